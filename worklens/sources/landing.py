"""CSV extracts with a reject channel (S-01, S-02).

Columns are bound by their header names, wherever they stand.  Every cell is read
as text and then parsed by the type that its column must have: several date
formats, amounts with currency signs, thousands separators and parentheses for
negative ones.  A row with a cell that does not parse, without a value it must
have, or with another number of cells than the header is kept aside with the
reason instead of becoming nulls that later filters drop unseen.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Header names of the extracts that differ from the column names used here.
HEADER_NAMES = {"hold_from_further_processing": "hold", "operid": "oper_id"}
DATE_FORMATS = ("yyyy-MM-dd", "M/d/yyyy")
TIME_FORMATS = ("yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSS]", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]",
                "M/d/yyyy H:mm[:ss]", "M/d/yyyy h:mm[:ss] a")
REJECTS = T.StructType([
    T.StructField("source_file", T.StringType()), T.StructField("errors", T.ArrayType(T.StringType())),
    T.StructField("record", T.StringType())])


@dataclass(frozen=True)
class Landed:
    """``rows`` in the schema asked for, ``rejects`` (see REJECTS), and counts.

    ``counts.get`` has ``n_rows`` and ``n_rejected`` of the extract once ``rows``
    has been computed by some action.
    """

    rows: DataFrame
    rejects: DataFrame
    counts: Observation


def column_name(header: str, names: Mapping[str, str] = HEADER_NAMES) -> str:
    """``PO No.`` -> ``po_no``."""
    plain = re.sub(r"[^a-z0-9]+", "_", header.strip().lower()).strip("_")
    return names.get(plain, plain)


def parse_cell(text: Column, kind: T.DataType) -> Column:
    """A trimmed, non-blank cell as ``kind``; null where it is none."""
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return _parse_time(text).cast(kind)
    if isinstance(kind, T.DecimalType):
        plain = F.regexp_replace(text, r"[$,\s]", "")
        return F.regexp_replace(plain, r"^\((.*)\)$", "-$1").try_cast(kind)
    return text.try_cast(kind)


def _parse_time(text: Column) -> Column:
    """The first format that ``text`` has; only those are tried that its signs allow.

    A format that does not fit costs an exception.  Beside digits, blanks and signs of years
    a cell has its format's ``/``, ``:`` and ``T`` and, for its ``a``, the M of AM or PM.
    """
    def has(sign: str) -> Column:
        return text.contains(sign) | text.contains(sign.lower()) if sign.isalpha() else text.contains(sign)

    def possible(fmt: str) -> Column:
        plain = fmt.replace("'", "").replace("M/d", "/").replace("MM", "")
        wanted = [has(x) if y in plain else ~has(x) for x, y in (("/", "/"), (":", ":"), ("T", "T"), ("M", "a"))]
        return reduce(Column.__and__, wanted)

    return F.coalesce(*[F.when(possible(f), F.try_to_timestamp(text, F.lit(f)))
                        for f in DATE_FORMATS + TIME_FORMATS])


def land_csv(spark: SparkSession, path: str, schema: T.StructType, required: Sequence[str] = (),
             optional: Sequence[str] = (), names: Mapping[str, str] = HEADER_NAMES,
             position: str | None = None) -> Landed:
    """Read an extract (a file, or a folder of files with one header).

    ``optional`` columns may be missing and are null then; any other missing column
    is an error, and so is a file whose header differs.  Columns that ``schema``
    does not have are ignored.  ``position`` names a column that, if the extract
    has none such, gets the row's place in it.
    """
    header = spark.read.option("header", "true").csv(path).columns
    at: dict[str, str] = {}
    for h in header:
        if at.setdefault(column_name(h, names), h) != h:
            raise ValueError(f"two columns of {path} are named {column_name(h, names)!r}")
    missing = [f.name for f in schema if f.name not in at and f.name not in (*optional, position)]
    if missing:
        raise ValueError(f"{path} lacks {missing}; it has {header}")
    corrupt = "_corrupt_record"
    raw_schema = T.StructType([T.StructField(h, T.StringType()) for h in (*header, corrupt)])
    raw = (spark.read.schema(raw_schema).option("header", "true").option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", corrupt).option("enforceSchema", "false")
           .option("columnPruning", "false").csv(path))

    def quoted(name: str) -> str:
        return "`" + name.replace("`", "``") + "`"

    # In steps, so that a cell is trimmed and parsed once although its value and its error need it.
    found = [f for f in schema.fields if f.name in at]
    record = F.coalesce(F.col(corrupt), F.to_json(F.struct(*map(quoted, header))))
    cells = raw.select(
        *[F.nullif(F.trim(F.col(quoted(at[f.name]))), F.lit("")).alias(f"_cell_{f.name}") for f in found],
        F.col(corrupt).isNotNull().alias("_corrupt"), F.monotonically_increasing_id().alias("_place"),
        record.alias("_record"), F.col("_metadata.file_path").alias("_file"))
    values = cells.select("*", *[parse_cell(F.col(f"_cell_{f.name}"), f.dataType).alias(f.name) for f in found])
    errors, columns = [F.when(F.col("_corrupt"), F.lit("number of cells"))], []
    for f in schema.fields:
        if f.name in at:
            cell = F.col(f"_cell_{f.name}")
            errors.append(F.when(cell.isNotNull() & F.col(f.name).isNull(), F.lit(f.name)))
            if f.name in required:
                errors.append(F.when(cell.isNull(), F.lit(f"{f.name} is missing")))
            columns.append(F.col(f.name))
        else:
            value = F.col("_place") if f.name == position else F.lit(None)
            columns.append(value.cast(f.dataType).alias(f.name))
    parsed = values.select(*columns, F.array_compact(F.array(*errors)).alias("_errors"), "_record", "_file")
    bad, counts = F.size("_errors") > 0, Observation()
    seen = parsed.observe(counts, F.count(F.lit(1)).alias("n_rows"), F.count_if(bad).alias("n_rejected"))
    return Landed(seen.where(~bad).select(*schema.fieldNames()),
                  parsed.where(bad).select(F.col("_file").alias("source_file"), F.col("_errors").alias("errors"),
                                           F.col("_record").alias("record")), counts)


def quarantine(landed: Landed, path: str) -> None:
    """Keep the rejected rows aside, beside those of earlier extracts."""
    landed.rejects.write.mode("append").parquet(path)
