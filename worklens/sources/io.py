"""Readers and writers (S-01 .. S-09).

Every reader takes an explicit schema, so nothing is inferred and the plan's
output schema is fixed.  Parquet readers get predicate pushdown and column
pruning from Catalyst; the archive is partitioned by snapshot so trend
queries over a date range prune whole folders.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from worklens import schemas
from worklens.context import RunContext
from worklens.sources.landing import Landed, land_csv


def read_table(spark: SparkSession, path: str, schema: T.StructType,
               fmt: str = "parquet", columns: Sequence[str] | None = None) -> DataFrame:
    """Generic schema-enforced reader; CSV extracts need a header row."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", "true").option("mode", "PERMISSIVE")
    df = reader.format(fmt).load(path)
    return df.select(*columns) if columns else df


def land_backlog(spark: SparkSession, path: str) -> Landed:
    """S-01 from CSV: rows, rejects and counts (title row already removed when landed)."""
    return land_csv(spark, path, schemas.BACKLOG, required=("requisition_id",))


def land_worklist(spark: SparkSession, path: str) -> Landed:
    """S-02 from CSV: as :func:`land_backlog`; the place in the extract breaks ties of repeated lines."""
    return land_csv(spark, path, schemas.WORKLIST, required=("po_no", "line"), optional=("tie1", "tie2"),
                    position="tie1")


def read_backlog(spark: SparkSession, path: str, fmt: str = "parquet",
                 columns: Sequence[str] | None = None) -> DataFrame:
    """S-01: the requisition backlog extract; of CSV the rows that parse (:func:`land_backlog`)."""
    if fmt == "csv":
        rows = land_backlog(spark, path).rows
        return rows.select(*columns) if columns else rows
    return read_table(spark, path, schemas.BACKLOG, fmt, columns)


def read_worklist(spark: SparkSession, path: str, fmt: str = "parquet",
                  columns: Sequence[str] | None = None) -> DataFrame:
    """S-02: the approver worklist extract; of CSV the rows that parse (:func:`land_worklist`)."""
    if fmt == "csv":
        rows = land_worklist(spark, path).rows
        return rows.select(*columns) if columns else rows
    return read_table(spark, path, schemas.WORKLIST, fmt, columns)


def read_buyers(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """S-03: the buyer dimension."""
    return read_table(spark, path, schemas.BUYERS, fmt)


def po_predicate(ctx: RunContext) -> F.Column:
    """F-10: strict lower bound on the PO date and the kept statuses."""
    # date -> timestamp_ntz is midnight with no zone involved (a Python datetime
    # literal would be read in the session zone).
    kept = F.col("status").isin(*ctx.po_statuses)
    if ctx.po_date_after is None:
        return F.col("po_date").isNotNull() & kept
    return (F.col("po_date") > F.lit(ctx.po_date_after).cast("timestamp_ntz")) & kept


def read_po(spark: SparkSession, path: str, ctx: RunContext,
            fields: Sequence[str] = ("po_no", "po_date", "buyer", "n_lines")) -> DataFrame:
    """S-04 + P-09: POs with the store-side predicate and field list (``lines``: nested documents).

    Both reach the Parquet scan (PushedFilters / ReadSchema) instead of being
    evaluated after a full read; of nested lines only the fields used later are read.
    """
    return read_po_frame(spark.read.schema(schemas.PO).parquet(path), ctx, fields)


def read_po_frame(po: DataFrame, ctx: RunContext,
                  fields: Sequence[str] = ("po_no", "po_date", "buyer", "n_lines")) -> DataFrame:
    return po.where(po_predicate(ctx)).select(*fields)


def read_archive(spark: SparkSession, path: str, schema: T.StructType,
                 since: dt.date | None = None, until: dt.date | None = None) -> DataFrame:
    """S-05: the archive, optionally restricted to a snapshot range (partition pruning).

    Columns come back in ``schema`` order (Spark appends partition columns last).
    """
    df = spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
    if since is not None:
        df = df.where(F.col("archive_time") >= F.lit(since))
    if until is not None:
        df = df.where(F.col("archive_time") <= F.lit(until))
    return df


def read_json_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """S-06 / D-24: JSON-lines documents with an explicit schema (malformed -> nulls)."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def parse_json_column(df: DataFrame, col: str, schema: T.StructType,
                      alias: str = "doc") -> DataFrame:
    """D-24: JSON text column -> struct column."""
    return df.withColumn(alias, F.from_json(F.col(col), schema))


def write_archive(df: DataFrame, path: str,
                  partition_by: Sequence[str] = ("archive_time",),
                  files_per_partition: int | None = None) -> None:
    """S-07: add a snapshot to the archive.

    Dynamic partition overwrite: only the partitions present in ``df`` are
    replaced, so re-running the same snapshot leaves one copy (Q12) and older
    snapshots are untouched.  The default partitioning is the snapshot alone:
    a rerun then replaces the whole snapshot, even when a status present in
    the first run is absent from the corrected one (with ``status`` as a
    partition column its stale folder would survive).  No trend filters on
    status, so nothing is lost in pruning.

    By default every task writes its own file per partition it holds (no extra
    shuffle).  ``files_per_partition=n`` instead shuffles once on the partition
    columns plus a hash salt of ``n`` values, giving about ``n`` files per
    partition; the salt keeps a partition that holds a third of the rows
    spread over ``n`` tasks rather than one.
    """
    if files_per_partition:
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(files_per_partition))
        df = df.repartition(*[F.col(c) for c in partition_by], salt)
    (df.write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_by)
       .parquet(path))


def write_jsonl(df: DataFrame, path: str) -> None:
    """S-08: export as JSON lines (one file per task, written in parallel)."""
    df.write.mode("overwrite").json(path)


def publish_datasets(datasets: Mapping[str, DataFrame], out_dir: str,
                     fmt: str = "parquet") -> dict[str, str]:
    """S-09: materialise each report dataset under ``out_dir/<name>``."""
    paths = {}
    for name, df in datasets.items():
        p = f"{out_dir.rstrip('/')}/{name}"
        w = df.write.mode("overwrite").format(fmt)
        if fmt == "csv":
            # keep labels such as the total row's " " intact (the writer trims by default)
            w = (w.option("header", "true").option("ignoreLeadingWhiteSpace", "false")
                  .option("ignoreTrailingWhiteSpace", "false"))
        w.save(p)
        paths[name] = p
    return paths


def read_in_order(spark: SparkSession, path: str) -> DataFrame:
    """A published Parquet dataset in the order it was published in.

    A global sort writes one file per range, named in range order, each sorted:
    the place in the dataset is (file name, row number).
    """
    return spark.read.parquet(path).orderBy("_metadata.file_name", "_metadata.row_index")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    Cuts lineage like ``checkpoint()`` but computes the plan once (a reliable
    RDD checkpoint recomputes an unpersisted plan to write it), keeps the data
    columnar and compressed, and gives later plans file statistics.  Losing an
    executor afterwards costs a re-read, not a recomputation.
    """
    from worklens.session import scratch_path
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Shape ``df`` to ``schema``: fields in order, cast, absent ones as typed nulls.

    Used to land a derived table in an extract's exact layout (CSV readers map
    columns by position).
    """
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields])
