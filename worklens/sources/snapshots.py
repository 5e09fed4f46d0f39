"""Snapshot archive committed by a manifest (S-05, S-07, C-14, T-01).

    <root>/<table>/archive_time=<instant>/commit=<id>/   rows, written first
    <root>/_commits/<id>/                                 one JSON row, written last

A snapshot is what one run archives at one instant, over any number of tables.
Its rows go to fresh folders; then one small file publishes them.  Readers follow
the published list and nothing else, so they never see half a snapshot, a failed
attempt leaves only folders that nobody reads, and a rerun that has no rows
replaces its snapshot by an empty one.

``replace`` commits stand for their tables' whole snapshot; ``append`` commits add
to it (one extract that arrives as several files).  ``deliveries`` records what a
commit has taken in, in the same published row: a ledger that cannot disagree with
the archive.  One writer at a time; readers need no coordination.  The list grows by
a row per commit (some a day), so it is read whole.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEXTS = T.ArrayType(T.StringType())
COMMIT = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("version", T.LongType()),
    T.StructField("archive_time", T.StringType()), T.StructField("mode", T.StringType()),
    T.StructField("tables", TEXTS), T.StructField("deliveries", TEXTS)])


@dataclass(frozen=True)
class Commit:
    id: str
    version: int
    archive_time: dt.datetime
    mode: str
    tables: tuple[str, ...]
    deliveries: tuple[str, ...]


def instant(value: dt.date | dt.datetime) -> dt.datetime:
    """A run's date as midnight; an instant as it is."""
    return value if isinstance(value, dt.datetime) else dt.datetime.combine(value, dt.time())


def as_instant(value: dt.date | dt.datetime) -> F.Column:
    """A literal without a time zone (a Python datetime would be read in the session's)."""
    return F.lit(instant(value).isoformat(sep=" ")).cast("timestamp_ntz")


def read_if_any(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                **options: str) -> DataFrame:
    """The files below ``path``; an empty table where nothing was ever written."""
    try:
        return spark.read.schema(schema).options(**options).format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def commits(spark: SparkSession, root: str) -> list[Commit]:
    """Everything published below ``root``, in order."""
    rows = read_if_any(spark, f"{root}/_commits", COMMIT, "json", recursiveFileLookup="true").collect()
    found = [Commit(r.id, r.version, dt.datetime.fromisoformat(r.archive_time), r.mode,
                    tuple(r.tables or ()), tuple(r.deliveries or ())) for r in rows]
    return sorted(found, key=lambda c: (c.version, c.id))


def deliveries(found: Iterable[Commit]) -> set[str]:
    return {d for c in found for d in c.deliveries}


def publish(spark: SparkSession, root: str, commit_id: str, archive_time: dt.datetime, mode: str,
            tables: Sequence[str], taken: Sequence[str]) -> None:
    """Make a commit visible: one row in one file, put in place by one rename."""
    version = max((c.version for c in commits(spark, root)), default=0) + 1
    row = spark.range(1).coalesce(1).select(
        F.lit(commit_id).alias("id"), F.lit(version).cast("long").alias("version"),
        F.lit(archive_time.isoformat()).alias("archive_time"), F.lit(mode).alias("mode"),
        F.lit(list(tables)).cast(TEXTS).alias("tables"), F.lit(list(taken)).cast(TEXTS).alias("deliveries"))
    row.write.json(f"{root}/_commits/{commit_id}")


def folder(root: str, table: str, archive_time: dt.datetime, commit_id: str) -> str:
    # Colons are escaped as Spark escapes them in partition folders.
    stamp = archive_time.isoformat(sep=" ").replace(":", "%3A")
    return f"{root}/{table}/archive_time={stamp}/commit={commit_id}"


def write_snapshot(spark: SparkSession, root: str, archive_time: dt.date | dt.datetime,
                   tables: Mapping[str, DataFrame], mode: str = "replace",
                   taken: Sequence[str] = ()) -> str:
    """S-07: archive ``tables`` (name -> rows) as one snapshot; returns the commit's id."""
    if mode not in ("replace", "append"):
        raise ValueError(f"mode {mode!r}")
    at, commit_id = instant(archive_time), uuid.uuid4().hex
    for name, df in tables.items():
        df.drop("archive_time").write.parquet(folder(root, name, at, commit_id))
    publish(spark, root, commit_id, at, mode, list(tables), taken)
    return commit_id


def live(found: Sequence[Commit], table: str, since: dt.date | dt.datetime | None = None,
         until: dt.date | dt.datetime | None = None) -> list[Commit]:
    """The commits that make up ``table``: of each instant the last replacement and what came after."""
    chosen: dict[dt.datetime, list[Commit]] = {}
    for c in found:
        if table in c.tables:
            if c.mode == "replace":
                chosen[c.archive_time] = []
            chosen.setdefault(c.archive_time, []).append(c)
    lo = dt.datetime.min if since is None else instant(since)
    # A date as the end of the range includes that whole day.
    hi = dt.datetime.max if until is None else until if isinstance(until, dt.datetime) else \
        dt.datetime.combine(until, dt.time.max)
    return [c for at in sorted(chosen) if lo <= at <= hi for c in chosen[at]]


def read_commits(spark: SparkSession, root: str, table: str, schema: T.StructType,
                 chosen: Sequence[Commit]) -> DataFrame:
    """The rows of these commits in ``schema`` order, and ``commit``; no other folder is listed."""
    full = T.StructType([*schema.fields, T.StructField("commit", T.StringType())])
    if not chosen:
        return spark.createDataFrame([], full)
    folders = [folder(root, table, c.archive_time, c.id) for c in chosen]
    df = spark.read.schema(full).option("basePath", f"{root}/{table}").parquet(*folders)
    return df.select(*full.fieldNames())


def read_snapshots(spark: SparkSession, root: str, table: str, schema: T.StructType,
                   since: dt.date | dt.datetime | None = None, until: dt.date | dt.datetime | None = None,
                   legacy: str | None = None) -> DataFrame:
    """S-05: a table of the archive, optionally of a range of instants.

    Columns that older commits do not have are null.  ``legacy`` is a folder of an
    earlier layout, Parquet partitioned by the date of the snapshot: its rows
    join with that date's midnight, unless a commit of that instant replaces them.
    """
    chosen = live(commits(spark, root), table, since, until)
    df = read_commits(spark, root, table, schema, chosen).drop("commit")
    if legacy is None:
        return df
    old_schema = T.StructType([T.StructField(f.name, T.DateType()) if f.name == "archive_time" else f
                               for f in schema.fields])
    old = read_if_any(spark, legacy, old_schema).select(*schema.fieldNames())
    lo, hi = (None if x is None else F.lit(x.date() if isinstance(x, dt.datetime) else x)
              for x in (since, until))
    if lo is not None:
        old = old.where(F.col("archive_time") >= lo)
    if hi is not None:
        old = old.where(F.col("archive_time") <= hi)
    replaced = [c.archive_time.date() for c in live(commits(spark, root), table)
                if c.archive_time.time() == dt.time()]
    if replaced:
        old = old.where(~F.col("archive_time").isin(replaced))
    return df.unionByName(old.withColumn("archive_time", F.col("archive_time").cast("timestamp_ntz")))


# summaries ---------------------------------------------------------------------------------

def unsummarised(spark: SparkSession, root: str, table: str, schema: T.StructType,
                 name: str) -> tuple[DataFrame, list[Commit]]:
    """The live rows of ``table`` that summary ``name`` has not met, and their commits."""
    done = deliveries(commits(spark, f"{root}/_summaries/{name}"))
    new = [c for c in live(commits(spark, root), table) if c.id not in done]
    return read_commits(spark, root, table, schema, new), new


def refresh_summary(spark: SparkSession, root: str, table: str, schema: T.StructType, name: str,
                    summarise, summary_schema: T.StructType) -> DataFrame:
    """Rows of ``summarise`` (a mergeable aggregate) for every live commit, computed once each.

    A refresh reads the commits that are new since the last one only; commits
    never change, so their summaries stay.  ``summarise`` takes rows with
    ``commit`` and ``archive_time`` and keeps both among its group keys;
    ``summary_schema`` holds both.  Commits of one instant are to be merged by
    the reader.
    """
    store = f"{root}/_summaries/{name}"
    rows, new = unsummarised(spark, root, table, schema, name)
    if new:
        commit_id, at = uuid.uuid4().hex, max(c.archive_time for c in new)
        summarise(rows).write.parquet(f"{store}/{commit_id}")
        publish(spark, store, commit_id, at, "append", [name], [c.id for c in new])
    kept = [c.id for c in live(commits(spark, root), table)]
    parts = [f"{store}/{c.id}" for c in commits(spark, store)]
    if not kept:
        return spark.createDataFrame([], summary_schema)
    return spark.read.schema(summary_schema).parquet(*parts).where(F.col("commit").isin(kept))
