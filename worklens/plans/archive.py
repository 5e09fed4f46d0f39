"""Archive datasets (C-14 .. C-17): snapshot rows, history and trends.

The reference appends to four document collections and then exports every
collection in full on every run.  Here a run's rows are one committed snapshot
over two tables (``sources.snapshots``), stamped with the run's instant; a rerun
of the instant replaces it whole.  Trends are single grouped passes, or sums of
counts kept per snapshot, of which a run computes only its own
(``*_incremental``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from worklens import schemas
from worklens.context import RunContext
from worklens.functions.columns import age_days
from worklens.operators.core import null_safe_full_join
from worklens.plans.backlog import HOLD, OUT_TO_BID, PLAIN
from worklens.sources.io import conform
from worklens.sources.snapshots import as_instant, read_snapshots, refresh_summary, write_snapshot

BACKLOG_TABLE, WORKLIST_TABLE = "backlog", "worklist"
# Columns that the history fixtures and the first archive layout have.
BACKLOG_ARCHIVE_COLS = schemas.ARCHIVE_BACKLOG.fieldNames()
WORKLIST_ARCHIVE_COLS = schemas.ARCHIVE_WORKLIST.fieldNames()


def backlog_snapshot(split: DataFrame, ctx: RunContext) -> DataFrame:
    """C-14: the classified backlog rows of this run, every source column but the last change date."""
    rows = split.where(F.col("status").isNotNull()).withColumn("archive_time", as_instant(ctx.snapshot))
    return conform(rows, schemas.SNAPSHOT_BACKLOG)


def worklist_snapshot(prepared: DataFrame, ctx: RunContext) -> DataFrame:
    """C-14: the prepared worklist of this run, every source column that it keeps."""
    return conform(prepared.withColumn("archive_time", as_instant(ctx.snapshot)),
                   schemas.SNAPSHOT_WORKLIST)


def archive_snapshot(spark: SparkSession, split: DataFrame, prepared: DataFrame, ctx: RunContext,
                     root: str) -> str:
    """C-14 + S-07: commit both halves of this run's snapshot at once; returns the commit's id."""
    return write_snapshot(spark, root, ctx.snapshot,
                          {BACKLOG_TABLE: backlog_snapshot(split, ctx),
                           WORKLIST_TABLE: worklist_snapshot(prepared, ctx)})


def read_backlog_archive(spark: SparkSession, root: str, since=None, until=None,
                         legacy: str | None = None) -> DataFrame:
    return read_snapshots(spark, root, BACKLOG_TABLE, schemas.SNAPSHOT_BACKLOG, since, until, legacy)


def read_worklist_archive(spark: SparkSession, root: str, since=None, until=None,
                          legacy: str | None = None) -> DataFrame:
    return read_snapshots(spark, root, WORKLIST_TABLE, schemas.SNAPSHOT_WORKLIST, since, until, legacy)


def _replay(df: DataFrame, date_col: str, dates: Sequence[dt.date]) -> DataFrame:
    """Each row once per snapshot date on or after ``date_col`` (a row-local explode)."""
    if not dates:
        raise ValueError("a history needs its snapshot dates (RunContext.history_dates)")
    d = F.to_date(F.col(date_col))
    snaps = F.filter(F.array(*[F.lit(x) for x in dates]), lambda a: a >= d)
    return df.withColumn("archive_time", F.explode(snaps))


def backlog_history(split: DataFrame, dates: Sequence[dt.date]) -> DataFrame:
    """Archive history as past runs would have written it: one snapshot per date."""
    rows = split.where(F.col("status").isNotNull())
    return (_replay(rows, "date_of_approval", dates)
            .withColumn("age", age_days("date_of_approval", F.col("archive_time")))
            .select(*BACKLOG_ARCHIVE_COLS))


def worklist_history(prepared: DataFrame, dates: Sequence[dt.date]) -> DataFrame:
    """Worklist archive history: each prepared PO at every snapshot after its entry."""
    return (_replay(prepared, "date_time", dates)
            .withColumn("age", age_days("date_time", F.col("archive_time")))
            .select(*[c for c in WORKLIST_ARCHIVE_COLS if c in prepared.columns or c == "archive_time"]))


def worklist_trend(archive: DataFrame, ctx: RunContext) -> DataFrame:
    """C-15: POs at or above the amount threshold per archive time."""
    return (archive.where(F.col("sum_of_po_amt") >= F.lit(ctx.min_po_amount))
                   .groupBy("archive_time").agg(F.count(F.lit(1)).alias("cnt")))


def status_counts(archive: DataFrame, ctx: RunContext, *keys: str) -> DataFrame:
    """Rows and 90+ rows per status, archive time, category (and ``keys``): sums of these merge."""
    return (archive.groupBy(*keys, "archive_time", "status", "category")
                   .agg(F.count(F.lit(1)).alias("all"),
                        F.count_if(F.col("age") >= ctx.min_age_days).alias("90plus")))


def status_trend(archive: DataFrame, ctx: RunContext) -> DataFrame:
    """C-16: the six trend tables (3 statuses x {all, 90+}) from one grouped pass."""
    return _status_trend(status_counts(archive, ctx))


def _status_trend(counts: DataFrame) -> DataFrame:
    """``scope`` = 'all' | '90plus'; a 90+ row exists only where the group has
    90+ rows, as when the reference filters before grouping."""
    long = counts.unpivot(["status", "archive_time", "category"], ["all", "90plus"], "scope", "cnt")
    return long.where(F.col("cnt") > 0)


def old_trend_sum(archive: DataFrame, ctx: RunContext, zero_fill: bool = False) -> DataFrame:
    """C-17: 90+ total per (archive time, category) over the three statuses.

    One conditional aggregation replaces the null-safe full outer join chain:
    ``nullif(.., 0)`` restores "group absent" for plain and out-to-bid, hold is
    zero-filled, so the total is null exactly where the reference's is (Q5).
    ``zero_fill=True`` treats every absent status as 0 instead.
    """
    old = archive.where(F.col("age") >= ctx.min_age_days)
    return _old_trend_sum(old.withColumn("90plus", F.lit(1).cast("long")), zero_fill)


def _old_trend_sum(old: DataFrame, zero_fill: bool) -> DataFrame:
    """From rows that each stand for ``90plus`` archived ones."""
    def count(status: str):
        return F.coalesce(F.sum(F.when(F.col("status") == status, F.col("90plus"))), F.lit(0))

    def absent_as_null(c):
        return c if zero_fill else F.nullif(c, F.lit(0))

    g = old.groupBy("archive_time", "category").agg(
        absent_as_null(count(PLAIN)).alias("plain_cnt"), count(HOLD).alias("hold_cnt"),
        absent_as_null(count(OUT_TO_BID)).alias("out_to_bid_cnt"))
    return g.withColumn("cnt", F.col("plain_cnt") + F.col("hold_cnt") + F.col("out_to_bid_cnt"))


def old_trend_sum_joined(archive: DataFrame, ctx: RunContext) -> DataFrame:
    """J-06: the reference's literal form, three tables joined null-safely on all keys."""
    old = archive.where(F.col("age") >= ctx.min_age_days)

    def count(status: str, name: str) -> DataFrame:
        return (old.where(F.col("status") == status).groupBy("archive_time", "category")
                   .agg(F.count(F.lit(1)).alias(name)))

    keys = ["archive_time", "category"]
    j = null_safe_full_join(null_safe_full_join(count(PLAIN, "plain_cnt"),
                                                count(HOLD, "hold_cnt"), keys),
                            count(OUT_TO_BID, "out_to_bid_cnt"), keys)
    j = j.fillna({"hold_cnt": 0})
    return j.withColumn("cnt", F.col("plain_cnt") + F.col("hold_cnt") + F.col("out_to_bid_cnt"))


# Kept up by each run: counts of a committed snapshot never change, so a run
# computes those of its own commits and sums what is there.

def status_summary(spark: SparkSession, root: str, ctx: RunContext) -> DataFrame:
    """Counts per (commit, archive time, status, category), brought up to date."""
    return refresh_summary(
        spark, root, BACKLOG_TABLE, schemas.SNAPSHOT_BACKLOG, f"status-{ctx.min_age_days}",
        lambda rows: status_counts(rows, ctx, "commit"), schemas.STATUS_SUMMARY)


def status_trend_incremental(spark: SparkSession, root: str, ctx: RunContext) -> DataFrame:
    """C-16 from the summaries."""
    merged = status_summary(spark, root, ctx).groupBy("archive_time", "status", "category").agg(
        F.sum("all").alias("all"), F.sum("90plus").alias("90plus"))
    return _status_trend(merged)


def old_trend_sum_incremental(spark: SparkSession, root: str, ctx: RunContext,
                              zero_fill: bool = False) -> DataFrame:
    """C-17 from the summaries."""
    return _old_trend_sum(status_summary(spark, root, ctx).where(F.col("90plus") > 0), zero_fill)


def snapshot_counts_incremental(spark: SparkSession, root: str, ctx: RunContext,
                                *keys: str) -> DataFrame:
    """A-08 / A-09 from the summaries: rows per archive time (and category)."""
    return status_summary(spark, root, ctx).groupBy("archive_time", *keys).agg(F.sum("all").alias("n"))


def worklist_trend_incremental(spark: SparkSession, root: str, ctx: RunContext) -> DataFrame:
    """C-15 from the summaries."""
    kept = refresh_summary(
        spark, root, WORKLIST_TABLE, schemas.SNAPSHOT_WORKLIST, f"worklist-{ctx.min_po_amount}",
        lambda rows: (rows.where(F.col("sum_of_po_amt") >= F.lit(ctx.min_po_amount))
                          .groupBy("commit", "archive_time").agg(F.count(F.lit(1)).alias("cnt"))),
        schemas.WORKLIST_SUMMARY)
    return kept.groupBy("archive_time").agg(F.sum("cnt").alias("cnt"))
