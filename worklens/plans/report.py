"""End-to-end runs: every dataset of the backlog and throughput reports in one go.

The reference renders two reports per run.  Here a run publishes each report
dataset as a table under an output folder.  The two intermediates that many
datasets start from (the classified backlog and the prepared worklist), and the
two small aggregates that most are projections of, are written once as Parquet
into the shared checkpoint folder and read back (``io.materialize``): later
datasets read them instead of re-scanning and re-shuffling the extracts, their
lineage is cut, and a lost executor costs a re-read of those files rather than a
recomputation from the extracts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from worklens.context import RunContext
from worklens.plans import archive, backlog, throughput, worklist
from worklens.session import ensure_checkpoint_dir
from worklens.sources.io import materialize, publish_datasets

#: Row order in which a dataset is published (a leading "-": descending); nulls come last.
DISPLAY_ORDER = {
    "age_table": ("category", "buyer"),
    "age_report": ("category_rank", "row_rank", "buyer_full"),
    "age_report_groups": ("category_rank",),
    "status_chart": ("category_rank", "-buyer_full", "type"),
    "hidden_buyers": ("buyer_full",),
    "old_table": ("category_rank", "buyer"),
    "old_chart": ("category_rank", "-buyer_full", "type"),
    "amount_table": ("category", "buyer"),
    "amount_report": ("category_rank", "row_rank", "buyer_full"),
    "amount_report_groups": ("category_rank",),
    "approver_detail": ("-overall_age", "po_no"),
    "worklist_trend": ("archive_time",),
    "status_trend": ("scope", "status", "archive_time", "category"),
    "old_trend_sum": ("archive_time", "category"),
    "po_throughput": ("category_rank", "buyer_full", "week_start"),
    "line_throughput": ("category_rank", "buyer_full", "week_start"),
    "po_throughput_wide": ("category_rank", "buyer_full"),
    "line_throughput_wide": ("category_rank", "buyer_full"),
    "throughput_groups": ("category_rank",),
}


def row_rank() -> Column:
    """Within a category the buyers, then their subtotal; the total's category comes last."""
    return F.when(F.col("row_kind") == "buyer", 1).when(F.col("row_kind") == "subtotal", 2).otherwise(3)


def sort_key(name: str) -> Column:
    c = row_rank() if name == "row_rank" else F.col(name.removeprefix("-"))
    return c.desc_nulls_last() if name.startswith("-") else c.asc_nulls_last()


def in_display_order(name: str, df: DataFrame) -> DataFrame:
    """O-01 .. O-04: a dataset in the order it is shown (range partitions, each sorted)."""
    order = DISPLAY_ORDER.get(name)
    return df.orderBy(*map(sort_key, order)) if order else df


def backlog_datasets(split: DataFrame, prepared: DataFrame, buyers: DataFrame,
                     po_docs: DataFrame, req_docs: DataFrame, ctx: RunContext,
                     summary: DataFrame | None = None) -> dict[str, DataFrame]:
    """All datasets of the backlog report (C-03 .. C-13), as lazy plans.

    Those of the backlog are projections of one aggregate per buyer, ``summary``.
    """
    summary = backlog.buyer_summary(split, ctx) if summary is None else summary
    return {
        **backlog.summary_datasets(summary, buyers),
        "approver_overview": worklist.approver_overview(prepared),
        "approver_detail": worklist.approver_detail(prepared, po_docs, req_docs, ctx),
        "approver_counts": worklist.approver_counts(prepared, ctx),
    }


def run_backlog_report(spark: SparkSession, backlog_raw: DataFrame, approver_raw: DataFrame,
                       buyers: DataFrame, po_docs: DataFrame, req_docs: DataFrame,
                       ctx: RunContext, out_dir: str,
                       archive_root: str | None = None) -> dict[str, str]:
    """Publish the backlog report; optionally add this run's snapshot to the archive.

    The snapshot is committed before the trends are computed, so they include
    this run (the reference's order); of the archive, trends read what this run
    committed, and sum the counts of earlier snapshots.
    """
    ensure_checkpoint_dir(spark)
    split = materialize(backlog.status_split(backlog.clean_backlog(backlog_raw, buyers, ctx)),
                        "run-split")
    prepared = materialize(worklist.prepared_worklist(approver_raw, ctx), "run-prepared")
    summary = materialize(backlog.buyer_summary(split, ctx), "run-summary")
    datasets = backlog_datasets(split, prepared, buyers, po_docs, req_docs, ctx, summary)
    if archive_root is not None:
        archive.archive_snapshot(spark, split, prepared, ctx, archive_root)
        datasets.update({
            "worklist_trend": archive.worklist_trend_incremental(spark, archive_root, ctx),
            "status_trend": archive.status_trend_incremental(spark, archive_root, ctx),
            "old_trend_sum": archive.old_trend_sum_incremental(spark, archive_root, ctx),
        })
    return publish_datasets({k: in_display_order(k, d) for k, d in datasets.items()}, out_dir)


def run_throughput_report(po: DataFrame, buyers: DataFrame, ctx: RunContext,
                          out_dir: str) -> dict[str, str]:
    """Publish the throughput report (C-18 .. C-20), long and wide forms."""
    by_week = materialize(throughput.weekly(po, buyers, ctx), "run-weekly")
    return publish_datasets({k: in_display_order(k, d)
                             for k, d in throughput.datasets(by_week, ctx).items()}, out_dir)
