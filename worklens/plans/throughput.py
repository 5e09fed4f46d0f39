"""Throughput datasets (C-18 .. C-20): POs and PO lines per buyer per Sunday week.

Plan: scan with pushed-down predicate -> broadcast join to the checked
dimension (drops unknown and IGNORE buyers before the shuffle) -> one hash
aggregation by (buyer, week) that yields both the PO count and the line
count.  The long form is the dataset; the wide form pivots over an explicit
week list so its schema never depends on the data.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worklens.context import IGNORE_CATEGORY, THROUGHPUT_LEVELS, RunContext
from worklens.functions.columns import (
    abbreviate, array_length, category_rank, format_week, week_start_sunday,
)
from worklens.operators.core import checked_dimension
from worklens.sources.io import read_po_frame


def line_count(po: DataFrame) -> F.Column:
    """Lines per PO: ``n_lines`` where given, else the length of the nested list, else 0.

    The length is that of one field of the lines, so that nothing else of a
    document's lines is read.
    """
    given = [F.col("n_lines")] if "n_lines" in po.columns else []
    nested = [array_length(F.col("lines")["line_no"])] if "lines" in po.columns else []
    return F.coalesce(*given, *nested, F.lit(0)).cast("bigint")


def weekly(po: DataFrame, buyers: DataFrame, ctx: RunContext) -> DataFrame:
    """C-18 + C-19 shared aggregation: (category, buyer, week) -> po_cnt, line_cnt."""
    counted = po.withColumn("line_count", line_count(po))
    pos = read_po_frame(counted, ctx, ["po_no", "po_date", "buyer", "line_count"])
    dim = checked_dimension(buyers, "buyer", ctx.broadcast_max_rows)
    kept = (pos.join(dim, "buyer", "inner")
               .where(F.col("category") != IGNORE_CATEGORY)
               .withColumn("week_start", week_start_sunday("po_date")))
    return (kept.groupBy("category", "buyer", "week_start")
                .agg(F.count(F.lit(1)).alias("po_cnt"),
                     F.sum("line_count").cast("bigint").alias("line_cnt")))


def _display(agg: DataFrame, measure: str) -> DataFrame:
    return agg.select(
        "category", category_rank("category", THROUGHPUT_LEVELS).alias("category_rank"),
        abbreviate("buyer").alias("buyer"), F.col("buyer").alias("buyer_full"),
        "week_start", format_week("week_start").alias("week_label"), measure)


def po_throughput(po: DataFrame, buyers: DataFrame, ctx: RunContext) -> DataFrame:
    """C-18: POs per buyer and week (long form, weeks with POs)."""
    return _display(weekly(po, buyers, ctx), "po_cnt")


def line_throughput(po: DataFrame, buyers: DataFrame, ctx: RunContext) -> DataFrame:
    """C-19: PO lines per buyer and week (long form)."""
    return _display(weekly(po, buyers, ctx), "line_cnt")


def week_column(w: dt.date) -> str:
    return f"w_{w:%Y_%m_%d}"


def wide(long: DataFrame, measure: str, weeks: Sequence[dt.date]) -> DataFrame:
    """R-01 + D-15: one column per week (``w_yyyy_MM_dd``), missing weeks as 0.

    Columns are keyed by the full week date, not the ``MM/dd`` label, so weeks
    of different years never merge (Q10).  The weeks are the run's fixed range:
    a week without POs is a column of zeros, POs outside it are in the long form only.
    """
    names = {str(w): week_column(w) for w in weeks}
    p = (long.groupBy("category", "category_rank", "buyer", "buyer_full")
             .pivot("week_start", list(weeks)).agg(F.sum(measure).cast("bigint")))
    p = p.withColumnsRenamed(names)
    return p.fillna(0, subset=list(names.values()))


def po_throughput_wide(po: DataFrame, buyers: DataFrame, ctx: RunContext) -> DataFrame:
    """C-18 wide: the PO count table as displayed, one column per week."""
    return wide(po_throughput(po, buyers, ctx), "po_cnt", ctx.report_weeks)


def line_throughput_wide(po: DataFrame, buyers: DataFrame, ctx: RunContext) -> DataFrame:
    """C-19 wide: the PO line count table as displayed, one column per week."""
    return wide(line_throughput(po, buyers, ctx), "line_cnt", ctx.report_weeks)


def throughput_groups(po: DataFrame, buyers: DataFrame, ctx: RunContext) -> DataFrame:
    """C-20: buyers with POs per displayed category (A-14 distinct, J-03, F-09, A-07)."""
    active = read_po_frame(po, ctx, ["buyer"]).distinct()
    dim = checked_dimension(buyers, "buyer", ctx.broadcast_max_rows)
    return (active.join(dim, "buyer", "inner")
                  .where(F.col("category") != IGNORE_CATEGORY)
                  .groupBy("category").agg(F.count(F.lit(1)).alias("n_buyers"))
                  .withColumn("category_rank", category_rank("category", THROUGHPUT_LEVELS)))


def datasets(by_week: DataFrame, ctx: RunContext) -> dict[str, DataFrame]:
    """C-18 .. C-20 of a run from its :func:`weekly` counts: the POs are read once."""
    counts, lines = _display(by_week, "po_cnt"), _display(by_week, "line_cnt")
    groups = (by_week.select("category", "buyer").distinct()
              .groupBy("category").agg(F.count(F.lit(1)).alias("n_buyers"))
              .withColumn("category_rank", category_rank("category", THROUGHPUT_LEVELS)))
    return {"po_throughput": counts, "line_throughput": lines,
            "po_throughput_wide": wide(counts, "po_cnt", ctx.report_weeks),
            "line_throughput_wide": wide(lines, "line_cnt", ctx.report_weeks),
            "throughput_groups": groups}
