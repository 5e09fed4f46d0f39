"""Backlog report datasets (C-01 .. C-09).

Plan shape for every table: one scan of the backlog, a broadcast join to the
(size-checked) buyer dimension, row-local columns (age, status, bucket), and a
single hash aggregation with map-side partial aggregation.  The reference's
three filtered copies + three counts + two full outer joins collapse into one
conditional aggregation; subtotals and the total are a ROLLUP over the already
small per-buyer table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worklens.context import (
    BACKLOG_AGE_EDGES, BACKLOG_AMOUNT_EDGES, BACKLOG_LEVELS, BROADCAST_MAX_ROWS, HOLD_NO, HOLD_YES,
    OTB_NOT_REQUESTED, OTB_REQUESTED, RunContext,
)
from worklens.functions.columns import (
    abbreviate, age_days, category_in, category_rank, fixed_bins, row_sum,
)
from worklens.operators.core import (
    bounded_by_dimension, bucket_counts, checked_dimension, unpivot_counts, with_totals,
)

PLAIN, HOLD, OUT_TO_BID = "plain", "hold", "out_to_bid"

AGE_BUCKETS = [("0", "age_0_30"), ("30", "age_30_60"), ("60", "age_60_90"),
               ("90", "age_90_plus"), (HOLD, "hold_cnt"), (OUT_TO_BID, "out_to_bid_cnt")]
AMOUNT_BUCKETS = [("0", "amt_lt_250k"), ("250000", "amt_250k_500k"),
                  ("500000", "amt_500k_plus"), (HOLD, "hold_cnt"),
                  (OUT_TO_BID, "out_to_bid_cnt")]

# Display labels of the chart series (one spelling for both charts).
CHART_TYPES = {"actionable_cnt": "Actionable", "on_hold_cnt": "On Hold",
               "out_to_bid_cnt": "Out-to-Bid"}


def status_of(hold: Column, out_to_bid: Column) -> Column:
    """C-02 / F-03..F-05: the mutually exclusive status; null when in no split.

    Out-to-bid wins over hold.  Null flags fall through every branch, exactly
    like the reference's three filters.
    """
    return (F.when(out_to_bid == OTB_REQUESTED, F.lit(OUT_TO_BID))
             .when((hold == HOLD_YES) & (out_to_bid != OTB_REQUESTED), F.lit(HOLD))
             .when((hold == HOLD_NO) & (out_to_bid == OTB_NOT_REQUESTED), F.lit(PLAIN)))


def in_window(approved: F.Column, ctx: RunContext) -> F.Column:
    """F-02: approval date inside the run's window; an end that is not given is open."""
    inside = approved.isNotNull()
    if ctx.date_from is not None:
        inside = inside & (approved >= F.lit(ctx.date_from))
    if ctx.date_to is not None:
        inside = inside & (approved <= F.lit(ctx.date_to))
    return inside


def clean_backlog(backlog: DataFrame, buyers: DataFrame, ctx: RunContext) -> DataFrame:
    """C-01: backlog rows of known buyers inside the approval window, with age and category.

    The reference full-joins the dimension and then drops null buyers, null
    categories and out-of-window dates: net effect an inner join (J-01).
    ``category_dim`` keeps the dimension's text (IGNORE included); ``category``
    is the ordered category, null for IGNORE (the reference factorises
    without removing them).
    """
    dim = checked_dimension(
        buyers.select("buyer", F.col("category").alias("category_dim")),
        "buyer", ctx.broadcast_max_rows)
    return (backlog
            .join(dim, "buyer", "inner")
            .where(in_window(F.col("date_of_approval"), ctx))
            .withColumn("age", age_days("date_of_approval", ctx.as_of))
            .withColumn("category", category_in("category_dim", BACKLOG_LEVELS)))


def status_split(clean: DataFrame) -> DataFrame:
    """C-02: one status column instead of three filtered copies."""
    return clean.withColumn("status", status_of(F.col("hold"), F.col("out_to_bid")))


def _bucketed_table(rows: DataFrame, plain_bucket: Column,
                    buckets: list[tuple[str, str]]) -> DataFrame:
    bucket = (F.when(F.col("status") == PLAIN, plain_bucket.cast("string"))
               .otherwise(F.col("status")))
    measures = [name for _, name in buckets]
    return (bucket_counts(rows.where(F.col("status").isNotNull()),
                          ["category_dim", "buyer"], bucket, buckets)
            .withColumn("total", row_sum(measures))
            .withColumnRenamed("category_dim", "category"))


def age_table(split: DataFrame) -> DataFrame:
    """C-03: per buyer, actionable rows by age bin, hold and out-to-bid counts, Total.

    Only buyers with at least one row in a split appear (Q15); ``category`` is
    the dimension text, IGNORE included (Q3).
    """
    return _bucketed_table(split, fixed_bins("age", BACKLOG_AGE_EDGES), AGE_BUCKETS)


def amount_table(split: DataFrame, ctx: RunContext) -> DataFrame:
    """C-09: 90+ rows, actionable ones by amount bin (null amount: no bin, Q19)."""
    old = split.where(F.col("age") >= ctx.min_age_days)
    return _bucketed_table(old, fixed_bins("req_total", BACKLOG_AMOUNT_EDGES), AMOUNT_BUCKETS)


def report_rows(table: DataFrame, measures: list[str],
                total_displayed_only: bool = False) -> DataFrame:
    """C-04 / C-09: detail rows, category subtotals and the grand total in display form.

    The total is taken over every category, IGNORE included, and IGNORE rows
    are dropped afterwards (Q3, the reference's behaviour).
    ``total_displayed_only=True`` restricts the total to the displayed
    categories instead.  ``row_kind`` and ``category_rank`` give the display
    order NINV, SE, INV, Total.
    """
    if total_displayed_only:
        table = table.where(F.col("category").isin(*BACKLOG_LEVELS))
    t = with_totals(table, "category", "buyer", measures)
    lvl = F.col("row_level")
    shown = t.where((lvl == 3) | F.col("category").isin(*BACKLOG_LEVELS))
    category = F.when(lvl == 3, F.lit("Total")).otherwise(F.col("category"))
    return shown.select(
        category.alias("category"),
        F.when(lvl == 0, abbreviate("buyer")).when(lvl == 1, F.lit("Subtotal"))
         .otherwise(F.lit(" ")).alias("buyer"),
        F.when(lvl == 0, F.col("buyer")).alias("buyer_full"),
        F.when(lvl == 0, F.lit("buyer")).when(lvl == 1, F.lit("subtotal"))
         .otherwise(F.lit("total")).alias("row_kind"),
        category_rank(category, (*BACKLOG_LEVELS, "Total")).alias("category_rank"),
        *measures,
    )


def age_report(split: DataFrame, total_displayed_only: bool = False) -> DataFrame:
    """C-04: the age table with subtotals and total, as displayed."""
    measures = [name for _, name in AGE_BUCKETS] + ["total"]
    return report_rows(age_table(split), measures, total_displayed_only)


def amount_report(split: DataFrame, ctx: RunContext,
                  total_displayed_only: bool = False) -> DataFrame:
    """C-09: the 90+ amount table with subtotals and total, as displayed."""
    measures = [name for _, name in AMOUNT_BUCKETS] + ["total"]
    return report_rows(amount_table(split, ctx), measures, total_displayed_only)


def report_groups(table: DataFrame) -> DataFrame:
    """C-05 / C-09: display rows per category; IGNORE becomes a null category."""
    return (table.groupBy("category").agg(F.count(F.lit(1)).alias("n_rows"))
                 .select(category_in("category", BACKLOG_LEVELS).alias("category"),
                         category_rank("category", BACKLOG_LEVELS).alias("category_rank"),
                         "n_rows"))


def status_counts(rows: DataFrame, group_cols: list[str]) -> DataFrame:
    """A-01: classified rows per group and status, one conditional aggregation."""
    s = F.col("status")
    return (rows.where(s.isNotNull()).groupBy(*group_cols)
                .agg(F.count_if(s == PLAIN).alias("actionable_cnt"),
                     F.count_if(s == HOLD).alias("on_hold_cnt"),
                     F.count_if(s == OUT_TO_BID).alias("out_to_bid_cnt")))


def status_chart(split: DataFrame, buyers: DataFrame,
                 max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """C-06: (buyer, category, type, count) for the stacked bar chart.

    Counts are zero-filled among buyers with work, then every dimension buyer
    is added; idle buyers keep null counts (Q4).  The counts have one row per
    dimension buyer at most, so they are broadcast when the dimension may be.
    """
    return _status_chart(status_counts(split, ["buyer"]), buyers, max_rows)


def _status_chart(counts: DataFrame, buyers: DataFrame,
                  max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    counts = bounded_by_dimension(counts, buyers, "buyer", max_rows)
    wide = buyers.join(counts, "buyer", "left")
    long = unpivot_counts(wide, ["buyer", "category"], CHART_TYPES, "type", "count")
    return long.select(
        abbreviate("buyer").alias("buyer"),
        F.col("buyer").alias("buyer_full"),
        category_in("category", BACKLOG_LEVELS).alias("category"),
        category_rank("category", BACKLOG_LEVELS).alias("category_rank"),
        "type", "count")


def hidden_buyers(table: DataFrame, buyers: DataFrame,
                  max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """C-07: dimension buyers with no row in the age table (J-05 anti join)."""
    active = bounded_by_dimension(table.select("buyer"), buyers, "buyer", max_rows)
    return (buyers.join(active, "buyer", "left_anti")
                  .select(abbreviate("buyer").alias("buyer"), F.col("buyer").alias("buyer_full")))


def old_table(split: DataFrame, ctx: RunContext) -> DataFrame:
    """C-08: 90+ counts per buyer by status (no Total); only buyers with such rows."""
    old = split.where(F.col("age") >= ctx.min_age_days)
    return (status_counts(old, ["category", "buyer"])
            .withColumn("category_rank", category_rank("category", BACKLOG_LEVELS)))


def old_chart(split: DataFrame, ctx: RunContext) -> DataFrame:
    """C-08: long form of the 90+ table for the chart."""
    return _old_chart(old_table(split, ctx))


def _old_chart(t: DataFrame) -> DataFrame:
    long = unpivot_counts(t, ["buyer", "category", "category_rank"], CHART_TYPES,
                          "type", "count")
    return long.select(abbreviate("buyer").alias("buyer"), F.col("buyer").alias("buyer_full"),
                       "category", "category_rank", "type", "count")


# One pass for a whole run: every table above is a projection of one aggregate per buyer.

STATUS_MEASURES = {PLAIN: "actionable_cnt", HOLD: "on_hold_cnt", OUT_TO_BID: "out_to_bid_cnt"}


def buyer_summary(split: DataFrame, ctx: RunContext) -> DataFrame:
    """All counts of C-03 .. C-09 per (category_dim, category, buyer), in one aggregation."""
    status, old = F.col("status"), F.col("age") >= ctx.min_age_days

    def bucket(plain: Column) -> Column:
        return F.when(status == PLAIN, plain.cast("string")).otherwise(status)

    age, amount = (bucket(fixed_bins(c, edges)) for c, edges in
                   (("age", BACKLOG_AGE_EDGES), ("req_total", BACKLOG_AMOUNT_EDGES)))
    return (split.where(status.isNotNull()).groupBy("category_dim", "category", "buyer").agg(
        *[F.count_if(age == v).alias(f"age_{name}") for v, name in AGE_BUCKETS],
        *[F.count_if(old & (amount == v)).alias(f"amount_{name}") for v, name in AMOUNT_BUCKETS],
        F.count_if(old).alias("old_rows"),
        *[F.count_if(status == s).alias(f"all_{name}") for s, name in STATUS_MEASURES.items()],
        *[F.count_if(old & (status == s)).alias(f"old_{name}") for s, name in STATUS_MEASURES.items()]))


def _summary_table(summary: DataFrame, kind: str, measures: list[str]) -> DataFrame:
    t = summary.select(F.col("category_dim").alias("category"), "buyer",
                       *[F.col(f"{kind}_{m}").alias(m) for m in measures])
    return t.withColumn("total", row_sum(measures))


def summary_datasets(summary: DataFrame, buyers: DataFrame) -> dict[str, DataFrame]:
    """C-03 .. C-09 of a run from its ``buyer_summary``: no fact row is read again."""
    age_measures, amount_measures = ([n for _, n in b] for b in (AGE_BUCKETS, AMOUNT_BUCKETS))
    shown = list(STATUS_MEASURES.values())
    old = summary.where("old_rows > 0")
    age = _summary_table(summary, "age", age_measures)
    amount = _summary_table(old, "amount", amount_measures)
    olds = (old.select("category", "buyer", *[F.col(f"old_{m}").alias(m) for m in shown])
               .withColumn("category_rank", category_rank("category", BACKLOG_LEVELS)))
    counts = summary.select("buyer", *[F.col(f"all_{m}").alias(m) for m in shown])
    return {
        "age_table": age,
        "age_report": report_rows(age, [*age_measures, "total"]),
        "age_report_groups": report_groups(age),
        "status_chart": _status_chart(counts, buyers),
        "hidden_buyers": hidden_buyers(age, buyers),
        "old_table": olds,
        "old_chart": _old_chart(olds),
        "amount_table": amount,
        "amount_report": report_rows(amount, [*amount_measures, "total"]),
        "amount_report_groups": report_groups(amount),
    }
