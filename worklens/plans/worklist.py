"""Approver worklist datasets (C-10 .. C-13).

Keep-first and the strict PO sum are two declarative aggregations (``min``
over an order-led struct per (PO, line), then ``sum`` / ``min_by`` per PO),
each with map-side partial aggregation, so a PO with a huge number of repeated
lines never lands whole in one task.  The per-PO document lookup of the
reference (two HTTP calls per PO) becomes two equi-joins, selective side
first, whose strategy AQE picks from runtime sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worklens.context import APPROVER_AGE_EDGES, APPROVER_AMOUNT_EDGES, RunContext
from worklens.functions.columns import (
    abbreviate, age_days, fixed_bins, parse_date, row_sum, trim, truncate_ellipsis, usd,
)
from worklens.operators.core import keep_first, latest_per_key, sum_strict

TOTAL_MONEY = "decimal(38,2)"

AGE_COLS = ["age_0_7", "age_7_14", "age_14_30", "age_30_plus"]
AMOUNT_COLS = ["amt_lt_50k", "amt_50k_250k", "amt_250k_500k", "amt_500k_plus"]


LINE_ORDER = ("date_time", "tie1", "tie2")


def prepared_worklist(approver: DataFrame, ctx: RunContext,
                      line_order: tuple[str, ...] = LINE_ORDER,
                      one_shuffle: bool = False) -> DataFrame:
    """C-10: one row per PO: first row's attributes, strict amount sum, worklist age.

    1. first row per (po_no, line) by ``line_order`` (the extract's repeats); of
       rows alike in it the smallest amount, then the other columns;
    2. per PO, the sum of those rows' amounts, null when any is null (Q8),
       and the attributes of the row with the lowest line.

    Order columns that the extract does not have are left out.  Default plan:
    two shuffles, each after map-side partial aggregation, so a PO holding a
    large share of all rows is spread over its lines and then reduced to one row
    per task.  ``one_shuffle=True`` hash-partitions the rows by ``po_no`` once
    and runs both levels inside those partitions: half the shuffle volume, but
    every row of a PO goes to one task, so use it only where no PO is hot.
    """
    if one_shuffle:
        approver = approver.repartition("po_no")
    order = [c for c in line_order if c in approver.columns]
    firsts = keep_first(approver, ["po_no", "line"], order, then=["merch_amt"])
    attrs = [c for c in firsts.columns if c not in ("po_no", "line", "merch_amt")]
    # ``line`` is unique within a PO after step 1, so one ``min_by`` per attribute
    # picks the same row for all of them (by hash where all are fixed-width).
    per_po = (firsts.groupBy("po_no")
              .agg(sum_strict("merch_amt").cast(TOTAL_MONEY).alias("sum_of_po_amt"),
                   *[F.min_by(c, "line").alias(c) for c in attrs]))
    return per_po.select(
        "po_no", *attrs, "sum_of_po_amt", age_days("date_time", ctx.as_of).alias("age"))


def worklist_amounts(approver: DataFrame, ctx: RunContext,
                     line_order: tuple[str, ...] = LINE_ORDER) -> DataFrame:
    """What C-11, C-13 and C-15 need of C-10: (po_no, date_time, sum_of_po_amt, age).

    The same winners as :func:`prepared_worklist`, from the key, order and amount
    columns alone: no attribute of the extract is read, sorted or shuffled.
    """
    need = ["po_no", "line", *line_order, "merch_amt"]
    narrow = approver.select(*[c for c in dict.fromkeys(need) if c in approver.columns])
    return prepared_worklist(narrow, ctx, line_order).select("po_no", "date_time", "sum_of_po_amt", "age")


def approver_overview(prepared: DataFrame) -> DataFrame:
    """C-11: one row: POs per age bin, per amount bin, and Total (= sum of age bins).

    A global aggregation always yields exactly one row, zeros on empty input.
    Null age or amount falls in no bin (Q19).
    """
    age_bin = fixed_bins("age", APPROVER_AGE_EDGES)
    amt_bin = fixed_bins("sum_of_po_amt", APPROVER_AMOUNT_EDGES)
    aggs = ([F.count_if(age_bin == e).alias(n) for e, n in zip(APPROVER_AGE_EDGES, AGE_COLS)]
            + [F.count_if(amt_bin == e).alias(n) for e, n in zip(APPROVER_AMOUNT_EDGES, AMOUNT_COLS)])
    return prepared.agg(*aggs).withColumn("total", row_sum(AGE_COLS))


def _versioned(docs: DataFrame, *fields: F.Column) -> DataFrame:
    return docs.select(*fields, *(["updated_at"] if "updated_at" in docs.columns else []))


def _po_requisition(po_docs: DataFrame) -> DataFrame:
    """O-05 + D-12 + D-23: the trimmed requisition id of the first line of each PO's last document."""
    first = _versioned(po_docs, F.col("po_no"),
                       trim(F.get(F.col("lines")["requisition"]["req_id"], 0)).alias("req_id"))
    return latest_per_key(first, "po_no", "updated_at")


def _requisition_fields(req_docs: DataFrame) -> DataFrame:
    """D-04 + D-11: the last document's fields as shown; the description is cut before any join."""
    shown = _versioned(
        req_docs, F.col("req_id"), F.lit(True).alias("matched"),
        parse_date("approved_on").alias("req_approval_date"),
        truncate_ellipsis(F.get(F.col("lines")["more_info"], 0)).alias("req_description"),
        F.col("buyer").alias("req_buyer"))
    return latest_per_key(shown, "req_id", "updated_at")


def requisition_lookup(po_docs: DataFrame, req_docs: DataFrame,
                       pos: DataFrame | None = None) -> DataFrame:
    """J-08: PO -> first line's requisition id -> requisition fields.

    Returns (po_no, req_id, matched, req_approval_date, req_description,
    req_buyer) for every PO of ``pos`` (default: every PO with a document), one
    row each however many documents there are: of several with one key the one
    updated last counts.  Unmatched rows carry nulls here and get the reference's
    default row in :func:`approver_detail`.  Outer joins are not reordered by the
    optimizer, so the selective side goes first: the POs to look up, then their
    documents, then the requisitions.  Documents are cut to the few short fields
    shown and reduced to one per key on the exchange that their join needs
    anyway; Spark's runtime Bloom filter drops those of other POs before it where
    they are large.
    """
    po_req = _po_requisition(po_docs)
    left = po_req if pos is None else pos.join(po_req, "po_no", "left")
    return left.join(_requisition_fields(req_docs), "req_id", "left")


def approver_detail(prepared: DataFrame, po_docs: DataFrame, req_docs: DataFrame,
                    ctx: RunContext) -> DataFrame:
    """C-12: POs of at least the amount threshold with their requisition details.

    A PO without document, without requisition id or whose requisition is
    missing gets the default row (description "", date null, buyer "") (Q17).
    """
    big = (prepared.where(F.col("sum_of_po_amt") >= F.lit(ctx.min_po_amount))
                   .select("po_no", "sum_of_po_amt", F.col("age").alias("worklist_age")))
    found = F.col("matched").isNotNull()
    d = requisition_lookup(po_docs, req_docs, pos=big)
    approval = F.when(found, F.col("req_approval_date"))
    return d.select(
        age_days(approval, ctx.as_of).alias("overall_age"),
        "po_no",
        usd("sum_of_po_amt").alias("amount"),
        "worklist_age",
        F.when(found, F.col("req_description")).otherwise(F.lit("")).alias("line1_description"),
        F.when(found, abbreviate("req_buyer")).otherwise(F.lit("")).alias("req_buyer"))


def approver_counts(prepared: DataFrame, ctx: RunContext) -> DataFrame:
    """C-13: detail rows, all rows, and the omitted difference, in one aggregation."""
    big = F.col("sum_of_po_amt") >= F.lit(ctx.min_po_amount)
    return (prepared.agg(F.count_if(big).alias("detail_count"),
                         F.count(F.lit(1)).alias("total_count"))
                    .withColumn("omitted_count", F.col("total_count") - F.col("detail_count")))
