"""Registered report datasets C-01 .. C-13 with their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from worklens.catalog.inputs import Inputs
from worklens.catalog.oracle import with_ctes
from worklens.catalog.registry import factor_sql, rank_sql, register
from worklens.plans import backlog, worklist

AGE_M = ["age_0_30", "age_30_60", "age_60_90", "age_90_plus", "hold_cnt",
         "out_to_bid_cnt", "total"]
AMT_M = ["amt_lt_250k", "amt_250k_500k", "amt_500k_plus", "hold_cnt",
         "out_to_bid_cnt", "total"]


def report_sql(table: str, measures: list[str]) -> str:
    plain = ", ".join(measures)
    summed = ", ".join(f"cast(sum({m}) as bigint) as {m}" for m in measures)
    return with_ctes(f"""
        select category, left(buyer, 2) as buyer, buyer as buyer_full, 'buyer' as row_kind,
               {rank_sql('category')} as category_rank, {plain}
        from {table} where category in ('NINV', 'SE', 'INV')
        union all
        select category, 'Subtotal', null, 'subtotal', {rank_sql('category')}, {summed}
        from {table} where category in ('NINV', 'SE', 'INV') group by category
        union all
        select 'Total', ' ', null, 'total', 4, {summed} from {table}""", table)


def groups_sql(table: str) -> str:
    return with_ctes(f"""
        select {factor_sql('category')} as category, {rank_sql('category')} as category_rank,
               count(*) as n_rows
        from {table} group by category""", table)


# Literal shape of the chart data: three count tables, full outer joins, NA -> 0.
CHART_COUNTS = """
    select coalesce(o.buyer, a.buyer, h.buyer) as buyer,
           coalesce(a.n, 0) as actionable_cnt, coalesce(h.n, 0) as on_hold_cnt,
           coalesce(o.n, 0) as out_to_bid_cnt
    from (select buyer, count(*) as n from {src} where out_to_bid = 'Requested' {cond}
          group by buyer) o
    full join (select buyer, count(*) as n from {src}
               where out_to_bid = 'Not Requested' and hold = 'N' {cond} group by buyer) a
         on o.buyer = a.buyer
    full join (select buyer, count(*) as n from {src}
               where hold = 'Y' and not (out_to_bid = 'Requested') {cond} group by buyer) h
         on coalesce(o.buyer, a.buyer) = h.buyer"""


def unpivot_sql(src: str, ids: str) -> str:
    parts = [f"""select {ids}, '{label}' as type, {col} as "count" from {src}"""
             for col, label in backlog.CHART_TYPES.items()]
    return "\nunion all\n".join(parts)


# --- C-01 .. C-09 ---------------------------------------------------------

@register("c01_clean_backlog", with_ctes("""
    select buyer, requisition_id, hold, out_to_bid, date_of_approval, req_total,
           category_dim, age, category from clean""", "clean"))
def c01_clean_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Inputs(spark, sf_dir).clean


@register("c02_status_split", with_ctes("""
    select buyer, requisition_id, hold, out_to_bid, date_of_approval, req_total,
           category_dim, age, category, status from split""", "split"))
def c02_status_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Inputs(spark, sf_dir).split


@register("c03_age_table", with_ctes("select * from age_table", "age_table"))
def c03_age_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backlog.age_table(Inputs(spark, sf_dir).split)


@register("c04_age_report", report_sql("age_table", AGE_M))
def c04_age_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backlog.age_report(Inputs(spark, sf_dir).split)


@register("c05_age_report_groups", groups_sql("age_table"))
def c05_age_report_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backlog.report_groups(backlog.age_table(Inputs(spark, sf_dir).split))


@register("c06_status_chart", with_ctes(
    unpivot_sql("wide", f"left(buyer, 2) as buyer, buyer as buyer_full, "
                         f"{factor_sql('category')} as category, "
                         f"{rank_sql('category')} as category_rank"),
    "clean", "buyers_cat",
    extra={"counts": CHART_COUNTS.format(src="clean", cond=""),
           "wide": """select coalesce(d.buyer, c.buyer) as buyer, d.category,
                             c.actionable_cnt, c.on_hold_cnt, c.out_to_bid_cnt
                      from buyers_cat d full join counts c on d.buyer = c.buyer"""}))
def c06_status_chart(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    return backlog.status_chart(i.split, i.buyers)


@register("c07_hidden_buyers", with_ctes("""
    select left(buyer, 2) as buyer, buyer as buyer_full from buyers_cat d
    where not exists (select 1 from age_table t where t.buyer = d.buyer)""",
    "buyers_cat", "age_table"))
def c07_hidden_buyers(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    return backlog.hidden_buyers(backlog.age_table(i.split), i.buyers)


OLD_EXTRA = {
    "old_cnt": CHART_COUNTS.format(src="clean", cond="and age >= 90"),
    "old_table": f"""select {factor_sql('d.category')} as category, c.buyer,
                            c.actionable_cnt, c.on_hold_cnt, c.out_to_bid_cnt,
                            {rank_sql('d.category')} as category_rank
                     from old_cnt c left join buyers_cat d on c.buyer = d.buyer""",
}


@register("c08_old_table", with_ctes("select * from old_table", "clean", "buyers_cat",
                                     extra=OLD_EXTRA))
def c08_old_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    return backlog.old_table(i.split, i.ctx)


@register("c08_old_chart", with_ctes(
    unpivot_sql("old_table", "left(buyer, 2) as buyer, buyer as buyer_full, category, "
                              "category_rank"),
    "clean", "buyers_cat", extra=OLD_EXTRA))
def c08_old_chart(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    return backlog.old_chart(i.split, i.ctx)


@register("c09_amount_table", with_ctes("select * from amount_table", "amount_table"))
def c09_amount_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    return backlog.amount_table(i.split, i.ctx)


@register("c09_amount_report", report_sql("amount_table", AMT_M))
def c09_amount_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    return backlog.amount_report(i.split, i.ctx)


@register("c09_amount_report_groups", groups_sql("amount_table"))
def c09_amount_report_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    return backlog.report_groups(backlog.amount_table(i.split, i.ctx))


# --- C-10 .. C-13 ---------------------------------------------------------

@register("c10_prepared_worklist", with_ctes("select * from prepared", "prepared"))
def c10_prepared_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Inputs(spark, sf_dir).prepared


def bins_sql(col: str, edges: list[int], names: list[str]) -> str:
    parts = [f"count(*) filter (where {col} >= {lo} and {col} < {hi}) as {n}"
             for lo, hi, n in zip(edges[:-1], edges[1:], names[:-1])]
    parts.append(f"count(*) filter (where not ({col} >= {edges[0]} and {col} < {edges[-1]}))"
                 f" as {names[-1]}")
    return ",\n".join(parts)


@register("c11_approver_overview", with_ctes(f"""
    select *, age_0_7 + age_7_14 + age_14_30 + age_30_plus as total from (
      select {bins_sql('age', [0, 7, 14, 30], worklist.AGE_COLS)},
             {bins_sql('sum_of_po_amt', [0, 50000, 250000, 500000], worklist.AMOUNT_COLS)}
      from prepared)""", "prepared"))
def c11_approver_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return worklist.approver_overview(Inputs(spark, sf_dir).amounts)


DETAIL_SQL = """
    select case when matched is not null
                then cast(date_diff('day', cast(try_strptime(substr(approved_on, 1, 10), '%Y-%m-%d')
                                               as date), DATE '2001-07-01') as integer) end
             as overall_age,
           po_no,
           '$' || format('{:,}', cast(round_even(cast(sum_of_po_amt as decimal(38,2)), 0)
                                      as bigint)) as amount,
           worklist_age,
           case when matched is null then ''
                when length(more_info) > 53 then substr(more_info, 1, 50) || '...'
                else more_info end as line1_description,
           case when matched is null then '' else left(rbuyer, 2) end as req_buyer
    from detail"""


@register("c12_approver_detail", with_ctes(DETAIL_SQL, "detail"))
def c12_approver_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    return worklist.approver_detail(i.amounts, i.po_docs, i.req_docs, i.ctx)


@register("c13_approver_counts", with_ctes("""
    select count(*) filter (where sum_of_po_amt >= 50000) as detail_count,
           count(*) as total_count,
           count(*) - count(*) filter (where sum_of_po_amt >= 50000) as omitted_count
    from prepared""", "prepared"))
def c13_approver_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    return worklist.approver_counts(i.amounts, i.ctx)
