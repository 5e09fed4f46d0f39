"""Registered single-operator queries (S, P, F, J, A, W, O, U, R, D rows of SURVEY §2).

Each is a thin query over the fixture views that exercises one operator on
whole tables, with an independent DuckDB oracle.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from worklens import schemas
from worklens.catalog.inputs import Inputs
from worklens.catalog.oracle import with_ctes
from worklens.catalog.registry import ORACLE, factor_sql, rank_sql, register
from worklens.catalog.reports import AGE_M, DETAIL_SQL, OLD_EXTRA, bins_sql, report_sql
from worklens.context import (
    APPROVER_AGE_EDGES, APPROVER_AMOUNT_EDGES, BACKLOG_AGE_EDGES, BACKLOG_AMOUNT_EDGES,
    BACKLOG_LEVELS,
)
from worklens.functions import columns as C
from worklens.operators import core as O
from worklens.plans import archive, backlog, throughput, worklist
from worklens.session import scratch_path
from worklens.sources import fixtures, io, snapshots
from worklens.sources.landing import REJECTS, quarantine

AS_OF = "DATE '2001-07-01'"
PO_FILTER = "po_date > TIMESTAMP '2001-01-01 00:00:00' and status in ('A', 'C', 'D')"
BACKLOG_COLS = ["requisition_id", "hold", "out_to_bid", "date_of_approval", "buyer", "req_total"]
WORKLIST_COLS = ["po_no", "line", "date_time", "merch_amt", "tie1", "tie2"]
CLEAN_SQL_COLS = ("buyer, requisition_id, hold, out_to_bid, date_of_approval, req_total, "
                  "category_dim, age, category")
FIRSTS_SQL = """
    select po_no, line, date_time, merch_amt, tie1, tie2 from (
      select *, row_number() over (partition by po_no, line
                                   order by date_time, tie1, tie2) as rn
      from approver_raw) where rn = 1"""


def _i(spark: SparkSession, sf_dir: str) -> Inputs:
    return Inputs(spark, sf_dir)


def _firsts(i: Inputs) -> DataFrame:
    return O.keep_first(i.approver_raw, ["po_no", "line"], ["date_time", "tie1", "tie2"])


def _status_wide(i: Inputs) -> DataFrame:
    """Every dimension buyer with its status counts (null for idle buyers)."""
    counts = backlog.status_counts(i.split, ["buyer"])
    return i.buyers.join(counts, "buyer", "left")


_WIDE_EXTRA = {
    "counts": """select buyer, count(*) filter (where status = 'plain') as actionable_cnt,
                        count(*) filter (where status = 'hold') as on_hold_cnt,
                        count(*) filter (where status = 'out_to_bid') as out_to_bid_cnt
                 from split where status is not null group by buyer""",
    "wide": """select coalesce(d.buyer, c.buyer) as buyer, d.category, c.actionable_cnt,
                      c.on_hold_cnt, c.out_to_bid_cnt
               from buyers_cat d full join counts c on d.buyer = c.buyer""",
}

# --- S: sources and sinks -------------------------------------------------


def _as_extract(df: DataFrame, schema, headers: dict[str, str]) -> DataFrame:
    """A table as people export it: their headers, US dates, dollars; columns in another order."""
    def shown(f):
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            return F.concat(F.lit("$"), F.format_number(c, 2))
        if isinstance(f.dataType, T.DateType):
            return F.date_format(c, "M/d/yyyy")
        if isinstance(f.dataType, T.TimestampNTZType):
            return F.date_format(c, "M/d/yyyy H:mm:ss")
        return c.cast("string")
    whole = io.conform(df, schema)
    return whole.select(*[shown(f).alias(headers.get(f.name, f.name)) for f in reversed(schema.fields)])


BACKLOG_HEADERS = {"business_unit": "Business Unit", "requisition_id": "Requisition ID",
                   "hold": "Hold From Further Processing", "date_of_approval": "Date of Approval",
                   "out_to_bid": "Out-to-Bid", "req_total": "Req Total", "buyer": "Buyer"}
WORKLIST_HEADERS = {"oper_id": "OperID", "date_time": "Date/Time", "po_no": "PO No.",
                    "merch_amt": "Merch_Amt", "line": "Line", "user": "User"}


def _landed_backlog(spark: SparkSession, sf_dir: str, name: str) -> str:
    """The backlog as a CSV extract, with copies of some rows whose date or amount is no such thing."""
    path = scratch_path(spark, name)
    rows = _as_extract(_i(spark, sf_dir).backlog_raw, schemas.BACKLOG, BACKLOG_HEADERS)
    key = F.col("Requisition ID").cast("long")
    no_date = rows.where(key % 50 == 0).withColumn("Date of Approval", F.lit("soon"))
    no_amount = rows.where(key % 60 == 0).withColumn("Req Total", F.lit("$1.2.3")).withColumn(
        "Requisition ID", F.lit(" "))
    rows.unionByName(no_date).unionByName(no_amount).write.option("header", "true").csv(path)
    return path


@register("s01_read_backlog", with_ctes(f"select {', '.join(BACKLOG_COLS)} from backlog_raw",
                                        "backlog_raw"))
def s01_read_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV extract with its own headers, formats and broken rows; every good row is read."""
    return io.read_backlog(spark, _landed_backlog(spark, sf_dir, "s01"), fmt="csv", columns=BACKLOG_COLS)


@register("k01_quarantined_rows", with_ctes("""
    select 'date_of_approval' as errors, count(*) as n from backlog_raw
    where cast(requisition_id as bigint) % 50 = 0
    union all
    select 'requisition_id is missing,req_total' as errors, count(*) as n from backlog_raw
    where cast(requisition_id as bigint) % 60 = 0""", "backlog_raw"))
def k01_quarantined_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows kept aside of that extract, by reason."""
    landed = io.land_backlog(spark, _landed_backlog(spark, sf_dir, "k01"))
    out = scratch_path(spark, "k01-aside")
    quarantine(landed, out)
    kept = spark.read.schema(REJECTS).parquet(out)
    return kept.groupBy(F.array_join("errors", ",").alias("errors")).agg(F.count(F.lit(1)).alias("n"))


@register("s02_read_worklist", with_ctes(f"select {', '.join(WORKLIST_COLS)} from approver_raw",
                                         "approver_raw"))
def s02_read_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "s02")
    rows = _as_extract(_i(spark, sf_dir).approver_raw, schemas.WORKLIST, WORKLIST_HEADERS)
    rows.write.option("header", "true").csv(path)
    return io.read_worklist(spark, path, fmt="csv", columns=WORKLIST_COLS)


@register("s03_buyer_dim", with_ctes("select category, buyer from buyers_cat", "buyers_cat"))
def s03_buyer_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = _i(spark, sf_dir)
    return O.checked_dimension(i.buyers, "buyer", i.ctx.broadcast_max_rows)


@register("s04_read_po", with_ctes(f"select po_no, po_date, buyer, n_lines from po_data "
                                   f"where {PO_FILTER}", "po_data"))
def s04_read_po(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed PO documents with their nested lines, read with predicate and field list."""
    i = _i(spark, sf_dir)
    path = scratch_path(spark, "s04")
    io.conform(fixtures.po_documents(spark, sf_dir, versions=False), schemas.PO).write.parquet(path)
    po = io.read_po(spark, path, i.ctx, ["po_no", "po_date", "buyer", "lines"])
    return po.select("po_no", "po_date", "buyer", throughput.line_count(po).alias("n_lines"))


@register("s05_read_archive", with_ctes(
    "select * from archive_backlog where archive_time >= DATE '2001-05-01'", "archive_backlog"))
def s05_read_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = _i(spark, sf_dir)
    path = scratch_path(spark, "s05")
    io.write_archive(archive.backlog_history(i.split, i.ctx.history_dates), path)
    return io.read_archive(spark, path, schemas.ARCHIVE_BACKLOG, since=dt.date(2001, 5, 1))


@register("s06_read_documents", with_ctes(
    "select req_id, approved_on, buyer, more_info from req_flat", "req_flat"))
def s06_read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requisition documents round-tripped through JSON lines, read with an explicit schema."""
    path = scratch_path(spark, "s06")
    io.write_jsonl(_i(spark, sf_dir).req_docs, path)
    docs = io.read_json_documents(spark, path, schemas.REQ_DOC)
    return docs.select("req_id", "approved_on", "buyer",
                       F.get(F.col("lines"), 0)["more_info"].alias("more_info"))


_S07_SQL = with_ctes("""
    select * from snapshot_backlog
    union all
    select * replace (TIMESTAMP '2001-07-01 17:30:00' as archive_time) from snapshot_backlog
    where status <> 'hold'""", "snapshot_backlog")


@register("s07_append_archive", _S07_SQL)
def s07_append_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of a day are two snapshots; the evening one was rerun without its hold rows."""
    i = _i(spark, sf_dir)
    root = scratch_path(spark, "s07")
    evening = replace(i.ctx, archive_time=dt.datetime(2001, 7, 1, 17, 30))
    for ctx in (i.ctx, evening):
        snapshots.write_snapshot(spark, root, ctx.snapshot,
                                 {archive.BACKLOG_TABLE: archive.backlog_snapshot(i.whole_split, ctx)})
    corrected = i.whole_split.where(F.col("status") != "hold")
    snapshots.write_snapshot(spark, root, evening.snapshot,
                             {archive.BACKLOG_TABLE: archive.backlog_snapshot(corrected, evening)})
    return archive.read_backlog_archive(spark, root)


@register("s08_write_jsonl", with_ctes(
    f"select po_no, date_time, tie1, tie2, sum_of_po_amt, age, {AS_OF} as archive_time "
    f"from prepared", "prepared"))
def s08_write_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = _i(spark, sf_dir)
    path = scratch_path(spark, "s08")
    io.write_jsonl(i.prepared.withColumn("archive_time", F.lit(i.ctx.as_of)), path)
    return io.read_json_documents(spark, path, schemas.ARCHIVE_WORKLIST)


@register("s09_publish_datasets", report_sql("age_table", AGE_M))
def s09_publish_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = _i(spark, sf_dir)
    out = scratch_path(spark, "s09")
    paths = io.publish_datasets({"age_report": backlog.age_report(i.split),
                                 "approver_overview": worklist.approver_overview(i.prepared)},
                                out)
    return spark.read.parquet(paths["age_report"])


# --- P: projections -------------------------------------------------------

@register("p01_derive_column", with_ctes(
    f"select *, cast(date_diff('day', date_of_approval, {AS_OF}) as integer) as age "
    f"from backlog_raw", "backlog_raw"))
def p01_derive_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = _i(spark, sf_dir)
    return i.backlog_raw.withColumn("age", C.age_days("date_of_approval", i.ctx.as_of))


@register("p02_transform_column", with_ctes(
    "select * replace (left(buyer, 2) as buyer) from age_table", "age_table"))
def p02_transform_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = backlog.age_table(_i(spark, sf_dir).split)
    return t.withColumn("buyer", C.abbreviate("buyer"))


@register("p03_literal_column", with_ctes(
    f"select *, {AS_OF} as archive_time from prepared", "prepared"))
def p03_literal_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = _i(spark, sf_dir)
    return i.prepared.withColumn("archive_time", F.lit(i.ctx.as_of))


@register("p04_reorder_columns", with_ctes(
    "select age, buyer, requisition_id, hold, out_to_bid, date_of_approval, req_total, "
    "category_dim, category from clean", "clean"))
def p04_reorder_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = _i(spark, sf_dir).clean
    return clean.select("age", *[c for c in clean.columns if c != "age"])


@register("p05_keep_columns", with_ctes("select po_no, sum_of_po_amt from prepared", "prepared"))
def p05_keep_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _i(spark, sf_dir).prepared.select("po_no", "sum_of_po_amt")


@register("p06_drop_columns", with_ctes(
    "select po_no, date_time, tie1, tie2 from approver_raw", "approver_raw"))
def p06_drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _i(spark, sf_dir).approver_raw.drop("line", "merch_amt")


@register("p07_rename_columns", with_ctes(
    "select po_no, date_time as worklist_time, tie1, tie2, sum_of_po_amt as amount, "
    "age as worklist_age from prepared", "prepared"))
def p07_rename_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _i(spark, sf_dir).prepared.withColumnsRenamed(
        {"date_time": "worklist_time", "sum_of_po_amt": "amount", "age": "worklist_age"})


@register("p09_source_projection", with_ctes(
    f"select po_no, buyer from po_data where {PO_FILTER}", "po_data"))
def p09_source_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = _i(spark, sf_dir)
    return io.read_po_frame(i.po_data, i.ctx, ["po_no", "buyer"])


# --- F: filters -----------------------------------------------------------

@register("f01_not_null_at", with_ctes("select * from backlog_raw where buyer is not null",
                                       "backlog_raw"))
def f01_not_null_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _i(spark, sf_dir).backlog_raw.dropna(subset=["buyer"])


@register("f02_date_window", with_ctes(
    "select * from backlog_raw where date_of_approval >= DATE '1996-01-01' "
    "and date_of_approval <= DATE '2001-07-15'", "backlog_raw"))
def f02_date_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = _i(spark, sf_dir)
    d = F.col("date_of_approval")
    return i.backlog_raw.where(backlog.in_window(d, i.ctx))


@register("f03_actionable", with_ctes(
    f"select {CLEAN_SQL_COLS} from clean where hold = 'N' and out_to_bid = 'Not Requested'",
    "clean"))
def f03_actionable(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _i(spark, sf_dir).clean
    return c.where((F.col("hold") == "N") & (F.col("out_to_bid") == "Not Requested"))


@register("f04_on_hold", with_ctes(
    f"select {CLEAN_SQL_COLS} from clean where hold = 'Y' and not (out_to_bid = 'Requested')",
    "clean"))
def f04_on_hold(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _i(spark, sf_dir).clean
    return c.where((F.col("hold") == "Y") & ~(F.col("out_to_bid") == "Requested"))


@register("f05_out_to_bid", with_ctes(
    f"select {CLEAN_SQL_COLS} from clean where out_to_bid = 'Requested'", "clean"))
def f05_out_to_bid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _i(spark, sf_dir).clean.where(F.col("out_to_bid") == "Requested")


@register("f06_min_age", with_ctes(f"select {CLEAN_SQL_COLS} from clean where age >= 90", "clean"))
def f06_min_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = _i(spark, sf_dir)
    return i.clean.where(F.col("age") >= i.ctx.min_age_days)


@register("f07_min_amount", with_ctes("select * from prepared where sum_of_po_amt >= 50000",
                                      "prepared"))
def f07_min_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = _i(spark, sf_dir)
    return i.prepared.where(F.col("sum_of_po_amt") >= F.lit(i.ctx.min_po_amount))


@register("f08_category_eq", with_ctes("select * from age_table where category = 'NINV'",
                                       "age_table"))
def f08_category_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backlog.age_table(_i(spark, sf_dir).split).where(F.col("category") == "NINV")


@register("f09_not_ignored", with_ctes(
    "select p.po_no, p.buyer, d.category from po_data p left join buyers_cat d "
    "on p.buyer = d.buyer where d.category <> 'IGNORE'", "po_data", "buyers_cat"))
def f09_not_ignored(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = _i(spark, sf_dir)
    dim = O.checked_dimension(i.buyers, "buyer", i.ctx.broadcast_max_rows)
    j = i.po_data.select("po_no", "buyer").join(dim, "buyer", "left")
    return j.where(F.col("category") != "IGNORE")


@register("f10_store_predicate", with_ctes(f"select * from po_data where {PO_FILTER}", "po_data"))
def f10_store_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = _i(spark, sf_dir)
    return i.po_data.where(io.po_predicate(i.ctx))


# --- J: joins -------------------------------------------------------------

@register("j01_dim_full_then_clean", with_ctes(f"select {CLEAN_SQL_COLS} from clean", "clean"))
def j01_dim_full_then_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference's literal form: full join, then null and window filters.

    Catalyst's outer-join elimination turns it into the same inner join as C-01.
    """
    i = _i(spark, sf_dir)
    dim = i.buyers.withColumnRenamed("category", "category_dim")
    j = (i.backlog_raw.join(dim, "buyer", "full")
           .where(F.col("buyer").isNotNull() & F.col("category_dim").isNotNull())
           .where(backlog.in_window(F.col("date_of_approval"), i.ctx)))
    return (j.withColumn("age", C.age_days("date_of_approval", i.ctx.as_of))
             .withColumn("category", C.category_in("category_dim", BACKLOG_LEVELS)))


@register("j02_full_outer_chain", with_ctes("""
    select coalesce(p.buyer, h.buyer, o.buyer) as buyer, p.n as plain_cnt, h.n as hold_cnt,
           o.n as out_to_bid_cnt
    from (select buyer, count(*) as n from split where status = 'plain' group by buyer) p
    full join (select buyer, count(*) as n from split where status = 'hold' group by buyer) h
         on p.buyer = h.buyer
    full join (select buyer, count(*) as n from split where status = 'out_to_bid'
               group by buyer) o on coalesce(p.buyer, h.buyer) = o.buyer""", "split"))
def j02_full_outer_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three per-status count tables merged by full outer joins (nulls kept)."""
    s = _i(spark, sf_dir).split

    def cnt(status: str, name: str) -> DataFrame:
        return (s.where(F.col("status") == status).groupBy("buyer")
                 .agg(F.count(F.lit(1)).alias(name)))

    return (cnt("plain", "plain_cnt").join(cnt("hold", "hold_cnt"), "buyer", "full")
            .join(cnt("out_to_bid", "out_to_bid_cnt"), "buyer", "full"))


@register("j03_dim_left", with_ctes(
    "select c.*, d.category from counts c left join buyers_cat d on c.buyer = d.buyer",
    "split", "buyers_cat", extra={"counts": _WIDE_EXTRA["counts"]}))
def j03_dim_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = _i(spark, sf_dir)
    dim = O.checked_dimension(i.buyers, "buyer", i.ctx.broadcast_max_rows)
    return backlog.status_counts(i.split, ["buyer"]).join(dim, "buyer", "left")


@register("j04_dim_full_keep_idle", with_ctes("select * from wide", "split", "buyers_cat",
                                              extra=_WIDE_EXTRA))
def j04_dim_full_keep_idle(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = _i(spark, sf_dir)
    counts = backlog.status_counts(i.split, ["buyer"])
    return i.buyers.join(counts, "buyer", "full")


@register("j05_anti", with_ctes("""
    select buyer, category from buyers_cat d
    where not exists (select 1 from age_table t where t.buyer = d.buyer)""",
    "buyers_cat", "age_table"))
def j05_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = _i(spark, sf_dir)
    active = backlog.age_table(i.split).select("buyer")
    return i.buyers.join(active, "buyer", "left_anti")


@register("j07_positional_zip", with_ctes(f"""
    select {bins_sql('age', [0, 7, 14, 30], worklist.AGE_COLS)},
           {bins_sql('sum_of_po_amt', [0, 50000, 250000, 500000], worklist.AMOUNT_COLS)}
    from prepared""", "prepared"))
def j07_positional_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Age-bin row and amount-bin row computed separately, then glued side by side."""
    p = _i(spark, sf_dir).prepared
    age_bin = C.fixed_bins("age", APPROVER_AGE_EDGES)
    amt_bin = C.fixed_bins("sum_of_po_amt", APPROVER_AMOUNT_EDGES)
    ages = p.agg(*[F.count_if(age_bin == e).alias(n)
                   for e, n in zip(APPROVER_AGE_EDGES, worklist.AGE_COLS)])
    amounts = p.agg(*[F.count_if(amt_bin == e).alias(n)
                      for e, n in zip(APPROVER_AMOUNT_EDGES, worklist.AMOUNT_COLS)])
    return O.zip_single_rows([ages, amounts])


@register("j08_document_lookup", with_ctes("""
    select q.po_no, q.req_id,
           case when r.req_id is null then '' when length(r.more_info) > 53
                then substr(r.more_info, 1, 50) || '...' else r.more_info end as line1_description,
           cast(try_strptime(substr(r.approved_on, 1, 10), '%Y-%m-%d') as date) as req_approval_date,
           case when r.req_id is null then '' else r.buyer end as req_buyer
    from (select po_no, case when n_lines > 0 then 'R' || po_no end as req_id from po_lines) q
    left join req_flat r on r.req_id = q.req_id""", "po_lines", "req_flat"))
def j08_document_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents, some of them in two versions; one row per PO."""
    i = _i(spark, sf_dir)
    found = F.col("matched").isNotNull()
    return worklist.requisition_lookup(i.po_documents, i.req_documents).select(
        "po_no", "req_id",
        F.when(found, F.col("req_description")).otherwise(F.lit("")).alias("line1_description"),
        F.when(found, F.col("req_approval_date")).alias("req_approval_date"),
        F.when(found, F.col("req_buyer")).otherwise(F.lit("")).alias("req_buyer"))


# --- A: aggregations ------------------------------------------------------

@register("a01_count_by_buyer", with_ctes(
    "select buyer, status, count(*) as n from split where status is not null "
    "group by buyer, status", "split"))
def a01_count_by_buyer(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _i(spark, sf_dir).split
    return (s.where(F.col("status").isNotNull()).groupBy("buyer", "status")
             .agg(F.count(F.lit(1)).alias("n")))


@register("a02_count_by_buyer_bin", with_ctes("""
    select buyer, case when age >= 0 and age < 30 then 0 when age >= 30 and age < 60 then 30
                       when age >= 60 and age < 90 then 60 else 90 end as bin, count(*) as n
    from split where status = 'plain' group by all""", "split"))
def a02_count_by_buyer_bin(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _i(spark, sf_dir).split.where(F.col("status") == "plain")
    return (s.withColumn("bin", C.fixed_bins("age", BACKLOG_AGE_EDGES))
             .groupBy("buyer", "bin").agg(F.count(F.lit(1)).alias("n")))


@register("a03_count_by_bin", with_ctes("""
    select case when age is null then null when age >= 0 and age < 7 then 0
                when age >= 7 and age < 14 then 7 when age >= 14 and age < 30 then 14
                else 30 end as bin, count(*) as n
    from prepared group by all""", "prepared"))
def a03_count_by_bin(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _i(spark, sf_dir).prepared
    return (p.withColumn("bin", C.fixed_bins("age", APPROVER_AGE_EDGES))
             .groupBy("bin").agg(F.count(F.lit(1)).alias("n")))


@register("a04_sum_by_po", with_ctes("""
    select po_no, case when count(*) = count(merch_amt)
                       then cast(sum(cast(merch_amt as decimal(18,2))) as double) end
                       as sum_of_po_amt
    from firsts group by po_no""", "approver_raw", extra={"firsts": FIRSTS_SQL}))
def a04_sum_by_po(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (_firsts(_i(spark, sf_dir)).groupBy("po_no")
            .agg(O.sum_strict("merch_amt").cast("decimal(38,2)").alias("sum_of_po_amt")))


_SUMS_SQL = ", ".join(f"cast(sum({m}) as bigint) as {m}" for m in AGE_M)


@register("a05_subtotal_by_category", with_ctes(
    f"select category, {_SUMS_SQL} from age_table group by category", "age_table"))
def a05_subtotal_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = backlog.age_table(_i(spark, sf_dir).split)
    return t.groupBy("category").agg(*[F.sum(m).cast("bigint").alias(m) for m in AGE_M])


@register("a06_grand_total", with_ctes(f"select {_SUMS_SQL} from age_table", "age_table"))
def a06_grand_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = backlog.age_table(_i(spark, sf_dir).split)
    return t.agg(*[F.sum(m).cast("bigint").alias(m) for m in AGE_M])


@register("a07_rows_per_category", with_ctes(
    "select category, count(*) as n_rows from age_table group by category", "age_table"))
def a07_rows_per_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = backlog.age_table(_i(spark, sf_dir).split)
    return t.groupBy("category").agg(F.count(F.lit(1)).alias("n_rows"))


@register("a08_count_by_snapshot", with_ctes(
    "select archive_time, count(*) as n from archive_backlog group by archive_time",
    "archive_backlog"))
def a08_count_by_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = _i(spark, sf_dir)
    h = archive.backlog_history(i.split, i.ctx.history_dates)
    return h.groupBy("archive_time").agg(F.count(F.lit(1)).alias("n"))


@register("a09_count_by_snapshot_category", with_ctes(
    "select archive_time, category, count(*) as n from archive_backlog "
    "where status = 'plain' and age >= 90 group by archive_time, category", "archive_backlog"))
def a09_count_by_snapshot_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = _i(spark, sf_dir)
    h = archive.backlog_history(i.split, i.ctx.history_dates)
    plain_old = h.where((F.col("status") == "plain") & (F.col("age") >= i.ctx.min_age_days))
    return plain_old.groupBy("archive_time", "category").agg(F.count(F.lit(1)).alias("n"))


def _po_weeks(i: Inputs) -> DataFrame:
    pos = io.read_po_frame(i.po_data, i.ctx, ["po_no", "po_date", "buyer", "n_lines"])
    return pos.withColumn("week_start", C.week_start_sunday("po_date"))


@register("a10_count_by_buyer_week", with_ctes(
    "select buyer, week_start, count(*) as n from po_weeks group by buyer, week_start",
    "po_weeks"))
def a10_count_by_buyer_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = _po_weeks(_i(spark, sf_dir))
    return w.groupBy("buyer", "week_start").agg(F.count(F.lit(1)).alias("n"))


@register("a11_sum_lines_by_buyer_week", with_ctes(
    "select buyer, week_start, cast(sum(n_lines) as bigint) as line_cnt from po_weeks "
    "group by buyer, week_start", "po_weeks"))
def a11_sum_lines_by_buyer_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = _po_weeks(_i(spark, sf_dir))
    return w.groupBy("buyer", "week_start").agg(F.sum("n_lines").cast("bigint").alias("line_cnt"))


@register("a12_global_count", with_ctes("select count(*) as n from prepared", "prepared"))
def a12_global_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _i(spark, sf_dir).prepared.agg(F.count(F.lit(1)).alias("n"))


@register("a13_distinct_keep_first", with_ctes("select * from firsts", "approver_raw",
                                               extra={"firsts": FIRSTS_SQL}))
def a13_distinct_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _firsts(_i(spark, sf_dir))


@register("a14_distinct_values", with_ctes("select distinct buyer from po_weeks", "po_weeks"))
def a14_distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _po_weeks(_i(spark, sf_dir)).select("buyer").distinct()


# --- W: windows -----------------------------------------------------------

@register("w01_partition_sum", with_ctes("""
    select f.*, s.sum_of_po_amt from firsts f join (
      select po_no, case when count(*) = count(merch_amt)
                         then cast(sum(cast(merch_amt as decimal(18,2))) as double) end
                         as sum_of_po_amt
      from firsts group by po_no) s on f.po_no = s.po_no""",
    "approver_raw", extra={"firsts": FIRSTS_SQL}))
def w01_partition_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _firsts(_i(spark, sf_dir))
    out = O.attach_group_total(f, ["po_no"], "merch_amt", "sum_of_po_amt")
    return out.withColumn("sum_of_po_amt", F.col("sum_of_po_amt").cast("decimal(38,2)"))


@register("w02_running_sum", with_ctes(f"""
    select category, {rank_sql('category')} as category_rank, count(*) as n_rows,
           cast(sum(count(*) + 1) over (order by {rank_sql('category')}
                rows between unbounded preceding and current row) as bigint) as last_row
    from age_table where category in ('NINV', 'SE', 'INV') group by category""", "age_table"))
def w02_running_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index of each displayed category's subtotal row (detail rows + 1, cumulated)."""
    g = backlog.report_groups(backlog.age_table(_i(spark, sf_dir).split))
    shown = g.where(F.col("category").isNotNull()).withColumn("rows", F.col("n_rows") + 1)
    return O.running_total(shown, "category_rank", "rows", "last_row").drop("rows")


# --- O: sorts -------------------------------------------------------------

@register("o01_sort_category_alpha", with_ctes("select * from age_table", "age_table"))
def o01_sort_category_alpha(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backlog.age_table(_i(spark, sf_dir).split).orderBy("category", "buyer")


@register("o02_sort_category_rank", with_ctes("select * from old_table", "clean", "buyers_cat",
                                              extra=OLD_EXTRA))
def o02_sort_category_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = _i(spark, sf_dir)
    t = backlog.old_table(i.split, i.ctx)
    return t.orderBy(F.col("category_rank").asc_nulls_last(), "buyer")


@register("o03_sort_buyer_desc", ORACLE["c06_status_chart"])
def o03_sort_buyer_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = _i(spark, sf_dir)
    chart = backlog.status_chart(i.split, i.buyers)
    return chart.orderBy(F.col("category_rank").asc_nulls_last(), F.col("buyer_full").desc())


@register("o04_sort_age_desc", with_ctes(DETAIL_SQL, "detail"))
def o04_sort_age_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = _i(spark, sf_dir)
    d = worklist.approver_detail(i.prepared, i.po_docs, i.req_docs, i.ctx)
    return d.orderBy(F.col("overall_age").desc_nulls_last(), "po_no")


_VERSIONS_SQL = """
    select po_no, {before} from po_lines where cast(po_no as bigint) % 11 = 0"""


@register("o05_first_element", with_ctes(
    "select po_no, case when n_lines > 0 then concat(' R', po_no, ' ') end as req_id_raw from po_lines"
    " union all" + _VERSIONS_SQL.format(before="case when n_lines > 0 then 'R-before' end"), "po_lines"))
def o05_first_element(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first of any number of lines, in every version of the documents."""
    d = _i(spark, sf_dir).po_documents
    return d.select("po_no", F.get(F.col("lines")["requisition"]["req_id"], 0).alias("req_id_raw"))


# --- U / R: set ops and reshaping -----------------------------------------

@register("u01_union_all", report_sql("age_table", AGE_M))
def u01_union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report stacked the reference's way: detail, subtotal and total frames unioned."""
    t = backlog.age_table(_i(spark, sf_dir).split)
    shown = t.where(F.col("category").isin(*BACKLOG_LEVELS))
    sums = [F.sum(m).cast("bigint").alias(m) for m in AGE_M]
    detail = shown.select("category", C.abbreviate("buyer").alias("buyer"),
                          F.col("buyer").alias("buyer_full"),
                          F.lit("buyer").alias("row_kind"), *AGE_M)
    sub = (shown.groupBy("category").agg(*sums)
                .withColumns({"buyer": F.lit("Subtotal"), "row_kind": F.lit("subtotal")}))
    total = t.agg(*sums).withColumns({"category": F.lit("Total"), "buyer": F.lit(" "),
                                      "row_kind": F.lit("total")})
    out = O.union_all([detail, sub, total])
    return out.withColumn("category_rank",
                          C.category_rank("category", (*BACKLOG_LEVELS, "Total")))


def _plain_bins(i: Inputs) -> DataFrame:
    s = i.split.where(F.col("status") == "plain")
    return s.withColumn("bin", C.fixed_bins("age", BACKLOG_AGE_EDGES))


_BIN_NAMES = {"0": "age_0_30", "30": "age_30_60", "60": "age_60_90", "90": "age_90_plus"}
_PIVOT_SQL = """
    select buyer, {0}(count(*) filter (where bin = 0){1}) as age_0_30,
           {0}(count(*) filter (where bin = 30){1}) as age_30_60,
           {0}(count(*) filter (where bin = 60){1}) as age_60_90,
           {0}(count(*) filter (where bin = 90){1}) as age_90_plus
    from (select buyer, case when age >= 0 and age < 30 then 0 when age >= 30 and age < 60 then 30
                             when age >= 60 and age < 90 then 60 else 90 end as bin
          from split where status = 'plain') group by buyer"""


@register("r01_pivot", with_ctes(_PIVOT_SQL.format("nullif", ", 0"), "split"))
def r01_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``groupBy.pivot`` with an explicit value list; absent bins are null."""
    p = (_plain_bins(_i(spark, sf_dir)).groupBy("buyer")
         .pivot("bin", list(BACKLOG_AGE_EDGES)).count())
    return p.withColumnsRenamed(_BIN_NAMES)


@register("r02_pad_columns", with_ctes(_PIVOT_SQL.format("", ""), "split"))
def r02_pad_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every bin column present, zero when empty (the pivot + pad of the reference)."""
    p = (_plain_bins(_i(spark, sf_dir)).groupBy("buyer")
         .pivot("bin", list(BACKLOG_AGE_EDGES)).count())
    return p.withColumnsRenamed(_BIN_NAMES).fillna(0, subset=list(_BIN_NAMES.values()))


def _unpivot_wide_sql() -> str:
    parts = [f"""select buyer, category, '{label}' as type, {col} as "count" from wide"""
             for col, label in backlog.CHART_TYPES.items()]
    return with_ctes("\nunion all\n".join(parts), "split", "buyers_cat", extra=_WIDE_EXTRA)


@register("r03_unpivot", _unpivot_wide_sql())
def r03_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.unpivot_counts(_status_wide(_i(spark, sf_dir)), ["buyer", "category"],
                            backlog.CHART_TYPES, "type", "count")


# --- D: scalar functions --------------------------------------------------

@register("d01_to_date", with_ctes(
    "select po_no, line, tie1, tie2, cast(date_time as date) as d from approver_raw",
    "approver_raw"))
def d01_to_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _i(spark, sf_dir).approver_raw
    return a.select("po_no", "line", "tie1", "tie2", C.to_date("date_time").alias("d"))


@register("d02_age_days", with_ctes(
    f"select po_no, line, tie1, tie2, "
    f"cast(date_diff('day', cast(date_time as date), {AS_OF}) as integer) as age "
    f"from approver_raw", "approver_raw"))
def d02_age_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = _i(spark, sf_dir)
    return i.approver_raw.select("po_no", "line", "tie1", "tie2",
                                 C.age_days("date_time", i.ctx.as_of).alias("age"))


@register("d04_parse_date", with_ctes(
    "select req_id, cast(try_strptime(substr(approved_on, 1, 10), '%Y-%m-%d') as date) as d "
    "from req_flat", "req_flat"))
def d04_parse_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _i(spark, sf_dir).req_docs
    return r.select("req_id", C.parse_date("approved_on").alias("d"))


_FY_SQL = ("case when month(date_of_approval) < 7 then year(date_of_approval) "
           "else year(date_of_approval) + 1 end")


@register("d05_fiscal_year", with_ctes(
    f"select requisition_id, cast({_FY_SQL} as integer) as fy from backlog_raw", "backlog_raw"))
def d05_fiscal_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _i(spark, sf_dir).backlog_raw
    return b.select("requisition_id", C.fiscal_year("date_of_approval").alias("fy"))


@register("d06_is_current_fy", with_ctes(
    f"select requisition_id, {_FY_SQL} = 2002 as is_current_fy from backlog_raw", "backlog_raw"))
def d06_is_current_fy(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = _i(spark, sf_dir)
    return i.backlog_raw.select(
        "requisition_id", C.is_current_fy("date_of_approval", i.ctx.as_of).alias("is_current_fy"))


@register("d07_is_given_fy", with_ctes(
    f"select requisition_id, {_FY_SQL} = 2000 as is_fy2000 from backlog_raw", "backlog_raw"))
def d07_is_given_fy(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _i(spark, sf_dir).backlog_raw
    return b.select("requisition_id", C.is_given_fy("date_of_approval", 2000).alias("is_fy2000"))


@register("d08_week_start_sunday", with_ctes("""
    select po_no, cast(po_date as date) - cast(dayofweek(cast(po_date as date)) as integer)
           as week_start from po_data""", "po_data"))
def d08_week_start_sunday(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _i(spark, sf_dir).po_data
    return p.select("po_no", C.week_start_sunday("po_date").alias("week_start"))


@register("d09_format_week", with_ctes("""
    select po_no, strftime(cast(po_date as date)
                           - cast(dayofweek(cast(po_date as date)) as integer), '%m/%d')
           as week_label from po_data""", "po_data"))
def d09_format_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _i(spark, sf_dir).po_data
    return p.select("po_no", C.format_week(C.week_start_sunday("po_date")).alias("week_label"))


@register("d10_abbreviate", with_ctes(
    "select buyer, left(buyer, 2) as buyer_abbr from buyers_cat", "buyers_cat"))
def d10_abbreviate(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _i(spark, sf_dir).buyers
    return b.select("buyer", C.abbreviate("buyer").alias("buyer_abbr"))


@register("d11_truncate_ellipsis", with_ctes("""
    select req_id, case when length(more_info) > 53 then substr(more_info, 1, 50) || '...'
                        else more_info end as description
    from req_flat""", "req_flat"))
def d11_truncate_ellipsis(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _i(spark, sf_dir).req_docs
    text = F.get(F.col("lines"), 0)["more_info"]
    return r.select("req_id", C.truncate_ellipsis(text).alias("description"))


@register("d12_trim", with_ctes("select po_no, req_id from po_req", "po_req"))
def d12_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _i(spark, sf_dir).po_docs
    return d.select("po_no", C.trim(F.get(F.col("lines"), 0)["requisition"]["req_id"])
                    .alias("req_id"))


@register("d13_concat_text", with_ctes("""
    select string_agg(left(buyer, 2), ', ' order by left(buyer, 2)) as hidden_buyers
    from buyers_cat d where not exists (select 1 from age_table t where t.buyer = d.buyer)""",
    "buyers_cat", "age_table"))
def d13_concat_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hidden-buyer sentence: a subset of the (size-checked) dimension, so bounded."""
    i = _i(spark, sf_dir)
    hidden = backlog.hidden_buyers(backlog.age_table(i.split), i.buyers)
    return hidden.agg(C.sorted_list_text("buyer").alias("hidden_buyers"))


@register("d14_usd_format", with_ctes(
    "select po_no, '$' || format('{:,}', cast(round_even(cast(sum_of_po_amt as decimal(38,2)), 0) "
    "as bigint)) as amount "
    "from prepared", "prepared"))
def d14_usd_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _i(spark, sf_dir).prepared
    return p.select("po_no", C.usd("sum_of_po_amt").alias("amount"))


@register("d15_null_to_zero", with_ctes(
    "select buyer, category, coalesce(actionable_cnt, 0) as actionable_cnt, "
    "coalesce(on_hold_cnt, 0) as on_hold_cnt, coalesce(out_to_bid_cnt, 0) as out_to_bid_cnt "
    "from wide", "split", "buyers_cat", extra=_WIDE_EXTRA))
def d15_null_to_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = _status_wide(_i(spark, sf_dir))
    return w.fillna(0, subset=list(backlog.CHART_TYPES))


@register("d16_null_to_zero_one", f"select * exclude (cnt) from ({ORACLE['c17_old_trend_sum']})")
def d16_null_to_zero_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = _i(spark, sf_dir)
    h = archive.backlog_history(i.split, i.ctx.history_dates)
    return archive.old_trend_sum_joined(h, i.ctx).drop("cnt")


@register("d17_row_sum", with_ctes(
    "select buyer, actionable_cnt + on_hold_cnt + out_to_bid_cnt as total from wide",
    "split", "buyers_cat", extra=_WIDE_EXTRA))
def d17_row_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null-propagating row sum: idle buyers (null counts) get a null total."""
    w = _status_wide(_i(spark, sf_dir))
    return w.select("buyer", C.row_sum(list(backlog.CHART_TYPES)).alias("total"))


@register("d18_bin_age", with_ctes("""
    select requisition_id, age, case when age >= 0 and age < 30 then 0
        when age >= 30 and age < 60 then 30 when age >= 60 and age < 90 then 60
        else 90 end as bin from clean""", "clean"))
def d18_bin_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _i(spark, sf_dir).clean
    return c.select("requisition_id", "age", C.fixed_bins("age", BACKLOG_AGE_EDGES).alias("bin"))


@register("d18_bin_amount", with_ctes("""
    select requisition_id, req_total, case when req_total is null then null
        when req_total >= 0 and req_total < 250000 then 0
        when req_total >= 250000 and req_total < 500000 then 250000 else 500000 end as bin
    from clean""", "clean"))
def d18_bin_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _i(spark, sf_dir).clean
    return c.select("requisition_id", "req_total",
                    C.fixed_bins("req_total", BACKLOG_AMOUNT_EDGES).alias("bin"))


@register("d18_approver_bin_age", with_ctes("""
    select po_no, age, case when age is null then null when age >= 0 and age < 7 then 0
        when age >= 7 and age < 14 then 7 when age >= 14 and age < 30 then 14 else 30 end as bin
    from prepared""", "prepared"))
def d18_approver_bin_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _i(spark, sf_dir).prepared
    return p.select("po_no", "age", C.fixed_bins("age", APPROVER_AGE_EDGES).alias("bin"))


@register("d18_approver_bin_amount", with_ctes("""
    select po_no, sum_of_po_amt, case when sum_of_po_amt is null then null
        when sum_of_po_amt >= 0 and sum_of_po_amt < 50000 then 0
        when sum_of_po_amt >= 50000 and sum_of_po_amt < 250000 then 50000
        when sum_of_po_amt >= 250000 and sum_of_po_amt < 500000 then 250000
        else 500000 end as bin
    from prepared""", "prepared"))
def d18_approver_bin_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _i(spark, sf_dir).prepared
    return p.select("po_no", "sum_of_po_amt",
                    C.fixed_bins("sum_of_po_amt", APPROVER_AMOUNT_EDGES).alias("bin"))


@register("d20_ordered_category", with_ctes(
    f"select buyer, {factor_sql('category')} as category, "
    f"{rank_sql('category')} as category_rank from buyers_cat", "buyers_cat"))
def d20_ordered_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _i(spark, sf_dir).buyers
    return b.select("buyer", C.category_in("category", BACKLOG_LEVELS).alias("category"),
                    C.category_rank("category", BACKLOG_LEVELS).alias("category_rank"))


@register("d22_array_length", with_ctes(
    "select po_no, n_lines from po_lines union all"
    + _VERSIONS_SQL.format(before="least(n_lines, 1)"), "po_lines"))
def d22_array_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of no, one and many lines."""
    d = _i(spark, sf_dir).po_documents
    return d.select("po_no", C.array_length(F.col("lines")["line_no"]).cast("bigint").alias("n_lines"))


@register("d23_json_path", with_ctes(
    "select po_no, case when n_lines > 0 then concat(' R', po_no, ' ') end as req_id_raw, "
    "first_line as req_line, n_lines from po_lines union all"
    + _VERSIONS_SQL.format(before="case when n_lines > 0 then 'R-before' end, "
                                  "case when n_lines > 0 then 0 end, least(n_lines, 1)"), "po_lines"))
def d23_json_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested fields by name (independent of field order in the document), from JSON lines."""
    path = scratch_path(spark, "d23")
    io.write_jsonl(_i(spark, sf_dir).po_documents.select("po_no", "lines"), path)
    d = io.read_json_documents(spark, path, schemas.PO_DOC)
    first = F.get(F.col("lines"), 0)
    return d.select("po_no", first["requisition"]["req_id"].alias("req_id_raw"),
                    first["requisition"]["req_line"].alias("req_line"),
                    F.size("lines").cast("bigint").alias("n_lines"))


@register("d24_json_parse", with_ctes(
    "select req_id, approved_on, buyer, more_info from req_flat", "req_flat"))
def d24_json_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents held as JSON text, parsed with an explicit schema."""
    r = _i(spark, sf_dir).req_docs
    raw = r.select(F.to_json(F.struct(*r.columns)).alias("json"))
    doc = io.parse_json_column(raw, "json", schemas.REQ_DOC).select("doc.*")
    return doc.select("req_id", "approved_on", "buyer",
                      F.get(F.col("lines"), 0)["more_info"].alias("more_info"))
