"""Registered archive, trend, throughput and streaming datasets (C-14 .. C-20, T-01 .. T-03)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from worklens import schemas
from worklens.catalog.inputs import Inputs
from worklens.catalog.oracle import with_ctes
from worklens.catalog.registry import ORACLE, register
from worklens.catalog.run import FIXTURE
from worklens.plans import archive, throughput
from worklens.session import scratch_path
from worklens.sources import fixtures
from worklens.sources.io import conform, materialize
from worklens.sources.snapshots import write_snapshot
from worklens.streaming import incremental

THROUGHPUT_RANK = "case {c} when 'INV' then 1 when 'NINV' then 2 when 'SE' then 3 end"


def _history(i: Inputs) -> DataFrame:
    return archive.backlog_history(i.split, i.ctx.history_dates)


def _worklist_history(i: Inputs) -> DataFrame:
    return archive.worklist_history(i.prepared, i.ctx.history_dates)


# --- C-14 .. C-17 ---------------------------------------------------------

@register("c14_archive_snapshot", with_ctes("""
    select 'backlog' as kind, * from snapshot_backlog
    union all by name
    select 'worklist' as kind, * from snapshot_worklist""", "snapshot_backlog", "snapshot_worklist"))
def c14_archive_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commit this run's snapshot, then read both halves of the archive back."""
    i = Inputs(spark, sf_dir)
    root = scratch_path(spark, "c14")
    archive.archive_snapshot(spark, i.whole_split, i.whole_prepared, i.ctx, root)
    return (archive.read_backlog_archive(spark, root).withColumn("kind", F.lit("backlog"))
            .unionByName(archive.read_worklist_archive(spark, root).withColumn("kind", F.lit("worklist")),
                         allowMissingColumns=True))


@register("c15_worklist_trend", with_ctes("""
    select archive_time, count(*) as cnt from archive_worklist
    where sum_of_po_amt >= 50000 group by archive_time""", "archive_worklist"))
def c15_worklist_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    return archive.worklist_trend(archive.worklist_history(i.amounts, i.ctx.history_dates), i.ctx)


@register("c16_status_trend", with_ctes("""
    select status, 'all' as scope, archive_time, category, count(*) as cnt
    from archive_backlog group by status, archive_time, category
    union all
    select status, '90plus' as scope, archive_time, category, count(*) as cnt
    from archive_backlog where age >= 90 group by status, archive_time, category""",
    "archive_backlog"))
def c16_status_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    return archive.status_trend(_history(i), i.ctx)


_OLD_TREND_SQL = with_ctes("""
    select case when p.archive_time is not null then p.archive_time
                when h.archive_time is not null then h.archive_time
                else o.archive_time end as archive_time,
           case when p.archive_time is not null then p.category
                when h.archive_time is not null then h.category
                else o.category end as category,
           p.n as plain_cnt, coalesce(h.n, 0) as hold_cnt, o.n as out_to_bid_cnt,
           p.n + coalesce(h.n, 0) + o.n as cnt
    from (select archive_time, category, count(*) as n from archive_backlog
          where age >= 90 and status = 'plain' group by archive_time, category) p
    full join (select archive_time, category, count(*) as n from archive_backlog
               where age >= 90 and status = 'hold' group by archive_time, category) h
         on p.archive_time = h.archive_time and p.category is not distinct from h.category
    full join (select archive_time, category, count(*) as n from archive_backlog
               where age >= 90 and status = 'out_to_bid' group by archive_time, category) o
         on coalesce(p.archive_time, h.archive_time) = o.archive_time
        and (case when p.archive_time is not null then p.category else h.category end)
            is not distinct from o.category""", "archive_backlog")


@register("c17_old_trend_sum", _OLD_TREND_SQL)
def c17_old_trend_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    return archive.old_trend_sum(_history(i), i.ctx)


@register("j06_natural_full_null_safe", _OLD_TREND_SQL)
def j06_natural_full_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    return archive.old_trend_sum_joined(_history(i), i.ctx)


# --- The same trends kept up by runs: three snapshots, a run, one more, a run ---

_KEPT_SQL = "(select * replace (cast(archive_time as timestamp) as archive_time) from {t})"


def _kept_up(spark: SparkSession, sf_dir: str, kept):
    """Archive the history one instant at a time, refreshing before and after the last.

    The rows that the snapshots replay are computed once, not per instant.
    """
    i = Inputs(spark, sf_dir)
    root = scratch_path(spark, "kept-trends")
    dates = i.ctx.history_dates
    backlog = archive.backlog_history(materialize(i.split, "kept-split"), dates)
    work = archive.worklist_history(materialize(i.prepared, "kept-prepared"), dates)
    for n, d in enumerate(i.ctx.history_dates):
        if n + 1 == len(i.ctx.history_dates):
            kept(spark, root, i.ctx)
        tables = {archive.BACKLOG_TABLE: backlog, archive.WORKLIST_TABLE: work}
        write_snapshot(spark, root, d, {k: t.where(F.col("archive_time") == F.lit(d))
                                        for k, t in tables.items()})
    return kept(spark, root, i.ctx)


def _register_kept(key: str, of: str, table: str, kept) -> None:
    sql = ORACLE[of].replace(f"from {table}", "from " + _KEPT_SQL.format(t=table))

    @register(key, sql)
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _kept_up(spark, sf_dir, kept)


_register_kept("k15_worklist_trend_kept", "c15_worklist_trend", "archive_worklist",
               archive.worklist_trend_incremental)
_register_kept("k16_status_trend_kept", "c16_status_trend", "archive_backlog",
               archive.status_trend_incremental)
_register_kept("k17_old_trend_sum_kept", "c17_old_trend_sum", "archive_backlog",
               archive.old_trend_sum_incremental)


@register("k08_count_by_snapshot_kept", with_ctes(
    "select cast(archive_time as timestamp) as archive_time, category, count(*) as n "
    "from archive_backlog group by archive_time, category", "archive_backlog"))
def k08_count_by_snapshot_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kept_up(spark, sf_dir, lambda s, root, ctx: archive.snapshot_counts_incremental(
        s, root, ctx, "category"))


# --- C-18 .. C-20 ---------------------------------------------------------

def _weekly_sql(measure_sql: str, measure: str) -> str:
    return with_ctes(f"""
        select c.category, {THROUGHPUT_RANK.format(c='c.category')} as category_rank,
               left(w.buyer, 2) as buyer, w.buyer as buyer_full, w.week_start,
               strftime(w.week_start, '%m/%d') as week_label, {measure_sql} as {measure}
        from po_weeks w join buyers_cat c on w.buyer = c.buyer
        where c.category <> 'IGNORE'
        group by c.category, w.buyer, w.week_start""", "po_weeks", "buyers_cat")


@register("c18_po_throughput", _weekly_sql("count(*)", "po_cnt"))
def c18_po_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    return throughput.po_throughput(i.po_data, i.buyers, i.ctx)


@register("c19_line_throughput", _weekly_sql("cast(sum(n_lines) as bigint)", "line_cnt"))
def c19_line_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    return throughput.line_throughput(i.po_data, i.buyers, i.ctx)


@register("k19_line_throughput_nested", _weekly_sql("cast(sum(n_lines) as bigint)", "line_cnt"))
def k19_line_throughput_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C-19 from landed PO documents with nested lines."""
    i = Inputs(spark, sf_dir)
    path = scratch_path(spark, "k19")
    docs = fixtures.po_documents(spark, sf_dir, versions=False)
    conform(docs, schemas.PO).write.parquet(path)
    return throughput.line_throughput(spark.read.schema(schemas.PO).parquet(path), i.buyers, i.ctx)


@register("c20_throughput_groups", with_ctes(f"""
    select c.category, count(*) as n_buyers,
           {THROUGHPUT_RANK.format(c='c.category')} as category_rank
    from (select distinct buyer from po_weeks) b join buyers_cat c on b.buyer = c.buyer
    where c.category <> 'IGNORE' group by c.category""", "po_weeks", "buyers_cat"))
def c20_throughput_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    return throughput.throughput_groups(i.po_data, i.buyers, i.ctx)


def _wide_sql(agg_sql: str) -> str:
    weeks = ", ".join(f"coalesce(cast({agg_sql} filter (week_start = date '{w}') as bigint), 0)"
                      f" as {throughput.week_column(w)}" for w in FIXTURE.report_weeks)
    return with_ctes(f"""
        select c.category, {THROUGHPUT_RANK.format(c='c.category')} as category_rank,
               left(p.buyer, 2) as buyer_abbr, p.buyer as buyer_full, p.* exclude (buyer)
        from (select buyer, {weeks} from po_weeks group by buyer) p
        join buyers_cat c on p.buyer = c.buyer
        where c.category <> 'IGNORE'""", "po_weeks", "buyers_cat")


@register("c18_po_throughput_wide", _wide_sql("count(*)"))
def c18_po_throughput_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    w = throughput.po_throughput_wide(i.po_data, i.buyers, i.ctx)
    return w.withColumnRenamed("buyer", "buyer_abbr")


@register("c19_line_throughput_wide", _wide_sql("sum(n_lines)"))
def c19_line_throughput_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    w = throughput.line_throughput_wide(i.po_data, i.buyers, i.ctx)
    return w.withColumnRenamed("buyer", "buyer_abbr")


# --- T-01 .. T-03 ---------------------------------------------------------

def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = fixtures.table(spark, sf_dir, name).schema
    return incremental.file_stream(spark, sf_dir, name, schema)


@register("t01_incremental_archive", with_ctes("select * from snapshot_backlog",
                                               "snapshot_backlog"))
def t01_incremental_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    orders = incremental.with_source_file(_stream(spark, sf_dir, "orders"))
    stream = fixtures.backlog_raw(spark, sf_dir, orders=orders, keep=("source_file",), whole=True)
    return incremental.incremental_archive(spark, stream, i.buyers, i.ctx)


@register("t02_weekly_throughput_stream", with_ctes("""
    select c.category, w.buyer, w.week_start, count(*) as po_cnt
    from po_weeks w join buyers_cat c on w.buyer = c.buyer
    where c.category <> 'IGNORE'
    group by c.category, w.buyer, w.week_start""", "po_weeks", "buyers_cat"))
def t02_weekly_throughput_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    stream = fixtures.po_data(spark, sf_dir, orders=_stream(spark, sf_dir, "orders"))
    return incremental.weekly_po_stream(spark, stream, i.buyers, i.ctx)


@register("t03_streaming_dedupe", with_ctes("select distinct po_no, line from approver_raw",
                                            "approver_raw"))
def t03_streaming_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = fixtures.approver_raw(spark, sf_dir, lineitem=_stream(spark, sf_dir, "lineitem"))
    return incremental.dedupe_stream(spark, stream)
