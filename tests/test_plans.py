"""Report plans on hand-made edge rows and report-level invariants."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from worklens.catalog import QUERIES
from worklens.catalog.inputs import Inputs
from worklens.context import RunContext
from worklens.plans import archive, backlog, worklist

CTX = RunContext(as_of=dt.date(2001, 7, 1), date_from=dt.date(1996, 1, 1),
                 date_to=dt.date(2001, 7, 15), po_date_after=dt.date(2001, 1, 1),
                 history_dates=(dt.date(2001, 6, 1), dt.date(2001, 7, 1)))
D0 = dt.date(2001, 7, 1)
BACKLOG_SCHEMA = ("requisition_id string, hold string, out_to_bid string, "
                  "date_of_approval date, buyer string, req_total decimal(18,2)")


def days_ago(n):
    return D0 - dt.timedelta(days=n)


@pytest.fixture()
def buyers(spark):
    return spark.createDataFrame(
        [("NINV", "n1"), ("NINV", "n2"), ("SE", "s1"), ("INV", "i1"), ("IGNORE", "x1"),
         ("SE", "idle")], "category string, buyer string")


@pytest.fixture()
def edge_backlog(spark):
    rows = [
        ("r1", "N", "Not Requested", days_ago(0), "n1", Decimal("100")),
        ("r2", "N", "Not Requested", days_ago(29), "n1", Decimal("249999.99")),
        ("r3", "N", "Not Requested", days_ago(30), "n1", None),
        ("r4", "N", "Not Requested", days_ago(95), "n2", None),        # 90+, null amount
        ("r5", "Y", "Requested", days_ago(100), "n2", Decimal("1")),   # both -> out-to-bid
        ("r6", "Y", None, days_ago(10), "s1", Decimal("1")),           # in no split
        ("r7", "Y", "Not Requested", days_ago(120), "i1", Decimal("1")),
        ("r8", "N", "Not Requested", days_ago(-1), "i1", Decimal("1")),   # negative age -> 90
        ("r14", "N", "Not Requested", days_ago(150), "i1", Decimal("-1")),  # negative amount
        ("r9", "N", "Not Requested", days_ago(200), "x1", Decimal("600000")),  # IGNORE
        ("r10", "N", "Not Requested", days_ago(5), "unknown", Decimal("1")),  # not in dim
        ("r11", "N", "Not Requested", days_ago(5), None, Decimal("1")),       # null buyer
        ("r12", "N", "Not Requested", None, "n1", Decimal("1")),              # null date
        ("r13", "N", "Not Requested", dt.date(1990, 1, 1), "n1", Decimal("1")),  # out of window
    ]
    return spark.createDataFrame(rows, BACKLOG_SCHEMA)


def test_clean_is_inner_join_in_window(edge_backlog, buyers):
    clean = backlog.clean_backlog(edge_backlog, buyers, CTX)
    ids = {r.requisition_id for r in clean.collect()}
    assert ids == {"r1", "r2", "r3", "r4", "r5", "r6", "r7", "r8", "r9", "r14"}
    cats = {r.requisition_id: (r.category, r.category_dim) for r in clean.collect()}
    assert cats["r9"] == (None, "IGNORE")


def test_status_split_is_exclusive(edge_backlog, buyers):
    split = backlog.status_split(backlog.clean_backlog(edge_backlog, buyers, CTX))
    st = {r.requisition_id: r.status for r in split.collect()}
    assert st["r5"] == "out_to_bid" and st["r6"] is None and st["r7"] == "hold"
    assert st["r1"] == "plain"


def test_age_table_edges(edge_backlog, buyers):
    split = backlog.status_split(backlog.clean_backlog(edge_backlog, buyers, CTX))
    t = {r.buyer: r.asDict() for r in backlog.age_table(split).collect()}
    assert set(t) == {"n1", "n2", "i1", "x1"}          # s1 has only an unsplit row
    assert (t["n1"]["age_0_30"], t["n1"]["age_30_60"], t["n1"]["total"]) == (2, 1, 3)
    assert (t["n2"]["age_90_plus"], t["n2"]["out_to_bid_cnt"]) == (1, 1)
    assert (t["i1"]["hold_cnt"], t["i1"]["age_90_plus"]) == (1, 2)   # negative age -> 90+
    assert t["x1"]["category"] == "IGNORE"


def test_age_report_total_includes_ignore(edge_backlog, buyers):
    split = backlog.status_split(backlog.clean_backlog(edge_backlog, buyers, CTX))
    rep = backlog.age_report(split).collect()
    total = [r for r in rep if r.row_kind == "total"][0]
    subs = {r.category: r.total for r in rep if r.row_kind == "subtotal"}
    assert "IGNORE" not in subs and total.total == sum(subs.values()) + 1
    assert all(r.category != "IGNORE" for r in rep)


def test_amount_table_null_amount_row_of_zeros(edge_backlog, buyers):
    split = backlog.status_split(backlog.clean_backlog(edge_backlog, buyers, CTX))
    t = {r.buyer: r.asDict() for r in backlog.amount_table(split, CTX).collect()}
    # n2: one plain 90+ row with null amount (no bin) and one out-to-bid row.
    assert (t["n2"]["amt_lt_250k"], t["n2"]["amt_250k_500k"], t["n2"]["amt_500k_plus"]) == (0, 0, 0)
    assert t["n2"]["total"] == 1
    assert t["i1"]["amt_500k_plus"] == 1     # negative amount -> top bin
    assert t["i1"]["total"] == 2             # r8 (age -1) is not 90+ here: filter is age >= 90


def test_status_chart_idle_buyers_null(edge_backlog, buyers):
    split = backlog.status_split(backlog.clean_backlog(edge_backlog, buyers, CTX))
    chart = backlog.status_chart(split, buyers).collect()
    idle = [r for r in chart if r.buyer_full == "idle"]
    assert len(idle) == 3 and all(r["count"] is None for r in idle)
    s1 = [r for r in chart if r.buyer_full == "s1"]
    assert all(r["count"] is None for r in s1)         # only an unsplit row: like idle
    labels = {r.type for r in chart}
    assert labels == {"Actionable", "On Hold", "Out-to-Bid"}


def test_hidden_buyers(edge_backlog, buyers):
    split = backlog.status_split(backlog.clean_backlog(edge_backlog, buyers, CTX))
    hidden = {r.buyer_full for r in backlog.hidden_buyers(backlog.age_table(split),
                                                          buyers).collect()}
    assert hidden == {"s1", "idle"}


WORKLIST_SCHEMA = ("po_no string, line int, date_time timestamp_ntz, merch_amt decimal(18,2), "
                   "tie1 long, tie2 long")


def _ts(d):
    return dt.datetime.combine(d, dt.time())


def test_prepared_worklist_dedupe_and_strict_sum(spark):
    rows = [
        ("A", 1, _ts(days_ago(3)), Decimal("10.00"), 1, 1),
        ("A", 1, _ts(days_ago(9)), Decimal("99.00"), 1, 1),   # earlier repeat of line 1 wins
        ("A", 2, _ts(days_ago(1)), Decimal("5.00"), 1, 1),
        ("B", 1, _ts(days_ago(40)), None, 1, 1),              # null amount -> null sum
        ("B", 2, _ts(days_ago(2)), Decimal("1.00"), 1, 1),
    ]
    p = {r.po_no: r for r in worklist.prepared_worklist(
        spark.createDataFrame(rows, WORKLIST_SCHEMA), CTX).collect()}
    assert p["A"].sum_of_po_amt == Decimal("104.00") and p["A"].age == 9
    assert p["B"].sum_of_po_amt is None and p["B"].age == 40
    ov = worklist.approver_overview(
        worklist.prepared_worklist(spark.createDataFrame(rows, WORKLIST_SCHEMA), CTX)).first()
    assert (ov.age_7_14, ov.age_30_plus, ov.total) == (1, 1, 2)
    assert ov.amt_lt_50k == 1                                 # B has no amount bin


def test_overview_on_empty_input_is_one_row_of_zeros(spark):
    empty = spark.createDataFrame([], WORKLIST_SCHEMA)
    rows = worklist.approver_overview(worklist.prepared_worklist(empty, CTX)).collect()
    assert len(rows) == 1 and set(rows[0].asDict().values()) == {0}


def test_detail_default_row_for_missing_lookup(spark):
    prepared = spark.createDataFrame(
        [("P1", Decimal("60000.00"), 3), ("P2", Decimal("70000.00"), 4)],
        "po_no string, sum_of_po_amt decimal(38,2), age int")
    po_docs = spark.createDataFrame(
        [("P1", [(1, (" R1 ", 1))])],
        "po_no string, lines array<struct<line_no:int, requisition:struct<req_id:string, "
        "req_line:int>>>")
    req_docs = spark.createDataFrame(
        [("R1", "2001-06-01T00:00:00Z", "07_BUYER", [("x" * 60,)])],
        "req_id string, approved_on string, buyer string, lines array<struct<more_info:string>>")
    d = {r.po_no: r for r in worklist.approver_detail(prepared, po_docs, req_docs, CTX).collect()}
    assert d["P1"].overall_age == 30 and d["P1"].line1_description == "x" * 50 + "..."
    assert d["P1"].req_buyer == "07" and d["P1"].amount == "$60,000"
    assert (d["P2"].line1_description, d["P2"].overall_age, d["P2"].req_buyer) == ("", None, "")


def test_old_trend_sum_equals_joined_form(spark, sf_small):
    i = Inputs(spark, sf_small)
    h = archive.backlog_history(i.split, i.ctx.history_dates)
    a = sorted((tuple(r) for r in archive.old_trend_sum(h, i.ctx).collect()), key=str)
    b = archive.old_trend_sum_joined(h, i.ctx)
    b = sorted((tuple(r) for r in b.select(*archive.old_trend_sum(h, i.ctx).columns).collect()),
               key=str)
    assert a == b


# --- invariants at sf0.01 -------------------------------------------------

def test_golden_age_report(spark, sf_oracle):
    if not sf_oracle.endswith("sf0.01"):
        pytest.skip("golden numbers are for sf0.01")
    rep = QUERIES["c04_age_report"](spark, sf_oracle)
    rows = {(r.row_kind, r.category): r for r in rep.collect()}
    t = rows[("total", "Total")]
    assert (t.age_0_30, t.age_30_60, t.age_60_90, t.age_90_plus, t.hold_cnt,
            t.out_to_bid_cnt) == (58, 72, 63, 3768, 1991, 1937)
    ninv = rows[("subtotal", "NINV")]
    assert (ninv.age_0_30, ninv.age_90_plus, ninv.hold_cnt) == (14, 853, 500)


def test_report_invariants(spark, sf_oracle):
    i = Inputs(spark, sf_oracle)
    t = backlog.age_table(i.split)
    parts = ["age_0_30", "age_30_60", "age_60_90", "age_90_plus", "hold_cnt", "out_to_bid_cnt"]
    bad = t.where(sum(F.col(c) for c in parts) != F.col("total")).count()
    assert bad == 0
    classified = i.split.where(F.col("status").isNotNull()).count()
    assert t.agg(F.sum("total")).first()[0] == classified
    p = i.prepared
    assert p.count() == p.select("po_no").distinct().count()


def test_repartitioned_input_changes_nothing(spark, sf_small):
    i = Inputs(spark, sf_small)
    a = sorted(tuple(r) for r in backlog.age_table(i.split).collect())
    shuffled = i.backlog_raw.repartition(7).orderBy(F.rand(seed=3))
    s2 = backlog.status_split(backlog.clean_backlog(shuffled, i.buyers, i.ctx))
    assert sorted(tuple(r) for r in backlog.age_table(s2).collect()) == a


def test_archive_rerun_is_idempotent(spark, sf_small):
    evening = dt.datetime(2001, 7, 1, 17, 30)
    n1 = QUERIES["s07_append_archive"](spark, sf_small).where(F.col("archive_time") < F.lit(evening)).count()
    n2 = QUERIES["c14_archive_snapshot"](spark, sf_small).where("kind = 'backlog'").count()
    assert n1 == n2 > 0


def test_stream_equals_batch(spark, sf_small):
    stream = QUERIES["t02_weekly_throughput_stream"](spark, sf_small)
    batch = QUERIES["c18_po_throughput"](spark, sf_small)
    s = {(r.buyer, r.week_start): r.po_cnt for r in stream.collect()}
    b = {(r.buyer_full, r.week_start): r.po_cnt for r in batch.collect()}
    assert s and s == b


def test_stream_counts_pos_that_arrive_out_of_date_order(spark):
    from worklens.session import scratch_path
    from worklens.streaming import incremental
    folder, root = scratch_path(spark, "pos"), scratch_path(spark, "t02-late")
    schema = "po_no string, po_date timestamp_ntz, buyer string, status string, n_lines bigint"
    buyers = spark.createDataFrame([("u1", "INV")], "buyer string, category string")

    def deliver(n, *dates):
        rows = [(f"{n}-{i}", _ts(d), "u1", "A", 1) for i, d in enumerate(dates)]
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/x{n}")
        s = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(folder)
        got = incremental.weekly_po_stream(spark, s, buyers, RunContext(CTX.as_of), root=root)
        return {r.week_start: r.po_cnt for r in got.collect()}

    june, january = dt.date(2001, 6, 6), dt.date(2001, 1, 10)
    assert deliver(1, june, june) == {dt.date(2001, 6, 3): 2}
    assert deliver(2, january, june) == {dt.date(2001, 6, 3): 3, dt.date(2001, 1, 7): 1}


def test_a_run_without_dates_drops_nothing(spark):
    d = dt.date(2024, 3, 1)
    ctx = RunContext(as_of=dt.date(2024, 5, 6))
    dates = spark.createDataFrame([(d,), (None,), (dt.date(1990, 1, 1),)], "d date")
    assert dates.where(backlog.in_window(F.col("d"), ctx)).count() == 2
    assert ctx.report_weeks[-1] == dt.date(2024, 5, 5)


def test_full_report_run_matches_single_queries(spark, sf_small):
    from worklens.plans import report
    from worklens.session import scratch_path
    i = Inputs(spark, sf_small)
    out, arch = scratch_path(spark, "run"), scratch_path(spark, "arch")
    paths = report.run_backlog_report(spark, i.backlog_raw, i.approver_raw, i.buyers,
                                      i.po_docs, i.req_docs, i.ctx, out, archive_root=arch)
    got = sorted(tuple(r) for r in spark.read.parquet(paths["age_report"]).collect())
    want = sorted(tuple(r) for r in QUERIES["c04_age_report"](spark, sf_small).collect())
    assert got == want
    trend = spark.read.parquet(paths["worklist_trend"]).collect()
    assert [r.archive_time for r in trend] == [i.ctx.snapshot]
    # a second run of the same snapshot leaves the archive unchanged
    report.run_backlog_report(spark, i.backlog_raw, i.approver_raw, i.buyers,
                              i.po_docs, i.req_docs, i.ctx, out, archive_root=arch)
    halves = QUERIES["c14_archive_snapshot"](spark, sf_small).groupBy("kind").count().collect()
    assert {r.kind: r["count"] for r in halves} == {
        "backlog": archive.read_backlog_archive(spark, arch).count(),
        "worklist": archive.read_worklist_archive(spark, arch).count()}
    tp = report.run_throughput_report(i.po_data, i.buyers, i.ctx, scratch_path(spark, "tp"))
    assert spark.read.parquet(tp["po_throughput_wide"]).count() == \
        QUERIES["c18_po_throughput_wide"](spark, sf_small).count()


def test_streaming_archive_rerun_does_not_replay(spark, sf_small):
    from worklens.session import scratch_path
    from worklens.sources import fixtures
    from worklens.streaming import incremental
    i = Inputs(spark, sf_small)
    root = scratch_path(spark, "t01-rerun")

    def run():
        schema = fixtures.table(spark, sf_small, "orders").schema
        stream = fixtures.backlog_raw(spark, sf_small,
                                      orders=incremental.file_stream(spark, sf_small, "orders",
                                                                     schema))
        return incremental.incremental_archive(spark, stream, i.buyers, i.ctx, root=root).count()

    first = run()
    assert first > 0 and run() == first


def test_quirk_options_default_off(spark, edge_backlog, buyers):
    split = backlog.status_split(backlog.clean_backlog(edge_backlog, buyers, CTX))
    shown_total = [r.total for r in backlog.age_report(split, total_displayed_only=True).collect()
                   if r.row_kind == "total"][0]
    all_total = [r.total for r in backlog.age_report(split).collect() if r.row_kind == "total"][0]
    assert all_total == shown_total + 1       # the IGNORE buyer's one row
    h = archive.backlog_history(split, CTX.history_dates)
    strict = archive.old_trend_sum(h, CTX).where(F.col("cnt").isNull()).count()
    filled = archive.old_trend_sum(h, CTX, zero_fill=True).where(F.col("cnt").isNull()).count()
    assert strict > 0 and filled == 0


def test_archive_write_with_salted_file_count(spark, sf_small):
    from worklens import schemas
    from worklens.session import scratch_path
    from worklens.sources import io
    i = Inputs(spark, sf_small)
    path = scratch_path(spark, "salted")
    snap = io.conform(i.split.where("status is not null").withColumn("archive_time", F.lit(D0)),
                      schemas.ARCHIVE_BACKLOG)
    io.write_archive(snap, path, files_per_partition=3)
    back = io.read_archive(spark, path, schemas.ARCHIVE_BACKLOG)
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in snap.collect())


def test_buyer_with_only_null_amounts_gets_zero_row(spark):
    buyers = spark.createDataFrame([("NINV", "n3")], "category string, buyer string")
    rows = [("a", "N", "Not Requested", days_ago(100), "n3", None),
            ("b", "N", "Not Requested", days_ago(120), "n3", None)]
    split = backlog.status_split(backlog.clean_backlog(
        spark.createDataFrame(rows, BACKLOG_SCHEMA), buyers, CTX))
    t = backlog.amount_table(split, CTX).collect()
    assert len(t) == 1
    r = t[0]
    assert (r.amt_lt_250k, r.amt_250k_500k, r.amt_500k_plus, r.hold_cnt, r.out_to_bid_cnt,
            r.total) == (0, 0, 0, 0, 0, 0)


def test_shared_prefix_buyers_stay_separate(spark):
    buyers = spark.createDataFrame([("SE", "ab_one"), ("SE", "ab_two")],
                                   "category string, buyer string")
    rows = [("a", "N", "Not Requested", days_ago(1), "ab_one", Decimal("1")),
            ("b", "N", "Not Requested", days_ago(1), "ab_two", Decimal("1"))]
    split = backlog.status_split(backlog.clean_backlog(
        spark.createDataFrame(rows, BACKLOG_SCHEMA), buyers, CTX))
    rep = [r for r in backlog.age_report(split).collect() if r.row_kind == "buyer"]
    assert sorted((r.buyer, r.buyer_full) for r in rep) == [("ab", "ab_one"), ("ab", "ab_two")]


def test_throughput_edges(spark):
    from worklens.plans import throughput
    buyers = spark.createDataFrame([("INV", "b1"), ("IGNORE", "b9")],
                                   "category string, buyer string")
    ts = lambda d: dt.datetime.combine(d, dt.time())
    rows = [
        ("p0", ts(dt.date(2001, 1, 1)), "b1", "A", 1),      # exactly at the bound: excluded
        ("p1", ts(dt.date(2001, 7, 1)), "b1", "A", 2),      # Sunday
        ("p2", ts(dt.date(2001, 7, 7)), "b1", "C", 0),      # Saturday, no lines: still a PO
        ("p3", ts(dt.date(2001, 7, 8)), "b1", "X", 5),      # status not kept
        ("p4", ts(dt.date(2001, 7, 2)), "b9", "A", 1),      # IGNORE buyer
        ("p5", ts(dt.date(2001, 7, 2)), "zz", "D", 1),      # unknown buyer
    ]
    po = spark.createDataFrame(rows, "po_no string, po_date timestamp_ntz, buyer string, "
                                     "status string, n_lines long")
    got = [(r.buyer_full, r.week_start, r.po_cnt)
           for r in throughput.po_throughput(po, buyers, CTX).collect()]
    assert got == [("b1", dt.date(2001, 7, 1), 2)]
    lines = throughput.line_throughput(po, buyers, CTX).first()
    assert lines.line_cnt == 2
    groups = {r.category: r.n_buyers for r in throughput.throughput_groups(po, buyers, CTX).collect()}
    assert groups == {"INV": 1}


def test_null_line_amount_keeps_po_out_of_detail(spark):
    rows = [("A", 1, _ts(days_ago(3)), Decimal("60000.00"), 1, 1),
            ("A", 2, _ts(days_ago(3)), None, 1, 1)]
    prepared = worklist.prepared_worklist(spark.createDataFrame(rows, WORKLIST_SCHEMA), CTX)
    empty_docs = spark.createDataFrame(
        [], "po_no string, lines array<struct<line_no:int, requisition:struct<req_id:string, "
            "req_line:int>>>")
    empty_reqs = spark.createDataFrame(
        [], "req_id string, approved_on string, buyer string, "
            "lines array<struct<more_info:string>>")
    assert worklist.approver_detail(prepared, empty_docs, empty_reqs, CTX).count() == 0
    ov = worklist.approver_overview(prepared).first()
    assert (ov.amt_lt_50k + ov.amt_50k_250k + ov.amt_250k_500k + ov.amt_500k_plus, ov.total) \
        == (0, 1)


def test_command_line_run_from_landed_extracts(spark, sf_small):
    from worklens import schemas
    from worklens.__main__ import main
    from worklens.session import scratch_path
    from worklens.sources import io
    i = Inputs(spark, sf_small)
    land = scratch_path(spark, "landing")
    io.conform(i.backlog_raw, schemas.BACKLOG).write.option("header", "true").csv(
        f"{land}/backlog.csv")
    io.conform(i.approver_raw, schemas.WORKLIST).write.parquet(f"{land}/worklist")
    i.buyers.write.option("header", "true").csv(f"{land}/buyers.csv")
    i.po_docs.write.json(f"{land}/po_docs.json")
    i.req_docs.write.json(f"{land}/req_docs.json")
    io.conform(i.po_data, schemas.PO).write.parquet(f"{land}/po")
    out = scratch_path(spark, "cli-out")
    assert main(["--as-of", "2001-07-01", "--date-from", "1996-01-01", "--date-to", "2001-07-15",
                 "--po-after", "2001-01-01", "--out", out,
                 "--backlog", f"{land}/backlog.csv", "--worklist", f"{land}/worklist",
                 "--buyers", f"{land}/buyers.csv", "--po-docs", f"{land}/po_docs.json",
                 "--req-docs", f"{land}/req_docs.json", "--po", f"{land}/po",
                 "--archive", f"{land}/archive"]) == 0
    got = sorted(tuple(r) for r in spark.read.parquet(f"{out}/backlog/age_report").collect())
    want = sorted(tuple(r) for r in QUERIES["c04_age_report"](spark, sf_small).collect())
    assert got == want
    detail = spark.read.parquet(f"{out}/backlog/approver_detail")
    assert sorted((tuple(r) for r in detail.collect()), key=str) == \
        sorted((tuple(r) for r in QUERIES["c12_approver_detail"](spark, sf_small).collect()),
               key=str)
    assert spark.read.parquet(f"{out}/throughput/po_throughput").count() == \
        QUERIES["c18_po_throughput"](spark, sf_small).count()


def test_stream_dedupe_across_extracts_keeps_relisted_old_entries(spark):
    import time as _time
    from worklens.session import scratch_path
    from worklens.streaming import incremental
    folder, root = scratch_path(spark, "extracts"), scratch_path(spark, "t03-multi")
    schema = "po_no string, line int, date_time timestamp_ntz"
    old = _ts(dt.date(1999, 1, 1))
    spark.createDataFrame([("A", 1, old), ("A", 1, old), ("B", 1, old)], schema) \
        .coalesce(1).write.parquet(f"{folder}/x1")

    def run():
        s = incremental.with_ingest_time(
            spark.readStream.schema(schema).option("recursiveFileLookup", "true")
                 .parquet(folder))
        return sorted(tuple(r) for r in incremental.dedupe_stream(spark, s, root=root).collect())

    assert run() == [("A", 1), ("B", 1)]
    _time.sleep(1.1)
    # a later extract re-lists A/1 and B/1 (old entry dates) and adds C/1
    spark.createDataFrame([("A", 1, old), ("B", 1, old), ("C", 1, old)], schema) \
        .coalesce(1).write.parquet(f"{folder}/x2")
    assert run() == [("A", 1), ("B", 1), ("C", 1)]


def test_prepared_worklist_one_shuffle_option_is_equivalent(spark, sf_small):
    i = Inputs(spark, sf_small)
    a = worklist.prepared_worklist(i.approver_raw, i.ctx)
    b = worklist.prepared_worklist(i.approver_raw, i.ctx, one_shuffle=True)

    def exchanges(df):  # inspect before executing: AQE's final plan also prints the initial one
        return df._jdf.queryExecution().executedPlan().toString().count(
            "Exchange hashpartitioning")

    assert (exchanges(a), exchanges(b)) == (2, 1)
    assert sorted((tuple(r) for r in a.collect()), key=str) == \
        sorted((tuple(r) for r in b.collect()), key=str)


def test_dimension_over_the_broadcast_limit_gives_same_result(spark, sf_small):
    import dataclasses
    i = Inputs(spark, sf_small)
    no_bcast = dataclasses.replace(i.ctx, broadcast_max_rows=0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        split = backlog.status_split(backlog.clean_backlog(i.backlog_raw, i.buyers, no_bcast))
        t = backlog.age_table(split)
        p = t._jdf.queryExecution().executedPlan().toString()
        got = sorted(tuple(r) for r in t.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in p
    assert got == sorted(tuple(r) for r in backlog.age_table(i.split).collect())


def test_sql_views(spark, sf_small):
    from worklens.catalog.views import register_views
    names = register_views(spark, sf_small)
    assert "age_report" in names
    via_sql = spark.sql("select sum(total) as t from age_table").first().t
    total = [r.total for r in QUERIES["c04_age_report"](spark, sf_small).collect()
             if r.row_kind == "total"][0]
    assert via_sql == total


def test_prepared_worklist_with_a_hot_po(spark, sf_small):
    """A third of all worklist rows belong to one PO: same answer as pandas."""
    import pandas as pd
    i = Inputs(spark, sf_small)
    hot = i.approver_raw.withColumn(
        "po_no", F.when(F.col("tie1") % 3 == 0, F.lit("HOT")).otherwise(F.col("po_no")))
    got = {r.po_no: (r.sum_of_po_amt, r.tie1, r.tie2)
           for r in worklist.prepared_worklist(hot, i.ctx).collect()}
    pdf = hot.toPandas()
    firsts = (pdf.sort_values(["date_time", "tie1", "tie2", "merch_amt"], na_position="first")
                 .groupby(["po_no", "line"], as_index=False).head(1))  # whole first rows
    want = {}
    for po, g in firsts.groupby("po_no"):
        amt = None if g["merch_amt"].isna().any() else sum(g["merch_amt"])
        head = g.sort_values("line").iloc[0]
        want[po] = (amt, int(head["tie1"]), int(head["tie2"]))
    assert sum(1 for _ in pdf.itertuples() if _.po_no == "HOT") > len(pdf) / 4
    assert got == want


def test_snapshot_rerun_replaces_the_whole_snapshot(spark, sf_small):
    from worklens import schemas
    from worklens.session import scratch_path
    from worklens.sources import io
    i = Inputs(spark, sf_small)
    path = scratch_path(spark, "rerun-status")
    snap = io.conform(i.split.where("status is not null").withColumn("archive_time", F.lit(D0)),
                      schemas.ARCHIVE_BACKLOG)
    io.write_archive(snap, path)
    io.write_archive(snap.where(F.col("status") != "hold"), path)   # corrected: no hold rows
    back = io.read_archive(spark, path, schemas.ARCHIVE_BACKLOG)
    assert back.where(F.col("status") == "hold").count() == 0
    assert back.count() == snap.where(F.col("status") != "hold").count()


def test_streams_under_cluster_settings_rocksdb_state(spark, sf_small):
    from worklens.session import apply_settings, cluster_settings
    want = sorted(tuple(r) for r in QUERIES["t03_streaming_dedupe"](spark, sf_small).collect())
    settings = cluster_settings(1 << 30, 8)
    before = {k: spark.conf.get(k, None) for k in settings}
    apply_settings(spark, settings)
    try:
        got = sorted(tuple(r) for r in QUERIES["t03_streaming_dedupe"](spark, sf_small).collect())
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert got == want


def test_publish_datasets_as_csv(spark, sf_small):
    from worklens.session import scratch_path
    from worklens.sources import io
    i = Inputs(spark, sf_small)
    rep = backlog.age_report(i.split)
    paths = io.publish_datasets({"age_report": rep}, scratch_path(spark, "csv-out"), fmt="csv")
    back = io.read_table(spark, paths["age_report"], rep.schema, fmt="csv")
    assert sorted((tuple(r) for r in back.collect()), key=str) == \
        sorted((tuple(r) for r in rep.collect()), key=str)
