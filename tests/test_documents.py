"""Nested documents (no, one and many lines, several versions) and keep-first over whole extracts."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from worklens import schemas
from worklens.catalog import QUERIES
from worklens.catalog.inputs import Inputs
from worklens.context import RunContext
from worklens.operators import core
from worklens.plans import throughput, worklist
from worklens.session import scratch_path
from worklens.sources import fixtures, io

CTX = RunContext(as_of=dt.date(2001, 7, 1))
T1, T2 = dt.datetime(2001, 6, 1), dt.datetime(2001, 6, 2)


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def po_docs(spark, *rows):
    return spark.createDataFrame(
        [(po, [(n, (req, n)) for n, req in lines] if lines is not None else None, at) for po, lines, at in rows],
        schemas.PO_DOC)


def req_docs(spark, *rows):
    return spark.createDataFrame(
        [(req, "2001-05-01T00:00:00Z", buyer, [(text,) for text in lines], at) for req, buyer, lines, at in rows],
        schemas.REQ_DOC)


def test_the_last_document_of_each_key_counts(spark):
    pos = po_docs(spark, ("p1", [(1, " R1 "), (2, "R9")], T2), ("p1", [(1, "R2")], T1), ("p1", [(1, "R3")], None),
                  ("p2", [], T1), ("p3", None, T1), ("p4", [(1, "R2")], T1), ("p4", [(1, "R2")], T1),
                  ("p5", [(1, "gone")], T1))
    reqs = req_docs(spark, ("R1", "b1", ["last", "second line"], T2), ("R1", "b0", ["before"], T1),
                    ("R2", "b2", ["two"], None), ("R2", "b2", ["two"], None))
    got = {r.po_no: (r.req_id, r.req_description, r.req_buyer) for r in
           worklist.requisition_lookup(pos, reqs).collect()}
    assert worklist.requisition_lookup(pos, reqs).count() == 5
    assert got == {"p1": ("R1", "last", "b1"), "p2": (None, None, None), "p3": (None, None, None),
                   "p4": ("R2", "two", "b2"), "p5": ("gone", None, None)}
    # documents without a version column: still one row per PO
    assert worklist.requisition_lookup(pos.drop("updated_at"), reqs.drop("updated_at")).count() == 5


def test_detail_has_as_many_rows_as_counts_say(spark, sf_small):
    i = Inputs(spark, sf_small)
    detail = worklist.approver_detail(i.amounts, i.po_documents, i.req_documents, i.ctx)
    assert i.po_documents.count() > i.po_documents.select("po_no").distinct().count()
    assert detail.count() == worklist.approver_counts(i.amounts, i.ctx).first().detail_count
    same = worklist.approver_detail(i.prepared, i.po_docs, i.req_docs, i.ctx)
    key = [F.col(c) for c in ("po_no", "amount", "worklist_age")]
    assert detail.select(*key).exceptAll(same.select(*key)).isEmpty()


def test_line_counts_of_nested_and_normalised_pos(spark, tmp_path):
    day = dt.datetime(2001, 6, 6)
    rows = [("p1", day, "n1", "A", None, [(1, ("a", 1)), (2, ("b", 1)), (2, ("b", 1))]),
            ("p2", day, "n1", "A", None, []), ("p3", day, "n1", "A", None, None),
            ("p4", day, "n1", "A", 5, None), ("p5", day, "n1", "A", 7, [(1, ("a", 1))])]
    df = spark.createDataFrame(rows, schemas.PO)
    buyers = spark.createDataFrame([("INV", "n1")], "category string, buyer string")
    (row,) = throughput.line_throughput(df, buyers, CTX).collect()
    assert row.line_cnt == 3 + 0 + 0 + 5 + 7
    (row,) = throughput.line_throughput(df.drop("n_lines"), buyers, CTX).collect()
    assert row.line_cnt == 3 + 1
    (row,) = throughput.line_throughput(df.drop("lines"), buyers, CTX).collect()
    assert row.line_cnt == 5 + 7
    # JSON documents, lines nested
    path = scratch_path(spark, "po-json")
    io.write_jsonl(df.drop("n_lines"), path)
    (row,) = throughput.line_throughput(io.read_json_documents(spark, path, schemas.PO), buyers, CTX).collect()
    assert row.line_cnt == 4


def test_only_one_field_of_nested_lines_is_read(spark, sf_small):
    i = Inputs(spark, sf_small)
    path = scratch_path(spark, "po-nested")
    io.conform(fixtures.po_documents(spark, sf_small, versions=False), schemas.PO).write.parquet(path)
    landed = spark.read.schema(schemas.PO).parquet(path)
    p = final_plan(throughput.line_throughput(landed.drop("n_lines"), i.buyers, i.ctx))
    assert "lines:array<struct<line_no:int>>" in p
    assert "requisition" not in p[p.index("ReadSchema"):p.index("ReadSchema") + 400]


# keep-first --------------------------------------------------------------------------------

def test_null_order_values_come_last(spark):
    rows = [("p", 1, None, Decimal(9)), ("p", 1, T2, Decimal(5)), ("p", 1, T1, Decimal(7)),
            ("p", 2, None, Decimal(4)), ("p", 2, None, Decimal(3)), ("q", 1, None, None)]
    df = spark.createDataFrame(rows, "po_no string, line int, date_time timestamp_ntz, merch_amt decimal(18,2)")
    got = {(r.po_no, r.line): (r.date_time, r.merch_amt) for r in
           core.keep_first(df, ["po_no", "line"], ["date_time"], then=["merch_amt"]).collect()}
    assert got == {("p", 1): (T1, Decimal(7)), ("p", 2): (None, Decimal(3)), ("q", 1): (None, None)}
    amounts = {r.po_no: r.sum_of_po_amt for r in worklist.worklist_amounts(df, CTX).collect()}
    assert amounts == {"p": Decimal(10), "q": None}


def test_amounts_equal_the_prepared_worklist(spark, sf_small):
    i = Inputs(spark, sf_small)
    cols = ["po_no", "date_time", "sum_of_po_amt", "age"]
    for whole in (i.prepared, i.whole_prepared):
        assert i.amounts.exceptAll(whole.select(*cols)).isEmpty()
        assert whole.select(*cols).exceptAll(i.amounts).isEmpty()


@pytest.mark.parametrize("key", ["c11_approver_overview", "c12_approver_detail", "c13_approver_counts",
                                 "c15_worklist_trend"])
def test_amounts_read_no_attribute(spark, sf_small, key):
    """The whole extract has user, status, unit, ...: none of them is read."""
    p = final_plan(QUERIES[key](spark, sf_small))
    assert "l_shipdate" in p
    for attribute in ("l_returnflag", "l_linestatus"):
        assert attribute not in p


def test_a_unique_order_aggregates_by_hash(spark):
    df = spark.range(100).selectExpr("id % 10 as k", "id as position", "id * 2 as amount")
    first = core.keep_first(df, ["k"], ["position"], one_row_per_order=True)
    assert {(r.k, r.position, r.amount) for r in first.collect()} == {(k, k, 2 * k) for k in range(10)}
    p = final_plan(first)
    assert "HashAggregate" in p and "SortAggregate" not in p and "Sort [" not in p


def test_group_total_computes_its_input_once(spark, sf_small):
    """Rows and totals start from one exchange; a null key is a group like any other."""
    p = final_plan(QUERIES["w01_partition_sum"](spark, sf_small))
    assert p.count("FileScan") == 1 or "ReusedExchange" in p
    assert p.count("FileScan") - p.count("ReusedExchange") <= 1
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 4), (None, 5), ("b", None)], "k string, v long")
    got = sorted((tuple(r) for r in core.attach_group_total(df, ["k"], "v", "t").collect()), key=str)
    assert got == sorted([("a", 1, 3), ("a", 2, 3), (None, 4, 9), (None, 5, 9), ("b", None, None)], key=str)


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 3, "w"), ("a", None, "z"), ("b", None, "q")],
                               "k string, version int, v string")
    assert {(r.k, r.v) for r in core.latest_per_key(df, "k", "version").collect()} == {("a", "y"), ("b", "q")}
    assert {(r.k, r.v) for r in core.latest_per_key(df.drop("version"), "k", "version").collect()} == \
        {("a", "z"), ("b", "q")}
