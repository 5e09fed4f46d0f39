"""Extracts as they are landed: headers, formats, and rows that are kept aside."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from worklens import schemas
from worklens.sources import io, landing

T = schemas.T


def write(tmp_path, text, name="x.csv"):
    (tmp_path / name).write_text(text, encoding="utf-8")
    return f"file://{tmp_path}/{name}"


def test_headers_bind_by_name_and_broken_rows_are_kept_aside(spark, tmp_path):
    text = """Req Total,Buyer,Requisition ID,Date of Approval,Hold From Further Processing,Out-to-Bid,Extra,Business Unit,\
Requisition Date,Origin,Requester,Last Change Date,Buyer Assignment,Hold Req Process
"$1,234.50",n1,r1,6/1/2001,N,Not Requested,x,,2001-05-30,,,,,
(12.00),n1,r2,2001-06-02,Y, Requested ,x,,,,,,,
, ,r3,,N,,x,,,,,,,
5,n1,r4,the first of June,N,,x,,,,,,,
5 apples,n1,r5,6/31x/2001,N,,x,,,,,,,
7,n1,,6/1/2001,N,,x,,,,,,,
7,n1,r7
99999999999999999999,n1,r8,6/1/2001,N,,x,,,,,,,
"""
    landed = io.land_backlog(spark, write(tmp_path, text))
    rows = {r.requisition_id: r for r in landed.rows.collect()}
    assert landed.rows.columns == schemas.BACKLOG.fieldNames()
    assert set(rows) == {"r1", "r2", "r3"}
    r1, r2, r3 = rows["r1"], rows["r2"], rows["r3"]
    assert (r1.req_total, r1.date_of_approval, r1.requisition_date, r1.hold) == \
        (Decimal("1234.50"), dt.date(2001, 6, 1), dt.date(2001, 5, 30), "N")
    assert (r2.req_total, r2.date_of_approval, r2.out_to_bid) == (Decimal("-12.00"), dt.date(2001, 6, 2), "Requested")
    assert (r3.req_total, r3.buyer, r3.date_of_approval) == (None, None, None)
    assert landed.counts.get == {"n_rows": 8, "n_rejected": 5}
    aside = [(r.errors, r.record) for r in landed.rejects.collect()]
    assert sorted(e for e, _ in aside) == sorted([
        ["date_of_approval"], ["date_of_approval", "req_total"], ["requisition_id is missing"],
        ["number of cells"], ["req_total"]])
    assert any(json.loads(r).get("Requisition ID") == "r4" for _, r in aside if r.startswith("{"))
    assert "7,n1,r7" in [r for _, r in aside]
    out = f"file://{tmp_path}/aside"
    landing.quarantine(landed, out)
    landing.quarantine(landed, out)
    assert spark.read.schema(landing.REJECTS).parquet(out).count() == 10


def test_worklist_extract_without_tie_breakers(spark, tmp_path):
    """The first of repeated lines is the first in the extract, as no column tells them apart."""
    from worklens.context import RunContext
    from worklens.plans import worklist
    text = """User,Status,OperID,Date/Time,Unit,PO No.,Origin,Merch_Amt,Line
u2,S,o,6/1/2001 8:05,un,p1,x,"$60,000.00",1
u1,S,o,6/1/2001 08:05:00,un,p1,x,1,1
u3,S,o,2001-06-02T10:00:00,un,p1,x,5,2
u4,S,o,6/2/2001 1:30 PM,un,p2,x,,1
u5,S,o,,un,p3,x,4,one
"""
    landed = io.land_worklist(spark, write(tmp_path, text))
    prepared = {r.po_no: r for r in worklist.prepared_worklist(landed.rows, RunContext(dt.date(2001, 7, 1))).collect()}
    assert set(prepared) == {"p1", "p2"}
    assert (prepared["p1"].user, prepared["p1"].sum_of_po_amt, prepared["p1"].age) == ("u2", Decimal(60005), 30)
    assert prepared["p2"].date_time == dt.datetime(2001, 6, 2, 13, 30) and prepared["p2"].sum_of_po_amt is None
    assert [r.errors for r in landed.rejects.collect()] == [["line"]]


def test_headers_that_do_not_fit_are_errors(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType())])
    with pytest.raises(ValueError, match="lacks"):
        landing.land_csv(spark, write(tmp_path, "a,c\n1,2\n", "one.csv"), schema)
    with pytest.raises(ValueError, match="two columns"):
        landing.land_csv(spark, write(tmp_path, "a.,a,b\n1,2,3\n", "two.csv"), schema)
    got = landing.land_csv(spark, write(tmp_path, "b,a\n1,x\n", "three.csv"), schema).rows.collect()
    assert [tuple(r) for r in got] == [("x", 1)]
    got = landing.land_csv(spark, write(tmp_path, "a\nx\n", "four.csv"), schema, optional=("b",)).rows.collect()
    assert [tuple(r) for r in got] == [("x", None)]
    (tmp_path / "many").mkdir()
    write(tmp_path / "many", "a,b\nx,1\n", "1.csv")
    write(tmp_path / "many", "b,a\n2,y\n", "2.csv")
    with pytest.raises(Exception, match="(?i)header"):  # columns of one folder never change places unseen
        landing.land_csv(spark, f"file://{tmp_path}/many", schema).rows.collect()


def test_empty_extract(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.StringType())])
    landed = landing.land_csv(spark, write(tmp_path, "a\n"), schema)
    assert landed.rows.collect() == [] and landed.rejects.collect() == []
    assert [landing.column_name(x) for x in ("PO No.", "Date/Time", "OperID", "Out-to-Bid", " Merch_Amt ")] == \
        ["po_no", "date_time", "oper_id", "out_to_bid", "merch_amt"]


def test_only_formats_that_can_fit_are_tried_with_the_same_values(spark):
    cells = ["2024-05-06", "5/6/2024", "05/06/2024", "2024-05-06 07:08:09", "2024-05-06T07:08:09", "soon", "",
             "2024-05-06 07:08:09.123456", "2024-05-06T07:08:09.123", "2024-05-06t07:08:09", "5/6/2024 7:08",
             "5/6/2024 17:08:09", "5/6/2024 7:08 PM", "5/6/2024 7:08:09 am", "5/6/2024 7:08 p.m.", "5/6/24",
             "2024/05/06", "13/6/2024", "2024-05-06 7:08", "5-6-2024", "5/6/2024T7:08", "+12024-05-06",
             "2024-05-06 07:08:09.123456.789", "May 6 2024", "5/6/2024  7:08", "-2024-05-06"]
    formats = landing.DATE_FORMATS + landing.TIME_FORMATS
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    plain = F.coalesce(*[F.try_to_timestamp("c", F.lit(f)) for f in formats])
    for kind in (T.DateType(), T.TimestampType(), T.TimestampNTZType()):
        rows = df.select("c", plain.cast(kind).cast("string").alias("x"),
                         landing.parse_cell(F.col("c"), kind).cast("string").alias("y")).collect()
        assert sum(r.x is not None for r in rows) >= 11
        assert [r.c for r in rows if r.x != r.y] == []


def test_a_cell_is_trimmed_and_parsed_once(spark, tmp_path):
    (tmp_path / "w.csv").write_text("po_no,line,date_time,merch_amt,user,status,oper_id,unit,origin\n"
                                    " 7 , 1 ,5/6/2024 7:08,$1.50,u,s,o,n,g\n8,x,5/6/2024 7:08,$1.50,u,s,o,n,g\n")
    landed = io.land_worklist(spark, str(tmp_path / "w.csv"))
    plan = landed.rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("trim(") == 9 and plan.count("gettimestamp(") == len(landing.DATE_FORMATS + landing.TIME_FORMATS)
    row, = landed.rows.collect()
    assert (row.po_no, row.line, str(row.merch_amt)) == ("7", 1, "1.50")
    assert [r.errors for r in landed.rejects.collect()] == [["line"]]
