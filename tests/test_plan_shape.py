"""Physical-plan properties the design relies on (pushdown, pruning, shuffles, no UDF)."""

import datetime as dt

import pytest

from worklens import schemas
from worklens.catalog import QUERIES
from worklens.catalog.inputs import Inputs
from worklens.plans import archive, backlog
from worklens.session import scratch_path
from worklens.sources import io


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_po_read_pushes_predicate_and_prunes_columns(spark, sf_small):
    i = Inputs(spark, sf_small)
    path = scratch_path(spark, "shape-po")
    io.conform(i.po_data, schemas.PO).write.parquet(path)
    p = plan(io.read_po(spark, path, i.ctx, ["po_no", "buyer"]))
    assert ("PushedFilters: [IsNotNull(po_date), GreaterThan(po_date,2001-01-01T00:00), "
            "In(status, [A,C,D])]") in p
    assert "ReadSchema: struct<po_no:string,po_date:timestamp_ntz,buyer:string,status:string>" in p


def test_archive_range_prunes_partitions(spark, sf_small):
    i = Inputs(spark, sf_small)
    path = scratch_path(spark, "shape-arch")
    io.write_archive(archive.backlog_history(i.split, i.ctx.history_dates), path)
    df = io.read_archive(spark, path, schemas.ARCHIVE_BACKLOG, since=dt.date(2001, 6, 1))
    p = plan(df)
    assert "PartitionFilters: [isnotnull(archive_time" in p
    assert {r.archive_time for r in df.select("archive_time").distinct().collect()} == \
        {dt.date(2001, 6, 1), dt.date(2001, 7, 1)}


def test_age_report_shuffles_fact_rows_once(spark, sf_small):
    i = Inputs(spark, sf_small)
    p = plan(backlog.age_report(i.split))
    # one exchange for the per-buyer aggregation, one for the rollup of that tiny result
    assert p.count("Exchange hashpartitioning") == 2
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    assert p.index("Expand") < p.rindex("Exchange hashpartitioning")  # rollup above the agg


def test_status_tables_are_single_aggregations(spark, sf_small):
    i = Inputs(spark, sf_small)
    for df in (backlog.age_table(i.split), backlog.amount_table(i.split, i.ctx),
               backlog.old_table(i.split, i.ctx)):
        p = plan(df)
        assert p.count("Exchange hashpartitioning") == 1
        assert "HashAggregate" in p and "SortAggregate" not in p


PURE_KEYS = [k for k in QUERIES if not k.startswith(("s0", "t0", "c14"))]


@pytest.mark.parametrize("key", PURE_KEYS)
def test_no_python_in_plans(spark, sf_small, key):
    p = plan(QUERIES[key](spark, sf_small))
    for op in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
               "PythonUDF"):
        assert op not in p, (key, op)


def test_landed_backlog_window_reaches_the_scan(spark, sf_small):
    i = Inputs(spark, sf_small)
    path = scratch_path(spark, "shape-backlog")
    io.conform(i.backlog_raw, schemas.BACKLOG).write.parquet(path)
    landed = io.read_backlog(spark, path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        p = plan(backlog.age_table(backlog.status_split(backlog.clean_backlog(landed, i.buyers,
                                                                              i.ctx))))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(date_of_approval,1996-01-01)" in p
    assert "LessThanOrEqual(date_of_approval,2001-07-15)" in p
    assert "IsNotNull(buyer)" in p
    # only the columns the table needs are read
    assert "ReadSchema: struct<hold:string,date_of_approval:date,buyer:string," \
           "out_to_bid:string>" in p
