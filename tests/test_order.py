"""Row order of results and published datasets, and runs that read their facts once."""

import glob

import pyarrow.parquet as pq
import pytest

from worklens.catalog import QUERIES
from worklens.catalog.inputs import Inputs
from worklens.plans import backlog, report, throughput, worklist
from worklens.session import scratch_path
from worklens.sources import io

RANKS = {"NINV": 1, "SE": 2, "INV": 3}


def files_in_order(path):
    """The rows of a written dataset, file by file by name."""
    return [r for f in sorted(glob.glob(path.removeprefix("file:").replace("//", "/") + "/part-*"))
            for r in pq.read_table(f).to_pylist()]


def last(v, flip=False):
    """A sort key that puts nulls last; ``flip`` for text that descends."""
    if v is None:
        return (1, "")
    return (0, tuple(-ord(c) for c in v) + (1,) if flip else v)


ORDERS = {
    "o01_sort_category_alpha": lambda r: (last(r["category"]), r["buyer"]),
    "o02_sort_category_rank": lambda r: (last(r["category_rank"]), r["buyer"]),
    "o03_sort_buyer_desc": lambda r: (last(r["category_rank"]), last(r["buyer_full"], flip=True)),
    "o04_sort_age_desc": lambda r: (last(None if r["overall_age"] is None else -r["overall_age"]), r["po_no"]),
}


@pytest.mark.parametrize("key", sorted(ORDERS))
def test_sorted_queries_write_sorted_files(spark, sf_oracle, key):
    path = scratch_path(spark, key)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # more than one file
    try:
        QUERIES[key](spark, sf_oracle).write.parquet(path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    rows = files_in_order(path)
    assert len(rows) > 3 and rows == sorted(rows, key=ORDERS[key])
    assert len(glob.glob(path.removeprefix("file:") + "/part-*")) > 1


def test_published_datasets_are_in_display_order(spark, sf_small):
    i = Inputs(spark, sf_small)
    paths = report.run_backlog_report(spark, i.backlog_raw, i.approver_raw, i.buyers, i.po_docs, i.req_docs,
                                      i.ctx, scratch_path(spark, "out"), archive_root=scratch_path(spark, "arch"))
    paths |= report.run_throughput_report(i.po_data, i.buyers, i.ctx, scratch_path(spark, "tp"))
    assert set(report.DISPLAY_ORDER) <= set(paths)

    def key(row, order):
        out = []
        for c in order:
            if c == "row_rank":
                out.append((0, {"buyer": 1, "subtotal": 2, "total": 3}[row["row_kind"]]))
            elif c == "-overall_age":
                out.append(last(None if row["overall_age"] is None else -row["overall_age"]))
            else:
                out.append(last(row[c.removeprefix("-")], flip=c.startswith("-")))
        return out

    for name, order in report.DISPLAY_ORDER.items():
        rows = files_in_order(paths[name])
        assert rows == sorted(rows, key=lambda r: key(r, order)), name  # noqa: B023
        assert [r.asDict() for r in io.read_in_order(spark, paths[name]).collect()] == rows, name
    kinds = [r["row_kind"] for r in files_in_order(paths["age_report"])]
    assert kinds[-1] == "total" and kinds.count("subtotal") == 3
    # every category's buyers stand above their subtotal
    assert "".join(k[0] for k in kinds).strip("b") != "" and kinds[0] == "buyer"


def as_set(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=str)


def test_one_aggregate_gives_every_backlog_table(spark, sf_small):
    i = Inputs(spark, sf_small)
    got = backlog.summary_datasets(backlog.buyer_summary(i.split, i.ctx), i.buyers)
    age, amount = backlog.age_table(i.split), backlog.amount_table(i.split, i.ctx)
    want = {"age_table": age, "age_report": backlog.age_report(i.split),
            "age_report_groups": backlog.report_groups(age),
            "status_chart": backlog.status_chart(i.split, i.buyers),
            "hidden_buyers": backlog.hidden_buyers(age, i.buyers),
            "old_table": backlog.old_table(i.split, i.ctx), "old_chart": backlog.old_chart(i.split, i.ctx),
            "amount_table": amount, "amount_report": backlog.amount_report(i.split, i.ctx),
            "amount_report_groups": backlog.report_groups(amount)}
    assert set(got) == set(want)
    for name, df in want.items():
        assert as_set(got[name]) == as_set(df), name


def test_one_aggregate_gives_every_throughput_table(spark, sf_small):
    i = Inputs(spark, sf_small)
    got = throughput.datasets(throughput.weekly(i.po_data, i.buyers, i.ctx), i.ctx)
    want = {"po_throughput": throughput.po_throughput(i.po_data, i.buyers, i.ctx),
            "line_throughput": throughput.line_throughput(i.po_data, i.buyers, i.ctx),
            "po_throughput_wide": throughput.po_throughput_wide(i.po_data, i.buyers, i.ctx),
            "line_throughput_wide": throughput.line_throughput_wide(i.po_data, i.buyers, i.ctx),
            "throughput_groups": throughput.throughput_groups(i.po_data, i.buyers, i.ctx)}
    assert set(got) == set(want)
    for name, df in want.items():
        assert as_set(got[name]) == as_set(df), name


def test_a_run_reads_its_facts_once(spark, sf_small, monkeypatch):
    """Every published plan reads the written aggregates; none goes back to the facts."""
    i = Inputs(spark, sf_small)
    seen = {}
    publish = report.publish_datasets
    monkeypatch.setattr(report, "publish_datasets", lambda d, out: seen.update(d) or publish(d, out))
    report.run_backlog_report(spark, i.backlog_raw, i.approver_raw, i.buyers, i.po_docs, i.req_docs, i.ctx,
                              scratch_path(spark, "out"))
    report.run_throughput_report(i.po_data, i.buyers, i.ctx, scratch_path(spark, "tp"))
    for name, df in seen.items():
        files = df.inputFiles()
        facts = [f for f in files if f.endswith(("orders.parquet", "lineitem.parquet"))]
        assert not facts or name == "approver_detail", (name, facts)  # its documents are a source
        if name.startswith(("age", "amount", "old", "status")):
            assert any("run-summary" in f for f in files) and not any("run-split" in f for f in files)
    assert worklist.approver_counts(i.amounts, i.ctx).first().total_count > 0
