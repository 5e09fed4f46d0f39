"""The committed archive: instants, reruns, halves, ranges, old layouts, deliveries, kept trends."""

import datetime as dt
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from worklens import schemas
from worklens.catalog.inputs import Inputs
from worklens.context import RunContext
from worklens.plans import archive, backlog
from worklens.session import scratch_path
from worklens.sources import io, snapshots
from worklens.streaming import incremental

MORNING, EVENING = dt.datetime(2001, 7, 1, 8, 15), dt.datetime(2001, 7, 1, 17, 30, 5)
CTX = RunContext(as_of=dt.date(2001, 7, 1), archive_time=MORNING)
ROWS = "k long, status string"
SCHEMA = schemas.T.StructType([schemas.T.StructField("k", schemas.T.LongType()),
                               schemas.T.StructField("status", schemas.T.StringType()), schemas.INSTANT])


def rows(spark, *ks):
    return spark.createDataFrame([(k, "plain") for k in ks], ROWS)


def kept(spark, root, table="t", **kw):
    return sorted((r.archive_time, r.k) for r in
                  snapshots.read_snapshots(spark, root, table, SCHEMA, **kw).collect())


def test_two_runs_of_a_day_and_a_rerun(spark):
    root = scratch_path(spark, "snap")
    assert kept(spark, root) == []
    snapshots.write_snapshot(spark, root, MORNING, {"t": rows(spark, 1, 2)})
    snapshots.write_snapshot(spark, root, EVENING, {"t": rows(spark, 2, 3)})
    assert kept(spark, root) == [(MORNING, 1), (MORNING, 2), (EVENING, 2), (EVENING, 3)]
    snapshots.write_snapshot(spark, root, MORNING, {"t": rows(spark, 1)})
    assert kept(spark, root) == [(MORNING, 1), (EVENING, 2), (EVENING, 3)]
    snapshots.write_snapshot(spark, root, EVENING, {"t": rows(spark)})  # an empty rerun clears it
    assert kept(spark, root) == [(MORNING, 1)]


def test_ranges_prune_whole_commits(spark):
    root = scratch_path(spark, "snap")
    for day in (1, 2, 3):
        for t in (MORNING, EVENING):
            snapshots.write_snapshot(spark, root, t.replace(day=day), {"t": rows(spark, day)})
    assert len(kept(spark, root, since=dt.date(2001, 7, 2))) == 4
    assert len(kept(spark, root, until=dt.date(2001, 7, 2))) == 4  # that day included
    assert kept(spark, root, since=EVENING, until=MORNING.replace(day=2)) == \
        [(EVENING, 1), (MORNING.replace(day=2), 2)]
    files = snapshots.read_snapshots(spark, root, "t", SCHEMA, since=dt.date(2001, 7, 3)).inputFiles()
    assert files and all("archive_time=2001-07-03" in f.replace("%20", " ") for f in files)


def test_nothing_is_seen_before_it_is_published(spark, monkeypatch):
    root = scratch_path(spark, "snap")
    snapshots.write_snapshot(spark, root, MORNING, {"t": rows(spark, 1), "u": rows(spark, 7)})

    def lost(*_):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(snapshots, "publish", lost)
    with pytest.raises(RuntimeError):
        snapshots.write_snapshot(spark, root, MORNING, {"t": rows(spark, 5), "u": rows(spark, 6)})
    monkeypatch.undo()
    assert kept(spark, root) == [(MORNING, 1)] and kept(spark, root, "u") == [(MORNING, 7)]
    with pytest.raises(ValueError):
        snapshots.write_snapshot(spark, root, MORNING, {}, mode="merge")


def test_append_adds_and_replace_clears(spark):
    root = scratch_path(spark, "snap")
    snapshots.write_snapshot(spark, root, MORNING, {"t": rows(spark, 1)}, mode="append", taken=["a"])
    snapshots.write_snapshot(spark, root, MORNING, {"t": rows(spark, 2)}, mode="append", taken=["b"])
    assert kept(spark, root) == [(MORNING, 1), (MORNING, 2)]
    assert snapshots.deliveries(snapshots.commits(spark, root)) == {"a", "b"}
    snapshots.write_snapshot(spark, root, MORNING, {"t": rows(spark, 3)})
    assert kept(spark, root) == [(MORNING, 3)]


def test_older_layouts_read_together(spark, sf_small):
    """The first layout (ten columns, by date), a commit without a column, and one of today's."""
    i = Inputs(spark, sf_small)
    old, root = scratch_path(spark, "old"), scratch_path(spark, "snap")
    io.write_archive(archive.backlog_history(i.split, i.ctx.history_dates), old)
    today = replace(i.ctx, archive_time=EVENING)
    snap = archive.backlog_snapshot(i.whole_split, today)
    snapshots.write_snapshot(spark, root, EVENING, {"backlog": snap.drop("requester")})
    snapshots.write_snapshot(spark, root, EVENING + dt.timedelta(1), {"backlog": snap})
    df = archive.read_backlog_archive(spark, root, legacy=old)
    assert df.schema.fieldNames() == schemas.SNAPSHOT_BACKLOG.fieldNames()
    n = snap.count()
    got = {r.archive_time: (r.n, r.w) for r in df.groupBy("archive_time").agg(
        F.count("*").alias("n"), F.count("requester").alias("w")).collect()}
    assert got[EVENING] == (n, 0) and got[EVENING + dt.timedelta(1)] == (n, n)
    assert got[dt.datetime(2001, 6, 1)][1] == 0 and len(got) == 2 + 3  # nothing was approved by the first date
    # a commit at the midnight of an old date stands for it
    snapshots.write_snapshot(spark, root, dt.date(2001, 6, 1), {"backlog": snap.limit(3)})
    df = archive.read_backlog_archive(spark, root, since=dt.date(2001, 6, 1), legacy=old)
    assert df.where(F.col("archive_time") == F.lit("2001-06-01").cast("timestamp_ntz")).count() == 3


def test_both_halves_keep_every_source_column(spark, sf_small):
    i = Inputs(spark, sf_small)
    root = scratch_path(spark, "snap")
    archive.archive_snapshot(spark, i.whole_split, i.whole_prepared, replace(i.ctx, archive_time=MORNING), root)
    b, w = archive.read_backlog_archive(spark, root), archive.read_worklist_archive(spark, root)
    assert set(schemas.BACKLOG.fieldNames()) - set(b.columns) == {"last_change_date"}
    assert {"user", "status", "oper_id", "unit", "origin", "sum_of_po_amt", "age"} <= set(w.columns)
    assert w.count() == i.prepared.count() and w.where("user is null or unit is null").count() == 0
    assert [c.tables for c in snapshots.commits(spark, root)] == [("backlog", "worklist")]


# deliveries --------------------------------------------------------------------------------

EXTRACT = "requisition_id string, hold string, out_to_bid string, date_of_approval date, buyer string, req_total decimal(18,2)"


def deliver(spark, folder, name, *ids):
    data = [(i, "N", "Not Requested", dt.date(2001, 6, 1), "n1", Decimal("5")) for i in ids]
    spark.createDataFrame(data, EXTRACT).coalesce(1).write.parquet(f"{folder}/{name}")


def test_each_extract_once(spark):
    folder, root = scratch_path(spark, "extracts"), scratch_path(spark, "t01")
    buyers = spark.createDataFrame([("NINV", "n1")], "category string, buyer string")

    def run(ctx=CTX):
        stream = incremental.with_source_file(spark.readStream.schema(EXTRACT).option(
            "recursiveFileLookup", "true").parquet(folder))
        got = incremental.incremental_archive(spark, stream, buyers, ctx, root=root)
        return sorted((r.archive_time, r.requisition_id) for r in got.collect())

    deliver(spark, folder, "a", "r1", "r2")
    assert run() == [(MORNING, "r1"), (MORNING, "r2")]
    deliver(spark, folder, "again", "r2", "r1")       # the same rows under another name
    assert run() == [(MORNING, "r1"), (MORNING, "r2")]
    deliver(spark, folder, "part-two", "r3")          # the same run's second file
    deliver(spark, folder, "part-two-again", "r3")    # twice within one micro-batch
    assert run() == [(MORNING, "r1"), (MORNING, "r2"), (MORNING, "r3")]
    deliver(spark, folder, "evening", "r1", "r4")
    assert run(replace(CTX, archive_time=EVENING)) == [
        (MORNING, "r1"), (MORNING, "r2"), (MORNING, "r3"), (EVENING, "r1"), (EVENING, "r4")]


def test_a_replayed_batch_adds_nothing(spark):
    """The checkpoint is lost after the commit: the same files come as another batch."""
    folder, root = scratch_path(spark, "extracts"), scratch_path(spark, "t01")
    buyers = spark.createDataFrame([("NINV", "n1")], "category string, buyer string")
    deliver(spark, folder, "a", "r1", "r2")
    for n in range(2):
        stream = incremental.with_source_file(spark.readStream.schema(EXTRACT).option(
            "recursiveFileLookup", "true").parquet(folder))
        out = f"{root}/archive"
        known = len(snapshots.commits(spark, out))
        incremental._run(stream.writeStream.foreachBatch(
            lambda b, _: incremental.archive_delivery(b, buyers, CTX, out)).option(
            "checkpointLocation", f"{root}/ckpt-{n}"))
        assert len(snapshots.commits(spark, out)) == max(known, 1)
    assert archive.read_backlog_archive(spark, f"{root}/archive").count() == 2


def test_streams_without_files_give_empty_tables(spark):
    folder = scratch_path(spark, "none")
    spark.createDataFrame([], EXTRACT).write.parquet(f"{folder}/x")
    buyers = spark.createDataFrame([("NINV", "n1")], "category string, buyer string")
    stream = spark.readStream.schema(EXTRACT).option("pathGlobFilter", "*.nothing").parquet(folder)
    df = incremental.incremental_archive(spark, stream, buyers, CTX)
    assert df.columns == schemas.SNAPSHOT_BACKLOG.fieldNames() and df.count() == 0
    po = "po_no string, po_date timestamp_ntz, buyer string, status string, n_lines bigint"
    stream = spark.readStream.schema(po).option("pathGlobFilter", "*.nothing").parquet(folder)
    assert incremental.weekly_po_stream(spark, stream, buyers, CTX).count() == 0


# kept trends -------------------------------------------------------------------------------

def test_a_run_reads_its_own_commit_only(spark, sf_small):
    i = Inputs(spark, sf_small)
    root = scratch_path(spark, "snap")
    history = archive.backlog_history(i.split, i.ctx.history_dates)
    name = f"status-{i.ctx.min_age_days}"

    def commit(d, rows):
        return snapshots.write_snapshot(spark, root, d, {"backlog": rows})

    for d in i.ctx.history_dates[:-1]:
        commit(d, history.where(F.col("archive_time") == F.lit(d)))
    archive.status_trend_incremental(spark, root, i.ctx)
    last = i.ctx.history_dates[-1]
    new_id = commit(last, history.where(F.col("archive_time") == F.lit(last)))
    unread, found = snapshots.unsummarised(spark, root, "backlog", schemas.SNAPSHOT_BACKLOG, name)
    assert [c.id for c in found] == [new_id]
    assert unread.inputFiles() and all(f"commit={new_id}" in f for f in unread.inputFiles())

    def as_set(df):
        return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=str)

    whole = archive.read_backlog_archive(spark, root)
    assert as_set(archive.status_trend_incremental(spark, root, i.ctx)) == \
        as_set(archive.status_trend(whole, i.ctx))
    assert as_set(archive.old_trend_sum_incremental(spark, root, i.ctx)) == \
        as_set(archive.old_trend_sum(whole, i.ctx))
    assert snapshots.unsummarised(spark, root, "backlog", schemas.SNAPSHOT_BACKLOG, name)[1] == []
    # a rerun of an earlier instant replaces its counts; an append adds to them
    commit(i.ctx.history_dates[1], history.limit(10))
    snapshots.write_snapshot(spark, root, last, {"backlog": history.limit(7)}, mode="append")
    whole = archive.read_backlog_archive(spark, root)
    assert as_set(archive.status_trend_incremental(spark, root, i.ctx)) == \
        as_set(archive.status_trend(whole, i.ctx))
    assert as_set(archive.snapshot_counts_incremental(spark, root, i.ctx)) == \
        as_set(whole.groupBy("archive_time").agg(F.count("*").alias("n")))


def test_kept_trends_of_nothing(spark):
    root = scratch_path(spark, "snap")
    assert archive.status_trend_incremental(spark, root, CTX).count() == 0
    assert archive.worklist_trend_incremental(spark, root, CTX).count() == 0


def test_a_history_needs_dates(spark, sf_small):
    i = Inputs(spark, sf_small)
    with pytest.raises(ValueError):
        archive.backlog_history(i.split, ())
    with pytest.raises(ValueError):
        archive.worklist_history(i.prepared, ())


# expiring de-duplication -------------------------------------------------------------------

def test_keys_expire_after_their_last_listing(spark):
    """Ten days of re-listing give each key once; one that is absent leaves the state."""
    folder, root = scratch_path(spark, "listings"), scratch_path(spark, "t03-expiry")
    schema = "po_no string, line int, listed timestamp"

    def day(n, *pos):
        rows = [(po, 1, dt.datetime(2001, 6, n, 8, 0)) for po in pos] * 2
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{n:02d}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(folder)
        got = incremental.dedupe_stream(spark, stream, "listed", "3 days", root=root)
        state = spark.read.format("statestore").load(f"{root}/_checkpoint")
        return sorted(r.po_no for r in got.collect()), {r.k for r in state.select(F.col("key.po_no").alias("k")).collect()}

    for n in range(1, 11):
        pos = ["A", "B"] if n <= 3 else ["A", "C"]
        emitted, state = day(n, *pos)
    assert emitted == ["A", "B", "C"]        # A was listed for ten days, longer than three
    assert state == {"A", "C"}               # B was last listed on the third
    emitted, state = day(11, "A", "B")
    assert emitted == ["A", "B", "B", "C"] and state == {"A", "B", "C"}


def test_kept_trends_compute_the_replayed_rows_once(spark, sf_small, monkeypatch):
    from worklens.catalog import trends
    plans = []

    def write(spark, root, at, tables):
        plans.extend(t._jdf.queryExecution().optimizedPlan().toString() for t in tables.values())
        return snapshots.write_snapshot(spark, root, at, tables)

    monkeypatch.setattr(trends, "write_snapshot", write)
    trends.k08_count_by_snapshot_kept(spark, sf_small)
    assert len(plans) == 2 * len(trends.FIXTURE.history_dates)
    assert not any("Join" in p or "Aggregate" in p for p in plans)
