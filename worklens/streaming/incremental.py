"""Structured Streaming variants (T-01 .. T-03).

The reference re-runs a batch twice a day.  The parts that are naturally
incremental are offered as streams over a file source:

* T-01  new backlog extracts -> commits of the run's snapshot (``foreachBatch`` with a
        ledger of deliveries, so neither a repeated extract nor a replayed batch counts twice);
* T-02  PO count per buyer and Sunday week, additive per micro-batch;
* T-03  (po_no, line) de-duplication of repeated worklist extracts.

Each function starts the query with ``trigger(availableNow=True)``, waits for
it, and returns a batch DataFrame over what the sink wrote.  Checkpoints and
sinks live under the session's shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from worklens.context import IGNORE_CATEGORY, RunContext
from worklens.functions.columns import week_start_sunday
from worklens.operators.core import checked_dimension
from worklens.plans import archive, backlog
from worklens.session import scratch_path
from worklens.sources.io import po_predicate
from worklens.sources.snapshots import commits, deliveries, read_if_any, write_snapshot


def file_stream(spark: SparkSession, folder: str, name: str,
                schema: T.StructType) -> DataFrame:
    """A file-source stream over ``folder/name.parquet`` (new files = new batches)."""
    return (spark.readStream.schema(schema)
                 .option("pathGlobFilter", f"{name}.parquet")
                 .parquet(folder))


def _run(writer, timeout_s: float | None = None) -> None:
    """Process everything available, then stop.

    An ``availableNow`` query ends by itself once the input present at start
    is consumed, so by default there is no time limit.  With ``timeout_s`` a
    query still running is stopped and reported as an error, never returned as
    if complete (its sink would hold only part of the input).
    """
    q = writer.trigger(availableNow=True).start()
    try:
        finished = q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
        if timeout_s and not finished:
            raise TimeoutError(f"streaming query did not finish within {timeout_s} s")
    finally:
        if q.isActive:
            q.stop()


def with_source_file(file_stream_df: DataFrame, name: str = "source_file") -> DataFrame:
    """Add the path of each row's file (the file source's metadata)."""
    return file_stream_df.withColumn(name, F.col("_metadata.file_path"))


def delivery_digests(batch: DataFrame, source: str = "source_file") -> dict[str, str]:
    """file -> digest of its rows, whatever their order: count, sum and XOR of row hashes.

    One row per delivered file reaches the driver.
    """
    cols = [c for c in batch.columns if c != source]
    rows = batch.select(source, F.xxhash64(*cols).alias("h"), F.xxhash64(F.lit(1), *cols).alias("g"))
    per_file = rows.groupBy(source).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("s"),
        F.bit_xor("g").alias("x"))
    return {r[source]: f"{r.n}:{r.s}:{r.x}" for r in per_file.collect()}


def archive_delivery(batch: DataFrame, buyers: DataFrame, ctx: RunContext, root: str) -> None:
    """Commit the files of a micro-batch that the archive has not taken in yet."""
    spark = batch.sparkSession
    if "source_file" not in batch.columns:
        batch = batch.withColumn("source_file", F.lit("batch"))
    known = deliveries(commits(spark, root))
    new: dict[str, str] = {}  # digest -> file, the first of equal ones
    for file, digest in sorted(delivery_digests(batch).items()):
        if digest not in known:
            new.setdefault(digest, file)
    if not new:
        return
    rows = batch.where(F.col("source_file").isin(list(new.values()))).drop("source_file")
    split = backlog.status_split(backlog.clean_backlog(rows, buyers, ctx))
    write_snapshot(spark, root, ctx.snapshot,
                   {archive.BACKLOG_TABLE: archive.backlog_snapshot(split, ctx)},
                   mode="append", taken=sorted(new))


def incremental_archive(spark: SparkSession, backlog_stream: DataFrame,
                        buyers: DataFrame, ctx: RunContext,
                        root: str | None = None) -> DataFrame:
    """T-01: classify each new extract and add it to the run's snapshot, each extract once.

    The archive is C-14's: every micro-batch is an ``append`` commit of the run's
    instant (an extract may arrive as several files).  A commit lists the digests
    of the files it took in; files whose digest the archive already has, under
    whatever name, are left out, so neither a second delivery nor a batch that is
    replayed after a failure adds a row.  ``source_file`` names each row's file
    (``with_source_file``); without it a micro-batch counts as one delivery.
    """
    root = root or scratch_path(spark, "t01")
    out, ckpt = f"{root}/archive", f"{root}/_checkpoint"
    dim = checked_dimension(buyers, "buyer", ctx.broadcast_max_rows)

    _run(backlog_stream.writeStream.foreachBatch(
        lambda batch, _: archive_delivery(batch, dim, ctx, out)).option("checkpointLocation", ckpt))
    return archive.read_backlog_archive(spark, out)


def weekly_po_stream(spark: SparkSession, po_stream: DataFrame, buyers: DataFrame,
                     ctx: RunContext, root: str | None = None) -> DataFrame:
    """T-02: POs per category, buyer and Sunday-aligned week, in whatever order POs arrive.

    Counts add up, so each micro-batch is counted on its own and written to its
    ``batch_id`` partition with dynamic overwrite: a replayed batch replaces
    exactly its own counts.  The result sums the batches; there is no watermark
    and no state, and no PO is late.
    """
    root = root or scratch_path(spark, "t02")
    out, ckpt = f"{root}/weekly", f"{root}/_checkpoint"
    dim = checked_dimension(buyers, "buyer", ctx.broadcast_max_rows)
    schema = T.StructType([dim.schema["category"], dim.schema["buyer"],
                           T.StructField("week_start", T.DateType()),
                           T.StructField("po_cnt", T.LongType()),
                           T.StructField("batch_id", T.LongType())])

    def sink(batch: DataFrame, batch_id: int) -> None:
        counts = (batch.where(po_predicate(ctx)).join(dim, "buyer", "inner")
                       .where(F.col("category") != IGNORE_CATEGORY)
                       .groupBy("category", "buyer",
                                week_start_sunday("po_date").alias("week_start"))
                       .agg(F.count(F.lit(1)).alias("po_cnt"))
                       .withColumn("batch_id", F.lit(batch_id).cast("long")))
        (counts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
               .partitionBy("batch_id").parquet(out))

    _run(po_stream.writeStream.foreachBatch(sink).option("checkpointLocation", ckpt))
    return (read_if_any(spark, out, schema).groupBy("category", "buyer", "week_start")
                 .agg(F.sum("po_cnt").alias("po_cnt")))


def with_ingest_time(file_stream_df: DataFrame, name: str = "ingest_ts") -> DataFrame:
    """Add the arrival time of each row's file (the file source's modification time)."""
    return file_stream_df.withColumn(name, F.col("_metadata.file_modification_time"))


def first_listings(stream: DataFrame, keys: Sequence[str], event_time: str, absent: str) -> DataFrame:
    """Each key when it is first listed; forgotten once it was not listed for ``absent``.

    The state of a key is its last listing.  The watermark trails the newest
    listing by ``absent``, so a key expires when it passes the key's last one: a
    key that every extract lists again stays, however long, and the state holds
    the keys of the last ``absent`` only.  Rows later than that are dropped by the
    watermark.  A key that comes back after its absence counts as new.
    """
    key_fields = [stream.schema[k] for k in keys]

    def listed(key, frames, state):
        if state.hasTimedOut:
            state.remove()
            return
        seen = max(int(f["_ms"].max()) for f in frames)
        known = state.get[0] if state.exists else None
        state.update((seen if known is None else max(seen, known),))
        state.setTimeoutTimestamp(state.get[0] + 1)
        if known is None:
            yield pd.DataFrame([key], columns=list(keys))

    rows = stream.select(*keys, event_time, F.unix_millis(event_time).alias("_ms")).withWatermark(
        event_time, absent)
    return rows.groupBy(*keys).applyInPandasWithState(
        listed, T.StructType(key_fields), T.StructType([T.StructField("last_ms", T.LongType())]),
        "append", GroupStateTimeout.EventTimeTimeout)


def dedupe_stream(spark: SparkSession, worklist_stream: DataFrame,
                  event_time: str | None = None, absent: str = "60 days",
                  root: str | None = None) -> DataFrame:
    """T-03: one row per (po_no, line) across repeated extracts, however long a line is listed.

    Without ``event_time`` the state holds every key seen (in RocksDB with
    ``session.cluster_settings``).  With it (a timestamp, e.g. the arrival of an
    extract, see ``with_ingest_time``) keys that were not listed for ``absent``
    leave the state (:func:`first_listings`); one that returns later is new.
    Which repeat survives is not defined, so only the keys are returned.
    """
    root = root or scratch_path(spark, "t03")
    out, ckpt = f"{root}/lines", f"{root}/_checkpoint"
    keys = ["po_no", "line"]
    if event_time is None:
        keyed = worklist_stream.dropDuplicates(keys).select(*keys)
    else:
        keyed = first_listings(worklist_stream, keys, event_time, absent)
    _run(keyed.writeStream.outputMode("append").format("parquet")
              .option("path", out).option("checkpointLocation", ckpt))
    return read_if_any(spark, out, keyed.schema)
