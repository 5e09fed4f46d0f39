"""Extendible hashing: documents to shards of a bounded number of bytes.

A directory is indexed by the leading bits of a key's hash.  A bucket whose
bytes exceed the limit splits on one more bit; all others stay.  The bits of a
row are the 60 bits of its key's hash, then 60 bits of a hash of its content
and then those of a row number, so rows of one hot key, and even identical
rows, can be told apart; a lookup by key walks the directory by the key's bits
and, for a key that fills several shards, gets all below its prefix.

The bits are consumed ``STEP`` at a time.  One round sums the bytes per prefix
of the rows still open (with map-side combine), rolls the sums up to the
shorter prefixes, and closes each prefix that fits.  Rounds end when every
bucket fits or holds a single row; a single row above the limit is a shard of
its own, marked ``fits = false``.

Only DataFrame functions are used.  Defined cases: null text counts zero
bytes; a null key has a hash of its own; repeated rows are kept, each in one
shard; an empty table has no shards; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worklens.llm.common import materialize

#: Bits of one hash, and bits that one round looks at.
HASH_BITS, STEP = 60, 10
SHARD_BYTES = 1 << 20


def hash_bits(value: Column) -> Column:
    """60 bits, as a string of 0 and 1, from the md5 of a text."""
    number = F.conv(F.substring(F.md5(value.cast("binary")), 1, HASH_BITS // 4), 16, 10)
    return F.lpad(F.bin(number.cast("long")), HASH_BITS, "0")


def directory_round(cells: DataFrame, start: int, limit: int) -> DataFrame:
    """Closed prefixes among ``cells`` (cell, bytes, docs), whose length is start + STEP.

    Returns a row per cell: its leaf (prefix), bytes and docs of it, or null if
    the cell is still open.  A leaf is the shortest prefix that fits.
    """
    depths = F.explode(F.sequence(F.lit(start), F.lit(start + STEP)))
    at = cells.select("cell", "cell_bytes", "cell_docs", depths.alias("depth"))
    at = at.withColumn("prefix", F.substring("cell", F.lit(1), F.col("depth")))
    sums = at.groupBy("prefix").agg(
        F.sum("cell_bytes").alias("shard_bytes"), F.sum("cell_docs").alias("shard_docs"))
    fit = sums.where((F.col("shard_bytes") <= limit) | (F.col("shard_docs") == 1))
    best = at.join(fit, "prefix").groupBy("cell").agg(
        F.min_by(F.struct("prefix", "shard_bytes", "shard_docs"), "depth").alias("leaf"))
    return cells.select("cell").join(best, "cell", "left")


def assign_shards(docs: DataFrame, limit: int = SHARD_BYTES, row: str | None = None) -> DataFrame:
    """(doc_id, n_bytes, shard, depth, shard_bytes, shard_docs, fits) per row.

    ``row`` names a column of row numbers, all different, that is returned too.
    """
    number = F.monotonically_increasing_id() if row is None else F.col(row)
    carry = ["doc_id", "n_bytes"] + ([] if row is None else [row])
    sized = materialize(docs.select(
        "doc_id", *carry[2:],
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.concat(hash_bits(F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))),
                 hash_bits(F.coalesce(F.col("text").cast("string"), F.lit(""))),
                 hash_bits(number.cast("string"))).alias("bits"),
    ), "shard-sizes")
    out, pending, start = None, sized, 0
    while True:
        cell = F.substring("bits", 1, start + STEP)
        cells = pending.groupBy(cell.alias("cell")).agg(
            F.sum("n_bytes").alias("cell_bytes"), F.count("*").alias("cell_docs"))
        leaves = materialize(directory_round(cells, start, limit), "shard-directory")
        placed = pending.withColumn("cell", cell).join(leaves, "cell")
        closed = placed.where(F.col("leaf").isNotNull()).select(
            *carry, F.col("leaf.prefix").alias("shard"),
            F.length("leaf.prefix").cast("long").alias("depth"),
            F.col("leaf.shard_bytes").alias("shard_bytes"),
            F.col("leaf.shard_docs").alias("shard_docs"),
            (F.col("leaf.shard_bytes") <= limit).alias("fits"))
        out = closed if out is None else out.unionByName(closed)
        start += STEP
        if leaves.where(F.col("leaf").isNull()).isEmpty():
            return out
        if start >= 3 * HASH_BITS:
            raise RuntimeError("rows with equal hashes of key, content and row number")
        pending = placed.where(F.col("leaf").isNull()).select(*carry, "bits")
        if start > STEP:  # few rows stay open after two rounds; cut the lineage
            pending = materialize(pending, "shard-open")


def write_shards(docs: DataFrame, path: str, limit: int = SHARD_BYTES) -> None:
    """The documents as Parquet, one folder per shard; each row once, in its own shard.

    The folders are ``shard=...``, or ``__shard=...`` for documents with a column
    ``shard`` of their own.  Rows are numbered and stored first, so that numbers mean the same rows later.
    """
    rows = materialize(
        docs.withColumn("__row", F.monotonically_increasing_id()), "shard-rows")
    name = "__shard" if "shard" in map(str.lower, docs.columns) else "shard"
    shards = assign_shards(rows.select("__row", "doc_id", "text"), limit, "__row").select(
        "__row", F.col("shard").alias(name))
    placed = rows.join(shards, "__row").drop("__row")
    placed.repartition(name).write.partitionBy(name).parquet(path)
