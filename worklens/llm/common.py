"""Helpers shared by the operators of this subpackage.

Words are maximal runs of characters other than space and U+0009..U+000D.  In
Python ``bytes.split()`` cuts at exactly those six characters, so a UTF-8 text
is split without a regular expression.
"""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import worklens
from worklens.sources.io import materialize  # noqa: F401  (re-used by the operators)

#: Java regular expression of the characters between words.
BLANKS = r"[\x20\x09-\x0D]+"
#: Words remembered per Python worker before its memo starts anew.
MEMO_WORDS = 400_000


def ship(spark: SparkSession) -> None:
    """Hand the package to the Python workers, unless they find it as this process does."""
    root = os.path.dirname(os.path.dirname(worklens.__path__[0] + "/"))
    sc = spark.sparkContext
    found = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(":")]
    if root in map(os.path.realpath, filter(None, found)) or getattr(sc, "_worklens_shipped", False):
        return
    sc.addPyFile(shutil.make_archive(tempfile.mkdtemp() + "/worklens", "zip", root, "worklens"))
    sc._worklens_shipped = True


#: Bytes of rows handed to a Python worker at once, see ``bound_batches``.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Hand texts to Python in batches of ``BATCH_BYTES``, unless the session has a size of its own.

    Executor and worker each hold whole batches of what goes in and comes out.
    """
    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.set(size, spark.conf.get(size, str(BATCH_BYTES)))


Batches = Iterator[pa.RecordBatch]


def frugal(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run``, with Arrow's free memory returned at the end: workers outlive their tasks."""
    def frugally(batches: Batches) -> Batches:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
    return frugally


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def word_array(text: Column) -> Column:
    """The words of a text as a JVM-side array; null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS), lambda w: w != "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also when lambdas refer to it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def utf8_column(batch: pa.RecordBatch, name: str) -> Iterator[bytes]:
    """The texts of a column as UTF-8 (null: empty), without decoding them."""
    col = batch.column(batch.schema.get_field_index(name))
    for v in col.cast(pa.binary()):
        yield v.as_py() or b""


def words_of(text: bytes, lower: bool = False) -> list[bytes]:
    """``bytes.lower`` changes A-Z only."""
    return text.lower().split() if lower else text.split()


class Memo(dict):
    """word -> value computed by ``make``; forgets everything beyond ``MEMO_WORDS``."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, word):
        if len(self) >= MEMO_WORDS:
            self.clear()
        value = self[word] = self.make(word)
        return value


_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 2**64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        for i, b in enumerate((_BASE, _UNBASE)):
            steps = np.full(n + n // 4, b, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers[0][:n], _powers[1][:n]


class RangeHash:
    """Polynomial hashes of any range of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray):
        self.up, down = powers(len(values) + 1)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * down[:-1])])

    def __call__(self, start: np.ndarray, length) -> np.ndarray:
        return (self.sums[start + length] - self.sums[start]) * self.up[start]


def hash_words(data: np.ndarray, at: np.ndarray, lower: bool = False):
    """64-bit hashes of the words of several texts, and where each text's words begin.

    ``data`` holds the texts' bytes one after the other, ``at`` where each
    begins and the end; no word reaches from one text into the next.
    """
    at = at - at[0]
    if lower:
        data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    word = (data != 32) & ((data < 9) | (data > 13))
    before, after = np.roll(word, 1), np.roll(word, -1)
    inner = at[at < len(data)]
    before[inner] = False
    after[inner - 1] = False  # at 0 this is the last byte, after which nothing follows
    start, end = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    size = (end - start).astype(np.uint64)
    h = RangeHash(data.astype(np.uint64) + np.uint64(1))(start, end - start) if len(start) else \
        np.zeros(0, np.uint64)
    return mix(h + size * np.uint64(0xD6E8FEB86659FD93), 7), np.searchsorted(start, at)


def hash_text(text: bytes, lower: bool = False) -> np.ndarray:
    """The hashes of the words of one text."""
    return hash_words(np.frombuffer(text, np.uint8), np.array([0, len(text)]), lower)[0]


def hashed_texts(batch: pa.RecordBatch, name: str, lower: bool = False,
                 chunk: int = 1 << 20) -> Iterator[np.ndarray]:
    """The word hashes of each text of a column (null: none), about ``chunk`` bytes at a time."""
    col = batch.column(batch.schema.get_field_index(name)).cast(pa.large_binary()).fill_null(b"")
    at = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2] or b"", np.uint8)
    i = 0
    while i < len(col):
        j = max(i + 1, int(np.searchsorted(at, at[i] + chunk)))
        j = min(j, len(col))
        h, begin = hash_words(data[at[i]:at[j]], at[i:j + 1], lower)
        for x, y in zip(begin[:-1], begin[1:]):
            yield h[x:y]
        i = j


def mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A bijective scramble of 64-bit values (xor-shift-multiply rounds)."""
    x = (x + np.uint64(seed & (2**64 - 1))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def record_batches(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


#: Ids (8 bytes each) up to which a semi-join broadcasts them instead of moving the texts.
BROADCAST_IDS = 2_000_000


def restrict(docs: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose key is among ``ids``; the ids are counted before a broadcast."""
    small = ids.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(ids) if small else ids, key, "left_semi")


#: Edges that a task contracts at once.
CHUNK_EDGES = 200_000


def local_stars(edges: DataFrame) -> DataFrame:
    """Edges (a, b) of the same components: a task joins the nodes of its edges to their smallest.

    ``CHUNK_EDGES`` at a time, so that what a task holds does not grow with its input.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict[int, int] = {}

        def find(x: int) -> int:
            while (y := up.setdefault(x, x)) != x:
                up[x] = x = up[y]
            return x

        def stars() -> pa.RecordBatch:
            moved = [(x, r) for x in list(up) if (r := find(x)) != x]
            up.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([m[i] for m in moved], pa.int64()) for i in (0, 1)], names=["a", "b"])

        n = 0
        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
            n += batch.num_rows
            if n >= CHUNK_EDGES:
                n = 0
                yield stars()
        yield stars()

    return edges.select("a", "b").mapInArrow(run, "a long, b long")


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node is on one side only and those on the left have one neighbour."""
    ends = edges.select(F.col("a").alias("x"), F.col("b").alias("to")).unionByName(
        edges.select(F.col("b").alias("x"), F.lit(None).cast("long").alias("to")))
    nodes = ends.groupBy("x").agg(F.min("to").alias("lo"), F.max("to").alias("hi"),
                                  F.bool_or(F.col("to").isNull()).alias("centre"))
    return nodes.where("lo <> hi or (lo is not null and centre)").isEmpty()


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, component): the smallest node reachable, for edges (a, b) between different nodes.

    Edges become stars within tasks, then two star contractions alternate with that until
    every component is one star; each contraction is a map-side minimum per node and an
    equi-join, so a node with very many edges is one row per task before the shuffle.
    """
    def contract(e: DataFrame, larger: bool) -> DataFrame:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        side = both if larger else both.where("b < a")
        least = side.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        if larger:
            moved = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), "m")
        else:
            moved = side.join(least, "a").select(F.col("b").alias("a"), "m").unionByName(
                least.select("a", "m"))
        return moved.where("a <> m").select("a", F.col("m").alias("b")).distinct()

    edges = materialize(local_stars(edges), name)
    while not _are_stars(edges):
        edges = materialize(local_stars(contract(contract(edges, True), False)), name)
    return edges.groupBy("a").agg(F.min("b").alias("component")).select(
        F.col("a").alias("node"), "component")
