"""Substring de-duplication on a compacted de Bruijn graph of token k-mers.

A window is ``span`` consecutive words.  A word goes when a window that covers
it also starts in a document with a smaller doc_id; windows are judged on the
input.  Nothing is cut before its words were compared, by a 128-bit digest of
their bytes, with those at the coordinates of the source.

* Edges are k-mers of words.  Of the k-mers inside a window only the one with
  the smallest scrambled hash represents it, so equal windows share an edge
  and about one position in twenty carries one.  Consecutive windows with the
  same edge form one path: hash of its words, place, number of windows and the
  edge that comes after it.
* Only edges of two documents or more go on.  An edge whose paths are all equal
  is straight.  A straight edge that is always followed by the same straight
  edge, as often as that one occurs, does not branch: such runs are compacted by
  joins that double the reach of each edge's pointer (``compact``), and only
  the first edge of a run is kept, with the windows of the whole run.  Every
  run's words are spelled from its source coordinates, the first document.
* Where paths branch, at the borders of shared passages, each distinct path is
  spelled out: its source coordinates fetch its words from the first document
  that has it, and its windows are compared with those of the other paths.

Sources are always reduced with map-side aggregates (smallest document per
edge, path or window) and no pairs are formed.  Where they are joined back to
the rows (``attach``), the keys that hold more than one row in ``HOT`` are at
most ``HOT`` and are broadcast, so a passage that a third of all documents
share never meets in one task.

Defined cases: null or short texts have no windows and lose nothing; windows
repeated only inside one document stay; of rows that share a doc_id each is cut
by its own text, and rows repeated in full are cut alike; rows with a null
doc_id keep all their words; an empty table gives an empty result; other
columns pass through untouched.  Texts of one id are told apart by a 32-bit
hash; where two of them agree in it, repeats of one may stay uncut.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worklens.llm.common import (BROADCAST_IDS, RangeHash, frugal, hashed_texts, materialize, mix,
                                 restrict, signed, utf8_column)

SPAN, K = 50, 12
#: Keys with more than one row in so many are joined by broadcast; there are at most so many.
HOT = 1024
#: Instead of the next edge, after the last path of a text; edges are odd.
NO_EDGE = 0


def paths(h: np.ndarray, span: int, k: int):
    """Arrays (edge, hash, first window, windows, next edge) of a text's paths."""
    n = len(h) - span + 1
    if n < 1:
        return None
    hashes = RangeHash(h)
    edges = mix(hashes(np.arange(len(h) - k + 1), k), 13) | np.uint64(1)
    view = np.lib.stride_tricks.sliding_window_view(edges, span - k + 1)
    at = np.arange(n) + view.argmin(axis=1)
    start = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    count = np.diff(np.append(start, n))
    edge = edges[at[start]]
    return (edge, mix(hashes(start, count + (span - 1)), 17), start, count,
            np.append(edge[1:], np.uint64(NO_EDGE)))


def path_rows(texts: DataFrame, span: int, k: int) -> DataFrame:
    """(edge, p, doc_id, place, windows, after) of every text, in one pass.

    ``place`` holds the text's key in its upper and the first word in its lower half.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = [[] for _ in range(6)]
            for doc_id, key, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist(),
                                      hashed_texts(b, "text"), strict=True):
                got = paths(h, span, k)
                if got is None:
                    continue
                e, p, start, count, after = got
                for c, v in zip(cols, (signed(e), signed(p), np.full(len(e), doc_id, np.int64),
                                       (key << 32) + start, count.astype(np.int32),
                                       signed(after)), strict=True):
                    c.append(v)
            if cols[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in cols],
                    names=["edge", "p", "doc_id", "place", "windows", "after"])
    return texts.mapInArrow(
        frugal(run), "edge long, p long, doc_id long, place long, windows int, after long")


def attach(rows: DataFrame, facts: DataFrame, keys: list[str], total: int,
           how: str = "inner") -> DataFrame:
    """``rows`` joined with ``facts``, which hold one row a key and in ``n`` how many rows have it.

    ``total`` is the sum of ``n``: at most ``HOT`` keys are broadcast, and no
    other key has more than one row in ``HOT``.  Facts must hold all hot keys of
    the rows, also those the caller drops afterwards.
    """
    hot = F.broadcast(facts.where(F.col("n") * HOT > total).drop("n"))
    cold = facts.where(F.col("n") * HOT <= total).drop("n")
    return rows.join(hot, keys).unionByName(
        rows.join(hot.select(*keys), keys, "left_anti").join(cold, keys, how))


def shared_paths(rows: DataFrame) -> tuple[DataFrame, int]:
    """Paths on edges of two documents or more, and how many there are."""
    edges = rows.groupBy("edge").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"),
                                     F.count("*").alias("n"))
    # an edge that one text alone holds often is hot, too
    edges = materialize(edges.where("n > 1").select(
        "edge", "n", (F.col("low") < F.col("high")).alias("shared")), "repeat-shared")
    total = edges.agg(F.sum("n")).first()[0] or 0
    return materialize(attach(rows, edges, ["edge"], total).where("shared").drop("shared"),
                       "repeat-paths"), total


def edge_facts(shared: DataFrame) -> DataFrame:
    """(edge, n, first, place, windows, after, straight): a row per edge.

    ``after`` is null unless all paths of the edge are followed by that edge.
    """
    facts = shared.groupBy("edge").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("first"),
        F.min_by("place", "doc_id").alias("place"), F.min("windows").alias("windows"),
        F.min("p").alias("low"), F.max("p").alias("high"),
        F.min("after").alias("after"), F.max("after").alias("last"))
    only = (F.col("after") == F.col("last")) & (F.col("after") != NO_EDGE)
    return materialize(facts.select(
        "edge", "n", "first", "place", "windows", F.when(only, F.col("after")).alias("after"),
        (F.col("low") == F.col("high")).alias("straight")), "repeat-edges")


def compact(facts: DataFrame) -> DataFrame:
    """(edge, n, first, place, windows): the nonbranching runs of straight edges, by their first edge.

    An edge that is always followed by another as often as that one occurs is its
    only predecessor, so wherever a run begins all of it follows.  Each round an
    edge's pointer takes over the pointer of the edge it points to, until it
    points to a first edge: a run of length l takes log2(l) rounds.
    """
    straight = facts.where("straight")
    # two edges as frequent as their common successor cannot be
    single = straight.where("after is not null").groupBy("after", "n").agg(
        F.min("edge").alias("up"), F.count("*").alias("c")).where("c = 1")
    moving = materialize(straight.select("edge", "n").join(
        single.select(F.col("after").alias("edge"), "n", "up"), ["edge", "n"]).select(
        "edge", "up"), "repeat-pointers")
    known, settled = moving.withColumn("ends", F.lit(False)), []
    while True:
        further = known.select(F.col("edge").alias("up"), F.col("up").alias("next"), "ends")
        # the pointers that still move point to different edges
        step = materialize(moving.join(further, "up", "left").select(
            "edge", F.coalesce("next", "up").alias("up"), F.coalesce("ends", F.lit(True)).alias(
                "ends")), "repeat-pointers")
        settled.append(step.where("ends"))
        moving = step.where("not ends").select("edge", "up")
        if moving.isEmpty():
            break
        known = reduce(DataFrame.unionByName, settled).unionByName(
            moving.withColumn("ends", F.lit(False)))
    ends = reduce(DataFrame.unionByName, settled).select("edge", "up")
    runs = straight.join(ends, "edge", "left").groupBy(F.coalesce("up", "edge").alias("edge")).agg(
        F.sum("windows").alias("windows"))
    return materialize(straight.drop("windows").join(runs, "edge").select(
        "edge", "n", "first", "place", "windows"), "repeat-runs")


def word_bytes(text: bytes) -> tuple[memoryview, np.ndarray]:
    """The words joined by one space, and where each of them begins there, with one place more."""
    words = text.split()
    at = np.zeros(len(words) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1, out=at[1:])
    return memoryview(b" ".join(words)), at


def digests(joined: memoryview, at: np.ndarray, start, size) -> np.ndarray:
    """Two 64-bit halves of the digest of each range of words; zeros for a range beyond the text."""
    start, end = np.asarray(start, np.int64), np.asarray(start, np.int64) + size
    inside = end < len(at)
    lo, hi = at[np.where(inside, start, 0)], at[np.where(inside, end, 0)] - 1
    empty = bytes(16)
    return np.frombuffer(b"".join(
        xxhash.xxh3_128_digest(joined[a:b]) if ok else empty
        for a, b, ok in zip(lo.tolist(), hi.tolist(), inside.tolist(), strict=True)),
        ">i8").reshape(-1, 2).astype(np.int64)


def spell(texts: DataFrame, sources: DataFrame, span: int) -> DataFrame:
    """(edge, p, first, nth, w1, w2): digests of words at source coordinates.

    ``sources`` are (edge, p, first, place, windows).  The digest of all words of
    a path or run has ``nth`` -1; where ``p`` is not null, each window follows.
    """
    key = F.shiftright("place", 32).cast("int")
    wanted = sources.groupBy("first", key.alias("key")).agg(F.collect_list(F.struct(
        "edge", "p", (F.col("place") - F.shiftleft(F.shiftright("place", 32), 32)).alias("start"),
        F.col("windows").cast("long"))).alias("wanted"))
    wanted = materialize(wanted, "repeat-wanted")
    # one text per source, as rows may be repeated
    source = restrict(texts, wanted.select(F.col("first").alias("doc_id")).distinct()).join(
        wanted.withColumnRenamed("first", "doc_id"), ["doc_id", "key"]).select(
        "doc_id", "key", "text", "wanted").dropDuplicates(["doc_id", "key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["edge", "p", "first", "nth", "w1", "w2"]
        for b in batches:
            wanted_rows = b.column(3)
            for i, (first, text) in enumerate(zip(
                    b.column(0).to_pylist(), utf8_column(b, "text"), strict=True)):
                joined, at = word_bytes(text)
                part = wanted_rows.slice(i, 1).flatten()
                edge, start, n = (part.field(j).to_numpy(zero_copy_only=False) for j in (0, 2, 3))
                path = part.field(1).is_valid().to_numpy(zero_copy_only=False)
                hashes = part.field(1).fill_null(0).to_numpy(zero_copy_only=False)
                times = np.where(path, n, 0)
                which = np.concatenate([np.arange(len(n)), np.repeat(np.arange(len(n)), times)])
                nth = np.concatenate([np.full(len(n), -1), *map(np.arange, times)]).astype(np.int32)
                w = digests(joined, at, start[which] + np.maximum(nth, 0),
                            np.where(nth < 0, n[which] + (span - 1), span))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(edge[which]), pa.array(hashes[which], mask=~path[which]),
                     pa.array(np.full(len(which), first, np.int64)), pa.array(nth),
                     pa.array(w[:, 0]), pa.array(w[:, 1])], names=names)
    return source.mapInArrow(
        frugal(run), "edge long, p long, first long, nth int, w1 long, w2 long")


def repeated_spans(texts: DataFrame, span: int = SPAN, k: int = K) -> DataFrame:
    """(doc_id, key, spans): ranges of words to remove, for texts that may have any.

    A span is (start, size, w1, w2, nth): if the ``size`` words from ``start`` on
    have that digest they go, or if ``nth`` is not null the windows it lists.
    ``texts`` are (doc_id, key, text).
    """
    shared, total = shared_paths(path_rows(texts, span, k))
    facts = edge_facts(shared)
    runs = compact(facts)

    # every edge takes part, or a hot one that is not asked for would meet in one task
    kinds = facts.select("edge", "n", "straight").join(
        runs.select("edge", F.lit(True).alias("head")), "edge", "left")
    rows = materialize(attach(shared.select("edge", "p", "doc_id", "place", "windows"), kinds,
                              ["edge"], total).where("head or not straight"), "repeat-branches")
    branching = rows.where("not straight")
    distinct = materialize(branching.groupBy("edge", "p", "windows").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("first"),
        F.min_by("place", "doc_id").alias("place")), "repeat-distinct")
    spelled = materialize(spell(texts, distinct.select(
        "edge", "p", "first", "place", "windows").unionByName(runs.select(
            "edge", F.lit(None).cast("long").alias("p"), "first", "place", "windows")), span),
        "repeat-windows")

    # runs: what comes after the first document goes whole
    digest = spelled.where("p is null").select("edge", "first", "w1", "w2")
    straight = attach(rows.where("straight").select("edge", "doc_id", "place"), runs.join(
        digest.drop("first"), "edge").select("edge", "n", "first", "windows", "w1", "w2"),
        ["edge"], total).where("doc_id > first").select(
        "doc_id", "place", (F.col("windows") + span - 1).cast("int").alias("size"), "w1", "w2",
        F.lit(None).cast("array<int>").alias("nth"))

    # paths that branch: each window goes by the first document that has it
    windows = spelled.where("nth >= 0")
    firsts = materialize(windows.groupBy("w1", "w2").agg(
        F.min("first").alias("seen"), F.count("*").alias("n")).where("n > 1"), "repeat-firsts")
    met = firsts.agg(F.sum("n")).first()[0] or 0
    # a window of one path alone is decided by the path's own first document
    known = attach(windows, firsts, ["w1", "w2"], met, "left").groupBy("edge", "p").agg(
        F.sort_array(F.collect_list(F.struct("nth", F.coalesce("seen", "first").alias("seen"))))
        .alias("at"))
    per_path = distinct.select("edge", "p", "n", "windows").join(known, ["edge", "p"]).join(
        spelled.where("p is not null and nth < 0").select("edge", "p", "w1", "w2"), ["edge", "p"])
    nth = F.transform(F.filter("at", lambda x: x["seen"] < F.col("doc_id")), lambda x: x["nth"])
    crossed = attach(branching.select("edge", "p", "doc_id", "place"),
                     materialize(per_path, "repeat-known"), ["edge", "p"], total).select(
        "doc_id", "place", (F.col("windows") + span - 1).cast("int").alias("size"), "w1", "w2",
        nth.alias("nth")).where(F.size("nth") > 0)

    start = F.col("place") - F.shiftleft(F.shiftright("place", 32), 32)
    return straight.unionByName(crossed).groupBy(
        "doc_id", F.shiftright("place", 32).cast("int").alias("key")).agg(F.collect_list(F.struct(
            start.cast("int").alias("start"), "size", "w1", "w2", "nth")).alias("spans"))


_WORD = re.compile(rb"[^ \t-\r]+[ \t-\r]*")
CUT = "n_words long, n_removed long, kept_sha256 string, kept_text string"


def cut_text(text: str | None, span: int = SPAN, starts=None, sizes=None, w1=None, w2=None,
             nth=None):
    """(words, removed, sha256 of the kept words, text without the ranges)."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    whole = len(words), 0, hashlib.sha256(b" ".join(words)).hexdigest(), text
    if starts is None or not len(starts):
        return whole
    starts, sizes = np.asarray(starts, np.int64), np.asarray(sizes, np.int64)
    found = digests(*word_bytes(raw), starts, sizes)
    good = (found[:, 0] == np.asarray(w1, np.int64)) & (found[:, 1] == np.asarray(w2, np.int64))
    gone = np.zeros(len(words) + 1, np.int64)
    for i in np.flatnonzero(good):
        if nth[i] is None:
            at, size = starts[i:i + 1], sizes[i]
        else:
            at, size = starts[i] + np.asarray(nth[i], np.int64), span
        np.add.at(gone, at, 1)
        np.subtract.at(gone, at + size, 1)
    keep = np.flatnonzero(np.cumsum(gone)[:-1] == 0)
    if len(keep) == len(words):
        return whole
    kept = b" ".join([words[i] for i in keep])
    pieces = _WORD.findall(raw)
    left = b"".join([pieces[i] for i in keep]).strip(b" \t\n\r\x0b\x0c")
    return (len(words), len(words) - len(keep), hashlib.sha256(kept).hexdigest(),
            left.decode("utf-8", "replace"))


def cut_repeats(docs: DataFrame, span: int = SPAN, k: int = K, into: str = "cut") -> DataFrame:
    """``docs`` with a struct column ``into``: n_words, n_removed, kept_sha256, kept_text."""
    text, doc_id = F.col("text").cast("string"), F.col("doc_id").cast("long")
    key = F.hash(text)
    spans = repeated_spans(docs.select(
        doc_id.alias("doc_id"), key.alias("key"), text.alias("text")).where(
        "doc_id is not null and text is not null"), span, k)
    # only the texts that lose words meet their ranges in a shuffle; the others stay in place
    spans = materialize(spans.select(
        F.col("doc_id").alias("__id"), F.col("key").alias("__key"),
        *[F.col(f"spans.{c}").alias(f"__{c}") for c in ("start", "size", "w1", "w2", "nth")]),
        "repeat-spans")
    kinds = [F.lit(None).cast(spans.schema[f"__{c}"].dataType).alias(f"__{c}")
             for c in ("start", "size", "w1", "w2", "nth")]

    @F.pandas_udf(CUT)
    def cut(text: pd.Series, starts: pd.Series, sizes: pd.Series, w1: pd.Series, w2: pd.Series,
            nth: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([cut_text(t, span, *x) for t, *x in zip(
            text, starts, sizes, w1, w2, nth, strict=True)],
            columns=[c.split()[0] for c in CUT.split(", ")])

    def result(rows: DataFrame) -> DataFrame:
        return rows.select(*docs.columns, cut(
            text, "__start", "__size", "__w1", "__w2", "__nth").alias(into))

    ids = spans.select("__id", "__key")
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    same = (doc_id == F.col("__id")) & (key == F.col("__key"))
    whole = docs.join(ids, same, "left_anti").select("*", *kinds)
    touched = docs.join(ids, same, "left_semi").join(spans, same)
    return result(whole).unionByName(result(touched))


def removed(docs: DataFrame, span: int = SPAN, k: int = K) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    cut = cut_repeats(docs.select("doc_id", "text"), span, k)
    return cut.select("doc_id", "cut.n_words", "cut.n_removed", "cut.kept_sha256")
