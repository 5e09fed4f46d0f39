"""N-gram Jaccard join: all links of similar documents, as components.

Documents are sets of hashed word shingles.  For sets, the size of the
symmetric difference is a metric, and a Jaccard similarity of at least t means
``difference <= (1 - t) / (1 + t) * (|x| + |y|)``.

Regions.  Voronoi regions of Jaccard distances to single pivots are no use at
the top: unrelated texts all have distance 1 to any pivot, so the windows of
the triangle inequality replicate every document to every region (measured in
the README).  The first level therefore splits the shingle space instead: by a
hash into more cells than the largest difference T of linked sets in a size
band, so that linked sets agree in whole cells.  A region is all documents of
a band with equal content of one cell; a document whose size reaches into the
next band is replicated there.  Linked sets agree in all but T of a band's
cells, so it is enough to emit the first T + 1 cells in an order that depends
on a cell's content alone: those with a rare shingle first, empty ones last.
Frequencies are read off a bounded sample of distinct sets (``SAMPLE``
documents, the ``COMMON`` most frequent shingles); they move work, not results.

Inside the regions:

1. Each document is compared with the pivot (smallest id) it shares most cells
   with; exact intersections decide, and links form components.
2. The regions of one pivot are one place: its documents are joined there if they
   still are of several components.  Each document comes with the 32-bit halves of
   its hashes, whose common elements are never fewer than those of the sets.  Pivots
   make Voronoi regions recursively in the space of cell counts, whose L1 distance
   never exceeds the symmetric difference; boundary documents are replicated by the
   triangle inequality's window, documents whose regions would not halve their pairs and small
   regions are compared outright, and a pair of
   different components that is within reach is compared by its halves at once.  A
   pair that passes joins the two components, so at most one link fewer than
   documents leaves a place, however alike its documents are.  A place above
   ``BLOCK_BYTES`` is dealt out as pairs of blocks.
3. These links are verified by exact intersections.  Should one fail (two hashes
   with equal halves), the pairs that it stood for are passed on one by one.

Every linked pair shares a region, so it is either inside one component after
step 1 or met by step 2: no link between different sets is lost.
Documents with equal sets are one class beforehand and are represented by the
smallest id.  Results are exact up to collisions of 64-bit shingle hashes.

Ids that several rows share (with whatever texts) do not name a set: rows then get
numbers of their own (stored once, so that they stay), are linked by number, and
the rows of one id belong to one component; ``one_of_each`` judges them apart.

Defined cases: a text with fewer words than a shingle is one shingle of all of
them; null or blank text is an empty set, linked with nothing; repeated rows
are copies; ids decide ties; rows with a null doc_id are counted on their own
and are their own component (null); an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from worklens.llm.common import (components, frugal, hashed_texts, materialize, mix, powers, restrict,
                                 signed)

BAND_RATIO, COUNTS, LEAF = 1.25, 64, 256
#: Bytes of hash halves in a block; a task holds two blocks.
BLOCK_BYTES = 4 << 20
#: SPARE: cells beyond T + 1, as a part of T, among which the order chooses.
SAMPLE, COMMON, SPARE = 20_000, 1 << 20, 0.3


def shingles(h: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles of a text, given its words' hashes."""
    if not len(h):
        return h
    n = max(1, len(h) - k + 1)
    k = min(k, len(h))
    up = powers(k + 1)[0]
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out += h[j:j + n] * up[j]
    return np.unique(mix(out, 31 + k))


class Bands:
    """Size bands and their numbers of cells for one threshold (in percent)."""

    def __init__(self, percent: int):
        self.percent = percent
        self.low, self.cells, self.reach = [1], [], []

    def _grow(self, size: int) -> None:
        while len(self.cells) < len(self.low) and (not self.cells or self.low[-1] <= size):
            low = self.low[-1]
            high = max(low, int(low * BAND_RATIO))
            reach = 2 * high * (100 - self.percent) // (100 + self.percent)
            cells = reach + 1 + int(SPARE * reach)
            self.cells.append(cells)
            self.reach.append(reach)
            self.low.append(high + 1)

    def of(self, size: int) -> list[tuple[int, int, int]]:
        """(band, cells, reach) a set of this size belongs to, skipping bands of equal sets."""
        self._grow(size * 100 // self.percent + 1)
        most = size * 100 // self.percent  # largest size of a linked set
        out = []
        for b, reach in enumerate(self.reach):
            if self.low[b + 1] > size and self.low[b] <= most and reach > 0:
                out.append((b, self.cells[b], reach))
        return out


@lru_cache(maxsize=4)
def bands(percent: int) -> Bands:
    return Bands(percent)


def cell_keys(s: np.ndarray, percent: int, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Keys of the regions of a set; ``common``: sorted frequent shingles, their frequencies."""
    keys, scrambled, parts = [], mix(s, 41), mix(s, 43)
    often = np.zeros(len(s), np.int64)
    if len(common[0]):
        i = np.minimum(np.searchsorted(common[0], s), len(common[0]) - 1)
        often = np.where(common[0][i] == s, common[1][i], 0)
    for band, cells, reach in bands(percent).of(len(s)):
        part = (parts % np.uint64(cells)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        size = np.bincount(part, minlength=cells)
        full = np.flatnonzero(size)
        begin = (np.cumsum(size) - size)[full]
        content, rarest = np.zeros(cells, np.uint64), np.full(cells, 2**62)
        content[full] = np.add.reduceat(scrambled[order], begin)
        rarest[full] = np.minimum.reduceat(often[order], begin)
        key = mix(content + mix(np.arange(cells).astype(np.uint64), 47 + band), 53)
        keys.append(key[np.lexsort((key, rarest))[:reach + 1]])
    return np.concatenate(keys) if keys else np.zeros(0, np.uint64)


def _scan(docs: DataFrame, schema: str, make) -> DataFrame:
    """One pass over the texts; ``make(ids, sets)`` gives the columns of a batch."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 2000):  # bounds the sets held at once
                part = b.slice(i, 2000)
                cols = make(part.column(0).to_pylist(), hashed_texts(part, "text", lower=True))
                if len(cols[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=names)
    return docs.mapInArrow(frugal(run), schema)


def describe(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n, f1, f2): size and 128-bit fingerprint of each set."""
    def make(ids, texts):
        n, f1, f2 = [], [], []
        for t in texts:
            s = shingles(t, k)
            n.append(len(s))
            f1.append(mix(s, 61).sum(dtype=np.uint64))
            f2.append(mix(s, 67).sum(dtype=np.uint64))
        return (pa.array(ids, pa.int64()), np.array(n, np.int64),
                signed(np.array(f1, np.uint64)), signed(np.array(f2, np.uint64)))
    return _scan(docs, "doc_id long, n long, f1 long, f2 long", make)


def common_shingles(docs: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles that two or more documents share, at most COMMON; how often."""
    def make(ids, texts):
        sets = [shingles(t, k) for t in texts]
        keys, n = np.unique(np.concatenate(sets), return_counts=True)
        return signed(keys), n.astype(np.int64)
    often = _scan(docs, "s long, n long", make).groupBy("s").agg(F.sum("n").alias("n")).where(
        "n > 1").orderBy(F.desc("n"), "s").limit(COMMON)
    got = often.toArrow()
    keys, n = (np.array(got[c].to_numpy()) for c in ("s", "n"))
    order = np.argsort(keys.view(np.uint64))
    return keys.view(np.uint64)[order], n[order]


def regions(docs: DataFrame, k: int, percent: int, common) -> DataFrame:
    """(key, doc_id): the regions of each document; equal sets of a batch give one row each."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def make(ids, texts):
        common = shared.value
        seen, keys, owner = set(), [], []
        for doc_id, t in sorted(zip(ids, texts, strict=True), key=lambda x: x[0]):
            s = shingles(t, k)
            if (print_ := s.tobytes()) in seen:
                continue
            seen.add(print_)
            key = cell_keys(s, percent, common)
            keys.append(key)
            owner.append(np.full(len(key), doc_id, np.int64))
        if not keys:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return signed(np.concatenate(keys)), np.concatenate(owner)
    return _scan(docs, "key long, doc_id long", make)


def shingle_sets(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, s): the sorted hashes of each set as bytes."""
    def make(ids, texts):
        return pa.array(ids, pa.int64()), [shingles(t, k).tobytes() for t in texts]
    return _scan(docs, "doc_id long, s binary", make)


def linked_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose exact similarity reaches the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3), strict=True):
                x, y = (np.frombuffer(v.as_py(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))
    left = sets.select(F.col("doc_id").alias("a"), F.col("s").alias("x"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("s").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(
        frugal(run), "a long, b long")


def _near(c: np.ndarray, n: np.ndarray, comp: np.ndarray, block: np.ndarray, lo: int, hi: int,
          percent: int, depth: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of different components whose counts allow a link; between blocks lo and hi."""
    share = (100 - percent) / (100 + percent)
    parts = []
    if len(n) > LEAF and depth < 4:
        pivots = np.linspace(0, len(n) - 1, 8).astype(int)
        d = np.stack([np.abs(c - c[p]).sum(axis=1) for p in pivots], axis=1)
        home = d.argmin(axis=1)
        window = 2 * share * 2 * n.max()  # twice the largest difference of a linked pair
        # boundary documents: this pivot is not farther than the nearest by more than the window
        near = d - d.min(axis=1, keepdims=True) <= window
        parts = [np.flatnonzero(near[:, r]) for r in np.unique(home)]
    # alike documents are near all pivots: regions that do not halve the pairs are not made
    if not parts or 2 * sum(len(at) ** 2 for at in parts) > len(n) ** 2:
        for i in range(len(n) - 1):
            j = np.arange(i + 1, len(n))
            j = j[(comp[j] != comp[i]) & ((lo == hi) | (block[j] != block[i]))]
            if len(j):
                j = j[np.abs(n[j] - n[i]) <= share * (n[j] + n[i])]
                j = j[np.abs(c[j] - c[i]).sum(axis=1) <= share * (n[j] + n[i])]
                yield np.full(len(j), i), j
        return
    for at in parts:
        for i, j in _near(c[at], n[at], comp[at], block[at], lo, hi, percent, depth + 1):
            yield at[i], at[j]


class Place:
    """Documents that meet in one task: their hash halves, and components that grow by links."""

    def __init__(self, comp: np.ndarray, halves: list[np.ndarray], percent: int):
        self.label = np.unique(comp, return_inverse=True)[1]
        self.n = np.array([len(h) for h in halves], np.int64)
        self.flat = np.concatenate(halves)
        self.at = np.cumsum(self.n) - self.n
        self.percent = percent
        self.tables: dict[int, np.ndarray] = {}

    def counts(self) -> np.ndarray:
        cell = np.repeat(np.arange(len(self.n)) * COUNTS, self.n) + self.flat % COUNTS
        return np.bincount(cell, minlength=len(self.n) * COUNTS).reshape(-1, COUNTS)

    def halves(self, i: int) -> np.ndarray:
        return self.flat[self.at[i]:self.at[i] + self.n[i]]

    def reaches(self, both: np.ndarray, i: int, j: np.ndarray) -> np.ndarray:
        return 100 * both >= self.percent * (self.n[i] + self.n[j] - both)

    def within(self, i: int, j: np.ndarray) -> np.ndarray:
        """The documents of ``j`` whose halves have enough in common with those of ``i``."""
        mine = self.halves(i)
        bits = int(np.clip(int(64 * len(mine)).bit_length(), 16, 24))
        table = self.tables.setdefault(bits, np.zeros(1 << bits, np.bool_))
        low = np.uint32((1 << bits) - 1)
        table[mine & low] = True
        out = []
        # some documents at a time, by the halves that are looked up at once
        for part in np.split(j, np.flatnonzero(np.diff(np.cumsum(self.n[j]) >> 20)) + 1):
            begin = np.cumsum(self.n[part]) - self.n[part]
            take = np.repeat(self.at[part] - begin, self.n[part]) + np.arange(self.n[part].sum())
            both = np.add.reduceat(table[self.flat[take] & low], begin, dtype=np.int64)
            out.append(part[self.reaches(both, i, part)])
        table[mine & low] = False
        return np.concatenate(out)

    def links(self, pairs: Iterator[tuple[np.ndarray, np.ndarray]], spanning: bool):
        """(i, j) within reach; if ``spanning`` only those that join two components."""
        for left, j in pairs:
            if not len(j):
                continue
            i = int(left[0])
            j = j[self.label[j] != self.label[i]]
            for k in self.within(i, j).tolist() if len(j) else ():
                if self.label[k] == self.label[i]:
                    continue
                both = np.isin(self.halves(k), self.halves(i)).sum()
                if self.reaches(both, i, k):
                    yield i, k
                    if spanning:
                        self.label[self.label == self.label[k]] = self.label[i]


def halves(sets: DataFrame) -> DataFrame:
    """(doc_id, h): the low halves of each set's hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = [np.frombuffer(s.as_buffer(), np.uint64).astype("<u4").tobytes() for s in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(h, pa.binary())],
                                             names=["doc_id", "h"])
    return sets.mapInArrow(frugal(run), "doc_id long, h binary")


def region_pairs(members: DataFrame, sets: DataFrame, percent: int,
                 spanning: bool = True) -> DataFrame:
    """Links (a, b) to verify, from (place, doc_id, n, component) and the sets.

    ``spanning``: of the links of a task only those that join two components.
    """
    place = members.groupBy("place").agg(
        F.ceil(F.sum("n") * 4 / BLOCK_BYTES).cast("int").alias("nb"),
        F.min("component").alias("lo"), F.max("component").alias("hi"))
    rows = members.join(place.where("lo < hi").select("place", "nb"), "place")
    rows = rows.join(halves(sets), "doc_id")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("nb")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    rows = rows.withColumn("lo", F.least("block", "other")).withColumn(
        "hi", F.greatest("block", "other"))

    # at most two blocks of BLOCK_BYTES (about, by hash) meet in a row
    groups = rows.groupBy("place", "lo", "hi").agg(F.collect_list(F.struct(
        "doc_id", "component", "block", "h")).alias("m")).where(F.size("m") > 1).select(
        "lo", "hi", "m")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r, (lo, hi) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(),
                                             strict=True)):
                m = b.column(2).slice(r, 1).flatten()
                ids, comp, block = (m.field(i).to_numpy(zero_copy_only=False) for i in range(3))
                here = Place(comp, [np.frombuffer(x.as_buffer(), "<u4") for x in m.field(3)], percent)
                found = list(here.links(_near(here.counts(), here.n, here.label.copy(), block,
                                              lo, hi, percent), spanning))
                if found:
                    i, j = (ids[list(x)] for x in zip(*found, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.minimum(i, j)), pa.array(np.maximum(i, j))], names=["a", "b"])

    return groups.mapInArrow(frugal(run), "a long, b long").distinct()


def has_repeated_ids(docs: DataFrame) -> bool:
    ids = docs.where("doc_id is not null").groupBy("doc_id").count()
    return not ids.where("count > 1").isEmpty()


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))


def link_components(docs: DataFrame, k: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles, component_id, one row per row of ``docs``."""
    texts = _texts(docs)
    if not has_repeated_ids(texts):
        return _link(texts, k, percent)
    rows = materialize(texts.withColumn("row", F.monotonically_increasing_id()), "jaccard-rows")
    linked = _link_rows(rows, "row", k, percent)
    names = linked.groupBy("component").agg(F.min("doc_id").alias("name"))
    linked = materialize(linked.join(names, "component"), "jaccard-named")
    edges = linked.where("doc_id <> name").select(
        F.col("doc_id").alias("a"), F.col("name").alias("b")).distinct()
    comp = components(materialize(edges, "jaccard-same-id"), "jaccard-same-id")
    out = linked.drop("component").join(comp, F.col("name") == F.col("node"), "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "name").alias("component_id"))
    alone = describe(rows.where("doc_id is null").select("doc_id", "text"), k)
    return out.unionByName(alone.select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def _link_rows(rows: DataFrame, row: str, k: int, percent: int) -> DataFrame:
    """(row, doc_id, n_shingles, component) of the rows with an id; the component is a row number."""
    known = rows.where("doc_id is not null")
    linked = _link(known.select(F.col(row).alias("doc_id"), F.col("text").cast("string").alias("text")),
                   k, percent)
    linked = linked.select(F.col("doc_id").alias("at"), "n_shingles", F.col("component_id").alias("component"))
    ids = known.select(F.col(row).alias("row"), F.col("doc_id").cast("long").alias("doc_id"))
    return materialize(ids.join(linked, F.col("row") == F.col("at")).drop("at"), "jaccard-by-row")


def one_of_each(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The rows of ``docs``, one per component: that of the smallest id.

    A component is of rows: of one id's rows those with unrelated texts all stay,
    and copies under one id are one.  Rows with a null doc_id stay.
    """
    if not has_repeated_ids(docs):
        linked = materialize(_link(_texts(docs), k, percent), "jaccard-near")
        gone = linked.where("doc_id <> component_id").select(F.col("doc_id").alias("__gone"))
        return docs.join(gone, F.col("doc_id").cast("long") == F.col("__gone"), "left_anti")
    rows = materialize(docs.withColumn("__row", F.monotonically_increasing_id()), "jaccard-rows")
    linked = _link_rows(rows, "__row", k, percent)
    stays = linked.groupBy("component").agg(
        F.min_by("row", F.struct("doc_id", "row")).alias("stays"))
    gone = linked.join(stays, "component").where("row <> stays").select(F.col("row").alias("__gone"))
    return rows.join(gone, F.col("__row") == F.col("__gone"), "left_anti").select(*docs.columns)


def _link(texts: DataFrame, k: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, component_id; the ids that are not null are all different."""
    info = materialize(describe(texts, k), "jaccard-sets")
    whole = info.where("doc_id is not null and n > 0")
    classes = whole.groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("rep"))
    member = materialize(whole.join(classes, ["f1", "f2", "n"]).select(
        "doc_id", "rep", "n"), "jaccard-classes")

    # regions with two documents or more, without copies
    reps_only = member.where("doc_id = rep").select("doc_id")
    part = SAMPLE / max(1, reps_only.count())
    drawn = reps_only.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(part * (1 << 30)))
    common = common_shingles(restrict(texts, materialize(drawn, "jaccard-sample")), k)
    cells = regions(texts.where("doc_id is not null"), k, percent, common)
    shared = cells.withColumn("g", F.count("*").over(Window.partitionBy("key"))).where("g > 1")
    copies = member.where("doc_id <> rep").select("doc_id").distinct()
    shared = materialize(shared.select("key", "doc_id").join(copies, "doc_id", "left_anti"),
                         "jaccard-regions")
    pivots = shared.groupBy("key").agg(F.min("doc_id").alias("pivot"), F.count("*").alias("g"))
    places = materialize(shared.join(pivots.where("g > 1"), "key").groupBy(
        "doc_id", F.col("pivot").alias("place")).agg(F.count("*").alias("cells")), "jaccard-places")
    first = places.where("doc_id <> place").groupBy("doc_id").agg(
        F.max_by("place", F.struct("cells", -F.col("place"))).alias("b"))
    first = materialize(first.select(F.col("doc_id").alias("a"), "b"), "jaccard-pivots")

    needed = places.select("doc_id").distinct()
    sets = materialize(shingle_sets(restrict(texts, materialize(needed, "jaccard-needed")), k)
                       .dropDuplicates(["doc_id"]), "jaccard-shingles")
    links = materialize(linked_pairs(first, sets, percent), "jaccard-links")
    comp = materialize(components(links, "jaccard-stars"), "jaccard-components")

    reps = member.where("doc_id = rep").select("doc_id", "n").dropDuplicates(["doc_id"])
    def more(spanning: bool) -> DataFrame:
        members = places.join(reps, "doc_id").join(
            comp, F.col("doc_id") == F.col("node"), "left").select(
            "place", "doc_id", "n", F.coalesce("component", "doc_id").alias("component"))
        return materialize(region_pairs(members, sets, percent, spanning), "jaccard-passed")

    passed = more(spanning=True)
    true = materialize(linked_pairs(passed, sets, percent), "jaccard-links")
    links = links.unionByName(true)
    comp = materialize(components(links, "jaccard-stars"), "jaccard-components")
    if passed.count() != true.count():  # a link that was none may have hidden others
        links = materialize(links.unionByName(
            linked_pairs(more(spanning=False), sets, percent)), "jaccard-links")
        comp = components(links, "jaccard-stars")

    named = member.select("doc_id", "rep").distinct().join(
        comp, F.col("rep") == F.col("node"), "left").select(
        "doc_id", F.coalesce("component", "rep").alias("component"))
    return info.join(named, "doc_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"))
