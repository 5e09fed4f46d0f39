"""Approximate nearest neighbours by cosine over balanced posting lists.

* Centroids come from k-means over a bounded sample of the vectors
  (``SAMPLE_PER_LIST`` per list, at most ``MAX_LISTS`` lists), and are searched
  through an in-memory neighbour graph by best-first search.
* Every vector goes to the posting list of its nearest centroid; a boundary
  vector is replicated to further lists whose centroid is within
  ``1 + REPLICATE`` of that distance.
* A query probes the lists within ``1 + PROBE`` of its nearest centroid's
  distance: one list where it is clear, many where all are about as far.
* Long lists are split into sub-lists of about ``SUBLIST`` vectors, which keeps
  the groups that are searched balanced; probes go to each sub-list.

Equal vectors are one index entry: of each distinct vector only the ids that
can ever appear in a result (the ``k + 1`` smallest) are kept, found with a
partial limit before the shuffle.  Equal queries are searched once.  A query that found fewer than ``k`` ids is
run again over all lists.

Defined cases: vectors that are null, empty, zero, or hold a null or non-finite
component take no part, nor do vectors of another dimension than the most
frequent one; ties in score go to the smaller id; repeated rows of one id and
vector count once; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from worklens.llm.common import materialize

MAX_LISTS, LIST_SIZE, SAMPLE_PER_LIST, KMEANS_ROUNDS = 8192, 256, 24, 8
REPLICATE, PROBE, SUBLIST = 0.05, 0.19, 2048
DEGREE, BEAM = 24, 64


def usable(embeddings: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, v (array<double>) of the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    rows = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.coalesce(finite, F.lit(False)) & F.exists("v", lambda x: x != 0))


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """rep_id, ids (the ``keep`` smallest of that vector), v."""
    key = Window.partitionBy("v").orderBy("vec_id")
    few = rows.dropDuplicates(["vec_id", "v"]).withColumn("rn", F.row_number().over(key)).where(
        F.col("rn") <= keep)
    return few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(
        F.element_at("ids", 1).alias("rep_id"), "ids", "v")


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class CentroidGraph:
    """Unit centroids with a neighbour graph; ``near`` walks it best first."""

    def __init__(self, sample: np.ndarray, lists: int, seed: int = 5):
        x, rng = unit(sample), np.random.default_rng(seed)
        c = x[rng.choice(len(x), lists, replace=False)]
        for _ in range(KMEANS_ROUNDS):
            own = np.concatenate([(x[i:i + 4096] @ c.T).argmax(1) for i in range(0, len(x), 4096)])
            sums = np.zeros_like(c)
            np.add.at(sums, own, x)
            size = np.bincount(own, minlength=lists)
            empty = (size == 0) | (np.abs(sums).max(1) < 1e-12)
            sums[empty] = x[rng.choice(len(x), int(empty.sum()))]
            c = unit(sums)
        self.c = c.astype(np.float32)
        links = [set() for _ in range(lists)]
        for i in range(0, lists, 1024):
            sims = self.c[i:i + 1024] @ self.c.T
            for j, row in enumerate(np.argsort(-sims, axis=1)[:, 1:DEGREE + 1]):
                for n in row.tolist():
                    links[i + j].add(n)
                    links[n].add(i + j)
        for j in range(lists):  # a few long links keep the graph in one piece
            for n in ((j + 1) % lists, int(rng.integers(lists))):
                links[j].add(n)
                links[n].add(j)
        self.links = [np.array(sorted(s - {j}), np.int64) for j, s in enumerate(links)]

    def near(self, v: np.ndarray, ratio: float) -> list[int]:
        """Lists whose centroid lies within (1 + ratio) of the nearest one's distance.

        The walk goes on while it finds centroids within that ratio, so the
        number of lists follows the data, not a fixed beam.
        """
        seen = np.zeros(len(self.c), bool)
        frontier, found, best = [], {}, float("inf")
        start = [0]
        while True:
            if start:
                ids = np.array(start, np.int64)
                seen[ids] = True
                for i, d in zip(start, np.sqrt(np.maximum(
                        0, 2 - 2 * (self.c[ids] @ v))).tolist(), strict=True):
                    found[i] = d
                    best = min(best, d)
                    heapq.heappush(frontier, (d, i))
            if not frontier:
                break
            d, i = heapq.heappop(frontier)
            if d > best * (1 + ratio) and len(found) >= BEAM * 2:
                break
            nxt = self.links[i]
            start = nxt[~seen[nxt]].tolist()
        return sorted(i for i, d in found.items() if d <= best * (1 + ratio) + 1e-6)


def route(rows: DataFrame, graph, ratio: float, id_col: str) -> DataFrame:
    """id, v, lists: the lists of each vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = graph.value
        for b in batches:
            x = unit(np.array(b.column(1).to_pylist(), float)) if b.num_rows else []
            near = [g.near(v.astype(np.float32), ratio) for v in x]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(near, pa.list_(pa.int32()))],
                names=["id", "v", "lists"])
    return rows.select(F.col(id_col).alias("id"), "v").mapInArrow(
        run, "id long, v array<double>, lists array<int>")


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings their largest component to [0.5, 1).

    Cosines stay the same to the bit, and neither tiny nor huge vectors leave the
    range of doubles when multiplied.
    """
    _, power = np.frexp(np.abs(x).max(axis=1))
    return np.ldexp(x, -power[:, None])


def search_lists(postings: DataFrame, probes: DataFrame, keep: int) -> DataFrame:
    """(query_id, rep_id, score): the best ``keep`` of each sub-list for each query."""
    def one(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            x, ids = scaled(np.array(left["v"].tolist())), left["id"].to_numpy()
            norm = np.linalg.norm(x, axis=1)
            for i in range(0, len(right), 512):
                part = right.iloc[i:i + 512]
                q = scaled(np.array(part["v"].tolist()))
                s = (q @ x.T) / (np.linalg.norm(q, axis=1)[:, None] * norm)
                for qid, row in zip(part["id"], s, strict=True):
                    if len(row) > keep:  # all that tie with the last one stay
                        top = np.flatnonzero(row >= np.partition(row, -keep)[-keep])
                    else:
                        top = np.arange(len(row))
                    top = top[np.lexsort((ids[top], -row[top]))][:keep]
                    out += [(qid, ids[t], row[t]) for t in top]
        return pd.DataFrame(out, columns=["query_id", "rep_id", "score"]).astype(
            {"query_id": "int64", "rep_id": "int64", "score": "float64"})

    return postings.groupBy("list", "sub").cogroup(probes.groupBy("list", "sub")).applyInPandas(
        one, "query_id long, rep_id long, score double")


def top_ids(hits: DataFrame, reps: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found, ties to smaller ids.

    ``asked`` (query_id, asked_as) names the query whose equal vector was searched.
    """
    def by(key, then):
        return Window.partitionBy(key).orderBy(F.desc("score"), then)

    best = hits.groupBy("query_id", "rep_id").agg(F.max("score").alias("score"))
    best = best.withColumn("n", F.row_number().over(by("query_id", "rep_id"))).where(
        F.col("n") <= k + 1)
    ids = best.join(reps.select("rep_id", "ids"), "rep_id").select(
        F.col("query_id").alias("asked_as"), "score", F.explode("ids").alias("vec_id"))
    # one more than k, as each query leaves itself out
    ids = ids.withColumn("n", F.row_number().over(by("asked_as", "vec_id"))).where(
        F.col("n") <= k + 1)
    each = ids.join(asked, "asked_as").where("vec_id <> query_id")
    ranked = each.withColumn("rank", F.row_number().over(by("query_id", "vec_id"))).where(
        F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def nearest(embeddings: DataFrame, k: int = 5, query_every: int = 50, id_col: str = "vec_id",
            vector_col: str = "embedding", replicate: float = REPLICATE,
            probe: float = PROBE) -> DataFrame:
    """The k nearest rows of every row whose id is divisible by ``query_every``."""
    spark = embeddings.sparkSession
    rows = usable(embeddings, id_col, vector_col)
    dims = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if dims is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("v") == dims["d"])
    reps = materialize(distinct_vectors(rows, k + 1), "ann-vectors")
    n = reps.count()
    lists = max(1, min(MAX_LISTS, n // LIST_SIZE))
    sample = reps.orderBy(F.xxhash64("rep_id"), "rep_id").limit(
        SAMPLE_PER_LIST * max(lists, 64)).select("v").toArrow()  # bounded by MAX_LISTS
    x = np.array(sample["v"].to_pylist(), float)
    graph = spark.sparkContext.broadcast(CentroidGraph(x, min(lists, len(x))))

    listed = route(reps, graph, replicate, "rep_id").select(
        "id", "v", F.explode("lists").alias("list"))
    postings = materialize(listed, "ann-postings")
    sizes = postings.groupBy("list").agg(  # one row per list: at most MAX_LISTS
        F.ceil(F.count("*") / SUBLIST).cast("int").alias("subs"))
    sizes = materialize(sizes, "ann-lists")
    bounded = F.broadcast(sizes)
    postings = postings.join(bounded, "list").withColumn(
        "sub", F.pmod(F.xxhash64("id"), F.col("subs")).cast("int"))
    # equal query vectors are searched once, as the smallest id among them
    each = rows.where(F.col("vec_id") % query_every == 0).groupBy("vec_id").agg(
        F.min("v").alias("v"))
    queries = materialize(each.groupBy("v").agg(F.min("vec_id").alias("vec_id")), "ann-queries")
    asked = materialize(each.join(queries.withColumnRenamed("vec_id", "asked_as"), "v").select(
        F.col("vec_id").alias("query_id"), "asked_as"), "ann-asked")

    def found(probes: DataFrame) -> DataFrame:
        probes = probes.join(bounded, "list").withColumn(
            "sub", F.explode(F.sequence(F.lit(0), F.col("subs") - 1)))
        return top_ids(search_lists(postings, probes.select("id", "v", "list", "sub"), k + 1),
                       reps, asked, k)

    first = materialize(found(route(queries, graph, probe, "vec_id").select(
        "id", "v", F.explode("lists").alias("list"))), "ann-found")
    short = asked.join(first.where(F.col("rank") == k).select("query_id"), "query_id", "left_anti")
    if short.isEmpty():
        return first
    every = F.explode(F.sequence(F.lit(0), F.lit(graph.value.c.shape[0] - 1)))
    lacking = queries.join(short.select(F.col("asked_as").alias("vec_id")).distinct(), "vec_id")
    again = found(lacking.select(F.col("vec_id").alias("id"), "v", every.alias("list"))).join(
        short.select("query_id"), "query_id", "left_semi")
    done = first.join(short.select("query_id"), "query_id", "left_anti")
    return done.unionByName(again)
