"""Conversation prefix trie: which conversations share their first turns, and what that saves.

A node is a distinct sequence of first turns.  Its identity is its depth and the
XOR of 120-bit hashes of (position, turn), so the nodes of a conversation are a
running XOR over its turns.  Positions and running XORs are distributed scans
(``running``): rows are range-partitioned by conversation and order, each task
scans its own, and what a conversation brings along from earlier tasks (one row
for each task at most) is added afterwards.  A conversation with very many turns
is thus spread over many tasks.

Subtree totals come from parallel tree contraction (``subtree_totals``): rounds
of compressing every unary chain (pointer doubling, so a chain of n nodes takes
log2 n joins) and raking every leaf, until nothing is left; then the contracted
nodes are expanded again, last round first.  A round leaves branching nodes
only, fewer than half of the leaves it met, so rounds are logarithmic too.  All
sums per parent are aggregates with map-side combine: a parent with very many
children is one row per task.

Defined cases: rows of a null conversation take no part; null turns come first;
rows of one conversation with equal turns go by a hash of role and text; null
role or text is empty; repeated rows are turns of their own; an empty table has
no node; other columns are not read.  ``%`` and ``-`` on negative ids are SQL's.
The digest of a node's ends is a hash of one long text, which only one task can
compute; the texts of the parts are joined by many tasks before.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from worklens.llm.common import materialize

#: Longest head that a conversation takes from another one.
MAX_HEAD = 5
#: Conversations that share a head: ids with the same number of hundreds.
FAMILY = 100
#: Ids of a node's ends that are joined into one text before hashing.
CHUNK_IDS = 50_000


# distributed scan --------------------------------------------------------------------------

def _segments(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each row's run of equal keys starts, and the starts."""
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return np.repeat(first, np.diff(np.concatenate([first, [len(keys)]]))), first


def running(df: DataFrame, key: str, order: Sequence[str | Column], xors: Sequence[str], n: str,
            name: str) -> DataFrame:
    """Each row with its number ``n`` within its key and the XORs up to it in place of ``xors``.

    ``key`` and ``xors`` are longs without nulls.  One range shuffle; the carries
    are at most one row per partition and hence broadcast.
    """
    kept = list(df.columns)
    schema = T.StructType([*df.schema.fields, T.StructField(n, T.LongType()),
                           T.StructField("run", T.LongType())])
    at_key, at_xor = kept.index(key), [kept.index(x) for x in xors]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, last, carry = TaskContext.get().partitionId(), None, [0] * (1 + len(xors))
        for b in batches:
            if not b.num_rows:
                continue
            keys = b.column(at_key).to_numpy(zero_copy_only=False)
            start, firsts = _segments(keys)
            goes_on = start == 0 if keys[0] == last else np.zeros(len(keys), bool)
            out = [np.arange(1, len(keys) + 1) - start + np.where(goes_on, carry[0], 0)]
            for k, i in enumerate(at_xor, 1):
                total = np.bitwise_xor.accumulate(b.column(i).to_numpy(zero_copy_only=False))
                before = np.concatenate([[0], total])[start]
                out.append(total ^ before ^ np.where(goes_on, carry[k], 0))
            last, carry = keys[-1], [int(x[-1]) for x in out]
            cols = list(b.columns)
            for i, x in zip(at_xor, out[1:], strict=True):
                cols[i] = pa.array(x, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(out[0], pa.int64()), pa.array(np.full(len(keys), task), pa.int64())],
                names=[*kept, n, "run"])

    ordered = df.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    scanned = materialize(ordered.mapInArrow(scan, schema), name)
    # Only the first key of a partition can have begun in an earlier one.
    spread = scanned.groupBy("run").agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
    edges = spread.select(F.explode(F.array_distinct(F.array("lo", "hi"))).alias(key), "run")
    edges = edges.groupBy(key).agg(F.collect_set("run").alias("runs")).where(F.size("runs") > 1)
    sums = (scanned.join(F.broadcast(edges.select(key)), key, "left_semi")
            .groupBy(key, "run").agg(F.max(n).alias("c_n"),
                                     *[F.max_by(x, n).alias(f"c_{x}") for x in xors]))
    later = sums.select(F.col(key).alias("c_key"), F.col("run").alias("c_run"), "c_n",
                        *[f"c_{x}" for x in xors])
    pairs = F.broadcast(edges.select(F.col(key).alias("e_key"), F.explode("runs").alias("e_run")))
    carried = (later.join(pairs, (F.col("c_key") == F.col("e_key")) & (F.col("c_run") < F.col("e_run")))
               .groupBy("e_key", "e_run").agg(F.sum("c_n").alias("c_n"),
                                              *[F.bit_xor(f"c_{x}").alias(f"c_{x}") for x in xors]))
    joined = scanned.join(F.broadcast(carried), (F.col(key) == F.col("e_key"))
                          & (F.col("run") == F.col("e_run")), "left")
    zero = F.lit(0).cast("long")
    new = {n: F.col(n) + F.coalesce("c_n", zero),
           **{x: F.col(x).bitwiseXOR(F.coalesce(f"c_{x}", zero)) for x in xors}}
    return joined.select(*[new.get(c, F.col(c)).alias(c) for c in [*kept, n]])


# tree contraction --------------------------------------------------------------------------

def subtree_totals(tree: DataFrame, values: Sequence[str], rounds: list | None = None) -> DataFrame:
    """(node, values): each value summed over the node's subtree.

    ``tree`` has node (long, all different), parent (null: a root) and the
    values (long).  ``rounds`` collects what each round did: chain steps.
    """
    edge = [f"edge_{v}" for v in values]
    zero = F.lit(0).cast("long")
    live = tree.select("node", "parent", *values, *[zero.alias(e) for e in edge])
    expansions, raked, r = [], [], 0
    while True:
        # What each parent has left below it; a hot parent is one row per task.
        below = live.where("parent is not null").groupBy(F.col("parent").alias("up")).agg(
            F.count("*").alias("kids"), F.min("node").alias("child"),
            *[F.sum(e).alias(f"sum_{e}") for e in edge])
        view = materialize(live.join(below, F.col("node") == F.col("up"), "left").drop("up"),
                           f"trie-live-{r}")
        if view.isEmpty():
            break
        links, steps = _compress(view.where("kids = 1"), values, r)
        expansions.append(links)
        top = links.groupBy(F.col("next").alias("bottom")).agg(
            F.max_by(F.struct("parent", *[(F.col(v) + F.col(e)).alias(v)
                                          for v, e in zip(values, edge, strict=True)]), "steps").alias("top"))
        rest = view.where("kids is null or kids > 1").join(
            top, F.col("node") == F.col("bottom"), "left")
        moved = F.col("bottom").isNotNull()
        rest = rest.select(
            "node", "kids", F.when(moved, F.col("top.parent")).otherwise(F.col("parent")).alias("parent"),
            *values, *[F.when(moved, F.col(f"top.{v}")).otherwise(F.col(e)).alias(e)
                       for v, e in zip(values, edge, strict=True)])
        rest = materialize(rest, f"trie-rest-{r}")
        leaves = rest.where("kids is null")
        raked.append(leaves.select("node", *values))
        gifts = leaves.where("parent is not null").groupBy(F.col("parent").alias("up")).agg(
            *[F.sum(F.col(v) + F.col(e)).alias(f"gift_{v}") for v, e in zip(values, edge, strict=True)])
        live = rest.where("kids > 1").join(gifts, F.col("node") == F.col("up"), "left").select(
            "node", "parent", *[(F.col(v) + F.coalesce(f"gift_{v}", zero)).alias(v) for v in values],
            *edge)
        if rounds is not None:
            rounds.append(steps)
        r += 1
    if not raked:
        return tree.select("node", *values)
    totals = None
    for r in range(len(raked) - 1, -1, -1):
        totals = raked[r] if totals is None else totals.unionByName(raked[r])
        found = totals.select(F.col("node").alias("bottom"), *[F.col(v).alias(f"of_{v}") for v in values])
        grown = expansions[r].join(found, F.col("next") == F.col("bottom")).select(
            "node", *[(F.col(v) + F.col(f"of_{v}")).alias(v) for v in values])
        totals = totals.unionByName(materialize(grown, f"trie-grown-{r}"))
    return totals


def _compress(unary: DataFrame, values: Sequence[str], r: int) -> tuple[DataFrame, int]:
    """(node, parent, edges, next, steps, values) of each unary node, ``next`` the end of its chain.

    The values are summed from the node down to the end, which is left out; the
    edges are what lies between the node and its parent.  No two open nodes have
    the same ``next``, so each doubling joins row to row.
    """
    edge = [f"edge_{v}" for v in values]
    links = unary.select(
        "node", "parent", *edge, F.col("child").alias("next"), F.lit(1).cast("long").alias("steps"),
        *[(F.col(v) + F.col(f"sum_edge_{v}")).alias(v) for v in values], F.lit(False).alias("done"))
    n = 0
    while True:
        onward = links.select(
            F.col("node").alias("at"), F.col("next").alias("to"), F.col("steps").alias("more"),
            F.col("done").alias("ends"), *[F.col(v).alias(f"to_{v}") for v in values])
        went = F.col("at").isNotNull()
        jumped = links.where(~F.col("done")).join(onward, F.col("next") == F.col("at"), "left").select(
            "node", "parent", *edge, F.coalesce("to", "next").alias("next"),
            (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
            *[(F.col(v) + F.coalesce(f"to_{v}", F.lit(0))).alias(v) for v in values],
            F.when(went, F.col("ends")).otherwise(F.lit(True)).alias("done"))
        links = materialize(links.where("done").unionByName(jumped), f"trie-chain-{r}-{n}")
        n += 1
        if links.where(~F.col("done")).isEmpty():
            return links, n


# conversations -----------------------------------------------------------------------------

def head_length(conv_id: Column) -> Column:
    """How many turns a conversation takes from the first one of its family."""
    return F.crc32(conv_id.cast("string").cast("binary")) % (MAX_HEAD + 1)


def _lane(digest: Column, at: int) -> Column:
    """60 bits of a hexadecimal digest."""
    return F.conv(F.substring(digest, at, 15), 16, 10).cast("long")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, pos, digest, chars) of the rebuilt conversations, and (conv_id, total) of all."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("digest"),
        F.length(text).cast("long").alias("chars"))
    placed = materialize(running(turns, "conv_id", ["turn", "digest"], [], "n", "trie-order")
                         .drop("turn"), "trie-turns")
    convs = placed.groupBy("conv_id").agg(F.max("n").alias("n_turns"))
    convs = convs.withColumn("h", head_length(F.col("conv_id"))).withColumn(
        "first", F.col("conv_id") - F.col("conv_id") % FAMILY)
    lengths = convs.where("conv_id = first").select(
        F.col("conv_id").alias("of"), F.least("n_turns", F.lit(MAX_HEAD).cast("long")).alias("has"))
    cut = F.least("h", F.coalesce("has", F.lit(0).cast("long")))
    convs = convs.join(lengths, F.col("first") == F.col("of"), "left").withColumn("cut", cut)
    heads = placed.where(f"n <= {MAX_HEAD} and conv_id % {FAMILY} = 0").select(
        F.col("conv_id").alias("of"), F.col("n").alias("pos"), "digest", "chars")
    taken = convs.drop("of").join(heads, (F.col("first") == F.col("of")) & (F.col("pos") <= F.col("h")))
    own = placed.withColumn("h", head_length(F.col("conv_id"))).where("n > h").withColumn(
        "first", F.col("conv_id") - F.col("conv_id") % FAMILY)
    own = own.join(lengths, F.col("first") == F.col("of"), "left").withColumn(
        "pos", F.col("n") - F.col("h") + cut)
    cols = ["conv_id", "pos", "digest", "chars"]
    total = F.col("cut") + F.greatest(F.col("n_turns") - F.col("h"), F.lit(0).cast("long"))
    return (taken.select(*cols).unionByName(own.select(*cols)),
            convs.select("conv_id", total.alias("total")))


def ends_digest(ends: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key, ends_sha256): SHA-256 of each key's conv_ids in order, comma-joined."""
    fields = ", ".join(f"{k} long" for k in key)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids = None, []

        def out():
            row = [*at, ids[0], ",".join(map(str, ids))]
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=[*key, "lo", "ids"])

        for b in batches:
            *ks, convs = (c.to_pylist() for c in b.columns)
            for k, c in zip(zip(*ks), convs, strict=True):
                if k != at or len(ids) >= CHUNK_IDS:
                    if ids:
                        yield out()
                    at, ids = k, []
                ids.append(c)
        if ids:
            yield out()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sha, rows = None, None, []

        def out(rows):
            *ks, hexes = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (*ks, hexes)],
                                              names=[*key, "ends_sha256"])

        for b in batches:
            *ks, _, texts = (c.to_pylist() for c in b.columns)
            for k, t in zip(zip(*ks), texts, strict=True):
                if k == at:
                    sha.update(b"," + t.encode())
                else:
                    if at is not None:
                        rows.append((*at, sha.hexdigest()))
                    at, sha = k, hashlib.sha256(t.encode())
            if len(rows) >= 1000:
                yield out(rows)
                rows = []
        if at is not None:
            yield out([*rows, (*at, sha.hexdigest())])

    order = [*key, "conv_id"]
    parts = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        chunks, f"{fields}, lo long, ids string")
    return parts.repartition(*key).sortWithinPartitions(*key, "lo").mapInArrow(
        digests, f"{fields}, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """A row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    turns, totals = rebuilt(conversations)
    totals = materialize(totals, "trie-convs")
    spot = F.md5(F.concat(F.col("pos").cast("string"), F.lit(":"), F.col("digest")).cast("binary"))
    turns = turns.withColumn("spot", spot).select(
        "conv_id", "pos", "chars", _lane(F.col("spot"), 1).alias("s1"), _lane(F.col("spot"), 16).alias("s2"),
        _lane(F.col("spot"), 1).alias("x1"), _lane(F.col("spot"), 16).alias("x2"))
    # Key of a node: its depth and the XORs up to it; of its parent: without its last turn.
    members = materialize(running(turns, "conv_id", ["pos"], ["x1", "x2"], "n", "trie-scan").select(
        "conv_id", F.col("pos").alias("depth"), "chars", "x1", "x2",
        F.col("x1").bitwiseXOR(F.col("s1")).alias("p1"), F.col("x2").bitwiseXOR(F.col("s2")).alias("p2")),
        "trie-members")
    grouped = members.groupBy("depth", "x1", "x2").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("chars").alias("chars"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2"))
    zero = F.lit(0).cast("long")
    root = totals.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where(
        "conv_id is not null").select(*[zero.alias(c) for c in ("depth", "x1", "x2")], "conv_id", "n_convs",
                                      *[zero.alias(c) for c in ("chars", "p1", "p2")])
    nodes = materialize(grouped.unionByName(root).withColumn("node", F.monotonically_increasing_id()),
                        "trie-nodes")
    up = nodes.select((F.col("depth") + 1).alias("depth"), F.col("x1").alias("p1"),
                      F.col("x2").alias("p2"), F.col("node").alias("parent"),
                      F.col("conv_id").alias("parent_conv_id"))
    tree = nodes.join(up, ["depth", "p1", "p2"], "left")
    kids = tree.where("parent is not null").groupBy(F.col("parent").alias("of")).agg(
        F.count("*").alias("n_children"))
    tree = materialize(tree.join(kids, F.col("node") == F.col("of"), "left").select(
        "node", "parent", "conv_id", "depth", "x1", "x2", "parent_conv_id", "n_convs",
        F.coalesce("n_children", zero).alias("n_children"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("own_saved")), "trie-tree")
    sums = subtree_totals(tree.select(
        "node", "parent", F.col("own_saved").alias("saved_tokens"),
        (F.col("n_children") == 0).cast("long").alias("n_leaves")), ["n_leaves", "saved_tokens"])
    last = totals.where("total > 0").join(
        members.select("conv_id", F.col("depth").alias("total"), "x1", "x2"), ["conv_id", "total"])
    ends = last.select(F.col("total").alias("depth"), "x1", "x2", "conv_id").unionByName(
        totals.where("total = 0").select(*[zero.alias(c) for c in ("depth", "x1", "x2")], "conv_id"))
    shas = ends_digest(ends, ["depth", "x1", "x2"])
    return (tree.join(sums, "node").join(shas, ["depth", "x1", "x2"], "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                    "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256")))
