"""Quality classifier: an interpolated modified Kneser-Ney model of trusted text.

The model is over characters: each word, with start marks before it and an end
mark after it, is a sequence of ``ORDER``-grams, per language.  A document's
perplexity is that of all characters of all its words.  A document is kept if
its log perplexity is at most its language's threshold: the median over trusted
documents plus ``SPREAD`` times the distance from there to their ``HIGH``
quantile.  One trusted document in ``FOLDS``, by a hash of its id, sets the
thresholds and does not train, or they would be too tight for unseen text.

* Counts come from all other trusted documents.  A task counts its words, then
  their n-grams, so that only distinct n-grams per batch are shuffled.
* Continuation counts, discounts, context sums and the recursion from order 1
  to ``ORDER`` are aggregates and equi-joins on (lang, packed n-gram).
* The result is a table of log probabilities and back-off weights.  If its row
  count is at most ``BROADCAST_ROWS`` (12 bytes a row) it is broadcast and the
  texts are scored in one pass without a shuffle; beyond that, the distinct
  n-grams of each document are joined with it, shard by shard.

Characters are 12-bit symbols: code points below 3072 are themselves, the rest
fold into 1024 classes, so an n-gram is one 64-bit key and contexts and
suffixes are shifts and masks.

Perplexities of short texts are noisy; ``PRIOR_CHARS`` characters at the
language's mean log probability over trusted text are added to every document.

Defined cases: null or blank text has no characters, a null perplexity and is
kept; so is a language without trusted text; a null lang is a language of its
own; repeated rows count and are scored once per repetition; an empty table
gives an empty result; labels with a null quality are not trusted; other
columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from worklens.llm.common import MEMO_WORDS, frugal, materialize, restrict, utf8_column

ORDER, BITS = 5, 12
START, END = 1, 2
HIGH, SPREAD, FOLDS, PRIOR_CHARS = 0.95, 4.0, 5, 50
BROADCAST_ROWS = 6_000_000
#: Distinct words that a task counts before it passes their n-grams on.
COUNT_WORDS = 100_000


def symbols(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of the words, each with start and end marks, and the length of each."""
    text = b"\n".join(words).decode("utf-8", "replace") + "\n"
    cp = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
    ends = np.flatnonzero(cp == 10)
    size = np.diff(np.concatenate([[-1], ends]))  # characters and the end mark
    cp = np.where(cp < 3072, cp, 3072 + cp % 1024)
    cp[ends] = END
    pad = ORDER - 1
    out = np.full(len(cp) + pad * len(ends), START, np.int64)
    out[np.arange(len(cp)) + pad * (1 + np.repeat(np.arange(len(ends)), size))] = cp
    return out, size


def grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Packed n-grams that end at each character of the words, and how many each word has."""
    s, size = symbols(words)
    pad = ORDER - 1
    at = np.arange(int(size.sum())) + pad * (1 + np.repeat(np.arange(len(size)), size))
    packed = np.zeros(len(at), np.int64)
    for j in range(ORDER):
        packed = (packed << BITS) | s[at - pad + j]
    return packed, size


def count_grams(trusted: DataFrame) -> DataFrame:
    """(lang, g, c): counts of the highest order, a row per distinct n-gram and ``COUNT_WORDS`` first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = {}

        def counted() -> Iterator[pa.RecordBatch]:
            for lang, counter in words.items():
                if not counter:
                    continue
                g, size = grams(list(counter))
                weight = np.repeat(np.fromiter(counter.values(), np.int64, len(counter)), size)
                keys, inverse = np.unique(g, return_inverse=True)
                total = np.bincount(inverse, weights=weight).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys)), pa.array(keys), pa.array(total)],
                    names=["lang", "g", "c"])
            words.clear()

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), utf8_column(b, "text"), strict=True):
                words.setdefault(lang, Counter()).update(text.split())
            if sum(map(len, words.values())) >= COUNT_WORDS:
                yield from counted()
        yield from counted()
    return trusted.mapInArrow(frugal(run), "lang string, g long, c long").groupBy("lang", "g").agg(
        F.sum("c").alias("c"))


def discounts(table: DataFrame) -> DataFrame:
    """(lang, d1, d2, d3) by the counts of counts of one order; at most a row per language."""
    n = [F.count_if(F.col("c") == i).cast("double") for i in (1, 2, 3, 4)]
    y = n[0] / F.nullif(n[0] + 2 * n[1], F.lit(0.0))
    raw = [1 - 2 * y * n[1] / F.nullif(n[0], F.lit(0.0)),
           2 - 3 * y * n[2] / F.nullif(n[1], F.lit(0.0)),
           3 - 4 * y * n[3] / F.nullif(n[2], F.lit(0.0))]
    # few counts make the estimates undefined or extreme; then the usual middle values
    return table.groupBy("lang").agg(*[
        F.when((r > 0) & (r < i + 1), r).otherwise(0.5 * (i + 1)).alias(f"d{i + 1}")
        for i, r in enumerate(raw)])


def estimate(counts: DataFrame) -> DataFrame:
    """(lang, kind, k, v): log probabilities ("p1".."p5") and back-off weights ("b1".."b5").

    ``b<k>`` is keyed by the context of order-k n-grams; ``b1`` by 0.  ``p0`` is
    the uniform probability.
    """
    levels = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):  # continuation counts: distinct left neighbours
        mask = (1 << (BITS * k)) - 1
        levels[k] = materialize(levels[k + 1].groupBy(
            "lang", F.col("g").bitwiseAND(F.lit(mask)).alias("g")).agg(
                F.count("*").alias("c")), f"kn-counts-{k}")
    lower = levels[1].groupBy("lang").agg((1.0 / (F.count("*") + 1)).alias("p"))
    out = [lower.select("lang", F.lit("p0").alias("kind"), F.lit(0).cast("long").alias("k"),
                        F.log("p").alias("v"))]
    lower = lower.withColumn("suffix", F.lit(0).cast("long"))
    for k in range(1, ORDER + 1):
        mask = (1 << (BITS * (k - 1))) - 1
        t = levels[k].join(F.broadcast(discounts(levels[k])), "lang").select(  # a row per language
            "lang", "g", "c", "d1", "d2", "d3",
            F.shiftright("g", BITS).alias("ctx"),
            F.col("g").bitwiseAND(F.lit(mask)).alias("suffix"))
        d = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(
            F.col("d3"))
        ctx = t.groupBy("lang", "ctx").agg(
            F.sum("c").alias("total"), (F.sum(d) / F.sum("c")).alias("gamma"))
        probs = t.withColumn("kept", F.col("c") - d).join(ctx, ["lang", "ctx"]).join(
            lower.select("lang", "suffix", "p"), ["lang", "suffix"]).select(
            "lang", "g", (F.col("kept") / F.col("total") + F.col("gamma") * F.col("p")).alias("p"))
        probs = materialize(probs, f"kn-probabilities-{k}")
        out.append(probs.select("lang", F.lit(f"p{k}").alias("kind"), F.col("g").alias("k"),
                                F.log("p").alias("v")))
        out.append(ctx.select("lang", F.lit(f"b{k}").alias("kind"), F.col("ctx").alias("k"),
                              F.log("gamma").alias("v")))
        lower = probs.withColumnRenamed("g", "suffix")
    return materialize(reduce(DataFrame.unionByName, out), "kn-model")


class Model:
    """The estimated tables of one language as sorted arrays."""

    def __init__(self, tables: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.t = tables

    def _find(self, kind: str, keys: np.ndarray) -> np.ndarray:
        """Values of the keys; nan where there is none."""
        k, v = self.t.get(kind, (np.zeros(0, np.int64), np.zeros(0)))
        if not len(k):
            return np.full(len(keys), np.nan)
        i = np.minimum(np.searchsorted(k, keys), len(k) - 1)
        return np.where(k[i] == keys, v[i], np.nan)

    def log_probs(self, g: np.ndarray) -> np.ndarray:
        """Log probabilities of packed n-grams, backing off order by order."""
        out, open_, at = np.zeros(len(g)), np.arange(len(g)), g
        for k in range(ORDER, 0, -1):
            p = self._find(f"p{k}", at)
            hit = ~np.isnan(p)
            out[open_[hit]] += p[hit]
            open_, at = open_[~hit], at[~hit]
            if not len(open_):
                return out
            out[open_] += np.nan_to_num(self._find(f"b{k}", at >> BITS), nan=0.0)
            at = at & ((1 << (BITS * (k - 1))) - 1)
        out[open_] += self.t["p0"][1][0]
        return out


def load(model: DataFrame) -> dict[str, Model]:
    """The table on the driver; only called below BROADCAST_ROWS rows.

    Spark sorts it; the driver gets 16 bytes a row (a table number, key and value)
    and cuts the two arrays where the number changes.
    """
    names = [(r.lang, r.kind) for r in model.select("lang", "kind").distinct().collect()]
    tables = model.sparkSession.createDataFrame(
        [(*n, i) for i, n in enumerate(names)], "lang string, kind string, t int")
    rows = model.join(F.broadcast(tables), ["lang", "kind"]).select(
        "t", "k", F.col("v").cast("float")).orderBy("t", "k").toArrow()
    t, k, v = (rows.column(c).to_numpy() for c in ("t", "k", "v"))
    out: dict[str, dict] = {}
    for i, (lang, kind) in enumerate(names):
        lo, hi = np.searchsorted(t, [i, i + 1])
        out.setdefault(lang, {})[kind] = (k[lo:hi], v[lo:hi])
    return {lang: Model(x) for lang, x in out.items()}


def score_broadcast(docs: DataFrame, model: DataFrame | Broadcast,
                    carry: tuple[str, ...] = ("doc_id", "lang")) -> DataFrame:
    """The columns ``carry``, n_chars and log_prob of each row, with the model in each task."""
    shared = model if isinstance(model, Broadcast) else share(model)
    schema = T.StructType([docs.schema[c] for c in carry]).add("n_chars", "long").add(
        "log_prob", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        # word -> place in two arrays, over all languages together: MEMO_WORDS in a worker
        memos, sums, sizes, used = {}, np.zeros(MEMO_WORDS), np.zeros(MEMO_WORDS, np.int32), 0

        def rate(lang: str, words: list[bytes]) -> None:
            nonlocal used
            g, size = grams(words)
            lp = np.add.reduceat(models[lang].log_probs(g), np.cumsum(size) - size)
            sums[used:used + len(words)], sizes[used:used + len(words)] = lp, size
            memos.setdefault(lang, {}).update(zip(words, range(used, used + len(words))))
            used += len(words)

        def score(lang: str, words: list[bytes]) -> tuple[float, int]:
            nonlocal used
            total, n = 0.0, 0
            for i in range(0, len(words), 50_000):
                part = words[i:i + 50_000]
                new = list(dict.fromkeys(w for w in part if w not in memos.get(lang, ())))
                if used + len(new) > MEMO_WORDS:
                    memos.clear()
                    used, new = 0, list(dict.fromkeys(part))
                if new:
                    rate(lang, new)
                at = np.fromiter(map(memos[lang].__getitem__, part), np.int64, len(part))
                total, n = total + float(sums[at].sum()), n + int(sizes[at].sum())
            return total, n

        for whole in batches:
            for i in range(0, whole.num_rows, 500):  # bounds the texts split at once
                b = whole.slice(i, 500)
                langs = b.column("lang").to_pylist()
                texts = [t.split() for t in utf8_column(b, "text")]
                for lang in set(langs) & set(models):  # words not met before, all at once
                    known = memos.get(lang, {})
                    new = list({w for la, t in zip(langs, texts, strict=True) if la == lang for w in t}
                               - known.keys())
                    for j in range(0, len(new), 50_000):
                        if used + len(new[j:j + 50_000]) <= MEMO_WORDS:
                            rate(lang, new[j:j + 50_000])
                rated = [score(lang, words) if lang in models and words else (None, 0)
                         for lang, words in zip(langs, texts, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*map(b.column, carry), pa.array([n for _, n in rated], pa.int64()),
                     pa.array([x for x, _ in rated], pa.float64())], names=schema.names)
    return docs.mapInArrow(frugal(run), schema)


def share(model: DataFrame) -> Broadcast:
    return model.sparkSession.sparkContext.broadcast(load(model))


def score_joined(docs: DataFrame, model: DataFrame,
                 carry: tuple[str, ...] = ("doc_id", "lang")) -> DataFrame:
    """As ``score_broadcast``, by joins of each document's distinct n-grams; for large models."""
    docs = materialize(docs.withColumn("row", F.monotonically_increasing_id()), "kn-rows")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(),
                                       utf8_column(b, "text"), strict=True):
                if words := text.split():
                    keys, n = np.unique(grams(words)[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row] * len(keys), pa.int64()),
                         pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(n)],
                        names=["row", "lang", "g", "n"])
    todo = docs.select("row", "lang", "text").mapInArrow(
        frugal(run), "row long, lang string, g long, n long")
    wanted = todo.select("lang", "g").distinct()
    langs = model.where("kind = 'p0'").select("lang", F.col("v").alias("v0"))
    at = wanted.join(F.broadcast(langs), "lang").select(  # a row per language
        "lang", "g", F.col("g").alias("k"), F.lit(0.0).alias("v"), "v0",
        F.lit(False).alias("done"))
    for k in range(ORDER, 0, -1):
        p = model.where(F.col("kind") == f"p{k}").select("lang", "k", F.col("v").alias("p"))
        w = model.where(F.col("kind") == f"b{k}").select(
            "lang", F.col("k").alias("ctx"), F.col("v").alias("b"))
        mask = (1 << (BITS * (k - 1))) - 1
        at = at.join(p, ["lang", "k"], "left").withColumn("ctx", F.shiftright("k", BITS)).join(
            w, ["lang", "ctx"], "left")
        hit = F.col("p").isNotNull()
        at = materialize(at.select(
            "lang", "g", F.col("k").bitwiseAND(F.lit(mask)).alias("k"),
            (F.col("v") + F.when(F.col("done"), 0.0).when(hit, F.col("p"))
             .otherwise(F.coalesce("b", F.lit(0.0)))).alias("v"), "v0",
            (F.col("done") | hit).alias("done")), f"kn-back-off-{k}")
    logs = at.select("lang", "g", F.when(F.col("done"), F.col("v"))
                     .otherwise(F.col("v") + F.col("v0")).alias("lp"))
    sums = todo.join(logs, ["lang", "g"]).groupBy("row").agg(
        F.sum("n").alias("n_chars"), F.sum(F.col("n") * F.col("lp")).alias("log_prob"))
    return docs.join(sums, "row", "left").select(
        *carry, F.coalesce("n_chars", F.lit(0)).alias("n_chars"), "log_prob")


def _rated(docs: DataFrame, labels: DataFrame, spread: float, broadcast_rows: int,
           carry: tuple[str, ...]) -> DataFrame:
    """The columns ``carry`` of docs (doc_id, lang, text, ...), n_chars, perplexity, threshold, kept.

    One pass over the rows, so that a verdict is that of the row's own text.
    """
    texts = docs.select("doc_id", "lang", "text")
    ids = labels.where("quality = 1").select(
        F.col("doc_id").cast("long").alias("doc_id")).distinct()
    sets_limits = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)) == 0
    trusted = restrict(texts, ids.where(~sets_limits))
    counts = materialize(count_grams(trusted.select("lang", "text")), "kn-counts")
    model = estimate(counts)
    if model.count() <= broadcast_rows:
        model, score = share(model), score_broadcast
    else:
        score = score_joined

    known = materialize(score(restrict(texts, ids.where(sets_limits)), model), "kn-scores")
    known = known.where("n_chars > 0")
    mean = known.groupBy("lang").agg((F.sum("log_prob") / F.sum("n_chars")).alias("mean"))
    mean = F.broadcast(materialize(mean, "kn-means"))  # a row per language
    perplexity = F.exp(
        -(F.col("log_prob") + PRIOR_CHARS * F.col("mean")) / (F.col("n_chars") + PRIOR_CHARS))
    q = F.percentile_approx(F.log("perplexity"), F.array(F.lit(0.5), F.lit(HIGH)), 10_000)
    limits = known.join(mean, "lang").withColumn("perplexity", perplexity)
    limits = limits.groupBy("lang").agg(q.alias("q")).select(
        "lang", F.exp(F.col("q")[0] + spread * (F.col("q")[1] - F.col("q")[0])).alias("threshold"))
    limits = F.broadcast(materialize(limits, "kn-thresholds"))
    return score(docs, model, carry).join(mean, "lang", "left").join(limits, "lang", "left").select(
        *carry, "n_chars", perplexity.alias("perplexity"), "threshold",
        F.coalesce(perplexity <= F.col("threshold"), F.lit(True)).alias("kept"))


def _texts(docs: DataFrame, *more: Column) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
                       F.col("text").cast("string").alias("text"), *more)


def classify(docs: DataFrame, labels: DataFrame, spread: float = SPREAD,
             broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """doc_id, lang, n_chars, perplexity, threshold, kept."""
    return _rated(_texts(docs), labels, spread, broadcast_rows, ("doc_id", "lang"))


def keep_rows(docs: DataFrame, labels: DataFrame, spread: float = SPREAD,
              broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The rows of ``docs`` that ``classify`` keeps, each judged by its own text."""
    rest = F.struct(*[c for c in docs.columns if c != "text"]).alias("rest")
    rated = _rated(_texts(docs, rest), labels, spread, broadcast_rows, ("lang", "text", "rest"))
    return rated.where("kept").select(
        *[F.col("text" if c == "text" else f"rest.{c}").alias(c) for c in docs.columns])
