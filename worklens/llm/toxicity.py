"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  A sentence's score is a logistic function
of the weights of its distinct words; the scores of a document's sentences are
combined by noisy-or, ``1 - prod(1 - p)``, which is trained against document
labels only.  Afterwards the sentence scores point at the offending sentences.
A sentence whose words do not speak for toxicity (weights that sum to nothing
or less) adds nothing, so a clean text scores 0 at any length.

The model is fitted on a bounded sample of labelled rows: at most
``MAX_POSITIVE`` and ``MAX_NEGATIVE`` documents, an equal share of each
language as far as it has so many, taken in the order of a hash of doc_id, each
with at most ``MAX_TRAIN_BYTES`` of text (longer ones do not train).  A word
tells by a z test and a likelihood ratio test, whatever the number of its
documents.  Its weights are a vector of ``2 ** BITS`` numbers whatever the input.
Scoring reads every whole text in one pass without a shuffle.

Defined cases: null or blank text has no sentence and scores 0; without
labelled rows of both kinds every score is 0; repeated rows score alike, each
on its own row; an empty table gives an empty result; null labels do not
train; a null or missing lang is a language of its own; other columns (source,
...) are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worklens.llm.common import Memo, frugal, materialize, utf8_column

BITS = 18
MAX_POSITIVE, MAX_NEGATIVE, MAX_TRAIN_BYTES = 3000, 6000, 20_000
#: A word needs so many standard errors between the two kinds, and such a ratio of rates.
MIN_Z, MIN_LIFT = 4.0, 3.0
#: The bias is fixed; it holds for sentences with a telling word, the others count nothing.
EPOCHS, RATE, L2, BIAS = 300, 0.5, 1e-4, -8.0

#: What a sentence is: a run without sentence ends.
SENTENCE = re.compile(rb"[^.!?\n]+")
_EDGES = b"\"'()[]{}<>,;:*_-#%&|$~`"


def feature(word: bytes) -> int:
    """Bucket of a word without the punctuation around it; -1 for punctuation alone."""
    word = word.strip(_EDGES).lower()
    return xxhash.xxh3_64_intdigest(word, 1) & ((1 << BITS) - 1) if word else -1


def sentence_features(text: bytes, memo: Memo) -> list[list[int]]:
    bags = (sorted({memo[w] for w in m.group().split()} - {-1}) for m in SENTENCE.finditer(text))
    return [b for b in bags if b]


def training_sample(docs: DataFrame, labels: DataFrame, target: str = "toxic") -> DataFrame:
    """(label, text): the bounded sample; never a row that is held out."""
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit("")
    ids = labels.where(~held_out(F.col("doc_id"))).select(
        F.col("doc_id").alias("id"), F.col(target).cast("int").alias("label")).where(
            "label in (0, 1)")
    langs = docs.select("doc_id", F.coalesce(lang, F.lit("")).alias("lang"))
    found = langs.join(ids, F.col("doc_id") == F.col("id")).groupBy("id", "label").agg(
        F.min("lang").alias("lang"))
    found = materialize(found, "toxic-labels")
    sizes = found.groupBy("label", "lang").agg(F.count("*").alias("n"))
    # the rank of a row within its label and language, as a uniform hash tells it
    place = F.shiftrightunsigned(F.xxhash64("id"), 11) * F.lit(2.0 ** -53) * F.col("n")
    ranked = found.join(F.broadcast(sizes), ["label", "lang"]).select(  # two rows a language
        "id", "label", place.alias("place"))
    drawn = [ranked.where(F.col("label") == v).orderBy("place", "id").limit(n).select("id", "label")
             for v, n in ((1, MAX_POSITIVE), (0, MAX_NEGATIVE))]
    few = F.broadcast(drawn[0].unionByName(drawn[1]))  # at most that many rows
    return docs.where(F.octet_length("text") <= MAX_TRAIN_BYTES).join(
        few, docs["doc_id"] == few["id"]).select("label", docs["text"])


def held_out(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def _documents(batches: Iterator[pa.RecordBatch], memo: Memo):
    """(label, sentence features) of the documents that have any."""
    for b in batches:
        for label, text in zip(b.column(0).to_pylist(), utf8_column(b, "text"), strict=True):
            if bags := sentence_features(text, memo):
                yield label, bags


def word_counts(sample: DataFrame) -> DataFrame:
    """(word, toxic, docs): in how many documents each word is; word -1 counts all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, (1 << BITS) + 1), np.int64)  # the last column is word -1
        for label, bags in _documents(batches, Memo(feature)):
            counts[label, np.unique(np.concatenate([*bags, [-1]]).astype(np.int64))] += 1
        docs = counts.sum(axis=0)
        word = np.flatnonzero(docs)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.where(word == 1 << BITS, -1, word).astype(np.int32)),
             pa.array(counts[1, word]), pa.array(docs[word])], names=["word", "toxic", "docs"])
    return sample.mapInArrow(frugal(run), "word int, toxic long, docs long").groupBy("word").agg(
        F.sum("toxic").alias("toxic"), F.sum("docs").alias("docs"))


def telling_bags(sample: DataFrame, often: np.ndarray) -> DataFrame:
    """(label, sizes, words): how many telling words the sentences of each document have that
    have any, and which."""
    shared = sample.sparkSession.sparkContext.broadcast(often)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tells = shared.value
        for label, bags in _documents(batches, Memo(feature)):
            found = [[w for w in bag if tells[w]] for bag in bags]
            sizes = [len(f) for f in found if f]
            yield pa.RecordBatch.from_arrays(
                [pa.array([label], pa.int32()), pa.array([sizes], pa.list_(pa.int32())),
                 pa.array([[w for f in found for w in f]], pa.list_(pa.int32()))],
                names=["label", "sizes", "words"])
    return sample.mapInArrow(frugal(run), "label int, sizes array<int>, words array<int>")


def telling(inside: np.ndarray, docs: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """Which words occur in toxic and other documents at rates that differ beyond chance."""
    outside, share = docs - inside, docs / (n1 + n0)
    rate = (docs + 1) / (n1 + n0 + 2)
    z = (inside / n1 - outside / n0) / np.sqrt(rate * (1 - rate) * (1 / n1 + 1 / n0))

    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9))
    # of few documents z is too large; the signed root of the likelihood ratio is not
    g = 2 * (part(inside, n1 * share) + part(outside, n0 * share)
             + part(n1 - inside, n1 * (1 - share)) + part(n0 - outside, n0 * (1 - share)))
    beyond = np.minimum(np.abs(z), np.sqrt(np.maximum(g, 0))) >= MIN_Z
    lift = np.log((inside + 0.5) / (n1 + 1)) - np.log((outside + 0.5) / (n0 + 1))
    return beyond & (np.abs(lift) >= math.log(MIN_LIFT))


def fit(y: np.ndarray, doc: np.ndarray, row: np.ndarray, col: np.ndarray) -> np.ndarray:
    """Weights that maximise the noisy-or likelihood of the labels (Adagrad).

    ``doc`` is the document of each sentence with a telling word, (``row``,
    ``col``) its words.
    """
    weights, seen = np.zeros(1 << BITS), np.full(1 << BITS, 1e-6)
    for _ in range(EPOCHS):
        z = BIAS + np.bincount(row, weights[col], minlength=len(doc))
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        log_none = np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=len(y))
        any_p = np.clip(-np.expm1(log_none), 1e-9, 1)
        # d log-likelihood / d z of a sentence: p * (1 - P) / P if toxic, -p if not
        slope = np.where(y == 1, (1 - any_p) / any_p, -1.0) / len(y)
        g = p * slope[doc]
        gw = np.bincount(col, g[row], minlength=1 << BITS) - L2 * weights / len(y)
        seen += gw * gw
        weights += RATE * gw / np.sqrt(seen)
    return weights


def train(docs: DataFrame, labels: DataFrame, target: str = "toxic") -> tuple[np.ndarray, float]:
    """The weights and the bias; the driver sees counts per word and telling words only."""
    sample = materialize(training_sample(docs, labels, target), "toxic-sample")
    got = word_counts(sample).toArrow()  # at most 2 ** BITS + 1 rows
    inside, count = np.zeros((2, (1 << BITS) + 1))
    word = got["word"].to_numpy()
    inside[word], count[word] = got["toxic"].to_numpy(), got["docs"].to_numpy()
    n1, n0 = inside[-1], count[-1] - inside[-1]
    if not n1 or not n0:
        return np.zeros(1 << BITS), -50.0
    often = telling(inside[:-1], count[:-1], n1, n0)
    bags = telling_bags(sample, often).toArrow().combine_chunks()
    sizes = bags["sizes"].combine_chunks()
    size = sizes.flatten().to_numpy()
    doc = np.repeat(np.arange(len(bags)), np.diff(sizes.offsets.to_numpy()))
    weights = fit(bags["label"].to_numpy(), doc,
                  np.repeat(np.arange(len(size)), size),
                  bags["words"].combine_chunks().flatten().to_numpy())
    return weights, BIAS


def noisy_or(parts: list[float]) -> float:
    return -math.expm1(sum(math.log1p(-min(p, 1 - 1e-12)) for p in parts))


def score_text(text: bytes, memo: Memo, bias: float, at: float):
    """(noisy-or score, sentences with a word, offending sentences with their offsets)."""
    log_none, n, found = 0.0, 0, []
    for m in SENTENCE.finditer(text):
        words = m.group().split()
        if not words:
            continue
        n += 1
        z = bias + sum(map(memo.__getitem__, set(words)))
        if z <= bias:  # nothing speaks for toxicity
            continue
        p = 1 / (1 + math.exp(-min(z, 40.0)))
        log_none += math.log1p(-min(p, 1 - 1e-12))
        if p >= at:
            start = len(text[:m.start()].decode("utf-8", "replace"))
            found.append({"start": start, "score": p,
                          "end": start + len(m.group().decode("utf-8", "replace"))})
    return min(1.0, -math.expm1(log_none)), n, found


OFFENDING = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()),
                                ("score", pa.float64())]))


def score(docs: DataFrame, model: tuple[np.ndarray, float], sentence_at: float = 0.5) -> DataFrame:
    """doc_id, score, n_sentences and the offending sentences (offsets in characters)."""
    weights, bias = model
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        memo = Memo(lambda word: float(w[f]) if (f := feature(word)) >= 0 else 0.0)
        for b in batches:
            rows = [score_text(t, memo, bias, sentence_at) for t in utf8_column(b, "text")]
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([r[0] for r in rows], pa.float64()),
                pa.array([r[1] for r in rows], pa.int64()),
                pa.array([r[2] for r in rows], OFFENDING),
            ], names=["doc_id", "score", "n_sentences", "offending"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        frugal(run), "doc_id long, score double, n_sentences long, "
                     "offending array<struct<start: long, end: long, score: double>>")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, n_sentences, offending."""
    return score(docs, train(docs, labels)).select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_sentences", "offending")


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose score stays below one half, each judged by its own text."""
    weights, bias = train(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        memo = Memo(lambda word: float(w[f]) if (f := feature(word)) >= 0 else 0.0)
        for b in batches:
            yield b.filter(pa.array([score_text(t, memo, bias, 0.5)[0] < 0.5
                                     for t in utf8_column(b, "text")], pa.bool_()))
    return docs.mapInArrow(frugal(run), docs.schema)
