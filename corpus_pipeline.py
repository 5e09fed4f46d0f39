"""A training-data pipeline over ``documents``.

quality -> toxicity -> near duplicates -> repeated passages -> packing

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns the rows that go on.  All but the last return the columns of
``documents``.  ``run`` writes each stage's rows as Parquet in the shared
scratch folder and reads them back as the next one's input, so a lost executor
costs one stage at most.  Texts reach the Python workers in batches bounded by bytes.

Labels (table ``labels``) train the quality and toxicity models; the models
then judge every row a stage is given by its own text, whatever its doc_id: rows
of one id may fare differently.  Rows with a null doc_id have no label and no
copies: a rejected one is dropped like any other; the rest are kept by the
duplicate stages, and packed.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from worklens.llm import debruijn, jaccard, kneser_ney, packing, toxicity
from worklens.llm.common import bound_batches, materialize, table
from worklens.llm.queries import tokenizer_file

#: Near duplicates: words per shingle and least similarity in percent.
SHINGLE_WORDS, SIMILARITY = 5, 80


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def bounded(stage: Stage) -> Stage:
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_batches(spark)
        return stage(spark, docs, sf_dir)
    return run


@bounded
def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents whose perplexity is above their language's threshold."""
    return kneser_ney.keep_rows(docs, table(spark, sf_dir, "labels"))


@bounded
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents whose noisy-or score reaches one half."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


@bounded
def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row, that of the smallest id, of each component of near duplicates."""
    return jaccard.one_of_each(docs, SHINGLE_WORDS, SIMILARITY)


@bounded
def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut every passage of 50 words or more that an earlier document holds too."""
    cut = debruijn.cut_repeats(docs, into="__cut")
    text = F.col("__cut.kept_text")
    new = {"text": text, "n_chars": F.coalesce(F.length(text), F.lit(0)).cast("long")}
    return cut.select(*[new.get(c, F.col(c)).alias(c) for c in docs.columns])


@bounded
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 4096 tokens."""
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", keep_quality),
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", one_per_group),
    ("substring dedup", cut_passages),
    ("packing", pack),
]

#: The models are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, f"pipeline-{i}")
    return docs
