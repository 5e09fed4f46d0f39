"""Weak supervision: quality rules vote or abstain, and a label model weighs them.

Every rule looks at one count of a document and votes 0 (bad) above a limit, 1
(good) below a stricter one, and abstains (null) in between or without words.
Some look at the same fault from two sides (symbols, their runs and the share of
letters; capitals and shouts; repeated words and lines), so votes can agree on a
fault or contradict each other.  Expectation-maximisation over the vote patterns
of all documents estimates the share of good documents and, for each rule, how
often it votes 1 on good and 0 on bad ones (a rule sees its own fault only, so
the two differ); abstaining says nothing.  The posterior probability of "good"
replaces the usual demand that every rule pass: a bad vote that no other rule
bears out can be outvoted.  EM starts from rules that seldom accuse good
documents and miss most bad ones (``START``).

There are at most ``3 ** len(rules())`` vote patterns whatever the input, so
the pattern table is the only thing EM iterates over.  Only DataFrame
functions are used; nothing of a document is shuffled but its counts.

Repeated 3-word windows are found inside a row: window hashes, with their
position in the low bits, are sorted; equal neighbours are compared word by
word.  That is ``n log n`` in the length of a text.

Defined cases: a null or blank text has zero counts and fails the base rules;
repeated rows are judged alike, each on its own row; an empty table gives an
empty result; doc_id may be null; other columns are not read.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worklens.llm.common import materialize, word_array

#: Characters counted as symbols.
SYMBOLS = "[#*$%&|<>]"
#: Characters of words other than letters.
MARKS = r"[^\p{L}\p{M}\x20\x09-\x0D]"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
ITERATIONS, KEEP_AT = 25, 0.5
#: Where EM starts: the share of good documents, and how often a rule is right on good and on
#: bad ones.  The range of estimated accuracies.
PRIOR, START, LEAST, MOST = 0.5, (0.95, 0.4), 0.05, 0.99


class Model(NamedTuple):
    """The share of good documents; per rule, how often its votes are right on good ones, on bad
    ones and on all."""
    prior: float
    on_good: list[float]
    on_bad: list[float]
    whole: list[float]


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def _vote(bad: Column, good: Column) -> Column:
    return F.when(F.col("n_words") > 0, F.when(bad, 0).when(good, 1))


def rules() -> dict[str, Column]:
    """name -> vote; the counts are columns of ``count_features``."""
    symbols, repeats = _share("n_symbols", "n_words"), _share("n_repeat_words", "n_words")
    lines, upper = _share("n_dup_lines", "n_lines"), _share("n_upper", "word_chars")
    length, shouts = _share("word_chars", "n_words"), _share("n_shouts", "n_words")
    runs, marks = _share("n_symbol_runs", "n_words"), _share("n_marks", "word_chars")
    return {
        "symbols": _vote(symbols > 0.2, symbols < 0.05),
        "repeats": _vote(repeats > 0.3, repeats < 0.1),
        "lines": _vote(lines > 0.3, lines < 0.1),
        "upper": _vote(upper > 0.4, upper < 0.15),
        "shouts": _vote(shouts > 0.2, shouts < 0.05),
        "word_length": _vote((length < 2.5) | (length > 12), length.between(3.0, 9.0)),
        "symbol_runs": _vote(runs > 0.2, runs < 0.05),
        "letters": _vote(marks > 0.25, marks < 0.1),
    }


def count_features(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of every whole text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    df = docs.select("doc_id", text.alias("text")).withColumn("w", word_array(F.col("text")))
    # positions take the low bits of a hash, as many as the text needs
    df = df.withColumn("m", F.expr(
        "shiftleft(1L, cast(ceil(log2(size(w) + 2.0D)) as int)) - 1"))
    df = df.withColumn("m", F.coalesce("m", F.lit(0).cast("long")))
    df = df.withColumn("s", F.expr("""
        sort_array(transform(if(size(w) >= 3, sequence(0, size(w) - 3), cast(array() as array<int>)),
            i -> (xxhash64(w[i], w[i + 1], w[i + 2]) & ~m) | i))"""))
    same = """((x & ~m) = (get(s, {j}) & ~m)
        and get(w, cast(x & m as int)) = get(w, cast(get(s, {j}) & m as int))
        and get(w, cast(x & m as int) + 1) = get(w, cast(get(s, {j}) & m as int) + 1)
        and get(w, cast(x & m as int) + 2) = get(w, cast(get(s, {j}) & m as int) + 2))"""
    df = df.withColumn("p", F.expr(f"""
        sort_array(transform(filter(s, (x, k) -> coalesce({same.format(j="k - 1")}, false)
            or coalesce({same.format(j="k + 1")}, false)), x -> x & m))"""))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return df.withColumn("lines", lines).select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr("aggregate(transform(p, (x, k) -> least(3L, coalesce(get(p, k + 1) - x, 3L))),"
               " 0L, (a, x) -> a + x)").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.regexp_count("text", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count("text", F.lit("!!")).cast("long").alias("n_shouts"),
        F.regexp_count("text", F.lit(f"{SYMBOLS}+")).cast("long").alias("n_symbol_runs"),
        F.regexp_count("text", F.lit(MARKS)).cast("long").alias("n_marks"))


def posterior(model: Model) -> Column:
    """P(good | votes) for the array column ``votes``, in the order of the rules."""
    def likelihood(label: int, rates: list[float]) -> Column:
        given = F.array(*[F.lit(a) for a in rates])
        terms = F.zip_with("votes", given, lambda v, a: F.when(v.isNull(), 1.0)
                           .when(v == label, a).otherwise(1.0 - a))
        return F.aggregate(terms, F.lit(1.0), lambda x, y: x * y)
    good = likelihood(1, model.on_good) * model.prior
    bad = likelihood(0, model.on_bad) * (1 - model.prior)
    return good / (good + bad)


def fit(patterns: DataFrame, n_rules: int, iterations: int) -> Model:
    """EM over the bounded table of vote patterns (votes, n)."""
    model = Model(PRIOR, [START[0]] * n_rules, [START[1]] * n_rules, [math.nan] * n_rules)
    for _ in range(iterations):
        rated = patterns.select("n", posterior(model).alias("p"),
                                F.posexplode("votes").alias("rule", "vote"))
        good, bad = F.col("n") * F.col("p"), F.col("n") * (1 - F.col("p"))
        voted, yes = F.col("vote").isNotNull(), F.col("vote") == 1
        got = rated.groupBy("rule").agg(  # a row per rule; each sees all patterns
            F.sum(good).alias("good"), F.sum("n").alias("all"),
            F.sum(F.when(voted, good).otherwise(0.0)).alias("cast_good"),
            F.sum(F.when(voted, bad).otherwise(0.0)).alias("cast_bad"),
            F.sum(F.when(yes, good).otherwise(0.0)).alias("right_good"),
            F.sum(F.when(voted & ~yes, bad).otherwise(0.0)).alias("right_bad")).collect()
        if not got:  # no document
            break
        # one made-up right and one wrong vote of each kind
        prior = (got[0]["good"] + 1) / (got[0]["all"] + 2)
        on_good, on_bad, whole = [list(x) for x in (model.on_good, model.on_bad, model.whole)]
        for r in got:
            def rate(right: float, cast: float) -> float:
                return min(max((right + 1) / (cast + 2), LEAST), MOST)
            if r["cast_good"] + r["cast_bad"]:  # silent rules stay
                on_good[r["rule"]] = rate(r["right_good"], r["cast_good"])
                on_bad[r["rule"]] = rate(r["right_bad"], r["cast_bad"])
                whole[r["rule"]] = rate(r["right_good"] + r["right_bad"],
                                        r["cast_good"] + r["cast_bad"])
        new = Model(prior, on_good, on_bad, whole)
        moved = max(abs(a - b) for a, b in zip(
            [prior, *on_good, *on_bad], [model.prior, *model.on_good, *model.on_bad], strict=True))
        model = new
        if moved < 1e-4:
            break
    return model


def fit_accuracies(patterns: DataFrame, n_rules: int, iterations: int) -> list[float]:
    """The share of each rule's votes that are right (nan for a silent rule)."""
    return fit(patterns, n_rules, iterations).whole


def judge(docs: DataFrame, keep_at: float = KEEP_AT, iterations: int = ITERATIONS) -> DataFrame:
    """Counts, base_failed, kept and p_good (the posterior) per document."""
    votes = rules()
    rows = materialize(
        count_features(docs).select("*", F.array(*votes.values()).alias("votes")), "quality-votes")
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    patterns = materialize(rows.groupBy("votes").agg(F.count("*").alias("n")), "vote-patterns")
    fitted = fit(patterns, len(votes), iterations)
    return rows.withColumn("p_good", posterior(fitted)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & (F.col("p_good") >= keep_at)).alias("kept"),
        "p_good", *[F.element_at("votes", i + 1).alias(r) for i, r in enumerate(votes)])
