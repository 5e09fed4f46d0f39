"""Ids that several rows share, clashing column names and vectors at the ends of the number range."""

import numpy as np
import pytest

from worklens.llm import ann, debruijn, jaccard, sharding
from worklens.session import scratch_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long, cut int, shard string"


def text(seed, n=150):
    rng = np.random.default_rng(seed)
    return " ".join(f"w{i}" for i in rng.integers(0, 900, n))


def near(t, at=75):
    words = t.split()
    words[at] = "changed"
    return " ".join(words)


A, B, C = text(1), text(2), text(3)


def docs(spark, *rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 7, "x") for i, t in rows], DOCS)


def linked(df, k=3, percent=90):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in
                   jaccard.link_components(df, k, percent).collect()), key=str)


def test_rows_of_one_id_link_as_one_document(spark):
    df = docs(spark, (1, A), (5, A), (5, B), (9, near(B)))
    n = len({tuple(A.split()[i:i + 3]) for i in range(148)})
    rows = linked(df)
    assert len(rows) == 4 and {r[2] for r in rows} == {1}
    assert [r for r in rows if r[0] == 1] == [(1, n, 1)]
    # repeated rows, nulls and texts without words among them
    df = docs(spark, (7, C), (7, C), (3, ""), (3, None), (None, A), (None, None), (8, near(C)), (2, "one"), (2, "one"))
    got = linked(df)
    assert len(got) == 9
    assert sorted([(r[0], r[2]) for r in got], key=str) == sorted(
        [(7, 7), (7, 7), (8, 7), (3, 3), (3, 3), (None, None), (None, None), (2, 2), (2, 2)], key=str)


def test_unique_and_repeated_ids_agree(spark):
    rng = np.random.default_rng(4)
    rows = [(i, near(text(int(rng.integers(0, 6))), int(rng.integers(20, 130)))) for i in range(40)]
    plain = {i: c for i, _, c in linked(docs(spark, *rows))}
    doubled = linked(docs(spark, *rows, *rows[:7]))
    assert {i: c for i, _, c in doubled} == plain and len(doubled) == 47


def test_no_text_of_a_shared_id_is_lost(spark, tmp_path):
    import corpus_pipeline as cp
    df = docs(spark, (1, A), (5, B), (5, C), (6, near(B)), (7, A), (7, A), (None, B), (None, B), (4, None))
    kept = cp.one_per_group(spark, df, str(tmp_path))
    assert kept.columns == df.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert got == sorted([(1, A), (5, B), (5, C), (None, B), (None, B), (4, None)], key=str)
    unique = docs(spark, (1, A), (5, B), (6, near(B)), (7, A), (None, B), (4, None))
    got = sorted(((r.doc_id, r.text) for r in cp.one_per_group(spark, unique, str(tmp_path)).collect()), key=str)
    assert got == sorted([(1, A), (5, B), (None, B), (4, None)], key=str)


def test_documents_with_a_column_cut(spark, tmp_path):
    import corpus_pipeline as cp
    df = docs(spark, (1, A), (2, B + " " + A), (3, None))
    out = {r.doc_id: r for r in cp.cut_passages(spark, df, str(tmp_path)).collect()}
    assert out[2].text == B and out[2].cut == 7 and out[1].text == A


def test_documents_with_a_column_shard(spark):
    df = docs(spark, *[(i % 3, text(i, 40)) for i in range(20)])
    path = scratch_path(spark, "shards")
    sharding.write_shards(df, path, 2000)
    back = spark.read.parquet(path)
    assert {"shard", "__shard"} <= set(back.columns)
    assert sorted((r.doc_id, r.text) for r in back.collect()) == sorted((r.doc_id, r.text) for r in df.collect())
    assert {r.shard for r in back.select("shard").collect()} == {"x"}


@pytest.mark.parametrize("scale", [1.0, 1e-200, 1e200])
def test_extreme_vectors(spark, scale):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(200, 8))
    plain = x.copy()
    for i, s in ((0, 1e-200), (50, 1e200), (51, 1e200), (9, 1e-200), (100, scale)):
        x[i] *= s
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(df).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    u = plain / np.linalg.norm(plain, axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -2)
    hits = 0
    for q in (0, 50, 100, 150):
        ids = [i for _, i, _ in sorted(got[q])]
        for _, i, score in got[q]:
            assert abs(score - s[q, i]) < 1e-9
        hits += len(set(ids) & set(np.argsort(-s[q])[:5].tolist()))
    assert hits >= 18


def test_scaling_keeps_cosines_to_the_bit():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(50, 16))
    y = ann.scaled(x)
    assert (np.abs(y).max(axis=1) < 1).all() and (np.abs(y).max(axis=1) >= 0.5).all()
    n, m = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    assert ((x @ x.T) / (n[:, None] * n) == (y @ y.T) / (m[:, None] * m)).all()


def cut_of(df):
    return {(r.doc_id, r.n_words): r.n_removed for r in debruijn.removed(df).collect()}


def test_each_text_of_an_id_is_cut_by_itself(spark):
    got = cut_of(docs(spark, (1, C), (5, C + " " + A), (5, B), (5, None)))
    assert got == {(1, 150): 0, (5, 300): 150, (5, 150): 0, (5, 0): 0}


def test_long_runs_compact_to_one_edge(spark):
    whole = text(4, 4000)
    half = " ".join(whole.split()[1000:3000])
    df = docs(spark, (1, whole), (2, whole), (2, whole), (3, A), (4, A), (9, B))
    key = df.selectExpr("doc_id", "hash(text) as key", "text")
    shared, _ = debruijn.shared_paths(debruijn.path_rows(key, 50, 12))
    facts = debruijn.edge_facts(shared)
    runs = debruijn.compact(facts).collect()
    assert facts.count() > 100 and sorted(r.windows for r in runs) == [101, 3951]
    assert sorted(r["first"] for r in runs) == [1, 3]
    assert cut_of(df) == {(1, 4000): 0, (2, 4000): 4000, (3, 150): 0, (4, 150): 150, (9, 150): 0}
    assert cut_of(df.unionByName(docs(spark, (0, half))))[1, 4000] == 2000


def test_one_passage_in_most_documents(spark, monkeypatch):
    rows = [(i, f"a{i} " * 90 + A + f" b{i}" * 30) for i in range(200)]  # a90: edges of one text
    expected = {(i, 150 if i else 0) for i in range(200)}
    for hot in (debruijn.HOT, 1):  # at 1 no key is broadcast
        monkeypatch.setattr(debruijn, "HOT", hot)
        assert {(r.doc_id, r.n_removed)
                for r in debruijn.removed(docs(spark, *rows)).collect()} == expected


def test_words_that_differ_from_their_source_stay():
    words = A.encode()
    w = debruijn.digests(*debruijn.word_bytes(words), [10, 145], [60, 60])
    assert debruijn.cut_text(A, 50, [10], [60], w[:1, 0], w[:1, 1], [None])[1] == 60
    assert debruijn.cut_text(A, 50, [11], [60], w[:1, 0], w[:1, 1], [None])[1] == 0
    assert debruijn.cut_text(A, 50, [10], [60], w[:1, 0], w[:1, 1], [[0, 2]])[1] == 52
    assert not w[1].any()
