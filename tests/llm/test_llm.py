"""The pipeline operators: brute-force comparisons and the defined edge cases."""

import collections
import hashlib
import math
import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from worklens.catalog.check import compare, duck
from worklens.llm import (ann, common, debruijn, jaccard, kneser_ney, packing, quality_rules,
                          quoting, sharding, toxicity, viterbi)
from worklens.llm.queries import ORACLE, QUERIES, tokenizer_file

DOCS = "doc_id long, text string, lang string, score double, key long"
WORDS = [f"w{i}x" for i in range(400)]


def text(seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    return " ".join(WORDS[i] for i in rng.integers(0, len(WORDS), n))


LONG = text(99, 9000)
BASE = text(1, 300)


@pytest.fixture(scope="module")
def odd_docs(spark):
    """Nulls, empty and very long texts, copies, near copies, repeated rows, clashing names."""
    passage = text(2, 60)
    near = BASE.split()
    near[150] = "changed"
    rows = [(0, BASE), (1, BASE), (2, " ".join(near)), (3, None), (4, ""), (5, " \n\t "),
            (6, LONG), (7, f"{text(3, 40)} {passage} {text(4, 40)}"),
            (8, f"{text(5, 30)}\n{passage}\n{text(6, 50)}"), (9, "one two"), (10, "One  TWO"),
            (11, "one"), (12, text(7, 49)), (12, text(7, 49)), (None, BASE), (None, None),
            (13, "a " * 200), (14, passage)]
    return spark.createDataFrame([(i, t, None if i == 2 else "en", 0.5, 7) for i, t in rows], DOCS)


def empty(df):
    return df.where(F.lit(False))


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_sql(spark, sf_oracle, key):
    got = compare(spark, duck(sf_oracle), key, QUERIES[key], ORACLE[key], sf_oracle)
    assert got["status"] == "ok", got


# packing -----------------------------------------------------------------------------------

def check_packing(rows, docs, tok):
    ids = {}
    for d, t in docs:
        ids.setdefault(d, []).append(np.array(
            tok.encode(t or "", add_special_tokens=False).ids + [2], "<u4"))
    by_seq, by_doc = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_seq[r.sequence_id].append(r)
        by_doc[r.doc_id].append(r)
        assert any(zlib.crc32(x[r.start:r.start + r.length].tobytes()) == r.ids_crc32
                   and len(x) == r.doc_tokens for x in ids[r.doc_id])
    for pieces in by_seq.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == 4096 or at & (at - 1) == 0  # no padding
    assert {d: sum(p.length for p in ps) for d, ps in by_doc.items()} == {
        d: sum(map(len, xs)) for d, xs in ids.items()}


def test_packing_is_whole_and_tight(spark, odd_docs):
    from tokenizers import Tokenizer
    path = tokenizer_file("word_bpe_49k.json")
    rows = packing.pack(odd_docs, path).collect()
    check_packing(rows, [(r.doc_id, r.text) for r in odd_docs.collect()], Tokenizer.from_file(path))
    assert packing.pack(empty(odd_docs), path).count() == 0


def test_word_ids_are_those_of_whole_texts():
    """Words that differ in case or punctuation are encoded once; other texts go by parts."""
    tok = packing.WordTokenizer(tokenizer_file("word_bpe_49k.json"))
    latin = ["Word word WORD, (word). \u00dcBER \u00fcber; it's IT'S 12 1 ...", "\u00c9t\u00e9\u2014\u00e9t\u00e9 _a_"]
    odd = ["a\tb \u0130x", "T\u0308 \u03a3\u03a3 \u00b2\u00bd", "<|endoftext|> X", "<|ENDOFTEXT|>", "", "\n \n"]
    for t, ids in zip(latin + odd, tok.ids([t.encode() for t in latin + odd]), strict=True):
        assert ids.tolist() == tok.tok.encode(t, add_special_tokens=False).ids, t
    alone = packing.WordTokenizer(tokenizer_file("word_bpe_49k.json"))
    alone.ids([latin[0].encode()])
    assert set(alone.memo) == {"word", ",", "(", ").", "\u00fcber", ";", "it", "'s", "1", "2", "..."}
    assert not packing.finds_words({"normalizer": None, "model": {"type": "BPE"}})


def test_words_are_cut_as_by_the_pre_tokenizer():
    draw = random.Random(3)
    tok = packing.WordTokenizer(tokenizer_file("word_bpe_49k.json"))
    signs = list("'strevemldSTX \n019.,<|>\u00e9\u00d7\u00f7\u00aa\u00b5\u00df\u017f\u2014")
    texts = ["", "'", "'s", "x's's'll'", "''s", "don't'", "\n"] + [
        "".join(draw.choices(signs, k=draw.choice([1, 2, 3, 8, 60]))) for _ in range(200)]
    assert all(map(tok.has_words, texts))
    split = tok.tok.pre_tokenizer.pre_tokenize_str
    for t, ids in zip(texts, tok.ids([t.encode() for t in texts]), strict=True):
        units, at, begins = packing.find_words(t.lower())
        assert begins.tolist() == [x for _, (x, _) in split(t.lower())], t
        assert np.diff(at).tolist() == [y - x for _, (x, y) in split(t.lower())], t
        assert ids.tolist() == tok.tok.encode(t, add_special_tokens=False).ids, t


def test_known_words_outlive_a_full_memo(monkeypatch):
    """What the texts at hand have in the memo is kept when it overflows, not encoded again."""
    monkeypatch.setattr(packing, "MEMO_PARTS", 4)
    tok, seen = packing.WordTokenizer(tokenizer_file("word_bpe_49k.json")), []
    encode = tok.encode_words
    monkeypatch.setattr(tok, "encode_words", lambda words: seen.extend(words) or encode(words))
    for text in ["the and of", "the and more words", "the and", "a b c d e f"]:
        ids, = tok.ids([text.encode()])
        assert ids.tolist() == tok.tok.encode(text, add_special_tokens=False).ids
        assert len(tok.memo) <= 4
    assert sorted(seen) == sorted("the and of more words a b c d e f".split())


def test_texts_are_looked_up_in_chunks_of_bytes(monkeypatch):
    monkeypatch.setattr(packing, "CHUNK_BYTES", 10)
    texts = ["abcd", None, "x" * 30, "", "a" * 6, "\u00e9\u00e9", "b"]
    batch = pa.record_batch({"doc_id": [*range(6), None], "text": texts})
    got = list(packing.chunks(batch))
    assert [len(t) for _, t in got] == [3, 3, 1]
    assert [d for ds, _ in got for d in ds] == [0, 1, 2, 3, 4, 5, None]
    assert [t for _, ts in got for t in ts] == [(t or "").encode() for t in texts]
    assert list(packing.chunks(batch.slice(0, 0))) == []


def test_packing_takes_the_lowest_cost_sequence():
    lengths = np.array([60, 40, 30, 30])
    got = list(packing.place(lengths, np.arange(4), np.array([80, 80]), 1.0, 0.1))
    assert got == [(0, 0, 60, 0, 0), (1, 0, 40, 1, 0), (2, 0, 30, 1, 40), (3, 0, 20, 0, 60),
                   (3, 20, 10, 1, 70)]
    assert sum(packing.capacities(5000, 4096)) == 5000


# sharding ----------------------------------------------------------------------------------

def test_shards_fit_and_hold_every_row(spark, odd_docs):
    limit = 3000
    rows = sharding.assign_shards(odd_docs, limit).collect()
    assert len(rows) == odd_docs.count()
    size = collections.Counter()
    for r in rows:
        size[r.shard] += r.n_bytes
    for r in rows:
        assert r.shard_bytes == size[r.shard]
        assert r.fits == (r.shard_bytes <= limit) and (r.fits or r.shard_docs == 1)
    shards = sorted(size)
    assert not any(b.startswith(a) for a in shards for b in shards if a != b)
    assert sharding.assign_shards(empty(odd_docs), limit).count() == 0


def test_a_hot_key_is_split_below_its_hash(spark):
    df = spark.createDataFrame([(1, "x" * 100)] * 30, "doc_id long, text string")
    rows = sharding.assign_shards(df, 1000).collect()
    assert len(rows) == 30 and all(r.fits for r in rows)
    assert min(r.depth for r in rows) > sharding.HASH_BITS


def test_each_row_is_written_once_to_its_shard(spark, tmp_path):
    rows = [(1, "x" * 100, i) for i in range(30)] + [(None, "y" * 50, 90), (None, None, 91), (2, "", 92)]
    df = spark.createDataFrame(rows, "doc_id long, text string, key long")
    sharding.write_shards(df, f"{tmp_path}/shards", 1000)
    size, got = collections.Counter(), []
    for folder in (tmp_path / "shards").glob("shard=*"):
        for r in spark.read.parquet(str(folder)).collect():
            size[folder.name] += len(r.text or "")
            got.append((r.doc_id, r.text, r.key))
    assert sorted(got, key=lambda r: r[2]) == rows
    assert len(size) > 3 and max(size.values()) <= 1000


# quality rules -----------------------------------------------------------------------------

def base_counts(t):
    t = t or ""
    words = t.encode().split()
    lines = [x for x in t.split("\n") if x.encode().split()]
    wins = collections.Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    hit = {i + j for i in range(len(words) - 2) if wins[tuple(words[i:i + 3])] > 1 for j in range(3)}
    return (len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in t),
            len(lines) - len(set(lines)), len(hit))


def test_counts_match_brute_force(spark, odd_docs):
    more = spark.createDataFrame([(20, "a b c\na b c\n\nx # $ a b c a b c", "en", 0.0, 1),
                                  (21, "é ß %\x0b&", "de", 0.0, 1)], DOCS)
    docs = odd_docs.unionByName(more)
    rows = quality_rules.judge(docs).collect()
    got = sorted(((r.doc_id or -1), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines,
                  r.n_repeat_words) for r in rows)
    assert got == sorted(((r.doc_id or -1), *base_counts(r.text)) for r in docs.collect())
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)
    assert quality_rules.judge(empty(docs)).count() == 0


def test_em_weighs_votes_by_estimated_accuracy(spark):
    # rule 0 agrees with rule 2; rule 1 contradicts both half of the time
    rows = [([1, 1, 1], 40), ([1, 0, 1], 40), ([0, 1, 0], 10), ([0, 0, 0], 10), ([0, None, 1], 1)]
    p = spark.createDataFrame(rows, "votes array<int>, n long")
    a = quality_rules.fit_accuracies(p, 3, 25)
    assert a[0] > 0.9 and a[2] > 0.9 and 0.3 < a[1] < 0.7


def test_a_bad_vote_can_be_outvoted(spark):
    letters = str.maketrans("0123456789", "abcdefghij")

    def lines(i, n):  # whole sentences, all different
        return [text(1000 * i + j, 12).translate(letters) for j in range(n)]

    rows = [(i, "\n".join(lines(i, 8))) for i in range(150)]
    rows += [(i, "\n".join(f"{w} |" for w in " ".join(lines(i, 8)).split())) for i in range(200, 230)]
    # one rule accuses: equal short lines after a long text
    rows += [(i, "\n".join([*lines(i, 20), *["and"] * 12])) for i in range(300, 303)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in quality_rules.judge(docs).collect()}
    votes = {i: [r[k] for k in quality_rules.rules()] for i, r in got.items()}
    assert all(got[i].kept for i in range(150))
    assert not any(got[i].kept for i in range(200, 230))
    for i in range(300, 303):
        assert 0 in votes[i] and not got[i].base_failed and got[i].kept
    voted = list(zip(*votes.values(), strict=True))
    assert sum({0, 1} <= set(v) for v in voted) >= 3  # several rules vote both ways


# toxicity ----------------------------------------------------------------------------------

def test_toxic_sentences_are_found(spark):
    rng = np.random.default_rng(0)
    rows, labels = [], []
    for i in range(900):
        sentences = [" ".join(WORDS[j] for j in rng.integers(0, 400, 8)) for _ in range(6)]
        toxic = int(i % 3 == 0)
        if toxic:
            sentences[i % 6] += " vile"
        rows.append((i, ". ".join(sentences), "en", 0.0, i))
        labels.append((i, toxic, None))
    rows += [(1000, None, None, 0.0, 0), (1001, "", None, 0.0, 0), (None, "vile", None, 0.0, 0)]
    docs = spark.createDataFrame(rows, DOCS)
    lab = spark.createDataFrame(labels + [(1000, None, None)], "doc_id long, toxic int, text string")
    got = {r.doc_id: r for r in toxicity.classify(docs, lab).collect()}
    assert len(got) == 903 and got[1000].score == 0 and got[1001].n_sentences == 0
    for i in range(900):
        r = got[i]
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert r.predicted == int(i % 3 == 0) and 0 <= r.score <= 1
        if r.predicted:
            (s,) = r.offending
            assert "vile" in rows[i][1][s.start:s.end]
    assert toxicity.classify(empty(docs), lab).count() == 0
    assert toxicity.classify(docs, empty(lab)).agg(F.max("score")).first()[0] < 1e-9


def test_rare_words_and_languages_train(spark, monkeypatch):
    # a word in 9 of 45 toxic and no clean document tells; chance words do not
    inside, count = np.array([9.0, 3.0, 1.0, 45.0]), np.array([9.0, 3.0, 2.0, 329.0])
    assert toxicity.telling(inside, count, 45.0, 284.0).tolist() == [True, False, False, False]
    monkeypatch.setattr(toxicity, "MAX_POSITIVE", 60)
    rows = [(i, f"w{i}", "xx" if i % 50 == 0 else "en") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i, _, _ in rows], "doc_id long, toxic int")
    drawn = {r.text for r in toxicity.training_sample(docs, labels).collect()}
    rare = {f"w{i}" for i in range(0, 2000, 50) if zlib.crc32(str(i).encode()) % 5}
    assert len(drawn) == 60 and len(drawn & rare) >= 0.7 * min(30, len(rare))


def test_a_clean_text_scores_nothing_at_any_length():
    weights = collections.defaultdict(float, {b"vile": 9.0, b"kind": -0.5})
    clean = b"plain words here. kind words there. " * 50_000
    score, n, found = toxicity.score_text(clean, weights, toxicity.BIAS, 0.5)
    assert (score, n, found) == (0.0, 100_000, [])  # the last blank is no sentence
    score, _, found = toxicity.score_text(clean + b"so vile", weights, toxicity.BIAS, 0.5)
    assert score > 0.5 and len(found) == 1


# nearest neighbours ------------------------------------------------------------------------

def test_neighbours_match_brute_force(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 8))
    x[100:300] = x[100]  # one vector holds a third of the rows
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    bad = [(1000, None, 1), (1050, [0.0] * 8, 1), (1100, [1.0, None] + [0.0] * 6, 1),
           (1150, [float("nan")] * 8, 1), (1200, [1.0, 2.0], 1), (None, [1.0] * 8, 1), rows[50]]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, rank int")
    got = collections.defaultdict(list)
    for r in ann.nearest(df, probe=9.0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert sorted(got) == list(range(0, 600, 50))
    n = x / np.linalg.norm(x, axis=1, keepdims=True)
    for q, found in got.items():
        s = np.round(n @ n[q], 12)
        s[q] = -2
        assert [v for v, _ in found] == np.lexsort((np.arange(600), -s))[:5].tolist()
        assert np.allclose([c for _, c in found], s[[v for v, _ in found]])
    assert ann.nearest(empty(df)).count() == 0
    assert ann.nearest(df.where("vec_id in (0, 1)")).count() == 1


def test_recall_on_the_table(spark, sf_oracle):
    got = {(r.query_id, r.vec_id) for r in QUERIES["op2_balanced_posting_lists"](
        spark, sf_oracle).collect()}
    t = common.table(spark, sf_oracle, "embeddings").toPandas()
    x = np.stack(t.embedding.map(lambda v: np.asarray(v, float)))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hit = total = 0
    for i in np.flatnonzero(t.vec_id % 50 == 0):
        s = x @ x[i]
        s[i] = -2
        top = t.vec_id.iloc[np.argsort(-s)[:5]]
        hit += sum((t.vec_id.iloc[i], v) in got for v in top)
        total += 5
    assert hit / total >= 0.9


# quotation linking -------------------------------------------------------------------------

CONV = "conv_id long, turn int, role string, text string, level int"


def test_quotes_become_replies(spark):
    rows = [(1, 0, "u", "Hello there\nsecond  line"), (1, 1, "a", "> hello  THERE\nmy answer"),
            (1, 2, "u", "> > second line\n> my answer\nthanks"), (1, 3, "a", "> nobody said\nx"),
            (1, 4, "u", None), (2, 0, "u", "> thanks\nnew"), (2, 0, "u", "> thanks\nnew"),
            (None, 1, "u", "> thanks"), (3, None, "u", ""), (1, 5, "u", "> thanks\n>\n> x")]
    df = spark.createDataFrame([(*r, 9) for r in rows], CONV)
    got = {(r.conv_id, r.turn): r for r in quoting.conversations(df).collect()}
    assert len(got) == 9
    assert (got[1, 1].parent_turn, got[1, 1].depth, got[1, 1].text) == (0, 1, "my answer")
    assert (got[1, 2].parent_turn, got[1, 2].root_turn, got[1, 2].depth) == (1, 0, 2)
    assert got[1, 2].max_level == 2 and got[1, 2].text == "thanks"
    assert got[1, 3].parent_turn is None and got[1, 3].n_linked == 0 and got[1, 3].text == "x"
    assert got[1, 4].text == "" and got[1, 4].depth == 0
    assert got[2, 0].parent_turn is None and got[2, 0].n_linked == 1
    assert got[1, 5].parent_turn == 3 and got[1, 5].root_turn == 3
    assert got[None, 1].n_quoted == 1 and got[3, None].depth == 0
    assert quoting.conversations(empty(df)).count() == 0


# substring removal -------------------------------------------------------------------------

def brute_cut(docs):
    first = {}
    for i, t in docs:
        w = (t or "").encode().split()
        for j in range(len(w) - 49):
            if i is not None:
                h = b" ".join(w[j:j + 50])
                first[h] = min(first.get(h, i), i)
    out = []
    for i, t in docs:
        w = (t or "").encode().split()
        gone = set()
        for j in range(len(w) - 49):
            if i is not None and first[b" ".join(w[j:j + 50])] < i:
                gone |= set(range(j, j + 50))
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((-1 if i is None else i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_removal_matches_brute_force(spark, odd_docs):
    rng = np.random.default_rng(8)
    common_part = text(50, 200).split()
    more = []
    for i in range(100, 160):  # overlapping stretches of one passage in fresh surroundings
        a, n = int(rng.integers(0, 140)), int(rng.integers(30, 120))
        more.append((i, " ".join([text(i, 20), *common_part[a:a + n], text(i + 500, 20)]),
                     "en", 0.0, 1))
    docs = odd_docs.unionByName(spark.createDataFrame(more, DOCS))
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept_sha256)
                 for r in debruijn.removed(docs).collect())
    assert got == brute_cut([(r.doc_id, r.text) for r in docs.collect()])
    assert sum(r[2] for r in got) > 1000
    assert debruijn.removed(empty(docs)).count() == 0


# streaming Viterbi -------------------------------------------------------------------------

def brute_viterbi(seg, marked):
    best, back = [0.0], [None]
    for end in range(1, len(marked) + 1):
        options = [(best[end - 1] + seg.unknown, -(end - 1), -1)]
        for a in range(max(0, end - seg.max_piece), end):
            if marked[a:end] in seg.pieces:
                i, s = seg.pieces[marked[a:end]]
                options.append((best[a] + s, -a, i))
        pieces = [o for o in options if o[2] >= 0] or options
        top = max(pieces + [o for o in options if o[0] > max(p[0] for p in pieces)])
        best.append(top[0])
        back.append((-top[1], top[2]))
    out, at = [], len(marked)
    while at:
        src, i = back[at]
        out = ([i] if i >= 0 else [seg.byte_ids[b] for b in
               marked[src:at].replace("▁", " ").encode()]) + out
        at = src
    return out


def test_streaming_equals_full_search(spark, odd_docs):
    path = tokenizer_file("piece_bpe_32k.model")
    seg = viterbi.segmenter(path)
    for t in ["", "Hello  world", "a" * 500, "日本語のテキスト🙂" * 20, " lead\n\ttabs  ", "x=1;" * 200]:
        marked = "▁" + t.replace(" ", "▁") if t else ""
        want = brute_viterbi(seg, marked)
        assert list(seg.stream([marked[i:i + 7] for i in range(0, len(marked), 7)])) == want
        assert seg.encode(t).tolist() == want
        assert seg.decode(seg.encode(t)) == t
    rows = viterbi.digest(odd_docs, path).collect()
    assert len(rows) == odd_docs.count() and all(r.exact for r in rows)
    ids = viterbi.encode(odd_docs.where("doc_id is not null"), path)
    back = {r.doc_id: r.text for r in viterbi.decode(ids, path).collect()}
    assert back[0] == BASE and back[3] == "" and back[6] == LONG
    assert viterbi.digest(empty(odd_docs), path).count() == 0


def test_windows_commit_inside_a_text(monkeypatch):
    seg = viterbi.segmenter(tokenizer_file("piece_bpe_32k.model"))
    text = " ".join(f"word{i * i} and, then: Zwölf x{i}" for i in range(20_000))
    marked = "▁" + text.replace(" ", "▁")
    kept, commits, ids = [], 0, []
    rest = ""
    for i in range(0, len(marked), 1000):
        [(got, rest)] = seg.advance([(rest + marked[i:i + 1000], False)])
        commits += len(got) > 0
        kept.append(len(rest))
        ids += got.tolist()
    ids += seg.advance([(rest, True)])[0][0].tolist()
    # every chunk commits, and what stays open is a few words, however long the text
    assert commits == len(kept) > 500 and max(kept) < 100
    assert ids == seg.encode(text).tolist()
    assert ids[:400] == brute_viterbi(seg, marked[:3000])[:400]

    # chunks of any length, texts that share a round, windows open over several chunks
    rng = np.random.default_rng(8)
    words = ["the", "tion", "aaaaaa", "é", "日本", "🙂", " ", "  ", "\n", "▁", "=" * 70, "ab" * 60, "\x00"]
    texts = ["", "x", "▁"] + ["".join(rng.choice(words, n)) for n in rng.integers(0, 60, 40)]
    want = [brute_viterbi(seg, "▁" + t.replace(" ", "▁") if t else "") for t in texts]
    for chunk in (1, 7, 64, 300, 1 << 17):
        monkeypatch.setattr(viterbi, "CHUNK", chunk)
        got, part = [], []
        for ids, last in seg.encode_all(texts):
            part += ids.tolist()
            if last:
                got.append(part)
                part = []
        assert got == want


def test_memory_follows_the_chunk_not_the_text():
    seg = viterbi.segmenter(tokenizer_file("piece_bpe_32k.model"))
    peaks = []
    for n in (30_000, 300_000):
        text = " ".join(f"w{i:x} some, words" for i in range(n))
        tracemalloc.start()
        again = viterbi.Digest(seg)
        source = text.encode()
        before = tracemalloc.get_traced_memory()[0]
        for ids, _ in seg.encode_all([text]):
            again.add(ids, source)
        peaks.append(tracemalloc.get_traced_memory()[1] - before)
        tracemalloc.stop()
        assert again.row(source)[4]
    assert peaks[1] < 1.2 * peaks[0]  # ten times the text


# Jaccard join ------------------------------------------------------------------------------

def brute_components(docs, k, percent):
    sets = {}
    for i, t in docs:
        w = (t or "").lower().encode().split()
        sets[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else (
            {tuple(w)} if w else set())
    comp = {i: i for i in sets}
    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = comp[i], comp[j]
                comp = {x: min(a, b) if c in (a, b) else c for x, c in comp.items()}
    return {i: (len(s), comp[i]) for i, s in sets.items()}


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80)])
def test_components_match_brute_force(spark, odd_docs, k, percent):
    rng = np.random.default_rng(4)
    more = []
    for i in range(100, 180):  # chains of edits, partly below the threshold
        w = BASE.split() if i % 2 else text(77, 60).split()
        for p in rng.integers(0, len(w), int(rng.integers(0, 5))):
            w[p] = f"edit{i}"
        more.append((i, " ".join(w), "en", 0.0, 1))
    docs = odd_docs.unionByName(spark.createDataFrame(more, DOCS))
    rows = jaccard.link_components(docs, k, percent).collect()
    assert len(rows) == docs.count()
    want = brute_components([(r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None],
                            k, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows if r.doc_id is not None} == want
    if percent == 90:
        assert jaccard.link_components(empty(docs), k, percent).count() == 0


def test_region_join_finds_all_pairs_within_reach():
    rng = np.random.default_rng(1)
    c = rng.poisson(3, (900, 16))
    c[450:] = np.maximum(0, c[:450] + rng.integers(-1, 2, (450, 16)) * (rng.random((450, 16)) < 0.1))
    n, comp, block = c.sum(axis=1), np.arange(900), np.zeros(900, int)
    got = {(min(a, b), max(a, b)) for i, j in jaccard._near(c, n, comp, block, 0, 0, 90)
           for a, b in zip(i, j)}
    want = {(i, j) for i in range(900) for j in range(i + 1, 900)
            if np.abs(c[i] - c[j]).sum() <= (n[i] + n[j]) * 10 / 190}
    assert got == want and want


def family(n_docs, rng, words=700, edits=9):
    """Copies of one passage with so many edits each that hardly any two are similar enough."""
    base = [f"w{i}" for i in range(words)]
    out = []
    for d in range(n_docs):
        text = list(base)
        for i in rng.choice(words, edits, replace=False):
            text[i] = f"e{d}x{i}"
        out.append((d, " ".join(text)))
    return out


def test_alike_but_unlinked_family_grows_in_proportion(spark, monkeypatch):
    rng = np.random.default_rng(9)
    passed = []
    plain = jaccard.region_pairs

    def counted(*args, **kw):
        got = plain(*args, **kw)
        passed.append(got.count())
        return got

    monkeypatch.setattr(jaccard, "region_pairs", counted)
    for n in (40, 80):
        rows = family(n, rng, edits=11)
        rows += [(n + d, t + f" tail{d}") for d, t in rows[:n // 2]]  # links that step 1 may miss
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        got = {r.doc_id: r.component_id for r in jaccard.link_components(docs, 5, 80).collect()}
        want = brute_components(rows, 5, 80)
        assert {k: got[k] for k in want} == {k: want[k][1] for k in want} and len(got) == len(rows)
        assert len(set(got.values())) > n // 2
        assert passed[-1] < len(rows)


@pytest.mark.parametrize("bits", [32, 7])
def test_place_links_and_hidden_links(spark, monkeypatch, bits):
    """With halves of 7 bits nearly everything passes for linked: the second pass must mend it."""
    def few_bits(sets):
        mask = np.uint32((1 << bits) - 1)

        def run(batches):
            for b in batches:
                h = [(np.frombuffer(x.as_py(), np.uint64).astype("<u4") & mask).tobytes()
                     for x in b.column(1)]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(h, pa.binary())],
                                                 names=["doc_id", "h"])
        return sets.mapInArrow(run, "doc_id long, h binary")

    monkeypatch.setattr(jaccard, "halves", few_bits)
    rng = np.random.default_rng(3)
    rows = family(60, rng, words=120, edits=2)
    rows += [(60 + d, t + " more") for d, t in rows[::3]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.link_components(docs, 3, 90).collect()}
    assert got == {k: v[1] for k, v in brute_components(rows, 3, 90).items()}


def test_blocks_of_a_place(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = family(80, rng, words=150, edits=3)
    rows += [(80 + d, t + " more") for d, t in rows[::2]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {k: v[1] for k, v in brute_components(rows, 3, 90).items()}
    monkeypatch.setattr(jaccard, "BLOCK_BYTES", 9_000)  # some blocks of a dozen documents
    got = {r.doc_id: r.component_id for r in jaccard.link_components(docs, 3, 90).collect()}
    assert got == want and len(set(want.values())) > 1


# Kneser-Ney --------------------------------------------------------------------------------

def brute_kneser_ney(words):
    """log P of each gram's last symbol by the recursive definition."""
    grams = collections.Counter(kneser_ney.grams([w.encode() for w in words])[0].tolist())
    order, bits = kneser_ney.ORDER, kneser_ney.BITS
    counts = {order: grams}
    for k in range(order - 1, 0, -1):
        counts[k] = collections.Counter(g & ((1 << bits * k) - 1) for g in counts[k + 1])

    def discount(k, c):
        n = [sum(v == i for v in counts[k].values()) for i in (1, 2, 3, 4)]
        i = min(c, 3) - 1
        y = n[0] / (n[0] + 2 * n[1]) if n[0] + 2 * n[1] else None
        d = (i + 1) - (i + 2) * y * n[i + 1] / n[i] if y is not None and n[i] else None
        return d if d is not None and 0 < d < i + 1 else 0.5 * (i + 1)

    def p(g, k):
        if not k:
            return 1 / (len(counts[1]) + 1)
        rest = p(g & ((1 << bits * (k - 1)) - 1), k - 1)
        same = [(x, c) for x, c in counts[k].items() if x >> bits == g >> bits]
        if not same:
            return rest
        total = sum(c for _, c in same)
        c = counts[k].get(g, 0)
        return (c - discount(k, c) if c else 0) / total + sum(
            discount(k, x) for _, x in same) / total * rest
    return p


def test_perplexities_match_the_definition(spark):
    train = "the cat sat on the mat and the cat ran at that rat the the a aa aaa b".split()
    docs = spark.createDataFrame([("en", " ".join(train))], "lang string, text string")
    model = kneser_ney.estimate(kneser_ney.count_grams(docs))
    p = brute_kneser_ney(train)
    seen = "the cat zebra on Xu a b".split()
    want = sum(math.log(p(int(g), kneser_ney.ORDER))
               for w in seen for g in kneser_ney.grams([w.encode()])[0])
    todo = spark.createDataFrame([(1, "en", " ".join(seen)), (2, "xx", "the"), (3, "en", None)],
                                 "doc_id long, lang string, text string")
    for way in (kneser_ney.score_broadcast, kneser_ney.score_joined):
        got = {r.doc_id: r for r in way(todo, model).collect()}
        assert got[1].n_chars == sum(len(w) + 1 for w in seen)
        assert abs(got[1].log_prob - want) < 1e-4
        assert got[2].log_prob is None and got[3].n_chars == 0


def test_quality_keeps_clean_and_rejects_junk(spark):
    rng = np.random.default_rng(2)
    rows = [(i, text(i, 120), "en", 0.0, 1) for i in range(200)]
    rows += [(i, "".join(chr(33 + c) for c in rng.integers(0, 90, 500)), "en", 0.0, 1)
             for i in range(200, 210)]
    rows += [(300, None, "en", 0.0, 1), (301, "", None, 0.0, 1), (302, "abc", "zz", 0.0, 1),
             (None, text(1, 50), "en", 0.0, 1), (5, text(5, 120), "en", 0.0, 1)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, 1) for i in range(150)] + [(300, None), (200, 0)],
                                   "doc_id long, quality int")
    got = kneser_ney.classify(docs, labels).collect()
    assert len(got) == len(rows)
    assert {r.doc_id for r in got if not r.kept} == set(range(200, 210))
    assert kneser_ney.classify(empty(docs), labels).count() == 0
    assert kneser_ney.classify(docs, empty(labels)).where("not kept").count() == 0


# pipeline ----------------------------------------------------------------------------------

def test_pipeline_stages(spark, sf_oracle):
    import corpus_pipeline as cp
    docs = common.table(spark, sf_oracle, "documents")
    before = docs
    for name, stage in cp.STAGES[:-1]:
        after = common.materialize(stage(spark, before, sf_oracle), "test-stage")
        assert after.columns == docs.columns, name
        assert 0 < after.count() <= before.count()
        before = after
    ids = {r.doc_id for r in before.select("doc_id").collect()}
    packed = cp.STAGES[-1][1](spark, before, sf_oracle)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == ids


def test_verdicts_hold_for_rows_not_ids(spark, tmp_path):
    import corpus_pipeline as cp
    rng = np.random.default_rng(5)
    junk = "".join(chr(33 + c) for c in rng.integers(0, 90, 500))
    rows = [(i, text(i, 60) + (". so vile" if i % 3 == 0 else "")) for i in range(600)]
    more = [(None, junk), (None, text(1, 60)), (700, junk), (700, text(7, 60)),
            (None, "so vile"), (701, "so vile"), (701, text(8, 60))]
    docs = spark.createDataFrame([(i, t, "en", "src", len(t)) for i, t in rows + more],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(600)],
                          "doc_id long, quality int, toxic int").write.parquet(
                              f"{tmp_path}/labels.parquet")

    def odd(df):
        assert df.columns == docs.columns
        return sorted((r.doc_id or 0, r.text) for r in df.collect() if r.doc_id in (None, 700, 701))
    kept = odd(cp.keep_quality(spark, docs, str(tmp_path)))
    assert kept == sorted((i or 0, t) for i, t in more if t != junk)
    kept = odd(cp.drop_toxic(spark, docs, str(tmp_path)))
    assert kept == sorted((i or 0, t) for i, t in more if t != "so vile")


def test_alike_documents_meet_once_in_a_place():
    """Regions that would hold nearly all documents each are not made: at most all pairs are looked at."""
    rng = np.random.default_rng(5)
    base = np.arange(150, dtype=np.uint32)
    sets = [np.unique(np.where(rng.random(150) < 0.12, rng.integers(1000, 2**31, 150), base)).astype("<u4")
            for _ in range(500)]
    place = jaccard.Place(np.arange(500), sets, 90)
    looked = jaccard._near(place.counts(), place.n, place.label.copy(), np.zeros(500, np.int32), 0, 0, 90)
    rows = 0
    for i, _ in looked:
        rows += 1
        assert rows < 2 * 500
    apart = [np.unique(rng.integers(0, 2**31, 150)).astype("<u4") for _ in range(600)]
    sets = [np.concatenate([x[:145], y]).astype("<u4") for x in apart for y in (x[145:], x[140:145] + 1)]
    place = jaccard.Place(np.arange(len(sets)), sets, 90)
    got = {tuple(sorted(x)) for x in place.links(jaccard._near(
        place.counts(), place.n, place.label.copy(), np.zeros(len(sets), np.int32), 0, 0, 90), False)}
    assert got >= {(2 * i, 2 * i + 1) for i in range(600)}


def test_components_of_edges_in_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(common, "CHUNK_EDGES", 40)
    written = []
    monkeypatch.setattr(common, "materialize", lambda df, name, m=common.materialize: written.append(1) or m(df, name))
    rng = np.random.default_rng(3)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 900, (500, 2)) if a != b]
    pairs += [(i, i + 1) for i in range(1000, 1300)] + [(2000, i) for i in range(2001, 2200)] + [(7, 2**62)]
    up: dict[int, int] = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    want = {x: find(x) for x in list(up) if find(x) != x}
    edges = spark.createDataFrame(pairs * 2, "a long, b long").repartition(5)
    got = {r.node: r.component for r in common.components(edges, "t").collect()}
    assert got == want
    written.clear()
    stars = spark.createDataFrame([(i, i % 7) for i in range(7, 500)], "a long, b long")
    assert {r.node: r.component for r in common.components(stars, "t").collect()} == {i: i % 7 for i in range(7, 500)}
    assert len(written) == 1
    assert common.components(stars.where("a < 0"), "t").count() == 0


def test_stages_hand_texts_on_in_bounded_batches(spark, monkeypatch):
    import corpus_pipeline as cp
    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.range(0, 2000, 1, 1).selectExpr("id as doc_id", "repeat('ten bytes ', 1000) as text")

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"])
    monkeypatch.setattr(cp.packing, "pack", lambda docs, path: docs.mapInArrow(sizes, "n long"))
    try:
        got = [r.n for r in cp.STAGES[-1][1](spark, docs, "").collect()]
        assert sum(got) >= 2000 * 10_000 and max(got) <= common.BATCH_BYTES + 20_000
        spark.conf.set(size, "1000000b")  # a session's own size stays
        got = [r.n for r in cp.STAGES[-1][1](spark, docs, "").collect()]
        assert sum(got) >= 2000 * 10_000 and max(got) <= 1_020_000
    finally:
        spark.conf.unset(size)


def test_passes_return_arrow_memory_at_their_end(monkeypatch):
    done = []
    pool = type("Pool", (), {"release_unused": lambda self: done.append(len(seen))})
    monkeypatch.setattr(pa, "default_memory_pool", pool)
    seen: list[int] = []
    for x in common.frugal(lambda batches: (2 * b for b in batches))(iter([1, 2, 3])):
        assert not done
        seen.append(x)
    assert seen == [2, 4, 6] and done == [3]


def test_ngrams_are_counted_over_batches(spark, monkeypatch):
    """However the texts are cut into batches, a task passes each n-gram on once per COUNT_WORDS."""
    rows = [("de" if i % 3 else "", text(i, 30)) for i in range(200)]
    docs = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    want = collections.Counter()
    for lang, t in rows:
        g, _ = kneser_ney.grams(t.encode().split())
        want.update((lang, int(x)) for x in g)

    def passed(df):  # rows on their way into the shuffle
        monkeypatch.setattr(type(df), "groupBy", lambda self, *c: type("Rows", (), {"agg": lambda _, *a: self}))
        out = kneser_ney.count_grams(df)
        monkeypatch.undo()
        return out.count()
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    try:
        spark.conf.set(size, 7)
        assert passed(docs) == len(want)
        monkeypatch.setattr(kneser_ney, "COUNT_WORDS", 50)
        got = {(r.lang, r.g): r.c for r in kneser_ney.count_grams(docs).collect()}
    finally:
        spark.conf.set(size, before)
    assert got == dict(want)
