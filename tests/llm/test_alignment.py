"""Alignment, prefix trie and WARC: brute force, SQL and the defined edge cases."""

import hashlib
import json
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from worklens.llm import alignment
from worklens.llm.queries import QUERIES, tokenizer_file

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"


def plain(docs):
    """The contract, token pair by token pair, with the files' own libraries."""
    import sentencepiece
    from tokenizers import Tokenizer
    a_tok = Tokenizer.from_file(tokenizer_file(A_FILE))
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file(B_FILE))
    with open(tokenizer_file(A_FILE), encoding="utf-8") as f:
        spell = {i: t for t, i in json.load(f)["model"]["vocab"].items()}
    table = alignment.byte_table()
    out, per_doc, corpus = [], [], Counter()
    for doc_id, text in docs:
        a = a_tok.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_tok.encode(text) if text else []
        raw_a = [bytes(table[c] for c in spell[i]) for i in a]
        raw_b = [bytes([int(b_tok.id_to_piece(i)[3:5], 16)]) if b_tok.is_byte(i) else
                 b_tok.id_to_piece(i).replace("▁", " ").encode() for i in b]
        whole = (" " + text).encode() if text else b""
        if b"".join(raw_a) != whole or b"".join(raw_b) != whole or not text:
            out.append((doc_id, [], [], [], []))
            per_doc.append(Counter())
            continue
        ends_a, ends_b = np.cumsum(list(map(len, raw_a))), np.cumsum(list(map(len, raw_b)))
        links = [(x, y) for i, x in enumerate(a) for j, y in enumerate(b)
                 if max(ends_a[i] - len(raw_a[i]), ends_b[j] - len(raw_b[j])) < min(ends_a[i], ends_b[j])]
        cuts = sorted(set(ends_a) & set(ends_b))
        groups, lo = [], 0
        for c in cuts:
            groups.append(([x for x, e in zip(a, ends_a) if lo < e <= c], [y for y, e in zip(b, ends_b) if lo < e <= c]))
            lo = c
        per_doc.append(Counter(links))
        corpus.update(per_doc[-1].keys())
        out.append((doc_id, a, b, groups, links))
    best = defaultdict(int)
    for (x, _), n in corpus.items():
        best[x] = max(best[x], n)
    rows = []
    for doc_id, a, b, groups, links in out:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        rows.append((doc_id, len(a), len(b), len(groups), len(links),
                     sum(corpus[p] == best[p[0]] for p in links), sum(corpus[p] for p in links),
                     hashlib.sha256(text.encode()).hexdigest() if a else ""))
    times = Counter()
    for c in per_doc:
        times.update(c)
    return rows, corpus, times


COLS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = ["", None, "one", " two  spaces ", "a\n\n\tb", "naïve ﬁ 漢字 😀", "<|endoftext|> <s> </s>", "x▁y", "▁",
       "the the the the the " * 9, "don't can't I'll", "  x  y", "é ´ ", "\x00\x01", "the cat", "the cat",
       "12345 67 8", "-" * 90, "ab" * 200]


def by_key(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


@pytest.fixture(scope="module")
def odd_texts(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(2, "one"), (None, "the cat"), (None, None)]
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n_a long, pair string")


def aligned(docs):
    return alignment.align_documents(docs, tokenizer_file(A_FILE), tokenizer_file(B_FILE))


def test_alignment_of_odd_texts(odd_texts):
    want, _, _ = plain([(r.doc_id, r.text) for r in odd_texts.collect()])
    df = aligned(odd_texts)
    assert df.columns == COLS
    assert by_key(map(tuple, df.collect())) == by_key(want)


def test_alignment_of_a_table(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").where("length(text) < 600")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want, corpus, times = plain(rows)
    assert by_key(map(tuple, aligned(docs).collect())) == by_key(want)
    index = alignment.pair_postings(docs, tokenizer_file(A_FILE), tokenizer_file(B_FILE))
    got = {(r.a_id, r.b_id): (r.n_docs, r.n_links) for r in alignment.pair_counts(index).collect()}
    assert got == {p: (corpus[p], times[p]) for p in corpus}


def test_alignment_over_segments_and_parts(odd_texts):
    """Tiny segments, batches and parts give the same rows."""
    want, _, _ = plain([(r.doc_id, r.text) for r in odd_texts.collect()])
    index = alignment.pair_postings(odd_texts.coalesce(1), tokenizer_file(A_FILE), tokenizer_file(B_FILE),
                                    segment_postings=20, batch_bytes=16, part_chars=8)
    assert index.select("segment").distinct().count() > 3
    assert by_key(map(tuple, alignment.document_scores(index).collect())) == by_key(want)
    text = "some words, then more\nof them. " * 40
    assert list(alignment.parts(text, 50)) != [" " + text]
    assert "".join(alignment.parts(text, 50)) == " " + text
    al = alignment.aligner(tokenizer_file(A_FILE), tokenizer_file(B_FILE))
    for t in [text, *filter(None, ODD)]:
        whole, cut = al.tokens(" " + t), [al.tokens(p) for p in alignment.parts(t, 5)]
        if whole is None:
            assert None in cut
        else:
            for side in (0, 1):
                assert np.concatenate([c[side] for c in cut]).tolist() == whole[side].tolist()


def test_fast_ranks_equal_the_file():
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_file(A_FILE))
    tok.encode_special_tokens = True
    fast = alignment.ByteBpe(tokenizer_file(A_FILE))
    for cp in [*range(0x3000), *range(0x1f300, 0x1f700)]:
        c = chr(cp)
        t = f" a{c}1 {c}{c}b  {c}'{c}s\n{c}"
        assert fast.encode(t).tolist() == tok.encode(t, add_special_tokens=False).ids, hex(cp)


def test_containers_round_trip():
    rng = np.random.default_rng(5)
    pair, slot = [], []
    for p, n in enumerate([1, 3, 70, 4000, 60000, 2, 65536]):
        pair += [p] * n
        slot += sorted(rng.choice(65536, n, replace=False).tolist())
    pair, slot = np.array(pair), np.array(slot)
    seen = {}
    for ps, n, docs in alignment.containers(pair, slot):
        got, k = alignment.container_slots(docs)
        assert k.tolist() == n.tolist()
        for p, x in zip(ps, np.split(got, np.cumsum(k)[:-1]), strict=True):
            seen[int(p)] = x.tolist()
            assert len(docs[list(ps).index(p)].as_py()) <= 8192 + 3
    assert seen == {p: slot[pair == p].tolist() for p in set(pair.tolist())}
    sliced = pa.array([b"\0\1\0", b"\0\2\0\3\0", b"\1\0\0\5"]).cast(pa.binary()).slice(1)
    assert [x.tolist() for x in alignment.container_slots(sliced)] == [[2, 3, 0, 2], [2, 2]]


def test_alignment_of_nothing(odd_texts):
    assert aligned(odd_texts.where(F.lit(False))).collect() == []


def test_registered(spark):
    assert {"op11_pair_bitmaps", "op12_prefix_trie", "op13_warc_archives"} <= set(QUERIES)
    assert zlib.crc32(b"7") % 6 == spark.sql("select crc32(binary('7')) % 6 as h").first().h
