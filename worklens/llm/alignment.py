"""Alignment of two tokenizers by inverted pair bitmaps.

A text is encoded by a byte-level BPE file (A) and a SentencePiece file (B).  Byte
offsets where a token of both ends cut it into groups; tokens whose bytes overlap
are linked, and every end of a token of either side closes exactly one link.

Each task numbers the documents it reads and collects, for each pair of linked
ids, a compressed bitmap of the documents that hold it: the documents' bits are
OR-ed into a container per pair and segment (up to ``SEGMENT_DOCS`` documents and
about ``SEGMENT_POSTINGS`` postings), a list of 16-bit numbers or plain bits,
whichever is smaller.  Multiplicity planes hold the binary digits of a
document's further links of the pair.  Segments hold different documents, so a
pair's document count is the sum of its containers' popcounts, and its link
count that of all planes by their weight.

The postings then return the scores: each container meets its pair's count, goes
to its segment, and adds the count to the documents whose bits are set.  A pair
has one row per segment and plane however often it occurs, so no pair is hot.
The best count per A id has at most a row per id of A's vocabulary: broadcast.

Long texts are encoded in parts of about ``PART_CHARS`` characters, cut before a
space between two words, where both tokenizers always begin a token.

Defined cases: a null or empty text and a text that the tokens do not spell (one
with U+2581, which B reads as a space) has no tokens; repeated rows are documents
of their own; a null doc_id is kept; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worklens.llm.common import materialize

SEGMENT_DOCS, SEGMENT_POSTINGS = 1 << 16, 2_000_000
PART_CHARS = 1 << 20
#: Bytes of text that are aligned together.
BATCH_BYTES = 1 << 22
#: Bits of a B id within a pair.
B_BITS = 20
#: The pattern by which byte-level BPE files split a text before merging (fixed).
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BETWEEN_WORDS = re.compile(r"(?<=\S) (?=\S)")
MARK = "▁"

DOC_FIELDS = [("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
              ("n_links", pa.int64()), ("groups_sha256", pa.string())]
POSTING_FIELDS = [("pair", pa.int64()), ("plane", pa.int32()), ("n_docs", pa.int64()), ("docs", pa.binary())]
SCHEMA = pa.schema([("segment", pa.int64()), ("slot", pa.int32()), *DOC_FIELDS, *POSTING_FIELDS])
SCHEMA_SQL = ("segment long, slot int, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
              "groups_sha256 string, pair long, plane int, n_docs long, docs binary")


# tokenizers --------------------------------------------------------------------------------

def byte_table() -> dict[str, int]:
    """The characters by which byte-level files spell bytes: themselves where printable,
    else the characters from U+0100 on, in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class ByteBpe:
    """Ids of a byte-level BPE file, special tokens read as plain text.

    Where the file's merges are in id order, equal ids come from its vocabulary
    as merge ranks, which is faster; else the file is applied as it is.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        special = {t["content"] for t in file["added_tokens"]}
        vocab, table = file["model"]["vocab"], byte_table()
        spelled = {bytes(table[c] for c in t): i for t, i in vocab.items() if t not in special}
        self.raw = [b""] * (max(vocab.values()) + 1)
        for raw, i in spelled.items():
            self.raw[i] = raw
        merges = [m.split(" ") if isinstance(m, str) else m for m in file["model"]["merges"]]
        in_order = [vocab[a + b] for a, b in merges] == list(range(256, 256 + len(merges)))
        if in_order and file["normalizer"] is None and sorted(map(len, self.raw[:256])) == [1] * 256:
            import tiktoken
            ranks = tiktoken.Encoding("ranks", pat_str=PRE_TOKEN, mergeable_ranks=spelled, special_tokens={})
            self.encode = lambda text: ranks.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
        else:
            import os
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer
            tok = Tokenizer.from_file(path)
            tok.encode_special_tokens = True
            self.encode = lambda text: np.array(tok.encode(text, add_special_tokens=False).ids, np.int64)


class Pieces:
    """Ids of a SentencePiece file, which puts a space before a text."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.raw = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i)
                    else sp.id_to_piece(i).replace(MARK, " ").encode() for i in range(sp.get_piece_size())]
        self.encode = lambda text: np.array(sp.encode(text, num_threads=1), np.int64)


class Aligner:
    """Both tokenizers, the byte lengths of their tokens, and ids as decimal texts."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteBpe(path_a), Pieces(path_b)
        self.len_a, self.len_b = (np.array(list(map(len, t.raw)), np.int64) for t in (self.a, self.b))
        self.width = max(len(self.len_a), len(self.len_b))
        #: "," before a token within a group, ";" before a group, "|" between its sides.
        self.spelled = [f"{sep}{i}".encode() for sep in ",;|" for i in range(self.width)]

    def tokens(self, text: str) -> tuple[np.ndarray, np.ndarray, int] | None:
        """Ids of A and B and bytes of ``text``, which starts with a space; None if not spelled."""
        a, b, raw = self.a.encode(text), self.b.encode(text[1:]), text.encode("utf-8", "replace")
        for ids, tok in ((a, self.a), (b, self.b)):
            if b"".join(map(tok.raw.__getitem__, ids.tolist())) != raw:
                return None
        return a, b, len(raw)


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def parts(text: str, limit: int = PART_CHARS) -> Iterator[str]:
    """A space and the text, cut before spaces between words into parts of about ``limit``."""
    at, text = 0, " " + text
    while len(text) - at > limit and (cut := BETWEEN_WORDS.search(text, at + limit)):
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


def align(a: np.ndarray, b: np.ndarray, len_a: np.ndarray, len_b: np.ndarray):
    """Links (index into a, index into b, byte they end at), group ends, and the ids' order.

    ``a`` and ``b`` spell the same bytes.  The order lists (code, side first?) of
    all tokens group by group: 0 "," 1 ";" 2 "|" tells how each is joined.
    """
    end_a, end_b = np.cumsum(len_a[a]), np.cumsum(len_b[b])
    size = int(end_a[-1])
    at_a, at_b = np.zeros(size + 1, bool), np.zeros(size + 1, bool)
    at_a[end_a] = at_b[end_b] = True
    ends = np.flatnonzero(at_a | at_b)
    upto_a, upto_b = np.cumsum(at_a), np.cumsum(at_b)
    link_a, link_b = upto_a[ends] - at_a[ends], upto_b[ends] - at_b[ends]
    both = at_a & at_b
    groups = np.flatnonzero(both)
    upto_g = np.cumsum(both)
    g_a, g_b = upto_g[end_a] - both[end_a], upto_g[end_b] - both[end_b]
    closed = np.concatenate([[0], groups])
    a_before, b_before = upto_a[closed], upto_b[closed]  # tokens up to each group's begin
    place_a = np.arange(len(a)) + b_before[g_a]
    place_b = np.arange(len(b)) + a_before[g_b + 1]
    order, join = np.empty(len(a) + len(b), np.int64), np.zeros(len(a) + len(b), np.int64)
    order[place_a], order[place_b] = a, b
    join[place_a[a_before[:-1]]], join[place_b[b_before[:-1]]] = 1, 2
    return link_a, link_b, ends, groups, order, join


# containers --------------------------------------------------------------------------------

def containers(pair: np.ndarray, slot: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
    """(pairs, popcounts, containers) for rows sorted by pair and slot.

    A container is a byte 0 and the slots as 16-bit numbers, or a byte 1, the
    first slot's byte number as 16 bits, and bits from there on.
    """
    if not len(pair):
        return
    first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
    n = np.diff(np.concatenate([first, [len(pair)]]))
    lo, hi = slot[first] >> 3, slot[first + n - 1] >> 3
    dense = 2 + hi - lo + 1 < 2 * n
    few = np.repeat(~dense, n)
    size = 1 + 2 * n[~dense]
    offsets = np.concatenate([[0], np.cumsum(size)])
    body = np.ones(offsets[-1], bool)
    body[offsets[:-1]] = False
    data = np.zeros(offsets[-1], np.uint8)
    data[body] = slot[few].astype("<u2").view(np.uint8)
    yield pair[first[~dense]], n[~dense], pa.Array.from_buffers(
        pa.binary(), len(size), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])
    if dense.any():
        bits = []
        for f, k, low, high in zip(first[dense], n[dense], lo[dense], hi[dense], strict=True):
            row = np.zeros((high - low + 1) * 8, np.uint8)
            row[slot[f:f + k] - low * 8] = 1
            bits.append(b"\1" + int(low).to_bytes(2, "little") + np.packbits(row, bitorder="little").tobytes())
        yield pair[first[dense]], n[dense], pa.array(bits, pa.binary())


def container_slots(docs: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """The slots of all containers, one after the other, and how many each has."""
    offsets = np.frombuffer(docs.buffers()[1], np.int32)[docs.offset:docs.offset + len(docs) + 1]
    data = np.frombuffer(docs.buffers()[2] or b"", np.uint8)
    dense = data[offsets[:-1]] == 1
    n = (np.diff(offsets) - 1) // 2
    lists = {}
    for i in np.flatnonzero(dense):
        raw = data[offsets[i]:offsets[i + 1]]
        slots = np.flatnonzero(np.unpackbits(raw[3:], bitorder="little")) + 8 * (int(raw[1]) + 256 * int(raw[2]))
        lists[i], n[i] = slots, len(slots)
    body = np.zeros(int(offsets[-1] - offsets[0]), bool)
    starts = offsets[:-1] - offsets[0]
    mark = np.zeros(len(body) + 1, np.int32)
    np.add.at(mark, starts[~dense] + 1, 1)
    np.add.at(mark, (offsets[1:] - offsets[0])[~dense], -1)
    body = np.cumsum(mark[:-1]) > 0
    few = data[offsets[0]:offsets[-1]][body].view("<u2")
    if not lists:
        return few.astype(np.int64), n
    out = np.empty(int(n.sum()), np.int64)
    out[np.repeat(~dense, n)] = few
    out[np.repeat(dense, n)] = np.concatenate([lists[i] for i in sorted(lists)])
    return out, n


class Segment:
    """The documents and postings that a task has collected since it last wrote them."""

    def __init__(self, number: int):
        self.number, self.docs, self.pairs, self.slots, self.times, self.size = number, [], [], [], [], 0

    def add(self, pair: np.ndarray, slot: np.ndarray, times: np.ndarray) -> None:
        self.pairs.append(pair.astype(np.int64))
        self.slots.append(slot.astype(np.uint16))
        self.times.append(times.astype(np.int32))
        self.size += len(pair)

    def write(self) -> Iterator[pa.RecordBatch]:
        cols = list(zip(*self.docs, strict=True))
        yield _rows(self.number, len(self.docs), slot=range(len(self.docs)),
                    **{name: c for (name, _), c in zip(DOC_FIELDS, cols, strict=True)})
        if not self.size:
            return
        pair, slot, times = map(np.concatenate, (self.pairs, self.slots, self.times))
        spelled = np.array([bool(d[1]) for d in self.docs])[slot]  # a part may have failed later
        pair, slot, times = pair[spelled], slot[spelled].astype(np.int64), times[spelled]
        if not len(pair):
            return
        # Slots ascend already, so a stable sort by pair leaves them in order.
        by = np.argsort(pair, kind="stable")
        pair, slot, times = pair[by], slot[by], times[by]
        new = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (slot[1:] != slot[:-1])]))
        pair, slot, more = pair[new], slot[new], np.add.reduceat(times, new) - 1
        for plane in range(int(more.max()).bit_length() + 1):
            rows = np.flatnonzero(more >> plane - 1 & 1) if plane else np.arange(len(pair))
            for p, n, docs in containers(pair[rows], slot[rows]):
                yield _rows(self.number, len(p), pair=p, plane=np.full(len(p), plane), n_docs=n, docs=docs)


def _rows(segment: int, n: int, **cols) -> pa.RecordBatch:
    cols["segment"] = np.full(n, segment)
    return pa.RecordBatch.from_arrays(
        [cols[f.name] if isinstance(cols.get(f.name), pa.Array) else
         pa.array(cols[f.name], f.type) if f.name in cols else pa.nulls(n, f.type) for f in SCHEMA],
        schema=SCHEMA)


# tasks -------------------------------------------------------------------------------------

def _encode(docs: DataFrame, path_a: str, path_b: str, segment_postings: int, batch_bytes: int,
            part_chars: int) -> DataFrame:
    """Rows of documents (slot set) and of postings (pair set), by segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = aligner(path_a, path_b)
        number = TaskContext.get().partitionId() << 24
        seg = Segment(number)
        queue, queued, open_docs = [], 0, []

        def work():
            """Aligns the queued parts; each is (slot, a, b, bytes)."""
            if not queue:
                return
            slots = np.array([q[0] for q in queue])
            a, b = np.concatenate([q[1] for q in queue]), np.concatenate([q[2] for q in queue])
            until = np.cumsum([q[3] for q in queue])
            link_a, link_b, ends, groups, order, join = align(a, b, al.len_a, al.len_b)
            pair = a[link_a] << B_BITS | b[link_b]
            part = np.searchsorted(until, ends)
            key, times = np.unique(slots[part] << 40 | pair, return_counts=True)
            seg.add(key & ((1 << 40) - 1), key >> 40, times)
            n_groups = np.bincount(np.searchsorted(until, groups), minlength=len(queue))
            n_links = np.bincount(part, minlength=len(queue))
            codes, at = (join * al.width + order).tolist(), 0
            for i, (slot, pa_, pb_, _) in enumerate(queue):
                d = open_docs[slot]
                to = at + len(pa_) + len(pb_)
                text = b"".join(map(al.spelled.__getitem__, codes[at:to]))
                d["sha"].update(text if d["n_a"] else text[1:])
                at = to
                for c, n in (("n_a", len(pa_)), ("n_b", len(pb_)), ("n_groups", n_groups[i]),
                             ("n_links", n_links[i])):
                    d[c] += int(n)
            queue.clear()

        def finish():
            work()
            seg.docs = [(d["doc_id"], *((0, 0, 0, 0, "") if d["failed"] or not d["n_a"] else
                                        (d["n_a"], d["n_b"], d["n_groups"], d["n_links"], d["sha"].hexdigest())))
                        for d in open_docs]
            return seg.write()

        for batch in batches:
            texts = batch.column(1)
            for doc_id, text in zip(batch.column(0).to_pylist(), (t.as_py() for t in texts), strict=True):
                slot = len(open_docs)
                d = {"doc_id": doc_id, "sha": hashlib.sha256(), "failed": False,
                     "n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0}
                open_docs.append(d)
                for part in parts(text, part_chars) if text else ():
                    got = al.tokens(part)
                    if got is None:
                        d["failed"] = True
                        break
                    queue.append((slot, *got))
                    queued += got[2]
                    if queued >= batch_bytes:
                        work()
                        queued = 0
                if len(open_docs) >= SEGMENT_DOCS or seg.size >= segment_postings:
                    yield from finish()
                    number += 1
                    seg, open_docs, queued = Segment(number), [], 0
        if open_docs:
            yield from finish()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCHEMA_SQL)


def _return_scores(postings: DataFrame) -> DataFrame:
    """(segment, slot, count_sum, n_best) from (segment, docs, score, best), by segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sums = None, None

        def out():
            slots = np.flatnonzero(sums[0])
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(slots), at)), pa.array(slots.astype(np.int32)),
                 pa.array(sums[0][slots]), pa.array(sums[1][slots])],
                names=["segment", "slot", "count_sum", "n_best"])

        for b in batches:
            segment = b.column(0).to_numpy()
            cuts = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]])) if len(segment) else []
            for i, j in zip(cuts, [*cuts[1:], len(segment)], strict=True):
                if segment[i] != at:
                    if at is not None:
                        yield out()
                    at, sums = segment[i], np.zeros((2, SEGMENT_DOCS), np.int64)
                part = b.slice(i, j - i)
                slots, n = container_slots(part.column(1).cast(pa.binary()))
                for k in (0, 1):
                    np.add.at(sums[k], slots, np.repeat(part.column(2 + k).to_numpy(), n))
        if at is not None:
            yield out()

    rows = postings.select("segment", "docs", "score", "best").repartition("segment")
    return rows.sortWithinPartitions("segment").mapInArrow(
        run, "segment long, slot int, count_sum long, n_best long")


# tables ------------------------------------------------------------------------------------

#: Weight of a plane's bits: 0 has the documents, the others digits of their further links.
def _weight():
    return F.expr("case when plane = 0 then 1L else shiftleft(1L, plane - 1) end")


def pair_postings(docs: DataFrame, path_a: str, path_b: str, segment_postings: int = SEGMENT_POSTINGS,
                  batch_bytes: int = BATCH_BYTES, part_chars: int = PART_CHARS) -> DataFrame:
    """The index, written once: rows of documents and of postings (see SCHEMA)."""
    return materialize(_encode(docs, path_a, path_b, segment_postings, batch_bytes, part_chars),
                       "pair-postings")


def pair_counts(index: DataFrame) -> DataFrame:
    """(a_id, b_id, n_docs, n_links) of each pair that is linked anywhere."""
    counts = index.where("pair is not null").groupBy("pair").agg(
        F.sum(F.when(F.col("plane") == 0, F.col("n_docs")).otherwise(0)).alias("n_docs"),
        F.sum(F.col("n_docs") * _weight()).alias("n_links"))
    return counts.select(F.shiftright("pair", B_BITS).alias("a_id"),
                         F.col("pair").bitwiseAND(F.lit((1 << B_BITS) - 1)).alias("b_id"), "n_docs", "n_links")


def document_scores(index: DataFrame) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 per document of the index."""
    postings = index.where("pair is not null").select("segment", "pair", "plane", "n_docs", "docs")
    counts = postings.where("plane = 0").groupBy("pair").agg(F.sum("n_docs").alias("count"))
    # At most a row per id of A.
    most = counts.groupBy(F.shiftright("pair", B_BITS).alias("a_id")).agg(F.max("count").alias("most"))
    met = postings.drop("n_docs").join(counts, "pair").join(
        F.broadcast(most), F.shiftright("pair", B_BITS) == F.col("a_id"))
    weight = _weight()
    scored = met.select("segment", "docs", (F.col("count") * weight).alias("score"),
                        F.when(F.col("count") == F.col("most"), weight).otherwise(0).alias("best"))
    scores = _return_scores(scored)
    zero = F.lit(0).cast("long")
    return index.where("slot is not null").select(
        "segment", "slot", *[name for name, _ in DOC_FIELDS]).join(scores, ["segment", "slot"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")


def align_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    return document_scores(pair_postings(docs, path_a, path_b))
