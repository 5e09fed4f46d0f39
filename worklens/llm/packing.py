"""Cost-balanced packing of tokenised documents into fixed-length sequences.

Each document becomes its token ids plus one end id.  A task packs the
documents of its own input partition in groups of about ``group_tokens``
tokens, so the operator needs no shuffle and holds one group in memory; groups
are never gathered across tasks.

Within a group, pieces of a full sequence are cut from long documents first.
What is left is placed in descending order of its estimated cost
``linear * n + quadratic * n**2`` into the sequence of the lowest cost so far
that has room for it; when none has, the document is cut over the largest
gaps.  The sequences of a group are sized to its tokens: full ones, and powers
of two for the rest below one full sequence, so that no padding is needed.

Defined cases: null text is empty (the end id alone); an empty table gives no
pieces; a repeated row is packed once per repetition; ties in cost go by
doc_id, then by input position; a null doc_id is packed like any other and
sorts first; other columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worklens.llm.common import frugal, record_batches, utf8_column

SEQUENCE = 4096
GROUP_TOKENS = 1 << 22
#: Parts remembered per Python worker.
MEMO_PARTS = 250_000
#: Bytes of texts whose parts are looked up at once.
CHUNK_BYTES = 1 << 19

SCHEMA = pa.schema([(c, pa.int64()) for c in (
    "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])


#: Pre-tokenizer and normalizer of the tokenizers files whose words ``find_words`` finds.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
          {"type": "Lowercase"}]
#: Texts of which NFC changes nothing and ``str.lower`` every character by itself: Latin
#: letters, common punctuation, spaces and line feeds; the letters of one in lower case.
LATIN = re.compile("[\n -~\u00a1-\u00b1\u00b4-\u00b8\u00ba\u00bb\u00bf-\u012f\u0131-\u017f\u2010-\u2027]*")
LETTERS = re.compile("[a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u017f]")
BLANK, LETTER, DIGIT, OTHER = range(4)
#: What each character of a lower-cased ``LATIN`` text is.
KIND = np.array([BLANK if c in "\n " else DIGIT if c in "0123456789" else
                 LETTER if LETTERS.match(c) else OTHER for c in map(chr, range(0x2028))], np.uint8)
#: Byte -> its character in the byte-level alphabet; a line feed, which no word holds, stays.
BYTE_CHAR = np.arange(256, dtype="<u2")
BYTE_CHAR[[*range(33), *range(127, 161), 173]] = range(256, 324)
BYTE_CHAR[10] = 10


def find_words(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pre-tokens of a lower-cased ``LATIN`` text by the rules of ``SPLIT``.

    Returns their UTF-16 units one after the other, where each begins among
    those (and the end), and where each begins in the text.
    """
    units = np.frombuffer(text.encode("utf-16-le"), "<u2")
    kind = KIND[units]
    begins = kind != BLANK
    begins[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    # a run of other characters that begins with an apostrophe may be a contraction
    for i in np.flatnonzero(begins & (units == ord("'"))).tolist():
        tail = text[i + 1:i + 3]
        n = 2 if tail in ("re", "ve", "ll") else 1 if tail[:1] and tail[0] in "stmd" else 0
        if n:
            begins[i + 1] = False
            if i + n + 1 < len(text) and kind[i + n + 1] == LETTER:
                begins[i + n + 1] = True
    inside = kind != BLANK
    units = units[inside]
    return units, np.append(np.flatnonzero(begins[inside]), len(units)), np.flatnonzero(begins)


def finds_words(spec: dict) -> bool:
    """Whether ``find_words`` cuts lower-cased ``LATIN`` texts as a tokenizers file does."""
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    return (spec.get("normalizer") == {"type": "Sequence", "normalizers": NORMAL}
            and steps[0] == {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed",
                             "invert": True}
            and all(x["type"] == "ByteLevel" and not x["add_prefix_space"] and not x["use_regex"]
                    for x in steps[1:])
            and spec["model"]["type"] == "BPE" and not spec.get("post_processor"))


class WordTokenizer:
    """Ids of texts by a ``tokenizers`` file whose pre-tokenizer drops white space.

    No pre-token spans a space or line feed, so the ids of a text are those of
    its parts between them.  Where the file's rules are those of ``finds_words``,
    the parts of a ``LATIN`` text without added tokens are its pre-tokens in lower
    case, of which there are fewer; its model alone encodes those.  The distinct
    parts of the texts at hand are looked up once.  Parts are remembered, up to
    ``MEMO_PARTS``; beyond that only those of the texts at hand.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's core is all it has
        from tokenizers import Tokenizer, pre_tokenizers
        self.tok = Tokenizer.from_file(path)
        self.lines = Tokenizer(self.tok.model)  # of words in the byte-level alphabet
        self.lines.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.memo: dict[str, bytes] = {}
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.finds_words = finds_words(spec)
        # an added token is found in the text as it is, before anything else
        added = [t["content"] for t in spec.get("added_tokens") or []]
        self.added = re.compile("|".join(map(re.escape, added)) or "(?!)", re.IGNORECASE)
        # a last token of a word is never another one
        vocab, suffix = self.tok.get_vocab(), spec["model"].get("end_of_word_suffix")
        self.last = np.zeros(max(vocab.values()) + 1, np.bool_)
        self.last[[i for t, i in vocab.items() if suffix and t.endswith(suffix)]] = True

    def has_words(self, text: str) -> bool:
        return bool(self.finds_words and LATIN.fullmatch(text) and not self.added.search(text))

    def encode(self, parts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes()
                for e in self.tok.encode_batch_fast(parts, add_special_tokens=False)]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """As ``encode``, of pre-tokens: many at once, cut behind the last token of each."""
        out = []
        for i in range(0, len(words), 1000):
            some = words[i:i + 1000]
            lines = BYTE_CHAR[np.frombuffer("\n".join(some).encode(), np.uint8)]
            ids, = self.lines.encode_batch_fast([lines.tobytes().decode("utf-16-le")],
                                                add_special_tokens=False)
            ids = np.array(ids.ids, "<u4")
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(some) and ends[-1] == len(ids):
                whole, ends = ids.tobytes(), (4 * ends).tolist()
                out += [whole[x:y] for x, y in zip([0, *ends], ends)]
            else:
                out += self.encode(some)
        return out

    def recall(self, parts: list[str], encode: Callable[[list[str]], list[bytes]]) -> list[bytes]:
        """The ids of distinct parts, from the memo or by ``encode``."""
        got = list(map(self.memo.get, parts))
        new = [p for p, ids in zip(parts, got, strict=True) if ids is None]
        found = encode(new)
        rest = iter(found)
        got = [next(rest) if ids is None else ids for ids in got]
        if len(self.memo) + len(new) > MEMO_PARTS:
            self.memo.clear()
            new, found = parts[:MEMO_PARTS], got[:MEMO_PARTS]
        self.memo.update(zip(new, found, strict=True))
        return got

    def words(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of texts that ``has_words`` holds for."""
        units, at, begins = find_words("\n".join(texts).lower())
        ends = np.searchsorted(begins, np.cumsum([len(t) + 1 for t in texts]))
        words = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(begins), [None, pa.py_buffer(2 * at), pa.py_buffer(units)])
        words = words.dictionary_encode()
        _, at, units = words.dictionary.buffers()
        at = (np.frombuffer(at, np.int64)[:len(words.dictionary) + 1] // 2).tolist()
        joined = units.to_pybytes()[:2 * at[-1]].decode("utf-16-le") if units else ""
        distinct = [joined[x:y] for x, y in zip(at, at[1:])]
        return gather(self.recall(distinct, self.encode_words), words.indices.to_numpy(), ends)

    def parts(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of any texts."""
        split = [t.replace("\n", " ").split(" ") for t in texts]
        ends = np.cumsum(list(map(len, split)))
        parts = pa.array(chain.from_iterable(split), pa.large_string()).dictionary_encode()
        return gather(self.recall(parts.dictionary.to_pylist(), self.encode),
                      parts.indices.to_numpy(), ends)

    def ids(self, texts: list[bytes]) -> list[np.ndarray]:
        whole = [t.decode("utf-8", "replace") for t in texts]
        easy = list(map(self.has_words, whole))
        got = {kind: run([t for t, e in zip(whole, easy, strict=True) if e == kind])
               for kind, run in ((True, self.words), (False, self.parts)) if kind in easy}
        return [next(got[e]) for e in easy]


def gather(values: list[bytes], codes: np.ndarray, ends: np.ndarray) -> Iterator[np.ndarray]:
    """The ids of texts; ``codes`` are places in ``values``, up to each of ``ends`` one text's."""
    size = np.fromiter(map(len, values), np.int64, len(values)) // 4
    flat, first, n = np.frombuffer(b"".join(values), "<u4"), np.cumsum(size) - size, size[codes]
    stop = np.cumsum(n)
    ids = flat[np.repeat(first[codes] - stop + n, n) + np.arange(n.sum())]
    cuts = np.append(0, stop)[ends].tolist()
    return (ids[x:y] for x, y in zip([0, *cuts], cuts))


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def capacities(tokens: int, sequence: int) -> list[int]:
    """Full sequences, then the powers of two that sum to the rest."""
    rest = tokens % sequence
    return [sequence] * (tokens // sequence) + [
        1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def place(lengths: np.ndarray, order: np.ndarray, room: np.ndarray,
          linear: float, quadratic: float) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, its start, length, sequence, offset there) for each piece.

    ``room`` must sum to the lengths; every piece then finds its place.
    """
    size, room, cost = room.copy(), room.copy(), np.zeros(len(room))
    for d in order:
        start, left = 0, int(lengths[d])
        while left:
            fits = np.flatnonzero(room >= left)
            s = fits[cost[fits].argmin()] if len(fits) else int(room.argmax())
            n = min(left, int(room[s]))
            yield int(d), start, n, int(s), int(size[s] - room[s])
            room[s] -= n
            cost[s] += linear * n + quadratic * n * n
            start, left = start + n, left - n


def pack_group(docs: list[tuple[int | None, np.ndarray]], first_sequence: int, sequence: int,
               linear: float, quadratic: float) -> tuple[pa.RecordBatch, int]:
    """The pieces of a group and the next free sequence id."""
    rows, nxt = [], first_sequence
    total = np.array([len(ids) for _, ids in docs], np.int64)

    def piece(d: int, start: int, n: int, seq: int, offset: int) -> None:
        doc_id, ids = docs[d]
        rows.append((doc_id, start, n, zlib.crc32(ids[start:start + n].tobytes()), len(ids),
                     seq, offset))

    for d, n in enumerate(total):
        for start in range(0, n - n % sequence, sequence):
            piece(d, start, sequence, nxt, 0)
            nxt += 1
    rest = total % sequence
    room = np.array(capacities(int(rest.sum()), sequence), np.int64)
    # doc_id and position decide ties, so a retried task packs alike
    ids_key = np.array([-(2**63) if d is None else d for d, _ in docs], np.int64)
    order = np.lexsort((np.arange(len(docs)), ids_key, -(linear * rest + quadratic * rest * rest)))
    for d, start, n, s, offset in place(rest, order, room, linear, quadratic):
        piece(d, int(total[d] - rest[d]) + start, n, nxt + s, offset)
    return record_batches(SCHEMA, zip(*rows, strict=True)), nxt + len(room)


def chunks(batch: pa.RecordBatch) -> Iterator[tuple[list[int | None], list[bytes]]]:
    """The ids and texts of a batch, about ``CHUNK_BYTES`` of texts at a time."""
    doc_ids, texts, size = [], [], 0
    for doc_id, text in zip(batch.column(0).to_pylist(), utf8_column(batch, "text"), strict=True):
        doc_ids.append(doc_id)
        texts.append(text)
        size += len(text)
        if size >= CHUNK_BYTES:
            yield doc_ids, texts
            doc_ids, texts, size = [], [], 0
    if texts:
        yield doc_ids, texts


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 2, sequence: int = SEQUENCE,
         group_tokens: int = GROUP_TOKENS, linear: float = 1.0,
         quadratic: float = 1 / SEQUENCE) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, end = tokenizer(tokenizer_path), np.array([end_id], "<u4")
        nxt = TaskContext.get().partitionId() << 32  # sequence ids of this task
        group, size = [], 0
        for batch in batches:
            for doc_ids, texts in chunks(batch):
                for doc_id, ids in zip(doc_ids, tok.ids(texts), strict=True):
                    group.append((doc_id, np.concatenate([ids, end])))
                    size += len(ids) + 1
                    if size >= group_tokens:
                        out, nxt = pack_group(group, nxt, sequence, linear, quadratic)
                        yield out
                        group, size = [], 0
        if group:
            yield pack_group(group, nxt, sequence, linear, quadratic)[0]
        tok.memo.clear()  # the worker may go on with another pass

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return source.mapInArrow(frugal(run), ", ".join(f"{f.name} long" for f in SCHEMA))
