"""SentencePiece encoding and decoding by a streaming Viterbi search.

The best segmentation of a text is the one with the largest sum of piece
scores.  A text is read once, ``CHUNK`` characters at a time, and only what is
not final is kept: as soon as all paths that can still go on pass through one
boundary, everything before it is committed and the text behind it forgotten.
A later piece can start among the last ``max_piece - 1`` positions at most, so
those are the ends of the surviving paths.  Two things show that they converge:

* A position inside which no piece of the vocabulary matches: every path passes
  there, whatever the scores.  In ordinary text that is each space mark and
  many places besides; the windows between them are a few characters long.
* In a window that stays open (a long run without such a position), the
  back-pointers of the surviving paths are followed until they meet.

At a boundary the search starts anew with the score 0; scores are integers, so
the ids do not depend on where chunks end.  Memory follows the chunk and the
distance between boundaries, not the text.  The short windows of a round, which
may come from many texts, advance in lockstep as arrays; open ones advance by
themselves.

The piece file is read by path and never copied.  Normalisation is the identity:
spaces become the mark, with one put in front of the text.  A character
without a piece falls back to its UTF-8 bytes.  Decoding joins the pieces and
reproduces the text exactly (a literal mark comes back as a space).

Defined cases: null text is empty and has no ids; ties go to the longer last
piece; a repeated row is encoded once per repetition; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worklens.llm.common import utf8_column

MARK = "▁"
#: Characters read in a round, and the longest window that advances in lockstep.
CHUNK, LONG = 1 << 17, 48
#: Piece scores are taken as whole multiples of 1 / SCALE, so that sums are exact in any
#: order; those of LONG pieces of -1e9 each (a score that vocabulary files use) fit 64 bits.
SCALE = 1 << 20
#: A code point that no text holds, between the texts of a round.
FENCE = 0x110000
_NEVER = -(1 << 60)


class Trie:
    """Pieces read from their last character to their first, as a hash table of arrays."""

    def __init__(self, pieces: dict[str, tuple[int, int]]):
        edges: dict[int, int] = {}
        ends = [-1]
        for piece, (piece_id, _) in pieces.items():
            node = 0
            for ch in reversed(piece):
                key = node << 21 | ord(ch)
                if (node := edges.setdefault(key, len(ends))) == len(ends):
                    ends.append(-1)
            ends[node] = piece_id
        self.piece = np.array(ends, np.int32)
        self.bits = max(10, len(edges).bit_length() + 2)
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.nodes = np.full(1 << self.bits, -1, np.int64)
        keys = np.fromiter(edges.keys(), np.int64, len(edges))
        nodes = np.fromiter(edges.values(), np.int64, len(edges))
        slot = self._slot(keys)
        while len(keys):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = keys[free]  # of several the last stays
            self.nodes[slot[free]] = nodes[free]
            left = self.keys[slot] != keys
            keys, nodes, slot = keys[left], nodes[left], (slot[left] + 1) & (len(self.keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def child(self, node: np.ndarray, ch: np.ndarray) -> np.ndarray:
        """The nodes reached by one more character, -1 where there is none."""
        keys = node << 21 | ch
        slot = self._slot(keys)
        found = self.keys[slot]
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (len(self.keys) - 1)
            found = self.keys[slot[open_]]
            open_ = open_[(found != keys[open_]) & (found >= 0)]
        return np.where(self.keys[slot] == keys, self.nodes[slot], -1)


class Segmenter:
    """Pieces, scores and byte ids of a SentencePiece file."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.pieces: dict[str, tuple[int, int]] = {}
        self.byte_ids, self.raw = [0] * 256, [b""] * n
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.raw[i] = bytes([int(piece[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.pieces[piece] = (i, round(sp.get_score(i) * SCALE))
                self.raw[i] = piece.replace(MARK, " ").encode()
        self.max_piece = max(map(len, self.pieces))
        #: Score of one character spelled in bytes: below any path of pieces over it.
        self.unknown = min(s for _, s in self.pieces.values()) - 10 * SCALE
        self.trie = Trie(self.pieces)
        self.score, self.length = np.zeros(n, np.int64), np.ones(n, np.int64)
        for piece, (i, s) in self.pieces.items():
            self.score[i], self.length[i] = s, len(piece)
        self.raw_size = np.array([len(r) for r in self.raw], np.int64)

    def stream(self, chunks: Iterable[str]) -> Iterator[int]:
        """Ids of the concatenated chunks, committed as soon as they are final."""
        for ids in self.commits(chunks):
            yield from ids.tolist()

    def commits(self, chunks: Iterable[str]) -> Iterator[np.ndarray]:
        """The same ids as arrays, one per round that commits any."""
        rest = ""
        for chunk in chunks:
            [(ids, rest)] = self.advance([(rest + chunk, False)])
            if len(ids):
                yield ids
        if rest:
            yield self.advance([(rest, True)])[0][0]

    def encode_all(self, texts: Iterable[str]) -> Iterator[tuple[np.ndarray, bool]]:
        """(ids, end of its text) in the order of the texts, at least one for each."""
        items: list[tuple[str, bool]] = []
        room = CHUNK
        for text in texts:
            at, rest = 0, MARK if text else ""
            while True:
                # what stays open is read again: with as much new text as that, the work stays linear
                end = min(len(text), at + max(room, len(rest)))
                items.append((rest + text[at:end].replace(" ", MARK), end == len(text)))
                room -= end - at
                rest, at = "", end
                if room <= 0:
                    done = self.advance(items)
                    for (ids, rest), (_, last) in zip(done, items, strict=True):
                        yield ids, last
                    items, room = [], CHUNK
                if at == len(text):
                    break
        for (ids, _), (_, last) in zip(self.advance(items), items, strict=True):
            yield ids, last

    def advance(self, items: list[tuple[str, bool]]) -> list[tuple[np.ndarray, str]]:
        """(ids that are final, text that is not) of each (text not final so far, is it the end)."""
        if not items:
            return []
        fence = chr(FENCE - 1)
        joined = fence + fence.join(t for t, _ in items)
        x = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        size = np.array([len(t) for t, _ in items])
        begin = np.cumsum(size + 1) - size
        stop = begin + size
        x[begin - 1] = FENCE
        end, length, piece = self.matches(x)

        # positions that no piece crosses
        n, wide = len(x), length > 1
        crossed = np.cumsum(np.bincount(end[wide] - length[wide] + 1, minlength=n + 1)
                            - np.bincount(end[wide], minlength=n + 1))
        cuts = np.flatnonzero(crossed == 0)
        # a later piece may cross what lies behind the last position it cannot reach
        last = np.array([e for _, e in items])
        limit = np.where(last, stop, np.maximum(begin, stop - self.max_piece + 1))
        final = cuts[np.searchsorted(cuts, limit, side="right") - 1]

        emitted = np.full(n + 1, -2, np.int64)  # by a piece's end: its id, -1 for a lone character
        start, to = cuts[:-1], cuts[1:]
        item = np.searchsorted(begin, start, side="right") - 1
        inside = (item >= 0) & (start >= begin[item]) & (to <= final[item])
        lane = inside & (to - start <= LONG)
        self._lockstep(start[lane], to[lane], n, end, length, piece, emitted)
        open_ = [(a, b, True) for a, b in zip(start[inside & ~lane], to[inside & ~lane])]
        open_ += [(final[i], stop[i], False) for i in np.flatnonzero(stop - final > LONG + self.max_piece)]
        if open_:
            order = np.lexsort((length, end))
            by_end = end[order], length[order], piece[order]
            for a, b, closed in open_:
                upto = self._walk(a, b, closed, *by_end, emitted)
                if not closed:
                    final[np.searchsorted(begin, a, side="right") - 1] = upto

        out = []
        ends = np.flatnonzero(emitted > -2)
        ids, count = self._spell(emitted[ends], x[ends - 1])
        total = np.concatenate([[0], np.cumsum(count)])
        lo, hi = np.searchsorted(ends, begin, side="right"), np.searchsorted(ends, final, side="right")
        for i, (text, _) in enumerate(items):
            out.append((ids[total[lo[i]]:total[hi[i]]], text[final[i] - begin[i]:]))
        return out

    def matches(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(end, length, id) of every piece in a sequence of code points."""
        at, node = np.arange(1, len(x) + 1), np.zeros(len(x), np.int64)
        found = []
        for length in range(1, self.max_piece + 1):
            node = self.trie.child(node, x[at - length])
            live = np.flatnonzero(node >= 0)
            at, node = at[live], node[live]
            piece = self.trie.piece[node]
            hit = piece >= 0
            found.append((at[hit], np.full(hit.sum(), length), piece[hit].astype(np.int64)))
            more = at > length
            at, node = at[more], node[more]
        return tuple(np.concatenate(c) for c in zip(*found, strict=True))

    def _lockstep(self, start, to, n, end, length, piece, emitted) -> None:
        """Search the windows [start, to) at once, position by position; fill ``emitted``."""
        if not len(start):
            return
        size = to - start
        order = np.argsort(-size, kind="stable")
        start, size = start[order], size[order]
        longest, lanes = int(size[0]), len(start)
        lane_of = np.full(n + 1, -1, np.int64)
        lane_of[np.repeat(start + 1 - (np.cumsum(size) - size), size) + np.arange(size.sum())] = \
            np.repeat(np.arange(lanes), size)
        lane = lane_of[end]
        mine = lane >= 0
        lane, length, piece = lane[mine], length[mine], piece[mine]
        group = (end[mine] - start[lane]) * (self.max_piece + 1) + length
        short = (longest + 1) * (self.max_piece + 1) < 1 << 15  # 16 bits are sorted by radix
        by = np.argsort(group.astype(np.int16) if short else group, kind="stable")
        lane, piece, group = lane[by], piece[by], group[by]
        edge = np.searchsorted(group, np.arange((longest + 1) * (self.max_piece + 1) + 1))

        best = np.full((longest + 1, lanes), _NEVER, np.int64)
        back = np.full((longest + 1, lanes), -1, np.int32)
        best[0] = 0
        for t in range(1, longest + 1):
            now, via = best[t], back[t]
            for step in range(1, min(t, self.max_piece) + 1):
                a, b = edge[t * (self.max_piece + 1) + step:][:2]
                if a < b:
                    l, p = lane[a:b], piece[a:b]
                    got = best[t - step][l] + self.score[p]
                    better = got >= now[l]  # ties go to the longer piece
                    l = l[better]
                    now[l], via[l] = got[better], p[better]
            single = best[t - 1] + self.unknown
            alone = single > now
            now[alone], via[alone] = single[alone], -1

        at, l = size.copy(), np.arange(lanes)
        while len(l):
            p = back[at, l]
            emitted[start[l] + at] = p
            at = at - np.where(p >= 0, self.length[p], 1)
            left = at > 0
            at, l = at[left], l[left]

    def _walk(self, start, to, closed, end, length, piece, emitted) -> int:
        """Search one long window; fill ``emitted`` up to the position where the paths meet."""
        lo, hi = np.searchsorted(end, [start + 1, to + 1])
        at = np.searchsorted(end[lo:hi], np.arange(start + 1, to + 2)).tolist()
        steps, ids = length[lo:hi].tolist(), piece[lo:hi].tolist()
        gains = self.score[piece[lo:hi]].tolist()
        score, back, via = [0], [0], [-1]
        for t in range(1, to - start + 1):
            best, src, got = -math.inf, 0, -1
            for m in range(at[t - 1], at[t]):
                a = t - steps[m]
                if a < 0:
                    break
                if score[a] + gains[m] >= best:
                    best, src, got = score[a] + gains[m], a, ids[m]
            if score[t - 1] + self.unknown > best:
                best, src, got = score[t - 1] + self.unknown, t - 1, -1
            score.append(best)
            back.append(src)
            via.append(got)
        size = to - start
        live = {size} if closed else set(range(max(0, size - self.max_piece + 1), size + 1))
        while len(live) > 1:
            most = max(live)
            live.remove(most)
            live.add(back[most])
        meet = t = live.pop()
        while t > 0:
            emitted[start + t] = via[t]
            t = back[t]
        return int(start) + meet

    def _spell(self, piece: np.ndarray, ch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids, and how many for each entry: a character without a piece has one per byte."""
        alone = np.flatnonzero(piece < 0)
        if not len(alone):
            return piece.astype("<u4"), np.ones(len(piece), np.int64)
        spelled = [[self.byte_ids[b] for b in chr(c).replace(MARK, " ").encode("utf-8", "replace")]
                   for c in ch[alone].tolist()]
        count = np.ones(len(piece), np.int64)
        count[alone] = [len(s) for s in spelled]
        ids = np.repeat(piece, count)
        ids[np.repeat(piece < 0, count)] = [i for s in spelled for i in s]
        return ids.astype("<u4"), count

    def encode(self, text: str) -> np.ndarray:
        parts = [ids for ids, _ in self.encode_all([text])]
        return np.concatenate(parts).astype("<u4")

    def decode(self, ids: np.ndarray) -> str:
        raw = b"".join(map(self.raw.__getitem__, ids.tolist()))
        return raw[1:].decode("utf-8", "replace")  # without the mark put in front


@lru_cache(maxsize=2)
def segmenter(path: str) -> Segmenter:
    return Segmenter(path)


def texts(batch: pa.RecordBatch) -> Iterator[str]:
    return (raw.decode("utf-8", "replace") for raw in utf8_column(batch, "text"))


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg = segmenter(model_path)
        for b in batches:
            ids, parts = [], []
            for got, last in seg.encode_all(texts(b)):
                parts.append(got)
                if last:
                    ids.append(np.concatenate(parts) if len(parts) > 1 else got)
                    parts = []
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id, text of a table of doc_id, ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg = segmenter(model_path)
        for b in batches:
            back = [seg.decode(np.array(x.as_py() or [], "<u4")) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(back, pa.string())], names=["doc_id", "text"])
    return encoded.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")).mapInArrow(
        run, "doc_id long, text string")


class Digest:
    """Both directions of one text, kept up commit by commit: no ids and no decoded text are held."""

    def __init__(self, seg: Segmenter):
        self.seg, self.n_ids, self.ids_crc = seg, 0, 0
        self.n_bytes, self.n_chars, self.text_crc, self.exact = 0, 0, 0, True

    def add(self, ids: np.ndarray, source: bytes) -> None:
        # a commit ends between characters, so its bytes are whole characters
        raw = b"".join(map(self.seg.raw.__getitem__, ids.tolist()))
        raw = raw[1:] if self.n_ids == 0 else raw  # without the mark put in front
        self.n_ids += len(ids)
        self.ids_crc = zlib.crc32(ids.tobytes(), self.ids_crc)
        self.exact = self.exact and source[self.n_bytes:self.n_bytes + len(raw)] == raw
        self.n_bytes += len(raw)
        self.n_chars += len(raw.decode("utf-8", "replace"))
        self.text_crc = zlib.crc32(raw, self.text_crc)

    def row(self, source: bytes) -> tuple:
        return (self.n_ids, self.ids_crc, self.n_chars, self.text_crc,
                self.exact and self.n_bytes == len(source))


DIGEST = "doc_id long, n_ids long, ids_crc32 long, n_chars_decoded long, text_crc32 long, exact boolean"


def digest(docs: DataFrame, model_path: str) -> DataFrame:
    """Both directions for each text: its ids' count and CRC-32, and the decoded text's."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg = segmenter(model_path)
        for b in batches:
            rows, sources = [], utf8_column(b, "text")
            again = None
            for ids, last in seg.encode_all(texts(b)):
                if again is None:  # a text begins
                    again, source = Digest(seg), next(sources).decode("utf-8", "replace").encode()
                again.add(ids, source)
                if last:
                    rows.append(again.row(source))
                    again = None
            cols = list(zip(*rows, strict=True)) or [()] * 5
            kinds = [pa.int64()] * 4 + [pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]],
                names=[f.split()[0] for f in DIGEST.split(", ")])
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, DIGEST)
