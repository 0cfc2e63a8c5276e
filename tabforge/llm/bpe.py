"""Byte-level BPE encoding and decoding (operator 2).

A text is split by the rank file's pattern, and ranked merges are folded over the byte arrays of
distinct words: each step joins, in every word still unfinished, the leftmost pair of lowest rank.
The fold is vectorised over all words of one length, which lose one token per step and so stay a
matrix. Words that are whole entries are taken as they are. Decoding concatenates the binary
pieces of the ids.

The same fold as Spark higher-order functions over a literal rank map gives the same ids but
takes about 0.7 ms of CPU per distinct word; the README has the figures. Here a worker folds a
distinct word once and remembers up to ``REMEMBERED`` of them, so the work needs no shuffle and
memory stays bounded.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabforge.llm._text import U, runs, span_hashes

REMEMBERED = 1_000_000
NONE = np.int32(2**31 - 1)
#: Longer words are folded one by one with a heap.
MATRIX_BYTES = 64
SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
#: The endings that the pattern splits off after an apostrophe.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


def read_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines()) if a}


@functools.lru_cache(maxsize=1)
def char_classes() -> np.ndarray:
    """Class of every code point: white space, letter, number or other."""
    import regex
    out = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for cls, name in ((LETTER, "L"), (NUMBER, "N"), (SPACE, "White_Space")):
        for m in regex.finditer(rf"\p{{{name}}}+", every):
            shift = lambda i: i if i < 0xD800 else i + 0x800
            out[shift(m.start()):shift(m.end() - 1) + 1] = cls
    return out


def split_words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(byte offset of each word's first byte plus the end, words before each row) of the pattern
    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+ on each row:
    every byte belongs to one word."""
    lead = (buf & 0xC0) != 0x80
    at = np.flatnonzero(lead)                                # byte offset of each character
    n = len(at)
    if n == 0:
        return np.zeros(1, np.int64), np.zeros(len(offs), np.int64)
    if n == len(buf):
        cp = buf.astype(np.int64)
    else:
        cp = np.frombuffer(buf.tobytes().decode("utf-8").encode("utf-32-le"), "<u4").astype(np.int64)
    cls = char_classes()[cp]
    row = np.searchsorted(at, offs)                          # first character of each row
    new = np.ones(n, bool)
    new[1:] = cls[1:] != cls[:-1]
    edge = row[:-1][row[:-1] < n]
    new[edge] = True
    first_of_row = np.zeros(n + 1, bool)
    first_of_row[row] = True
    # a run of white space gives its last character to what follows: a space joins it, any
    # other character is a word of its own
    last_space = np.zeros(n, bool)
    last_space[:-1] = (cls[:-1] == SPACE) & (cls[1:] != SPACE) & ~first_of_row[1:n]
    new[last_space] = True
    joins = np.flatnonzero(last_space & (cp == 32))
    new[joins + 1] = False
    # an apostrophe that starts a word takes the ending after it, and the rest starts anew
    a = np.flatnonzero(new[:-1] & (cp[:-1] == 39) & (cls[1:] == LETTER) & ~first_of_row[1:n])
    if len(a):
        limit = row[np.searchsorted(row, a, side="right")]
        size = np.zeros(len(a), np.int64)
        for e in ENDINGS:
            fits = (size == 0) & (a + len(e) < limit)
            for k, c in enumerate(e):
                fits &= cp[np.minimum(a + 1 + k, n - 1)] == ord(c)
            size[fits] = len(e)
        a, size = a[size > 0], size[size > 0]
        new[a + 1] = False
        rest = a + 1 + size
        rest = rest[(rest < n)]
        new[rest] = True
    words = np.flatnonzero(new)
    return np.concatenate((at[words], [len(buf)])), np.searchsorted(words, row)


class BytePairs:
    """Encoder and decoder for one set of ranks (id = rank, every byte an entry)."""

    def __init__(self, ranks: dict[bytes, int]):
        self.size = max(ranks.values()) + 1
        pieces = [b""] * self.size
        for p, r in ranks.items():
            pieces[r] = p
        self.piece_off = np.concatenate(([0], np.cumsum([len(p) for p in pieces]))).astype(np.int64)
        self.piece_bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for p, r in ranks.items():
            for k in range(1, len(p)):
                left, right = ranks.get(p[:k]), ranks.get(p[k:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = r
        self.pairs = pairs
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_rank = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int32)
        whole = span_hashes(self.piece_bytes, self.piece_off[:-1], self.piece_off[1:], fold_case=False)
        order = np.argsort(whole)
        self.whole, self.whole_id = whole[order], order.astype(np.int32)
        self._clear()

    def _clear(self):
        self.place: dict[int, int] = {}
        self.off, self.ids = [np.zeros(1, np.int64)], [np.zeros(0, np.int32)]
        self.n_words = self.n_ids = 0

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * self.size + right
        k = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[k] == key, self.pair_rank[k], NONE)

    def fold(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranked merges over a (words x bytes) matrix: (ids left-aligned, number of ids)."""
        m, n = words.shape
        out, count = np.zeros((m, n), np.int32), np.zeros(m, np.int64)
        live, tok = np.arange(m), self.byte_id[words]
        ranks = self.rank(tok[:, :-1], tok[:, 1:])
        while len(live):
            width = tok.shape[1]
            if width == 1:
                done = np.ones(len(live), bool)
            else:
                j = ranks.argmin(axis=1)                     # the leftmost of the lowest
                low = ranks[np.arange(len(live)), j]
                done = low == NONE
            if done.any():
                out[live[done], :width] = tok[done]
                count[live[done]] = width
                keep = ~done
                live, tok = live[keep], tok[keep]
                if not len(live):
                    break
                ranks, j, low = ranks[keep], j[keep], low[keep]
            rows = np.arange(len(live))
            tok[rows, j] = low
            col = np.arange(width - 1)
            tok = np.take_along_axis(tok, col + (col > j[:, None]), axis=1)
            col = col[:-1]
            ranks = np.take_along_axis(ranks, col + (col >= j[:, None]), axis=1)
            b = np.flatnonzero(j > 0)
            ranks[b, j[b] - 1] = self.rank(tok[b, j[b] - 1], tok[b, j[b]])
            b = np.flatnonzero(j < width - 2)
            ranks[b, j[b]] = self.rank(tok[b, j[b]], tok[b, j[b] + 1])
        return out, count

    def fold_long(self, word: bytes) -> list[int]:
        """The same merges for one long word, with a heap of pairs."""
        tok = self.byte_id[np.frombuffer(word, np.uint8)].tolist()
        n = len(tok)
        nxt, prev = list(range(1, n + 1)), list(range(-1, n - 1))
        look, size = self.pairs.get, self.size
        heap = [(r, i, tok[i], tok[i + 1]) for i in range(n - 1) if (r := look(tok[i] * size + tok[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            k = nxt[i] if tok[i] == a else n
            if k >= n or tok[k] != b:
                continue
            tok[i], tok[k] = r, -1
            nxt[i] = nxt[k]
            if nxt[i] < n:
                prev[nxt[i]] = i
                if (s := look(r * size + tok[nxt[i]])) is not None:
                    heapq.heappush(heap, (s, i, r, tok[nxt[i]]))
            if prev[i] >= 0 and (s := look(tok[prev[i]] * size + r)) is not None:
                heapq.heappush(heap, (s, prev[i], tok[prev[i]], r))
        return [t for t in tok if t >= 0]

    def _learn(self, buf: np.ndarray, start: np.ndarray, size: np.ndarray, hashes: np.ndarray) -> None:
        n = len(start)
        count, lists = np.ones(n, np.int64), []
        k = np.minimum(np.searchsorted(self.whole, hashes), len(self.whole) - 1)
        known = self.whole[k] == hashes
        lists.append((np.flatnonzero(known), self.whole_id[k[known]][:, None], np.ones(known.sum(), np.int64)))
        open_ = np.flatnonzero(~known)
        for width in np.unique(size[open_]).tolist():
            some = open_[size[open_] == width]
            if width <= MATRIX_BYTES:
                for a in range(0, len(some), 65_536):
                    part = some[a:a + 65_536]
                    lists.append((part, *self.fold(buf[start[part][:, None] + np.arange(width)])))
            else:
                for i in some.tolist():
                    one = np.array([self.fold_long(buf[start[i]:start[i] + width].tobytes())], np.int32)
                    lists.append((np.array([i]), one, np.array([one.shape[1]])))
        for at, _, c in lists:
            count[at] = c
        off = np.concatenate(([0], np.cumsum(count)))
        flat = np.zeros(off[-1], np.int32)
        for at, ids, c in lists:
            cols = np.arange(ids.shape[1])
            ok = cols < c[:, None]
            flat[(off[at][:, None] + cols)[ok]] = ids[ok]
        self.place.update(zip(hashes.tolist(), range(self.n_words, self.n_words + n)))
        self.off.append(self.n_ids + off[1:])
        self.ids.append(flat)
        self.n_words, self.n_ids = self.n_words + n, self.n_ids + len(flat)

    def encode(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, offsets per row) of UTF-8 texts."""
        cut, word_off = split_words(buf, offs)
        start, end = cut[:-1], cut[1:]
        uniq, first, inv = np.unique(span_hashes(buf, start, end, fold_case=False), return_index=True, return_inverse=True)
        if self.n_words + len(uniq) > REMEMBERED:
            self._clear()
        keys = uniq.tolist()
        new = np.array([k for k, h in enumerate(keys) if h not in self.place], np.int64)
        if len(new):
            self._learn(buf, start[first[new]], (end - start)[first[new]], uniq[new])
        if len(self.off) > 1:
            self.off, self.ids = [np.concatenate(self.off)], [np.concatenate(self.ids)]
        off, ids = self.off[0], self.ids[0]
        at = np.array([self.place[h] for h in keys], np.int64)[inv] if keys else np.zeros(0, np.int64)
        size = off[at + 1] - off[at]
        before = np.concatenate(([0], np.cumsum(size)))
        return ids[np.repeat(off[at] - before[:-1], size) + np.arange(before[-1])], before[word_off]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The pieces of ``ids``, concatenated, as bytes."""
        size = self.piece_off[ids + 1] - self.piece_off[ids]
        before = np.cumsum(size) - size
        return self.piece_bytes[np.repeat(self.piece_off[ids] - before, size) + np.arange(size.sum())]


_HELD: dict[str, BytePairs] = {}


def shared(content: bytes) -> BytePairs:
    """The worker's encoder for a rank file's content."""
    key = hashlib.sha1(content).hexdigest()
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = BytePairs(read_ranks(content))
    return _HELD[key]


def _ranks(docs: DataFrame, path: str):
    with open(path, "rb") as f:                              # a vocabulary file on the driver, under 1 MB
        return docs.sparkSession.sparkContext.broadcast(f.read())


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids array<int>) of every row of ``docs`` (doc_id, text) by the rank file ``path``.

    Defined cases, here and in ``roundtrip``: a null or empty text has no ids; rows count as they
    stand; an empty table gives no rows; other columns are ignored."""
    sent = _ranks(docs, path)

    def run(batches):
        enc = shared(sent.value)
        for batch in batches:
            for lo, hi, buf, offs in runs(batch.column("text")):
                ids, off = enc.encode(buf, offs)
                lists = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), lists], names=["doc_id", "ids"])
    return _texts(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(tokens: DataFrame, path: str) -> DataFrame:
    """(doc_id, decoded binary) of rows (doc_id, ids): the pieces of the ids. Null ids are none."""
    sent = _ranks(tokens, path)

    def run(batches):
        enc = shared(sent.value)
        for batch in batches:
            out = [enc.decode(np.array(i.as_py() or [], np.int64)).tobytes() for i in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary())], names=["doc_id", "decoded"])
    return tokens.select("doc_id", F.col("ids").cast("array<int>").alias("ids")).mapInArrow(run, "doc_id long, decoded binary")


def roundtrip(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): each text encoded, its ids decoded, both
    digested where they are made, so that the ids need not travel."""
    sent = _ranks(docs, path)

    def run(batches):
        enc = shared(sent.value)
        for batch in batches:
            for lo, hi, buf, offs in runs(batch.column("text")):
                ids, off = enc.encode(buf, offs)
                raw = ids.astype("<u4")
                own = [raw[a:b] for a, b in zip(off[:-1], off[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array(np.diff(off), pa.int64()),
                     pa.array([hashlib.sha256(x).hexdigest() for x in own]),
                     pa.array([hashlib.sha256(enc.decode(x.astype(np.int64))).hexdigest() for x in own])],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return _texts(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
