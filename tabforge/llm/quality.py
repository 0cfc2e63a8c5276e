"""Text quality from random-indexing word vectors and a two-layer network (operator 8).

1. Random indexing over all documents: every token has a fixed sparse random index vector;
   a token's context vector is the sum of the index vectors of its neighbours in the corpus.
   Tokens share ``CELLS`` hashed cells, so the table has one size at any corpus size. Tokens
   are runs of letters, of digits, or of other signs, case kept.
2. A document is the mean of its tokens' context vectors, the mean agreement of neighbouring
   tokens' index and context vectors (repetition shows there), and its length.
3. A two-layer network on a bounded, documented sample of labelled documents (``train_rows``,
   in hash order), with a temperature fitted on a part of it that training does not see.
4. Every whole text is scored in one pass.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabforge.llm._store import hash_sample
from tabforge.llm._sums import table_sum
from tabforge.llm._text import U, byte_set, mix, runs, span_hashes, word_spans

CELLS = 1 << 13
DIM = 48
_LETTER = byte_set((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
_DIGIT = byte_set((0x30, 0x39))
_SIGN = ~(_LETTER | _DIGIT | byte_set((0x20, 0x20), (0x09, 0x0D)))
WIDTH = 3 * DIM + 4


def tokens(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cell of each token in text order, token offsets per row)."""
    starts, cells = [], []
    for salt, cls in enumerate((_LETTER, _DIGIT, _SIGN)):
        a, b, _ = word_spans(buf, offs, cls)
        if cls is _DIGIT:
            h = np.minimum(b - a, 20).astype(np.uint64)      # numbers count by their length
        else:
            h = span_hashes(buf, a, b, fold_case=False)
        starts.append(a)
        cells.append((mix(h + U(salt + 1)) % U(CELLS)).astype(np.int64))
    at = np.concatenate(starts)
    order = np.argsort(at, kind="stable")
    return np.concatenate(cells)[order], np.searchsorted(at[order], offs)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Two positions and signs of each cell's index vector."""
    h = mix(np.arange(1, 2 * CELLS + 1, dtype=np.uint64)).reshape(2, CELLS)
    return (h % U(DIM)).astype(np.int64), np.where((h >> U(40)) & U(1), 1.0, -1.0)


def dense_index() -> np.ndarray:
    pos, sign = index_vectors()
    out = np.zeros((CELLS, DIM), np.float32)
    for p, s in zip(pos, sign):
        np.add.at(out, (np.arange(CELLS), p), s)
    return out


def _neighbours(cells: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Whether token i and i + 1 are in one row."""
    ok = np.ones(max(0, len(cells) - 1), bool)
    cut = off[(off > 0) & (off < len(cells))]
    ok[cut - 1] = False
    return ok


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit context vectors (CELLS x DIM) summed over all rows of ``docs`` (text)."""
    pos, sign = index_vectors()

    def add(batch, table):
        for _, _, buf, offs in runs(batch.column("text")):
            cells, off = tokens(buf, offs)
            ok = _neighbours(cells, off)
            for a, b in ((cells[:-1][ok], cells[1:][ok]), (cells[1:][ok], cells[:-1][ok])):
                for p, s in zip(pos, sign):
                    table[:CELLS * DIM] += np.bincount(a * DIM + p[b], weights=s[b], minlength=CELLS * DIM).astype(np.int64)

    sums = table_sum(docs.select(F.col("text").cast("string").alias("text")).where("text is not null"), CELLS * DIM, "int64", add)
    v = sums.reshape(CELLS, DIM).astype(np.float64)
    v -= v.sum(axis=0) / max(1.0, np.abs(v).sum()) * np.abs(v).sum(axis=1, keepdims=True)
    return (v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(buf: np.ndarray, offs: np.ndarray, vec: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Document vectors (rows x WIDTH); a row without tokens is zero."""
    rows = len(offs) - 1
    out = np.zeros((rows, WIDTH), np.float32)
    cells, off = tokens(buf, offs)
    n = np.diff(off)
    some = np.flatnonzero(n > 0)
    if not len(some):
        return out
    first = off[:-1][some]
    size = n[some][:, None].astype(np.float32)
    v = vec[cells]
    out[some, :DIM] = np.add.reduceat(v, first, axis=0) / size
    ok = _neighbours(cells, off)[:, None]
    for k, m in ((1, vec), (2, index)):
        near = m[cells]
        near = np.concatenate((near[:-1] * near[1:] * ok, np.zeros((1, DIM), np.float32)))
        out[some, k * DIM:(k + 1) * DIM] = np.add.reduceat(near, first, axis=0) / size
    again = np.concatenate(((cells[:-1] == cells[1:]) & ok[:, 0], [False])).astype(np.float32)
    out[some, -4] = np.add.reduceat(again, first) / size[:, 0]
    out[some, -3] = np.linalg.norm(out[some, :DIM], axis=1)
    out[some, -2] = np.log(n[some])
    out[some, -1] = np.log1p(np.diff(offs)[some] / n[some])
    return out


class Network:
    """x -> relu(x W1 + b1) W2 + b2, inputs standardised, output divided by a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 60, rate: float = 3e-3,
                 decay: float = 1e-4, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.mean, self.scale, self.t = x.mean(axis=0), x.std(axis=0) + 1e-6, 1.0
        d = x.shape[1]
        self.p = [rng.normal(0, (2 / d) ** 0.5, (d, hidden)), np.zeros(hidden), rng.normal(0, (1 / hidden) ** 0.5, hidden), np.zeros(1)]
        hold = np.arange(len(x)) % 6 == 5                    # for the temperature
        tx, ty = (x[~hold] - self.mean) / self.scale, y[~hold]
        m, v, step = [np.zeros_like(q) for q in self.p], [np.zeros_like(q) for q in self.p], 0
        for _ in range(epochs):
            order = rng.permutation(len(tx))
            for a in range(0, len(tx), 128):
                bx, by = tx[order[a:a + 128]], ty[order[a:a + 128]]
                h = np.maximum(bx @ self.p[0] + self.p[1], 0)
                e = (_sigmoid(h @ self.p[2] + self.p[3]) - by) / len(by)
                back = np.outer(e, self.p[2]) * (h > 0)
                grads = [bx.T @ back + decay * self.p[0], back.sum(axis=0), h.T @ e + decay * self.p[2], np.array([e.sum()])]
                step += 1
                for k, g in enumerate(grads):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] = self.p[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
        if hold.any():
            z, hy = self.logits(x[hold]), y[hold]
            losses = {t: np.logaddexp(0, np.where(hy > 0, -z, z) / t).mean() for t in np.geomspace(0.25, 8, 61)}
            self.t = min(losses, key=losses.get)

    def logits(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum(((x - self.mean) / self.scale) @ self.p[0] + self.p[1], 0)
        return h @ self.p[2] + self.p[3]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(x) / self.t)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def train(docs: DataFrame, labels: DataFrame, vec: np.ndarray, train_rows: int = 20_000) -> Network | None:
    """Network fitted on at most ``train_rows`` rows of ``labels`` (doc_id, quality 0/1), in the
    order of a hash of doc_id; None if there are none. The driver gets their pooled vectors."""
    some = labels.where("doc_id is not null and quality in (0, 1)").select(F.col("doc_id").alias("id"), "quality")
    some = hash_sample(some, ["id"], train_rows)
    sent = docs.sparkSession.sparkContext.broadcast(vec)

    def run(batches):
        index, v = dense_index(), sent.value
        for batch in batches:
            for lo, hi, buf, offs in runs(batch.column("text")):
                x = pooled(buf, offs, v, index)
                off = pa.array(np.arange(hi - lo + 1, dtype=np.int32) * WIDTH)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), batch.column("quality").slice(lo, hi - lo),
                                                  pa.ListArray.from_arrays(off, pa.array(x.ravel()))], names=["doc_id", "quality", "x"])

    # at most train_rows rows of two integers
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = base.join(F.broadcast(some), F.col("doc_id") == F.col("id")).select("doc_id", "text", F.col("quality").cast("int").alias("quality"))
    got = rows.mapInArrow(run, "doc_id long, quality int, x array<float>").toArrow()
    if not got.num_rows:
        return None
    x = got["x"].combine_chunks().flatten().to_numpy().reshape(-1, WIDTH).astype(np.float64)
    y, ids = got["quality"].to_numpy(), got["doc_id"].to_numpy()
    order = np.lexsort((y, mix(ids.astype(np.uint64))))
    return Network(x[order], y[order].astype(np.float64))


def score(docs: DataFrame, vec: np.ndarray, net: Network | None) -> DataFrame:
    """``docs`` (doc_id, text) -> (doc_id, score): the calibrated probability of label 1.

    Defined cases: a null or empty text is scored as a text without tokens; without any label
    every score is 0.5; rows count as they stand; other columns are ignored."""
    sent = docs.sparkSession.sparkContext.broadcast((vec, net))

    def run(batches):
        index, (v, n) = dense_index(), sent.value
        for batch in batches:
            for lo, hi, buf, offs in runs(batch.column("text")):
                p = n.probability(pooled(buf, offs, v, index).astype(np.float64)) if n else np.full(hi - lo, 0.5)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(p)], names=["doc_id", "score"])

    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return base.mapInArrow(run, "doc_id long, score double")
