"""Languages of a text as a mixture fitted by expectation-maximisation (operator 9).

Training counts the byte trigrams of the words of every labelled training text into a table
(languages x hashed trigrams) whose size does not depend on the corpus. A word's likelihood in
a language is the product of its smoothed trigram probabilities. Each document's language
proportions are then fitted by EM over its words; the language set is chosen by penalised
likelihood (BIC), dropping the weakest language while that loses less likelihood than the
penalty saves. All documents of a run are fitted at once in NumPy.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabforge.llm._sums import table_sum
from tabforge.llm._text import LOWER, U, byte_set, runs, string_buffers, word_spans

CELLS = 1 << 15
#: Words are runs of ASCII letters and non-ASCII characters.
LETTERS = byte_set((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
UNKNOWN = "und"


def trigrams(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashed trigram at each word byte, first trigram of each word, word offsets per row).
    The bytes before and after a word count as spaces."""
    starts, ends, woff = word_spans(buf, offs, LETTERS)
    if not len(starts):
        return np.zeros(0, np.int64), starts, woff
    low = LOWER[buf].astype(np.uint32)
    word = LETTERS[buf]
    size = ends - starts
    first = np.concatenate(([0], np.cumsum(size)))
    here = low[word]
    prev, nxt = np.roll(here, 1), np.roll(here, -1)
    prev[first[:-1]] = 32
    nxt[first[1:] - 1] = 32
    h = (prev * np.uint32(0x9E3779B1)) ^ (here * np.uint32(0x85EBCA77)) ^ (nxt * np.uint32(0xC2B2AE3D))
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return (h >> np.uint32(17)).astype(np.int64), first, woff


def train(docs: DataFrame, max_langs: int = 256) -> tuple[list[str], np.ndarray]:
    """(languages, log probabilities languages x CELLS) from all rows of ``docs`` (text, lang)."""
    labelled = docs.where("text is not null and lang is not null")
    langs = sorted(r.lang for r in labelled.select("lang").distinct().limit(max_langs + 1).collect())
    if len(langs) > max_langs:
        raise ValueError(f"more than {max_langs} languages; raise max_langs (the model has {CELLS} cells for each)")
    if not langs:
        return [], np.zeros((0, CELLS))
    place = {x: k for k, x in enumerate(langs)}

    def add(batch, table):
        lang = np.array([place[x] for x in batch.column("lang").to_pylist()], np.int64)
        for lo, hi, buf, offs in runs(batch.column("text")):
            gram, first, woff = trigrams(buf, offs)
            row = np.repeat(lang[lo:hi], np.diff(first[woff])) if len(gram) else gram
            for k in np.unique(row):
                table[k * CELLS:(k + 1) * CELLS] += np.bincount(gram[row == k], minlength=CELLS)

    counts = table_sum(labelled.select("text", "lang"), len(langs) * CELLS, "int64", add).reshape(len(langs), CELLS) + 0.5
    return langs, np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)


def _em(like: np.ndarray, woff: np.ndarray, doc: np.ndarray, pi: np.ndarray, turns: int) -> tuple[np.ndarray, np.ndarray]:
    """(proportions, log likelihood) per document from word likelihoods scaled to at most 1."""
    n = np.maximum(np.diff(woff), 1)[:, None]
    ll = np.zeros(len(pi))
    for _ in range(turns):
        r = like * pi[doc]
        total = r.sum(axis=1)
        ll = np.add.reduceat(np.log(total), woff[:-1])
        r /= total[:, None]
        pi = np.add.reduceat(r, woff[:-1], axis=0) / n
    return pi, ll


def mixtures(buf: np.ndarray, offs: np.ndarray, logp: np.ndarray, turns: int = 8, penalty: float = 1.0) -> np.ndarray:
    """Proportions (rows x languages) in the selected set; rows without words get zeros."""
    rows, k = len(offs) - 1, len(logp)
    out = np.zeros((rows, k))
    gram, first, woff_all = trigrams(buf, offs)
    n_all = np.diff(woff_all)
    some = np.flatnonzero(n_all > 0)
    if not len(some) or not k:
        return out
    woff = np.concatenate(([0], np.cumsum(n_all[some])))
    doc = np.repeat(np.arange(len(some)), n_all[some])
    words = np.stack([np.add.reduceat(logp[j][gram], first[:-1], dtype=np.float64) for j in range(k)], axis=1)
    like = np.maximum(np.exp(words - words.max(axis=1, keepdims=True)), 1e-30)
    pi, ll = _em(like, woff, doc, np.full((len(some), k), 1.0 / k), turns)
    cost = penalty * np.log(n_all[some] + 1.0)
    open_ = np.ones(len(some), bool)                         # documents whose set may still shrink
    for _ in range(k - 1):
        width = (pi > 0).sum(axis=1)
        d = np.flatnonzero(open_ & (width > 1))
        if not len(d):
            break
        weakest = np.where(pi[d] > 0, pi[d], 2.0).argmin(axis=1)
        less = pi[d].copy()
        less[np.arange(len(d)), weakest] = 0.0
        less /= less.sum(axis=1, keepdims=True)
        sub = np.concatenate(([0], np.cumsum(n_all[some][d])))
        pick = np.zeros(len(some), bool)
        pick[d] = True
        new_pi, new_ll = _em(like[pick[doc]], sub, np.repeat(np.arange(len(d)), n_all[some][d]), less,
                             1 if (width[d] == 2).all() else turns // 2)
        better = new_ll + cost[d] >= ll[d]
        pi[d[better]], ll[d[better]] = new_pi[better], new_ll[better]
        open_[d[~better]] = False
    out[some] = pi
    return out


def _predictions(text: pa.Array, langs: list[str], logp: np.ndarray):
    """(first row, end row, languages, scores, mixtures) of runs of rows."""
    for lo, hi, buf, offs in runs(text):
        pi = mixtures(buf, offs, logp)
        letter = byte_set((0x41, 0x5A), (0x61, 0x7A))[buf]
        seen = np.diff(np.concatenate(([0], np.cumsum(letter)))[offs]) > 0
        best, score, mix = [], [], []
        for i in range(hi - lo):
            known = langs and (seen[i] or any(c.isalpha() for c in text[lo + i].as_py() or ""))
            j = int(pi[i].argmax()) if known else -1
            best.append(langs[j] if known else UNKNOWN)
            score.append(float(min(1.0, pi[i, j])) if known else 0.0)
            mix.append([(langs[x], float(pi[i, x])) for x in np.flatnonzero(pi[i] > 0)] if known else [])
        yield lo, hi, best, score, mix


def identify(docs: DataFrame, langs: list[str], logp: np.ndarray) -> DataFrame:
    """``docs`` (doc_id, text) -> (doc_id, lang_pred, score, mixture map<string,double>). The
    predicted language is the one with the largest proportion (ties: the first by name).

    Defined cases: a null text, or one without any letter, is ``und`` with score 0; so is every
    text if no language was learned; rows count as they stand; an empty table gives no rows;
    other columns are ignored."""
    model = docs.sparkSession.sparkContext.broadcast((langs, logp))

    def run(batches):
        langs, logp = model.value
        for batch in batches:
            for lo, hi, best, score, mix in _predictions(batch.column("text"), langs, logp):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array(best, pa.string()), pa.array(score, pa.float64()),
                     pa.array(mix, pa.map_(pa.string(), pa.float64()))], names=["doc_id", "lang_pred", "score", "mixture"])

    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return base.mapInArrow(run, "doc_id long, lang_pred string, score double, mixture map<string,double>")


def drop_unknown(docs: DataFrame, langs: list[str], logp: np.ndarray) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text has a known language; if no language
    was learned, those whose text has a letter."""
    model = docs.sparkSession.sparkContext.broadcast((langs, logp))

    def run(batches):
        langs, logp = model.value
        for batch in batches:
            text = batch.column("text")
            if not langs:
                yield batch.filter(pa.array([any(c.isalpha() for c in t or "") for t in text.to_pylist()], pa.bool_()))
                continue
            for lo, hi, best, _, _ in _predictions(text, langs, logp):
                yield batch.slice(lo, hi - lo).filter(pa.array([b != UNKNOWN for b in best], pa.bool_()))
    return docs.mapInArrow(run, docs.schema)


def fold_of(modulus: int):
    """crc32 of the doc_id as text, modulo ``modulus`` (0 for a null doc_id)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus, F.lit(0))
