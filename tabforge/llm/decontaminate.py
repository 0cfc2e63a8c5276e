"""Benchmark passages in documents by Wu-Manber search over words (operator 7).

The patterns are all windows of 13 consecutive benchmark words (a shorter item is one window of
its own length). Per pattern length m, as in Wu and Manber's method:

* a block is two consecutive words (one word if m = 1); the shift table gives, for each block of
  a pattern, how far an alignment may move before that block can end a pattern. Every other
  block allows m - 1 words, so nearly all positions are never looked at;
* at shift 0 the alignment's suffix block and the hash of its other words pick the bucket of
  test windows;
* the bucket's window is compared with the document word for word, first by 64-bit word codes and
  then by the words' bytes, before it counts.

NumPy moves one cursor per stretch of m - 1 alignments, all cursors of a run of texts at once.
The windows and their owners are made by Spark (one row per distinct window); the driver gets them
packed, in slices of about ``slice_words`` windows, and sorts a slice into tables. One slice is
broadcast at a time. One slice is the usual case and documents are not shuffled; with more,
documents with what they have collected so far are written between slices. No step gathers
documents.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from tabforge.llm._store import stored
from tabforge.llm._text import ALNUM, LOWER, gram_hashes, rows_of, runs, span_hashes, word_spans

WINDOW = 13
_HELD = "text string, spans array<int>, items array<string>"
_FOUND = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, spans array<int>, items array<string>"


def benchmark_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(m, raw, codes, items): every distinct window of ``items`` (item_id, text), its words in lower
    case and their codes, with the sorted ids of the items that hold it."""
    def run(batches):
        for batch in batches:
            ids = batch.column("item_id")
            for lo, hi, buf, offs in runs(batch.column("text")):
                starts, ends, woff = word_spans(buf, offs, ALNUM)
                codes, low = span_hashes(buf, starts, ends), LOWER[buf].tobytes()
                words = [low[x:y] for x, y in zip(starts.tolist(), ends.tolist())]
                n = np.diff(woff)
                m = np.minimum(n, window)
                for k in np.unique(m[m > 0]).tolist():
                    own = np.flatnonzero(m == k)
                    many = n[own] - k + 1
                    at = np.repeat(woff[own] - np.cumsum(many) + many, many) + np.arange(many.sum())
                    for a in range(0, len(at), 20_000):
                        some, who = at[a:a + 20_000], np.repeat(own, many)[a:a + 20_000]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(some), k, np.int32)), pa.array([b" ".join(words[i:i + k]) for i in some.tolist()], pa.binary()),
                             pa.array([codes[i:i + k].tobytes() for i in some.tolist()], pa.binary()), ids.take(pa.array(lo + who))],
                            names=["m", "raw", "codes", "item_id"])

    each = items.mapInArrow(run, "m int, raw binary, codes binary, item_id string").distinct()
    return each.groupBy("m", "raw", "codes").agg(F.sort_array(F.collect_set("item_id")).alias("items"))


def pattern_tables(windows: pa.Table) -> dict:
    """Shift tables, buckets and owners of the rows of ``benchmark_windows``, by length."""
    lengths = windows["m"].to_numpy()
    names, own = np.unique(np.array([x for i in windows["items"].to_pylist() for x in i], object), return_inverse=True)
    n_own = pc.list_value_length(windows["items"]).to_numpy().astype(np.int64)
    first = np.cumsum(n_own) - n_own
    tables = []
    for m in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == m)
        pat = np.frombuffer(b"".join(windows["codes"].take(pa.array(rows)).to_pylist()), np.uint64).reshape(-1, m)
        size = min(2, m)
        far = m - size + 1
        blocks = gram_hashes(pat.ravel(), size)             # block k of row i starts at word i * m + k
        block = blocks[np.arange(len(pat))[:, None] * m + np.arange(far)].ravel()
        left = np.tile(far - 1 - np.arange(far), len(pat))  # words between the block's end and the pattern's
        keys, of = np.unique(block, return_inverse=True)
        shift = np.full(len(keys), far)
        np.minimum.at(shift, of, left)
        whole = gram_hashes_rows(pat)
        order = np.argsort(whole, kind="stable")
        rows, many = rows[order], n_own[rows[order]]
        raw = windows["raw"].take(pa.array(rows)).to_pylist()
        tables.append({"m": m, "size": size, "far": far, "keys": keys, "shift": shift, "whole": whole[order], "pat": pat[order], "raw": raw,
                       "own": own[np.repeat(first[rows] - np.cumsum(many) + many, many) + np.arange(many.sum())],
                       "off": np.concatenate(([0], np.cumsum(many))).astype(np.int64)})
    return {"ids": names.tolist(), "tables": tables}


def occurrences(codes: np.ndarray, woff: np.ndarray, t: dict, word) -> tuple[np.ndarray, np.ndarray]:
    """(index of the last word, pattern) of every occurrence of the patterns of one length;
    ``word(i)`` gives the bytes of word i in lower case."""
    m, far = t["m"], t["far"]
    none = np.zeros(0, np.int64)
    if len(codes) < m or not len(t["keys"]):
        return none, none
    blocks = gram_hashes(codes, t["size"])                  # block ending at word e: blocks[e - size + 1]
    n = np.diff(woff)
    stretches = np.where(n >= m, -(-(n - m + 1) // far), 0)
    doc = np.repeat(np.arange(len(n)), stretches)
    rank = np.arange(len(doc)) - np.repeat(np.cumsum(stretches) - stretches, stretches)
    at = woff[doc] + m - 1 + rank * far
    stop = np.minimum(at + far, woff[doc + 1])
    found = []
    while len(at):
        b = blocks[at - t["size"] + 1]
        k = np.minimum(np.searchsorted(t["keys"], b), len(t["keys"]) - 1)
        move = np.where(t["keys"][k] == b, t["shift"][k], far)
        found.append(at[move == 0])
        at = at + np.maximum(move, 1)
        on = at < stop
        at, stop = at[on], stop[on]
    ends = np.concatenate(found)
    good_e, good_p = [], []
    for a in range(0, len(ends), 65536):
        e = ends[a:a + 65536]
        words = codes[e[:, None] + np.arange(1 - m, 1)]
        whole = gram_hashes_rows(words)
        p = np.searchsorted(t["whole"], whole)
        while len(p):                                       # every window in the bucket: more than one only if hashes clash
            inside = p < len(t["whole"])
            inside[inside] = t["whole"][p[inside]] == whole[inside]
            e, p, words, whole = e[inside], p[inside], words[inside], whole[inside]
            same = np.flatnonzero((t["pat"][p] == words).all(axis=1))
            same = same[[t["raw"][p[i]] == b" ".join(map(word, range(e[i] - m + 1, e[i] + 1))) for i in same]] if len(same) else same
            good_e.append(e[same])
            good_p.append(p[same])
            p = p + 1
    return (np.concatenate(good_e), np.concatenate(good_p)) if good_e else (none, none)


def gram_hashes_rows(words: np.ndarray) -> np.ndarray:
    """``gram_hashes`` of each row as one gram."""
    n, m = words.shape
    return gram_hashes(words.ravel(), m)[::m] if n else np.zeros(0, np.uint64)


def scan_run(buf: np.ndarray, offs: np.ndarray, patterns: dict) -> tuple[np.ndarray, list[list[int]], list[list[str]]]:
    """Per row: number of words, hit spans (first word, end word, ...), item ids."""
    starts, ends, woff = word_spans(buf, offs, ALNUM)
    codes = span_hashes(buf, starts, ends)
    rows = len(offs) - 1
    spans: list[list[int]] = [[] for _ in range(rows)]
    items: list[list[str]] = [[] for _ in range(rows)]
    hit = np.zeros(len(codes) + 1, np.int64)
    pairs = []
    doc_of = rows_of(woff)
    known: dict[int, bytes] = {}

    def word(i: int) -> bytes:
        if i not in known:
            known[i] = LOWER[buf[starts[i]:ends[i]]].tobytes()
        return known[i]
    for t in patterns["tables"]:
        e, p = occurrences(codes, woff, t, word)
        if not len(e):
            continue
        np.add.at(hit, e - t["m"] + 1, 1)
        np.add.at(hit, e + 1, -1)
        reps = t["off"][p + 1] - t["off"][p]
        own = t["own"][np.repeat(t["off"][p], reps) + np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)]
        pairs.append(np.unique(np.stack([np.repeat(doc_of[e], reps), own], axis=1), axis=0))
    if pairs:
        for d, i in np.unique(np.concatenate(pairs), axis=0).tolist():
            items[d].append(patterns["ids"][i])
        on = (np.cumsum(hit)[:-1] > 0).astype(np.int8)
        for d in np.unique(doc_of[on > 0]).tolist():
            edge = np.flatnonzero(np.diff(np.concatenate(([0], on[woff[d]:woff[d + 1]], [0]))))
            spans[d] = edge.tolist()
    return np.diff(woff), spans, items


def _scanner(patterns, last: bool, held: bool):
    """Rows (row, text[, spans, items]) -> the same with more found, or the final columns."""
    def run(batches):
        pats = patterns.value
        for batch in batches:
            row, text = batch.column("row"), batch.column("text")
            for lo, hi, buf, offs in runs(text):
                n, spans, items = scan_run(buf, offs, pats)
                if held:
                    old_s, old_i = (batch.column(c).slice(lo, hi - lo).to_pylist() for c in ("spans", "items"))
                    spans = [_union(a, b) for a, b in zip(old_s, spans)]
                    items = [a + b for a, b in zip(old_i, items)]
                own = row.slice(lo, hi - lo)
                if not last:
                    yield pa.RecordBatch.from_arrays([own, text.slice(lo, hi - lo), pa.array(spans, pa.list_(pa.int32())),
                                                      pa.array(items, pa.list_(pa.string()))], names=["row", "text", "spans", "items"])
                    continue
                n_hit = [sum(s[1::2]) - sum(s[::2]) for s in spans]
                names = [sorted(set(i)) for i in items]
                yield pa.RecordBatch.from_arrays(
                    [own, pa.array(n, pa.int64()), pa.array(n_hit, pa.int64()),
                     pa.array([len(x) for x in names], pa.int64()),
                     pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in names]),
                     pa.array([h > 0 and 20 * h >= k for h, k in zip(n_hit, n.tolist())], pa.bool_()),
                     pa.array(spans, pa.list_(pa.int32())), pa.array(names, pa.list_(pa.string()))],
                    names=["row", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans", "items"])
    return run


def _union(a: list[int], b: list[int]) -> list[int]:
    out: list[int] = []
    for s, e in sorted([*zip(a[::2], a[1::2]), *zip(b[::2], b[1::2])]):
        if out and s <= out[-1]:
            out[-1] = max(out[-1], e)
        else:
            out += [s, e]
    return out


def _scan(rows: DataFrame, benchmark: DataFrame, window: int, slice_words: int) -> DataFrame:
    """``rows`` (row, text) -> (row, what was found)."""
    sc, kind = rows.sparkSession.sparkContext, StructType([rows.schema["row"]])
    schema = lambda ddl: StructType([*kind.fields, *StructType.fromDDL(ddl).fields])
    item = F.coalesce(F.col("item_id").cast("string"), F.lit("null"))
    items = benchmark.select(item.alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    windows = stored(benchmark_windows(items, window), "windows")
    slices = max(1, -(-windows.count() // slice_words))
    held, ahead = False, None
    for k in range(slices):
        if ahead is not None:
            rows, held = stored(rows.mapInArrow(_scanner(ahead, False, held), schema(_HELD)), "scanned"), True
        ahead = sc.broadcast(pattern_tables(windows.where(F.pmod(F.xxhash64("m", "raw"), F.lit(slices)) == k).toArrow()))
    return rows.mapInArrow(_scanner(ahead, True, held), schema(_FOUND))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slice_words: int = 500_000) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans, items), one row per
    row of ``docs``: ``spans`` are the hit words as first, end, first, end, ...; ``items`` the
    sorted ids of the items with an occurring window. A document is contaminated if 5 % of its
    words or more are hit.

    Defined cases: a null or empty text has no words and is clean; a null item text has no
    window; a null item_id is named "null"; repeated rows of either table count as they stand
    (an item id counts once per document); an empty benchmark hits nothing; other columns are
    ignored."""
    rows = docs.select(F.col("doc_id").cast("long").alias("row"), F.col("text").cast("string").alias("text"))
    return _scan(rows, benchmark, window, slice_words).withColumnRenamed("row", "doc_id")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slice_words: int = 500_000) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are not contaminated."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("text").cast("string").alias("text"))
    return _scan(rows, benchmark, window, slice_words).where("not contaminated").select("row.*")
