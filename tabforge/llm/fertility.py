"""Quality rules from tokeniser fertility (operator 12).

1. ``measure``: one pass over whole texts. Every distinct word of a run of rows is encoded once by
   two public vocabularies, and a document gets, from all its words: characters per token of each
   vocabulary, the share of byte-fallback tokens, and the entropy of its tokens (in bits, divided
   by the most its token count allows). The same pass counts words, symbols, equal lines and
   repeated three-word windows.
2. ``bands``: for each language (the ``lang`` column; none where it is null or missing) and script,
   and for the entropy each octave of the token count, the quartiles of each measure over **all**
   documents, from exact counts of binned values. A band reaches ``reach`` times the quartile distance beyond the
   quartiles (never less than a floor, so that many copies of one text do not close it).
   Characters per token are bounded on both sides, fallback above, entropy below.
3. ``verdicts``: a document is kept if no base rule fails and every measure is within its band.

Identity of words, windows and lines is decided by their bytes: hashes only propose it.
"""

from __future__ import annotations

import base64
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tabforge.llm._store import stored
from tabforge.llm._text import NOT_SPACE, byte_set, rows_of, runs, span_hashes, word_spans

SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
LINE = ~byte_set((0x0A, 0x0A))
#: Words are encoded in pieces of at most this many characters (encoders are slow on long words).
PIECE_CHARS = 256
#: First code point of each block and its script, from the Unicode block list. Fixed values.
BLOCKS = (
    (0x0000, "none"), (0x0041, "latin"), (0x005B, "none"), (0x0061, "latin"), (0x007B, "none"),
    (0x00C0, "latin"), (0x00D7, "none"), (0x00D8, "latin"), (0x00F7, "none"), (0x00F8, "latin"),
    (0x02B0, "none"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0700, "other"), (0x0750, "arabic"), (0x0780, "other"), (0x0900, "devanagari"),
    (0x0980, "bengali"), (0x0A00, "other"), (0x0B80, "tamil"), (0x0C00, "other"), (0x0E00, "thai"),
    (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"),
    (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "none"), (0x2C60, "latin"), (0x2C80, "other"),
    (0x3000, "none"), (0x3040, "kana"), (0x3100, "other"), (0x3130, "hangul"), (0x3190, "other"),
    (0x31F0, "kana"), (0x3200, "none"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"),
    (0xD7B0, "other"), (0xE000, "none"), (0xF900, "han"), (0xFB00, "other"), (0xFE00, "none"),
    (0xFE70, "arabic"), (0xFF00, "none"), (0x10000, "other"), (0x1F000, "none"), (0x20000, "han"),
    (0xE0000, "none"))
SCRIPTS = sorted({s for _, s in BLOCKS} - {"none"})
_BLOCK_AT = np.array([a for a, _ in BLOCKS])
_BLOCK_SCRIPT = np.array([SCRIPTS.index(s) if s != "none" else -1 for _, s in BLOCKS])
_BYTE_SCRIPT = _BLOCK_SCRIPT[np.searchsorted(_BLOCK_AT, np.arange(128), side="right") - 1]

#: (column, bins per unit, whether too little and too much reject, least quartile distance: of the median, absolute)
MEASURES = (("piece_chars", 256, True, True, 0.05, 0.0), ("byte_chars", 256, True, True, 0.035, 0.0),
            ("fallback", 256, False, True, 0.0, 0.05), ("entropy", 256, True, False, 0.0, 0.05))
#: Copies of the bands that documents are dealt over, so that a common language is no hot key.
SALTS = 64
SCHEMA = ("doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "n_tokens long, script string, piece_chars double, byte_chars double, fallback double, entropy double")


def exact_codes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code of each span, position of each code's first span): equal codes are equal bytes. Spans
    of one hash are compared byte by byte with the first of them; if any differ, bytes decide."""
    h = span_hashes(buf, starts, ends, fold_case=False)
    _, first, code = np.unique(h, return_index=True, return_inverse=True)
    size = ends - starts
    head = first[code]
    same = bool((size == size[head]).all())
    a = 0
    while same and a < len(starts):                          # some 4 MB of bytes at a time
        b = max(a + 1, int(np.searchsorted(np.cumsum(size[a:]), 1 << 22)) + a)
        n, total = size[a:b], int(size[a:b].sum())
        step = np.arange(total) - np.repeat(np.cumsum(n) - n, n)
        same = bool((buf[np.repeat(starts[a:b], n) + step] == buf[np.repeat(starts[head[a:b]], n) + step]).all())
        a = b
    if not same:
        seen: dict[bytes, int] = {}
        code = np.array([seen.setdefault(buf[s:e].tobytes(), len(seen)) for s, e in zip(starts, ends)], np.int64)
        _, first = np.unique(code, return_index=True)
    return code, first


def repeated_words(code: np.ndarray, off: np.ndarray, k: int = 3) -> np.ndarray:
    """Per row, the words in windows of k words that the row holds twice or more."""
    rows, n = len(off) - 1, len(code)
    out = np.zeros(rows, np.int64)
    if n < k:
        return out
    row = rows_of(off)
    inside = row[:n - k + 1] == row[k - 1:]
    at = np.flatnonzero(inside)
    key = row[at].astype(np.int64)
    for j in range(k):                                       # dense numbers of (row, w1 .. wj): exact
        _, key = np.unique(key * (int(code.max()) + 1) + code[at + j], return_inverse=True)
    again = at[np.bincount(key)[key] > 1]
    hit = np.zeros(n, bool)
    for j in range(k):
        hit[again + j] = True
    return np.bincount(row[hit], minlength=rows)


def equal_lines(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Per row, the lines with a word that equal an earlier line of the row."""
    rows = len(offs) - 1
    a, b, off = word_spans(buf, offs, LINE)                  # runs without \\n are whole lines
    if not len(a):
        return np.zeros(rows, np.int64)
    words = np.concatenate(([0], np.cumsum(NOT_SPACE[buf])))
    row, real = rows_of(off), words[b] > words[a]
    a, b, row = a[real], b[real], row[real]
    code, _ = exact_codes(buf, a, b)
    key = row * (int(code.max(initial=0)) + 1) + code
    _, first = np.unique(key, return_index=True)
    return np.bincount(row, minlength=rows) - np.bincount(row[first], minlength=rows)


def scripts_of(buf: np.ndarray, offs: np.ndarray) -> list[str]:
    """Per row, the script of most letters ('none' without letters; the first by name on a tie)."""
    at = np.flatnonzero((buf & 0xC0) != 0x80)
    lead = buf[at].astype(np.int64)
    kind = np.full(len(at), -1)
    plain = lead < 128
    kind[plain] = _BYTE_SCRIPT[lead[plain]]
    wide = np.flatnonzero(~plain)
    if len(wide):
        size = 2 + (lead[wide] >= 0xE0) + (lead[wide] >= 0xF0)
        cp = lead[wide] & np.array([0, 0, 0x1F, 0x0F, 0x07])[size]
        for j in range(1, 4):
            more = size > j
            cp[more] = cp[more] << 6 | (buf[at[wide[more]] + j] & 0x3F)
        kind[wide] = _BLOCK_SCRIPT[np.searchsorted(_BLOCK_AT, cp, side="right") - 1]
    row = np.searchsorted(offs, at, side="right") - 1
    ok = kind >= 0
    counts = np.bincount(row[ok] * len(SCRIPTS) + kind[ok], minlength=(len(offs) - 1) * len(SCRIPTS)).reshape(-1, len(SCRIPTS))
    best = counts.argmax(axis=1)
    return [SCRIPTS[k] if counts[i, k] else "none" for i, k in enumerate(best)]


class Vocabularies:
    """The two public vocabularies, opened once per worker."""

    def __init__(self, piece_model: bytes, byte_ranks: bytes, pattern: str):
        import sentencepiece
        import tiktoken
        self.piece = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in byte_ranks.splitlines() if line)}
        self.byte = tiktoken.Encoding("fertility", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.is_byte = np.array([self.piece.is_byte(i) for i in range(self.piece.vocab_size())])

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(piece ids of all words, number of piece ids of each, number of byte-level tokens of each)."""
        parts, owner = words, None
        if any(len(w) > PIECE_CHARS for w in words):
            cut = [[w[a:a + PIECE_CHARS] for a in range(0, len(w), PIECE_CHARS)] for w in words]
            parts, owner = list(itertools.chain.from_iterable(cut)), np.repeat(np.arange(len(words)), [len(c) for c in cut])
        got = self.piece.encode(parts, num_threads=1)
        size = np.fromiter((len(g) for g in got), np.int64, len(got))
        ids = np.fromiter(itertools.chain.from_iterable(got), np.int64, int(size.sum()))
        small = np.fromiter((len(self.byte.encode_ordinary(" " + w)) for w in parts), np.int64, len(parts))
        if owner is not None:
            size, small = (np.bincount(owner, x, len(words)).astype(np.int64) for x in (size, small))
        return ids, size, small


def _per_row(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values)))
    return total[off[1:]] - total[off[:-1]]


def measure_run(buf: np.ndarray, offs: np.ndarray, v: Vocabularies) -> dict[str, np.ndarray]:
    """Counts and measures of a run of rows, each row on its own."""
    starts, ends, off = word_spans(buf, offs, NOT_SPACE)
    chars = np.concatenate(([0], np.cumsum((buf & 0xC0) != 0x80)))
    rows, n_words = len(offs) - 1, np.diff(off)
    out = {"n_words": n_words, "word_chars": _per_row(chars[ends] - chars[starts], off),
           "n_symbols": _per_row(SYMBOL[buf].astype(np.int64), offs), "n_dup_lines": equal_lines(buf, offs)}
    code, first = exact_codes(buf, starts, ends) if len(starts) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    out["n_repeat_words"] = repeated_words(code, off)
    raw = buf.tobytes()
    ids, size, small = v.encode([raw[a:b].decode() for a, b in zip(starts[first].tolist(), ends[first].tolist())])
    at = np.cumsum(size) - size
    n = _per_row(size[code], off)
    fallback = np.add.reduceat(np.append(v.is_byte[ids], False), np.minimum(at, len(ids))).astype(np.int64) if len(size) else size
    fallback[size == 0] = 0
    counts = np.zeros(rows)
    entropy, a = np.zeros(rows), 0
    while a < rows:                                          # rows of some 1M tokens at a time
        b = max(a + 1, int(np.searchsorted(np.cumsum(n[a:]), 1 << 20)) + a)
        some, of = code[off[a]:off[b]], rows_of(off[a:b + 1])
        many = size[some]
        flat = ids[np.repeat(at[some], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)]
        _, c = np.unique(np.repeat(of, many) * len(v.is_byte) + flat, return_counts=True)
        row = _ // len(v.is_byte)
        total = np.bincount(row, c, b - a)
        counts[a:b] = total
        entropy[a:b] = np.log2(np.maximum(total, 1)) - np.bincount(row, c * np.log2(c), b - a) / np.maximum(total, 1)
        a = b
    most = np.log2(np.clip(counts, 2, len(v.is_byte)))
    out["n_tokens"] = n
    out["piece_chars"] = out["word_chars"] / np.maximum(n, 1)
    out["byte_chars"] = out["word_chars"] / np.maximum(_per_row(small[code], off), 1)
    out["fallback"] = _per_row(fallback[code], off) / np.maximum(n, 1)
    out["entropy"] = np.where(counts > 1, entropy / most, 1.0)
    return out


def measure(docs: DataFrame, piece_model: str, byte_ranks: str, pattern: str) -> DataFrame:
    """Counts and measures of every row of ``docs`` (doc_id, text), see the module's docstring.
    ``piece_model`` and ``byte_ranks`` are paths of public vocabulary files, read on the driver
    (their sizes are fixed); ``pattern`` splits words for the second."""
    with open(piece_model, "rb") as f, open(byte_ranks, "rb") as g:
        sent = docs.sparkSession.sparkContext.broadcast((f.read(), g.read(), pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = None
        for batch in batches:
            v = v or Vocabularies(*sent.value)
            for lo, hi, buf, offs in runs(batch.column("text")):
                m = measure_run(buf, offs, v)
                cols = {k: batch.column(k).slice(lo, hi - lo) for k in ("doc_id", "lang")}
                cols |= {"script": pa.array(scripts_of(buf, offs), pa.string())} | {k: pa.array(x, pa.float64() if k in _RATES else pa.int64()) for k, x in m.items()}
                yield pa.RecordBatch.from_arrays([cols[k] for k in _NAMES], names=_NAMES)

    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), lang.alias("lang"), F.col("text").cast("string").alias("text"))
    return base.mapInArrow(run, SCHEMA)


_NAMES = [c.split()[0] for c in SCHEMA.split(", ")]
_RATES = {m[0] for m in MEASURES}


def _cells(measures: DataFrame) -> DataFrame:
    """With the cell of a document's rates and, for its entropy, the cell with its length."""
    octave = F.floor(F.log2(F.greatest(F.col("n_tokens"), F.lit(1)))).cast("int")
    of = lambda o: F.struct(F.coalesce("lang", F.lit("")).alias("lang"), "script", o.alias("octave"))
    return measures.withColumn("cell", of(F.lit(-1))).withColumn("sized", of(octave))


def bands(measures: DataFrame, reach: float = 3.0) -> DataFrame:
    """(cell, one low and one high column per measure) over all rows of ``measures``. A cell is
    (lang, script, octave), octave -1 for the measures that do not depend on the length; columns
    of the other kind are null. Quartiles come from exact counts of binned values."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("m"), F.col("sized" if c == "entropy" else "cell").alias("cell"),
                                        F.floor(F.col(c) * n).alias("bin")) for k, (c, n, *_) in enumerate(MEASURES)]))
    counts = _cells(measures).where("n_tokens > 0").select(each.alias("x")).groupBy("x.cell", "x.m", "x.bin").count()
    of = Window.partitionBy("cell", "m")                         # over bins of a bounded range, not over documents
    ranked = counts.select("*", F.sum("count").over(of).alias("all"), F.sum("count").over(of.orderBy("bin")).alias("upto"))
    place = lambda p: F.min(F.when(F.col("upto") >= p * F.col("all"), F.col("bin")))
    quart = ranked.groupBy("cell", "m").agg(place(0.25).alias("a"), place(0.5).alias("mid"), place(0.75).alias("b"))
    cols = []
    for k, (name, n, low, high, share, least) in enumerate(MEASURES):
        a, mid, b = (F.max(F.when(F.col("m") == k, F.col(c))) / n for c in ("a", "mid", "b"))
        width = F.greatest(b - a, share * mid, F.lit(least)) * reach
        cols += [(a - width if low else F.lit(float("-inf"))).alias(f"{name}_low"),
                 (b + 1 / n + width if high else F.lit(float("inf"))).alias(f"{name}_high")]
    return quart.groupBy("cell").agg(*cols)


def verdicts(measures: DataFrame, limits: DataFrame) -> DataFrame:
    """``measures`` with base_failed, kept and reasons (the names of all failed rules)."""
    rules = [F.when(F.col("n_words") < 50, "few_words"), F.when(100 * F.col("n_repeat_words") > 50 * F.col("n_words"), "repeated_windows")]
    soft = [F.when(~F.col(c).between(F.col(f"{c}_low"), F.col(f"{c}_high")), c) for c, *_ in MEASURES]
    salt = F.pmod(F.xxhash64("doc_id", "word_chars"), F.lit(SALTS)).cast("int")
    limits = limits.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    sized = [f"entropy_{e}" for e in ("low", "high")]
    rates = limits.where("cell.octave = -1").drop(*sized)
    lengths = limits.where("cell.octave >= 0").select(F.col("cell").alias("sized"), "salt", *sized)
    joined = _cells(measures).withColumn("salt", salt).join(rates, ["cell", "salt"], "left").join(lengths, ["sized", "salt"], "left")
    failed = lambda r: F.filter(F.array(*r), lambda x: x.isNotNull())
    out = joined.withColumn("reasons", failed(rules + soft)).withColumn("base_failed", F.size(failed(rules)) > 0)
    return out.select(*_NAMES, "base_failed", (F.size("reasons") == 0).alias("kept"), "reasons")


def quality_rules(docs: DataFrame, piece_model: str, byte_ranks: str, pattern: str, reach: float = 3.0) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, and lang if there): counts, measures,
    base_failed, kept, reasons.

    Defined cases: a null or empty text has no words, tokens or script, all counts 0, and fails the
    base rules; a text of one token has entropy 1; rows with a null or repeated doc_id are judged
    each on its own; texts without ``lang`` share the bands of their script; an empty table gives
    no rows; other columns are ignored. Long texts are measured whole, their words in pieces of
    ``PIECE_CHARS`` characters for the encoders."""
    measures = stored(measure(docs, piece_model, byte_ranks, pattern), "fertility")
    return verdicts(measures, stored(bands(measures, reach), "bands"))
