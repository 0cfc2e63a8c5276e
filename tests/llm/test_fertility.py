"""Operator 12 against brute force on plain Python values."""

import base64
import collections
import math
import re

import public_tokenizers as public
import pytest

from tabforge.llm import fertility
from tabforge.llm.queries import op12_fertility
from tabforge.session import table

from ..conftest import SF_SMALL

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def base_counts(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    many = collections.Counter(grams)
    hit = {i + j for i, g in enumerate(grams) if many[g] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit))


def rules(docs):
    return fertility.quality_rules(docs, public.path("piece_bpe_32k.model"), public.path("byte_bpe_multi_50k.tiktoken"), public.PATTERN)


def test_whole_table_equals_brute_force(spark):
    want = {r.doc_id: base_counts(r.text) for r in table(spark, SF_SMALL, "documents").collect()}
    got = op12_fertility(spark, SF_SMALL).collect()
    assert len(got) == len(want)
    for r in got:
        assert tuple(r[c] for c in BASE) == want[r.doc_id], r.doc_id
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed and not (failed and r.kept)


def test_measures_equal_the_libraries(spark):
    import sentencepiece
    import tiktoken
    piece = sentencepiece.SentencePieceProcessor(model_file=public.path("piece_bpe_32k.model"))
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    enc = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["a plain text, with words", "жизнь и 日本語 \U0001f600 ⠿⠿", "x" * 1000 + " tail", "one", "", None, " \n\t "]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in rules(docs).collect()}
    for i, t in enumerate(texts):
        words = re.findall("[^\x20\x09-\x0D]+", t or "")
        parts = [w[a:a + 256] for w in words for a in range(0, len(w), 256)]
        ids = [x for w in parts for x in piece.encode(w)]
        n, c = len(ids), collections.Counter(ids)
        assert got[i].n_tokens == n
        assert got[i].piece_chars == pytest.approx(sum(map(len, words)) / max(n, 1))
        assert got[i].byte_chars == pytest.approx(sum(map(len, words)) / max(1, sum(len(enc.encode_ordinary(" " + w)) for w in parts)))
        assert got[i].fallback == pytest.approx(sum(piece.is_byte(x) for x in ids) / max(n, 1))
        bits = -sum(k / n * math.log2(k / n) for k in c.values()) if n > 1 else 1.0
        assert got[i].entropy == pytest.approx(bits / math.log2(min(n, 32000)) if n > 1 else 1.0)
    assert [got[i].script for i in range(7)] == ["latin", "cyrillic", "latin", "latin", "none", "none", "none"]


def test_bands_reject_what_their_language_does_not_hold(spark):
    good = [(i, "en", " ".join(f"the {w} of a {w}ing house and river number {i + k}" for k, w in enumerate(["read", "walk", "sing", "play", "form", "help"])))
            for i in range(40)]
    bad = [(100, "en", " ".join("zxq#$%vkj&*" + str(k) for k in range(60))), (101, None, good[0][2])]
    got = {r.doc_id: r for r in rules(spark.createDataFrame(good + bad, "doc_id long, lang string, text string")).collect()}
    assert all(got[i].kept for i in range(40)) and got[101].kept
    assert not got[100].kept and not got[100].base_failed and "byte_chars" in got[100].reasons


def test_defined_cases(spark):
    rows = [(None, "a b c a b c", 1), (7, "same line\nsame line\n\n\nsame line", 2), (7, "same line\nsame line\n\n\nsame line", 2),
            (8, "l\n" * 70_000 + "end" * 100_000, 3), (9, None, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int")
    got = sorted(rules(docs).collect(), key=lambda r: r.doc_id or 0)
    assert [tuple(r[c] for c in BASE) for r in got] == [base_counts(t) for _, t, _ in rows]
    assert rules(docs.limit(0)).count() == 0


def test_equal_hashes_of_unequal_spans_are_told_apart(monkeypatch):
    import numpy as np
    buf = np.frombuffer(b"ab cd ab ef", np.uint8)
    a = np.array([0, 3, 6, 9])
    monkeypatch.setattr(fertility, "span_hashes", lambda b, s, e, fold_case: np.zeros(len(s), np.uint64))
    code, first = fertility.exact_codes(buf, a, a + 2)
    assert code.tolist() == [0, 1, 0, 2] and first.tolist() == [0, 1, 3]
