import numpy as np
import pyarrow as pa
import re

from tabforge.llm import _text as t


def test_runs_cover_rows_and_nulls():
    arr = pa.array(["ab", None, "", "x" * 50, "é c"]).slice(1)
    got = [(a, b, bytes(buf), offs.tolist()) for a, b, buf, offs in t.runs(arr, max_bytes=10)]
    assert [x[:2] for x in got] == [(0, 2), (2, 3), (3, 4)]
    assert got[1][2] == b"x" * 50 and got[2][2] == "é c".encode()
    assert list(t.runs(pa.array([], pa.string()))) == []


def test_spans_and_hashes_do_not_depend_on_place():
    texts = ["One two  one", "two", "", " ONE\ttwo\n", "onetwo"]
    buf, offs = t.string_buffers(pa.array(texts))
    s, e, woff = t.word_spans(buf, offs, t.NOT_SPACE)
    words = [bytes(buf[a:b]).decode() for a, b in zip(s, e)]
    assert words == [w for x in texts for w in re.findall(r"\S+", x)]
    assert np.diff(woff).tolist() == [3, 1, 0, 2, 1]
    h = t.span_hashes(buf, s, e)
    assert h[0] == h[2] == h[4] and h[1] == h[3] == h[5] and len(set(h.tolist())) == 3
    assert t.span_hashes(buf, s, e, fold_case=False)[0] != h[0]


def test_hashes_across_blocks(monkeypatch):
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abcdef"), rng.integers(1, 40))) for _ in range(3000)]
    buf, offs = t.string_buffers(pa.array([" ".join(words)]))
    s, e, _ = t.word_spans(buf, offs, t.NOT_SPACE)
    whole = t.span_hashes(buf, s, e)
    monkeypatch.setattr(t, "BLOCK_BYTES", 100)
    assert (t.span_hashes(buf, s, e) == whole).all()
    assert len(set(whole.tolist())) == len(set(words))
