"""Tokenisation, token files, archives and nearest neighbours: exact round trips and brute force."""

import gzip
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")

from tabforge.llm.queries import QUERIES
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.llm.helpers import table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
VOCAB = public_tokenizers.path("word_bpe_49k.json")


def _texts():
    rng = random.Random(3)
    signs = list("aA sS'tTrRveldm0127.,!?\n\t\r 　\u0085éßñ中文😀́‍")
    return table(SF_SMALL, "documents")["text"] + ["".join(rng.choices(signs, k=rng.randint(0, 30))) for _ in range(20_000)] + [
        "", "'", "'s", "a's", " 's", "''s", "  ", "\n", "a  b", "x'll'd", "'re", "a" * 3000, "ab" * 5000, "<|endoftext|>"]


# ---------------------------------------------------------------- byte-level BPE
def test_bpe_equals_the_library():
    import tiktoken
    from tabforge.llm.bpe import read_ranks, shared
    from tabforge.llm._text import runs
    content = open(RANKS, "rb").read()
    enc = shared(content)
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(content), special_tokens={})
    texts = _texts()
    for lo, hi, buf, offs in runs(pa.array(texts, pa.large_string())):
        ids, off = enc.encode(buf, offs)
        for k in range(hi - lo):
            own = ids[off[k]:off[k + 1]]
            assert own.tolist() == lib.encode_ordinary(texts[lo + k]), texts[lo + k]
            assert enc.decode(own.astype(np.int64)).tobytes() == texts[lo + k].encode()


def test_bpe_documents(spark):
    from tabforge.llm.bpe import decode_documents, encode_documents, roundtrip
    texts = [None, "", "naïve café", "naïve café", "x" * 200_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'a' AS ids")
    ids = {r.doc_id: r.ids for r in encode_documents(docs, RANKS).collect()}
    back = {r.doc_id: bytes(r.decoded) for r in decode_documents(encode_documents(docs, RANKS), RANKS).collect()}
    assert back == {i: (t or "").encode() for i, t in enumerate(texts)} and ids[2] == ids[3] and ids[0] == []
    for r in roundtrip(docs, RANKS).collect():
        t = (texts[r.doc_id] or "").encode()
        assert r.n_tokens == len(ids[r.doc_id]) and r.decoded_sha256 == hashlib.sha256(t).hexdigest()
        assert r.ids_sha256 == hashlib.sha256(np.array(ids[r.doc_id], "<u4").tobytes()).hexdigest()
    assert roundtrip(docs.limit(0), RANKS).count() == 0


# ---------------------------------------------------------------- token files
@pytest.mark.parametrize("width", [1, 3, 7, 16, 17, 31])
def test_packing(width):
    from tabforge.llm.token_files import pack, unpack
    ids = np.random.default_rng(0).integers(0, 2 ** width, 1001).astype(np.uint32)
    raw = pack(ids, width)
    assert len(raw) == -(-1001 * width // 8) and (unpack(raw, width, 0, 1001) == ids).all()
    assert (unpack(raw, width, 333, 777) == ids[333:777]).all() and len(unpack(raw, width, 5, 5)) == 0


def test_chunks_encode_like_whole_texts():
    from tokenizers import Tokenizer
    from tabforge.llm.token_files import ChunkEncoder
    from tabforge.llm._text import runs
    spec = open(VOCAB, encoding="utf-8").read()
    enc, lib, texts = ChunkEncoder(spec), Tokenizer.from_str(spec), _texts()
    want = [e.ids + [1] for e in lib.encode_batch(texts, add_special_tokens=False)]
    for lo, hi, buf, offs in runs(pa.array(texts, pa.large_string())):
        ids, off = enc.encode(buf, offs)
        assert [ids[off[k]:off[k + 1]].tolist() for k in range(hi - lo)] == want[lo:hi]


def test_token_files(spark):
    from tokenizers import Tokenizer
    from tabforge.llm.token_files import token_roundtrip
    texts = ["b c", None, "", "A long one " * 500, "b c", "z"]
    ids = [7, 3, 9, 1, 12, -4]
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").selectExpr("*", "1 AS part")
    lib, start, want = Tokenizer.from_file(VOCAB), 0, {}
    for i, t in sorted(zip(ids, texts)):
        e = lib.encode(t or "", add_special_tokens=False).ids + [1]
        want[i] = (start, len(e), zlib.crc32(np.array(e, "<u4").tobytes()))
        start += len(e)
    for block in (1, 50, 65_536):
        got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_roundtrip(docs, VOCAB, block).collect()}
        assert got == want
    twice = token_roundtrip(docs.union(docs).union(docs.selectExpr("CAST(NULL AS LONG)", "text", "part")), VOCAB).collect()
    assert len(twice) == 18 and len({r.start for r in twice}) == 18 and min(r.start for r in twice if r.doc_id is None) == 0
    assert token_roundtrip(docs.limit(0), VOCAB).count() == 0


# ---------------------------------------------------------------- archives
def _brute_archives(pages):
    """[(page_id, html)] -> sorted rows of the contract."""
    leader: dict = {}
    for i, t in pages:
        b = (t or "").encode()
        if i is not None and len(b) >= 1000:
            leader[b] = max(leader.get(b, i), i)
    out = []
    for i, t in pages:
        b = (t or "").encode()
        to = leader.get(b) if i is not None and leader.get(b) != i else None
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


def test_archive_query_over_whole_tables(spark):
    for sf in (SF_SMALL, SF_ORACLE):
        d = table(sf, "pages")
        want = _brute_archives(list(zip(d["page_id"], d["html"])))
        got = QUERIES["op10_warc"](spark, sf).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
        assert sorted(map(tuple, got), key=str) == want


def test_archives_of_a_hot_page(spark, monkeypatch):
    """A page_id, and pages without one, that hold most rows; very long html."""
    from tabforge.llm import warc
    monkeypatch.setattr(warc, "HOT_ROWS", 20)
    rows = [(7, "u", "x" * 1500)] * 60 + [(None, "u", "x" * 1500)] * 40 + [(9, "u", "x" * 1500), (7, "u", "other" * 300), (3, None, "y" * 3_000_000)]
    got = warc.archive_roundtrip(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = sorted(map(tuple, got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)
    assert got == _brute_archives([(i, t) for i, _, t in rows])


def test_records_have_the_mandatory_headers(spark):
    import glob
    import gzip
    from tabforge.llm._store import fresh_dir
    from tabforge.llm.warc import write_archives
    folder = fresh_dir(spark, "warc-heads")
    write_archives(spark.createDataFrame([(1, "http://a/", "z" * 1000), (2, "http://b/", "z" * 1000)], "page_id long, url string, html string").coalesce(1), folder)
    file, = glob.glob(folder.removeprefix("file:") + "/*.warc.gz")
    records = [r for r in gzip.open(file, "rb").read().split(b"WARC/1.1\r\n") if r]
    assert [r.split(b"\r\n")[0] for r in records] == [b"WARC-Type: warcinfo", b"WARC-Type: revisit", b"WARC-Type: response"]
    for r in records:
        head, _, rest = r.partition(b"\r\n\r\n")
        names = dict(line.split(b": ", 1) for line in head.split(b"\r\n"))
        assert {b"WARC-Type", b"WARC-Date", b"WARC-Record-ID", b"Content-Length"} <= set(names)
        assert rest[int(names[b"Content-Length"]):] == b"\r\n\r\n"
    assert b"HTTP/1.1 200 OK\r\n" in records[2] and names[b"Content-Type"] == b"application/http; msgtype=response"


def test_archives(spark):
    from tabforge.llm._store import fresh_dir
    from tabforge.llm.warc import open_store, read_records, write_archives
    big, other = "<p>é</p>\r\n\r\nWARC/1.1\r\n" * 100, "y" * 999
    pages = [(1, "http://a/ b", big), (5, "http://a/2", big), (9, None, big), (2, "u", other), (3, "u", other), (4, "u", None), (6, "u", ""),
             (7, "v", "z" * 1000), (None, "w", big), (9, "again", big)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "'c' AS digest").repartition(3)
    folder = fresh_dir(spark, "warc-test")
    index = write_archives(df, folder)
    got = read_records(index, folder).collect()
    assert len(got) == len(pages)
    for r in got:
        html = dict((p[0], p[2]) for p in pages)[r.page_id] or ""
        assert r.payload_bytes == len(html.encode()) and r.payload_digest == hashlib.sha1(html.encode()).hexdigest()
        revisit = r.page_id in (1, 5)
        assert (r.record_type, r.refers_to) == (("revisit", 9) if revisit else ("response", None))
        assert (r.payload is None) if revisit else bytes(r.payload) == html.encode()
    rows = index.collect()
    store, base = open_store(folder)
    one = next(r for r in rows if r.page_id == 7)
    with store.open_input_file(f"{base}/{one.file}") as f:       # a byte range of the file is the record
        raw = gzip.decompress(f.read_at(one.length, one.offset))
    assert raw.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and raw.endswith(b"z" * 1000 + b"\r\n\r\n")
    some = read_records(index.where("page_id = 7 or page_id = 5"), folder, payload=False).collect()
    assert sorted(r.page_id for r in some) == [5, 7] and {r.url for r in got if r.page_id == 1} == {"http://a/%20b"}
    assert write_archives(df.limit(0), fresh_dir(spark, "warc-test")).count() == 0


def test_ranges_join_neighbours():
    from tabforge.llm.warc import GAP_BYTES, READ_BYTES, _ranges
    rows = [(0, 10), (10, 10), (20 + GAP_BYTES, 5), (30 + 3 * GAP_BYTES, 5), (30 + 3 * GAP_BYTES, READ_BYTES * 2)]
    assert [(a, b, k) for a, b, k in _ranges(rows)] == [(0, 25 + GAP_BYTES, [0, 1, 2]), (30 + 3 * GAP_BYTES, 35 + 3 * GAP_BYTES, [3]),
                                                        (30 + 3 * GAP_BYTES, 30 + 3 * GAP_BYTES + 2 * READ_BYTES, [4])]


# ---------------------------------------------------------------- nearest neighbours
def _truth(ids, x, queries, top):
    out = {}
    for q in queries:
        s = (x * x[ids == q][0]).sum(axis=1)
        s[ids == q] = -np.inf
        out[q] = [(int(ids[k]), float(s[k])) for k in np.lexsort((ids, -s))[:top] if s[k] > -np.inf]
    return out


def test_nearest_is_exact_on_small_tables(spark):
    from pyspark.sql import functions as F
    from tabforge.llm.nearest import nearest
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 5)).astype(np.float32)
    x[10:40] = x[10]                                          # ties go to the smaller id
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(100, None), (120, [0.0] * 5), (140, [1.0, None, 0.0, 0.0, 0.0]), (160, [1.0, float("nan"), 0.0, 0.0, 0.0]), (180, [float("inf")] * 5),
           (200, [1.0, 2.0]), (220, []), (None, [1.0] * 5)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").selectExpr("*", "7 AS key")
    got = {}
    for r in nearest(df, F.col("vec_id") % 20 == 0, top=20).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(got[r.query_id]) == r["rank"]
    want = _truth(np.arange(60), x.astype(np.float64), [0, 20, 40], 20)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    assert all(abs(a[1] - b[1]) < 1e-12 for q in want for a, b in zip(got[q], want[q]))
    few = nearest(df.where("vec_id < 3"), F.col("vec_id") == 0).collect()
    assert sorted(r.vec_id for r in few) == [1, 2]
    assert nearest(df.limit(0), F.lit(True)).count() == 0 and nearest(df.where("vec_id = 100"), F.lit(True)).count() == 0


def test_nearest_recall_by_hashing(spark):
    from pyspark.sql import functions as F
    from tabforge.llm.nearest import nearest
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(10, 16))
    x = (centre[rng.integers(0, 10, 6000)] + rng.normal(size=(6000, 16))).astype(np.float32)
    x[100:1500] = x[100]                                      # a hot bucket
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    rows = nearest(df, F.col("vec_id") % 100 == 0, sample_rows=1000, block_rows=300, lane_probes=10).collect()
    want = _truth(np.arange(6000), x.astype(np.float64), range(0, 6000, 100), 20)
    got = {}
    for r in rows:
        got.setdefault(r.query_id, []).append(r.vec_id)
    hit = sum(len({i for i, _ in want[q]} & set(got.get(q, []))) for q in want)
    assert all(len(v) == len(set(v)) == 20 for v in got.values()) and hit >= 0.9 * 20 * len(want)


def _recall(rows, want):
    got = {}
    for r in rows:
        got.setdefault(r.query_id, set()).add(r.vec_id)
    return sum(len({i for i, _ in want[q]} & got.get(q, set())) for q in want) / sum(map(len, want.values()))


def test_nearest_recall_with_unequal_norms(spark):
    from pyspark.sql import functions as F
    from tabforge.llm.nearest import nearest
    rng = np.random.default_rng(9)
    x = rng.normal(size=(40, 32))[rng.integers(0, 40, 8000)] + 0.5 * rng.normal(size=(8000, 32))
    even = x / np.linalg.norm(x, axis=1, keepdims=True)
    for y in (even, even * rng.lognormal(0, 1, (8000, 1))):
        y[7] *= 1000                                          # one long vector
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(y)], "vec_id long, embedding array<double>")
        rows = nearest(df, F.col("vec_id") % 100 == 0, sample_rows=1000, bucket_rows=300).collect()
        assert _recall(rows, _truth(np.arange(8000), y, range(0, 8000, 100), 20)) >= 0.9


def test_nearest_gives_every_query_its_rows(spark):
    from pyspark.sql import functions as F
    from tabforge.llm.nearest import nearest
    rng = np.random.default_rng(6)
    centre = rng.normal(size=(20, 16))
    x = centre[np.where(np.arange(6000) % 3 == 1, 0, rng.integers(0, 20, 6000))] + 0.01 * rng.normal(size=(6000, 16))   # a third in one place
    x[[0, 300]] = rng.normal(size=(2, 16))                    # two queries in sparse directions
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    rows = nearest(df, F.col("vec_id") % 100 == 0, sample_rows=1000, bucket_rows=30).collect()
    count = {}
    for r in rows:
        count[r.query_id] = count.get(r.query_id, 0) + 1
    assert count == {q: 20 for q in range(0, 6000, 100)}
    same = [(5, [1.0, k / 100]) for k in range(50)] + [(k, [0.5, k / 100]) for k in range(10, 40)]
    rows = nearest(spark.createDataFrame([(0, [1.0, 1.0]), *same], "vec_id long, embedding array<double>"), F.col("vec_id") == 0).collect()
    assert sorted(r.vec_id for r in rows) == [5, *range(21, 40)]   # an id in many rows takes one place


def test_nearest_hashes_the_given_tables(spark):
    from pyspark.sql import functions as F
    from tabforge.llm.nearest import nearest
    from tabforge.llm.queries import QUERIES
    t = table(SF_SMALL, "embeddings")
    ids, x = np.array(t["vec_id"]), np.array(list(t["embedding"]), np.float64)
    want = _truth(ids, x, ids[ids % 20 == 0], 20)
    assert _recall(QUERIES["op4_nearest"](spark, SF_SMALL).collect(), want) >= 0.9
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    assert _recall(nearest(df, F.col("vec_id") % 20 == 0, recall=0.3).collect(), want) < 1   # fewer probes, not all rows


def test_nearest_fit_says_when_it_fails():
    from tabforge.llm.nearest import fit
    x = np.eye(40)
    assert fit(x, np.arange(40), -x, np.arange(100, 140), 40, 1.0, 1.0, 1, 1, 40) is None


def test_norm_ranges():
    from tabforge.llm.nearest import norm_ranges
    assert norm_ranges(np.array([0]), np.array([9])) == [0]
    assert norm_ranges(np.array([0, 40, -1]), np.array([10_000, 1, 10])) == [40, -1]
    lows = norm_ranges(np.arange(-2000, 2000), np.ones(4000, np.int64))
    assert len(lows) == 8 and lows == sorted(lows, reverse=True) and lows[-1] == -2000


def test_probe_sets_are_ordered_and_valid():
    from tabforge.llm.nearest import probe_sets
    sets = probe_sets(4, 81)
    assert sets[0] == () and sets[1] == (0,) and len(set(sets)) == 81
    assert all(len({min(j, 7 - j) for j in s}) == len(s) for s in sets)
