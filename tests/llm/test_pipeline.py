import zlib

import numpy as np

from tests.conftest import SF_ORACLE
from tests.llm import helpers
from tests.llm.helpers import table


def test_pipeline_against_brute_force(spark):
    """Every stage on what its predecessor kept: brute force for the sets, the library for the ids."""
    import tiktoken
    import public_tokenizers
    import corpus_pipeline as cp
    from tabforge.llm._store import stored
    from tabforge.llm.bpe import read_ranks
    assert [n for n, _ in cp.STAGES] == ["language", "near_duplicates", "decontaminate", "personal_data", "tokens"]
    d, b = table(SF_ORACLE, "documents"), table(SF_ORACLE, "benchmark")
    extra = [(5000, None, "en", "x", 0), (5001, "12 34 !!", "en", "x", 8), (5002, "", None, "x", 0)]
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    docs = docs.union(spark.createDataFrame(extra, docs.schema))
    kept = {i: t for i, t in zip(d["doc_id"], d["text"])}
    names = docs.columns
    out = {}
    for name, stage in cp.STAGES:
        docs = stored(stage(spark, docs, SF_ORACLE), name)
        out[name] = {r.doc_id: r for r in docs.collect()}
        assert name == "tokens" or docs.columns == names
    assert set(out["language"]) == set(kept)                 # only the texts without a letter go
    comp = helpers.components([(i, t) for i, t in kept.items()], 5)
    kept = {i: t for i, t in kept.items() if comp[i][1] == i}
    assert set(out["near_duplicates"]) == set(kept)
    bad = {r[0] for r in helpers.contamination(kept.items(), list(zip(b["item_id"], b["text"]))) if r[-1]}
    kept = {i: t for i, t in kept.items() if i not in bad}
    assert set(out["decontaminate"]) == set(kept) and bad
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                            mergeable_ranks=read_ranks(open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read()))
    for i, t in kept.items():
        masked = out["personal_data"][i].text
        assert not helpers.base_spans(masked) and (masked == t or helpers.base_spans(t))
        ids = lib.encode_ordinary(masked)
        assert out["tokens"][i].n_tokens == len(ids)
        assert zlib.crc32(np.array(ids, "<u4").tobytes()) >= 0


def test_run_is_registered(spark):
    from __spark_entry__ import queries
    names = list(queries())
    assert "pipeline" in names and len([n for n in names if n.startswith("op")]) == 13


def test_copies_go_and_nothing_else(spark):
    """Repeated and missing doc_ids: only texts make a group, and each group keeps one row."""
    from tabforge.llm.near_dups import drop_copies
    rows = [(1, "a b c", 0), (5, "a b c", 1), (5, "x y z", 2), (7, "x y z", 3), (9, "one text here now", 4),
            (9, "another thing entirely there", 5), (9, "another thing entirely there", 6), (None, "only here without id", 7),
            (None, "only here without id", 8), (None, "a b c", 9), (3, None, 10), (3, "", 11), (None, None, 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int")
    got = drop_copies(docs, words=2)
    assert got.columns == docs.columns
    kept = [tuple(r) for r in got.collect()]
    by_text = {}
    for i, t, _ in rows:
        by_text.setdefault(t or None, []).append(i)
    want = sorted((t, min((i for i in ids if i is not None), default=-1)) for t, ids in by_text.items() if t)
    assert sorted((t, -1 if i is None else i) for i, t, _ in kept if t) == want
    assert sorted(n for _, t, n in kept if not t) == [10, 11, 12]      # without words: linked with nothing
    plain = spark.createDataFrame([r for r in rows if r[0] in (1, 7)] + [(8, "a b c", 3)], docs.schema)
    assert sorted(r.doc_id for r in drop_copies(plain, words=2).collect()) == [1, 7]


def test_a_corpus_without_languages_passes(spark):
    from tabforge.llm.language import drop_unknown, train
    docs = spark.createDataFrame([(1, "A clean English text.", None), (2, "12 34 !!", None), (3, None, None), (4, "жизнь", None)],
                                 "doc_id long, text string, lang string")
    assert sorted(r.doc_id for r in drop_unknown(docs, *train(docs)).collect()) == [1, 4]
