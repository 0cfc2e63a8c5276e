import random

import pytest

from tabforge.llm.near_dups import connected_components, drop_copies, near_dups
from tests.conftest import SF_SMALL
from tests.llm.helpers import components, table


def _result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_query_matches_all_pairs(spark):
    from tabforge.llm.queries import QUERIES
    d = table(SF_SMALL, "documents")
    got = QUERIES["op1_near_dups"](spark, SF_SMALL).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == components(list(zip(d["doc_id"], d["text"])), 2)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


@pytest.mark.parametrize("k", [2, 5])
def test_mutated_copies(spark, k):
    """A large group of near copies, chains of edits, and texts that only share a passage."""
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(400)]
    first = [rng.choice(vocab) for _ in range(60)]
    passage = [rng.choice(vocab) for _ in range(30)]
    docs = []
    for i in range(40):
        w = list(first)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(60)] = rng.choice(vocab)
        docs.append((i, " ".join(w)))
    chain = [rng.choice(vocab) for _ in range(50)]
    for i in range(40, 60):
        chain[(i * 7) % 50] = rng.choice(vocab)
        docs.append((i, " ".join(chain)))
    for i in range(60, 90):
        docs.append((i, " ".join(passage + [rng.choice(vocab) for _ in range(rng.randint(2, 25))])))
    got = _result(near_dups(spark.createDataFrame(docs, "doc_id long, text string"), words=k))
    assert got == components(docs, k)


def test_defined_cases(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "  \t\n", "x"), (4, "one", "x"), (5, "ONE", "x"), (6, "a b c", "x"),
            (6, "a b c", "x"), (None, "a b c", "x"), (8, "z y", "x"), (9, "a b c", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, node string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dups(df, words=2).collect()), key=str)
    assert got == sorted([(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (6, 2, 6, True),
                          (6, 2, 6, True), (None, 2, None, True), (8, 1, 8, True), (9, 2, 6, False)], key=str)
    kept = drop_copies(df, words=2)
    assert kept.columns == df.columns and sorted(str(r.doc_id) for r in kept.collect()) == sorted("1 2 3 4 6 8".split())   # the row without id is a copy
    assert near_dups(df.limit(0)).count() == 0


def test_repeated_id_ties_its_texts(spark):
    df = spark.createDataFrame([(1, "a b c"), (5, "a b c"), (5, "x y z"), (7, "x y z")], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_dups(df, words=2).collect()} == {1: 1, 5: 1, 7: 1}


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101)], "x long, y long")
    got = {r.node: r.comp for r in connected_components(links).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100}


def test_no_exploded_or_large_table_is_broadcast(spark, monkeypatch):
    """Whatever Spark takes their size for: a generous limit stands for tables that it sizes too low."""
    from tabforge.llm import near_dups as module
    plans, store = {}, module.stored

    def stored(df, name):
        plans.setdefault(name, []).append(df._jdf.queryExecution().executedPlan().toString())
        return store(df, name)
    monkeypatch.setattr(module, "stored", stored)
    monkeypatch.setattr(module, "MERGE_ROWS", 0, raising=False)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
    try:
        docs = [(i, f"a b c d e f g h i j k l m n o p{i // 3}") for i in range(12)] + [(20, "q r s")]
        got = _result(near_dups(spark.createDataFrame(docs, "doc_id long, text string"), words=2))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == components(docs, 2)
    assert "BroadcastHashJoin" not in plans["stars"][0]                   # m * m rows of each node
    assert all("BroadcastHashJoin [t#" not in p for p in plans["labels"])     # of the links with the labels
