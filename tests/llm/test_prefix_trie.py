"""Operator 13 against brute force on plain Python values."""

import collections
import hashlib
import random
import zlib

import pytest

from tabforge.llm.prefix_trie import OUT, prefix_trie
from tabforge.llm.queries import op13_prefix_trie
from tabforge.session import table

from ..conftest import SF_ORACLE, SF_SMALL


def turn_key(r):
    return (r[1] is not None, r[1] or 0)


def brute(rows):
    """rows: (conv_id, turn, role, text), turns of a conversation distinct."""
    own = collections.defaultdict(list)
    for r in sorted((r for r in rows if r[0] is not None), key=turn_key):
        own[r[0]].append((r[2] or "", r[3] or ""))
    conv = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        conv[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    member, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c, t in conv.items():
        for d in range(len(t) + 1):
            member[t[:d]].append(c)
        ends[t].append(c)
    children, leaves, saved = (collections.Counter() for _ in range(3))
    for p in sorted(member, key=len, reverse=True):
        if p:
            saved[p] += (len(member[p]) - 1) * len(p[-1][1].encode())
        leaves[p] += not children[p]
        if p:
            children[p[:-1]] += 1
            leaves[p[:-1]] += leaves[p]
            saved[p[:-1]] += saved[p]
    return sorted((min(m), len(p), min(member[p[:-1]]) if p else -1, len(m), children[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in member.items())


def found(df):
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.select(*OUT).collect())


@pytest.mark.parametrize("sf", [SF_SMALL, SF_ORACLE])
def test_whole_table_equals_brute_force(spark, sf):
    rows = [tuple(r) for r in table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert found(op13_prefix_trie(spark, sf)) == brute(rows)


@pytest.mark.parametrize("segment,rows,turns", [(4096, 2048, 1 << 17), (4096, 2, 5), (4, 3, 4), (3, 1, 3), (1, 1, 1)])
def test_any_segment_and_container_size(spark, segment, rows, turns):
    """Shared prefixes of many depths, copies, conversations that end inside others and at the
    edge of a segment."""
    rng = random.Random(segment * 100 + rows)
    data = []
    for c in range(-7, 60):
        text = rng.choice(["x" * 3, "yy", "z" * 5])
        n = rng.choice([1, 3, 4, 6, 8, 9, 12, 16])
        data += [(c, t, "user", text if t < 10 or c % 3 else f"{c}") for t in range(n)]
    assert found(prefix_trie(spark.createDataFrame(data, "conv_id long, turn long, role string, text string"), segment, rows, turns)) == brute(data)


def test_defined_cases(spark):
    schema = "key string, conv_id long, turn long, role string, text string, n long, w int"
    data = [("k", 1, None, None, "é", 1, 1), ("k", 1, 0, "", "b", 1, 1), ("k", 2, 5, "u", None, 1, 1), ("k", None, 1, "u", "lost", 1, 1),
            ("k", 3, 1, "u", "same", 1, 1), ("k", 3, 1, "u", "same", 1, 1), ("k", 4, 0, "u:", "x", 1, 1), ("k", 14, 0, "u", ":x", 1, 1)]
    rows = [r[1:5] for r in data]
    assert found(prefix_trie(spark.createDataFrame(data, schema))) == brute(rows)
    assert prefix_trie(spark.createDataFrame([], schema)).count() == 0
    assert found(prefix_trie(spark.createDataFrame([r for r in data if r[1] is None], schema))) == []


def test_turnless_and_copied_conversations(spark):
    few = [c for c in range(200) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2][:30]
    data = [(c, t, "u", "hi" * 10) for c in few for t in range(2)] + [(c, t, "u", f"t{t}") for c in range(1000, 1400) for t in range(9)]
    got = found(prefix_trie(spark.createDataFrame(data, "conv_id long, turn long, role string, text string"), 4, 8, 16))
    assert got == brute(data)
    assert max(r[3] for r in got if r[1] == 9) > 50


def test_ties_of_turns_do_not_depend_on_layout(spark):
    data = [(5, 0, "u", f"t{i % 7}") for i in range(40)]
    schema = "conv_id long, turn long, role string, text string"
    a = found(prefix_trie(spark.createDataFrame(data, schema)))
    assert a == found(prefix_trie(spark.createDataFrame(data[::-1], schema).repartition(5), 8, 2, 8)) and len(a) == 41
