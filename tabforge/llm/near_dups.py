"""Near-duplicate groups by MinHash with tensored tables (operator 1).

Plan, for documents of any number and any group size:

1. One Arrow pass turns every whole text into its set of distinct word shingles and keeps a
   128-bit digest of the set and ``2 * m * r`` minhashes, folded into two collections
   A_1..A_m and B_1..B_m of r minhashes each.
2. Texts with equal sets are one node (``groupBy`` digest, partial aggregation), named after
   its smallest doc_id.
3. Table (i, j) has the key (A_i, B_j): m * m tables of 2r minhashes from 2m collections, so
   minhash work is the square root of what independent tables would take. Two sets of
   similarity s share a table with probability (1 - (1 - s^r)^m)^2: 1 - 7e-5 at s = 0.8 for
   m = 10, r = 2.
4. Stars first: in each bucket of the tables the smallest node is compared with the others, one
   pair per row. Confirmed links make components, which take in most of every group of copies.
5. Then every other pair that shares a table and lies in different components is looked at
   once, by its minhashes: rows with the same A_i meet in blocks of ``block_rows`` (a larger
   group is dealt out as pairs of blocks), and of the pairs with a common B_j those are kept
   whose minhashes agree in ``agree`` places or more (a pair of similarity 0.8 fails this with
   probability 1e-5; texts that share just a passage rarely pass) and whose bitmaps allow the
   similarity: bits of one set that the other lacks bound the intersection from above, so this
   never drops a link. Stars are screened in the same way.
6. Whatever passes 4 or 5 is confirmed on the full sets, rebuilt from the two texts.
7. Components are label propagation with pointer jumping over confirmed links.

Hot buckets: a hub is a partially aggregated minimum, members find it by an equi-join that
adaptive execution can split, and blocks bound what meets in step 5. Only counts are collected.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from tabforge.llm._store import stored
from tabforge.llm._text import NOT_SPACE, U, gram_hashes, mix, runs, span_hashes, word_spans
from tabforge.operators.indexing import global_index

#: Node ids up to which the list of involved nodes (8 bytes each) is broadcast.
BROADCAST_IDS = 2_000_000
#: Rows from which a stored table is merged, whatever its files' size.
MERGE_ROWS = 200_000
BITMAP = 2048


def _beside(df: DataFrame) -> DataFrame:
    """A stored table as one side of a join: Spark sizes it by its compressed files, a
    fraction of what a broadcast of it takes on the driver, so only a small one is left to it."""
    return df.hint("merge") if df.count() > MERGE_ROWS else df


def shingle_sets(buf: np.ndarray, offs: np.ndarray, words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row: ``words`` consecutive words in lower case,
    the whole sequence if a row has fewer, an empty array without words."""
    starts, ends, woff = word_spans(buf, offs, NOT_SPACE)
    h = span_hashes(buf, starts, ends)
    grams = gram_hashes(h, words)
    out = []
    for a, b in zip(woff[:-1], woff[1:]):
        n = b - a
        if n == 0:
            out.append(np.zeros(0, np.uint64))
        elif n < words:
            out.append(gram_hashes(h[a:b], int(n)))
        else:
            s = np.sort(grams[a:b - words + 1])
            out.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
    return out


def _hash_family(n: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * U(0xA0761D6478BD642F))
    return seeds[:n], seeds[n:] | U(1)


def _bitmap(s: np.ndarray) -> bytes:
    """A bit for each shingle, by its low bits."""
    on = np.zeros(BITMAP, np.uint8)
    on[(s & U(BITMAP - 1)).astype(np.int64)] = 1
    return np.packbits(on).tobytes()


def _allowed(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray, num: int, den: int) -> np.ndarray:
    """Whether sets of nx and ny shingles with bitmaps x and y (rows) can be similar enough."""
    nx, ny = nx.astype(np.int64), ny.astype(np.int64)
    most = np.minimum(nx - np.bitwise_count(x & ~y).sum(axis=1, dtype=np.int64), ny - np.bitwise_count(y & ~x).sum(axis=1, dtype=np.int64))
    return den * most >= num * (nx + ny - most)


def _rows(col, dtype: str) -> np.ndarray:
    """A binary column of equal lengths as a matrix."""
    return np.frombuffer(b"".join(col.to_pylist()), dtype).reshape(len(col), -1)


def _sketcher(words: int, m: int, r: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()),
                        ("a", pa.list_(pa.int64())), ("b", pa.list_(pa.int64())), ("sig", pa.binary()), ("bits", pa.binary())])

    def run(batches):
        xor, mul = _hash_family(2 * m * r)
        fold = mix(np.arange(1, r + 1, dtype=np.uint64))
        for batch in batches:
            ids = batch.column("doc_id")
            for lo, hi, buf, offs in runs(batch.column("text")):
                n, d1, d2, sig, short, bits = [], [], [], np.zeros((hi - lo, 2 * m), np.uint64), [], []
                for k, s in enumerate(shingle_sets(buf, offs, words)):
                    n.append(len(s))
                    d1.append(np.add.reduce(mix(s)) if len(s) else U(0))
                    d2.append(np.bitwise_xor.reduce(mix(s + U(0x9E3779B97F4A7C15))) if len(s) else U(0))
                    if len(s):
                        low = np.full(2 * m * r, ~U(0))
                        for p in range(0, len(s), 4096):
                            np.minimum(low, ((s[p:p + 4096, None] ^ xor) * mul).min(axis=0), out=low)
                        sig[k] = np.add.reduce(mix(low.reshape(2 * m, r) + fold), axis=1)
                    short.append((low >> U(8)).astype("<u2").tobytes() if len(s) else b"")
                    bits.append(_bitmap(s))
                flat, off = sig.view(np.int64), pa.array(np.arange(hi - lo + 1, dtype=np.int32) * m)
                lists = [pa.ListArray.from_arrays(off, pa.array(np.ascontiguousarray(x).ravel())) for x in (flat[:, :m], flat[:, m:])]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(np.array(d1, np.uint64).view(np.int64)),
                     pa.array(np.array(d2, np.uint64).view(np.int64)), *lists,
                     pa.array(short, pa.binary()), pa.array(bits, pa.binary())], schema=schema)
    return run, "doc_id long, n long, d1 long, d2 long, a array<long>, b array<long>, sig binary, bits binary"


def _pack(batches):
    """(node, text) -> (node, zstd of the UTF-8 text): what verification shuffles."""
    z = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        text = batch.column("text")
        packed = pa.array([z.compress((t.as_py() or "").encode()) for t in text], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("node"), packed], names=["node", "packed"])


def _verifier(words: int, num: int, den: int):
    def run(batches):
        import collections
        z, kept = zstandard.ZstdDecompressor(), collections.OrderedDict()

        def full_set(node, packed):
            key = (node, packed)
            if key in kept:
                kept.move_to_end(key)
                return kept[key]
            raw = np.frombuffer(z.decompress(packed), np.uint8)
            s = shingle_sets(raw, np.array([0, len(raw)]), words)[0]
            kept[key] = s
            while len(kept) > 1 and sum(len(x) for x in kept.values()) > 1 << 20 or len(kept) > 64:
                kept.popitem(last=False)
            return s

        for batch in batches:
            ok = []
            for hub, node, hp, np_ in zip(*(batch.column(c).to_pylist() for c in ("hub", "node", "hub_packed", "packed"))):
                x, y = full_set(hub, hp), full_set(node, np_)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(den * shared >= num * (len(x) + len(y) - shared))
            keep = batch.select(["hub", "node"]).filter(pa.array(ok, pa.bool_()))
            if len(keep):
                yield keep
    return run


def connected_components(links: DataFrame) -> DataFrame:
    """(node, comp) for the nodes of undirected ``links`` (x, y): comp is the smallest node
    reachable. Each iteration takes the least label of the neighbours, then jumps to the
    label's label, and writes the labels to the shared folder; it ends when none changes."""
    both = links.select(F.col("x").alias("s"), F.col("y").alias("t")).union(links.select("y", "x"))
    near = stored(both.distinct(), "links")
    labels = stored(near.groupBy(F.col("s").alias("node")).agg(F.least(F.first("s"), F.min("t")).alias("comp")), "labels")
    while True:
        names = _beside(labels)
        told = near.join(names, near.t == labels.node).groupBy("s").agg(F.min("comp").alias("told"))
        better = names.join(told, labels.node == told.s, "left").select(
            "node", F.col("comp").alias("old"), F.least("comp", "told").alias("comp"))
        up = names.select(F.col("node").alias("comp"), F.col("comp").alias("up"))
        new = stored(better.join(up, "comp", "left").select(
            "node", "old", F.least(F.col("comp"), F.col("up")).alias("comp")), "labels")
        labels = new.select("node", "comp")
        if new.where("comp != old").isEmpty():
            return labels


def _matching(m: int, r: int, agree: int, num: int, den: int):
    """Rows (g, lo, hi, i, side, whole, node, n, comp, sig, bits) sorted by (g, lo, hi) -> pairs (hub, node)
    of different components, each at the first table that it shares."""
    def pairs_of(t: pa.Table, cell: np.ndarray):
        sig, bits = _rows(t["sig"], "<u2"), _rows(t["bits"], "<u8")
        node, comp, n, i, side, whole = (t[c].to_numpy() for c in ("node", "comp", "n", "i", "side", "whole"))
        end = np.searchsorted(cell, cell, side="right")
        reps = end - np.arange(len(cell)) - 1
        cut = np.concatenate(([0], np.cumsum(reps)))
        for a in range(0, int(cut[-1]), 200_000):
            k = np.arange(a, min(a + 200_000, int(cut[-1])))
            u = np.searchsorted(cut, k, side="right") - 1
            v = u + 1 + k - cut[u]
            ok = (comp[u] != comp[v]) & (np.minimum(n[u], n[v]) * den >= np.maximum(n[u], n[v]) * num) & (whole[u] | (side[u] != side[v]))
            u, v = u[ok], v[ok]
            same = sig[u] == sig[v]
            ok = same.sum(axis=1) >= agree
            u, v, same = u[ok], v[ok], same[ok]
            fold = same.reshape(len(u), 2 * m, r).all(axis=2)
            ok = fold[:, m:].any(axis=1) & (fold[:, :m].argmax(axis=1) == i[u])
            u, v = u[ok], v[ok]
            ok = _allowed(bits[u], bits[v], n[u], n[v], num, den)
            yield np.minimum(node[u[ok]], node[v[ok]]), np.maximum(node[u[ok]], node[v[ok]])

    def emit(t: pa.Table):
        key = np.stack([t[c].to_numpy() for c in ("g", "lo", "hi")], axis=1)
        cell = np.concatenate(([0], np.cumsum((key[1:] != key[:-1]).any(axis=1))))
        for x, y in pairs_of(t, cell):
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=["hub", "node"])

    def run(batches):
        held = None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            held = part if held is None else pa.concat_tables([held, part])
            if held.num_rows < 4096:
                continue
            key = np.stack([held[c].to_numpy() for c in ("g", "lo", "hi")], axis=1)
            last = int(np.flatnonzero((key == key[-1]).all(axis=1))[0])   # the last cell may go on
            if last:
                yield from emit(held.slice(0, last))
                held = held.slice(last)
        if held is not None and held.num_rows:
            yield from emit(held)
    return run


def _similar(agree: int, num: int, den: int):
    """Pairs with their sizes, minhashes and bitmaps -> (hub, node) that can be similar enough."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = batch.column("hub_n").to_numpy(), batch.column("n").to_numpy()
            ok = (_rows(batch.column("hub_sig"), "<u2") == _rows(batch.column("sig"), "<u2")).sum(axis=1) >= agree
            ok &= _allowed(_rows(batch.column("hub_bits"), "<u8"), _rows(batch.column("bits"), "<u8"), a, b, num, den)
            yield batch.select(["hub", "node"]).filter(pa.array(ok))
    return run


def near_dups(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100, m: int = 10, r: int = 2, agree: int = 21,
              block_rows: int = 2048) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text, ...).

    Texts are linked when ``den * intersection >= num * union`` of their shingle sets; a
    component is everything reachable, named by its smallest doc_id; ``kept`` marks the row
    that stays. ``agree`` fits 2 * m * r minhashes and a similarity of 0.8. Other columns of
    ``docs`` are ignored, whatever their names.

    Defined cases: a null or empty text (or one without words) has 0 shingles and no links;
    rows that repeat a doc_id are one document, so their texts count as linked and each row is
    returned; a null doc_id gives a null component and is kept; an empty table gives no rows.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    run, schema = _sketcher(words, m, r)
    sketch = stored(base.mapInArrow(run, schema), "sketch")
    named = sketch.where("n > 0 and doc_id is not null")
    nodes = stored(named.groupBy("n", "d1", "d2")
                   .agg(F.min("doc_id").alias("node"), F.min_by(F.struct("a", "b", "sig", "bits"), "doc_id").alias("s"))
                   .select("node", "n", "d1", "d2", "s.*"), "nodes")
    owner = (sketch.select("doc_id", "n", "d1", "d2").join(_beside(nodes.select("node", "n", "d1", "d2")), ["n", "d1", "d2"], "left")
             .select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.col("node")).alias("node")))
    # a doc_id with several texts ties their sets together
    several = named.groupBy("doc_id").agg(F.min("d1").alias("x"), F.max("d1").alias("y")).where("x != y").select("doc_id")
    own = owner.join(several, "doc_id").where("node is not null").select("doc_id", "node").distinct()
    tied = (own.join(own.groupBy("doc_id").agg(F.min("node").alias("x")), "doc_id").where("x != node")
            .select("x", F.col("node").alias("y")))

    rows = (nodes.select("node", F.posexplode("a").alias("i", "av"), "b").select("node", "i", "av", F.posexplode("b").alias("j", "bv"))
            .select("node", F.xxhash64("i", "j", "av", "bv").alias("key")))
    hubs = (rows.groupBy("key").agg(F.count("*").alias("size"), F.min("node").alias("hub")).where("size > 1").select("key", "hub"))
    # m * m rows a node, which Spark takes for no more bytes than the node's: left to it, either side may be broadcast
    star = stored(rows.join(hubs.hint("merge"), "key").where("node != hub").select("hub", "node").distinct(), "stars")
    sigs = nodes.select("node", "n", "sig", "bits")
    hub_sigs = sigs.select(F.col("node").alias("hub"), F.col("n").alias("hub_n"), F.col("sig").alias("hub_sig"), F.col("bits").alias("hub_bits"))

    def confirmed(pairs: DataFrame) -> DataFrame:
        """The links (x, y) among candidate pairs (hub, node)."""
        ids = stored(pairs.select("node").union(pairs.select("hub")).distinct(), "involved")
        few = ids.count() <= BROADCAST_IDS
        wanted = base.join(F.broadcast(ids) if few else ids, base.doc_id == ids.node)
        texts = stored(wanted.select("node", "text").mapInArrow(_pack, "node long, packed binary").distinct(), "texts")
        hub_texts = texts.select(F.col("node").alias("hub"), F.col("packed").alias("hub_packed"))
        both = _beside(pairs).join(texts, "node").join(hub_texts, "hub").select("hub", "node", "hub_packed", "packed")
        found = both.mapInArrow(_verifier(words, num, den), "hub long, node long")
        return stored(found.select(F.col("hub").alias("x"), F.col("node").alias("y")), "confirmed")

    likely = _beside(star).join(sigs, "node").join(hub_sigs, "hub").mapInArrow(_similar(agree, num, den), "hub long, node long")
    links = confirmed(stored(likely, "likely")).union(tied)
    comps = connected_components(links)

    candidates = star.select("node").union(star.select("hub")).distinct()
    lab = (nodes.select("node", F.col("n").cast("int").alias("n"), "a", "sig", "bits").join(candidates, "node", "left_semi")
           .join(_beside(comps), "node", "left").select("node", "n", "sig", "bits", F.coalesce("comp", "node").alias("comp"), F.posexplode("a").alias("i", "av"))
           .select(F.xxhash64("i", "av").alias("g"), "i", "node", "n", "comp", "sig", "bits"))
    mixed = (lab.select("g", "comp").groupBy("g").agg(F.count("*").alias("size"), F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 != c1")
             .select("g", F.ceil(F.col("size") / block_rows).cast("int").alias("blocks")))
    cells = (lab.join(mixed, "g").withColumn("side", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("g", F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi"), "i", "side",
                     (F.col("side") == F.col("other")).alias("whole"), "node", "n", "comp", "sig", "bits"))
    rest = (cells.repartition("g", "lo", "hi").sortWithinPartitions("g", "lo", "hi")
            .mapInArrow(_matching(m, r, agree, num, den), "hub long, node long"))
    rest = stored(rest, "rest")
    if not rest.isEmpty():
        more = confirmed(rest)
        if not more.isEmpty():
            comps = connected_components(links.union(more))
    return _named(owner, comps)


def _named(owner: DataFrame, comps: DataFrame) -> DataFrame:
    comp = F.coalesce("comp", "node", "doc_id")
    return owner.join(_beside(comps), "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), comp.alias("component_id"),
        F.coalesce(comp == F.col("doc_id"), F.lit(True)).alias("kept"))


def drop_copies(docs: DataFrame, **params) -> DataFrame:
    """The rows of ``docs``, with all their columns, that stay when one row of each near-duplicate
    group stays: the one with the smallest doc_id (nulls last).

    Only texts make a group: rows that repeat a doc_id, or have none, lose copies and nothing else.
    If there are such rows, all rows are numbered in the order of their doc_id first."""
    odd = docs.groupBy(F.col("doc_id").cast("long").alias("doc_id")).count().where("count > 1 or doc_id is null")
    if odd.isEmpty():
        return _without(docs, F.col("doc_id").cast("long"), params)
    row = "row"
    while row in docs.columns:
        row += "_"
    order = {f"{row}{k}": c for k, c in enumerate((F.col("doc_id").isNull(), F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string")), F.rand(11)))}
    numbered = stored(global_index(docs.withColumns(order), list(order), row).drop(*order), "numbered")
    return _without(numbered, F.col(row), params).drop(row)


def _without(docs: DataFrame, key: Column, params: dict) -> DataFrame:
    """``docs`` without the rows that ``near_dups`` drops; ``key`` names a row."""
    found = near_dups(docs.select(key.alias("doc_id"), "text"), **params)
    gone = stored(found.where(~F.col("kept")).select(F.col("doc_id").alias("gone_id")), "gone")
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone   # else the texts would be shuffled
    return docs.join(gone, key == F.col("gone_id"), "left_anti")
