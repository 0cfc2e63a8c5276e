"""Hard negatives by integer inner product over an STR-packed R-tree (operator 11).

* **Packing.** Rows are dealt to shards by sort-tile-recursive slabs: first by label, then by the
  coordinates of largest variance, cut at quantiles of a bounded sample (cuts only place rows;
  results are exact for any cuts). A shard that got too many rows (equal vectors) is split by a
  hash of vec_id. Inside a shard rows are tiled again into leaf pages of ``LEAF_ROWS``. Pages are
  written as a table: the vectors move once.
* **Boxes.** A page and a shard carry the smallest and largest value of every coordinate and of
  the label. Against a query each coordinate gives an interval of products; their sums bound the
  inner product of every row inside.
* **Search.** Queries visit pages best bound first, in rounds of 1, 2, 4, ... pages, and skip those
  outside the score window or strictly below the kth best so far. Shards are visited the same way
  in two jobs: first the most promising shard of each query, then all whose bounds still reach its
  kth best.

Positives are searched among rows of the anchor's label, then every (anchor, positive) is a query
with the window that its score gives, among rows of other labels.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tabforge.llm._store import hash_sample, salted_join, stored

LEAF_ROWS = 256
SHARD_ROWS = 1 << 18
#: Anchors that meet a shard in one task.
LANE_ROWS = 1 << 17
SAMPLE_ROWS = 1 << 15
#: Shards placed by the sample; larger tables are split further by a hash.
MOST_TILES = 4096
#: Bytes of shard boxes that are broadcast at once.
BOX_BYTES = 64 << 20
#: Queries that meet the pages of a shard at a time.
CHUNK = 512
_LOW, _HIGH = -(1 << 62), 1 << 62


def dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of the rows of a and b. Sums stay below the largest product of
    norms, so floats are exact up to their mantissa; beyond it 64-bit integers are."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    x, y = a.astype(np.float64), b.astype(np.float64)
    top = 1.001 * math.sqrt((x * x).sum(axis=1).max()) * math.sqrt((y * y).sum(axis=1).max())
    if top < 1 << 24:
        return (x.astype(np.float32) @ y.astype(np.float32).T).astype(np.int64)
    return (x @ y.T).astype(np.int64) if top < 1 << 53 else a.astype(np.int64) @ b.astype(np.int64).T


def bounds(q: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, largest) inner product of each query with any point of each box."""
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    both = np.concatenate((up, down), axis=1)
    return dot(both, np.concatenate((lo, hi), axis=1)), dot(both, np.concatenate((hi, lo), axis=1))


# ---- packing

def slab_tree(labels: np.ndarray, x: np.ndarray, tiles: int) -> dict:
    """Nested cuts that deal rows into about ``tiles`` tiles: slabs of labels, then STR slabs."""
    names, n = np.unique(labels, return_counts=True)
    if tiles <= 1 or not len(names):
        return {}
    share, cuts, groups, held = n * tiles / n.sum(), [], [], 0.0
    for name, s in zip(names, share):
        if groups and held + s <= 1:                        # small labels share a slab
            held += s
            groups[-1] = (groups[-1][0], name, held)
        else:
            if groups:
                cuts.append(name)
            held = s
            groups.append((name, name, s))
    kids = []
    for a, b, s in groups:
        some = x[(labels >= a) & (labels <= b)]
        order = np.argsort(-some.var(axis=0), kind="stable")
        kids.append(_slabs(some, max(1, round(s)), order[:3].tolist()))
    return {"col": -1, "cuts": np.array(cuts, np.int64), "kids": kids}


def _slabs(x: np.ndarray, tiles: int, cols: list[int]) -> dict:
    if tiles <= 1 or not cols or len(x) < 2:
        return {}
    n = tiles if len(cols) == 1 else math.ceil(tiles ** (1 / len(cols)))
    v = np.sort(x[:, cols[0]])
    cuts = np.unique(v[[len(v) * k // n for k in range(1, n)]])
    slab = np.searchsorted(cuts, x[:, cols[0]], side="right")
    return {"col": cols[0], "cuts": cuts, "kids": [_slabs(x[slab == k], math.ceil(tiles / n), cols[1:]) for k in range(len(cuts) + 1)]}


def place(tree: dict, labels: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Tile of each row: the path through the slabs, as a number."""
    out, at = np.zeros(len(x), np.int64), 0

    def walk(node: dict, rows: np.ndarray) -> None:
        nonlocal at
        if not node:
            out[rows] = at
            at += 1
            return
        v = labels[rows] if node["col"] < 0 else x[rows, node["col"]]
        k = np.searchsorted(node["cuts"], v, side="right")
        for i, kid in enumerate(node["kids"]):
            walk(kid, rows[k == i])
    walk(tree, np.arange(len(x)))
    return out


def leaves(labels: np.ndarray, x: np.ndarray, rows: int) -> list[np.ndarray]:
    """Rows of a shard in pages of at most ``rows``: STR over label and four coordinates."""
    cols = [labels] + [x[:, c] for c in np.argsort(-x.astype(np.float64).var(axis=0), kind="stable")[:4]]
    cols = cols if (labels != labels[0]).any() else cols[1:]

    def tile(some: np.ndarray, d: int) -> list[np.ndarray]:
        pages = math.ceil(len(some) / rows)
        if pages <= 1:
            return [some]
        some = some[np.argsort(cols[d][some], kind="stable")]
        if d + 1 == len(cols):
            return [some[a:a + rows] for a in range(0, len(some), rows)]
        per = math.ceil(pages / math.ceil(pages ** (1 / (len(cols) - d)))) * rows
        return [p for a in range(0, len(some), per) for p in tile(some[a:a + per], d + 1)]
    return tile(np.arange(len(x)), 0)


@dataclass
class Shape:
    dim: int
    kind: str                                               # little-endian integers of a vector

    def vectors(self, col) -> np.ndarray:
        col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
        return np.frombuffer(b"".join(col.to_pylist()), self.kind).reshape(-1, self.dim)

    def pack(self, x: np.ndarray) -> pa.Array:
        return pa.array([r.tobytes() for r in np.ascontiguousarray(x, self.kind)], pa.binary())


def _flat(parts, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(parts), kind)


_PAGE = ("shard int, leaf int, label_lo long, label_hi long, lo binary, hi binary, ids binary, labels binary, vecs binary, "
         "box_label_lo long, box_label_hi long, box_lo binary, box_hi binary")
_PAGE_NAMES = [c.split()[0] for c in _PAGE.split(", ")]


def usable(vectors: DataFrame) -> tuple[DataFrame, int, int, int] | None:
    """((vec_id, label, c: array of integers), dimension, rows, largest absolute value); None if no
    row takes part."""
    e = F.col("embedding").cast("array<double>")
    bad = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.where(e.isNotNull() & (F.size(e) > 0) & ~bad & F.col("vec_id").isNotNull() & F.col("label").isNotNull())
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), e.alias("e"))
    top = rows.groupBy(F.size("e").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if top is None:
        return None
    dim = top["d"]
    most = 1 << (59 - max(0, (dim - 1).bit_length())) // 2  # products of such vectors fit a long
    rows = rows.where((F.size("e") == dim) & F.forall("e", lambda x: F.abs(x) < most / 256 - 1))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select("vec_id", label.alias("label"), F.transform("e", lambda x: F.floor(x * 256).cast("long")).alias("c"))
    again = stored(rows.groupBy("vec_id").count().where("count > 1").select("vec_id"), "again")
    if not again.isEmpty():                                 # one row per vec_id
        some = salted_join(rows, again, "vec_id", F.monotonically_increasing_id(), "left_semi").groupBy("vec_id").agg(F.min(F.struct("label", "c")).alias("r"))
        rows = salted_join(rows, again, "vec_id", F.monotonically_increasing_id(), "left_anti").unionByName(some.select("vec_id", "r.label", "r.c"))
    size = rows.agg(F.count("*"), F.max(F.greatest(F.array_max("c"), -F.array_min("c")))).first()
    return (rows, dim, size[0], size[1]) if size[0] else None


def pack(rows: DataFrame, shape: Shape, n: int, shard_rows: int, leaf_rows: int) -> tuple[DataFrame, DataFrame]:
    """(dealt rows (shard, vec_id, label, vec), leaf pages)."""
    spark = rows.sparkSession
    tiles = min(MOST_TILES, math.ceil(n / shard_rows))
    tree: dict = {}
    if tiles > 1:
        some = hash_sample(rows, ["vec_id"], SAMPLE_ROWS).toArrow()
        tree = slab_tree(some["label"].to_numpy(), some["c"].combine_chunks().flatten().to_numpy().reshape(-1, shape.dim), tiles)
    sent = spark.sparkContext.broadcast(tree)

    def deal(batches):
        for batch in batches:
            x = batch.column("c").flatten().to_numpy().reshape(-1, shape.dim)
            tile = place(sent.value, batch.column("label").to_numpy(), x)
            yield pa.RecordBatch.from_arrays([pa.array(tile, pa.int32()), batch.column("vec_id"), batch.column("label"), shape.pack(x)],
                                             names=["tile", "vec_id", "label", "vec"])

    dealt = stored(rows.mapInArrow(deal, "tile int, vec_id long, label long, vec binary"), "dealt")
    held = sorted((r["tile"], r["count"]) for r in dealt.groupBy("tile").count().collect())      # MOST_TILES rows or so
    parts, at = [], 0
    for tile, count in held:
        cut = math.ceil(count / (2 * shard_rows))
        parts.append((tile, at, cut))
        at += cut
    cuts = spark.createDataFrame(parts, "tile int, first int, cut int")
    dealt = dealt.join(F.broadcast(cuts), "tile").select(
        (F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("cut"))).cast("int").alias("shard"), "vec_id", "label", "vec")

    def page(t: pa.Table) -> pa.Table:
        ids, labels, x = t["vec_id"].to_numpy(), t["label"].to_numpy(), shape.vectors(t["vec"])
        out = []
        for k, some in enumerate(leaves(labels, x, leaf_rows)):
            some = some[np.argsort(ids[some], kind="stable")]
            y = x[some]
            out.append((t["shard"][0].as_py(), k, int(labels[some].min()), int(labels[some].max()), y.min(axis=0).tobytes(), y.max(axis=0).tobytes(),
                        ids[some].astype("<i8").tobytes(), labels[some].astype("<i8").tobytes(), y.tobytes(),
                        int(labels.min()), int(labels.max()), *((x.min(axis=0).tobytes(), x.max(axis=0).tobytes()) if k == 0 else (None, None))))
        return pa.table(dict(zip(_PAGE_NAMES, (pa.array(c, pa.binary() if isinstance(c[0], bytes) else pa.int32() if i < 2 else pa.int64())
                                               for i, c in enumerate(zip(*out))))))

    return dealt, stored(dealt.groupBy("shard").applyInArrow(page, _PAGE), "pages")


# ---- search

class Best:
    """The ``top`` best (score, id) of each query so far, ties to the smaller id."""

    def __init__(self, n: int, top: int):
        self.scores, self.ids = np.full((n, top), _LOW, np.int64), np.full((n, top), _HIGH, np.int64)

    def add(self, q: np.ndarray, s: np.ndarray, i: np.ndarray) -> None:
        if not len(q):
            return
        some, of = np.unique(q, return_inverse=True)
        top = self.scores.shape[1]
        of = np.concatenate((of, np.repeat(np.arange(len(some)), top)))
        s, i = np.concatenate((s, self.scores[some].ravel())), np.concatenate((i, self.ids[some].ravel()))
        o = np.lexsort((i, -s, of))
        rank = np.arange(len(o)) - np.searchsorted(of[o], of[o])
        o, rank = o[rank < top], rank[rank < top]
        self.scores[some[of[o]], rank], self.ids[some[of[o]], rank] = s[o], i[o]


@dataclass
class Pages:
    """The leaf pages of a shard."""
    lo: np.ndarray
    hi: np.ndarray
    label_lo: np.ndarray
    label_hi: np.ndarray
    ids: list[np.ndarray]
    labels: list[np.ndarray]
    x: list[np.ndarray]


def search(pages: Pages, x: np.ndarray, own: np.ndarray, label: np.ndarray, of: np.ndarray, low: np.ndarray, high: np.ndarray,
           floor: np.ndarray, same: bool, top: int) -> Best:
    """Query j is the vector ``x[of[j]]``: its best rows with a score from low[j] to high[j], of the
    anchor's label (``same``) or of others, never the anchor itself. Scores strictly below
    ``floor`` are not wanted."""
    best = Best(len(of), top)
    least, most = bounds(x, pages.lo, pages.hi)
    fits = (pages.label_lo <= label[:, None]) & (label[:, None] <= pages.label_hi)
    fits = fits if same else ~(fits & (pages.label_lo == pages.label_hi))
    ok = fits[of] & (most[of] >= low[:, None]) & (least[of] <= high[:, None])
    reach = np.where(ok, np.minimum(most[of], high[:, None]), _LOW)
    order = np.argsort(-reach, axis=1, kind="stable")
    a, step = 0, 1
    while a < order.shape[1]:
        cols = order[:, a:a + step]
        kth, kth_id = np.maximum(best.scores[:, -1], floor), best.ids[:, -1]
        need = np.take_along_axis(reach, cols, 1)
        need = (need > _LOW) & (need >= kth[:, None])
        if not need.any():
            break
        q, c = np.nonzero(need)
        page = cols[q, c]
        o = np.argsort(page, kind="stable")
        q, page = q[o], page[o]
        edge = np.flatnonzero(np.append(True, page[1:] != page[:-1]))
        hits = []
        for f, t in zip(edge, np.append(edge[1:], len(page))):
            p, some = page[f], q[f:t]
            who, back = np.unique(of[some], return_inverse=True)
            s = dot(x[who], pages.x[p])[back]
            ids, equal = pages.ids[p], pages.labels[p][None, :] == label[of[some]][:, None]
            good = (s >= np.maximum(low, kth)[some][:, None]) & (s <= high[some][:, None]) & (equal if same else ~equal)
            good &= (ids != own[of[some]][:, None]) & ((s > best.scores[some, -1][:, None]) | (ids < kth_id[some][:, None]))
            r, k = np.nonzero(good)
            hits.append((some[r], s[r, k], ids[k]))
        best.add(*(np.concatenate(h) for h in zip(*hits)))
        a, step = a + step, min(16, 2 * step)
    return best


_QUERY = "anchor_id long, label long, vec binary, home int, of_id array<long>, of_score array<long>, floor array<long>"
_FOUND = "anchor_id long, of_id long, of_score long, vec_id long, score long"


@dataclass
class Windows:
    """How rows of ``_QUERY`` are read in tasks."""
    shape: Shape
    same: bool
    low: int
    high: int

    def scores(self, of_score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest wanted score of each query."""
        if self.same:
            return np.full(len(of_score), _LOW + 1), np.full(len(of_score), _HIGH)
        return -((-self.low * of_score) // 100), (self.high * of_score) // 100

    def read(self, t) -> tuple:
        """Vectors, anchor ids, labels, and per query the row of its vector, of_id, of_score, floor."""
        of, score, floor = (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (t.column(n) for n in ("of_id", "of_score", "floor")))
        n = of.value_lengths().to_numpy()
        return (self.shape.vectors(t.column("vec")), t.column("anchor_id").to_numpy(), t.column("label").to_numpy(),
                np.repeat(np.arange(len(n)), n), *(c.flatten().to_numpy() for c in (of, score, floor)))


class Miner:
    """Searches of one packed table: of the anchor's own label without a window (``same``), or of
    other labels within low/100 to high/100 of each of_score."""

    def __init__(self, pages: DataFrame, shape: Shape, lanes: int, low: int, high: int):
        self.pages, self.shape, self.lanes, self.low, self.high = pages, shape, lanes, low, high
        box = pages.where("leaf = 0").select("shard", "box_label_lo", "box_label_hi", "box_lo", "box_hi")
        per = max(1, BOX_BYTES // (2 * shape.dim * np.dtype(shape.kind).itemsize + 64))
        shards = pages.agg(F.max("shard")).first()[0] + 1
        self.boxes = [box.where(F.col("shard").between(a, a + per - 1)) for a in range(0, shards, per)]

    def visits(self, queries: DataFrame, same: bool, first: bool) -> DataFrame:
        """Queries by shard: with ``first`` the home shard of a same-label search and else the most
        promising of the first slice of boxes; otherwise all other shards that bounds and floors
        leave."""
        windows, kind, dim = Windows(self.shape, same, self.low, self.high), self.shape.kind, self.shape.dim
        parts = []
        for k, box in enumerate(self.boxes):
            if first and not same and k:
                break
            rows = box.toPandas()                           # at most BOX_BYTES
            sent = self.pages.sparkSession.sparkContext.broadcast((
                rows["shard"].to_numpy(), rows["box_label_lo"].to_numpy(), rows["box_label_hi"].to_numpy(),
                *(_flat(rows[c], kind).reshape(-1, dim) for c in ("box_lo", "box_hi"))))

            def run(batches, sent=sent, k=k):
                shard, label_lo, label_hi, lo, hi = sent.value
                for whole in batches:
                    for a in range(0, whole.num_rows, CHUNK):
                        batch = whole.slice(a, CHUNK)
                        x, _, label, of, _, score, floor = windows.read(batch)
                        low, high = windows.scores(score)
                        least, most = bounds(x, lo, hi)
                        fits = (label_lo <= label[:, None]) & (label[:, None] <= label_hi)
                        fits = fits if same else ~(fits & (label_lo == label_hi))
                        ok = fits[of] & (most[of] >= low[:, None]) & (least[of] <= high[:, None])
                        start = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
                        if same:
                            early = shard == batch.column("home").to_numpy()[:, None]
                        else:
                            reach = np.maximum.reduceat(np.where(ok, np.minimum(most[of], high[:, None]), _LOW), start, axis=0)
                            early = (np.arange(len(shard)) == reach.argmax(axis=1)[:, None]) & (k == 0)
                        open_ = np.logical_or.reduceat(ok & (most[of] >= floor[:, None]), start, axis=0)
                        r, c = np.nonzero(open_ & (early == first))
                        if len(r):
                            got = batch.take(pa.array(r))
                            yield pa.RecordBatch.from_arrays([pa.array(shard[c], pa.int32()), *got.columns], names=["shard", *got.schema.names])

            parts.append(queries.mapInArrow(run, f"shard int, {_QUERY}"))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def meet(self, visits: DataFrame, same: bool, top: int) -> DataFrame:
        """The best rows of each visited shard: (anchor_id, of_id, of_score, vec_id, score)."""
        windows, kind, dim = Windows(self.shape, same, self.low, self.high), self.shape.kind, self.shape.dim

        def one(pages: pa.Table, asked: pa.Table) -> pa.Table:
            cols: list[list] = [[] for _ in range(5)]
            if pages.num_rows and asked.num_rows:
                lists = {c: pages[c].to_pylist() for c in ("lo", "hi", "ids", "labels", "vecs")}
                p = Pages(*(_flat(lists[c], kind).reshape(-1, dim) for c in ("lo", "hi")),
                          *(pages[c].to_numpy() for c in ("label_lo", "label_hi")),
                          *([np.frombuffer(b, "<i8") for b in lists[c]] for c in ("ids", "labels")),
                          [np.frombuffer(b, kind).reshape(-1, dim) for b in lists["vecs"]])
                for a in range(0, asked.num_rows, CHUNK):
                    x, own, label, of, of_id, score, floor = windows.read(asked.slice(a, CHUNK))
                    b = search(p, x, own, label, of, *windows.scores(score), floor, same, top)
                    q, k = np.nonzero(b.scores > _LOW)
                    for out, v in zip(cols, (own[of[q]], of_id[q], score[q], b.ids[q, k], b.scores[q, k])):
                        out.append(v)
            return pa.table({n.split()[0]: pa.array(np.concatenate(c) if c else np.zeros(0, np.int64)) for n, c in zip(_FOUND.split(", "), cols)})

        lanes = F.explode(F.sequence(F.lit(0), F.lit(self.lanes - 1)))
        left = self.pages.drop("box_label_lo", "box_label_hi", "box_lo", "box_hi").withColumn("lane", lanes)
        right = visits.withColumn("lane", F.pmod(F.xxhash64("anchor_id"), F.lit(self.lanes)).cast("int"))
        return left.groupBy("shard", "lane").cogroup(right.groupBy("shard", "lane")).applyInArrow(one, _FOUND)

    def best(self, found: DataFrame, top: int) -> DataFrame:
        """Rank of the ``top`` best of each (anchor, of). Rows per query: top x visited shards, cut
        to ``top`` before the shuffle."""
        w = Window.partitionBy("anchor_id", "of_id").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)

    def run(self, queries: DataFrame, same: bool, top: int) -> DataFrame:
        """queries (anchor_id, label, vec, home, of_id, of_score) -> their ranked best rows."""
        queries = queries.withColumn("floor", F.transform("of_id", lambda _: F.lit(_LOW)))
        names = [c.split()[0] for c in _QUERY.split(", ")]
        queries = stored(queries.select(*names), "queries")
        near = stored(self.meet(self.visits(queries, same, True), same, top), "near")
        kth = self.best(near, top).where(F.col("rank") == top).select("anchor_id", "of_id", F.col("score").alias("kth"))
        kth = kth.groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("of_id", "kth"))).alias("kths"))   # positives of an anchor
        floor = F.transform("of_id", lambda i: F.coalesce(F.element_at("kths", i), F.lit(_LOW)))
        rest = queries.join(kth, "anchor_id", "left").withColumn("floor", F.when(F.col("kths").isNull(), F.col("floor")).otherwise(floor)).select(*names)
        return self.best(near.unionByName(self.meet(self.visits(rest, same, False), same, top)), top)


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
                   shard_rows: int | None = None, leaf_rows: int = LEAF_ROWS, lane_rows: int = LANE_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows of
    ``vectors`` (vec_id, embedding, label) where ``is_anchor`` (over vec_id) holds: for each of the
    anchor's ``positives`` best rows of its label, the ``negatives`` best rows of other labels with
    low * positive_score <= 100 * negative_score <= high * positive_score. Exact.

    Defined cases: rows with a null vec_id, label or vector, an empty vector or a null or
    non-finite component take no part, nor do vectors of another length than the most frequent one
    (the longer on a tie) or with a component so large that scores could leave a long (from 2^18
    for 64 coordinates); of the rows of one vec_id that are left, the one with the smallest
    (label, vector) counts; an anchor without positives, or a positive without negatives, gives no
    rows, as does an empty table; other columns are ignored."""
    spark = vectors.sparkSession
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    found = usable(vectors)
    if found is None:
        return spark.createDataFrame([], out)
    rows, dim, n, most = found
    shape = Shape(dim, next(k for k, top in (("<i2", 1 << 15), ("<i4", 1 << 31), ("<i8", 1 << 63)) if most < top))
    wide = spark.sparkContext.defaultParallelism
    dealt, pages = pack(rows, shape, n, shard_rows or min(SHARD_ROWS, max(8 * leaf_rows, n // (4 * wide))), leaf_rows)
    anchors = stored(dealt.where(is_anchor).select(F.col("vec_id").alias("anchor_id"), "label", "vec", F.col("shard").alias("home")), "anchors")
    miner = Miner(pages, shape, max(1, math.ceil(anchors.count() / lane_rows)), low, high)
    none = F.array(F.lit(0).cast("long"))
    mates = stored(miner.run(anchors.withColumns({"of_id": none, "of_score": none}), True, positives), "positives")
    lists = mates.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("p"))   # at most `positives`
    asked = anchors.join(lists, "anchor_id").withColumns({
        "of_id": F.transform("p", lambda r: r["vec_id"]), "of_score": F.transform("p", lambda r: r["score"])})
    return miner.run(asked, False, negatives).select(
        "anchor_id", F.col("of_id").alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        F.col("of_score").alias("positive_score"), F.col("score").alias("negative_score"))
