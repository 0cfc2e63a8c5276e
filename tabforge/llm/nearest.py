"""Approximate nearest neighbours by multiprobe p-stable hashing (operator 4).

Rows are split into ranges of norms, each with its own bound M (the largest norm in it) and its
own hashing, and every query searches all ranges: a few long vectors do not move the others away
from the queries. In a range, largest inner product is turned into smallest Euclidean distance: an
indexed vector x gets, in units of M, the coordinate sqrt(1 - |x|^2), a query of length 1 the
coordinate 0. Each table hashes with
k functions floor((a.x + b) / w), a Gaussian. A query visits its own bucket and then the buckets
one step to either side in some coordinates, in the order in which they are likely to hold near
vectors: the perturbation sets are ranked once by the expected squared distances of a query to
its k nearest and k farther bucket walls, and applied to each query's own order of walls.

What is fitted for each range, on bounded samples of its vectors and of the queries in hash order
(``sample_rows``, ``FIT_QUERIES``), with the bound of the whole range: the width, the number of
functions and the number of probes that find ``recall`` of the queries' nearest in the sample,
with 95 % confidence, with more tables if need be. A range where no hashing reaches that (or with
too few queries to show it) is not hashed: all its rows are ranked. Every candidate
of a visited bucket is ranked by its exact inner product in double precision.

Spark's part: index rows and probes meet on (range, table, bucket, block). A bucket has one block per
``block_rows`` vectors and one lane per ``lane_probes`` probes, so neither a hot bucket nor a hot
query group lands in one task. A task scores a block with one matrix product and keeps each
probe's best; lists are merged per query as a stream. A query for which the probes found fewer
than ``top`` rows of a range that has as many (or not all of a smaller one) then meets every row
of that range, in the same blocks and lanes, so every query gets its full number of rows.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabforge.llm._store import hash_sample, stored

TOP = 20
#: Bins of norms per factor 2, norm ranges at most, queries of a fit at most.
NORM_BINS, NORM_RANGES, FIT_QUERIES = 2, 8, 256


def norm_bin(e):
    """(norm, bin) of an array column, null for vectors that take no part (Spark may ask before
    they are filtered out); powers of 2 lie inside a bin."""
    most = F.nullif(F.array_max(F.transform(e, F.abs)), F.lit(0.0))
    norm = most * F.sqrt(F.aggregate(e, F.lit(0.0), lambda a, x: a + (x / most) * (x / most)))
    return norm, F.floor(F.log2(norm) * NORM_BINS + 0.5).try_cast("int")


def norm_ranges(bins: np.ndarray, rows: np.ndarray, most: int = NORM_RANGES) -> list[int]:
    """Lowest bin of each norm range, longest vectors first: the fewest ranges, ``most`` at most,
    whose rows lie half a bin or less below the top bin of their range on average; each number of
    ranges is cut where that average is smallest."""
    o = np.argsort(-bins)
    b, n = bins[o].astype(np.float64), len(bins)
    c, s = (np.concatenate(([0.0], np.cumsum(v))) for v in (rows[o], rows[o] * b))
    cost, cut = np.full((most + 1, n + 1), np.inf), np.zeros((most + 1, n + 1), np.int64)
    cost[0, 0] = 0
    for g in range(1, most + 1):
        for j in range(1, n + 1):
            v = cost[g - 1, :j] + b[:j] * (c[j] - c[:j]) - (s[j] - s[:j])
            cut[g, j] = np.argmin(v)
            cost[g, j] = v[cut[g, j]]
        if cost[g, n] <= 0.5 * c[n]:
            break
    lows, j = [], n
    for g in range(g, 0, -1):
        lows.append(int(b[j - 1]))
        j = cut[g, j]
    return lows[::-1]


def probe_sets(k: int, most: int) -> list[tuple[int, ...]]:
    """Sets of wall ranks (0 .. 2k-1, nearest first) in order of expected squared distance. Rank j
    and 2k-1-j are the two walls of one coordinate, so no set has both."""
    z = np.array([(j + 1) * (j + 2) / (4 * (k + 1) * (k + 2)) for j in range(k)])
    far = np.array([1 - (2 * k - j) / (k + 1) + (2 * k - j) * (2 * k - j + 1) / (4 * (k + 1) * (k + 2)) for j in range(k, 2 * k)])
    z = np.concatenate((z, far))
    sets = []
    for pick in itertools.product((0, 1, 2), repeat=k):
        s = tuple(j if c == 1 else 2 * k - 1 - j for j, c in enumerate(pick) if c)
        sets.append((float(z[list(s)].sum()) if s else -1.0, s))
    return [s for _, s in sorted(sets)[:most]]


class Hashing:
    """k functions for each of some tables, on vectors of ``dim`` coordinates plus one."""

    def __init__(self, dim: int, tables: int, k: int, width: float, bound: float, probes: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.a = rng.normal(size=(tables, dim + 1, k))
        self.b = rng.uniform(0, width, size=(tables, k))
        self.tables, self.k, self.width, self.bound, self.dim = tables, k, width, bound, dim
        self.probes = probe_sets(k, probes)

    def lift(self, x: np.ndarray, query: bool) -> np.ndarray:
        x = x / (np.abs(x).max(axis=1, keepdims=True) if query else self.bound)
        n = (x * x).sum(axis=1)
        if query:                                           # the length of a query does not matter
            return np.concatenate((x / np.sqrt(n)[:, None], np.zeros((len(x), 1))), axis=1)
        return np.concatenate((x, np.sqrt(np.maximum(1 - n, 0))[:, None]), axis=1)

    def cells(self, x: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
        y = (x @ self.a[t] + self.b[t]) / self.width
        f = np.floor(y)
        return f.astype(np.int64), y - f

    @staticmethod
    def key(cells: np.ndarray) -> np.ndarray:
        out = np.zeros(cells.shape[:-1], np.int64)
        for j in range(cells.shape[-1]):
            out = out * np.int64(1_000_003) + cells[..., j]
        return out

    def walls(self, q: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cells of lifted queries, their coordinates by the distance to the nearer wall, and the
        side of that wall."""
        cells, frac = self.cells(q, t)
        coord = np.argsort(np.minimum(frac, 1 - frac), axis=1, kind="stable")
        f = np.take_along_axis(frac, coord, 1)
        return cells, coord, np.where(f <= 1 - f, -1, 1)

    def first_probe(self, x: np.ndarray, q: np.ndarray, truth: np.ndarray) -> np.ndarray:
        """The probe that first reaches row truth[i, j] of x from query i; 3^k if none does."""
        place = {tuple(sorted(s)): p for p, s in enumerate(self.probes)}
        out = np.full(truth.shape, 3 ** self.k)
        for t in range(self.tables):
            own = self.cells(self.lift(x, False), t)[0]
            cells, coord, side = self.walls(self.lift(q, True), t)
            step = np.take_along_axis(own[truth] - cells[:, None, :], np.broadcast_to(coord[:, None, :], (*truth.shape, self.k)), 2) * side[:, None, :]
            for i, j in np.ndindex(*truth.shape):
                d = step[i, j]
                if (np.abs(d) <= 1).all():
                    s = sorted(r if d[r] > 0 else 2 * self.k - 1 - r for r in np.flatnonzero(d))
                    out[i, j] = min(out[i, j], place.get(tuple(s), 3 ** self.k))
        return out

    def probe_keys(self, q: np.ndarray, t: int) -> np.ndarray:
        """(queries x probes) bucket keys of lifted queries, likely ones first."""
        cells, coord, side = self.walls(q, t)
        out = np.empty((len(q), len(self.probes)), np.int64)
        rows = np.arange(len(q))
        for p, s in enumerate(self.probes):
            c = cells.copy()
            for j in s:
                r, sign = (j, 1) if j < self.k else (2 * self.k - 1 - j, -1)
                c[rows, coord[:, r]] += sign * side[:, r]
            out[:, p] = self.key(c)
        return out


def exact_scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of one query with each row, summed in one fixed order (equal vectors get
    equal scores wherever they stand)."""
    return (c * q[None, :]).sum(axis=1)


def best(scores: np.ndarray, ids: np.ndarray, top: int) -> np.ndarray:
    """Positions of the ``top`` best ids, each at its best score."""
    o = np.lexsort((ids, -scores))
    _, first = np.unique(ids[o], return_index=True)
    return o[np.sort(first)[:top]]


def enough(n: int, recall: float) -> int:
    """Fewest of n pairs that, when found, show ``recall`` with 95 % confidence (Wilson's lower
    bound); n + 1 if n pairs are too few to show it."""
    p, z2 = np.arange(n + 1) / max(n, 1), 1.645 ** 2 / max(n, 1)
    lower = (p + z2 / 2 - np.sqrt(z2 * (p * (1 - p) + z2 / 4))) / (1 + z2)
    return int(np.append(np.flatnonzero(lower >= recall), n + 1)[0])


def fit(sample: np.ndarray, ids: np.ndarray, queries: np.ndarray, names: np.ndarray, rows: int, bound: float, recall: float, tables: int,
        bucket_rows: int, top: int) -> Hashing | None:
    """Hashing for ``rows`` vectors of norm ``bound`` at most from samples of them and of the
    queries. The sample's nearest few stand for the table's ``top`` nearest: with s of n vectors
    sampled, the top * s / n nearest (at least one). Fewer functions come first, then two and four
    times the tables; None if ``recall`` is still not reached, or the pairs are too few to show it
    (some 65 for 0.96)."""
    dim, n = sample.shape[1], len(sample)
    want_k = max(1, min(10, round(math.log(max(2, rows / bucket_rows), 2.6))))
    near = max(1, round(top * n / max(rows, n)))
    s = queries @ sample.T
    s[names[:, None] == ids[None, :]] = -np.inf
    truth = np.argsort(-s, axis=1, kind="stable")[:, :near]
    real = np.take_along_axis(s, truth, 1) > -np.inf
    must = max(1, enough(int(real.sum()), recall))
    if must > real.sum():
        return None
    for copies, k in itertools.product((1, 2, 4), range(want_k, 0, -1)):
        h = Hashing(dim, tables * copies, k, 1.0, bound, 1)
        spread = np.std(h.lift(sample, False) @ h.a[0])
        h = Hashing(dim, tables * copies, k, max(1e-9, 1.5 * spread), bound, 3 ** k)
        need = np.sort(h.first_probe(sample, queries, truth)[real])
        last = int(need[must - 1])
        if last < 3 ** k:
            h.probes = h.probes[:last + 1]
            return h
    return None


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def usable(vectors: DataFrame, dim: int | None = None) -> DataFrame:
    """(vec_id, embedding) of the rows that take part: not null, not zero, all finite."""
    e = F.col("embedding")
    bad = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    ok = e.isNotNull() & (F.size(e) > 0) & ~bad & F.exists(e, lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where(ok & F.col("vec_id").isNotNull())
    return rows if dim is None else rows.where(F.size("embedding") == dim)


def nearest(vectors: DataFrame, is_query, top: int = TOP, recall: float = 0.96, tables: int = 2, sample_rows: int = 4096,
            bucket_rows: int = 2048, block_rows: int = 8192, lane_probes: int = 8192) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``vectors`` (vec_id, embedding) for which
    the condition ``is_query`` holds, the ``top`` largest inner products found among all rows with
    another vec_id, ties to the smaller vec_id.

    Defined cases: vectors that are null, empty, zero, or hold null or non-finite components take
    no part, nor do rows without vec_id or of another length than the most frequent one (the
    longer on a tie); a vec_id that repeats is one candidate, with its best score; the number of
    rows switches nothing (a range without a fit that reaches ``recall`` is ranked whole); with ``top`` candidates or fewer in all, the result is all of them; no
    usable row gives no rows; other columns are ignored."""
    spark = vectors.sparkSession
    out_schema = "query_id long, rank int, vec_id long, score double"
    sizes = usable(vectors).groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], out_schema)
    dim, rows = sizes[0]["d"], sizes[0]["count"]
    base = usable(vectors, dim)
    norm, place = norm_bin(F.col("embedding"))
    bins = base.select(norm.alias("norm"), place.alias("bin")).groupBy("bin").agg(F.count("*").alias("n"), F.max("norm").alias("m")).toPandas()
    lows = norm_ranges(bins["bin"].to_numpy(), bins["n"].to_numpy())
    bins["r"] = sum(((bins["bin"] < low).astype(int) for low in lows[:-1]), 0)
    base = base.withColumn("r", sum(((place < low).cast("int") for low in lows[:-1]), F.lit(0)))
    some = hash_sample(base.where(is_query), ["vec_id"], FIT_QUERIES).select("vec_id", "embedding").toArrow()
    some, names = _matrix(some["embedding"], dim), some["vec_id"].to_numpy()
    models = {}
    for r, of in bins.groupby("r"):
        sample = hash_sample(base.where(F.col("r") == int(r)), ["vec_id"], sample_rows).select("vec_id", "embedding").toArrow()
        models[int(r)] = fit(_matrix(sample["embedding"], dim), sample["vec_id"].to_numpy(), some, names, int(of["n"].sum()), float(of["m"].max()),
                             recall, tables, bucket_rows, top)
    sent = spark.sparkContext.broadcast(models)

    def batch_of(r, t, key, name, ids, vector, embedding):
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(key), r, np.int32)), pa.array(np.full(len(key), t, np.int32)), pa.array(key), ids, embedding],
                                          names=["r", "t", "key", name, vector])

    def index(batches):
        for batch in batches:
            ranges = batch.column("r").to_numpy()
            for r in np.unique(ranges):
                m, part = sent.value[int(r)], batch.filter(pa.array(ranges == r))
                if m is None:
                    continue
                x = _matrix(part.column("embedding"), dim)
                for t in range(m.tables):
                    key = m.key(m.cells(m.lift(x, False), t)[0])
                    yield batch_of(r, t, key, "vec_id", part.column("vec_id"), "embedding", part.column("embedding"))

    def probes(batches):
        for batch in batches:
            x = _matrix(batch.column("embedding"), dim)
            for r, m in sent.value.items():
                if m is None:
                    continue
                for t in range(m.tables):
                    keys = m.probe_keys(m.lift(x, True), t)
                    for p in range(keys.shape[1]):
                        yield batch_of(r, t, keys[:, p].copy(), "query_id", batch.column("vec_id"), "q", batch.column("embedding"))

    cells = base.mapInArrow(index, "r int, t int, key long, vec_id long, embedding array<double>")
    asked = stored(base.where(is_query).mapInArrow(probes, "r int, t int, key long, query_id long, q array<double>"), "probes")

    def score(c: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"query_id": pd.Series([], dtype="int64"), "r": pd.Series([], dtype="int32"),
                             "ids": pd.Series([], dtype=object), "scores": pd.Series([], dtype=object)})
        if not len(c) or not len(q):
            return none
        c = c.sort_values("vec_id", kind="stable")
        x, ids, r_of = np.stack(c["embedding"].to_numpy()), c["vec_id"].to_numpy(), int(c["r"].iloc[0])
        first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
        res = []
        for a in range(0, len(q), 512):
            some = np.stack(q["q"].iloc[a:a + 512].to_numpy())
            names = q["query_id"].iloc[a:a + 512].to_numpy()
            s = some @ x.T
            s[names[:, None] == ids[None, :]] = -np.inf
            n = min(top, len(first))
            floor = -np.partition(-np.maximum.reduceat(s, first, axis=1), n - 1, axis=1)[:, n - 1]
            slack = 1e-9 * (1 + np.abs(floor))
            for r in range(len(some)):
                pick = np.flatnonzero((s[r] >= (floor[r] - slack[r])) & (s[r] > -np.inf))
                if len(pick):
                    v = exact_scores(some[r], x[pick])
                    o = best(v, ids[pick], top)
                    res.append((int(names[r]), r_of, ids[pick][o].tolist(), v[o].tolist()))
        return pd.DataFrame(res, columns=["query_id", "r", "ids", "scores"]) if res else none

    lists_schema = "query_id long, r int, ids array<long>, scores array<double>"

    def meet(cells: DataFrame, asked: DataFrame) -> DataFrame:
        """Lists of the best rows of each block for the queries that ask for its bucket."""
        bucket = ["r", "t", "key"]
        lanes = asked.groupBy(*bucket).agg(F.count("*").alias("asked"))
        blocks = cells.groupBy(*bucket).agg(F.count("*").alias("held"))
        size = stored(blocks.join(lanes, bucket).select(
            *bucket, F.ceil(F.col("held") / block_rows).cast("int").alias("blocks"), F.ceil(F.col("asked") / lane_probes).cast("int").alias("lanes")), "cells")
        left = (cells.join(size, bucket)
                .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
                .withColumn("lane", F.explode(F.sequence(F.lit(0), F.col("lanes") - 1)))
                .select(*bucket, "block", "lane", "vec_id", "embedding"))
        right = (asked.join(size, bucket)
                 .withColumn("lane", F.pmod(F.xxhash64("query_id"), F.col("lanes")).cast("int"))
                 .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                 .select(*bucket, "block", "lane", "query_id", "q"))
        keys = [*bucket, "block", "lane"]
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(score, lists_schema)

    def gather(batches, names):
        now, ids, val = None, np.zeros(0, np.int64), np.zeros(0)
        for batch in batches:
            for q, i, s in zip(zip(*(batch.column(n).to_pylist() for n in names)), batch.column("ids"), batch.column("scores")):
                if q != now:
                    if now is not None:
                        yield now, ids, val
                    now, ids, val = q, np.zeros(0, np.int64), np.zeros(0)
                i, s = np.concatenate((ids, i.values.to_numpy())), np.concatenate((val, s.values.to_numpy()))
                o = best(s, i, top)
                ids, val = i[o], s[o]
        if now is not None:
            yield now, ids, val

    def merge(batches):
        for (q, r), ids, val in gather(batches, ["query_id", "r"]):
            yield pa.RecordBatch.from_arrays([pa.array([q]), pa.array([r], pa.int32()), pa.array([ids]), pa.array([val])], names=["query_id", "r", "ids", "scores"])

    def rank(batches):
        for (q,), ids, val in gather(batches, ["query_id"]):
            n = len(ids)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, q)), pa.array(np.arange(1, n + 1), pa.int32()), pa.array(ids), pa.array(val)],
                                             names=["query_id", "rank", "vec_id", "score"])

    found = stored(meet(cells, asked).repartition("query_id").sortWithinPartitions("query_id", "r").mapInArrow(merge, lists_schema), "lists")
    held = bins.groupby("r")["n"].sum().sort_index()
    want = F.element_at(F.array(*[F.lit(min(top, int(n))) for n in held]), F.col("r") + 1)
    queries = base.where(is_query).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q"))
    pairs = queries.select("query_id").distinct().withColumn("r", F.explode(F.array(*[F.lit(int(r)) for r in held.index])))
    pairs = pairs.join(found.where(F.size("ids") >= want).select("query_id", "r"), ["query_id", "r"], "left_anti")
    whole = [F.lit(-1).alias("t"), F.lit(0).cast("long").alias("key")]
    short = stored(pairs.join(queries, "query_id").select("r", *whole, "query_id", "q"), "short")
    if not short.isEmpty():
        found = found.unionByName(meet(base.select("r", *whole, "vec_id", "embedding"), short))
    return found.repartition("query_id").sortWithinPartitions("query_id").mapInArrow(rank, out_schema)
