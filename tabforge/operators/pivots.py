"""Exact neighbour search in many dimensions: pivots and the triangle inequality.

Donors belong to the nearest of some pivots (means of a bounded sample; the choice moves work, not
results). A cell knows its count and the least and largest distance of its donors to the pivot, so
the distance D of a query to the pivot bounds every distance into the cell:

* from below by ``D - largest``, ``least - D`` and the distance to the plane between the query's own
  pivot and the cell's;
* from above by ``D + largest`` (the bound that farthest neighbours need).

Pass 1 takes a query through its most promising cells until they hold enough donors; the k-th
distance found is the threshold of pass 2, which meets pages of donors in the order of their cells and
looks only into the cells that can still matter (``pages.py``; no row is copied per cell). In pass 1
donors of a cell are ordered by their distance to the pivot, and rows outside ``D +- threshold`` are
skipped; crowded cells are cut on both sides, as in the other strategies."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from tabforge.session import cut_lineage

MOST_PIVOTS = 4096
#: Donors in the sample that pivots are fitted on, per pivot, and at least.
SAMPLE_PER_PIVOT, SAMPLE_LEAST = 16, 4096
_CHUNK = 256
#: Bytes of distances to all pivots that are held at a time.
_HELD_BYTES = 16 << 20


def _distances(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    """(rows, pivots) distances, good to ``_slack``."""
    mu = p.mean(axis=0)
    x, p = x - mu, p - mu
    return np.sqrt(np.maximum((x * x).sum(axis=1)[:, None] + (p * p).sum(axis=1) - 2 * (x @ p.T), 0))


def nearest_pivot(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    """The number of each row's nearest pivot, by blocks of rows."""
    mu = p.mean(axis=0)
    p, rows = p - mu, max(1, _HELD_BYTES // (8 * len(p)))
    size, out = (p * p).sum(axis=1), np.empty(len(x), np.int64)
    for a in range(0, len(x), rows):
        near = (x[a:a + rows] - mu) @ p.T
        near *= -2.0
        near += size                                        # squared distances less the row's own square
        out[a:a + rows] = near.argmin(axis=1)
    return out


def _slack(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    mu = p.mean(axis=0)
    far = np.sqrt(((p - mu) ** 2).sum(axis=1).max()) if len(p) else 0.0
    return 1e-6 * (np.sqrt(((x - mu) ** 2).sum(axis=1)) + far + 1e-12)


def choose_pivots(sample: np.ndarray, n: int, turns: int = 6) -> np.ndarray:
    """Means of the sample, from rows spread over it. Only distinct ones are kept."""
    distinct = np.unique(sample, axis=0)
    pivots = distinct[np.unique(np.linspace(0, len(distinct) - 1, min(n, len(distinct))).astype(int))]
    for _ in range(turns):
        own = nearest_pivot(sample, pivots)
        some = np.unique(own)
        pivots = np.stack([sample[own == k].mean(axis=0) for k in some])
    return np.unique(pivots, axis=0)


def _bounds(x: np.ndarray, pivots: np.ndarray, cells: np.ndarray, lo: np.ndarray, hi: np.ndarray, farthest: bool, more: float) -> np.ndarray:
    """(rows, cells): no donor of the cell is nearer, or with ``farthest`` none is farther."""
    every, slack = _distances(x, pivots), _slack(x, pivots)[:, None]
    d, own = every[:, cells], every.argmin(axis=1)
    if farthest:
        return np.sqrt((d + hi + slack) ** 2 + more)
    gap = _distances(pivots[own], pivots)[:, cells] + slack                # never too small
    plane = (d * d - every[np.arange(len(x)), own][:, None] ** 2) / (2 * gap)
    plane -= slack * (d + every.max(axis=1)[:, None]) / gap                # of the plane, from those of its distances
    return np.maximum.reduce([d - hi - slack, lo - d - slack, np.where(cells == own[:, None], 0.0, plane), np.zeros_like(d)])


class PivotIndex:
    """``donors`` as ``_prepare`` returns them: __id, __g, __x0 ..., __c0 ..."""

    def __init__(self, donors: DataFrame, n_features: int, n_cats: int, metric: str, cat_penalty: float, block_rows: int, farthest: bool):
        self.xcols, self.ccols = [f"__x{i}" for i in range(n_features)], [f"__c{i}" for i in range(n_cats)]
        self.metric, self.penalty, self.block_rows, self.farthest = metric, cat_penalty, block_rows, farthest
        donors = cut_lineage(donors)                        # read several times below
        n = donors.count()
        want = min(MOST_PIVOTS, max(1, math.ceil(4 * n / block_rows)))
        rows, place = max(SAMPLE_LEAST, SAMPLE_PER_PIVOT * want), F.pmod(F.xxhash64("__id"), F.lit(1 << 32))
        some = donors.where(place < int((1 << 32) * min(1.0, 2 * rows / n))) if n > 4 * rows else donors
        sample = some.orderBy(place, "__id").limit(rows).select(*self.xcols).toPandas().to_numpy(dtype="float64")
        self.pivots = choose_pivots(sample, want) if len(sample) else np.zeros((1, n_features))
        pivots = donors.sparkSession.sparkContext.broadcast(self.pivots)

        @F.pandas_udf("cell int, r double")
        def own(*cols: pd.Series) -> pd.DataFrame:
            x, p = np.column_stack([c.to_numpy(dtype="float64") for c in cols]), pivots.value
            cell = nearest_pivot(x, p)
            return pd.DataFrame({"cell": cell.astype("int32"), "r": np.sqrt(((x - p[cell]) ** 2).sum(axis=1))})

        def placed(df: DataFrame) -> DataFrame:
            return df.withColumn("__p", own(*self.xcols)).select("*", F.col("__p.cell").alias("__cell"), F.col("__p.r").alias("__r")).drop("__p")
        self.placed = placed
        self.donors = cut_lineage(placed(donors))
        stats = self.donors.groupBy("__g", "__cell").agg(F.count("*").alias("n"), F.min("__r").alias("lo"), F.max("__r").alias("hi")).toPandas()
        self.cells = {g: (s["__cell"].to_numpy(), s["n"].to_numpy(), s["lo"].to_numpy(), s["hi"].to_numpy())
                      for g, s in stats.sort_values("__cell").groupby("__g", dropna=False)}     # groups x pivots rows

    def visits(self, queries: DataFrame, k: int, exclude_self: bool, rest: bool) -> DataFrame:
        """``queries`` once per cell to search: the first ones, or with ``rest`` all others that the
        threshold ``__t`` leaves. __dp is the distance to the cell's pivot."""
        sent = queries.sparkSession.sparkContext.broadcast((self.pivots, self.cells))
        xcols, farthest, need, more = self.xcols, self.farthest, k + exclude_self, (self.penalty * len(self.ccols) if self.metric == "mixed" else 0.0)

        def run(batches):
            pivots, groups = sent.value
            for batch in batches:
                for a in range(0, len(batch), _CHUNK):
                    some = batch.iloc[a:a + _CHUNK]
                    for g, part in some.groupby("__g", sort=False, dropna=False):
                        if g not in groups:
                            continue
                        cell, n, lo, hi = groups[g]
                        x = part[xcols].to_numpy(dtype="float64")
                        d, bound = _distances(x, pivots)[:, cell], _bounds(x, pivots, cell, lo, hi, farthest, more)
                        order = np.argsort(-bound if farthest else d, axis=1, kind="stable")
                        held = np.cumsum(n[order], axis=1) - n[order]
                        first = np.zeros(d.shape, bool)
                        np.put_along_axis(first, order, held < need, axis=1)
                        go = first
                        if rest:
                            t = part["__t"].to_numpy(dtype="float64")[:, None]
                            go = ~first & (bound >= t * (1 - 1e-9) if farthest else bound <= t * (1 + 1e-9))
                        r, c = np.nonzero(go)
                        if len(r):
                            out = part.iloc[r].copy()
                            out["__cell"], out["__dp"] = cell[c].astype("int32"), d[r, c]
                            yield out
        schema = StructType([*queries.schema.fields, StructField("__cell", IntegerType()), StructField("__dp", DoubleType())])
        return queries.mapInPandas(run, schema)

    def search(self, visits: DataFrame, k: int, exclude_self: bool) -> DataFrame:
        """The k best donors of each visited cell: (query_id, donor_id, distance)."""
        from tabforge.operators.knn import OUT_SCHEMA, _cats, _matrix, _sub_blocks, local_topk
        xcols, ccols, metric, penalty, farthest = self.xcols, self.ccols, self.metric, self.penalty, self.farthest
        pivots = self.pivots
        more = penalty * len(ccols) if metric == "mixed" else 0.0

        def pair(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            out: tuple[list, list, list] = ([], [], [])
            if len(left) and len(right):
                left, right = left.sort_values("__dp", kind="stable"), right.sort_values("__r", kind="stable")
                r, dp, t = (f[c].to_numpy(dtype="float64") for f, c in ((right, "__r"), (left, "__dp"), (left, "__t")))
                ids, x, cats = right["__id"].to_numpy(), _matrix(right, xcols), _cats(right, ccols)
                qx, qc, qid = _matrix(left, xcols), _cats(left, ccols), left["__id"].to_numpy()
                slack = _slack(qx, pivots)
                for a in range(0, len(left), _CHUNK):
                    some = slice(a, a + _CHUNK)
                    if farthest:
                        reach = np.sqrt(np.maximum(np.maximum(t[some], 0) ** 2 * (1 - 1e-9) - more, 0))
                        lo, hi = np.searchsorted(r, (reach - dp[some] - slack[some]).min(), side="left"), len(r)
                    else:
                        lo = np.searchsorted(r, (dp[some] - t[some] * (1 + 1e-9) - slack[some]).min(), side="left")
                        hi = np.searchsorted(r, (dp[some] + t[some] * (1 + 1e-9) + slack[some]).max(), side="right")
                    got = local_topk(qid[some], qx[some], ids[lo:hi], x[lo:hi], k, metric, exclude_self, None if qc is None else qc[some],
                                     None if cats is None else cats[lo:hi], penalty, farthest)
                    for o, v in zip(out, got):
                        o += v
            return pd.DataFrame({n: pd.Series(v, dtype=t) for n, v, t in zip(("query_id", "donor_id", "distance"), out, ("int64", "int64", "float64"))})

        qq, dd = _sub_blocks(cut_lineage(visits), self.donors, ["__g", "__cell"], self.block_rows)   # read twice
        keys = ["__g", "__cell", "__sub"]
        return qq.groupBy(*keys).cogroup(dd.groupBy(*keys)).applyInPandas(pair, OUT_SCHEMA)

    def topk(self, queries: DataFrame, k: int, exclude_self: bool) -> DataFrame:
        """Candidates that hold the k best donors of every query."""
        none = float("-inf") if self.farthest else float("inf")
        open_ = queries.withColumn("__t", F.lit(none))
        first = cut_lineage(self.search(self.visits(open_, k, exclude_self, False), k, exclude_self))
        # the k-th best of pass 1: at most k rows of each first cell
        best = F.sort_array(F.collect_list("distance"), asc=not self.farthest)
        kth = first.groupBy("query_id").agg(F.get(best, F.lit(k - 1)).alias("__t")).select(F.col("query_id").alias("__id"), "__t")
        known = queries.join(kth, "__id", "left").withColumn("__t", F.coalesce("__t", F.lit(none))).select(*open_.columns)
        return self.rest(known, k, exclude_self)

    def rest(self, queries: DataFrame, k: int, exclude_self: bool) -> DataFrame:
        """The k best donors of ``queries`` with thresholds __t: pages of either side in the order of
        cells; a chunk of queries meets the donors of the cells that matter to any of them."""
        from tabforge.operators import pages
        from tabforge.operators.best import QUERIES
        from tabforge.operators.knn import OUT_SCHEMA, BlockState, _row_bytes
        sent = queries.sparkSession.sparkContext.broadcast((self.pivots, self.cells))
        names, cats, metric, penalty, farthest = self.xcols, self.ccols, self.metric, self.penalty, self.farthest
        more = penalty * len(cats) if metric == "mixed" else 0.0

        class State(BlockState):
            def against(self, best, g, rows, ids, x, nominal, t):
                pivots, groups = sent.value
                cells, _, lo, hi = groups[g]
                here = t["__cell"].to_numpy()[rows]
                some = np.unique(here)
                at, place = np.searchsorted(cells, some), np.searchsorted(some, here)
                for a in range(0, len(best.x), QUERIES):
                    turn = np.arange(a, min(a + QUERIES, len(best.x)))
                    bound = _bounds(best.x[turn], pivots, some, lo[at], hi[at], farthest, more)
                    limit = best.bound(turn)[:, None]
                    go = (bound >= -limit * (1 - 1e-9)) if farthest else (bound <= limit * (1 + 1e-9))
                    met = go.any(axis=0)[place]
                    best.meet(turn, ids[met], x[met], None if nominal is None else nominal[met])

        def state(t):
            return State(t, names, cats, k, metric, exclude_self, penalty, farthest, limit=True)
        return pages.meet(self.placed(queries).drop("__r"), self.donors.drop("__r"), _row_bytes(len(names), len(cats)), state, OUT_SCHEMA, ["__cell"])
