"""Exact donors for kNN imputation in many dimensions: cells of one presence pattern and one region
(I-02).

The nan-euclidean distance looks only at coordinates that both rows have, scaled by p / shared. A
donor cell is a common presence pattern (rarer ones share a class) times the region of a pivot. It
knows which coordinates all and which any of its donors have, the least and largest value of each,
and how many donors have each column. For a query this gives

* the columns that the cell can fill at all;
* a lower bound of every distance into it: the smallest mean of squared gaps to the box that any
  possible set of shared coordinates allows.

Pages of queries meet pages of donors, both in the order of cells (``pages.py``; no row is copied per
cell). A chunk of queries first takes the nearest cells of the page until they hold enough donors for
each missing column; the k-th distance per column found so far then leaves only the cells that can
still better some column."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tabforge.operators.best import presence
from tabforge.operators.pivots import SAMPLE_LEAST, SAMPLE_PER_PIVOT, _distances, choose_pivots
from tabforge.session import cut_lineage

MOST_PIVOTS = 256
#: Presence patterns with cells of their own.
MOST_PATTERNS = 64
_CHUNK = 64
_STATS = "cell int, n array<long>, lo array<double>, hi array<double>, rows long"


def lower_bounds(q: np.ndarray, always: np.ndarray, ever: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """(queries, cells): no donor of the cell is nearer; inf where no coordinate can be shared."""
    p, have = q.shape[1], ~np.isnan(q)
    x = q[:, None, :]
    gap = np.fmax(np.fmax(np.where(always, lo, -np.inf)[None] - x, x - np.where(always, hi, np.inf)[None]), 0.0)
    n, s = have.astype("float64") @ always.T.astype("float64"), np.einsum("qcp,qcp->qc", gap, gap)
    best = np.where(n > 0, s / np.maximum(n, 1), np.inf)
    some = np.flatnonzero((ever & ~always).any(axis=1))
    if len(some):                                            # the smallest optional gaps, as long as they lower the mean
        maybe = have[:, None, :] & (ever & ~always)[some][None]
        with np.errstate(invalid="ignore"):
            gap = np.where(maybe, np.maximum(np.maximum(lo[some][None] - x, x - hi[some][None]), 0.0) ** 2, np.inf)
        rows, cells = np.nonzero(maybe.any(axis=2))
        more = np.sort(gap[rows, cells], axis=1)
        cells = some[cells]
        mean = (s[rows, cells][:, None] + np.cumsum(more, axis=1)) / (n[rows, cells][:, None] + np.arange(1, p + 1))
        best[rows, cells] = np.minimum(best[rows, cells], mean.min(axis=1))
    return np.sqrt(best * p) * (1 - 1e-9)


class PatternIndex:
    """``donors`` as ``_prepare`` returns them: __id, __x0 ..."""

    def __init__(self, donors: DataFrame, n_features: int, block_rows: int):
        self.xcols = xcols = [f"__x{i}" for i in range(n_features)]
        self.block_rows = block_rows
        donors = cut_lineage(donors)                        # read several times below
        spark, n = donors.sparkSession, donors.count()
        bits = F.concat(*[F.when(F.col(c).isNull() | F.isnan(c), "0").otherwise("1") for c in xcols])
        common = [r[0] for r in donors.groupBy(bits.alias("b")).count().where(F.col("count") >= max(2, block_rows // 8))
                  .orderBy(F.desc("count"), "b").limit(MOST_PATTERNS).collect()]
        want = min(MOST_PIVOTS, max(1, math.ceil(4 * n / block_rows / max(1, len(common)))))
        rows, place = max(SAMPLE_LEAST, SAMPLE_PER_PIVOT * want), F.pmod(F.xxhash64("__id"), F.lit(1 << 32))
        some = donors.where(place < int((1 << 32) * min(1.0, 2 * rows / n))) if n > 4 * rows else donors
        sample = some.orderBy(place, "__id").limit(rows).select(*xcols).toPandas().to_numpy(dtype="float64")
        with np.errstate(invalid="ignore"):
            known = ~np.isnan(sample)
            mean = np.where(known.any(axis=0), np.nan_to_num(sample).sum(axis=0) / np.maximum(known.sum(axis=0), 1), 0.0)
        pivots = choose_pivots(np.where(known, sample, mean), want) if len(sample) else np.zeros((1, n_features))
        sent = spark.sparkContext.broadcast((pivots, mean, common))
        n_pivots = len(pivots)

        @F.pandas_udf("int")
        def cell_of(*cols: pd.Series) -> pd.Series:
            pivots, mean, common = sent.value
            x = np.column_stack([c.to_numpy(dtype="float64", na_value=np.nan) for c in cols])
            have = ~np.isnan(x)
            region = _distances(np.where(have, x, mean), pivots).argmin(axis=1)
            number = {b: k for k, b in enumerate(common)}
            kind = np.array([number.get("".join("1" if v else "0" for v in h), len(common)) for h in have], np.int64)
            return pd.Series((kind * n_pivots + region).astype("int32"))

        self.placed = lambda df: df.withColumn("__cell", cell_of(*xcols))
        self.donors = cut_lineage(self.placed(donors))

        def stats(batches):
            for pdf in batches:
                for cell, part in pdf.groupby("__cell"):
                    x = part[xcols].to_numpy(dtype="float64", na_value=np.nan)
                    have = ~np.isnan(x)
                    yield pd.DataFrame({"cell": [cell], "n": [have.sum(axis=0)], "lo": [np.where(have, x, np.inf).min(axis=0)],
                                        "hi": [np.where(have, x, -np.inf).max(axis=0)], "rows": [len(x)]})

        def total(pdf: pd.DataFrame) -> pd.DataFrame:       # one row per task and batch
            return pd.DataFrame({"cell": [pdf["cell"].iloc[0]], "n": [np.sum(np.stack(pdf["n"]), axis=0)], "lo": [np.min(np.stack(pdf["lo"]), axis=0)],
                                 "hi": [np.max(np.stack(pdf["hi"]), axis=0)], "rows": [pdf["rows"].sum()]})
        found = self.donors.mapInPandas(stats, _STATS).groupBy("cell").applyInPandas(total, _STATS).toPandas().sort_values("cell")
        shape = (len(found), n_features)
        self.cell = found["cell"].to_numpy(dtype="int64")
        self.n = np.array(found["n"].tolist(), np.int64).reshape(shape)
        self.lo, self.hi = (np.array(found[c].tolist(), np.float64).reshape(shape) for c in ("lo", "hi"))
        self.always, self.ever = self.n == found["rows"].to_numpy()[:, None], self.n > 0

    def visits(self, queries: DataFrame, k: int, rest: bool) -> DataFrame:
        """``queries`` with a missing value, once per cell to search: the first ones, or with ``rest`` all
        others that the thresholds ``__t`` (map column -> distance) leave."""
        xcols = self.xcols
        sent = queries.sparkSession.sparkContext.broadcast((self.cell, self.n, self.lo, self.hi, self.always, self.ever))

        def run(batches):
            cell, n, lo, hi, always, ever = sent.value
            for batch in batches:
                for a in range(0, len(batch), _CHUNK):
                    part = batch.iloc[a:a + _CHUNK]
                    q = part[xcols].to_numpy(dtype="float64", na_value=np.nan)
                    bound = lower_bounds(q, always, ever, lo, hi)
                    order = np.argsort(bound, axis=1, kind="stable")
                    rows, cells = [], []
                    for i in range(len(q)):
                        miss = np.flatnonzero(np.isnan(q[i]))
                        o = order[i][np.isfinite(bound[i][order[i]])]
                        can = n[o][:, miss]
                        first = ((np.cumsum(can, axis=0) - can < k) & (can > 0)).any(axis=1)
                        go = first
                        if rest:
                            known = dict(part["__t"].iloc[i] or {})
                            t = np.array([known.get(int(c), np.inf) for c in miss])
                            go = ~first & ((can > 0) & (bound[i][o][:, None] <= t * (1 + 1e-9))).any(axis=1)
                        rows.append(np.full(int(go.sum()), i))
                        cells.append(cell[o[go]])
                    rows, cells = np.concatenate(rows), np.concatenate(cells)
                    if len(rows):
                        yield part.iloc[rows].drop(columns=["__t"]).assign(__cell=cells.astype("int32"))
        schema = StructType([f for f in queries.schema.fields if f.name != "__t"] + [StructField("__cell", IntegerType())])
        return queries.mapInPandas(run, schema)

    def search(self, visits: DataFrame, k: int) -> DataFrame:
        from tabforge.operators.knn import IMPUTE_SCHEMA, _matrix, _sub_blocks, local_impute_candidates
        xcols = self.xcols

        def pair(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            got = local_impute_candidates(left["__id"].to_numpy(), _matrix(left, xcols), right["__id"].to_numpy(), _matrix(right, xcols), k)
            return pd.DataFrame({n: pd.Series(v, dtype=t) for n, v, t in zip(
                ("query_id", "col", "donor_id", "distance", "value"), got, ("int64", "int32", "int64", "float64", "float64"))})
        qq, dd = _sub_blocks(cut_lineage(visits), self.donors, ["__cell"], self.block_rows)   # read twice
        return qq.groupBy("__cell", "__sub").cogroup(dd.groupBy("__cell", "__sub")).applyInPandas(pair, IMPUTE_SCHEMA)

    def candidates(self, queries: DataFrame, k: int) -> DataFrame:
        """Rows that hold the k nearest donors of every missing cell."""
        from tabforge.operators import pages
        from tabforge.operators.knn import IMPUTE_SCHEMA, ImputeState, _columns, _keys, _row_bytes
        sent = queries.sparkSession.sparkContext.broadcast((self.cell, self.n, self.lo, self.hi, self.always, self.ever))
        names = self.xcols

        class State(ImputeState):
            def meet(self, t):
                cell, n, lo, hi, always, ever = sent.value
                best, ids, d, here = self.best, _keys(t), _columns(t, names), t["__cell"].to_numpy()
                kinds = presence(d)
                some = np.unique(here)
                at, place = np.searchsorted(cell, some), np.searchsorted(some, here)
                for a in range(0, len(best.x), _CHUNK):
                    turn = np.arange(a, min(a + _CHUNK, len(best.x)))
                    bound = lower_bounds(best.x[turn], always[at], ever[at], lo[at], hi[at])
                    can = (best.miss[turn].astype(np.float32) @ (n[at] > 0).T.astype(np.float32)) > 0
                    first = np.zeros(len(some), bool)
                    if np.isinf(best.bound(turn)).any():     # the nearest cells to the chunk that hold k donors of each column
                        wanted = best.miss[turn].any(axis=0)
                        order = np.argsort(np.where(can, bound, np.inf).min(axis=0), kind="stable")
                        held = np.cumsum(n[at][order][:, wanted], axis=0) - n[at][order][:, wanted]
                        first[order] = ((held < 2 * k) & (n[at][order][:, wanted] > 0)).any(axis=1)
                        met = first[place]
                        best.meet(turn, ids[met], d[met], kinds[met])
                    met = ((bound <= best.bound(turn)[:, None] * (1 + 1e-9)) & can).any(axis=0)
                    met = (met & ~first)[place]
                    best.meet(turn, ids[met], d[met], kinds[met])
        return pages.meet(self.placed(queries), self.donors, _row_bytes(len(names)), lambda t: State(t, len(names), k), IMPUTE_SCHEMA, ["__cell"])
