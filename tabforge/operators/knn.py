"""Exact k-nearest-neighbour join (J-02): the kernel of kNN imputation and of
every SMOTE-family, NearMiss and cleaning balancer.

Exact strategies, same results (ties by donor key):

* ``broadcast`` -- donors (size checked against a byte budget) are shipped
  once to every executor; query partitions stream through ``mapInPandas`` in
  Arrow batches and keep only their top-k per query row. Queries lie in the
  order of the donors' widest coordinate, so a batch looks only at donors near
  it. Donors over the budget are met as pages instead.
* ``blocked`` -- queries and donors are hashed into blocks per group (e.g.
  per class); every (query block, donor block) pair meets in one
  ``cogroup().applyInPandas`` task whose memory is bounded by the block size,
  emits at most k candidates per query row, and a final top-k per query merges
  the candidates. A hot group just gets more blocks.

* ``partitioned`` -- cells by quantiles of one coordinate, for few dimensions.
* ``pivots`` -- cells around pivots, for many dimensions and for farthest
  neighbours (``pivots.py``).

No strategy ever materialises the pair set: each task returns k rows per query.
Distances are computed from direct float64 differences (not the
|a|^2+|b|^2-2ab form) so ties agree with SQL.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tabforge.operators import pages
from tabforge.operators.best import NO_KEY, QUERIES, Nearest, NearestPresent, frame, keys_of
from tabforge.session import cut_lineage

OUT_SCHEMA = "query_id long, donor_id long, distance double"
OUT_COLUMNS = {"query_id": "int64", "donor_id": "int64", "distance": "float64"}
PAIR_CHUNK = 2_000_000  # float64 cells (queries x donors) per distance chunk inside a task
PATTERN_BLOCKS = 16     # auto imputes by presence patterns from this many donor blocks on
PRUNE_MAX_DIMS = 8      # auto uses one-coordinate pruning up to this many continuous features


def pair_distances(Q: np.ndarray, D: np.ndarray, metric: str = "euclidean",
                   qcat: np.ndarray | None = None, dcat: np.ndarray | None = None,
                   cat_penalty: float = 0.0) -> np.ndarray:
    """(len(Q), len(D)) distance matrix, accumulated one coordinate at a time
    (2-D arrays only, terms added left to right as SQL does).

    ``nan_euclidean``: sqrt(p / present * sum over coordinates present in
    both); NaN when nothing is shared. ``mixed``: euclidean^2 + cat_penalty
    per nominal mismatch (SMOTENC). ``vdm``: columns hold P(class | value) for
    ``cat_penalty`` classes per feature; delta_f = sum_c |dP|, distance =
    sum_f delta_f^2."""
    m, n, p = Q.shape[0], D.shape[0], Q.shape[1]
    if metric == "vdm":
        c = int(cat_penalty)
        total = np.zeros((m, n))
        for f in range(p // c):
            delta = np.zeros((m, n))
            for j in range(f * c, (f + 1) * c):
                delta += np.abs(Q[:, j][:, None] - D[:, j][None, :])
            total += delta * delta
        return total
    if metric == "nan_euclidean":
        ss = np.zeros((m, n))
        cnt = np.zeros((m, n))
        for j in range(p):
            diff = Q[:, j][:, None] - D[:, j][None, :]
            ok = ~np.isnan(diff)
            ss += np.where(ok, diff * diff, 0.0)
            cnt += ok
        with np.errstate(invalid="ignore", divide="ignore"):
            d2 = np.where(cnt > 0, ss * (p / np.maximum(cnt, 1)), np.nan)
        return np.sqrt(d2)
    d2 = np.zeros((m, n))
    for j in range(p):
        diff = Q[:, j][:, None] - D[:, j][None, :]
        d2 += diff * diff
    if metric == "mixed" and qcat is not None and qcat.shape[1] > 0:
        mism = np.zeros((m, n))
        for j in range(qcat.shape[1]):
            mism += qcat[:, j][:, None] != dcat[:, j][None, :]
        d2 = d2 + cat_penalty * mism
    return np.sqrt(d2)


def local_topk(qids, Q, dids, D, k, metric="euclidean", exclude_self=False,
               qcat=None, dcat=None, cat_penalty=0.0, farthest=False):
    """Top-k donors per query inside one (query set, donor set) pair of blocks
    (the k largest distances with ``farthest``), ties by donor key.

    Vectorised: donors are put in key order once, ``argpartition`` finds the
    k-th distance per row, and rows whose candidate set is exactly k (the
    usual case) are sorted with a stable sort, which keeps key order on equal
    distances. Rows with ties at the k-th distance take the exact slow path."""
    out_q, out_d, out_v = [], [], []
    if len(qids) == 0 or len(dids) == 0:
        return out_q, out_d, out_v
    dids, qids = np.asarray(dids), np.asarray(qids)
    if metric in ("euclidean", "mixed") and Q.shape[1] > 0:
        mixed = metric == "mixed" and qcat is not None and qcat.shape[1] > 0
        return _euclid_topk(qids, Q, dids, D, k, exclude_self, farthest,
                            qcat if mixed else None, dcat if mixed else None, cat_penalty)
    order = np.argsort(dids, kind="stable")
    dids, D = dids[order], D[order]
    if dcat is not None:
        dcat = dcat[order]
    n = len(dids)
    per = max(1, PAIR_CHUNK // max(1, n))
    for s in range(0, len(qids), per):
        qs = slice(s, s + per)
        dist = pair_distances(Q[qs], D, metric, None if qcat is None else qcat[qs], dcat, cat_penalty)
        dist = np.where(np.isnan(dist), np.inf, dist)
        if farthest:
            dist = np.where(np.isinf(dist), np.inf, -dist)
        if exclude_self:
            dist = np.where(qids[qs][:, None] == dids[None, :], np.inf, dist)
        kk = min(k, n)
        if kk < n:
            kth = np.partition(dist, kk - 1, axis=1)[:, kk - 1]
        else:
            kth = np.full(dist.shape[0], np.inf)
        mask = (dist <= kth[:, None]) & np.isfinite(dist)
        cnt = mask.sum(axis=1)
        fast = np.nonzero(cnt == kk)[0]
        if fast.size:
            cols = np.nonzero(mask[fast])[1].reshape(-1, kk)  # ascending position = ascending key
            dv = np.take_along_axis(dist[fast], cols, axis=1)
            o = np.argsort(dv, axis=1, kind="stable")
            cols = np.take_along_axis(cols, o, axis=1)
            dv = np.take_along_axis(dv, o, axis=1)
            out_q.extend(np.repeat(qids[qs][fast], kk).tolist())
            out_d.extend(dids[cols].ravel().tolist())
            out_v.extend((-dv if farthest else dv).ravel().tolist())
        for i in np.nonzero(cnt != kk)[0]:
            row = dist[i]
            cand = np.nonzero(mask[i])[0]
            o = cand[np.lexsort((dids[cand], row[cand]))][:kk]
            out_q.extend([qids[s + i]] * len(o))
            out_d.extend(dids[o].tolist())
            out_v.extend((-row[o] if farthest else row[o]).tolist())
    return out_q, out_d, out_v


def _euclid_topk(qids, Q, dids, D, k, exclude_self, farthest, qcat=None, dcat=None, cat_penalty=0.0):
    """Euclidean top-k: BLAS screening, exact re-ranking (``best.py``)."""
    best = Nearest(qids, Q, k, exclude_self, farthest, qcat, cat_penalty)
    best.sweep(keys_of(dids), D, dcat)
    return tuple(v.tolist() for v in best.rows())


def _matrix(pdf: pd.DataFrame, cols: list[str]) -> np.ndarray:
    if not cols:
        return np.zeros((len(pdf), 0))
    return pdf[cols].to_numpy(dtype="float64", na_value=np.nan)


def _cats(pdf: pd.DataFrame, cols: list[str]) -> np.ndarray | None:
    if not cols:
        return None
    return pdf[cols].astype("string").fillna("\x00<null>").to_numpy(dtype=object)


def _prepare(df: DataFrame, key: str, features: list[str], cat_features: list[str],
             group: str | None, missing_ok: bool = False) -> DataFrame:
    """Key, coordinates and group under fixed names. A distance to a missing coordinate is not
    defined, so unless the metric takes them (``missing_ok``) such a row fails the query."""
    cols = [F.col(key).cast("long").alias("__id")]
    for i, c in enumerate(features):
        x = F.col(f"`{c}`").cast("double")
        if not missing_ok:
            x = F.when(x.isNull() | F.isnan(x), F.raise_error(F.concat(
                F.lit(f"neighbour search: feature {c!r} is missing in row "), F.coalesce(F.col(key).cast("string"), F.lit("NULL")),
                F.lit("; impute it first")))).otherwise(x)
        cols.append(x.alias(f"__x{i}"))
    cols += [F.col(f"`{c}`").cast("string").alias(f"__c{i}") for i, c in enumerate(cat_features)]
    cols += [F.col(f"`{group}`").alias("__g")] if group else [F.lit(0).alias("__g")]
    return df.select(*cols)


def _by_rank(queries: DataFrame, donors: DataFrame, key: str, search) -> DataFrame:
    """``search(queries, donors)`` for keys that are not integers: rows are numbered in key order
    (so ties still go by key) and the numbers are turned back into keys."""
    from tabforge.operators.indexing import global_index
    names = queries.select(F.col(f"`{key}`").alias("__key")).union(donors.select(F.col(f"`{key}`").alias("__key")))
    ids = cut_lineage(global_index(names.where(F.col("__key").isNotNull()).distinct(), "__key", "__kid"))

    def numbered(df: DataFrame) -> DataFrame:
        return df.join(ids, F.col(f"`{key}`") == F.col("__key")).drop(key, "__key").withColumnRenamed("__kid", key)
    nn = search(numbered(queries), numbered(donors))
    for side in ("query_id", "donor_id"):
        nn = nn.join(ids, nn[side] == ids["__kid"]).drop(side, "__kid").withColumnRenamed("__key", side)
    return nn.select("query_id", "donor_id", "distance", "rank")


def _rank(cands: DataFrame, k: int, farthest: bool = False) -> DataFrame:
    """Merge candidates: the window partition is one query's candidates
    (blocks x k rows), never a whole group."""
    w = Window.partitionBy("query_id").orderBy(F.desc("distance") if farthest else F.asc("distance"), "donor_id")
    return (cands.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k))


def knn_join(queries: DataFrame, donors: DataFrame, features: list[str], k: int = 5,
             key: str = "ID", metric: str = "euclidean", exclude_self: bool = False,
             group: str | None = None, cat_features: list[str] = (), cat_penalty: float = 0.0,
             strategy: str = "auto", broadcast_budget: int = 128 << 20,
             block_rows: int = 20_000, farthest: bool = False) -> DataFrame:
    """k nearest donors for every query row -> (query_id, donor_id, distance, rank).

    ``group`` restricts neighbours to donors of the same group value (e.g. the
    same class). ``strategy``: ``broadcast`` (while donors stay under ``broadcast_budget``
    bytes, measured; then as ``blocked``), ``partitioned`` (exact, range-pruned cells), ``pivots``
    (exact, cells pruned by the triangle inequality, also for ``farthest``),
    ``blocked`` (exact, every block pair) or ``auto``: broadcast when the
    donors fit, else partitioned in up to ``PRUNE_MAX_DIMS`` dimensions, else
    pivots when the metric allows pruning, else blocked."""
    cat_features = list(cat_features)
    if not isinstance(queries.schema[key].dataType, IntegralType):
        return _by_rank(queries, donors, key, lambda q, d: knn_join(
            q, d, features, k, key, metric, exclude_self, group, cat_features, cat_penalty, strategy, broadcast_budget,
            block_rows, farthest))
    missing_ok = metric == "nan_euclidean"
    q = _prepare(queries, key, features, cat_features, group, missing_ok)
    d = _first_copies(_prepare(donors, key, features, cat_features, group, missing_ok), k + exclude_self)
    fits = strategy in ("auto", "broadcast") and _bytes(d, len(features), len(cat_features)) <= broadcast_budget
    if strategy == "broadcast" and not fits:
        strategy = "blocked"
    if strategy == "auto":
        if fits:
            strategy = "broadcast"
        elif metric in ("euclidean", "mixed") and not farthest and 0 < len(features) <= PRUNE_MAX_DIMS:
            strategy = "partitioned"
        elif metric in ("euclidean", "mixed") and features:
            strategy = "pivots"
        else:
            strategy = "blocked"
    if strategy == "broadcast":
        cands = _broadcast_topk(q, d, features, cat_features, k, metric, exclude_self, cat_penalty, farthest)
    elif strategy == "blocked":
        cands = _blocked_topk(q, d, features, cat_features, k, metric, exclude_self, cat_penalty, block_rows,
                              farthest)
    elif strategy == "partitioned":
        if metric not in ("euclidean", "mixed") or farthest or not features:
            raise ValueError("the partitioned strategy needs a euclidean-type metric, nearest neighbours and a "
                             "continuous feature to prune on; use strategy='blocked'")
        cands = _partitioned_topk(q, d, features, cat_features, k, metric, exclude_self, cat_penalty, block_rows)
    elif strategy == "pivots":
        if metric not in ("euclidean", "mixed") or not features:
            raise ValueError("pivots need a euclidean-type metric and a continuous feature; use strategy='blocked'")
        from tabforge.operators.pivots import PivotIndex
        index = PivotIndex(d, len(features), len(cat_features), metric, cat_penalty, block_rows, farthest)
        cands = index.topk(q, k, exclude_self)
    else:
        raise ValueError(strategy)
    return _rank(cands, k, farthest)


def _bytes(d: DataFrame, n_features: int, n_cats: int) -> int:
    """Measured size of the prepared donors as arrays: 8 bytes a number, the strings' own length."""
    text = sum((F.coalesce(F.octet_length(f"__c{i}"), F.lit(0)) + 64 for i in range(n_cats)), F.lit(0))
    r = d.agg(F.count(F.lit(1)), F.coalesce(F.sum(text), F.lit(0))).first()
    return r[0] * 8 * (n_features + 2) + r[1]


def _first_copies(d: DataFrame, n: int) -> DataFrame:
    """Donors without those that no query can have: of equal donors (coordinates, nominal values and
    group) the ``n`` smallest keys come before all others, since ties go by key. Stored, as it is
    read several times."""
    by = [c for c in d.columns if c != "__id"]
    first = Window.partitionBy(F.xxhash64(*by), *by).orderBy(F.asc_nulls_last("__id"))
    ranked = d.withColumn("__copy", F.dense_rank().over(first)).where(F.col("__copy") <= n).drop("__copy")
    return cut_lineage(ranked)


def _broadcast_topk(q, d, features, cat_features, k, metric, exclude_self, cat_penalty, farthest=False):
    spark = q.sparkSession
    pdf = d.toPandas()  # the caller checked its size
    xcols = [f"__x{i}" for i in range(len(features))]
    ccols = [f"__c{i}" for i in range(len(cat_features))]
    by_group, order = {}, []
    if xcols and len(pdf):
        along = pdf[xcols].var().fillna(0.0).idxmax()
        pdf, order = pdf.sort_values(along, kind="stable"), [F.col(along)]
    for g, part in pdf.groupby("__g", sort=False, dropna=False):
        by_group[g] = (part["__id"].to_numpy(), _matrix(part, xcols), _cats(part, ccols))
    bc = spark.sparkContext.broadcast(by_group)

    def run(batches):
        groups = bc.value
        for pdf_q in batches:
            oq, od, ov = [], [], []
            for g, part in pdf_q.groupby("__g", sort=False, dropna=False):
                if g not in groups:
                    continue
                dids, D, dcat = groups[g]
                a, b, c = local_topk(part["__id"].to_numpy(), _matrix(part, xcols), dids, D, k, metric,
                                     exclude_self, _cats(part, ccols), dcat, cat_penalty, farthest)
                oq += a
                od += b
                ov += c
            yield pd.DataFrame({"query_id": pd.Series(oq, dtype="int64"),
                                "donor_id": pd.Series(od, dtype="int64"),
                                "distance": pd.Series(ov, dtype="float64")})
    # explicit partition count: AQE must not fold a small query set into one task
    by = [F.xxhash64("__g"), *order, F.xxhash64("__id")]
    return q.repartitionByRange(pages.TASKS * spark.sparkContext.defaultParallelism, *by).sortWithinPartitions(*by).mapInPandas(run, OUT_SCHEMA)


def _row_bytes(n_features: int, n_cats: int = 0) -> int:
    return 8 * (n_features + 4) + 64 * n_cats


def _columns(t, names: list[str]) -> np.ndarray:
    """Numeric columns of an Arrow table as a matrix, missing ones as NaN."""
    out = np.empty((t.num_rows, len(names)))
    for j, c in enumerate(names):
        out[:, j] = t[c].to_numpy()
    return out


def _keys(t) -> np.ndarray:
    return t["__id"].fill_null(NO_KEY).to_numpy()


def _by_group(t) -> dict:
    """Row numbers of each group of a page."""
    return t.select(["__g"]).to_pandas().groupby("__g", sort=False, dropna=False).indices


class BlockState:
    """A page of queries that meets pages of donors, group by group. With ``limit`` the column __t
    holds distances that the k-th best is known not to exceed."""

    def __init__(self, t, features, cat_features, k, metric, exclude_self, cat_penalty, farthest, limit=False):
        self.xcols, self.ccols = [f"__x{i}" for i in range(len(features))], [f"__c{i}" for i in range(len(cat_features))]
        self.k, self.metric, self.exclude_self, self.penalty, self.farthest = k, metric, exclude_self, cat_penalty, farthest
        self.streams = metric in ("euclidean", "mixed") and len(self.xcols) > 0
        self.found: list[pd.DataFrame] = []
        self.groups = {}
        for g, (rows, ids, x, cats) in self._parts(t):
            bound = t["__t"].to_numpy()[rows] if limit else None
            self.groups[g] = Nearest(ids, x, k, exclude_self, farthest, self._nominal(cats), cat_penalty, bound) if self.streams else (ids, x, cats)

    def _nominal(self, cats):
        return cats if self.metric == "mixed" else None

    def _parts(self, t):
        ids, x, cats = _keys(t), _columns(t, self.xcols), _cats(t.select(self.ccols).to_pandas(), self.ccols)
        for g, rows in _by_group(t).items():
            yield g, (rows, ids[rows], x[rows], None if cats is None else cats[rows])

    def meet(self, t) -> None:
        for g, (rows, ids, x, cats) in self._parts(t):
            if g not in self.groups:
                continue
            if self.streams:
                self.against(self.groups[g], g, rows, ids, x, self._nominal(cats), t)
            else:
                qids, q, qcats = self.groups[g]
                got = local_topk(qids, q, ids, x, self.k, self.metric, self.exclude_self, qcats, cats, self.penalty, self.farthest)
                self.found.append(frame(OUT_COLUMNS, got))

    def against(self, best: Nearest, g, rows, ids, x, cats, t) -> None:
        best.sweep(ids, x, cats)

    def result(self) -> pd.DataFrame:
        found = self.found + ([frame(OUT_COLUMNS, best.rows()) for best in self.groups.values()] if self.streams else [])
        return pd.concat(found, ignore_index=True) if found else frame(OUT_COLUMNS, ([], [], []))


def _blocked_topk(q, d, features, cat_features, k, metric, exclude_self, cat_penalty, block_rows,
                  farthest=False):
    def state(t):
        return BlockState(t, features, cat_features, k, metric, exclude_self, cat_penalty, farthest)
    some = F.col("__g").isNotNull()
    return pages.meet(q.where(some), d.where(some), _row_bytes(len(features), len(cat_features)), state, OUT_SCHEMA)


# ------------------------------------------------------------------ imputation kernel (I-02)
IMPUTE_SCHEMA = "query_id long, col int, donor_id long, distance double, value double"


IMPUTE_COLUMNS = {"query_id": "int64", "col": "int32", "donor_id": "int64", "distance": "float64", "value": "float64"}


class ImputeState:
    """A page of rows with missing values that meets pages of donors. ``along`` is the column that
    pages are ordered by; __t then bounds the k-th distance of every missing column."""

    def __init__(self, t, n_features: int, k: int, along: int | None = None):
        self.xcols, self.along = [f"__x{i}" for i in range(n_features)], along
        x = _columns(t, self.xcols)
        limit = None if along is None else np.repeat(t["__t"].to_numpy()[:, None], n_features, axis=1)
        self.best = NearestPresent(_keys(t), x, k, limit)

    def meet(self, t) -> None:
        ids, d = _keys(t), _columns(t, self.xcols)
        if self.along is None:
            return self.best.meet(np.arange(len(self.best.x)), ids, d)
        x, y = self.best.x[:, self.along], d[:, self.along]
        turn = np.argsort(x, kind="stable")                 # missing ones last
        for a in range(0, len(turn), QUERIES):
            rows = turn[a:a + QUERIES]
            r = self.best.bound(rows).max() * (1 + 1e-9)
            with np.errstate(invalid="ignore"):
                near = ~((y < x[rows].min() - r) | (y > x[rows].max() + r))     # NaN: no bound
            self.best.meet(rows, ids[near], d[near])

    def result(self) -> pd.DataFrame:
        return frame(IMPUTE_COLUMNS, self.best.rows())


def local_impute_candidates(qids, Q, dids, D, k):
    """For each query row and each of its missing columns: the k nearest donors
    (nan-euclidean, ties by donor key) that have that column."""
    if len(qids) == 0 or len(dids) == 0:
        return [], [], [], [], []
    best = NearestPresent(qids, Q, k)
    best.meet(np.arange(len(Q)), keys_of(dids), D)
    return tuple(v.tolist() for v in best.rows())


def impute_candidates(queries: DataFrame, donors: DataFrame, features: list[str], k: int = 5,
                      key: str = "ID", block_rows: int = 20_000, strategy: str = "auto") -> DataFrame:
    """(query_id, col, donor_id, distance, value) for the k nearest donors per
    missing cell, merged per (query, column). ``partitioned`` (the ``auto``
    choice when the donors span several cells) prunes by one coordinate in few
    dimensions; ``patterns`` by presence pattern and region (``patterns.py``);
    ``blocked`` compares every query block with every donor block."""
    q = _prepare(queries, key, features, [], None, missing_ok=True)
    d = _prepare(donors, key, features, [], None, missing_ok=True)
    # one coordinate prunes well only in a few dimensions
    if strategy == "partitioned" or (strategy == "auto" and len(features) <= PRUNE_MAX_DIMS):
        cands = _partitioned_impute(q, d, features, k, block_rows)
        if cands is not None:
            w = Window.partitionBy("query_id", "col").orderBy("distance", "donor_id")
            return cands.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
        if strategy == "partitioned":
            raise ValueError("no coordinate to prune on (too many missing values or one cell)")
    if strategy == "patterns" or (strategy == "auto" and d.count() >= PATTERN_BLOCKS * block_rows):
        from tabforge.operators.patterns import PatternIndex
        cands = PatternIndex(d, len(features), block_rows).candidates(q, k)
        w = Window.partitionBy("query_id", "col").orderBy("distance", "donor_id")
        return cands.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    cands = pages.meet(q, d, _row_bytes(len(features)), lambda t: ImputeState(t, len(features), k), IMPUTE_SCHEMA)
    w = Window.partitionBy("query_id", "col").orderBy("distance", "donor_id")
    return cands.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


# ------------------------------------------------------------------ partitioned (pruned) strategy
def _accuracy(cells: int) -> int:
    """percentile_approx accuracy (relative error 1 / accuracy) fine enough to
    tell ``cells`` quantiles apart; a fixed 10,000 would merge cells beyond that."""
    return max(10_000, 4 * cells)


def _cells(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.searchsorted(bounds, values, side="right")


def _sub_blocks(queries: DataFrame, donors: DataFrame, keys: list[str], block_rows: int):
    """Deal every cell out so that a task gets about ``block_rows`` queries and ``block_rows``
    donors: a cell with more of either is cut into ceil(n / block_rows) hash slices on that side,
    and each slice of one side meets each slice of the other. A value that most donors share
    makes one large cell, so the donor side is cut like the query side. The counts of large cells
    stay DataFrames joined back by the cell key, so nothing per cell reaches the plan."""
    n = F.count(F.lit(1))

    def slices(df: DataFrame, name: str) -> DataFrame:
        return (df.groupBy(*keys).agg(n.alias("__n")).where(F.col("__n") > F.lit(block_rows))
                .select(*keys, F.ceil(F.col("__n") / F.lit(block_rows)).cast("int").alias(name)))
    nq, nd = slices(queries, "__nq"), slices(donors, "__nd")

    def counted(df: DataFrame) -> DataFrame:
        j = df.join(nq, keys, "left").join(nd, keys, "left")
        return j.withColumns({c: F.coalesce(F.col(c), F.lit(1)) for c in ("__nq", "__nd")})
    own_q, own_d = F.pmod(F.xxhash64("__id"), F.col("__nq")), F.pmod(F.xxhash64("__id", F.lit("donor")), F.col("__nd"))
    qq = counted(queries).withColumn("__sub", F.explode(F.transform(
        F.sequence(F.lit(0), F.col("__nd") - 1), lambda s: (own_q * F.col("__nd") + s).cast("int"))))
    dd = counted(donors).withColumn("__sub", F.explode(F.transform(
        F.sequence(F.lit(0), F.col("__nq") - 1), lambda s: (s * F.col("__nd") + own_d).cast("int"))))
    return qq.drop("__nq", "__nd"), dd.drop("__nq", "__nd")


def _partitioned_topk(q: DataFrame, d: DataFrame, features, cat_features, k, metric, exclude_self, cat_penalty,
                      block_rows: int) -> DataFrame:
    """Exact k-NN with range pruning on one coordinate.

    Donors are cut into cells of about ``block_rows`` rows by quantiles of the
    highest-variance coordinate (per group). Pass 1 searches each query's own
    cell; the k-th distance r found there bounds the answer, and since
    |x_p - y_p| <= distance, pass 2 only visits what intersects
    [x_p - r, x_p + r]: pages in the order of the coordinate, and rows inside
    them. Crowded cells are cut on both sides, so a task of pass 1 holds at most
    about block_rows donors and block_rows queries."""
    spark = q.sparkSession
    xcols = [f"__x{i}" for i in range(len(features))]
    ccols = [f"__c{i}" for i in range(len(cat_features))]
    var = d.agg(*[F.var_pop(c).alias(c) for c in xcols]).first()
    pivot = max(xcols, key=lambda c: (var[c] or 0.0))
    dn = {r[0]: r[1] for r in d.groupBy("__g").count().collect()}  # one row per group
    bounds: dict = {}
    for g, n in dn.items():
        cells = max(1, math.ceil(n / block_rows))
        if cells == 1:
            bounds[g] = np.array([], dtype="float64")
            continue
        fr = [i / cells for i in range(1, cells)]
        qs = d.where(F.col("__g") == F.lit(g)).agg(
            F.percentile_approx(pivot, fr, _accuracy(cells)).alias("b")).first()["b"]  # cells - 1 numbers
        bounds[g] = np.unique(np.asarray(qs, dtype="float64"))
    bb = spark.sparkContext.broadcast(bounds)  # total cells ~ rows / block_rows numbers

    @F.pandas_udf("int")
    def cell_of(g: pd.Series, x: pd.Series) -> pd.Series:
        b = bb.value
        out = np.zeros(len(x), dtype="int32")
        for gv in pd.unique(g):
            m = (g == gv).to_numpy()
            out[m] = _cells(x[m].to_numpy(dtype="float64"), b.get(gv, np.array([])))
        return pd.Series(out)

    dc = d.withColumn("__cell", cell_of(F.col("__g"), F.col(pivot)))
    qc = q.withColumn("__cell", cell_of(F.col("__g"), F.col(pivot)))

    def run_pass(queries: DataFrame) -> DataFrame:
        # crowded cells are cut on both sides
        qq, dd = _sub_blocks(queries, dc, ["__g", "__cell"], block_rows)
        keys = ["__g", "__cell", "__sub"]

        def pair(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            a, b, c = local_topk(left["__id"].to_numpy(), _matrix(left, xcols), right["__id"].to_numpy(),
                                 _matrix(right, xcols), k, metric, exclude_self,
                                 _cats(left, ccols), _cats(right, ccols), cat_penalty)
            return pd.DataFrame({"query_id": pd.Series(a, dtype="int64"), "donor_id": pd.Series(b, dtype="int64"),
                                 "distance": pd.Series(c, dtype="float64")})

        return qq.groupBy(*keys).cogroup(dd.groupBy(*keys)).applyInPandas(pair, OUT_SCHEMA)

    first = run_pass(qc)
    # radius: k-th distance in the own cell (infinite when the cell has fewer than k donors)
    kth = first.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("r"))
    radius = F.when(F.col("n") >= k, F.col("r")).otherwise(F.lit(float("inf")))
    qr = qc.join(kth.select(F.col("query_id").alias("__id"), radius.alias("__r")), "__id", "left") \
        .withColumn("__r", F.coalesce("__r", F.lit(float("inf"))))

    x = F.col(pivot)
    reach = qr.withColumnRenamed("__r", "__t").withColumns({"__lo": x - F.col("__t") * (1 + 1e-9), "__hi": x + F.col("__t") * (1 + 1e-9)})

    def state(t):
        return BlockState(t, features, cat_features, k, metric, exclude_self, cat_penalty, False, limit=True)
    return pages.meet(reach.drop("__cell"), d.withColumns({"__lo": x, "__hi": x}), _row_bytes(len(features), len(cat_features)), state,
                      OUT_SCHEMA, [pivot])


def _partitioned_impute(q: DataFrame, d: DataFrame, features: list[str], k: int, block_rows: int):
    """Range-pruned candidates for kNN imputation (nan-euclidean).

    For donors whose pivot coordinate is present, |dx_pivot| <= distance
    (the weight p / present is at least 1), so the cell pruning of
    ``_partitioned_topk`` holds per (query, missing column): pass 1 searches
    the own cell, pass 2 the cells within the largest k-th distance of the
    query's missing columns, as pages in the order of the coordinate. Donors
    missing the pivot carry no bound: their pages meet every query. Queries
    missing the pivot meet every page."""
    spark = q.sparkSession
    xcols = [f"__x{i}" for i in range(len(features))]
    n_d = d.count()
    stats = d.agg(*[F.var_pop(c).alias(f"v{i}") for i, c in enumerate(xcols)],
                  *[F.count(c).alias(f"n{i}") for i, c in enumerate(xcols)]).first()
    ok = [i for i in range(len(xcols)) if n_d and stats[f"n{i}"] >= 0.9 * n_d and (stats[f"v{i}"] or 0) > 0]
    if not ok:
        return None
    pi = max(ok, key=lambda i: stats[f"v{i}"])
    pivot = xcols[pi]
    cells = max(1, math.ceil(stats[f"n{pi}"] / block_rows))
    if cells == 1:
        return None
    fr = [i / cells for i in range(1, cells)]
    b = d.where(F.col(pivot).isNotNull()).agg(F.percentile_approx(pivot, fr, _accuracy(cells)).alias("b")).first()["b"]
    bounds = np.unique(np.asarray(b, dtype="float64"))
    # bucket = number of bounds <= pivot: a JVM-side binary search over the bounds (NULL rows replaced below)
    from pyspark.ml.feature import Bucketizer
    buck = Bucketizer(splits=[float("-inf"), *[float(v) for v in bounds], float("inf")], inputCol=pivot,
                      outputCol="__bucket", handleInvalid="keep")
    bucket = F.col("__bucket")
    dc = buck.transform(d.where(F.col(pivot).isNotNull())).withColumn("__cell", bucket.cast("int")).drop("__bucket")
    qc = buck.transform(q).withColumn("__cell", F.when(F.col(pivot).isNull(), F.lit(-1))
                                      .otherwise(bucket).cast("int")).drop("__bucket")

    def kernel(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        a, c, bb_, dist, v = local_impute_candidates(left["__id"].to_numpy(), _matrix(left, xcols),
                                                     right["__id"].to_numpy(), _matrix(right, xcols), k)
        return pd.DataFrame({"query_id": pd.Series(a, dtype="int64"), "col": pd.Series(c, dtype="int32"),
                             "donor_id": pd.Series(bb_, dtype="int64"), "distance": pd.Series(dist, dtype="float64"),
                             "value": pd.Series(v, dtype="float64")})

    def run(queries: DataFrame, donors: DataFrame) -> DataFrame:
        qq, dd = _sub_blocks(queries, donors, ["__cell"], block_rows)
        return qq.groupBy("__cell", "__sub").cogroup(dd.groupBy("__cell", "__sub")).applyInPandas(kernel, IMPUTE_SCHEMA)

    # pass 1: pivot-present queries in their own cell
    first = run(qc.where(F.col("__cell") >= 0), dc)
    per_col = first.groupBy("query_id", "col").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("r"))
    rad = per_col.groupBy("query_id").agg(
        F.max(F.when(F.col("n") >= k, F.col("r")).otherwise(F.lit(float("inf")))).alias("__r"),
        F.count(F.lit(1)).alias("__ncols"))
    # a missing column without any candidate in pass 1 has no bound either
    miss_cols = sum(F.col(c).isNull().cast("int") for c in xcols)
    qr = qc.join(rad.select(F.col("query_id").alias("__id"), "__r", "__ncols"), "__id", "left") \
        .withColumn("__r", F.when(F.coalesce(F.col("__ncols"), F.lit(0)) < miss_cols, F.lit(float("inf")))
                    .otherwise(F.col("__r")))

    # pages that meet [x - r, x + r]; every page when the pivot is missing or r is unbounded, and
    # those with donors that miss the pivot
    ends = {c: F.lit(float(v)) for c, v in (("__lo", "-inf"), ("__hi", "inf"))}
    x, t = F.nanvl(pivot, F.lit(None).cast("double")), F.coalesce("__r", F.lit(float("inf")))
    known = qr.withColumn("__t", t).withColumns({"__lo": F.coalesce(x - F.col("__t") * (1 + 1e-9), ends["__lo"]),
                                                 "__hi": F.coalesce(x + F.col("__t") * (1 + 1e-9), ends["__hi"])})
    spread = d.withColumns({c: F.coalesce(x, e) for c, e in ends.items()})
    return pages.meet(known.drop("__cell", "__r", "__ncols"), spread, _row_bytes(len(features)),
                      lambda page: ImputeState(page, len(xcols), k, pi), IMPUTE_SCHEMA, [pivot])
