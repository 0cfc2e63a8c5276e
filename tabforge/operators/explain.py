"""Exact Shapley values of a boosted-tree model and the mean |SHAP| feature
ranking (M-08, third method; the reference ranks features by the global mean
absolute Shapley value of its tree model on the test fold).

Path-dependent TreeSHAP (Lundberg, Erion and Lee, 2018). For a leaf l with
value v_l (times the tree weight), the unique split features P_l on its path
(d_l of them), the cover fraction z_j (share of the training rows that follow
the path's splits on feature j) and the row's indicator o_j (1 iff the row
follows all of them):

    phi_i += v_l (o_i - z_i) * sum_k c_k w(k, d_l),   w(k, d) = k! (d - k - 1)! / d!

where c_k are the coefficients of t^k in prod_{j in P_l, j != i} (z_j + o_j t).
Summed over leaves and trees, phi adds up to the model margin minus the
expected value.

Work split: the trees (bounded by the model, not the data) are read on the
driver from the model Spark writes to the shared folder. Rows stream through
``mapInPandas`` as Arrow batches. A leaf depends on a row only through its d
path bits, so each worker first tabulates every leaf's contribution for all
2^d bit patterns (once per model); a row then costs a bit-pack, a gather and
a segmented sum over (leaves x depth) cells. Models too large for the table
fall back to the polynomial per row. Each task returns p partial sums, so
the shuffle is p rows per task."""

from __future__ import annotations

import math
import uuid
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# array cells per NumPy step inside a task (rows x leaves x depth); ~16 MB of float64
_CELLS = 2_000_000


@dataclass
class TreeTables:
    """Leaf paths of every tree, padded to the longest path."""
    n_features: int
    leaf_v: np.ndarray       # (L,)   leaf value x tree weight
    node_feat: np.ndarray    # (L, K) feature of the k-th split on the path
    node_thr: np.ndarray     # (L, K) threshold of a continuous split
    node_left: np.ndarray    # (L, K) the path takes the left branch
    node_slot: np.ndarray    # (L, K) slot of that feature in the leaf's feature list; -1 pads
    cat_splits: list         # [(l, k, left categories)] for categorical splits
    slot_feat: np.ndarray    # (L, D) unique path features
    slot_z: np.ndarray       # (L, D) cover fraction per unique feature; pads are 1
    slot_valid: np.ndarray   # (L, D)
    wts: np.ndarray          # (L, D) w(k, d_l), 0 for k >= d_l
    expected_value: float    # sum over leaves of v_l * prod z
    uid: str = ""            # cache key of the pattern table

    @property
    def n_leaves(self) -> int:
        return int(self.leaf_v.shape[0])


def read_trees(model) -> tuple[list[tuple], list[float]]:
    """(node rows, tree weights) of a fitted Spark ML tree ensemble.

    The model is written to the shared checkpoint folder and its node table
    read back. Node rows: (tree, id, prediction, cover, left, right, feature,
    threshold or left categories, number of categories); the count is
    bounded by trees x nodes per tree."""
    from tabforge.session import ensure_checkpoint_dir
    spm = model.model if hasattr(model, "model") else model
    spark = _active_session()
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tabforge-models/{uuid.uuid4().hex}"
    spm.write().overwrite().save(path)
    nd = F.col("nodeData")
    rows = spark.read.parquet(f"{path}/data").select(
        "treeID", nd["id"], nd["prediction"], nd["impurityStats"][0], nd["leftChild"], nd["rightChild"],
        nd["split"]["featureIndex"], nd["split"]["leftCategoriesOrThreshold"], nd["split"]["numCategories"],
    ).collect()  # model nodes, not data rows
    weights = list(getattr(spm, "treeWeights", None) or [1.0] * (1 + max(r[0] for r in rows)))
    return [tuple(r) for r in rows], [float(w) for w in weights]


def _active_session():
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    if spark is None:
        raise RuntimeError("no active Spark session")
    return spark


def tables_from_nodes(nodes: list[tuple], tree_weights: list[float], n_features: int) -> TreeTables:
    by_tree: dict[int, dict[int, tuple]] = defaultdict(dict)
    for r in nodes:
        by_tree[r[0]][r[1]] = r
    leaves = []  # (value, path splits, z by feature, feature order)
    for t in sorted(by_tree):
        nd = by_tree[t]
        children = {c for r in nd.values() for c in (r[4], r[5]) if c is not None and c >= 0}
        root = next(i for i in sorted(nd) if i not in children)
        stack = [(root, [], {}, [])]
        while stack:
            i, path, z, order = stack.pop()
            r = nd[i]
            if r[4] is None or r[4] < 0:
                leaves.append((tree_weights[t] * r[2], path, z, order))
                continue
            f, cover = int(r[6]), float(r[3])
            for child, go_left in ((r[4], True), (r[5], False)):
                frac = float(nd[child][3]) / cover if cover > 0 else 0.0
                z2 = dict(z)
                z2[f] = z2.get(f, 1.0) * frac
                stack.append((child, path + [(f, r[7], r[8], go_left)], z2, order if f in z else order + [f]))
    n_leaves = len(leaves)
    K = max([1] + [len(p) for _, p, _, _ in leaves])
    D = max([1] + [len(o) for _, _, _, o in leaves])
    leaf_v = np.zeros(n_leaves)
    node_feat = np.zeros((n_leaves, K), dtype=np.int64)
    node_thr = np.zeros((n_leaves, K))
    node_left = np.zeros((n_leaves, K), dtype=bool)
    node_slot = np.full((n_leaves, K), -1, dtype=np.int64)
    slot_feat = np.zeros((n_leaves, D), dtype=np.int64)
    slot_z = np.ones((n_leaves, D))
    slot_valid = np.zeros((n_leaves, D), dtype=bool)
    wts = np.zeros((n_leaves, D))
    cat_splits = []
    expected = 0.0
    for li, (v, path, z, order) in enumerate(leaves):
        leaf_v[li] = v
        slot_of = {f: s for s, f in enumerate(order)}
        for k, (f, thr, ncat, go_left) in enumerate(path):
            node_feat[li, k] = f
            node_left[li, k] = go_left
            node_slot[li, k] = slot_of[f]
            if ncat is not None and ncat > 0:
                cat_splits.append((li, k, np.asarray(thr, dtype=float)))
            else:
                node_thr[li, k] = float(thr[0])
        d = len(order)
        for s, f in enumerate(order):
            slot_feat[li, s] = f
            slot_z[li, s] = z[f]
            slot_valid[li, s] = True
            wts[li, s] = math.factorial(s) * math.factorial(d - 1 - s) / math.factorial(d)
        expected += v * float(np.prod([z[f] for f in order])) if order else v
    return TreeTables(n_features, leaf_v, node_feat, node_thr, node_left, node_slot, cat_splits, slot_feat,
                      slot_z, slot_valid, wts, expected, uuid.uuid4().hex)


def tree_tables(model) -> TreeTables:
    nodes, weights = read_trees(model)
    return tables_from_nodes(nodes, weights, len(model.features))


def _codes(tt: TreeTables, x: np.ndarray) -> np.ndarray:
    """Bit pattern per (row, leaf): bit s set iff the row follows every split
    of the leaf's path on the feature of slot s (pads stay 0). One pass per
    path position over contiguous (rows x leaves) arrays: a failed split
    clears its slot's bit."""
    m = x.shape[0]
    n_leaves, D = tt.slot_z.shape
    dt = np.uint8 if D <= 8 else (np.uint16 if D <= 16 else np.uint32 if D <= 32 else np.uint64)
    full = ((np.uint64(1) << tt.slot_valid.sum(axis=1).astype(np.uint64)) - np.uint64(1)).astype(dt)
    code = np.broadcast_to(full, (m, n_leaves)).copy()
    cats = defaultdict(list)
    for li, k, c in tt.cat_splits:
        cats[k].append((li, c))
    for k in range(tt.node_feat.shape[1]):
        pad = tt.node_slot[:, k] < 0
        if pad.all():
            continue
        vals = x[:, tt.node_feat[:, k]]  # (m, L)
        with np.errstate(invalid="ignore"):
            ok = (vals <= tt.node_thr[:, k]) == tt.node_left[:, k]  # NaN goes right, as in Spark
        for li, c in cats.get(k, ()):
            ok[:, li] = np.isin(vals[:, li], c) == tt.node_left[li, k]
        ok |= pad
        keep = ~np.where(pad, 0, np.left_shift(1, np.maximum(tt.node_slot[:, k], 0))).astype(dt)
        code &= np.where(ok, np.array(~dt(0), dtype=dt), keep)
    return code


def _slot_contrib(o: np.ndarray, z: np.ndarray, wts: np.ndarray, v: np.ndarray, valid: np.ndarray) -> np.ndarray:
    """Per-slot contribution (rows x leaves x slots) for indicator values ``o``
    (pads 0, so a pad's factor z + o t is 1)."""
    m, n_leaves, D = o.shape
    o = o.astype(np.float64)
    live = [j for j in range(D) if valid[:, j].any()]
    out = np.zeros((m, n_leaves, D))
    for i in live:
        poly = np.zeros((m, n_leaves, D))
        poly[..., 0] = 1.0
        for j in live:
            if j == i:
                continue
            nxt = poly * z[None, :, j, None]
            nxt[..., 1:] += poly[..., :-1] * o[:, :, j, None]
            poly = nxt
        w = np.einsum("mlk,lk->ml", poly, wts)
        out[:, :, i] = (o[:, :, i] - z[None, :, i]) * w * np.where(valid[:, i], v, 0.0)[None]
    return out


def _scatter_plan(tt: TreeTables):
    """Valid (leaf, slot) cells in feature order and the run starts per feature."""
    flat = tt.slot_feat.reshape(-1)
    order = np.flatnonzero(tt.slot_valid.reshape(-1))
    order = order[np.argsort(flat[order], kind="stable")]
    feats = flat[order]
    starts = np.flatnonzero(np.r_[True, feats[1:] != feats[:-1]])
    D = tt.slot_z.shape[1]
    return order // D, order % D, order, starts, feats[starts]


# Per-process cache of leaf pattern tables, keyed by the tree tables' id: a
# Python worker builds the table once and reuses it for every batch and task.
_PATTERNS: dict = {}
# pattern-table budget per Python worker (leaves x 2^depth x depth float64 cells, 64 MB;
# an executor runs one worker per core): 250 trees of 64 leaves fit at depth 6
_TABLE_CELLS = 8_000_000


def pattern_table(tt: TreeTables) -> np.ndarray | None:
    """(leaves x 2^D x D): each leaf's slot contributions for every indicator
    pattern. A leaf depends on the row only through its d <= D path bits, so
    a row needs one lookup per leaf. None when over the budget."""
    n_leaves, D = tt.slot_z.shape
    if n_leaves * (1 << D) * D > _TABLE_CELLS:
        return None
    if tt.uid in _PATTERNS:
        return _PATTERNS[tt.uid]
    n_pat = 1 << D
    bits = ((np.arange(n_pat)[:, None] >> np.arange(D)[None, :]) & 1).astype(bool)  # (P, D)
    table = np.zeros((n_leaves, n_pat, D))
    step = max(1, _CELLS // max(1, n_pat * D))
    for l0 in range(0, n_leaves, step):
        sl = slice(l0, l0 + step)
        o = bits[:, None, :] & tt.slot_valid[None, sl]
        c = _slot_contrib(o, tt.slot_z[sl], tt.wts[sl], tt.leaf_v[sl], tt.slot_valid[sl])  # (P, Ls, D)
        table[sl] = c.transpose(1, 0, 2)
    _PATTERNS.clear()  # one model at a time per worker
    _PATTERNS[tt.uid] = table
    return table


def _chunk(tt: TreeTables, x: np.ndarray, table: np.ndarray | None, plan) -> np.ndarray:
    code = _codes(tt, x)  # (m, L)
    m = x.shape[0]
    n_leaves, D = tt.slot_z.shape
    leaf, slot, order, starts, feats = plan
    if not len(order):
        return np.zeros((m, tt.n_features))
    if table is not None:
        n_pat = table.shape[1]
        # flat index of table[leaf, code, slot] for the valid cells in feature order
        itype = np.int32 if table.size < 2 ** 31 else np.int64
        base = ((leaf * n_pat) * D + slot).astype(itype)
        idx = code.astype(itype)[:, leaf]
        idx *= itype(D)
        idx += base[None, :]
        cells = np.take(table.reshape(-1), idx)  # (m, cells), feature-sorted
    else:
        o = ((code.astype(np.int64)[:, :, None] >> np.arange(D)[None, None, :]) & 1).astype(bool)
        cells = _slot_contrib(o, tt.slot_z, tt.wts, tt.leaf_v, tt.slot_valid).reshape(m, -1)[:, order]
    out = np.zeros((m, tt.n_features))
    out[:, feats] = np.add.reduceat(cells, starts, axis=1)
    return out


def shap_matrix(tt: TreeTables, x: np.ndarray, use_table: bool = True) -> np.ndarray:
    """Shapley values (rows x features) of the model margin for the rows of ``x``
    (float64, NaN = missing)."""
    x = np.asarray(x, dtype=np.float64)
    out = np.zeros((x.shape[0], tt.n_features))
    if tt.n_leaves == 0 or x.shape[0] == 0:
        return out
    table = pattern_table(tt) if use_table else None
    plan = _scatter_plan(tt)
    width = tt.node_feat.shape[1] + (1 if table is not None else tt.slot_z.shape[1]) * tt.slot_z.shape[1]
    step = max(1, _CELLS // max(1, tt.n_leaves * width))
    for s0 in range(0, x.shape[0], step):
        out[s0:s0 + step] = _chunk(tt, x[s0:s0 + step], table, plan)
    return out


def shap_importance(model, df: DataFrame) -> DataFrame:
    """(feature, importance): mean |Shapley value| over every row of ``df``.

    One scan of ``df``. The tree tables are broadcast (size is the model's),
    each task sums |phi| of its rows per feature and Spark adds the p partial
    sums of every task."""
    import pandas as pd
    spark = df.sparkSession
    feats = list(model.features)
    p = len(feats)
    bc = spark.sparkContext.broadcast(tree_tables(model))
    xs = df.select(*[F.col(f"`{c}`").cast("double").alias(f"__x{i}") for i, c in enumerate(feats)])

    def run(batches):
        tt = bc.value
        acc, n = np.zeros(p), 0
        for pdf in batches:
            x = pdf.to_numpy(dtype=np.float64, na_value=np.nan)
            acc += np.abs(shap_matrix(tt, x)).sum(axis=0)
            n += len(pdf)
        yield pd.DataFrame({"fi": np.arange(p, dtype=np.int32), "abs_sum": acc, "n": np.full(p, n, np.int64)})

    sums = xs.mapInPandas(run, "fi int, abs_sum double, n long")
    agg = sums.groupBy("fi").agg((F.sum("abs_sum") / F.sum("n")).alias("importance"))
    names = F.array(*[F.lit(c) for c in feats])
    return agg.select(F.element_at(names, F.col("fi") + 1).alias("feature"), "importance")


def expected_value(model) -> float:
    return tree_tables(model).expected_value
