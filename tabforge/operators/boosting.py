"""Leaf-wise boosted trees on quantile-binned columns (the fit behind M-01 ... M-03).

The binned rows are packed once into blocks, one row per Arrow batch, with their labels and
margins, and cut from their lineage. A *pass* is one Spark job over the blocks: tasks add the trees
since the margins were last stored, route rows through the unfinished tree and sum gradient
histograms per open leaf; only summed histograms come back (leaves x features x bins). The driver
picks splits from them.

* **Best-first growth.** The leaf of largest gain is split next, until ``num_leaves`` leaves. A
  split's gain does not depend on other splits, so one pass serves every leaf that the queue could
  take next: the tree is exactly the best-first one, in about as many passes as it has levels.
* **Sibling subtraction.** Rows of the smaller child are summed; the larger one is the difference.
* **Resumable.** Every round adds a tree to the margins; no round is fitted twice. The pass that
  starts round t also sums the valid loss after t trees, so patience costs no jobs.

Fitted trees become a Spark ML tree ensemble: prediction, saving and importances run on the JVM.
Missing values stand in the last bin and go right, as they do in Spark ML trees."""

from __future__ import annotations

import heapq
import json
import pickle
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.session import cut_lineage, ensure_checkpoint_dir

#: Fewest rows and least sum of second derivatives in a leaf.
MIN_ROWS = 20
MIN_HESSIAN = 1e-3
MAX_BINS = 255
#: Deepest level: node numbers fit a long.
MAX_DEPTH = 50
#: Rounds after which the margins are stored again.
REFRESH = 8
#: Histogram bytes that the driver sums itself; more are summed by chunk on the executors first.
DRIVER_BYTES = 32 << 20
_CHUNK = 4096
#: Packed bytes that are worth a task of their own.
PART_BYTES = 4 << 20
_BLOCK = "bins binary, y binary, valid binary, draw binary, margin binary"
_BLOCK_NAMES = [c.split()[0] for c in _BLOCK.split(", ")]


@dataclass
class Split:
    gain: float
    feature: int
    bin: int


@dataclass
class Node:
    """Nodes are numbered from the root 1: the children of i are 2i and 2i + 1."""
    count: float
    grad: float
    hess: float
    best: Split | None = None
    value: float = 0.0


@dataclass
class Tree:
    nodes: dict[int, Node] = field(default_factory=dict)
    splits: dict[int, Split] = field(default_factory=dict)

    def leaves(self, bins: np.ndarray) -> dict[int, np.ndarray]:
        """Row numbers in each leaf: a row is looked at once a level."""
        held = {1: np.arange(len(bins))}
        for i in sorted(self.splits):
            s, here = self.splits[i], held.pop(i)
            right = bins[here, s.feature] > s.bin
            held[2 * i], held[2 * i + 1] = here[~right], here[right]
        return held

    def route(self, bins: np.ndarray) -> np.ndarray:
        """Number of the leaf of each binned row."""
        at = np.ones(len(bins), np.int64)
        for i, here in self.leaves(bins).items():
            at[here] = i
        return at

    def add(self, margin: np.ndarray, bins: np.ndarray) -> None:
        for i, here in self.leaves(bins).items():
            if len(here):
                margin[here] += self.nodes[i].value


def bin_bounds(df: DataFrame, features: list[str], max_bins: int = MAX_BINS) -> list[np.ndarray]:
    """Upper bounds of each feature's bins: distinct values at its quantiles (one aggregate)."""
    at = [(k + 1) / max_bins for k in range(max_bins)]
    col = lambda c: F.when(~F.isnan(F.col(f"`{c}`").cast("double")), F.col(f"`{c}`").cast("double"))
    row = df.agg(*[F.percentile_approx(col(c), at, 10_000).alias(f"q{i}") for i, c in enumerate(features)]).first()
    return [np.unique(np.array(q if q is not None else [], np.float64)) for q in row]


def _bin(x: np.ndarray, bounds: list[np.ndarray]) -> np.ndarray:
    out = np.empty(x.shape, np.uint16)
    for j, b in enumerate(bounds):                          # NaN and values above all bounds: the last bin
        out[:, j] = np.searchsorted(b, x[:, j], side="left")
    return out


def _blocks(df: DataFrame, features: list[str], label: str, bounds: list[np.ndarray], init: float) -> DataFrame:
    x = [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float("nan"))).alias(f"x{i}") for i, c in enumerate(features)]
    rows = df.select(F.col(f"`{label}`").cast("double").alias("y"), F.col("__valid").cast("int").alias("v"), *x)
    rows = rows.where(F.col("y").isNotNull()).withColumn("d", F.xxhash64("y", *[f"x{i}" for i in range(len(features))]))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                m = np.column_stack([b.column(f"x{i}").to_numpy() for i in range(len(features))]) if features else np.zeros((b.num_rows, 0))
                parts = (_bin(m, bounds), b.column("y").to_numpy(), b.column("v").to_numpy().astype(np.uint8),
                         b.column("d").to_numpy(), np.full(b.num_rows, init))
                yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(p).tobytes()], pa.binary()) for p in parts], names=_BLOCK_NAMES)
    return rows.mapInArrow(pack, _BLOCK)


def _unpack(batches: Iterator[pa.RecordBatch], p: int) -> Iterator[tuple]:
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in _BLOCK_NAMES)):
            bins, y, v, d, margin = (np.frombuffer(b, t) for b, t in zip(row, (np.uint16, np.float64, np.uint8, np.int64, np.float64)))
            yield bins.reshape(-1, p), y, v.astype(bool), d, margin.copy()


def _sampled(draw: np.ndarray, rate: float, seed: int, round_: int) -> np.ndarray:
    """Rows of a round's sample, by their values: equal rows go together, on any layout."""
    if rate >= 1:
        return np.ones(len(draw), bool)
    z = draw.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + round_ * 0xBF58476D1CE4E5B9) % (1 << 64))
    for a, m in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(a))) * np.uint64(m)
    return (z ^ (z >> np.uint64(31))) < np.uint64(int(rate * ((1 << 64) - 1)))


def _derivatives(y: np.ndarray, margin: np.ndarray, task: str) -> tuple[np.ndarray, np.ndarray]:
    if task == "Regression":
        return margin - y, np.ones(len(y))
    p = 1 / (1 + np.exp(-margin))
    return p - y, p * (1 - p)


def _loss(y: np.ndarray, margin: np.ndarray, task: str) -> float:
    return float(((margin - y) ** 2).sum() if task == "Regression" else np.logaddexp(0, np.where(y > 0.5, -margin, margin)).sum())


def histogram(bins: np.ndarray, at: np.ndarray, g: np.ndarray, h: np.ndarray, nodes: list[int], cols: np.ndarray, width: int) -> np.ndarray:
    """(nodes, features, bins, [rows, gradient, hessian]) sums of the rows ``at`` the nodes."""
    out = np.zeros((3, len(nodes) * len(cols) * width))
    order = np.argsort(nodes)
    known = np.asarray(nodes)[order]
    near = np.minimum(np.searchsorted(known, at), len(nodes) - 1)
    place = np.where(known[near] == at, order[near], -1)
    rows = np.flatnonzero(place >= 0)
    step = max(1, 2_000_000 // max(1, len(cols)))
    for a in range(0, len(rows), step):
        r = rows[a:a + step]
        cell = ((place[r][:, None] * len(cols) + np.arange(len(cols))) * width + bins[np.ix_(r, cols)]).ravel()
        out[0] += np.bincount(cell, minlength=out.shape[1])
        for k, w in ((1, g), (2, h)):
            out[k] += np.bincount(cell, np.repeat(w[r], len(cols)), out.shape[1])
    return np.moveaxis(out.reshape(3, len(nodes), len(cols), width), 0, -1)


def best_split(hist: np.ndarray, cols: np.ndarray, l2: float, min_rows: int) -> Split | None:
    """Best split of one leaf from its (features, bins, 3) sums; ties to the first feature and bin."""
    left = np.cumsum(hist, axis=1)[:, :-1]
    total = hist[0].sum(axis=0)
    right = total - left
    ok = (left[..., 0] >= min_rows - 0.5) & (right[..., 0] >= min_rows - 0.5)
    ok &= (left[..., 2] >= MIN_HESSIAN) & (right[..., 2] >= MIN_HESSIAN)
    score = lambda s: s[..., 1] ** 2 / np.maximum(s[..., 2] + l2, 1e-12)
    gain = np.where(ok, score(left) + score(right) - score(total), -np.inf)
    if not gain.size:
        return None
    f, b = np.unravel_index(int(gain.argmax()), gain.shape)
    return Split(float(gain[f, b]), int(cols[f]), int(b)) if gain[f, b] > 1e-10 else None


def grow(sums: Callable[[Tree, list[int]], np.ndarray], root: np.ndarray, cols: np.ndarray, num_leaves: int, max_depth: int,
         rate: float, l2: float = 0.0, min_rows: int = MIN_ROWS) -> Tree:
    """The best-first tree. ``root`` has the root's sums; ``sums(tree, nodes)`` those of others."""
    tree, held = Tree(), {1: root}
    position = {int(c): k for k, c in enumerate(cols)}

    def open_node(i: int) -> None:
        s = held[i][0].sum(axis=0)
        can = i.bit_length() <= max_depth
        tree.nodes[i] = Node(*map(float, s), best_split(held[i], cols, l2, min_rows) if can else None)

    open_node(1)
    while True:
        chosen, unknown, queue = {}, [], [(-tree.nodes[1].best.gain, 1)] if tree.nodes[1].best else []
        while queue and len(chosen) + 1 < num_leaves:       # what the queue takes, as far as it is known
            _, i = heapq.heappop(queue)
            chosen[i] = tree.nodes[i].best
            if 2 * i not in tree.nodes:
                unknown.append(i)
                continue
            for k in (2 * i, 2 * i + 1):
                if tree.nodes[k].best:
                    heapq.heappush(queue, (-tree.nodes[k].best.gain, k))
        tree.splits = chosen
        if not unknown:
            break
        small = []
        for i in unknown:
            s = chosen[i]
            left = held[i][position[s.feature], :s.bin + 1, 0].sum()
            small.append(2 * i + (2 * left > tree.nodes[i].count))
        got = sums(tree, small)
        for i, k, h in zip(unknown, small, got):
            held[k], held[k ^ 1] = h, held[i] - h
            open_node(2 * i)
            open_node(2 * i + 1)
            del held[i]
    keep = {1} | {k for i in tree.splits for k in (2 * i, 2 * i + 1)}
    tree.nodes = {i: n for i, n in tree.nodes.items() if i in keep}
    for n in tree.nodes.values():
        n.value = -rate * n.grad / max(n.hess + l2, 1e-12)
    return tree


#: Rounds without a better valid loss that end boosting (the default of the reference's trainer).
PATIENCE = 10


def early_stop_rounds(losses: list[float], patience: int = PATIENCE) -> int:
    """Number of trees to keep: the best iteration seen before ``patience``
    rounds pass without improvement."""
    best, best_i = float("inf"), 0
    for i, loss in enumerate(losses):
        if loss < best - 1e-12:
            best, best_i = loss, i
        elif i - best_i >= patience:
            break
    return best_i + 1


def stopped(losses: list[float], patience: int = PATIENCE) -> bool:
    """Whether early stopping ends inside ``losses``."""
    return len(losses) - early_stop_rounds(losses, patience) >= patience


@dataclass
class Spec:
    """What a fit needs besides its rows."""
    task: str
    p: int
    width: int                                              # bins of a feature, at most
    num_leaves: int
    max_depth: int
    rate: float
    colsample: float
    subsample: float
    seed: int
    l2: float
    min_rows: int
    max_iter: int
    patience: int
    watched: bool                                           # valid rows decide when to stop

    def columns(self, round_: int) -> np.ndarray:
        n = max(1, min(self.p, round(self.colsample * self.p)))
        return np.sort(np.random.default_rng([self.seed, round_]).choice(self.p, n, replace=False)) if self.p else np.zeros(0, np.int64)

    def used(self, block: tuple, round_: int) -> tuple:
        """Bins and derivatives of the rows that a round's tree is grown on."""
        bins, y, v, d, margin = block
        use = ~v & _sampled(d, self.subsample, self.seed, round_)
        return bins[use], *_derivatives(y[use], margin[use], self.task)

    def add(self, total: np.ndarray, block: tuple, used: tuple, tree: Tree | None, nodes: list[int], cols: np.ndarray, loss: bool) -> None:
        """Add a block's sums for the ``nodes`` of an unfinished tree (none: the root), then its valid
        loss and valid rows."""
        _, y, v, _, margin = block
        if loss and v.any():
            total[-2:] += _loss(y[v], margin[v], self.task), v.sum()
        b, g, h = used
        at = tree.route(b) if tree else np.ones(len(b), np.int64)
        total[:-2] += histogram(b, at, g, h, nodes, cols, self.width).ravel()


class InTask:
    """Passes over blocks that one task holds."""

    def __init__(self, spec: Spec, blocks: list[tuple]):
        self.spec, self.blocks, self.rounds, self.used = spec, blocks, 0, []

    def sums(self, tree, nodes, cols, loss):
        total = np.zeros(len(nodes) * len(cols) * self.spec.width * 3 + 2)
        self.used = self.used or [self.spec.used(block, self.rounds) for block in self.blocks]     # once a round
        for block, used in zip(self.blocks, self.used):
            self.spec.add(total, block, used, tree, nodes, cols, loss)
        return total

    def added(self, tree: Tree) -> None:
        self.rounds, self.used = self.rounds + 1, []
        for bins, _, _, _, margin in self.blocks:
            tree.add(margin, bins)


class Spread:
    """Passes as Spark jobs. The stored margins lag at most ``REFRESH`` trees behind."""

    def __init__(self, spec: Spec, blocks: DataFrame, hold: Callable[[DataFrame], DataFrame]):
        self.spec, self.blocks, self.hold, self.rounds, self.fresh = spec, blocks, hold, 0, []
        self.parts = blocks.rdd.getNumPartitions()

    def sums(self, tree, nodes, cols, loss):
        spec, fresh, round_ = self.spec, self.fresh, self.rounds
        size = len(nodes) * len(cols) * spec.width * 3 + 2

        def run(batches):
            total = np.zeros(size)
            for block in _unpack(batches, spec.p):
                for t in fresh:
                    t.add(block[4], block[0])
                spec.add(total, block, spec.used(block, round_), tree, nodes, cols, loss)
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                             names=["part", "sums"])

        parts = self.blocks.mapInArrow(run, "part int, sums binary")
        if size * 8 * self.parts > DRIVER_BYTES:
            return _tree_sum(parts, size)
        got = {r["part"]: np.frombuffer(r["sums"]) for r in parts.collect()}
        return sum((got[k] for k in sorted(got)), np.zeros(size))

    def added(self, tree: Tree) -> None:
        self.rounds += 1
        self.fresh.append(tree)
        if len(self.fresh) < REFRESH:
            return
        p, fresh, before = self.spec.p, self.fresh, self.blocks

        def run(batches):
            for batch in batches:
                out = []
                for bins, _, _, _, margin in _unpack(iter([batch]), p):
                    for t in fresh:
                        t.add(margin, bins)
                    out.append(margin.tobytes())
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.binary())], names=_BLOCK_NAMES)
        self.blocks, self.fresh = self.hold(before.mapInArrow(run, _BLOCK)), []
        before.unpersist()


def boost(passes: InTask | Spread, spec: Spec) -> tuple[list[Tree], list[float]]:
    """(trees, valid loss after each of them). Every round is fitted once."""
    trees: list[Tree] = []
    losses: list[float] = []
    while spec.watched or len(trees) < spec.max_iter:
        cols = spec.columns(len(trees))
        shape = (-1, len(cols), spec.width, 3)
        total = passes.sums(None, [1], cols, spec.watched)
        if trees and total[-1]:
            losses.append(float(total[-2] / total[-1]))
        if len(trees) >= spec.max_iter or stopped(losses, spec.patience):
            break
        tree = grow(lambda t, nodes: passes.sums(t, nodes, cols, False)[:-2].reshape(shape), total[:-2].reshape(shape)[0], cols,
                    spec.num_leaves, spec.max_depth, spec.rate, spec.l2, spec.min_rows)
        if not tree.splits:                                 # no split improves the fit
            break
        trees.append(tree)
        passes.added(tree)
    return trees, losses


@dataclass
class Fit:
    trees: list[Tree]
    losses: list[float]
    bounds: list[np.ndarray]
    init: float


def fit_trees(train: DataFrame, valid: DataFrame | None, features: list[str], label: str, task: str, num_leaves: int, max_depth: int,
              rate: float, colsample: float, subsample: float, seed: int, l2: float, min_rows: int, max_iter: int, patience: int,
              max_bins: int = MAX_BINS, part_bytes: int = PART_BYTES) -> Fit:
    """Boost on ``train`` with patience on ``valid``. Packed rows of at most ``part_bytes`` stand in one
    part, whose task then runs the loop itself: there are no sums to exchange. More rows are
    spread. Both give the same trees."""
    fit = train.where(F.col(f"`{label}`").isNotNull())
    rows, mean = fit.agg(F.count("*"), F.avg(F.col(f"`{label}`").cast("double"))).first()
    if not rows:
        raise ValueError("no training rows with a label")
    bounds = bin_bounds(fit, features, max_bins)
    if task != "Regression":
        mean = min(max(mean, 1e-6), 1 - 1e-6)
        mean = float(np.log(mean / (1 - mean)))
    spec = Spec(task, len(features), max((len(b) for b in bounds), default=0) + 1, num_leaves, min(max_depth, MAX_DEPTH), rate, colsample,
                subsample, seed, l2, min_rows, max_iter, patience, valid is not None)
    both = fit.withColumn("__valid", F.lit(False))
    if valid is not None:
        names = [F.col(f"`{c}`") for c in dict.fromkeys([*features, label])]
        both = both.select(*names, "__valid").union(valid.withColumn("__valid", F.lit(True)).select(*names, "__valid"))

    def hold(df: DataFrame) -> DataFrame:
        done = cut_lineage(df)                              # computed with all its tasks; then as few parts as its bytes need
        held = done.agg(F.sum(F.length("bins") + F.length("margin"))).first()[0] or 0
        parts = min(done.rdd.getNumPartitions(), max(1, -(-held // part_bytes)))
        return done.coalesce(parts).persist(StorageLevel.MEMORY_AND_DISK)

    passes = Spread(spec, hold(_blocks(both, features, label, bounds, float(mean))), hold)
    try:
        if passes.parts > 1:
            trees, losses = boost(passes, spec)
        else:
            def run(batches):
                done = boost(InTask(spec, list(_unpack(batches, spec.p))), spec)
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(done)], pa.binary())], names=["fit"])
            trees, losses = pickle.loads(passes.blocks.mapInArrow(run, "fit binary").first()["fit"])
    finally:
        passes.blocks.unpersist()
    return Fit(trees, losses, bounds, float(mean))


def _tree_sum(parts: DataFrame, size: int) -> np.ndarray:
    """Sum of the tasks' tables by chunk, in the order of the parts: a task holds one sum per chunk
    and the driver gets each chunk once."""
    def cut(batches):
        for batch in batches:
            for part, cells in zip(batch.column("part").to_pylist(), batch.column("sums").to_pylist()):
                x = [cells[a:a + 8 * _CHUNK] for a in range(0, len(cells), 8 * _CHUNK)]
                yield pa.RecordBatch.from_arrays([pa.array(range(len(x)), pa.int32()), pa.array([part] * len(x), pa.int32()), pa.array(x, pa.binary())],
                                                 names=["chunk", "part", "sums"])

    def add(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for c, s in zip(batch.column("chunk").to_pylist(), batch.column("sums").to_pylist()):
                x = np.frombuffer(s)
                held[c] = held[c] + x if c in held else x
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([x.tobytes() for x in held.values()], pa.binary())], names=["chunk", "sums"])

    out = np.zeros(size)
    chunks = parts.mapInArrow(cut, "chunk int, part int, sums binary").repartition("chunk").sortWithinPartitions("chunk", "part")
    for r in chunks.mapInArrow(add, "chunk int, sums binary").collect():
        x = np.frombuffer(r["sums"])
        out[r["chunk"] * _CHUNK:r["chunk"] * _CHUNK + len(x)] = x
    return out


_NODES = ("treeID int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>, rawCount bigint, gain double, "
          "leftChild int, rightChild int, split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>")


def _stub(spark, task: str, n_features: int):
    """A Spark ML ensemble of one leaf: the carrier of a model's metadata."""
    from pyspark.ml.classification import GBTClassificationModel
    from pyspark.ml.regression import GBTRegressionModel
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    ml = jvm.org.apache.spark.ml
    kind = ml.regression.DecisionTreeRegressionModel
    stats = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(gateway.new_array(jvm.double, 3), 0)
    trees, weights = gateway.new_array(kind, 1), gateway.new_array(jvm.double, 1)
    trees[0], weights[0] = kind(f"dtr_{uuid.uuid4().hex[:12]}", ml.tree.LeafNode(0.0, 0.0, stats), n_features), 1.0
    uid = f"gbt_{uuid.uuid4().hex[:12]}"
    if task == "Regression":
        return GBTRegressionModel(ml.regression.GBTRegressionModel(uid, trees, weights, n_features))
    return GBTClassificationModel(ml.classification.GBTClassificationModel(uid, trees, weights, n_features, 2))


def to_spark_model(spark, trees: list[Tree], bounds: list[np.ndarray], init: float, task: str, n_features: int):
    """A Spark ML tree ensemble that predicts the sum of the trees (the first carries ``init``). The
    classifier's margin counts twice in Spark's probability, so values are halved there. The nodes
    go through Spark's ML persistence format: one table, however many trees."""
    trees = trees or [Tree({1: Node(1.0, 0.0, 1.0)}, {})]
    scale = 1.0 if task == "Regression" else 0.5
    rows = []
    for k, t in enumerate(trees):
        order, todo = [], [1]
        while todo:                                         # parents before children, left before right
            i = todo.pop()
            order.append(i)
            todo += [2 * i + 1, 2 * i] if i in t.splits else []
        number = {i: n for n, i in enumerate(order)}
        for i in order:
            n, s = t.nodes[i], t.splits.get(i)
            value = (n.value + (0.0 if k else init)) * scale
            stats = [n.count, -n.grad, n.hess]
            tail = ((s.gain / max(n.count, 1.0), number[2 * i], number[2 * i + 1], (s.feature, [float(bounds[s.feature][s.bin])], -1)) if s
                    else (-1.0, -1, -1, (-1, [], -1)))
            rows.append((k, (number[i], value, 0.0, stats, int(round(n.count)), *tail)))
    stub, path = _stub(spark, task, n_features), f"{ensure_checkpoint_dir(spark).rstrip('/')}/ensemble-{uuid.uuid4().hex}"
    stub.write().save(f"{path}/stub")
    meta = json.loads(spark.read.text(f"{path}/stub/metadata").first()[0]) | {"numTrees": len(trees)}
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.text(f"{path}/model/metadata")
    one = spark.read.parquet(f"{path}/stub/treesMetadata").first()
    each = [(k, json.dumps(json.loads(one[1]) | {"uid": f"dtr_{uuid.uuid4().hex[:12]}"}), 1.0) for k in range(len(trees))]
    spark.createDataFrame(each, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/model/treesMetadata")
    spark.createDataFrame(rows, _NODES).coalesce(1).write.parquet(f"{path}/model/data")
    return type(stub).load(f"{path}/model").setFeaturesCol("__features")
