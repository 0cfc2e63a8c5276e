"""Class balancing (B-02 ... B-15).

Over-samplers return the original rows plus synthetic rows (``is_synthetic``,
``draw_id`` = "class:j", key NULL); under-samplers return a subset of rows.

Every random choice is ``u(draw_id, salt)``. Draw tables come from
``spark.range`` (spread over tasks), rows get their within-class index from
the distributed ``global_index``, and neighbours from the exact ``knn_join``;
draws meet rows and neighbours through equi-joins. No step puts a whole class
in one task.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.functions.hashing import u
from tabforge.operators.indexing import dealt_join, global_index, keep_smallest
from tabforge.operators.knn import knn_join
from tabforge.session import cut_lineage

K_NEIGHBORS = 5        # SMOTE family
M_NEIGHBORS = 10       # Borderline danger test
NEARMISS_K = 3         # NearMiss n_neighbors and n_neighbors_ver3
NCR_K = 3
DRAW_CHUNK = 10_000    # ADASYN: per-row quotas are exploded in chunks of this size


@dataclass
class BalanceReport:
    """Classes skipped (with reason) and per-class synthetic/kept counts."""
    method: str
    skipped: dict = field(default_factory=dict)
    notes: dict = field(default_factory=dict)


def class_counts(df: DataFrame, label: str) -> dict:
    """Rows per class. A NULL label is no class: such rows raise instead of vanishing."""
    counts = {r[0]: r[1] for r in df.groupBy(label).count().collect()}  # one row per class
    if None in counts:
        raise ValueError(f"{counts[None]} rows without {label!r}; drop or label them before balancing")
    return counts


def _lit_map(mapping: dict, key: Column, dtype: str) -> Column:
    if not mapping:
        return F.lit(None).cast(dtype)
    args = []
    for k, v in mapping.items():
        args += [F.lit(k), F.lit(v).cast(dtype)]
    return F.element_at(F.create_map(*args), key)


def draw_table(spark, deficits: dict, label: str, label_type) -> DataFrame:
    """(label, j, draw_id) for j in 0..m_c-1 per class: one ``spark.range`` over
    all draws, mapped to classes through cumulative offsets (classes x 1)."""
    items = [(c, int(m)) for c, m in sorted(deficits.items(), key=lambda kv: str(kv[0])) if m > 0]
    total = sum(m for _, m in items)
    if total == 0:
        return spark.createDataFrame([], f"`{label}` {label_type.simpleString()}, j long, draw_id string")
    idx = F.col("id")
    cls, start = None, None
    off = 0
    for c, m in items:
        cond = idx < F.lit(off + m)
        cls = F.when(cond, F.lit(c)) if cls is None else cls.when(cond, F.lit(c))
        start = F.when(cond, F.lit(off)) if start is None else start.when(cond, F.lit(off))
        off += m
    df = spark.range(total).select(cls.cast(label_type).alias(label), (idx - start).alias("j"))
    return df.withColumn("draw_id", F.concat(F.col(label).cast("string"), F.lit(":"), F.col("j").cast("string")))


def _prep_common(df, key, label):
    counts = class_counts(df, label)
    if len(counts) < 2:
        return counts, None
    n_max = max(counts.values())
    return counts, n_max


def _tag_original(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in columns], F.lit(False).alias("is_synthetic"),
                     F.lit(None).cast("string").alias("draw_id"))


# ------------------------------------------------------------------ B-02
def random_oversample(df: DataFrame, key: str = "ID", label: str = "label", seed="ros",
                      report: BalanceReport | None = None) -> DataFrame:
    """Copies of uniformly drawn rows of every non-majority class up to the majority size."""
    columns = df.columns
    counts, n_max = _prep_common(df, key, label)
    if n_max is None:
        return _tag_original(df, columns)
    deficits = {c: n_max - n for c, n in counts.items() if n < n_max}
    if report is not None:
        report.notes["added"] = dict(deficits)
    idx = global_index(df.where(F.col(label).isin(list(deficits))), key, "__idx", group=label)
    draws = draw_table(df.sparkSession, deficits, label, df.schema[label].dataType)
    n_of = _lit_map(counts, F.col(label), "bigint")
    draws = draws.withColumn("__idx", F.floor(u("draw_id", f"{seed}:base") * n_of).cast("long"))
    j = draws.join(idx, [label, "__idx"], "inner")
    synth = j.select(*[F.lit(None).cast(df.schema[key].dataType).alias(key) if c == key else F.col(f"`{c}`")
                       for c in columns], F.lit(True).alias("is_synthetic"), F.col("draw_id"))
    return _tag_original(df, columns).unionByName(synth)


# ------------------------------------------------------------------ SMOTE core
def _neighbour_table(df, key, label, features, k, classes, metric="euclidean", cat_features=(),
                     cat_penalty=0.0, strategy="auto", block_rows=20_000, group=None):
    rows = df.where(F.col(label).isin(list(classes)))
    g = group or label
    return knn_join(rows, rows, features, k=k, key=key, metric=metric, exclude_self=True, group=g,
                    cat_features=list(cat_features), cat_penalty=cat_penalty, strategy=strategy,
                    block_rows=block_rows)


def _interpolate(draws: DataFrame, base_rows: DataFrame, nn: DataFrame, df: DataFrame, key: str,
                 label: str, features: list[str], k_of: Column, seed: str,
                 nominal: DataFrame | None = None, cat_features=()) -> DataFrame:
    """draws(label, draw_id, __base_key) -> synthetic rows: x_base + g (x_nn - x_base)."""
    d = draws.withColumn("__rank", (F.lit(1) + F.floor(u("draw_id", f"{seed}:nn") * k_of)).cast("int")) \
             .withColumn("__gap", u("draw_id", f"{seed}:gap"))
    d = d.join(nn.select(F.col("query_id").alias("__base_key"), F.col("rank").cast("int").alias("__rank"),
                         F.col("donor_id").alias("__nn_key")), ["__base_key", "__rank"], "inner")
    base = base_rows.select(F.col(key).alias("__base_key"),
                            *[F.col(f"`{c}`").cast("double").alias(f"__b{i}") for i, c in enumerate(features)])
    near = df.select(F.col(key).alias("__nn_key"),
                     *[F.col(f"`{c}`").cast("double").alias(f"__n{i}") for i, c in enumerate(features)])
    j = d.join(base, "__base_key", "inner").join(near, "__nn_key", "inner")
    cols = {}
    for i, c in enumerate(features):
        b, n = F.col(f"__b{i}"), F.col(f"__n{i}")
        cols[c] = (b + F.col("__gap") * (n - b)).alias(c)
    if nominal is not None:
        j = j.join(nominal, "__base_key", "left")
        for c in cat_features:
            cols[c] = F.col(f"__mode_{c}").alias(c)
    return j, cols


def _assemble(df: DataFrame, j: DataFrame, cols: dict, key: str, label: str) -> DataFrame:
    columns = df.columns
    out = []
    for c in columns:
        if c == key:
            out.append(F.lit(None).cast(df.schema[key].dataType).alias(key))
        elif c == label:
            out.append(F.col(label))
        elif c in cols:
            out.append(cols[c].cast(df.schema[c].dataType) if not isinstance(df.schema[c].dataType, T.StringType)
                       else cols[c])
        else:
            out.append(F.lit(None).cast(df.schema[c].dataType).alias(c))
    synth = j.select(*out, F.lit(True).alias("is_synthetic"), F.col("draw_id"))
    return _tag_original(df, columns).unionByName(synth)


def _neighbour_modes(nn: DataFrame, df: DataFrame, key: str, cat_features, k_of_label: dict, label: str):
    """Per base row: the most frequent value of each nominal column among its
    k' neighbours (smallest value on ties)."""
    vals = df.select(F.col(key).alias("donor_id"), F.col(label).alias("__lbl"),
                     *[F.col(f"`{c}`").cast("string").alias(c) for c in cat_features])
    kk = _lit_map(k_of_label, F.col("__lbl"), "int")
    j = nn.join(vals, "donor_id").where(F.col("rank") <= kk)
    long = j.select("query_id", F.explode(F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).alias("v"))
                                                   for c in cat_features])).alias("kv")).select(
        "query_id", "kv.col", "kv.v")
    cnt = long.groupBy("query_id", "col", "v").agg(F.count(F.lit(1)).alias("n"))
    best = cnt.groupBy("query_id", "col").agg(F.min_by("v", F.struct((-F.col("n")).alias("nn"), F.col("v"))).alias("v"))
    wide = best.groupBy("query_id").pivot("col", list(cat_features)).agg(F.first("v"))
    return wide.select(F.col("query_id").alias("__base_key"),
                       *[F.col(c).alias(f"__mode_{c}") for c in cat_features])


def smote(df: DataFrame, key: str = "ID", label: str = "label", features: list[str] | None = None,
          cat_features: list[str] = (), k: int = K_NEIGHBORS, seed: str = "smote", variant: str = "auto",
          strategy: str = "auto", block_rows: int = 20_000, report: BalanceReport | None = None) -> DataFrame:
    """SMOTE (continuous), SMOTENC (mixed, ``cat_features``) or SMOTEN (all
    nominal: ``features`` empty, value-difference metric). Each non-majority
    class gets ``n_max - n_c`` synthetic rows; classes under 2 rows are skipped."""
    features = list(features) if features is not None else [
        c for c in df.columns if c not in (key, label) and c not in cat_features]
    cat_features = list(cat_features)
    counts, n_max = _prep_common(df, key, label)
    if n_max is None:
        return _tag_original(df, df.columns)
    report = report or BalanceReport("smote")
    usable = {c: n for c, n in counts.items() if n < n_max and n >= 2}
    for c, n in counts.items():
        if n < n_max and n < 2:
            report.skipped[c] = "fewer than 2 rows"
    if not usable:
        return _tag_original(df, df.columns)
    k_of = {c: min(k, n - 1) for c, n in usable.items()}
    # one checkpointed copy of the classes to grow: kNN, base rows and
    # neighbour rows all read it instead of recomputing the input
    idx = global_index(df.where(F.col(label).isin(list(usable))), key, "__idx", group=label)
    metric, penalty = "euclidean", 0.0
    if features and cat_features:
        metric = "mixed"
        minority = min(counts, key=lambda c: (counts[c], str(c)))
        stds = df.where(F.col(label) == F.lit(minority)).agg(
            *[F.stddev_pop(F.col(f"`{c}`").cast("double")).alias(f"s{i}") for i, c in enumerate(features)]).first()
        vals = sorted(v for v in stds if v is not None)
        med = 0.0 if not vals else (vals[len(vals) // 2] if len(vals) % 2 else (vals[len(vals) // 2 - 1] + vals[len(vals) // 2]) / 2)
        penalty = med * med
        report.notes["median_std"] = med
    elif not features:
        metric = "vdm"
    if metric == "vdm":
        nn = vdm_neighbours(df, idx, key, label, cat_features, k, strategy, block_rows)
    else:
        nn = knn_join(idx, idx, features, k=k, key=key, metric=metric, exclude_self=True, group=label,
                      cat_features=cat_features, cat_penalty=penalty, strategy=strategy, block_rows=block_rows)
    draws = draw_table(df.sparkSession, {c: n_max - n for c, n in usable.items()}, label, df.schema[label].dataType)
    n_of = _lit_map(usable, F.col(label), "bigint")
    draws = draws.withColumn("__idx", F.floor(u("draw_id", f"{seed}:base") * n_of).cast("long"))
    draws = draws.join(idx.select(label, "__idx", F.col(key).alias("__base_key")), [label, "__idx"])
    nominal = _neighbour_modes(nn, idx, key, cat_features, k_of, label) if cat_features else None
    k_col = _lit_map(k_of, F.col(label), "int")
    j, cols = _interpolate(draws, idx, nn, idx, key, label, features, k_col, seed, nominal, cat_features)
    return _assemble(df, j, cols, key, label)


def vdm_space(df: DataFrame, key: str, label: str, cat_features: list[str], rows: DataFrame | None = None):
    """Rows mapped to P(class | value) per nominal column (value-difference
    metric space; probabilities from all of ``df``, applied to ``rows``). The
    probabilities stay a table (column, value) that is joined to the rows."""
    classes = sorted(class_counts(df, label), key=str)
    long = df.select(F.col(label).alias("__cls"), F.explode(F.array(*[
        F.struct(F.lit(i).alias("col"), F.col(f"`{c}`").cast("string").alias("v")) for i, c in enumerate(cat_features)
    ])).alias("kv")).select("__cls", "kv.col", "kv.v").where(F.col("v").isNotNull())
    prob = cut_lineage(long.groupBy("col", "v").agg(*[
        F.avg((F.col("__cls").eqNullSafe(F.lit(c))).cast("double")).alias(f"p{i}") for i, c in enumerate(classes)]))
    space = (rows if rows is not None else df).select(
        F.col(key), F.col(label), *[F.col(f"`{c}`").cast("string").alias(f"__v{i}") for i, c in enumerate(cat_features)])
    names = []
    for i, c in enumerate(cat_features):
        here = [f"__p_{c}_{ci}" for ci in range(len(classes))]
        of = prob.where(F.col("col") == i).select(F.col("v").alias(f"__v{i}"), *[F.col(f"p{ci}").alias(n) for ci, n in enumerate(here)])
        space = dealt_join(space, of, [f"__v{i}"], key).withColumns({n: F.coalesce(F.col(f"`{n}`"), F.lit(0.0)) for n in here})
        names += here
    return space.select(key, label, *[F.col(f"`{n}`") for n in names]), names, len(classes)


def vdm_neighbours(df: DataFrame, rows: DataFrame, key: str, label: str, cat_features: list[str], k: int, strategy: str = "auto",
                   block_rows: int = 20_000) -> DataFrame:
    """The k nearest other rows of its class for each of ``rows`` in the value-difference metric:
    (query_id, donor_id, distance, rank).

    Rows of one class with the same category tuple stand at one point. So the search runs between
    distinct tuples: a tuple asks once, for k + 1 rows, and offers its first k + 1 rows by key (no
    answer can hold more of them). A row's neighbours are its tuple's without itself."""
    values = [f"__t{i}" for i in range(len(cat_features))]
    named = rows.select(F.col(key).alias("__row"), F.col(label).alias("__cls"), *[F.col(f"`{c}`").cast("string").alias(t) for c, t in zip(cat_features, values)])
    point = ["__cls", *values]
    few = cut_lineage(named.withColumn("__n", F.row_number().over(Window.partitionBy(*point).orderBy("__row")))   # first k + 1 of each tuple
                      .where(F.col("__n") <= k + 1))
    offer = few.select(F.col("__row").alias(key), F.col("__cls").alias(label), "__n", *[F.col(t).alias(c) for c, t in zip(cat_features, values)])
    space, names, n_classes = vdm_space(df, key, label, cat_features, rows=offer)
    space = cut_lineage(space)
    asks = space.join(few.where("__n = 1").select(F.col("__row").alias(key)), key, "left_semi")
    nn = knn_join(asks, space, names, k=k + 1, key=key, metric="vdm", group=label, cat_penalty=float(n_classes), strategy=strategy, block_rows=block_rows)
    lists = nn.groupBy(F.col("query_id").alias("__row")).agg(F.sort_array(F.collect_list(F.struct("rank", "donor_id", "distance"))).alias("__nn"))   # k + 1
    lists = few.where("__n = 1").join(lists, "__row").select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in point],
                                                            F.concat_ws(",", *[F.col(c).isNull().cast("string") for c in point]).alias("__nulls"), "__nn")
    asked = named.select("__row", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in point],
                         F.concat_ws(",", *[F.col(c).isNull().cast("string") for c in point]).alias("__nulls"))
    each = dealt_join(asked, lists, [*point, "__nulls"], "__row", "inner")
    mine = F.slice(F.filter("__nn", lambda x: x["donor_id"] != F.col("__row")), 1, k)
    return each.select(F.col("__row").alias("query_id"), F.posexplode(mine).alias("__at", "__d")).select(
        "query_id", "__d.donor_id", "__d.distance", (F.col("__at") + 1).alias("rank"))


# ------------------------------------------------------------------ B-06 ADASYN
def adasyn(df: DataFrame, key: str = "ID", label: str = "label", features: list[str] | None = None,
           k: int = K_NEIGHBORS, seed: str = "adasyn", strategy: str = "auto", block_rows: int = 20_000,
           report: BalanceReport | None = None) -> DataFrame:
    """Per non-majority class: r_i = other-class share among the k-NN over all
    rows; row quota = round_half_even(m * r_i / sum r); SMOTE steps towards a
    same-class neighbour. sum r = 0 skips the class."""
    features = list(features) if features is not None else [c for c in df.columns if c not in (key, label)]
    counts, n_max = _prep_common(df, key, label)
    if n_max is None:
        return _tag_original(df, df.columns)
    report = report or BalanceReport("adasyn")
    usable = {c: n for c, n in counts.items() if n < n_max and n >= 2}
    if not usable:
        return _tag_original(df, df.columns)
    queries = df.where(F.col(label).isin(list(usable)))
    allnn = knn_join(queries, df, features, k=k, key=key, exclude_self=True, strategy=strategy,
                     block_rows=block_rows)
    lbl = df.select(F.col(key).alias("donor_id"), F.col(label).alias("__dl"))
    qlbl = queries.select(F.col(key).alias("query_id"), F.col(label))
    other = cut_lineage(allnn.join(lbl, "donor_id").join(qlbl, "query_id")  # read more than once
                        .groupBy("query_id", label).agg(F.count_if(F.col("__dl") != F.col(label)).alias("n_other")))
    tot = {r[0]: r[1] for r in other.groupBy(label).agg(F.sum("n_other")).collect()}
    keep = {c: n for c, n in usable.items() if tot.get(c)}
    for c in usable:
        if not tot.get(c):
            report.skipped[c] = "no other-class neighbours (sum of ratios is 0)"
    if not keep:
        return _tag_original(df, df.columns)
    m_of = _lit_map({c: n_max - n for c, n in keep.items()}, F.col(label), "double")
    s_of = _lit_map({c: float(tot[c]) for c in keep}, F.col(label), "double")
    quota = other.where(F.col(label).isin(list(keep))).withColumn(
        "quota", F.bround(m_of * F.col("n_other") / s_of, 0).cast("long")).where(F.col("quota") > 0)
    # two-level explode: chunk records are spread over tasks before expansion
    chunks = quota.withColumn("__c", F.explode(F.sequence(F.lit(0), F.floor((F.col("quota") - 1) / DRAW_CHUNK)))) \
        .repartition("query_id", "__c")
    draws = chunks.withColumn("t", F.explode(F.sequence(
        F.col("__c") * DRAW_CHUNK, F.least(F.col("quota"), (F.col("__c") + 1) * DRAW_CHUNK) - 1)))
    draws = draws.select(F.col(label), F.col("query_id").alias("__base_key"),
                         F.concat(F.col(label).cast("string"), F.lit(":"), F.col("query_id").cast("string"),
                                  F.lit(":"), F.col("t").cast("string")).alias("draw_id"))
    cls_rows = cut_lineage(df.where(F.col(label).isin(list(keep))))  # read once by kNN and both joins
    nn = _neighbour_table(cls_rows, key, label, features, k, keep, strategy=strategy, block_rows=block_rows)
    k_col = _lit_map({c: min(k, n - 1) for c, n in keep.items()}, F.col(label), "int")
    j, cols = _interpolate(draws, cls_rows, nn, cls_rows, key, label, features, k_col, seed)
    return _assemble(df, j, cols, key, label)


# ------------------------------------------------------------------ B-07 Borderline-SMOTE
def borderline_smote(df: DataFrame, key: str = "ID", label: str = "label", features: list[str] | None = None,
                     k: int = K_NEIGHBORS, m: int = M_NEIGHBORS, seed: str = "borderline",
                     strategy: str = "auto", block_rows: int = 20_000,
                     report: BalanceReport | None = None) -> DataFrame:
    """Borderline-1: danger rows have m/2 <= other-class among m-NN < m; draws
    start only at danger rows, neighbours come from the whole class."""
    features = list(features) if features is not None else [c for c in df.columns if c not in (key, label)]
    counts, n_max = _prep_common(df, key, label)
    if n_max is None:
        return _tag_original(df, df.columns)
    report = report or BalanceReport("borderline")
    usable = {c: n for c, n in counts.items() if n < n_max and n >= 2}
    if not usable:
        return _tag_original(df, df.columns)
    queries = df.where(F.col(label).isin(list(usable)))
    allnn = knn_join(queries, df, features, k=m, key=key, exclude_self=True, strategy=strategy,
                     block_rows=block_rows)
    lbl = df.select(F.col(key).alias("donor_id"), F.col(label).alias("__dl"))
    qlbl = queries.select(F.col(key).alias("query_id"), F.col(label))
    other = cut_lineage(allnn.join(lbl, "donor_id").join(qlbl, "query_id")  # read more than once
                        .groupBy("query_id", label).agg(F.count_if(F.col("__dl") != F.col(label)).alias("n_other")))
    danger = other.where((F.col("n_other") >= F.lit(m / 2)) & (F.col("n_other") < F.lit(m)))
    n_danger = {r[0]: r[1] for r in danger.groupBy(label).count().collect()}
    keep = {c: n for c, n in usable.items() if n_danger.get(c)}
    for c in usable:
        if not n_danger.get(c):
            report.skipped[c] = "no row in danger"
    if not keep:
        return _tag_original(df, df.columns)
    didx = global_index(danger.where(F.col(label).isin(list(keep))), "query_id", "__idx", group=label)
    draws = draw_table(df.sparkSession, {c: n_max - n for c, n in keep.items()}, label, df.schema[label].dataType)
    nd_of = _lit_map({c: n_danger[c] for c in keep}, F.col(label), "bigint")
    draws = draws.withColumn("__idx", F.floor(u("draw_id", f"{seed}:base") * nd_of).cast("long"))
    draws = draws.join(didx.select(label, "__idx", F.col("query_id").alias("__base_key")), [label, "__idx"])
    cls_rows = cut_lineage(df.where(F.col(label).isin(list(keep))))  # read once by kNN and both joins
    nn = _neighbour_table(cls_rows, key, label, features, k, keep, strategy=strategy, block_rows=block_rows)
    k_col = _lit_map({c: min(k, n - 1) for c, n in keep.items()}, F.col(label), "int")
    j, cols = _interpolate(draws, cls_rows, nn, cls_rows, key, label, features, k_col, seed)
    return _assemble(df, j, cols, key, label)


# ------------------------------------------------------------------ B-08 KMeans-SMOTE
def kmeans_smote(df: DataFrame, key: str = "ID", label: str = "label", features: list[str] | None = None,
                 k: int = K_NEIGHBORS, n_clusters: int = 8, threshold: float | str = "auto",
                 seed: str = "kmeans", kmeans_seed: int = 42, strategy: str = "auto", block_rows: int = 20_000,
                 report: BalanceReport | None = None) -> DataFrame:
    """Cluster all rows (Spark ML KMeans); per class keep clusters whose class
    share exceeds the threshold (auto: the class share overall) and that hold
    at least 2 class rows; split the class deficit over the kept clusters by
    sparsity (largest remainder) and run SMOTE inside each cluster.

    Sparsity uses the root-mean-square pairwise distance of the cluster's class
    rows, exact from per-cluster moments (O(n)), instead of the mean pairwise
    distance, which would need every pair: density = n / rms^n_features."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    features = list(features) if features is not None else [c for c in df.columns if c not in (key, label)]
    counts, n_max = _prep_common(df, key, label)
    if n_max is None:
        return _tag_original(df, df.columns)
    report = report or BalanceReport("kmeans_smote")
    total = sum(counts.values())
    vec = VectorAssembler(inputCols=features, outputCol="__vec", handleInvalid="keep").transform(
        df.select(F.col(key), F.col(label), *[F.col(f"`{c}`").cast("double").alias(c) for c in features]))
    km = KMeans(k=n_clusters, seed=kmeans_seed, featuresCol="__vec", predictionCol="__cluster").fit(vec)
    clustered = km.transform(vec).select(key, label, "__cluster")
    withc = df.join(clustered.select(key, "__cluster"), key)
    stats = withc.groupBy("__cluster", label).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.var_pop(F.col(f"`{c}`").cast("double")).alias(f"v{i}") for i, c in enumerate(features)]).collect()
    per_cluster: dict = {}
    for r in stats:
        per_cluster.setdefault(r["__cluster"], 0)
        per_cluster[r["__cluster"]] += r["n"]
    pieces = []
    for c, n in counts.items():
        if n >= n_max:
            continue
        thr = n / total if threshold == "auto" else float(threshold)
        weights = {}
        for r in stats:
            if r[label] != c or r["n"] < 2:
                continue
            if r["n"] / per_cluster[r["__cluster"]] <= thr:
                continue
            var_sum = sum(r[f"v{i}"] or 0.0 for i in range(len(features)))
            rms = math.sqrt(2.0 * r["n"] / (r["n"] - 1) * var_sum) if var_sum > 0 else 0.0
            density = r["n"] / (rms ** len(features)) if rms > 0 else float("inf")
            weights[r["__cluster"]] = 0.0 if math.isinf(density) else 1.0 / density
        if not weights:
            report.skipped[c] = "no cluster passes the balance threshold"
            continue
        wsum = sum(weights.values())
        if wsum == 0:
            weights = {cl: 1.0 for cl in weights}
            wsum = float(len(weights))
        need = n_max - n
        raw = {cl: need * w / wsum for cl, w in weights.items()}
        alloc = {cl: int(math.floor(v)) for cl, v in raw.items()}
        rest = need - sum(alloc.values())
        for cl in sorted(raw, key=lambda cl: (-(raw[cl] - alloc[cl]), cl))[:rest]:
            alloc[cl] += 1
        report.notes[f"clusters_{c}"] = alloc
        for cl, quota in alloc.items():
            if quota > 0:
                pieces.append((c, cl, quota))
    if not pieces:
        return _tag_original(df, df.columns)
    # one SMOTE over (class, cluster) groups; draws indexed per group
    grp, label_of = F.lit(None).cast("string"), F.lit(None).cast(df.schema[label].dataType)
    for c, cl, _ in pieces:  # classes x clusters; labels are compared and carried as values, never as text
        grp = F.when((F.col(label) == F.lit(c)) & (F.col("__cluster") == cl), F.lit(f"{c}#{cl}")).otherwise(grp)
        label_of = F.when(F.col("__grp") == F.lit(f"{c}#{cl}"), F.lit(c)).otherwise(label_of)
    rows = withc.withColumn("__grp", grp).where(F.col("__grp").isNotNull())
    gcount = {r[0]: r[1] for r in rows.groupBy("__grp").count().collect()}
    idx = global_index(rows, key, "__idx", group="__grp")  # checkpointed: kNN and joins read it
    nn = knn_join(idx, idx, features, k=k, key=key, exclude_self=True, group="__grp", strategy=strategy,
                  block_rows=block_rows)
    draws = draw_table(df.sparkSession, {f"{c}#{cl}": q for c, cl, q in pieces}, "__grp", T.StringType())
    draws = draws.withColumn(label, label_of)
    n_of = _lit_map(gcount, F.col("__grp"), "bigint")
    draws = draws.withColumn("__idx", F.floor(u("draw_id", f"{seed}:base") * n_of).cast("long"))
    draws = draws.join(idx.select("__grp", "__idx", F.col(key).alias("__base_key")), ["__grp", "__idx"])
    k_col = F.least(F.lit(k), n_of - 1).cast("int")
    j, cols = _interpolate(draws, idx, nn, idx, key, label, features, k_col, seed)
    return _assemble(df, j, cols, key, label)


# ------------------------------------------------------------------ B-09 ... B-11 NearMiss
def _mean_distance(queries, donors, features, k, key, farthest, strategy, block_rows):
    nn = knn_join(queries, donors, features, k=k, key=key, strategy=strategy, block_rows=block_rows,
                  farthest=farthest)
    # rounded so that equal neighbour sets tie exactly whatever the summation order
    return cut_lineage(nn.groupBy("query_id").agg(F.round(F.avg("distance"), 9).alias("__score")))


def near_miss(df: DataFrame, key: str = "ID", label: str = "label", features: list[str] | None = None,
              version: int = 1, k: int = NEARMISS_K, k3: int = NEARMISS_K, strategy: str = "auto",
              block_rows: int = 20_000) -> DataFrame:
    """NearMiss-1/2/3: every class other than the minority keeps ``n_min`` rows.
    1: smallest mean distance to the k nearest minority rows; 2: smallest mean
    distance to the k farthest; 3: short-list the k3 nearest rows of each class
    to every minority row, keep the largest mean distance to the k nearest
    minority rows (a shorter list is kept whole)."""
    features = list(features) if features is not None else [c for c in df.columns if c not in (key, label)]
    counts = class_counts(df, label)
    if len(counts) < 2:
        return df
    minority = min(counts, key=lambda c: (counts[c], str(c)))
    n_min = counts[minority]
    mino = df.where(F.col(label) == F.lit(minority))
    out = mino
    for c in sorted((c for c in counts if c != minority), key=str):
        maj = df.where(F.col(label) == F.lit(c))
        if version == 3:
            short = knn_join(mino, maj, features, k=k3, key=key, strategy=strategy, block_rows=block_rows)
            ids = cut_lineage(short.select(F.col("donor_id").alias("__sid")).distinct())
            maj = maj.join(ids, F.col(key) == F.col("__sid"), "left_semi")
        score = _mean_distance(maj, mino, features, k, key, version == 2, strategy, block_rows)
        scored = maj.join(score, F.col(key) == F.col("query_id")).drop("query_id")
        if version == 3:
            scored = scored.withColumn("__score", -F.col("__score"))
        kept = keep_smallest(scored.withColumn("__g", F.lit(1)), "__g", "__score", key, {1: n_min})
        out = out.unionByName(kept.drop("__g", "__score"))
    return out


# ------------------------------------------------------------------ B-12 NCR, B-13 OSS
def _vote(nn: DataFrame, df: DataFrame, key: str, label: str) -> DataFrame:
    """query_id -> predicted label = most frequent neighbour label (smallest on ties)."""
    lbl = df.select(F.col(key).alias("donor_id"), F.col(label).alias("__dl"))
    cnt = nn.join(lbl, "donor_id").groupBy("query_id", "__dl").agg(F.count(F.lit(1)).alias("n"))
    return cnt.groupBy("query_id").agg(F.min_by("__dl", F.struct((-F.col("n")).alias("nn"), F.col("__dl"))).alias("__pred"))


def neighbourhood_cleaning(df: DataFrame, key: str = "ID", label: str = "label",
                           features: list[str] | None = None, k: int = NCR_K, strategy: str = "auto",
                           block_rows: int = 20_000) -> DataFrame:
    """Drop non-minority rows out-voted by their k-NN, and non-minority
    neighbours of minority rows out-voted by their k-NN."""
    features = list(features) if features is not None else [c for c in df.columns if c not in (key, label)]
    df = cut_lineage(df)                                    # read several times below
    counts = class_counts(df, label)
    if len(counts) < 2:
        return df
    minority = min(counts, key=lambda c: (counts[c], str(c)))
    nn = cut_lineage(knn_join(df, df, features, k=k, key=key, exclude_self=True, strategy=strategy, block_rows=block_rows))
    pred = cut_lineage(_vote(nn, df, key, label))
    own = df.select(F.col(key).alias("query_id"), F.col(label).alias("__own"))
    wrong = pred.join(own, "query_id").where(F.col("__pred") != F.col("__own"))
    drop1 = wrong.where(F.col("__own") != F.lit(minority)).select(F.col("query_id").alias("__drop"))
    bad_min = wrong.where(F.col("__own") == F.lit(minority)).select("query_id")
    lbl = df.select(F.col(key).alias("donor_id"), F.col(label).alias("__dl"))
    drop2 = nn.join(bad_min, "query_id", "left_semi").join(lbl, "donor_id") \
        .where(F.col("__dl") != F.lit(minority)).select(F.col("donor_id").alias("__drop"))
    drops = drop1.unionByName(drop2).distinct()
    return df.join(drops, F.col(key) == F.col("__drop"), "left_anti")


def tomek_drop(df: DataFrame, key: str, label: str, features: list[str], keep_class, strategy="auto",
               block_rows: int = 20_000) -> DataFrame:
    """Remove members of Tomek links (mutual 1-NN of different classes) that are not ``keep_class``."""
    nn = cut_lineage(knn_join(df, df, features, k=1, key=key, exclude_self=True, strategy=strategy, block_rows=block_rows))
    a = nn.select(F.col("query_id").alias("a"), F.col("donor_id").alias("b"))
    b = nn.select(F.col("query_id").alias("b"), F.col("donor_id").alias("a"))
    mutual = a.join(b, ["a", "b"])
    lbl = df.select(F.col(key).alias("a"), F.col(label).alias("__la"))
    lblb = df.select(F.col(key).alias("b"), F.col(label).alias("__lb"))
    links = mutual.join(lbl, "a").join(lblb, "b").where(F.col("__la") != F.col("__lb"))
    drops = links.where(F.col("__la") != F.lit(keep_class)).select(F.col("a").alias("__drop")).distinct()
    return df.join(drops, F.col(key) == F.col("__drop"), "left_anti")


def one_sided_selection(df: DataFrame, key: str = "ID", label: str = "label",
                        features: list[str] | None = None, seed: str = "oss", strategy: str = "auto",
                        block_rows: int = 20_000) -> DataFrame:
    """One-pass OSS: seed = the majority row with the least u; keep minority,
    seed, and majority rows whose 1-NN in (minority + seed) is a minority row;
    then drop the majority members of Tomek links."""
    features = list(features) if features is not None else [c for c in df.columns if c not in (key, label)]
    df = cut_lineage(df)                                    # read several times below
    counts = class_counts(df, label)
    if len(counts) < 2:
        return df
    minority = min(counts, key=lambda c: (counts[c], str(c)))
    mino = df.where(F.col(label) == F.lit(minority))
    out = mino
    for c in sorted((c for c in counts if c != minority), key=str):
        maj = df.where(F.col(label) == F.lit(c))
        seed_row = cut_lineage(maj.withColumn("__u", u(key, seed)).orderBy("__u", key).limit(1).drop("__u"))
        pool = mino.unionByName(seed_row)
        nn = knn_join(maj, pool, features, k=1, key=key, exclude_self=True, strategy=strategy,
                      block_rows=block_rows)
        lbl = pool.select(F.col(key).alias("donor_id"), F.col(label).alias("__dl"))
        hit = nn.join(lbl, "donor_id").where(F.col("__dl") == F.lit(minority)).select(F.col("query_id").alias("__k"))
        kept = maj.join(hit, F.col(key) == F.col("__k"), "left_semi")
        out = out.unionByName(seed_row).unionByName(kept.join(seed_row.select(F.col(key).alias("__s")),
                                                              F.col(key) == F.col("__s"), "left_anti"))
    return tomek_drop(cut_lineage(out), key, label, features, minority, strategy, block_rows)


# ------------------------------------------------------------------ B-14, B-15
SLOW = ("neighborhoodcleaningrule", "onesidedselection")


def applicable_balancers(n_features: int, n_categorical: int, enable_slow: bool = False) -> list[str]:
    """Random over-sampling always; all-categorical -> SMOTEN; mixed -> SMOTENC;
    none categorical -> SMOTE, ADASYN, Borderline, KMeans-SMOTE, NearMiss 1-3
    (+ NCR and OSS with ``enable_slow``)."""
    out = ["ros"]
    if n_categorical and n_categorical == n_features:
        return out + ["smote"]  # SMOTEN
    if n_categorical:
        return out + ["smote"]  # SMOTENC
    out += ["smote", "adasyn", "borderlinesmote", "kmeanssmote", "nearmiss1", "nearmiss2", "nearmiss3"]
    if enable_slow:
        out += list(SLOW)
    return out


def balance(name: str, df: DataFrame, key: str = "ID", label: str = "label", features=None,
            cat_features=(), report: BalanceReport | None = None, **kw) -> DataFrame:
    """Apply the named balancer; ``none`` returns the rows unchanged. ``report`` collects the
    classes that an over-sampler skipped, with the reason."""
    if report is not None and name in ("ros", "smote", "adasyn", "borderlinesmote", "kmeanssmote"):
        kw["report"] = report
    if name == "none":
        return df
    if name == "ros":
        return random_oversample(df, key, label, report=kw.get("report"))
    if name == "smote":
        return smote(df, key, label, features, cat_features, **kw)
    if name == "adasyn":
        return adasyn(df, key, label, features, **kw)
    if name == "borderlinesmote":
        return borderline_smote(df, key, label, features, **kw)
    if name == "kmeanssmote":
        return kmeans_smote(df, key, label, features, **kw)
    if name.startswith("nearmiss"):
        return near_miss(df, key, label, features, version=int(name[-1]), **kw)
    if name == "neighborhoodcleaningrule":
        return neighbourhood_cleaning(df, key, label, features, **kw)
    if name == "onesidedselection":
        return one_sided_selection(df, key, label, features, **kw)
    raise ValueError(name)
