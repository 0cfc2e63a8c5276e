"""Feature synthesis and pruning (D-01 ... D-11, X-01).

``fit_features`` looks at the train rows once for category counts and once per
pruning pass, and returns a ``FeaturePlan``: an ordered, JSON-serialisable list
of feature definitions. ``FeaturePlan.transform`` is a single ``select`` that
replays the same features on any fold.
"""

from __future__ import annotations

import importlib
import json
import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.operators.clean import NUMERIC_TYPES

# Defaults of the synthesis and selection calls.
TOP_N = 10
CORR_THRESHOLD = 0.95
NULL_THRESHOLD = 0.95
AGG_CHUNK = 400
#: Features on a side of a block of pairs.
_GRAM = 512

# ------------------------------------------------------------------ primitives (X-01)
ROW_PRIMITIVES: dict[str, dict] = {}


def register_primitive(name: str, input_kind: str, return_kind: str, fn, description: str = ""):
    """Register a row-wise transform primitive: ``fn(Column) -> Column``.
    ``input_kind`` is one of numeric, boolean, categorical, datetime, any."""
    ROW_PRIMITIVES[name] = {"input": input_kind, "return": return_kind, "fn": fn, "description": description}


def register_vectorized_primitive(name: str, input_kind: str, return_kind: str, fn, return_type: str, description: str = ""):
    """Register a row-wise primitive given as ``fn(pandas.Series) -> pandas.Series`` of the Spark type
    ``return_type``: it runs as a pandas UDF over Arrow batches."""
    register_primitive(name, input_kind, return_kind, lambda c: F.pandas_udf(fn, return_type)(c), description)
    ROW_PRIMITIVES[name]["vectorized"] = (fn, return_type)


def _reference(spec: dict) -> str:
    """Where a primitive's function is defined, as ``module:name``."""
    fn = spec.get("vectorized", (spec["fn"],))[0]
    return f"{fn.__module__}:{fn.__qualname__}"


def _described(name: str, registry: dict) -> dict:
    """What a saved plan keeps of a primitive that is not built in."""
    spec = registry[name]
    return {"name": name, "sequence": registry is SEQUENCE_PRIMITIVES, "input": spec["input"], "return": spec["return"],
            "description": spec["description"], "function": _reference(spec), "type": spec.get("vectorized", (None, None))[1]}


def _restore(saved: dict) -> None:
    """Register a saved plan's primitive, unless this session has it, by importing its function."""
    if saved["name"] in (SEQUENCE_PRIMITIVES if saved["sequence"] else ROW_PRIMITIVES):
        return
    module, _, path = saved["function"].partition(":")
    try:
        fn = importlib.import_module(module)
        for part in path.split("."):
            fn = getattr(fn, part)
    except (ImportError, AttributeError) as e:
        raise ValueError(f"primitive {saved['name']!r} is not registered and {saved['function']!r} cannot be imported; register it first") from e
    if saved["sequence"]:
        register_sequence_primitive(saved["name"], saved["input"], saved["return"], fn, saved["description"])
    elif saved["type"]:
        register_vectorized_primitive(saved["name"], saved["input"], saved["return"], fn, saved["type"], saved["description"])
    else:
        register_primitive(saved["name"], saved["input"], saved["return"], fn, saved["description"])


def _kind(dtype) -> str:
    if isinstance(dtype, T.BooleanType):
        return "boolean"
    if isinstance(dtype, NUMERIC_TYPES):
        return "numeric"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "datetime"
    if isinstance(dtype, T.StringType):
        return "categorical"
    return "other"


# Ordered (sequence) primitives: fn(df, value, out, order, group, key) -> df.
SEQUENCE_PRIMITIVES: dict[str, dict] = {}


def register_sequence_primitive(name: str, input_kind: str, return_kind: str, fn, description: str = ""):
    """Register a primitive that needs row order (running totals, changes)."""
    SEQUENCE_PRIMITIVES[name] = {"input": input_kind, "return": return_kind, "fn": fn, "description": description}


def apply_sequence_primitive(df: DataFrame, name: str, value: str, order, group: str | None = None,
                             key: str | None = None) -> DataFrame:
    spec = SEQUENCE_PRIMITIVES[name]
    return spec["fn"](df, value, f"{name}({value})", order, group, key)


register_primitive("IS_NULL", "any", "boolean", lambda c: c.isNull(), "whether {} is null")
# weekday(): Monday = 0 ... Sunday = 6
register_primitive("WEEKDAY", "datetime", "numeric", lambda c: F.weekday(c), "the day of the week of {}")


def _cum_sum(df, value, out, order, group, key):
    from tabforge.operators.windows import cumulative_sum
    return cumulative_sum(df, value, order, out, group=group, key=key)


def _pct_change(df, value, out, order, group, key):
    from tabforge.operators.windows import percent_change
    return percent_change(df, value, order, out, group=group, key=key)


register_sequence_primitive("CUM_SUM", "numeric", "numeric", _cum_sum, "the cumulative sum of {}")
register_sequence_primitive("PERCENT_CHANGE", "numeric", "numeric", _pct_change, "the percent change of {}")
_BUILT_IN = {*ROW_PRIMITIVES, *SEQUENCE_PRIMITIVES}


def _steps(defs: list[dict]) -> list[dict]:
    """Every definition that ``defs`` are built from, inner ones first."""
    out: list[dict] = []
    for d in defs:
        out += _steps([d["arg"]]) if "arg" in d else []
        out.append(d)
    return out


def with_sequences(df: DataFrame, defs: list[dict], key: str) -> DataFrame:
    """``df`` with a column for every sequence feature that ``defs`` need, inner ones first."""
    done = set()
    for d in _steps(defs):
        if d["kind"] != "sequence" or d["name"] in done:
            continue
        done.add(d["name"])
        value = "__sequence_value"
        df = df.withColumn(value, _build(d["arg"]))
        df = SEQUENCE_PRIMITIVES[d["primitive"]]["fn"](df, value, d["name"], d["order"], d["group"], key).drop(value)
    return df


@dataclass
class FeaturePlan:
    key: str
    defs: list[dict] = field(default_factory=list)
    dropped: list[dict] = field(default_factory=list)

    @property
    def names(self) -> list[str]:
        return [d["name"] for d in self.defs]

    def column(self, d: dict) -> Column:
        return _build(d).alias(d["name"])

    def transform(self, df: DataFrame, keep: list[str] = ()) -> DataFrame:
        passthrough = [F.col(f"`{c}`") for c in [self.key, *keep] if c in df.columns]
        df = with_sequences(df, self.defs, self.key)
        return df.select(*passthrough, *[self.column(d) for d in self.defs])

    def to_json(self) -> str:
        used = {(d["primitive"], d["kind"]) for d in _steps(self.defs) if "primitive" in d}
        own = [_described(n, SEQUENCE_PRIMITIVES if k == "sequence" else ROW_PRIMITIVES) for n, k in sorted(used) if n not in _BUILT_IN]
        return json.dumps({"key": self.key, "defs": self.defs, "dropped": self.dropped, "primitives": own})

    @staticmethod
    def from_json(s: str) -> "FeaturePlan":
        o = json.loads(s)
        for saved in o.get("primitives", []):
            _restore(saved)
        return FeaturePlan(o["key"], o["defs"], o.get("dropped", []))


def _build(d: dict) -> Column:
    k = d["kind"]
    if k == "identity":
        return F.col(f"`{d['input']}`")
    if k == "sequence":
        return F.col(f"`{d['name']}`")                      # made by with_sequences
    if k == "primitive":
        inner = _build(d["arg"])
        return ROW_PRIMITIVES[d["primitive"]]["fn"](inner)
    if k == "onehot":
        return F.coalesce(_build(d["arg"]) == F.lit(d["value"]), F.lit(False))
    if k == "unknown":
        arg = _build(d["arg"])
        return arg.isNull() | ~arg.isin(*d["values"]) if d["values"] else F.lit(True)
    raise ValueError(k)


def _applies(prim: str, kind: str) -> bool:
    want = ROW_PRIMITIVES[prim]["input"]
    return want == "any" or want == kind


def synthesize(df: DataFrame, key: str, exclude=(), primitives=("IS_NULL", "WEEKDAY"),
               max_depth: int = 2, order=None, group: str | None = None) -> list[dict]:
    """Identity features plus primitives stacked up to ``max_depth`` (D-01...D-04). Sequence
    primitives among them need ``order`` (columns) and run within ``group``."""
    order = [order] if isinstance(order, str) else list(order or [])
    missing = [p for p in primitives if p in SEQUENCE_PRIMITIVES and not order]
    if missing:
        raise ValueError(f"sequence primitives {missing} need order=...")
    ex = set(exclude) | {key}
    base = []
    for f in df.schema.fields:
        if f.name in ex:
            continue
        kind = _kind(f.dataType)
        if kind == "other":
            continue
        base.append({"name": f.name, "kind": "identity", "input": f.name, "type": kind, "depth": 0})
    out = list(base)
    frontier = base
    for depth in range(1, max_depth + 1):
        new = []
        for prim in primitives:
            for d in frontier:
                if prim in SEQUENCE_PRIMITIVES:
                    spec = SEQUENCE_PRIMITIVES[prim]
                    if spec["input"] in ("any", d["type"]):
                        new.append({"name": f"{prim}({d['name']})", "kind": "sequence", "primitive": prim, "arg": d, "order": order,
                                    "group": group, "type": spec["return"], "depth": depth})
                    continue
                if not _applies(prim, d["type"]):
                    continue
                # stacking a boolean test on a boolean test adds nothing
                if prim == "IS_NULL" and d["kind"] == "primitive" and d["primitive"] == "IS_NULL":
                    continue
                new.append({"name": f"{prim}({d['name']})", "kind": "primitive", "primitive": prim,
                            "arg": d, "type": ROW_PRIMITIVES[prim]["return"], "depth": depth})
        out += new
        frontier = new
    return out


def category_tops(df: DataFrame, columns: list[str], top_n: int = TOP_N) -> dict[str, list]:
    """Top ``top_n`` values per categorical column, ranked by (count desc, value
    asc), for all columns in one pass: unpivot -> count -> rank per column."""
    if not columns:
        return {}
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns
    ])).alias("kv")).select("kv.*").where(F.col("value").isNotNull())
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    from pyspark.sql import Window
    order = [F.desc("n"), F.asc("value")]
    # two-stage top-n: values are first cut per hash slice (about 200k distinct
    # values per slice), so no task ranks all distinct values of a column
    counts = counts.persist()
    slices = max(1, -(-counts.count() // 200_000))
    cut = counts.withColumn("__s", F.pmod(F.xxhash64("value"), F.lit(slices)))
    cut = cut.withColumn("rk", F.row_number().over(Window.partitionBy("column", "__s").orderBy(*order))) \
        .where(F.col("rk") <= top_n).drop("rk", "__s")
    top = cut.withColumn("rk", F.row_number().over(Window.partitionBy("column").orderBy(*order))) \
        .where(F.col("rk") <= top_n)
    res: dict[str, list] = {c: [] for c in columns}
    for r in top.orderBy("column", "rk").collect():  # <= columns x top_n rows
        res[r["column"]].append(r["value"])
    counts.unpersist()
    return res


def encode(defs: list[dict], tops: dict[str, list]) -> list[dict]:
    """Replace every categorical feature by ``f = v`` for its top values and
    ``f is unknown`` (D-05)."""
    out = []
    for d in defs:
        if d["type"] != "categorical":
            out.append(d)
            continue
        values = tops.get(d["name"], [])
        for v in values:
            out.append({"name": f"{d['name']} = {v}", "kind": "onehot", "arg": d, "value": v,
                        "type": "boolean", "depth": d["depth"]})
        out.append({"name": f"{d['name']} is unknown", "kind": "unknown", "arg": d, "values": values,
                    "type": "boolean", "depth": d["depth"]})
    return out


def _chunks(items, n=AGG_CHUNK):
    for i in range(0, len(items), n):
        yield items[i:i + n]


def column_stats(df: DataFrame, defs: list[dict]) -> dict[str, dict]:
    """n, non-NULL count, min, max per feature: one pass (chunked when wide)."""
    res = {}
    for chunk in _chunks(defs, AGG_CHUNK // 3):
        exprs = [F.count(F.lit(1)).alias("__n")]
        for i, d in enumerate(chunk):
            c = _build(d)
            exprs += [F.count(c).alias(f"c{i}"), F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}")]
            if d["type"] in ("numeric", "boolean"):
                exprs.append(F.avg(c.cast("double")).alias(f"m{i}"))
        row = df.agg(*exprs).first()
        for i, d in enumerate(chunk):
            res[d["name"]] = {"n": row["__n"], "count": row[f"c{i}"], "min": row[f"lo{i}"], "max": row[f"hi{i}"],
                              "mean": row[f"m{i}"] if d["type"] in ("numeric", "boolean") else None}
    return res


def _gram_kernel(names: list[str], centers: list[float]):
    """Per Arrow batch: pairwise-complete moment sums of centred columns, by blocks of ``_GRAM`` by
    ``_GRAM`` features. Emits (i, j, n, sx, sy, sxx, syy, sxy) for every pair j < i."""
    import numpy as np
    import pandas as pd

    p = len(names)
    c = np.asarray(centers, dtype="float64")
    blocks = [(a, b) for a in range(0, p, _GRAM) for b in range(0, a + 1, _GRAM)]

    def run(batches):
        acc: dict = {}
        for pdf in batches:
            x = pdf[names].to_numpy(dtype="float64", na_value=np.nan) - c
            m = (~np.isnan(x)).astype("float64")
            x0 = np.where(m > 0, x, 0.0)
            for a, b in blocks:
                i, j = slice(a, a + _GRAM), slice(b, b + _GRAM)
                q = x0 * x0 if p <= _GRAM else None
                xi, xj = (q[:, i], q[:, j]) if q is not None else (x0[:, i] ** 2, x0[:, j] ** 2)
                part = np.stack([m[:, i].T @ m[:, j], x0[:, i].T @ m[:, j], m[:, i].T @ x0[:, j], xi.T @ m[:, j], m[:, i].T @ xj, x0[:, i].T @ x0[:, j]])
                acc[a, b] = acc[a, b] + part if (a, b) in acc else part
        for (a, b), sums in acc.items():
            i, j = np.indices(sums.shape[1:])
            i, j = i + a, j + b
            low = j < i
            yield pd.DataFrame({"i": i[low].astype("int32"), "j": j[low].astype("int32"),
                                **{n: s[low] for n, s in zip(("n", "sx", "sy", "sxx", "syy", "sxy"), sums)}})
    return run


def _correlation_cells(df: DataFrame, defs: list[dict], centers: dict | None) -> DataFrame:
    """(i, j, r) for all j < i: pairwise-complete Pearson r, NULL where it is not defined.

    Each task multiplies its centred, NULL-masked feature block with itself
    (NumPy/BLAS on Arrow batches) and emits one cell of moment sums per pair; Spark sums
    the cells across tasks (map-side combined). Centring on the column mean keeps the sums stable."""
    names = [f"f{i}" for i in range(len(defs))]
    ctr = [float((centers or {}).get(d["name"]) or 0.0) for d in defs]
    block = df.select(*[_build(d).cast("double").alias(n) for d, n in zip(defs, names)])
    schema = "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double"
    cells = block.mapInPandas(_gram_kernel(names, ctr), schema)
    sums = cells.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ["n", "sx", "sy", "sxx", "syy", "sxy"]]).where("n > 0")
    n = F.col("n")
    cov = F.col("sxy") / n - (F.col("sx") / n) * (F.col("sy") / n)
    vx, vy = (F.col(f"s{a}{a}") / n - (F.col(f"s{a}") / n) * (F.col(f"s{a}") / n) for a in "xy")
    flat = (vx <= 1e-12 * F.greatest(F.lit(1.0), F.col("sxx") / n)) | (vy <= 1e-12 * F.greatest(F.lit(1.0), F.col("syy") / n))
    r = F.when(~flat, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cov / F.sqrt(vx * vy))))
    return sums.select("i", "j", r.alias("r"))


def pair_correlations(df: DataFrame, defs: list[dict], centers: dict | None = None
                      ) -> dict[tuple[str, str], float | None]:
    """Pearson r of every pair of features, on the driver: p * p / 2 numbers (None: not defined)."""
    if len(defs) < 2:
        return {}
    found = {(r["i"], r["j"]): r["r"] for r in _correlation_cells(df, defs, centers).collect()}
    return {(defs[i]["name"], defs[j]["name"]): found.get((i, j)) for i in range(len(defs)) for j in range(i)}


def correlated_features(df: DataFrame, defs: list[dict], centers: dict | None = None, threshold: float = CORR_THRESHOLD) -> set[str]:
    """D-08 without the pairs: features with |r| >= threshold to some feature on their left, dropped
    or not. The pairs are judged on the executors; the driver gets at most p names."""
    if len(defs) < 2:
        return set()
    near = _correlation_cells(df, defs, centers).where(F.abs("r") >= threshold).select("i").distinct()
    return {defs[r["i"]]["name"] for r in near.collect()}


def low_information(st: dict) -> bool:
    """D-07: all NULL, or one value with NULL counted as a value."""
    return st["count"] == 0 or (st["min"] == st["max"] and st["count"] == st["n"])


def highly_null(st: dict, threshold: float = NULL_THRESHOLD) -> bool:
    return st["n"] > 0 and (st["n"] - st["count"]) / st["n"] >= threshold


def single_value(st: dict) -> bool:
    """D-10: at most one distinct non-NULL value."""
    return st["count"] == 0 or st["min"] == st["max"]


def correlated_drops(defs: list[dict], corr: dict, threshold: float = CORR_THRESHOLD) -> set[str]:
    """D-08: from right to left, drop feature i if some j < i (dropped or not)
    has |r| >= threshold; an undefined r never drops."""
    dropped = set()
    for i in range(len(defs) - 1, 0, -1):
        for j in range(i - 1, -1, -1):
            r = corr.get((defs[i]["name"], defs[j]["name"]))
            if r is not None and not math.isnan(r) and abs(r) >= threshold:
                dropped.add(defs[i]["name"])
                break
    return dropped


def fit_features(train: DataFrame, key: str = "ID", exclude=(), top_n: int = TOP_N,
                 remove_low_info: bool = True, remove_high_corr: bool = True,
                 remove_high_nan: bool = True, remove_single_val: bool = True,
                 corr_threshold: float = CORR_THRESHOLD, null_threshold: float = NULL_THRESHOLD,
                 primitives=("IS_NULL", "WEEKDAY"), max_depth: int = 2, order=None, group: str | None = None) -> FeaturePlan:
    """Plan of features synthesized from and pruned on ``train``. ``primitives`` may name row, vectorized
    and sequence primitives; the latter follow ``order`` within ``group``, on whatever rows the
    plan is replayed."""
    from pyspark import StorageLevel
    # the fit reads train three times (category counts, column stats, Gram
    # cells): keep it for the duration of the fit (recomputed if evicted)
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _fit(train, key, exclude, top_n, remove_low_info, remove_high_corr, remove_high_nan,
                    remove_single_val, corr_threshold, null_threshold, primitives, max_depth, order, group)
    finally:
        train.unpersist()


def _fit(train, key, exclude, top_n, remove_low_info, remove_high_corr, remove_high_nan, remove_single_val,
         corr_threshold, null_threshold, primitives, max_depth, order=None, group=None) -> FeaturePlan:
    defs = synthesize(train, key, exclude, primitives, max_depth, order, group)
    train = with_sequences(train, defs, key)
    cats = [d["name"] for d in defs if d["type"] == "categorical"]
    tops = category_tops(train.select(*[_build(d).alias(d["name"]) for d in defs if d["type"] == "categorical"]),
                         cats, top_n) if cats else {}
    defs = encode(defs, tops)
    dropped = []
    need_stats = remove_low_info or remove_high_nan or remove_single_val
    stats = column_stats(train, defs) if need_stats else {}
    if remove_low_info:
        keep = [d for d in defs if not low_information(stats[d["name"]])]
        dropped += [{"name": d["name"], "reason": "low_information"} for d in defs if d not in keep]
        defs = keep
    if remove_high_corr:
        numeric = [d for d in defs if d["type"] in ("numeric", "boolean")]
        gone = correlated_features(train, numeric, {k: v.get("mean") for k, v in stats.items()}, corr_threshold)
        dropped += [{"name": n, "reason": "highly_correlated"} for n in [d["name"] for d in defs] if n in gone]
        defs = [d for d in defs if d["name"] not in gone]
    if remove_high_nan:
        gone = {d["name"] for d in defs if highly_null(stats[d["name"]], null_threshold)}
        dropped += [{"name": d["name"], "reason": "highly_null"} for d in defs if d["name"] in gone]
        defs = [d for d in defs if d["name"] not in gone]
    if remove_single_val:
        gone = {d["name"] for d in defs if single_value(stats[d["name"]])}
        dropped += [{"name": d["name"], "reason": "single_value"} for d in defs if d["name"] in gone]
        defs = [d for d in defs if d["name"] not in gone]
    return FeaturePlan(key, defs, dropped)


def plan_report(plan: FeaturePlan, spark) -> DataFrame:
    rows = [(d["name"], i, True, None) for i, d in enumerate(plan.defs)]
    rows += [(d["name"], None, False, d["reason"]) for d in plan.dropped]
    return spark.createDataFrame(rows, "feature string, position int, kept boolean, reason string")
