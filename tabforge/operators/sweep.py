"""Random hyper-parameter sweep, best-trial choice and sweep summary
(M-05 ... M-07, W-05, J-04, A-09).

The trial table is drawn with ``u(trial_id, parameter)``: reproducible and
checkable in SQL. Trials run on a small driver thread pool, each with a job group
that is cancelled at its time limit; every fit inside a trial is distributed, and each (imputer, balancer) variant is
built once and shared by the trials that use it."""

from __future__ import annotations

import threading
import time
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.functions.hashing import u
from tabforge.operators.model import ROUNDS, TrialParams, fit_gbt
from tabforge.operators.report import classification_report, neg_rmse
from tabforge.operators.impute import fit_imputer
from tabforge.operators.variant import model_features, variant

# The search space of the reference's sweep.
SPACE = {
    "max_depth": ("quniform", 5, 20, 1),
    "num_leaves": ("quniform", 10, 50, 1),
    "colsample": ("uniform", 0.5, 1.0),
    "subsample": ("uniform", 0.5, 1.0),
    "learning_rate": ("uniform", 0.05, 0.2),
}


def trial_table(spark, n_trials: int, imputers: list[str], balancers: list[str]) -> DataFrame:
    return draw_trials(spark.range(n_trials).select(F.col("id").alias("trial_id")), imputers, balancers)


def draw_trials(t: DataFrame, imputers: list[str], balancers: list[str]) -> DataFrame:
    """Parameters of each ``trial_id`` of ``t``, drawn from SPACE by the id alone."""
    def choice(name, values):
        idx = F.floor(u("trial_id", name) * F.lit(len(values))).cast("int") + 1
        return F.element_at(F.array(*[F.lit(v) for v in values]), idx).alias(name)

    cols = [choice("imputer", imputers), choice("balancer", balancers)]
    for name, spec in SPACE.items():
        lo, hi = spec[1], spec[2]
        x = F.lit(lo) + u("trial_id", name) * F.lit(hi - lo)
        if spec[0] == "quniform":
            x = (F.bround(x / spec[3], 0) * spec[3]).cast("int")
        cols.append(x.alias(name))
    return t.select("trial_id", *cols)


class JobGroup:
    """The Spark jobs that this thread starts inside the block: a group of their own in a fair pool of
    their own, cancelled once ``limit`` seconds have passed. Jobs that the thread starts after that
    are cancelled too, so the block ends with an error as soon as it next asks Spark for anything."""

    EVERY = 0.2

    def __init__(self, spark, name: str, limit: float):
        self.sc, self.name, self.limit = spark.sparkContext, f"{name} {uuid.uuid4().hex}", limit
        self.cancelled, self._over = False, threading.Event()

    def _watch(self) -> None:
        if self._over.wait(max(0.0, self.limit)):
            return
        self.cancelled = True
        while True:
            self.sc.cancelJobGroup(self.name)
            if self._over.wait(self.EVERY):
                return

    def __enter__(self) -> "JobGroup":
        self.sc.setJobGroup(self.name, self.name, interruptOnCancel=True)
        self.sc.setLocalProperty("spark.scheduler.pool", self.name)
        self._thread = threading.Thread(target=self._watch, daemon=True)
        self._thread.start()
        return self

    def __exit__(self, *_error) -> None:
        self._over.set()
        self._thread.join()
        for k in ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel", "spark.scheduler.pool"):
            self.sc.setLocalProperty(k, None)


def run_sweep(df: DataFrame, trials: DataFrame, key: str = "ID", label: str = "label",
              task: str = "Classification", primary_metric: str = "weighted-avg_f1-score",
              max_iter: int = ROUNDS, parallelism: int = 5, features: list[str] | None = None,
              balance_kw: dict | None = None, time_limit: float = 7200.0,
              trial_limit: float | None = None) -> tuple[DataFrame, dict]:
    """Run every trial; returns (trial results table, {trial_id: (model, metrics)}).

    A trial or a variant that fails is recorded (score NULL, the reason in ``error``) and the
    others go on. Every trial has its own job group and scheduler pool. At ``time_limit`` seconds
    the jobs of all running trials are cancelled and no further trial starts; ``trial_limit`` does
    the same for one trial. A cancelled trial is recorded as such. Valid and test rows are kept
    once per imputer, balanced train rows once per variant and only while its trials run."""
    from pyspark import StorageLevel
    spark = df.sparkSession
    features = features or model_features(df, key, label)
    rows = trials.orderBy("trial_id").collect()  # the trial table: n_trials rows
    began = time.time()
    # every variant of every trial reads the same projection: compute it once
    base = df.select(key, label, "fold", *[F.col(f"`{c}`") for c in features]).persist(
        StorageLevel.MEMORY_AND_DISK)
    fit_rows = base.where(F.col("fold") == "train").select(key, *[F.col(f"`{c}`").cast("double").alias(c) for c in features])
    done: dict = {}

    def part(fold, imputer, balancer, model):
        return variant(base, fold, imputer, balancer, key, label, features, imputer_model=model,
                       **(balance_kw or {})).persist(StorageLevel.MEMORY_AND_DISK)

    def one(r, train, valid, test):
        t0 = time.time()
        if t0 - began > time_limit:
            raise TimeoutError(f"not started: the sweep is over its limit of {time_limit:g} s")
        params = TrialParams(r["max_depth"], r["num_leaves"], r["colsample"], r["subsample"],
                             r["learning_rate"], max_iter)
        model = fit_gbt(train, features, label, params, task, valid=valid)
        pred = model.predict(test)
        if task == "Regression":
            metrics = {"neg_root_mean_squared_error": neg_rmse(pred, label, "yhat").first()[0]}
        else:
            metrics = {m["metric"]: m["value"] for m in classification_report(pred, label, "yhat").collect()}
        metrics["n_trees"] = float(model.n_trees)
        metrics["fit_seconds"] = time.time() - t0
        return model, metrics

    def attempt(r, *parts):
        limit = began + time_limit - time.time()
        limit = limit if trial_limit is None else min(limit, trial_limit)
        with JobGroup(spark, f"trial {r['trial_id']}", limit) as group:
            try:
                done[r["trial_id"]] = (*one(r, *parts), None)
            except Exception as e:  # one bad trial does not end the sweep
                why = f"TimeoutError: cancelled after {limit:.0f} s" if group.cancelled else f"{type(e).__name__}: {e}"
                done[r["trial_id"]] = (None, {}, why)

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        for imputer in dict.fromkeys(r["imputer"] for r in rows):
            mine = [r for r in rows if r["imputer"] == imputer]
            held = []
            try:
                model = fit_imputer(imputer, fit_rows, key)
                valid, test = (part(f, imputer, "none", model) for f in ("valid", "test"))
                held += [valid, test]
                # every balancer of this imputer: trials of all variants share the pool
                jobs = []
                for balancer in dict.fromkeys(r["balancer"] for r in mine):
                    some = [r for r in mine if r["balancer"] == balancer]
                    try:
                        train = part("train", imputer, balancer, model)
                    except Exception as e:
                        done.update({r["trial_id"]: (None, {}, f"{type(e).__name__}: {e}") for r in some})
                        continue
                    held.append(train)
                    jobs += [pool.submit(attempt, r, train, valid, test) for r in some]
                for j in jobs:
                    j.result()
            except Exception as e:
                done.update({r["trial_id"]: (None, {}, f"{type(e).__name__}: {e}") for r in mine if r["trial_id"] not in done})
            finally:
                for h in held:
                    h.unpersist()
    out_rows = [(r["trial_id"], r["imputer"], r["balancer"],
                 float(m[primary_metric]) if m.get(primary_metric) is not None else None,
                 {k: float(v) for k, v in m.items()}, error) for r in rows for _model, m, error in [done[r["trial_id"]]]]
    table = spark.createDataFrame(out_rows, "trial_id long, imputer string, balancer string, score double, "
                                            "metrics map<string,double>, error string")
    base.unpersist()
    return table, {tid: (model, m) for tid, (model, m, error) in done.items() if error is None}


def best_trial(trials: DataFrame, score: str = "score") -> DataFrame:
    """W-05: the maximum score, ties by the smaller trial id."""
    return trials.where(F.col(score).isNotNull()).orderBy(F.desc(score), F.asc("trial_id")).limit(1)


def sweep_summary(trials: DataFrame, tags: DataFrame | None = None, score: str = "score") -> DataFrame:
    """M-07: one row -- best id, ordered id/score/imputer/balancer lists and the
    distinct imputer and balancer counts. With ``tags`` (trial_id, imputer,
    balancer) the lists come from a join on trial id (J-04)."""
    t = trials.select("trial_id", score) if tags is not None else trials
    if tags is not None:
        t = t.join(tags, "trial_id", "left")
    agg = t.agg(
        # best: largest score, ties by the smaller trial id
        F.max_by("trial_id", F.struct(F.col(score), (-F.col("trial_id")).alias("neg_id"))).alias("best_trial_id"),
        F.sort_array(F.collect_list(F.struct("trial_id", score, "imputer", "balancer"))).alias("__l"),
        F.count_distinct("balancer").alias("num_balancer"),
        F.count_distinct("imputer").alias("num_imputer"))
    return agg.select(
        "best_trial_id",
        F.transform("__l", lambda s: s["trial_id"]).alias("sweep_run_ids"),
        F.transform("__l", lambda s: s[score]).alias("sweep_primary_metric"),
        F.transform("__l", lambda s: s["balancer"]).alias("sweep_balancer"),
        F.transform("__l", lambda s: s["imputer"]).alias("sweep_imputer"),
        "num_balancer", "num_imputer")
