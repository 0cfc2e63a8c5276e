"""DuckDB oracle SQL for the registered queries; column names match exactly.
Views ``orders customer ...`` are the given tables."""

from __future__ import annotations

from tabforge.functions.hashing import u_sql_duckdb
from tabforge.operators.split import fold_bounds
from tabforge.sources.fixtures import FX_ORDERS_SQL, FX_TRIALS_SQL

ORACLES: dict[str, str] = {}

R = 6
NUM = ["o_totalprice", "acctbal", "custkey", "const_col", "mostly_null", "price_twin"]
T_TEST, T_VALID = fold_bounds()


def _clean_orders_cte() -> str:
    cols = []
    for c in ["ID", "o_totalprice", "acctbal", "custkey", "o_orderdate", "mktsegment", "o_orderstatus",
              "const_col", "mostly_null", "price_twin", "label"]:
        if c in NUM:
            cols.append(f"CASE WHEN isfinite({c}) THEN {c} END AS {c}")
        else:
            cols.append(c)
    return f"fx AS ({FX_ORDERS_SQL}), fxc AS (SELECT {', '.join(cols)} FROM fx)"


def _folds_cte() -> str:
    uu = u_sql_duckdb("ID", 42)
    return (f"{_clean_orders_cte()}, fxf AS (SELECT *, CASE WHEN {uu} < {T_TEST} THEN 'test' "
            f"WHEN {uu} < {T_VALID} THEN 'valid' ELSE 'train' END AS fold FROM fxc)")


def _standardize() -> str:
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in NUM)
    scaled = ", ".join(
        f"round(({c} - m_{c}) / CASE WHEN s_{c} IS NULL OR s_{c} = 0 THEN 1 ELSE s_{c} END, {R}) AS {c}"
        for c in NUM)
    return (f"WITH {_folds_cte()}, st AS (SELECT {stats} FROM fxf WHERE fold = 'train') "
            f"SELECT ID, fold, label, {scaled} FROM fxf, st")


ORACLES["i03_standardize"] = _standardize()

ORACLES["p01_sanitize_columns"] = """
SELECT o_orderkey AS oorderkey, o_custkey AS ocustkey, o_orderstatus AS o_orderstatus,
       o_totalprice AS o_totalprice, o_orderpriority AS oorderpriority
FROM orders"""

ORACLES["p02_cast_columns"] = f"""
WITH fx AS ({FX_ORDERS_SQL})
SELECT ID, CAST(custkey AS BIGINT) AS custkey, CAST(label AS DOUBLE) AS label, o_orderstatus FROM fx"""

ORACLES["p03_nonfinite_to_null"] = f"WITH {_clean_orders_cte()} SELECT ID, o_totalprice, acctbal, mostly_null FROM fxc"

ORACLES["p04_duplicate_keys"] = """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""

ORACLES["p05_label_encode"] = """
SELECT o_orderkey AS ID, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS label FROM orders"""

ORACLES["p07_replace_values"] = f"""
WITH fx AS ({FX_ORDERS_SQL})
SELECT ID,
       CASE WHEN mktsegment = 'BUILDING' THEN 'BLDG' WHEN mktsegment = 'MACHINERY' THEN 'MACH' ELSE mktsegment END
         AS mktsegment,
       CASE WHEN o_orderstatus = 'F' THEN 'FINISHED' ELSE o_orderstatus END AS o_orderstatus
FROM fx"""

ORACLES["p08_keep_numeric"] = (f"WITH {_clean_orders_cte()} SELECT ID, o_totalprice, acctbal, custkey, const_col, "
                               "mostly_null, price_twin, label FROM fxc")

ORACLES["p09_strip_commas"] = "SELECT doc_id, replace(text, ',', ' ') AS text, replace(lang, ',', ' ') AS lang FROM documents"

ORACLES["p10_select_columns"] = f"WITH fx AS ({FX_ORDERS_SQL}) SELECT ID, mktsegment, label FROM fx"

ORACLES["p11_select_complement"] = (f"WITH fx AS ({FX_ORDERS_SQL}) SELECT ID, o_totalprice, acctbal, custkey, "
                                    "const_col, mostly_null, price_twin, label FROM fx")

ORACLES["p12_split_roles"] = (f"WITH {_clean_orders_cte()} SELECT ID, o_totalprice, acctbal, custkey, mktsegment, "
                              "o_orderstatus, mostly_null, price_twin FROM fxc")

_ALL_FX = ["ID", "o_totalprice", "acctbal", "custkey", "o_orderdate", "mktsegment", "o_orderstatus",
           "const_col", "mostly_null", "price_twin", "label"]

ORACLES["a01_profile"] = (f"WITH fx AS ({FX_ORDERS_SQL}), p AS (SELECT 'dataframe rows' AS metric, count(*) AS value FROM fx "
                          + "".join(f"UNION ALL SELECT 'missing.{c}', count(*) FILTER (WHERE {c} IS NULL) FROM fx "
                                    for c in _ALL_FX)
                          + ") SELECT metric, CAST(value AS BIGINT) AS value FROM p "
                            "WHERE metric = 'dataframe rows' OR value > 0")

ORACLES["a04_preview"] = (f"WITH {_clean_orders_cte()} SELECT ID, o_totalprice, mktsegment, label FROM fxc "
                          "ORDER BY ID LIMIT 5")

ORACLES["a05_column_means"] = (f"WITH {_clean_orders_cte()} "
                               + " UNION ALL ".join(f"SELECT 'stats.{c}_mean' AS metric, round(avg({c}), {R}) AS value FROM fxc"
                                                    for c in NUM + ["label"]))

ORACLES["a06_column_modes"] = (f"WITH {_clean_orders_cte()} "
                               + " UNION ALL ".join(
                                   f"SELECT 'stats.{c}_mode' AS metric, (SELECT {c} FROM fxc WHERE {c} IS NOT NULL "
                                   f"GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS value"
                                   for c in ["mktsegment", "o_orderstatus"]))

ORACLES["a08_class_counts"] = (f"WITH {_folds_cte()} SELECT 'y_' || fold || '_' || CAST(label AS VARCHAR) AS metric, "
                               "count(*) AS value FROM fxf GROUP BY fold, label")

ORACLES["b00_assign_folds"] = f"WITH {_folds_cte()} SELECT ID, fold, label FROM fxf"


def _exact_folds() -> str:
    uu = u_sql_duckdb("ID", 42)
    return f"""
WITH fx AS ({FX_ORDERS_SQL}),
     n AS (SELECT count(*) AS n FROM fx),
     k AS (SELECT CAST(ceil(0.33 * n) AS BIGINT) AS n_test FROM n),
     k2 AS (SELECT n_test, CAST(ceil(0.15 * (n - n_test)) AS BIGINT) AS n_valid FROM k, n),
     rk AS (SELECT ID, label, row_number() OVER (ORDER BY {uu}, ID) - 1 AS rn FROM fx)
SELECT ID, label, CASE WHEN rn < n_test THEN 'test' WHEN rn < n_test + n_valid THEN 'valid' ELSE 'train' END AS fold
FROM rk, k2"""


ORACLES["b00_exact_folds"] = _exact_folds()

ORACLES["b01_downsample"] = f"""
WITH fx AS ({FX_ORDERS_SQL}),
     c AS (SELECT min(n) AS n_min FROM (SELECT label, count(*) AS n FROM fx GROUP BY label)),
     rk AS (SELECT ID, label, row_number() OVER (PARTITION BY label ORDER BY {u_sql_duckdb('ID', 'downsample')}, ID) AS rn
            FROM fx)
SELECT ID, label FROM rk, c WHERE rn <= n_min"""


ORACLES["b01_downsample_folds"] = f"""
WITH {_folds_cte()},
     c AS (SELECT fold, min(n) AS n_min FROM (SELECT fold, label, count(*) AS n FROM fxf GROUP BY fold, label) GROUP BY fold),
     rk AS (SELECT ID, fold, label, row_number() OVER (PARTITION BY fold, label ORDER BY {u_sql_duckdb('ID', 'downsample')}, ID) AS rn
            FROM fxf)
SELECT ID, rk.fold, CAST(label AS INTEGER) AS label FROM rk JOIN c ON rk.fold = c.fold WHERE rn <= n_min"""

ORACLES["j01_attach_label"] = f"WITH fx AS ({FX_ORDERS_SQL}) SELECT ID, o_orderstatus, label FROM fx"


# ---------------------------------------------------------------- D-*
# Feature order of the fx_orders plan (identity in column order,
# categoricals one-hot in place ranked by train count, then IS_NULL, WEEKDAY,
# IS_NULL(WEEKDAY)).
SEGMENTS = ["HOUSEHOLD", "MACHINERY", "AUTOMOBILE", "FURNITURE", "BUILDING"]
STATUSES = ["P", "O", "F"]
BASE_COLS = ["o_totalprice", "acctbal", "custkey", "o_orderdate", "mktsegment", "o_orderstatus",
             "const_col", "mostly_null", "price_twin"]


def _q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def orders_feature_exprs() -> list[tuple[str, str, str]]:
    """(name, DuckDB expression, type) in plan order."""
    out = []
    for c in BASE_COLS:
        if c == "mktsegment":
            out += [(f"mktsegment = {v}", f"coalesce(mktsegment = '{v}', false)", "boolean") for v in SEGMENTS]
            out.append(("mktsegment is unknown",
                        "(mktsegment IS NULL OR mktsegment NOT IN (" + ", ".join(f"'{v}'" for v in SEGMENTS) + "))",
                        "boolean"))
        elif c == "o_orderstatus":
            out += [(f"o_orderstatus = {v}", f"coalesce(o_orderstatus = '{v}', false)", "boolean") for v in STATUSES]
            out.append(("o_orderstatus is unknown",
                        "(o_orderstatus IS NULL OR o_orderstatus NOT IN (" + ", ".join(f"'{v}'" for v in STATUSES) + "))",
                        "boolean"))
        elif c == "o_orderdate":
            out.append((c, c, "datetime"))
        else:
            out.append((c, c, "numeric"))
    out += [(f"IS_NULL({c})", f"({c} IS NULL)", "boolean") for c in BASE_COLS]
    out.append(("WEEKDAY(o_orderdate)", "CAST(isodow(o_orderdate) - 1 AS INTEGER)", "numeric"))
    out.append(("IS_NULL(WEEKDAY(o_orderdate))", "(o_orderdate IS NULL)", "boolean"))
    return out


def _dfs_all() -> str:
    cols = ", ".join(f"{e} AS {_q(n)}" for n, e, t in orders_feature_exprs() if t != "datetime")
    return f"WITH {_folds_cte()} SELECT ID, fold, {cols} FROM fxf"


ORACLES["d01_dfs_features"] = _dfs_all()


def _one_hot() -> str:
    uu = u_sql_duckdb("p_partkey", 42)
    parts = []
    for c, e in [("p_brand", "p_brand"), ("p_size", "CAST(p_size AS VARCHAR)")]:
        parts.append(f"""
  {c}_top AS (SELECT v, row_number() OVER (ORDER BY n DESC, v) AS rk FROM
      (SELECT {e} AS v, count(*) AS n FROM pf WHERE fold = 'train' AND {e} IS NOT NULL GROUP BY v) QUALIFY rk <= 10),
  {c}_long AS (
      SELECT pf.ID, '{c} = ' || t.v AS feature, coalesce({e} = t.v, false) AS flag FROM pf, {c}_top t
      UNION ALL
      SELECT pf.ID, '{c} is unknown' AS feature,
             ({e} IS NULL OR {e} NOT IN (SELECT v FROM {c}_top)) AS flag FROM pf)""")
    return (f"WITH pf AS (SELECT p_partkey AS ID, p_brand, p_size, CASE WHEN {uu} < {T_TEST} THEN 'test' "
            f"WHEN {uu} < {T_VALID} THEN 'valid' ELSE 'train' END AS fold FROM part),"
            + ",".join(parts) + " SELECT * FROM p_brand_long UNION ALL SELECT * FROM p_size_long")


ORACLES["d05_one_hot"] = _one_hot()


def _prune() -> str:
    feats = orders_feature_exprs()
    stats = ["count(*) AS n"]
    for i, (n, e, t) in enumerate(feats):
        stats += [f"count({e}) AS c{i}", f"min({e}) AS lo{i}", f"max({e}) AS hi{i}"]
    low = {i: f"(c{i} = 0 OR (lo{i} = hi{i} AND c{i} = n))" for i in range(len(feats))}
    num = [i for i, (n, e, t) in enumerate(feats) if t in ("numeric", "boolean")]
    corr = [f"corr(CAST({feats[a][1]} AS DOUBLE), CAST({feats[b][1]} AS DOUBLE)) AS r{a}_{b}"
            for ii, a in enumerate(num) for b in num[:ii]]
    rows = []
    for ii, i in enumerate(num + [k for k in range(len(feats)) if k not in num]):
        name = feats[i][0]
        if i in num:
            earlier = [j for j in num if j < i]
            conds = [f"(NOT {low[j]} AND coalesce(NOT isnan(r{i}_{j}) AND abs(r{i}_{j}) >= 0.95, false))"
                     for j in earlier]
            d08 = "(" + " OR ".join(conds) + ")" if conds else "false"
        else:
            d08 = "false"
        reason = (f"CASE WHEN {low[i]} THEN 'low_information' WHEN {d08} THEN 'highly_correlated' "
                  f"WHEN (n - c{i}) / n >= 0.95 THEN 'highly_null' "
                  f"WHEN (c{i} = 0 OR lo{i} = hi{i}) THEN 'single_value' ELSE 'kept' END")
        rows.append(f"SELECT '{name}' AS feature, {reason} AS reason FROM st, cr")
    return (f"WITH {_folds_cte()}, tr AS (SELECT * FROM fxf WHERE fold = 'train'), "
            f"st AS (SELECT {', '.join(stats)} FROM tr), cr AS (SELECT {', '.join(corr)} FROM tr), "
            f"dec AS ({' UNION ALL '.join(rows)}) SELECT feature, reason = 'kept' AS kept, reason FROM dec")


ORACLES["d07_prune_features"] = _prune()

# Survivors of the d07 decisions on fx_orders (the same at sf0.001,
# sf0.01 and sf0.1); the datetime identity is left out of the output.
PRUNED_KEPT = ["o_totalprice", "acctbal", "custkey"] + [f"mktsegment = {v}" for v in SEGMENTS] + [
    "mktsegment is unknown"] + [f"o_orderstatus = {v}" for v in STATUSES] + [
    "IS_NULL(o_totalprice)", "IS_NULL(acctbal)", "IS_NULL(mostly_null)", "WEEKDAY(o_orderdate)"]


def _replay(kept: list[str]) -> str:
    exprs = {n: e for n, e, t in orders_feature_exprs()}
    cols = ", ".join(f"{exprs[n]} AS {_q(n)}" for n in kept)
    return f"WITH {_folds_cte()} SELECT ID, {cols} FROM fxf WHERE fold = 'test'"


ORACLES["d06_replay_plan"] = _replay(PRUNED_KEPT)

# ---------------------------------------------------------------- W-*
_EV = "SELECT event_id, user_id, ts, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value FROM events"

ORACLES["w01_cumulative_sum"] = f"""
WITH ev AS ({_EV})
SELECT event_id, user_id,
       round(CASE WHEN value IS NOT NULL THEN coalesce(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) END, 6) AS cum_value
FROM ev"""

ORACLES["w01_cumulative_sum_global"] = f"""
WITH ev AS ({_EV})
SELECT event_id,
       round(CASE WHEN value IS NOT NULL THEN sum(value) OVER (ORDER BY event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END, 4) AS cum_value
FROM ev"""

ORACLES["w02_percent_change"] = f"""
WITH ev AS ({_EV}), l AS (
  SELECT event_id, user_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM ev)
SELECT event_id, user_id,
       round(CASE WHEN prev IS NULL OR prev = 0 THEN NULL ELSE (value - prev) / prev END, 6) AS pct_change
FROM l"""

ORACLES["w03_top_values"] = """
SELECT value, count, CAST(row_number() OVER (ORDER BY count DESC, value) AS INTEGER) AS rank FROM (
  SELECT p_brand AS value, count(*) AS count FROM part WHERE p_brand IS NOT NULL GROUP BY p_brand
  ORDER BY count DESC, value LIMIT 10)"""

ORACLES["w04_top_ranked"] = """
SELECT 'feature_rank_' || CAST(row_number() OVER (ORDER BY importance DESC, name) - 1 AS VARCHAR) AS metric,
       name AS value
FROM (SELECT p_brand AS name, round(avg(p_retailprice), 2) AS importance FROM part GROUP BY p_brand
      ORDER BY importance DESC, name LIMIT 20)"""

ORACLES["w05_best_trial"] = f"""
WITH t AS ({FX_TRIALS_SQL}) SELECT * FROM t ORDER BY score DESC, trial_id LIMIT 1"""


# ---------------------------------------------------------------- J-02, I-01, I-02
from tabforge.sources.fixtures import fx_vectors_sql  # noqa: E402


def _knn(k: int, within_class: bool, order: str = "distance") -> str:
    same = "AND a.label = b.label" if within_class else ""
    return f"""
WITH v AS (SELECT vec_id AS ID, embedding, CASE WHEN label = 0 THEN 1 ELSE 0 END AS label FROM embeddings),
pairs AS (
  SELECT a.ID AS query_id, b.ID AS donor_id,
         sqrt(list_sum(list_transform(list_zip(a.embedding, b.embedding),
              lambda z: (CAST(z[1] AS DOUBLE) - CAST(z[2] AS DOUBLE)) * (CAST(z[1] AS DOUBLE) - CAST(z[2] AS DOUBLE)))))
           AS distance
  FROM v a JOIN v b ON a.ID <> b.ID {same}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY {order}, donor_id) AS rank FROM pairs)
SELECT query_id, donor_id, CAST(rank AS INTEGER) AS rank, round(distance, {R}) AS distance FROM ranked
WHERE rank <= {k}"""


ORACLES["j02_knn_join"] = _knn(5, False)
ORACLES["j02_knn_join_blocked"] = _knn(5, False)
ORACLES["j02_knn_within_class"] = _knn(3, True)

ORACLES["i01_mean_impute"] = (
    f"WITH {_folds_cte()}, m AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}" for c in NUM)
    + " FROM fxf WHERE fold = 'train') SELECT ID, fold, "
    + ", ".join(f"round(coalesce({c}, m_{c}), {R}) AS {c}" for c in NUM) + " FROM fxf, m")


def _knn_impute() -> str:
    cols = ", ".join(f"d{j}" for j in range(64))
    return f"""
WITH v AS ({fx_vectors_sql(missing=True)}),
long AS (SELECT ID, j, x FROM (SELECT ID, unnest(range(64)) AS j, unnest([{cols}]) AS x FROM v)),
pairs AS (
  SELECT a.ID AS q, b.ID AS d,
         sum(CASE WHEN a.x IS NOT NULL AND b.x IS NOT NULL THEN (a.x - b.x) * (a.x - b.x) END) AS ss,
         count(CASE WHEN a.x IS NOT NULL AND b.x IS NOT NULL THEN 1 END) AS n
  FROM long a JOIN long b ON a.j = b.j AND a.ID <> b.ID GROUP BY a.ID, b.ID),
dist AS (SELECT q, d, sqrt(ss * 64.0 / n) AS dist FROM pairs WHERE n > 0),
miss AS (SELECT ID AS q, j FROM long WHERE x IS NULL),
cand AS (
  SELECT m.q, m.j, dd.d, dd.dist, b.x,
         row_number() OVER (PARTITION BY m.q, m.j ORDER BY dd.dist, dd.d) AS rk
  FROM miss m JOIN dist dd ON dd.q = m.q JOIN long b ON b.ID = dd.d AND b.j = m.j AND b.x IS NOT NULL),
means AS (SELECT j, avg(x) AS mx FROM long GROUP BY j),
imp AS (SELECT q, j, avg(x) AS value FROM cand WHERE rk <= 5 GROUP BY q, j)
SELECT m.q AS ID, 'd' || CAST(m.j AS VARCHAR) AS feature, round(coalesce(i.value, mm.mx), {R}) AS value
FROM miss m LEFT JOIN imp i ON i.q = m.q AND i.j = m.j JOIN means mm ON mm.j = m.j"""


ORACLES["i02_knn_impute"] = _knn_impute()


# ---------------------------------------------------------------- B-02 ... B-13
from tabforge.sources.fixtures import FX_TOXIC_SQL  # noqa: E402

TX = ["n_chars", "n_spaces", "n_dots"]


def _u(expr: str, salt: str) -> str:
    return u_sql_duckdb(expr, salt)


def _dist(a: str, b: str, cols=TX) -> str:
    return " + ".join(f"({a}.{c} - {b}.{c}) * ({a}.{c} - {b}.{c})" for c in cols)


_TX_BASE = f"""
t AS ({FX_TOXIC_SQL}),
x AS (SELECT ID, n_chars, n_spaces, n_dots, label, lang, source FROM t),
cnt AS (SELECT label, count(*) AS n FROM x GROUP BY label),
mx AS (SELECT max(n) AS n_max FROM cnt)"""


def _orig(cols=TX, extra="") -> str:
    return (f"SELECT ID, label, {', '.join(f'round({c}, {R}) AS {c}' for c in cols)}{extra}, "
            "false AS is_synthetic, CAST(NULL AS VARCHAR) AS draw_id FROM x")


def _knn_sql(name: str, q_where: str, d_where: str, k: int, same_class: bool, dist: str | None = None,
             exclude_self: bool = True, farthest: bool = False) -> str:
    dist = dist or f"sqrt({_dist('a', 'b')})"
    conds = ["a.ID <> b.ID"] if exclude_self else ["true"]
    if same_class:
        conds.append("a.label = b.label")
    order = "distance DESC" if farthest else "distance"
    return f"""
{name} AS (SELECT * FROM (
  SELECT a.ID AS query_id, b.ID AS donor_id, {dist} AS distance,
         row_number() OVER (PARTITION BY a.ID ORDER BY {dist} {'DESC' if farthest else ''}, b.ID) AS rank
  FROM x a JOIN x b ON {' AND '.join(conds)} WHERE {q_where} AND {d_where}) WHERE rank <= {k})"""


def _interp_sql(draws: str, seed: str, kexpr: str, nn: str, cols=TX) -> str:
    """draws(label, draw_id, base_id, kk) -> synthetic rows."""
    feats = ", ".join(f"round(b.{c} + d.gap * (nb.{c} - b.{c}), {R}) AS {c}" for c in cols)
    return f"""
syn AS (
  SELECT CAST(NULL AS BIGINT) AS ID, d.label, {feats}, true AS is_synthetic, d.draw_id
  FROM (SELECT *, CAST(1 + floor({_u('draw_id', seed + ':nn')} * {kexpr}) AS BIGINT) AS nrank,
               {_u('draw_id', seed + ':gap')} AS gap FROM {draws}) d
  JOIN x b ON b.ID = d.base_id
  JOIN {nn} ON {nn}.query_id = d.base_id AND {nn}.rank = d.nrank
  JOIN x nb ON nb.ID = {nn}.donor_id)"""


_DRAWS = """
dr AS (SELECT c.label, c.n, unnest(range(mx.n_max - c.n)) AS j FROM cnt c, mx WHERE c.n < mx.n_max AND c.n >= 2),
dr2 AS (SELECT label, n, CAST(label AS VARCHAR) || ':' || CAST(j AS VARCHAR) AS draw_id FROM dr),
idx AS (SELECT ID, label, row_number() OVER (PARTITION BY label ORDER BY ID) - 1 AS idx FROM x)"""


def _ros() -> str:
    return f"""
WITH {_TX_BASE}, {_DRAWS}
{_orig()}
UNION ALL
SELECT CAST(NULL AS BIGINT) AS ID, d.label, {', '.join(f'round(i2.{c}, {R}) AS {c}' for c in TX)},
       true AS is_synthetic, d.draw_id
FROM dr2 d JOIN idx i ON i.label = d.label AND i.idx = CAST(floor({_u('d.draw_id', 'ros:base')} * d.n) AS BIGINT)
JOIN x i2 ON i2.ID = i.ID"""


ORACLES["b02_random_oversample"] = _ros()


def _smote() -> str:
    return f"""
WITH {_TX_BASE}, {_DRAWS},
minor AS (SELECT c.label FROM cnt c, mx WHERE c.n < mx.n_max AND c.n >= 2),
{_knn_sql('nn', 'a.label IN (SELECT label FROM minor)', 'true', 5, True)[1:]},
db AS (SELECT d.label, d.draw_id, d.n, i.ID AS base_id FROM dr2 d JOIN idx i ON i.label = d.label
       AND i.idx = CAST(floor({_u('d.draw_id', 'smote:base')} * d.n) AS BIGINT)),
{_interp_sql('db', 'smote', 'least(5, n - 1)', 'nn')[1:]}
{_orig()}
UNION ALL SELECT * FROM syn"""


ORACLES["b03_smote"] = _smote()


def _smotenc() -> str:
    med = """
sd AS (SELECT stddev_pop(n_chars) AS s1, stddev_pop(n_spaces) AS s2, stddev_pop(n_dots) AS s3 FROM x
       WHERE label = (SELECT label FROM cnt ORDER BY n, CAST(label AS VARCHAR) LIMIT 1)),
md AS (SELECT (CASE WHEN s1 <= s2 AND s2 <= s3 OR s3 <= s2 AND s2 <= s1 THEN s2
                    WHEN s2 <= s1 AND s1 <= s3 OR s3 <= s1 AND s1 <= s2 THEN s1 ELSE s3 END) AS med FROM sd)"""
    dist = (f"sqrt({_dist('a', 'b')} + (SELECT med * med FROM md) * "
            "(CAST(a.lang <> b.lang AS INTEGER) + CAST(a.source <> b.source AS INTEGER)))")
    modes = []
    for c in ["lang", "source"]:
        modes.append(f"""
m_{c} AS (SELECT query_id, v AS {c} FROM (
  SELECT nn.query_id, x.{c} AS v, count(*) AS k,
         row_number() OVER (PARTITION BY nn.query_id ORDER BY count(*) DESC, x.{c}) AS rk
  FROM nn JOIN x ON x.ID = nn.donor_id JOIN cnt c ON c.label = x.label
  WHERE nn.rank <= least(5, c.n - 1) GROUP BY nn.query_id, x.{c}) WHERE rk = 1)""")
    feats = ", ".join(f"round(b.{c} + d.gap * (nb.{c} - b.{c}), {R}) AS {c}" for c in TX)
    return f"""
WITH {_TX_BASE}, {_DRAWS},
minor AS (SELECT c.label FROM cnt c, mx WHERE c.n < mx.n_max AND c.n >= 2),
{med[1:]},
{_knn_sql('nn', 'a.label IN (SELECT label FROM minor)', 'true', 5, True, dist)[1:]},
{','.join(m[1:] for m in modes)},
db AS (SELECT d.label, d.draw_id, d.n, i.ID AS base_id FROM dr2 d JOIN idx i ON i.label = d.label
       AND i.idx = CAST(floor({_u('d.draw_id', 'smote:base')} * d.n) AS BIGINT)),
syn AS (
  SELECT CAST(NULL AS BIGINT) AS ID, d.label, {feats}, ml.lang, ms.source, true AS is_synthetic, d.draw_id
  FROM (SELECT *, CAST(1 + floor({_u('draw_id', 'smote:nn')} * least(5, n - 1)) AS BIGINT) AS nrank,
               {_u('draw_id', 'smote:gap')} AS gap FROM db) d
  JOIN x b ON b.ID = d.base_id
  JOIN nn ON nn.query_id = d.base_id AND nn.rank = d.nrank
  JOIN x nb ON nb.ID = nn.donor_id
  LEFT JOIN m_lang ml ON ml.query_id = d.base_id LEFT JOIN m_source ms ON ms.query_id = d.base_id)
{_orig(extra=', lang, source')}
UNION ALL SELECT * FROM syn"""


ORACLES["b04_smotenc"] = _smotenc()


def _adasyn() -> str:
    return f"""
WITH {_TX_BASE},
minor AS (SELECT c.label, c.n, mx.n_max - c.n AS m FROM cnt c, mx WHERE c.n < mx.n_max AND c.n >= 2),
{_knn_sql('alln', 'a.label IN (SELECT label FROM minor)', 'true', 5, False)[1:]},
oth AS (SELECT q.ID, q.label, count_if(d.label <> q.label) AS n_other
        FROM alln JOIN x q ON q.ID = alln.query_id JOIN x d ON d.ID = alln.donor_id GROUP BY q.ID, q.label),
tot AS (SELECT label, sum(n_other) AS s FROM oth GROUP BY label HAVING sum(n_other) > 0),
quota AS (SELECT o.ID, o.label, mi.n,
                 CAST(round_even(CAST(mi.m AS DOUBLE) * o.n_other / CAST(t.s AS DOUBLE), 0) AS BIGINT) AS q
          FROM oth o JOIN tot t ON t.label = o.label JOIN minor mi ON mi.label = o.label),
dr AS (SELECT ID AS base_id, label, n, unnest(range(q)) AS t FROM quota WHERE q > 0),
db AS (SELECT label, n, base_id, CAST(label AS VARCHAR) || ':' || CAST(base_id AS VARCHAR) || ':' || CAST(t AS VARCHAR)
              AS draw_id FROM dr),
{_knn_sql('nn', 'a.label IN (SELECT label FROM minor)', 'true', 5, True)[1:]},
{_interp_sql('db', 'adasyn', 'least(5, n - 1)', 'nn')[1:]}
{_orig()}
UNION ALL SELECT * FROM syn"""


ORACLES["b06_adasyn"] = _adasyn()


def _borderline() -> str:
    return f"""
WITH {_TX_BASE}, {_DRAWS},
minor AS (SELECT c.label, c.n FROM cnt c, mx WHERE c.n < mx.n_max AND c.n >= 2),
{_knn_sql('alln', 'a.label IN (SELECT label FROM minor)', 'true', 10, False)[1:]},
oth AS (SELECT q.ID, q.label, count_if(d.label <> q.label) AS n_other
        FROM alln JOIN x q ON q.ID = alln.query_id JOIN x d ON d.ID = alln.donor_id GROUP BY q.ID, q.label),
danger AS (SELECT ID, label, row_number() OVER (PARTITION BY label ORDER BY ID) - 1 AS didx,
                  count(*) OVER (PARTITION BY label) AS nd
           FROM oth WHERE n_other >= 5 AND n_other < 10),
{_knn_sql('nn', 'a.label IN (SELECT label FROM minor)', 'true', 5, True)[1:]},
db AS (SELECT d.label, d.draw_id, d.n, g.ID AS base_id FROM dr2 d
       JOIN (SELECT DISTINCT label, nd FROM danger) dn ON dn.label = d.label
       JOIN danger g ON g.label = d.label AND g.didx = CAST(floor({_u('d.draw_id', 'borderline:base')} * dn.nd) AS BIGINT)),
{_interp_sql('db', 'borderline', 'least(5, n - 1)', 'nn')[1:]}
{_orig()}
UNION ALL SELECT * FROM syn"""


ORACLES["b07_borderline_smote"] = _borderline()


def _near_miss(version: int) -> str:
    mino = "(SELECT label FROM cnt ORDER BY n, CAST(label AS VARCHAR) LIMIT 1)"
    head = f"""
WITH {_TX_BASE},
mn AS (SELECT {mino} AS label, (SELECT min(n) FROM cnt) AS n_min)"""
    if version in (1, 2):
        knn = _knn_sql("nn", "a.label <> (SELECT label FROM mn)", "b.label = (SELECT label FROM mn)", 3, False,
                       exclude_self=False, farthest=(version == 2))
        pool = "x"
        order = "sc.score, p.ID"
    else:
        short = _knn_sql("sl", "a.label = (SELECT label FROM mn)", "b.label <> (SELECT label FROM mn)", 3, False,
                         exclude_self=False)
        knn = short + ",\nslx AS (SELECT x.* FROM x WHERE ID IN (SELECT donor_id FROM sl))," + _knn_sql(
            "nn", "a.ID IN (SELECT donor_id FROM sl)", "b.label = (SELECT label FROM mn)", 3, False,
            exclude_self=False)
        pool = "slx"
        order = "-sc.score, p.ID"
    return f"""{head},{knn[1:] if version != 3 else knn[1:]},
sc AS (SELECT query_id AS ID, round(avg(distance), 9) AS score FROM nn GROUP BY query_id),
kept AS (SELECT p.ID, p.label, row_number() OVER (PARTITION BY p.label ORDER BY {order}) AS rk
         FROM {pool} p JOIN sc ON sc.ID = p.ID WHERE p.label <> (SELECT label FROM mn))
SELECT ID, label FROM x WHERE label = (SELECT label FROM mn)
UNION ALL SELECT ID, label FROM kept WHERE rk <= (SELECT n_min FROM mn)"""


ORACLES["b09_near_miss_1"] = _near_miss(1)
ORACLES["b10_near_miss_2"] = _near_miss(2)
ORACLES["b11_near_miss_3"] = _near_miss(3)


def _vote_sql(nn: str, name: str) -> str:
    return f"""
{name} AS (SELECT query_id, lbl AS pred FROM (
  SELECT {nn}.query_id, d.label AS lbl, row_number() OVER (PARTITION BY {nn}.query_id ORDER BY count(*) DESC, d.label) AS rk
  FROM {nn} JOIN x d ON d.ID = {nn}.donor_id GROUP BY {nn}.query_id, d.label) WHERE rk = 1)"""


def _ncr() -> str:
    mino = "(SELECT label FROM cnt ORDER BY n, CAST(label AS VARCHAR) LIMIT 1)"
    return f"""
WITH {_TX_BASE},
mn AS (SELECT {mino} AS label),
{_knn_sql('nn', 'true', 'true', 3, False)[1:]},
{_vote_sql('nn', 'vt')[1:]},
wrong AS (SELECT x.ID, x.label FROM vt JOIN x ON x.ID = vt.query_id WHERE vt.pred <> x.label),
drops AS (SELECT ID FROM wrong WHERE label <> (SELECT label FROM mn)
          UNION SELECT nn.donor_id FROM nn JOIN wrong w ON w.ID = nn.query_id AND w.label = (SELECT label FROM mn)
                JOIN x d ON d.ID = nn.donor_id WHERE d.label <> (SELECT label FROM mn))
SELECT ID, label FROM x WHERE ID NOT IN (SELECT ID FROM drops)"""


ORACLES["b12_neighbourhood_cleaning"] = _ncr()


def _oss() -> str:
    mino = "(SELECT label FROM cnt ORDER BY n, CAST(label AS VARCHAR) LIMIT 1)"
    d = f"sqrt({_dist('a', 'b')})"
    return f"""
WITH {_TX_BASE},
mn AS (SELECT {mino} AS label),
seed AS (SELECT ID FROM x WHERE label <> (SELECT label FROM mn) ORDER BY {_u('ID', 'oss')}, ID LIMIT 1),
pool AS (SELECT * FROM x WHERE label = (SELECT label FROM mn) OR ID IN (SELECT ID FROM seed)),
nn1 AS (SELECT * FROM (SELECT a.ID AS query_id, b.ID AS donor_id, b.label AS dl,
        row_number() OVER (PARTITION BY a.ID ORDER BY {d}, b.ID) AS rank
        FROM x a JOIN pool b ON a.ID <> b.ID WHERE a.label <> (SELECT label FROM mn)) WHERE rank = 1),
s AS (SELECT * FROM pool UNION SELECT x.* FROM x JOIN nn1 ON nn1.query_id = x.ID
      WHERE nn1.dl = (SELECT label FROM mn) AND x.ID NOT IN (SELECT ID FROM seed)),
t1 AS (SELECT * FROM (SELECT a.ID AS qa, b.ID AS qb, a.label AS la, b.label AS lb,
       row_number() OVER (PARTITION BY a.ID ORDER BY {d}, b.ID) AS rank
       FROM s a JOIN s b ON a.ID <> b.ID) WHERE rank = 1),
links AS (SELECT p.qa, p.la FROM t1 p JOIN t1 q ON p.qa = q.qb AND p.qb = q.qa WHERE p.la <> p.lb)
SELECT ID, label FROM s WHERE ID NOT IN (SELECT qa FROM links WHERE la <> (SELECT label FROM mn))"""


ORACLES["b13_one_sided_selection"] = _oss()


def _smoten() -> str:
    probs = []
    for f in ["lang", "source"]:
        probs.append(f"""
p_{f} AS (SELECT {f} AS v, label, CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER (PARTITION BY {f}) AS DOUBLE) AS p
          FROM x GROUP BY {f}, label)""")
    joins = " ".join(
        f"LEFT JOIN p_{f} {f}{c} ON {f}{c}.v = x.{f} AND {f}{c}.label = {c}" for f in ["lang", "source"] for c in (0, 1))
    pcols = ", ".join(f"coalesce({f}{c}.p, 0.0) AS p_{f}{c}" for f in ["lang", "source"] for c in (0, 1))
    delta = " + ".join(
        f"(abs(a.p_{f}0 - b.p_{f}0) + abs(a.p_{f}1 - b.p_{f}1)) * (abs(a.p_{f}0 - b.p_{f}0) + abs(a.p_{f}1 - b.p_{f}1))"
        for f in ["lang", "source"])
    modes = []
    for c in ["lang", "source"]:
        modes.append(f"""
m_{c} AS (SELECT query_id, v AS {c} FROM (
  SELECT nn.query_id, x.{c} AS v,
         row_number() OVER (PARTITION BY nn.query_id ORDER BY count(*) DESC, x.{c}) AS rk
  FROM nn JOIN x ON x.ID = nn.donor_id JOIN cnt c ON c.label = x.label
  WHERE nn.rank <= least(5, c.n - 1) GROUP BY nn.query_id, x.{c}) WHERE rk = 1)""")
    return f"""
WITH t AS ({FX_TOXIC_SQL}),
x0 AS (SELECT ID, lang, source, label FROM t),
cnt AS (SELECT label, count(*) AS n FROM x0 GROUP BY label),
mx AS (SELECT max(n) AS n_max FROM cnt),
x AS (SELECT * FROM x0),
{','.join(p[1:] for p in probs)},
xp AS (SELECT x.ID, x.label, {pcols} FROM x {joins}),
minor AS (SELECT c.label FROM cnt c, mx WHERE c.n < mx.n_max AND c.n >= 2),
nn AS (SELECT * FROM (
  SELECT a.ID AS query_id, b.ID AS donor_id,
         row_number() OVER (PARTITION BY a.ID ORDER BY {delta}, b.ID) AS rank
  FROM xp a JOIN xp b ON a.ID <> b.ID AND a.label = b.label WHERE a.label IN (SELECT label FROM minor))
  WHERE rank <= 5),
{_DRAWS[1:]},
{','.join(m[1:] for m in modes)},
db AS (SELECT d.label, d.draw_id, d.n, i.ID AS base_id FROM dr2 d JOIN idx i ON i.label = d.label
       AND i.idx = CAST(floor({_u('d.draw_id', 'smote:base')} * d.n) AS BIGINT))
SELECT ID, label, lang, source, false AS is_synthetic, CAST(NULL AS VARCHAR) AS draw_id FROM x
UNION ALL
SELECT CAST(NULL AS BIGINT), d.label, ml.lang, ms.source, true, d.draw_id
FROM db d LEFT JOIN m_lang ml ON ml.query_id = d.base_id LEFT JOIN m_source ms ON ms.query_id = d.base_id"""


ORACLES["b05_smoten"] = _smoten()


# ---------------------------------------------------------------- A-10 ... A-12, P-16, M-07
from tabforge.sources.fixtures import fx_scores_sql  # noqa: E402

ORACLES["a10_classification_report"] = f"""
WITH s AS ({fx_scores_sql()}),
cm AS (SELECT label AS y, yhat, count(*) AS n FROM s GROUP BY label, yhat),
cls AS (SELECT y AS c FROM cm UNION SELECT yhat FROM cm),
per AS (SELECT c.c,
          coalesce((SELECT sum(n) FROM cm WHERE y = c.c AND yhat = c.c), 0) AS tp,
          coalesce((SELECT sum(n) FROM cm WHERE y = c.c), 0) AS support,
          coalesce((SELECT sum(n) FROM cm WHERE yhat = c.c), 0) AS pred FROM cls c),
pr AS (SELECT c, support, CASE WHEN pred > 0 THEN tp / pred ELSE 0.0 END AS precision,
              CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM per),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1
      FROM pr)
SELECT CAST(c AS VARCHAR) || '_precision' AS metric, round(precision, {R}) AS value FROM f
UNION ALL SELECT CAST(c AS VARCHAR) || '_recall', round(recall, {R}) FROM f
UNION ALL SELECT CAST(c AS VARCHAR) || '_f1-score', round(f1, {R}) FROM f
UNION ALL SELECT CAST(c AS VARCHAR) || '_support', round(CAST(support AS DOUBLE), {R}) FROM f
UNION ALL SELECT 'macro-avg_precision', round(avg(precision), {R}) FROM f
UNION ALL SELECT 'macro-avg_recall', round(avg(recall), {R}) FROM f
UNION ALL SELECT 'macro-avg_f1-score', round(avg(f1), {R}) FROM f
UNION ALL SELECT 'macro-avg_support', round(CAST(sum(support) AS DOUBLE), {R}) FROM f
UNION ALL SELECT 'weighted-avg_precision', round(sum(precision * support) / sum(support), {R}) FROM f
UNION ALL SELECT 'weighted-avg_recall', round(sum(recall * support) / sum(support), {R}) FROM f
UNION ALL SELECT 'weighted-avg_f1-score', round(sum(f1 * support) / sum(support), {R}) FROM f
UNION ALL SELECT 'weighted-avg_support', round(CAST(sum(support) AS DOUBLE), {R}) FROM f"""

ORACLES["a11_neg_rmse"] = (f"WITH s AS ({fx_scores_sql()}) "
                           f"SELECT round(-sqrt(avg((CAST(label AS DOUBLE) - p) * (CAST(label AS DOUBLE) - p))), {R}) AS neg_rmse FROM s")
ORACLES["a12_brier_score"] = (f"WITH s AS ({fx_scores_sql()}) "
                              f"SELECT round(avg((p - CAST(label AS DOUBLE)) * (p - CAST(label AS DOUBLE))), {R}) AS brier FROM s")
ORACLES["p16_classify"] = f"WITH s AS ({fx_scores_sql()}) SELECT ID, CAST(p >= 0.5 AS INTEGER) AS yhat FROM s"

ORACLES["m07_sweep_summary"] = f"""
WITH t AS ({FX_TRIALS_SQL})
SELECT (SELECT trial_id FROM t ORDER BY score DESC, trial_id LIMIT 1) AS best_trial_id,
       count(DISTINCT balancer) AS num_balancer, count(DISTINCT imputer) AS num_imputer,
       CAST(count(*) AS INTEGER) AS n_trials,
       string_agg(CAST(trial_id AS VARCHAR), ',' ORDER BY trial_id) AS run_ids,
       string_agg(balancer, ',' ORDER BY trial_id) AS balancers
FROM t"""


# ---------------------------------------------------------------- R-*, U-*, P-17, S-*
from tabforge.sources.fixtures import FX_RUNS_SQL  # noqa: E402

def _dur_sql() -> str:
    m = "date_diff('microsecond', start_ts, end_ts)"
    q = f"CAST(floor({m} / 600000) AS BIGINT)"
    return (f"CAST(({q} + CASE WHEN ({m} - {q} * 600000) * 2 > 600000 OR (({m} - {q} * 600000) * 2 = 600000 "
            f"AND {q} % 2 = 1) THEN 1 ELSE 0 END) / 100.0 AS DOUBLE)")


_RUNS_END = f"""
runs AS ({FX_RUNS_SQL}),
re AS (SELECT *, start_ts + to_microseconds(CAST(round(metric * 1000000.0) AS BIGINT)) AS end_ts FROM runs)"""

_LONG = f"""{_RUNS_END},
done AS (SELECT * FROM re WHERE status = 'Completed'),
lg AS (
  SELECT run_id, 'JOB_' || job || '.isreused' AS key, CAST(NULL AS DOUBLE) AS num_value, 'False' AS str_value, end_ts, seq FROM done
  UNION ALL SELECT run_id, 'JOB_' || job || '.startTime', NULL, strftime(start_ts, '%Y-%m-%dT%H:%M:%S.%fZ'), end_ts, seq FROM done
  UNION ALL SELECT run_id, 'JOB_' || job || '.duration', {_dur_sql()}, NULL, end_ts, seq FROM done
  UNION ALL SELECT run_id, 'metric', metric, NULL, end_ts, seq FROM done),
mg AS (SELECT run_id, key, arg_max(num_value, (end_ts, seq)) AS num_value, arg_max(str_value, (end_ts, seq)) AS str_value
       FROM lg GROUP BY run_id, key)"""

ORACLES["r01_run_log"] = f"WITH {_LONG[1:]} SELECT run_id, key, round(num_value, {R}) AS num_value, str_value FROM mg"


def _wide() -> str:
    keys = [f"JOB_{j}.{m}" for j in ["click", "purchase", "signup", "view"]
            for m in ["duration", "isreused", "startTime"]] + ["metric"]
    cols = []
    for k in keys:
        if k.endswith(".duration") or k == "metric":
            cols.append(f"round(max(CASE WHEN key = '{k}' THEN num_value END), {R}) AS {_q(k)}")
        else:
            cols.append(f"max(CASE WHEN key = '{k}' THEN str_value END) AS {_q(k)}")
    return (f"WITH {_LONG[1:]} SELECT 'fx_runs' AS experiment, 'False' AS downsample, 'False' AS drop_bools, "
            f"run_id, {', '.join(cols)} FROM mg GROUP BY run_id")


ORACLES["r01_run_row_wide"] = _wide()
ORACLES["r02_duration_minutes"] = f"WITH {_RUNS_END[1:]} SELECT seq, {_dur_sql()} AS duration FROM re"
ORACLES["p17_completed"] = f"WITH runs AS ({FX_RUNS_SQL}) SELECT run_id, job, seq FROM runs WHERE status = 'Completed'"

_PARITY = "date_diff('day', DATE '2024-01-01', CAST(start_ts AS DATE)) % 2"
ORACLES["u01_union_outer"] = f"""
WITH runs AS ({FX_RUNS_SQL})
SELECT run_id, job, seq, status, CAST(NULL AS DOUBLE) AS metric FROM runs WHERE {_PARITY} = 0
UNION ALL SELECT run_id, job, seq, NULL, metric FROM runs WHERE {_PARITY} = 1"""

ORACLES["u03_merge_last_writer"] = (f"WITH {_RUNS_END[1:]} SELECT run_id, job AS key, "
                                    f"round(arg_max(metric, (end_ts, seq)), {R}) AS num_value FROM re GROUP BY run_id, job")

ORACLES["s01_read_delimited"] = """
SELECT o_orderkey AS oorderkey, o_custkey AS ocustkey, o_orderstatus, o_totalprice, o_orderpriority AS oorderpriority
FROM orders"""

ORACLES["s03_stage_roundtrip"] = f"WITH {_folds_cte()} SELECT ID, label FROM fxf WHERE fold = 'test'"


def _toxic_folds_sql() -> str:
    uu = u_sql_duckdb("ID", 42)
    return (f"SELECT ID, label, CASE WHEN {uu} < {T_TEST} THEN 'test' WHEN {uu} < {T_VALID} THEN 'valid' "
            f"ELSE 'train' END AS fold FROM ({FX_TOXIC_SQL}) t")


ORACLES["s06_gold_roundtrip"] = f"SELECT * FROM ({_toxic_folds_sql()}) WHERE fold = 'test'"

ORACLES["s08_registry_tags"] = f"""
WITH t AS ({FX_TRIALS_SQL}),
k AS (SELECT 'imputer____' || imputer AS key FROM t UNION ALL SELECT 'balancer____' || imputer || '_' || lower(balancer) FROM t),
p AS (SELECT string_split(key, '_')[5] AS imputer, string_split(key, '_')[6] AS balancer FROM k)
SELECT (SELECT string_agg(DISTINCT imputer, ',' ORDER BY imputer) FROM p WHERE imputer IS NOT NULL AND imputer <> '') AS imputers,
       (SELECT string_agg(DISTINCT balancer, ',' ORDER BY balancer) FROM p WHERE balancer IS NOT NULL AND balancer <> '') AS balancers"""

_HIST = f"""
WITH runs AS ({FX_RUNS_SQL})
SELECT run_id, job, seq, CASE WHEN {_PARITY} = 1 THEN metric END AS metric FROM runs"""
ORACLES["s11_compact_history"] = _HIST
ORACLES["s12_compact_stream"] = _HIST

ORACLES["x01_custom_primitive"] = ORACLES["w01_cumulative_sum"]
ORACLES["x04_compact"] = _HIST


def _smote_orders() -> str:
    feats = ["o_totalprice", "acctbal", "custkey"]
    base = (f"{_clean_orders_cte()}, m AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}" for c in feats)
            + " FROM fxc), x AS (SELECT ID, " + ", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in feats)
            + ", label FROM fxc, m), cnt AS (SELECT label, count(*) AS n FROM x GROUP BY label), "
            "mx AS (SELECT max(n) AS n_max FROM cnt)")
    d = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in feats)
    feat_out = ", ".join(f"round(b.{c} + d.gap * (nb.{c} - b.{c}), {R}) AS {c}" for c in feats)
    return f"""
WITH {base}, {_DRAWS[1:]},
minor AS (SELECT c.label FROM cnt c, mx WHERE c.n < mx.n_max AND c.n >= 2),
nn AS (SELECT * FROM (
  SELECT a.ID AS query_id, b.ID AS donor_id,
         row_number() OVER (PARTITION BY a.ID ORDER BY sqrt({d}), b.ID) AS rank
  FROM x a JOIN x b ON a.ID <> b.ID AND a.label = b.label WHERE a.label IN (SELECT label FROM minor)) WHERE rank <= 5),
db AS (SELECT d.label, d.draw_id, d.n, i.ID AS base_id FROM dr2 d JOIN idx i ON i.label = d.label
       AND i.idx = CAST(floor({_u('d.draw_id', 'smote:base')} * d.n) AS BIGINT)),
syn AS (
  SELECT CAST(NULL AS BIGINT) AS ID, d.label, {feat_out}, true AS is_synthetic, d.draw_id
  FROM (SELECT *, CAST(1 + floor({_u('draw_id', 'smote:nn')} * least(5, n - 1)) AS BIGINT) AS nrank,
               {_u('draw_id', 'smote:gap')} AS gap FROM db) d
  JOIN x b ON b.ID = d.base_id JOIN nn ON nn.query_id = d.base_id AND nn.rank = d.nrank
  JOIN x nb ON nb.ID = nn.donor_id)
SELECT ID, label, {', '.join(f'round({c}, {R}) AS {c}' for c in feats)}, false AS is_synthetic,
       CAST(NULL AS VARCHAR) AS draw_id FROM x
UNION ALL SELECT * FROM syn"""


ORACLES["b03_smote_orders"] = _smote_orders()
ORACLES["j02_knn_join_partitioned"] = ORACLES["j02_knn_join_pivots"] = ORACLES["j02_knn_join"]
ORACLES["j02_knn_farthest_pivots"] = _knn(3, False, "distance DESC")

ORACLES["p13_align_columns"] = f"WITH {_folds_cte()} SELECT label, ID, price_twin, acctbal FROM fxf WHERE fold = 'test'"
ORACLES["p14_normalize_booleans"] = (f"WITH {_clean_orders_cte()} SELECT ID, coalesce(o_totalprice > 100000, false) AS big, "
                                     "coalesce(mktsegment = 'BUILDING', false) AS building FROM fxc")


def _bundle() -> str:
    c = ["o_totalprice", "acctbal"]
    st = ", ".join(f"avg({x}) AS m_{x}, stddev_pop({x}) AS s_{x}" for x in c)
    sc = ", ".join(f"round(({x} - m_{x}) / CASE WHEN s_{x} IS NULL OR s_{x} = 0 THEN 1 ELSE s_{x} END, {R}) AS {x}"
                   for x in c)
    return (f"WITH {_folds_cte()}, st AS (SELECT {st} FROM fxf WHERE fold = 'train') "
            f"SELECT ID, label, fold, {sc} FROM fxf, st")


ORACLES["s05_bundle_roundtrip"] = _bundle()
ORACLES["s09_write_metrics"] = ORACLES["a01_profile"]
ORACLES["s10_write_run_row"] = f"WITH {_LONG[1:]} SELECT round(num_value, {R}) AS metric FROM mg WHERE key = 'metric'"
ORACLES["i02_knn_impute_partitioned"] = ORACLES["i02_knn_impute_patterns"] = ORACLES["i02_knn_impute"]


def _trial_table() -> str:
    def x(name, lo, hi):
        return f"(CAST({lo} AS DOUBLE) + {u_sql_duckdb('trial_id', name)} * CAST({round(hi - lo, 12)} AS DOUBLE))"

    def pick(name, values):
        return f"[{', '.join(repr(v) for v in values)}][CAST(floor({u_sql_duckdb('trial_id', name)} * {len(values)}) AS INTEGER) + 1]"
    return f"""
WITH t AS (SELECT p_partkey AS trial_id FROM part)
SELECT trial_id, {pick('imputer', ['mean', 'knn'])} AS imputer, {pick('balancer', ['none', 'ros', 'smote'])} AS balancer,
       CAST(round_even({x('max_depth', 5, 20)}, 0) AS INTEGER) AS max_depth,
       CAST(round_even({x('num_leaves', 10, 50)}, 0) AS INTEGER) AS num_leaves,
       round({x('colsample', 0.5, 1.0)}, 6) AS colsample, round({x('subsample', 0.5, 1.0)}, 6) AS subsample,
       round({x('learning_rate', 0.05, 0.2)}, 6) AS learning_rate FROM t"""


ORACLES["m05_trial_table"] = _trial_table()


def _variant_valid() -> str:
    """B-15: mean of the train rows in place of a missing value, valid rows kept as they are."""
    uu, cols = u_sql_duckdb("ID", 42), ["n_chars", "n_spaces", "n_dots"]
    fold = f"CASE WHEN {uu} < {T_TEST} THEN 'test' WHEN {uu} < {T_VALID} THEN 'valid' ELSE 'train' END"
    return (f"WITH t AS (SELECT *, {fold} AS fold FROM ({FX_TOXIC_SQL}) t0), m AS (SELECT "
            + ", ".join(f"avg(CAST({c} AS DOUBLE)) AS m_{c}" for c in cols) + " FROM t WHERE fold = 'train') SELECT ID, label, "
            + ", ".join(f"round(coalesce(CAST({c} AS DOUBLE), m_{c}), {R}) AS {c}" for c in cols) + " FROM t, m WHERE fold = 'valid'")


ORACLES["b15_variant"] = _variant_valid()
ORACLES["x01_primitives_in_a_plan"] = f"""
WITH ev AS ({_EV}), s AS (
SELECT event_id, user_id, CASE WHEN value IS NOT NULL THEN sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS c,
       CASE WHEN value IS NOT NULL THEN sum(value / 2) OVER (PARTITION BY user_id ORDER BY ts, event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS h
FROM ev)
SELECT event_id, user_id, round(c, {R}) AS cum_value, round(c / 2, {R}) AS half_cum, round(h, {R}) AS cum_half FROM s"""
