"""Named queries for binning, transforms, errors, metrics and the registry
(second half of the catalogue; registered into the same dicts)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.operators import binning as B, boosting as H, encoding as C, errors as E, registry as G, transform as T
from lakeops.operators.ranks import weighted_medians
from lakeops.plans import roles as R
from lakeops.plans.catalog import ORACLE, QUERIES, SQL_AS_OF, query, rounded  # noqa: F401
from lakeops.session import scratch_path
from lakeops.sinks import writers as W
from lakeops.sources import files as S


def _plist(q: int) -> str:
    return "[" + ", ".join(repr(i / q) for i in range(q + 1)) + "]"


def _sql_bin(q: int, src: str, keys: list[str], ident: str) -> str:
    """Rows of ``src`` (ident, keys, y) with their qcut bin for this q."""
    k = ", ".join(keys)
    on = " AND ".join(f"s.{c} = e.{c}" for c in keys)
    return f"""SELECT s.{ident}, {', '.join('s.' + c for c in keys)}, {q} AS q,
       CAST(greatest(0, len(list_filter(e.edges, lambda x: x < s.y)) - 1) AS INTEGER) AS bin
FROM {src} s JOIN (SELECT {k}, list_distinct(quantile_cont(y, {_plist(q)})) AS edges
                   FROM {src} s2 GROUP BY {k}) e ON {on}"""


def _sql_choose(src: str, keys: list[str], ident: str, q_min=B.Q_MIN, q_max=B.Q_MAX) -> str:
    """CTE text: rowbins (all q), chosen (per group q)."""
    k = ", ".join(keys)
    blocks = "\nUNION ALL\n".join(_sql_bin(q, src, keys, ident) for q in range(q_min, q_max + 1))
    return f"""rowbins AS ({blocks}),
mins AS (SELECT {k}, q, min(cnt) AS min_cnt FROM
          (SELECT {k}, q, bin, count(*) AS cnt FROM rowbins GROUP BY {k}, q, bin) c GROUP BY {k}, q),
chosen AS (SELECT {k}, CAST(coalesce(min(q) FILTER (WHERE min_cnt <> 1), {B.UNSTRATIFIED_Q}) AS INTEGER) AS q
           FROM mins GROUP BY {k})"""


# =============================================================== binning and split

_SQL_QCUT_SRC = "(SELECT o_orderkey, o_orderstatus AS measure, o_totalprice AS y FROM orders)"


@query("qcut_bins", _sql_bin(20, _SQL_QCUT_SRC, ["measure"], "o_orderkey").replace(", 20 AS q", ""))
def q_qcut(spark, sf):
    o = R.tables(spark, sf).orders
    d = o.select("o_orderkey", F.col("o_orderstatus").alias("measure"), F.col("o_totalprice").alias("y"))
    return B.qcut_bins(d, ["measure"], "y", 20).select("o_orderkey", "measure", "bin")


_SQL_CHOOSE_SRC = """(SELECT o_orderkey, o_orderstatus AS measure, o_custkey % 100 AS service,
                      o_totalprice AS y FROM orders)"""


@query("qcut_choose_q", f"""WITH {_sql_choose(_SQL_CHOOSE_SRC, ['measure', 'service'], 'o_orderkey')}
SELECT measure, service, q FROM chosen""")
def q_choose(spark, sf):
    o = R.tables(spark, sf).orders
    d = o.select(F.col("o_orderstatus").alias("measure"), (F.col("o_custkey") % 100).alias("service"),
                 F.col("o_totalprice").alias("y"))
    return B.choose_q(d, ["measure", "service"], "y")


_SQL_SPLIT_SRC = """(SELECT o_orderkey, o_orderstatus AS measure, o_orderpriority AS service,
                     o_totalprice AS y FROM orders)"""


@query("stratified_split", f"""WITH {_sql_choose(_SQL_SPLIT_SRC, ['measure', 'service'], 'o_orderkey')},
r AS (SELECT s.o_orderkey, s.measure, s.service, c.q,
             CAST(CASE WHEN c.q = {B.UNSTRATIFIED_Q} THEN 0 ELSE rb.bin END AS INTEGER) AS bin
      FROM {_SQL_SPLIT_SRC} s JOIN chosen c ON s.measure = c.measure AND s.service = c.service
      LEFT JOIN rowbins rb ON rb.o_orderkey = s.o_orderkey AND rb.q = c.q)
SELECT o_orderkey, measure, service, q, bin,
       row_number() OVER (PARTITION BY measure, service, bin
                          ORDER BY (o_orderkey * 48271) % 2147483647, o_orderkey)
         <= round(0.2 * count(*) OVER (PARTITION BY measure, service, bin)) AS is_test
FROM r""")
def q_strat(spark, sf):
    o = R.tables(spark, sf).orders
    d = o.select("o_orderkey", F.col("o_orderstatus").alias("measure"),
                 F.col("o_orderpriority").alias("service"), F.col("o_totalprice").alias("y"))
    s = B.stratified_split(d, ["measure", "service"], "y", "o_orderkey")
    return s.select("o_orderkey", "measure", "service", "q", "bin", "is_test")


@query("random_split", """
SELECT o_orderkey, o_orderstatus AS measure, o_orderpriority AS service,
       row_number() OVER (PARTITION BY o_orderstatus, o_orderpriority
                          ORDER BY (o_orderkey * 48271) % 2147483647, o_orderkey)
         <= round(0.2 * count(*) OVER (PARTITION BY o_orderstatus, o_orderpriority)) AS is_test
FROM orders""")
def q_random_split(spark, sf):
    o = R.tables(spark, sf).orders
    d = o.select("o_orderkey", F.col("o_orderstatus").alias("measure"),
                 F.col("o_orderpriority").alias("service"))
    return B.random_split(d, ["measure", "service"], "o_orderkey")


# =============================================================== Yeo-Johnson

_YJ_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _sql_psi(x: str, lam: str) -> str:
    return (f"CASE WHEN {x} >= 0 THEN (CASE WHEN {lam} = 0 THEN ln({x} + 1) "
            f"ELSE (pow({x} + 1, {lam}) - 1) / {lam} END) "
            f"ELSE (CASE WHEN {lam} = 2 THEN -ln(1 - {x}) "
            f"ELSE -(pow(1 - {x}, 2 - {lam}) - 1) / (2 - {lam}) END) END")


def _sql_yj_fit(rounds: int = 10) -> str:
    """The bracketing search, a block of CTEs per round; the columns here are
    done before the last one."""
    longf = "\nUNION ALL ".join(
        f"SELECT l_returnflag AS measure, l_linestatus AS service, '{c}' AS column_name, "
        f"CAST({c} AS DOUBLE) AS x FROM lineitem WHERE {c} IS NOT NULL AND NOT isnan({c})"
        for c in _YJ_COLS)
    keys = "measure, service, column_name"
    out = [f"""lf AS MATERIALIZED ({longf}),
st AS MATERIALIZED (SELECT {keys}, count(*) AS n, min(x) AS xmin, max(x) AS xmax, sum(sign(x) * ln(abs(x) + 1)) AS s FROM lf GROUP BY {keys}),
r0 AS MATERIALIZED (SELECT {keys}, {T.CENTRE!r}::DOUBLE AS centre, {T.STEP!r}::DOUBLE AS step, FALSE AS narrowed, xmin = xmax AS done,
       CAST(NULL AS DOUBLE) AS llf, CAST(NULL AS DOUBLE) AS var, CAST(NULL AS DOUBLE) AS mean FROM st)"""]
    for i in range(rounds):
        out.append(f"""p{i} AS (SELECT {keys}, k, centre + k * step AS lam FROM r{i}, unnest(range(-{T.REACH}, {T.REACH + 1})) u(k) WHERE NOT done),
e{i} AS MATERIALIZED (SELECT {keys}, k, lam, var_pop(psi) AS var, avg(psi) AS mean FROM
       (SELECT {keys}, k, lam, {_sql_psi('x', 'lam')} AS psi FROM lf JOIN p{i} USING ({keys})) v GROUP BY {keys}, k, lam),
b{i} AS MATERIALIZED (SELECT {keys}, k, lam, var, mean, -n / 2.0 * ln(var) + (lam - 1) * s AS llf FROM e{i} JOIN st USING ({keys}) WHERE var > 0 AND n > 1
       QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY llf DESC, k) = 1),
r{i + 1} AS MATERIALIZED (SELECT {keys}, coalesce(b.lam, r.centre) AS centre,
       CASE WHEN r.done THEN r.step WHEN abs(b.k) < {T.REACH} THEN r.step / 4 WHEN r.narrowed THEN r.step ELSE r.step * 2 END AS step,
       r.narrowed OR coalesce(abs(b.k) < {T.REACH}, TRUE) AS narrowed,
       r.done OR b.k IS NULL OR (abs(b.k) < {T.REACH} AND r.step <= {T.FINEST!r}) AS done,
       CASE WHEN r.done THEN r.llf ELSE b.llf END AS llf, CASE WHEN r.done THEN r.var ELSE b.var END AS var, CASE WHEN r.done THEN r.mean ELSE b.mean END AS mean
       FROM r{i} r LEFT JOIN b{i} b USING ({keys}))""")
    out.append(f"""params AS (SELECT {keys}, n, CASE WHEN n > 1 AND xmin < xmax AND llf IS NOT NULL THEN centre END AS lmbda,
                  CASE WHEN n > 1 AND xmin < xmax AND llf IS NOT NULL THEN mean END AS mean,
                  CASE WHEN n > 1 AND xmin < xmax AND llf IS NOT NULL THEN sqrt(var) END AS std
           FROM r{rounds} JOIN st USING ({keys}) WHERE done)""")
    return ",\n".join(out)


@query("yeo_johnson_fit", f"""WITH {_sql_yj_fit()}
SELECT measure, service, column_name, n, lmbda, round(mean, 6) AS mean, round(std, 6) AS std FROM params""")
def q_yj_fit(spark, sf):
    li = R.tables(spark, sf).lineitem
    d = li.select(F.col("l_returnflag").alias("measure"), F.col("l_linestatus").alias("service"), *_YJ_COLS)
    fit = T.yeo_johnson_fit(d, ["measure", "service"], _YJ_COLS)
    return rounded(fit.select("measure", "service", "column_name", "n", "lmbda", "mean", "std"),
                   ["mean", "std"], 6)


def _sql_yj_apply_col(c: str) -> str:
    p = f"p_{c}"
    t = _sql_psi(f"CAST(l.{c} AS DOUBLE)", f"{p}.lmbda")
    return (f"round(CASE WHEN {p}.lmbda IS NULL THEN CAST(l.{c} AS DOUBLE) "
            f"WHEN {p}.std > 0 THEN (({t}) - {p}.mean) / {p}.std ELSE ({t}) - {p}.mean END, 6) AS {c}")


@query("yeo_johnson_apply", f"""WITH {_sql_yj_fit()}
SELECT l.l_orderkey, l.l_linenumber, l.l_returnflag AS measure, l.l_linestatus AS service,
       {', '.join(_sql_yj_apply_col(c) for c in _YJ_COLS)}
FROM lineitem l
{' '.join(f"LEFT JOIN params p_{c} ON p_{c}.measure = l.l_returnflag AND p_{c}.service = l.l_linestatus AND p_{c}.column_name = '{c}'" for c in _YJ_COLS)}""")
def q_yj_apply(spark, sf):
    li = R.tables(spark, sf).lineitem
    d = li.select("l_orderkey", "l_linenumber", F.col("l_returnflag").alias("measure"),
                  F.col("l_linestatus").alias("service"), *_YJ_COLS)
    fit = T.yeo_johnson_fit(d, ["measure", "service"], _YJ_COLS)
    out = T.yeo_johnson_apply(d, fit, ["measure", "service"], _YJ_COLS)
    return rounded(out, _YJ_COLS, 6)


# =============================================================== errors and metrics

_SQL_SCORED = """(SELECT b.ts_id, b.measure, b.service, b.y, m.pred FROM
   (SELECT o_orderkey AS ts_id, o_orderstatus AS measure, o_orderpriority AS service,
           CAST(floor(o_totalprice / 100000) AS DOUBLE) AS y FROM orders) b
   JOIN (SELECT o_orderstatus AS measure, o_orderpriority AS service, avg(o_totalprice / 100000) AS pred
         FROM orders GROUP BY o_orderstatus, o_orderpriority) m USING (measure, service))"""

_SQL_ERRS = f"""(SELECT ts_id, measure, service, y, pred,
        CASE WHEN y = 0 THEN abs(pred) ELSE abs(y - pred) / y END AS rel_err_abs,
        CASE WHEN y = 0 THEN pred ELSE (y - pred) / y END AS rel_err
 FROM {_SQL_SCORED} sc)"""


def _errors(spark, sf):
    return E.relative_errors(R.scored(R.tables(spark, sf)), "y", "pred")


@query("relative_errors", f"""
SELECT ts_id, measure, service, round(rel_err_abs, 6) AS rel_err_abs, round(rel_err, 6) AS rel_err,
       'group_mean' AS run_id FROM {_SQL_ERRS} e""")
def q_rel_errors(spark, sf):
    e = _errors(spark, sf).withColumn("run_id", F.lit("group_mean"))
    return rounded(e.select("ts_id", "measure", "service", "rel_err_abs", "rel_err", "run_id"),
                   ["rel_err_abs", "rel_err"], 6)


@query("regression_metrics", f"""
SELECT measure, service, count(*) AS n, round(avg((y - pred) ^ 2), 6) AS mse,
       round(sqrt(avg((y - pred) ^ 2)), 6) AS rmse,
       round(avg(abs(y - pred) / CASE WHEN y <> 0 THEN y END), 6) AS mape,
       count(*) FILTER (WHERE y = 0) AS n_zero_y,
       round(1 - sum((y - pred) ^ 2) / (var_pop(y) * count(y)), 6) AS r2
FROM {_SQL_SCORED} s GROUP BY measure, service""")
def q_metrics(spark, sf):
    m = E.regression_metrics(R.scored(R.tables(spark, sf)), ["measure", "service"], "y", "pred")
    return rounded(m, ["mse", "rmse", "mape", "r2"], 6)


@query("model_score", f"""
SELECT measure, service, round(avg(rel_err_abs), 6) AS mape FROM {_SQL_ERRS} e GROUP BY measure, service""")
def q_model_score(spark, sf):
    return rounded(E.model_score(_errors(spark, sf), ["measure", "service"]), ["mape"], 6)


def _sql_describe(col: str, s: str) -> str:
    return (f"count({col}) AS count{s}, round(avg({col}), 6) AS mean{s}, "
            f"round(stddev_samp({col}), 6) AS std{s}, round(min({col}), 6) AS min{s}, "
            f"round(quantile_cont({col}, 0.25), 6) AS q1{s}, round(quantile_cont({col}, 0.5), 6) AS q2{s}, "
            f"round(quantile_cont({col}, 0.75), 6) AS q3{s}, round(max({col}), 6) AS max{s}")


@query("describe_rel_err", f"""
SELECT measure, service, {_sql_describe('rel_err_abs', '')} FROM {_SQL_ERRS} e GROUP BY measure, service""")
def q_describe(spark, sf):
    d = E.describe(_errors(spark, sf), ["measure", "service"], "rel_err_abs")
    return rounded(d, ["mean", "std", "min", "q1", "q2", "q3", "max"], 6)


@query("metrics_by_group", f"""
SELECT measure, service, round(avg((y - pred) ^ 2), 6) AS mse,
       round(avg(abs(y - pred) / CASE WHEN y <> 0 THEN y END), 6) AS mape,
       round(1 - sum((y - pred) ^ 2) / (var_pop(y) * count(y)), 6) AS r2,
       count(*) FILTER (WHERE y = 0) AS n_zero_y,
       {_sql_describe('rel_err', '_rel_err')}, {_sql_describe('rel_err_abs', '_rel_err_abs')}
FROM {_SQL_ERRS} e GROUP BY measure, service""")
def q_metrics_by_group(spark, sf):
    m = E.metrics_by_group(_errors(spark, sf), ["measure", "service"], "y", "pred")
    dbl = [f.name for f in m.schema.fields if f.dataType.typeName() == "double"]
    return rounded(m, dbl, 6)


@query("error_histogram", f"""
WITH st AS (SELECT measure, service, min(rel_err_abs) AS mn, max(rel_err_abs) AS mx, avg(rel_err_abs) AS mean,
                   quantile_cont(rel_err_abs, 0.5) AS median FROM {_SQL_ERRS} e GROUP BY measure, service),
b AS (SELECT e.measure, e.service, st.mn, st.mx, st.mean, st.median,
             CAST(CASE WHEN (st.mx - st.mn) / 10.0 > 0
                       THEN least(floor((e.rel_err_abs - st.mn) / ((st.mx - st.mn) / 10.0)), 9) ELSE 0 END AS INTEGER) AS bin
      FROM {_SQL_ERRS} e JOIN st USING (measure, service))
SELECT measure, service, bin, round(any_value(mn) + bin * ((any_value(mx) - any_value(mn)) / 10.0), 6) AS bin_lo,
       round(any_value(mn) + (bin + 1) * ((any_value(mx) - any_value(mn)) / 10.0), 6) AS bin_hi,
       count(*) AS count, round(any_value(mean), 6) AS mean, round(any_value(median), 6) AS median
FROM b GROUP BY measure, service, bin""")
def q_hist(spark, sf):
    h = E.error_histogram(_errors(spark, sf), ["measure", "service"], "rel_err_abs", 10)
    return rounded(h, ["bin_lo", "bin_hi", "mean", "median"], 6)


# =============================================================== registry

_SQL_REG = """(SELECT event_type AS measure, CAST(user_id % 10 AS VARCHAR) AS service,
        CAST(event_id AS VARCHAR) AS model_run_id, -100.0::DOUBLE AS value, value AS mape,
        1 AS flag, ts AS date FROM events)"""
_SQL_REG_STORED = """(SELECT event_type AS measure, CASE WHEN user_id % 10 < 8 THEN '' ELSE 'old' END || CAST(user_id % 10 AS VARCHAR) AS service,
        CAST(event_id AS VARCHAR) AS model_run_id, -100.0::DOUBLE AS value, value AS mape,
        1 AS flag, ts AS date FROM events WHERE event_id % 2 = 1)"""
_SQL_NEW_SCORES = """(SELECT measure, service, min(value) AS mape,
        concat_ws('_', measure, service, 'gbt') AS model_run_id
 FROM (SELECT event_type AS measure, CAST(user_id % 10 AS VARCHAR) AS service, value
       FROM events WHERE event_id % 2 = 0) e GROUP BY measure, service)"""
_SQL_CHALLENGERS = f"""(SELECT n.measure, n.service, n.model_run_id, -100.0::DOUBLE AS value,
        CAST(n.mape AS DOUBLE) AS mape, 1 AS flag, {SQL_AS_OF} AS date
 FROM {_SQL_NEW_SCORES} n
 LEFT JOIN (SELECT measure, service, min(mape) AS best, count(*) AS n_stored FROM {_SQL_REG_STORED} r
            GROUP BY measure, service) c ON n.measure = c.measure AND n.service = c.service
 WHERE c.n_stored IS NULL OR n.mape < 0.99 * c.best)"""


@query("champion_first_value", f"""
SELECT measure, service, model_run_id, value,
       first_value(mape) OVER (PARTITION BY measure, service ORDER BY mape ASC NULLS LAST, date DESC) AS mape,
       flag, date FROM {_SQL_REG} r""")
def q_champ_fv(spark, sf):
    return G.champion_first_value(R.registry(R.tables(spark, sf)))


@query("champion_row", f"""
SELECT measure, service, model_run_id, value, mape, flag, date FROM (
  SELECT *, row_number() OVER (PARTITION BY measure, service
                               ORDER BY mape ASC NULLS LAST, date DESC, model_run_id ASC) AS rn
  FROM {_SQL_REG} r) x WHERE rn = 1""")
def q_champ_row(spark, sf):
    return G.champion_row(R.registry(R.tables(spark, sf)))


@query("challenger_select", f"SELECT * FROM {_SQL_CHALLENGERS} c")
def q_challenger(spark, sf):
    t = R.tables(spark, sf)
    return G.challenger_select(R.new_scores(t), R.registry_stored(t), as_of=R.AS_OF)


@query("model_registry_append", f"SELECT * FROM {_SQL_REG_STORED} r UNION ALL SELECT * FROM {_SQL_CHALLENGERS} c")
def q_registry_append(spark, sf):
    """Stored registry in a folder; the decisions appended in one write."""
    t = R.tables(spark, sf)
    stored = R.registry_stored(t)
    path = scratch_path(spark, "registry")
    stored.write.mode("overwrite").parquet(path)
    reg = spark.read.parquet(path)
    dec = G.challenger_select(R.new_scores(t), reg, as_of=R.AS_OF)
    W.append(dec.select(*reg.columns), path, is_path=True)
    return spark.read.schema(reg.schema).parquet(path)


@query("single_price_groups", f"""
WITH s AS (SELECT CAST(o_custkey AS VARCHAR) AS measure, o_orderpriority AS service, o_custkey,
                  CAST(floor(o_totalprice / 100000) AS DOUBLE) AS y FROM orders),
g AS (SELECT measure, service, min(o_custkey) AS ck, min(y) AS mn, max(y) AS mx FROM s GROUP BY measure, service)
SELECT measure, service, 'no_model' AS model_run_id, mn AS value, 100.0::DOUBLE AS mape, 0 AS flag,
       {SQL_AS_OF} AS date
FROM g WHERE (mn IS NULL OR mn = mx) AND ck % 2 <> 0""")
def q_single_price(spark, sf):
    o = R.tables(spark, sf).orders
    d = o.select(F.col("o_custkey").cast("string").alias("measure"), F.col("o_orderpriority").alias("service"),
                 "o_custkey", F.floor(F.col("o_totalprice") / 100000).cast("double").alias("y"))
    stored = d.withColumn("measure", F.when(F.col("o_custkey") % 2 == 0, F.col("measure")).otherwise(F.concat(F.lit("old"), F.col("measure")))).select("measure", "service")
    return G.single_price_groups(d, ["measure", "service"], "y", stored, as_of=R.AS_OF)


@query("single_price_groups_nan", f"""
WITH s AS (SELECT CAST(o_custkey AS VARCHAR) AS measure, o_orderpriority AS service,
                  CASE WHEN o_orderkey % 3 <> 0 THEN CAST(floor(o_totalprice / 100000) AS DOUBLE) END AS y FROM orders),
g AS (SELECT measure, service, min(y) AS mn, max(y) AS mx FROM s GROUP BY measure, service)
SELECT measure, service, 'no_model' AS model_run_id, mn AS value, 100.0::DOUBLE AS mape, 0 AS flag,
       {SQL_AS_OF} AS date
FROM g WHERE mn IS NULL OR mn = mx""")
def q_single_price_nan(spark, sf):
    """Targets that are NaN (here for a third of the orders) count as missing."""
    y = F.when(F.col("o_orderkey") % 3 == 0, F.lit(float("nan"))).otherwise(F.floor(F.col("o_totalprice") / 100000).cast("double"))
    d = R.tables(spark, sf).orders.select(F.col("o_custkey").cast("string").alias("measure"), F.col("o_orderpriority").alias("service"), y.alias("y"))
    return G.single_price_groups(d, ["measure", "service"], "y", as_of=R.AS_OF)


@query("yeo_johnson_fit_offset", """
WITH g AS (SELECT l_returnflag AS measure, l_linestatus AS service, count(*) AS n,
                  avg(l_orderkey + 1e9::DOUBLE) AS mean, stddev_pop(l_orderkey) AS std
           FROM lineitem GROUP BY l_returnflag, l_linestatus)
SELECT measure, service, 'x' AS column_name, n, 1.0::DOUBLE AS lmbda, round(mean, 1) AS mean, round(std, 1) AS std FROM g""")
def q_yj_offset(spark, sf):
    """A column far from 0 keeps its spread (lambda 1: the identity)."""
    d = R.tables(spark, sf).lineitem.select(F.col("l_returnflag").alias("measure"), F.col("l_linestatus").alias("service"),
                                            (F.col("l_orderkey") + F.lit(1e9)).alias("x"))
    fit = T.yeo_johnson_fit(d, ["measure", "service"], ["x"], grid=(1.0,))
    return rounded(fit.select("measure", "service", "column_name", "n", "lmbda", "mean", "std"), ["mean", "std"], 1)


@query("qcut_bin_counts", f"""
SELECT measure, min(cnt) AS min_bin_count, count(*) AS n_bins FROM (
  SELECT measure, bin, count(*) AS cnt FROM ({_sql_bin(20, _SQL_QCUT_SRC, ['measure'], 'o_orderkey')}) b
  GROUP BY measure, bin) c
GROUP BY measure""")
def q_bin_counts(spark, sf):
    """Members per qcut bin, reduced to the smallest bin per group."""
    o = R.tables(spark, sf).orders
    d = o.select("o_orderkey", F.col("o_orderstatus").alias("measure"), F.col("o_totalprice").alias("y"))
    return B.bin_counts(B.qcut_bins(d, ["measure"], "y", 20), ["measure"])


# =============================================================== boosting of all groups

_SQL_ORDER = f"((o_orderkey % 2147483647 + {C.SEED}) * 48271) % 2147483647, o_orderkey"


def _sql_statistic(column: str) -> str:
    before = f"OVER (PARTITION BY measure, {column} ORDER BY {_SQL_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return (f"round(CASE WHEN is_test THEN (coalesce(sum(y) FILTER (WHERE NOT is_test) OVER (PARTITION BY measure, {column}), 0) + mean) "
            f"/ (count(*) FILTER (WHERE NOT is_test) OVER (PARTITION BY measure, {column}) + 1) "
            f"ELSE (coalesce(sum(y) FILTER (WHERE NOT is_test) {before}, 0) + mean) / (count(*) FILTER (WHERE NOT is_test) {before} + 1) END, 3) AS {column}")


@query("ordered_target_statistics", f"""
WITH s AS (SELECT o_orderkey, o_orderstatus AS measure, o_orderpriority AS priority, CAST(o_custkey AS VARCHAR) AS customer,
                  o_totalprice AS y, o_orderkey % 5 = 0 AS is_test FROM orders),
m AS (SELECT measure, avg(y) AS mean FROM s WHERE NOT is_test GROUP BY measure)
SELECT o_orderkey, measure, {_sql_statistic('priority')}, {_sql_statistic('customer')}, is_test
FROM s JOIN m USING (measure)""")
def q_target_statistics(spark, sf):
    """Categories (customers: thousands of labels) as ordered target statistics."""
    o = R.tables(spark, sf).orders
    d = o.select("o_orderkey", F.col("o_orderstatus").alias("measure"), F.col("o_orderpriority").alias("priority"),
                 F.col("o_custkey").cast("string").alias("customer"), F.col("o_totalprice").alias("y"), (F.col("o_orderkey") % 5 == 0).alias("is_test"))
    out = C.target_statistics(d, ["measure"], ["priority", "customer"], "y", row_id="o_orderkey")
    return rounded(out.select("o_orderkey", "measure", "priority", "customer", "is_test"), ["priority", "customer"], 3)


_SQL_WEIGHT = f"greatest(1, CAST(round({float(H.ONE)!r} / greatest(1.0, abs(y))) AS BIGINT))"


def _sql_weighted_median(keys: str, src: str, value: str = "y") -> str:
    """``(keys, med)``: the lowest value with half of the weight at or below it."""
    return f"""SELECT {keys}, min(v) AS med FROM (
    SELECT {keys}, {value} AS v, sum(sum(w)) OVER (PARTITION BY {keys} ORDER BY {value}) AS upto, sum(sum(w)) OVER (PARTITION BY {keys}) AS whole
    FROM {src} GROUP BY {keys}, {value}) c WHERE 2 * upto >= whole GROUP BY {keys}"""


@query("weighted_median", f"""
WITH s AS (SELECT o_orderstatus AS measure, o_orderpriority AS service, o_totalprice AS y FROM orders),
t AS (SELECT *, {_SQL_WEIGHT} AS w FROM s)
{_sql_weighted_median('measure, service', 't')}""")
def q_weighted_median(spark, sf):
    """The price of each group that minimises the mean relative error."""
    y = F.col("o_totalprice")
    d = R.tables(spark, sf).orders.select(F.col("o_orderstatus").alias("measure"), F.col("o_orderpriority").alias("service"),
                                          y.alias("_v"), H.relative_weight(y).alias("_w"))
    return weighted_medians(d, ["measure", "service"]).withColumnRenamed("_val", "med")


_TREE_FEATURES = ["l_quantity", "l_discount", "l_tax", "l_partkey"]
_TREE_GROUP = ["l_returnflag", "l_linestatus"]


def _sql_first_tree(depth: int = 2) -> str:
    g = ", ".join(_TREE_GROUP)
    points = "[" + ", ".join(repr(i / H.BINS) for i in range(1, H.BINS)) + "]"
    edges = ", ".join(f"list_distinct(quantile_cont(CAST({f} AS DOUBLE), {points})) AS e{i}" for i, f in enumerate(_TREE_FEATURES))
    bins = ", ".join(f"1 + len(list_filter(e{i}, lambda x: x < CAST(r.{f} AS DOUBLE))) AS b{i}" for i, f in enumerate(_TREE_FEATURES))
    out = [f"""WITH r AS (SELECT {g}, {', '.join(_TREE_FEATURES)}, l_extendedprice AS y FROM lineitem WHERE l_orderkey % 5 <> 0),
t AS (SELECT *, {_SQL_WEIGHT} AS w FROM r),
start AS ({_sql_weighted_median(g, 't')}),
edges AS (SELECT {g}, {edges} FROM r GROUP BY {g}),
n0 AS MATERIALIZED (SELECT {g}, r.y, r.w, CAST(sign(r.y - med) AS BIGINT) AS z, med, {bins}, 1 AS node
       FROM t r JOIN start USING ({g}) JOIN edges USING ({g}))"""]
    for level in range(depth):
        long = " UNION ALL ".join(f"SELECT {g}, node, {i} AS feature, b{i} AS bin, sum(z * w) AS s, sum(w) AS w FROM n{level} WHERE node >= {1 << level} GROUP BY ALL" for i in range(len(_TREE_FEATURES)))
        part = f"PARTITION BY {g}, node, feature"
        out.append(f"""h{level} AS (SELECT {g}, node, feature, bin, CAST(sum(s) OVER ({part} ORDER BY bin) AS DOUBLE) AS sl, CAST(sum(w) OVER ({part} ORDER BY bin) AS DOUBLE) AS wl,
       CAST(sum(s) OVER ({part}) AS DOUBLE) AS st, CAST(sum(w) OVER ({part}) AS DOUBLE) AS wt FROM ({long}) u),
c{level} AS (SELECT {g}, node, feature, bin, (sl * sl / wl + (st - sl) * (st - sl) / (wt - wl) - st * st / wt) / {float(H.ONE)!r} AS gain FROM h{level} WHERE wl < wt),
s{level} AS MATERIALIZED (SELECT * FROM c{level} WHERE gain > 1e-12 QUALIFY row_number() OVER (PARTITION BY {g}, node ORDER BY gain DESC, feature, bin) = 1),
n{level + 1} AS MATERIALIZED (SELECT n.* EXCLUDE (node), CASE WHEN s.node IS NULL THEN n.node
         ELSE 2 * n.node + CAST([{', '.join(f'n.b{i}' for i in range(len(_TREE_FEATURES)))}][s.feature + 1] > s.bin AS INTEGER) END AS node
       FROM n{level} n LEFT JOIN s{level} s ON {' AND '.join(f'n.{c} = s.{c}' for c in _TREE_GROUP)} AND n.node = s.node)""")
    splits = " UNION ALL ".join(f"SELECT {g}, node, feature, CAST(bin AS INTEGER) AS bin, round(gain, 9) AS gain, 0.0::DOUBLE AS value FROM s{level}" for level in range(depth))
    out.append(f"""d AS (SELECT {g}, node, y - med AS rest, w FROM n{depth}),
l AS ({_sql_weighted_median(g + ', node', 'd', 'rest')})""")
    return ",\n".join(out) + f"""
{splits}
UNION ALL SELECT {g}, node, -1, -1, 0.0, round(med * {H.LEARNING_RATE!r}, 6) FROM l"""


@query("boosted_first_tree", _sql_first_tree())
def q_first_tree(spark, sf):
    """The first tree of every group, all groups at once: bins, weights,
    splits with their gains, leaves (feature and bin -1)."""
    li = R.tables(spark, sf).lineitem
    row = ((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 1000003 + F.col("l_partkey")).alias("row_id")
    d = li.select(row, *_TREE_GROUP, *_TREE_FEATURES, F.col("l_extendedprice").alias("y"), (F.col("l_orderkey") % 5 == 0).alias("is_test"))
    fit = H.fit_boosted(d, _TREE_GROUP, "y", _TREE_FEATURES, n_trees=1, depth=2)
    t = fit.trees.select(*_TREE_GROUP, "node", "feature", "bin", "gain", "value")
    return t.withColumns({"gain": F.round("gain", 9), "value": F.round("value", 6)}).fillna(-1, ["feature", "bin"]).fillna(0.0, ["gain", "value"])
