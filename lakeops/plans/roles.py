"""Roles of the driver's test tables (FIXTURES.md section C).

The test data is a TPC-H-like star; these functions map it onto the
roles the operators expect (a batch of new orders, the stored orders, the
leg-cost star, a scored hold-out set, a model registry...).  Each role is
a lazy plan over the given tables, so its size grows with them.  The
matching DuckDB SQL lives next to each query in ``lakeops.plans.catalog``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators import legs as L
from lakeops.plans.orders import OrderCols, customer_summary as _summary

#: Fixed values that define the roles (see FIXTURES.md section C).
SUMMARY_CUTOFF = "1998-04-25 00:00:00"     # median o_orderdate at sf0.01
AS_OF = "2026-01-01 03:00:00"              # registry stamp used by the queries
ORDER_COLS = OrderCols(order_id="o_orderkey", customer_id="o_custkey", order_date="o_orderdate",
                       amount="o_totalprice", customer_key="c_custkey", customer_name="c_name")


class Tables:
    """Scans of the test tables, opened when first named."""

    def __init__(self, spark: SparkSession | None = None, sf_dir: str = "", **given: DataFrame):
        self._spark, self._dir = spark, sf_dir
        for name, table in given.items():
            setattr(self, name, table)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        table = self._spark.read.parquet(f"{self._dir}/{name}.parquet")
        setattr(self, name, table)
        return table


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)


# ---------------------------------------------------------------- orders ETL roles

def moved(df: DataFrame, key: str, rows) -> DataFrame:
    """All of ``df``; the keys of these rows leave the key range (k to -1 - k),
    so that they match nothing on the other side."""
    return df.withColumn(key, F.when(rows, F.lit(-1) - F.col(key)).otherwise(F.col(key)))


def orders_batch(t) -> DataFrame:
    return moved(t.orders, "o_orderkey", F.col("o_orderkey") % 3 == 0)


def orders_stored(t) -> DataFrame:
    return moved(t.orders, "o_orderkey", F.col("o_orderkey") % 2 != 0)


def known_customers(t) -> DataFrame:
    return moved(t.customer, "c_custkey", F.col("c_custkey") % 5 == 0)


def products(t) -> DataFrame:
    return moved(t.part, "p_partkey", F.col("p_partkey") % 4 == 0).select("p_partkey", "p_retailprice")


def summary_old(t) -> DataFrame:
    o = t.orders.filter(F.col("o_orderdate") < F.lit(SUMMARY_CUTOFF).cast("timestamp_ntz"))
    return _summary(o, known_customers(t), ORDER_COLS)


def summary_new(t) -> DataFrame:
    o = t.orders.filter(F.col("o_orderdate") >= F.lit(SUMMARY_CUTOFF).cast("timestamp_ntz"))
    return _summary(o, known_customers(t), ORDER_COLS)


# ---------------------------------------------------------------- NaN / NULL roles

def geo(t) -> DataFrame:
    k = F.col("o_orderkey")
    lat = (F.when(k % 7 == 0, F.lit(float("nan")))
            .when(k % 11 == 0, F.lit(None).cast("double"))
            .otherwise(F.col("o_totalprice")))
    return t.orders.select("o_orderkey", lat.alias("lat"))


def balances(t) -> DataFrame:
    k = F.col("c_custkey")
    bal = F.when(k % 7 == 0, F.lit(float("nan"))).otherwise(F.col("c_acctbal"))
    return t.customer.select("c_custkey", bal.alias("bal"))


# ---------------------------------------------------------------- leg-cost star

def legs_star(t, min_ts_id: int = L.MIN_SOLUTION_ID) -> DataFrame:
    """The wide join on the test star: lineitem (legs) with its order
    (transport solution), supplier and customer with their nations (the
    departure / destination points: one dimension in two roles) and part."""
    l, ts = t.lineitem.alias("l"), t.orders.alias("ts")
    sup, cus, pt = t.supplier.alias("sup"), t.customer.alias("cus"), t.part.alias("pt")
    pr1, pr2 = t.nation.alias("pr1"), t.nation.alias("pr2")
    # The dimensions that grow past a broadcast come first -- orders meet their
    # customer, legs their part -- so that the last shuffle of the legs is the one
    # by order, which a join on ``ts_id`` needs no more.
    legs = l.join(pt, F.col("l.l_partkey") == F.col("pt.p_partkey"))
    solutions = ts.filter(F.col("o_orderkey") > F.lit(min_ts_id)).join(cus, F.col("ts.o_custkey") == F.col("cus.c_custkey"))
    j = (legs.join(solutions, F.col("l.l_orderkey") == F.col("ts.o_orderkey"))
             .join(sup, F.col("l.l_suppkey") == F.col("sup.s_suppkey"))
             .join(pr1, F.col("sup.s_nationkey") == F.col("pr1.n_nationkey"))
             .join(pr2, F.col("cus.c_nationkey") == F.col("pr2.n_nationkey")))
    j = j.filter(L.is_not_nan("sup.s_acctbal") & L.is_not_nan("cus.c_acctbal"))
    cols = [F.col(f"l.{c}") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                       "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                                       "l_returnflag", "l_linestatus")]
    cols += [F.col("ts.o_orderkey").alias("ts_id"), F.col("ts.o_custkey").alias("ts_custkey"),
             F.col("ts.o_orderstatus").alias("ts_orderstatus"),
             F.col("ts.o_totalprice").alias("ts_totalprice"),
             F.col("ts.o_orderpriority").alias("ts_orderpriority")]
    cols += L.date_parts(F.col("ts.o_orderdate"), "ts_date_start")
    cols += L.date_parts(F.col("l.l_shipdate"), "ts_date_finish")
    cols += [F.col("sup.s_name").alias("sup_name"), F.col("sup.s_acctbal").alias("sup_acctbal"),
             F.col("pr1.n_name").alias("pr_code_dep"), F.col("pr1.n_regionkey").alias("pr_region_dep")]
    cols += [F.col("cus.c_name").alias("cus_name"), F.col("cus.c_acctbal").alias("cus_acctbal"),
             F.col("cus.c_mktsegment").alias("cus_mktsegment"),
             F.col("pr2.n_name").alias("pr_code_dest"), F.col("pr2.n_regionkey").alias("pr_region_dest")]
    cols += [F.col("pt.p_brand").alias("pt_brand"), F.col("pt.p_type").alias("pt_type"),
             F.col("pt.p_size").alias("pt_size"), F.col("pt.p_retailprice").alias("pt_retailprice")]
    cols.append((F.col("l.l_extendedprice") * (1 - F.col("l.l_discount"))).alias("ce_cost"))
    return j.select(*cols)


def cargo_tables(t) -> tuple[DataFrame, DataFrame, DataFrame]:
    """cargo_types (lineitem), etsng_freights (parts, the odd ones under keys
    that no cargo has), dopog_freights (suppliers; three times the key is
    compared with the part size)."""
    cgt = t.lineitem.select(F.col("l_quantity").alias("weight"),
                            F.col("l_linenumber").alias("fk_cont_type"),
                            F.col("l_linenumber").alias("quantity_cont"),
                            F.col("l_tax").alias("quantity_wag"),
                            F.col("l_orderkey").alias("fk_transport_solution"),
                            F.col("l_partkey").alias("fk_etsng_freights"))
    ef = moved(t.part, "p_partkey", F.col("p_partkey") % 2 != 0).select(
        F.col("p_partkey").alias("id"), F.col("p_size").alias("rt_id"),
        F.col("p_brand").alias("code_fk_gng_freights"))
    dpf = t.supplier.select((F.col("s_suppkey") * 3).alias("rt_id_fk_etsng_freights"))
    return cgt, ef, dpf


def cargo(t, null_fill: str = "null") -> DataFrame:
    return L.cargo_guarded(*cargo_tables(t), null_fill=null_fill)


# ---------------------------------------------------------------- model roles

def scored_base(t) -> DataFrame:
    """Hold-out rows: id, group, target (0..4, zeros occur)."""
    o = t.orders
    return o.select(F.col("o_orderkey").alias("ts_id"), F.col("o_orderstatus").alias("measure"),
                    F.col("o_orderpriority").alias("service"),
                    F.floor(F.col("o_totalprice") / 100000).cast("double").alias("y"),
                    (F.col("o_totalprice") / 100000).alias("_x"))


def scored(t) -> DataFrame:
    """``scored`` plus ``pred``: the group mean of ``o_totalprice / 1e5``
    (the deterministic stand-in model, M16), computed by aggregate + join."""
    b = scored_base(t)
    m = b.groupBy("measure", "service").agg(F.avg("_x").alias("pred"))
    return b.join(m, ["measure", "service"], "inner").select("ts_id", "measure", "service", "y", "pred")


def registry(t) -> DataFrame:
    e = t.events
    return e.select(F.col("event_type").alias("measure"),
                    (F.col("user_id") % 10).cast("string").alias("service"),
                    F.col("event_id").cast("string").alias("model_run_id"),
                    F.lit(-100.0).alias("value"), F.col("value").alias("mape"),
                    F.lit(1).alias("flag"), F.col("ts").alias("date"))


def registry_stored(t) -> DataFrame:
    """Stored registry for the challenger test: the odd events (the even ones
    are the new scores), those of services 8 and 9 under names of their own."""
    user = F.col("user_id") % 10
    e = t.events.filter(F.col("event_id") % 2 == 1)
    return registry(Tables(events=e.withColumn("user_id", user))).withColumn(
        "service", F.when(F.col("service") < "8", F.col("service")).otherwise(F.concat(F.lit("old"), F.col("service"))))


def new_scores(t) -> DataFrame:
    """New model scores for the challenger test: best even event per group."""
    e = t.events.filter(F.col("event_id") % 2 == 0)
    g = e.groupBy(F.col("event_type").alias("measure"),
                  (F.col("user_id") % 10).cast("string").alias("service")).agg(F.min("value").alias("mape"))
    return g.withColumn("model_run_id", F.concat_ws("_", "measure", "service", F.lit("gbt")))


def profile(t) -> DataFrame:
    return t.orders.withColumn("k1", F.lit(1)).withColumn("n0", F.lit(None).cast("double"))
