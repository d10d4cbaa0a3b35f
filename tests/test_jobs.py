"""The two composite jobs end to end on small inputs."""

import pytest
from pyspark.sql import functions as F

from lakeops.plans.leg_costs import LegCostConfig, persist, run_leg_costs
from lakeops.plans.orders import OrderCols, run_orders_etl
from lakeops.sinks import writers as W

ORDERS_SCHEMA = "order_id long, customer_id long, order_date timestamp_ntz, total_amount double"
ITEMS_SCHEMA = "order_item_id long, order_id long, product_id long, quantity int"


def test_orders_etl(spark, tmp_path):
    d = str(tmp_path)
    customers = spark.createDataFrame([(1, "Ann"), (2, "Bob")], "customer_id long, customer_name string")
    products = spark.createDataFrame([(10, 2.5), (11, 4.0)], "product_id long, price double")
    stored_orders = spark.createDataFrame([(100, 1, "2025-06-01 00:00:00", 10.0)], ORDERS_SCHEMA.replace(
        "timestamp_ntz", "string")).withColumn("order_date", F.col("order_date").cast("timestamp_ntz"))
    stored_orders.write.parquet(f"{d}/orders")
    spark.createDataFrame([(1000, 100, 10, 1, 2.5)], ITEMS_SCHEMA + ", unit_price double") \
        .write.parquet(f"{d}/items")
    spark.createDataFrame([(1, "Ann", 1, 10.0, None), (9, "Old", 3, 30.0, None)],
                          "customer_id long, customer_name string, total_orders long, "
                          "total_spent double, last_order_date timestamp_ntz").write.parquet(f"{d}/summary")
    # new orders: one known key (skipped), one new, one of an unknown customer
    new_orders = spark.createDataFrame(
        [(100, 1, "2025-06-01 00:00:00", 10.0), (101, 2, "2025-06-02 00:00:00", 20.0),
         (102, 7, "2025-06-02 00:00:00", 5.0)], ORDERS_SCHEMA.replace("timestamp_ntz", "string"))
    W.write_csv(new_orders, f"{d}/orders_new.csv")
    new_items = spark.createDataFrame([(1000, 100, 10, 1), (1001, 101, 11, 2), (1002, 999, 10, 1),
                                       (1003, 101, 55, 1)], ITEMS_SCHEMA)
    W.write_csv(new_items, f"{d}/items_new.csv")

    rep = run_orders_etl(spark, f"{d}/orders_new.csv", f"{d}/items_new.csv", orders_path=f"{d}/orders",
                         items_path=f"{d}/items", customers=customers, products=products,
                         summary_path=f"{d}/summary", orders_schema=ORDERS_SCHEMA,
                         items_schema=ITEMS_SCHEMA, cols=OrderCols())
    assert (rep["orders"]["n_batch"], rep["orders"]["n_skipped"], rep["orders"]["n_added"]) == (2, 1, 1)
    assert (rep["items"]["n_skipped"], rep["items"]["n_added"]) == (1, 1)
    summary = {r.customer_id: r for r in spark.read.parquet(rep["summary_path"]).collect()}
    assert set(summary) == {1, 2, 9}                      # customer 9 is kept
    assert (summary[2].total_orders, summary[2].total_spent) == (1, 20.0)
    assert rep["summary"]["n_replaced"] == 1 and rep["summary"]["n_added"] == 1


@pytest.mark.parametrize("learner", ["spark_ml", "boosted"])
def test_leg_costs_job(spark, learner):
    rows = spark.range(1200).select(
        F.col("id").alias("ts_id"),
        F.when(F.col("id") % 3 == 0, "m1").otherwise("m2").alias("measure"),
        F.when(F.col("id") % 2 == 0, "s1").otherwise("s2").alias("service"),
        (F.col("id") % 17).cast("double").alias("dist"),
        F.when(F.col("id") % 5 == 0, "A").otherwise("B").alias("code"),
        F.lit(7).alias("constant_col"))
    lc = rows.withColumn("cost", F.when(F.col("service") == "s2", F.lit(42.0))
                         .otherwise(100.0 + F.col("dist") * 10 + F.when(F.col("code") == "A", 50.0).otherwise(0.0)))
    registry = spark.createDataFrame(
        [("m1", "s1", "old", -100.0, 0.5, 1, "2025-01-01 00:00:00")],
        "measure string, service string, model_run_id string, value double, mape double, flag int, "
        "date string").withColumn("date", F.col("date").cast("timestamp_ntz"))
    cfg = LegCostConfig(measure="measure", service="service", target="cost", id_col="ts_id",
                        categorical=("code",), n_trees=3, depth=3, parallelism=2, learner=learner)
    out = run_leg_costs(spark, lc, registry, cfg, as_of="2026-01-01 00:00:00")
    assert "constant_col" not in out["roles"].numeric
    single = {(r.measure, r.service): r for r in out["single_price"].collect()}
    assert set(single) == {("m1", "s2"), ("m2", "s2")} and single[("m1", "s2")].value == 42.0
    summary = out["fit"].summary.collect()
    assert {(r.measure, r.service) for r in summary} == {("m1", "s1"), ("m2", "s1")}
    dec = {(r.measure, r.service): r for r in out["decisions"].collect()}
    assert dec[("m2", "s1")].flag == 1 and dec[("m1", "s2")].model_run_id == "no_model"
    errs = out["errors"]
    assert errs.count() == out["fit"].predictions.count() and "ts_id" in errs.columns


def test_leg_costs_persisted(spark, tmp_path):
    """What a run writes can be read back, and a second run with the same
    scores adds no registry row; the split does not depend on partitioning."""
    d = str(tmp_path)
    lc = spark.range(600).select(F.col("id").alias("ts_id"), F.lit("m").alias("measure"),
                                 F.when(F.col("id") % 2 == 0, "s1").otherwise("s2").alias("service"),
                                 (F.col("id") % 17).cast("double").alias("dist"),
                                 F.when(F.col("id") % 2 == 0, 5.0).otherwise(100.0 + F.col("id") % 17).alias("cost"))
    cfg = LegCostConfig(measure="measure", service="service", target="cost", id_col="ts_id", categorical=(),
                        n_trees=3, depth=2, parallelism=1)
    ddl = "measure string, service string, model_run_id string, value double, mape double, flag int, date timestamp_ntz"
    tested = []
    for parts in (1, 7):
        registry = spark.createDataFrame([], ddl) if not tested else spark.read.parquet(paths["registry"])
        out = run_leg_costs(spark, lc.repartition(parts), registry, cfg, as_of="2026-01-01 00:00:00", out_dir=d)
        paths = persist(out, d, cfg)
        tested.append({r.ts_id for r in out["fit"].predictions.collect()})
    assert tested[0] == tested[1] and len(tested[0]) > 30
    stored = spark.read.parquet(paths["registry"]).collect()
    assert sorted((r.service, r.flag) for r in stored) == [("s1", 0), ("s2", 1)]
    errs = spark.read.parquet(paths["row_errors"])
    assert errs.count() == 2 * len(tested[0]) and errs.select("run_id").distinct().count() == 2
    champion = next(r.model_run_id for r in stored if r.flag == 1)
    assert errs.filter(F.col("run_id") == champion).count() == len(tested[0])
    fits = spark.read.parquet(paths["fits"]).collect()
    from pyspark.ml import PipelineModel
    assert [PipelineModel.load(r.model_path).stages[-1].getNumTrees for r in fits] == [r.n_trees for r in fits]
    balance = spark.read.option("header", True).csv(paths["balance"])
    assert {r.service for r in balance.select("service").collect()} == {"s1", "s2"}
    assert spark.read.option("header", True).csv(paths["service_counts"]).count() == 2
