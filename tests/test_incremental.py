"""Key buckets and batches: what is left alone, and runs after a crash."""

import os

import pytest
from pyspark.sql import functions as F

from lakeops.operators import batches as B, bucketed as K
from lakeops.operators.keyed import upsert_by_key


class Crash(Exception):
    pass


def crash_at(monkeypatch, module, name, call=1):
    """The ``call``-th use of ``module.name`` dies before it does anything."""
    real, seen = getattr(module, name), []

    def f(*args, **kwargs):
        seen.append(1)
        if len(seen) == call:
            raise Crash
        return real(*args, **kwargs)
    monkeypatch.setattr(module, name, f)


def files(folder):
    return {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns
            for d, _, names in os.walk(folder) for n in names}


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


@pytest.fixture
def stored(spark, tmp_path):
    name = f"t_{os.path.basename(tmp_path).replace('-', '_')}"
    df = spark.range(400).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), F.lit("old").alias("v"))
    K.create_bucketed(df, name, "k", 16, f"{tmp_path}/table")
    yield name, df, str(tmp_path)
    spark.sql(f"DROP TABLE {name}")


def test_only_touched_buckets_are_rewritten(spark, stored):
    name, df, folder = stored
    before = files(folder)
    new = spark.createDataFrame([("new", 7), ("new", 7), ("null", None), ("add", 9_000)], "v string, k int")
    touched = K.replace_in_buckets(spark, name, new)
    assert 0 < len(touched) <= 3
    after = files(folder)
    assert all(after[f] == t for f, t in before.items())              # nothing old was changed
    written = {f for f in after if f not in before and f.endswith(".parquet")}
    assert {int(f.split(f"{K.BUCKET}=")[1].split("/")[0]) for f in written} == set(touched)
    want = upsert_by_key(df, new.select(F.col("k").cast("long").alias("k"), "v"), "k")
    assert rows(K.bucketed_rows(spark, name), "k", "v") == rows(want, "k", "v")


def test_only_touched_buckets_are_read(spark, stored):
    name, _, _ = stored
    plan = spark.table(name).filter(F.col(K.BUCKET).isin([3]))._jdf.queryExecution().executedPlan().toString()
    assert f"{K.BUCKET}" in plan.split("PartitionFilters")[1].split("]")[0]
    assert len(spark.table(name).filter(F.col(K.BUCKET) == 3).inputFiles()) < len(spark.table(name).inputFiles())


def test_an_empty_batch_changes_nothing(spark, stored):
    name, df, folder = stored
    before = files(folder)
    assert K.replace_in_buckets(spark, name, df.limit(0)) == []
    assert files(folder) == before


def test_buckets_of_an_empty_table_and_of_other_key_types(spark, tmp_path):
    for kind in ("double", "string", "date"):
        name = f"t_empty_{kind}"
        empty = spark.createDataFrame([], f"k {kind}, v int")
        K.create_bucketed(empty, name, "k", 4, f"{tmp_path}/{kind}")
        assert K.bucketed_rows(spark, name).count() == 0
        one = spark.sql(f"SELECT CAST({'-0.0' if kind == 'double' else 'NULL'} AS {kind}) k, 1 v")
        two = spark.sql(f"SELECT CAST({'0.0' if kind == 'double' else 'NULL'} AS {kind}) k, 2 v")
        K.replace_in_buckets(spark, name, one)
        K.replace_in_buckets(spark, name, two)
        assert rows(K.bucketed_rows(spark, name), "v") == [(2,)]
        spark.sql(f"DROP TABLE {name}")


def test_a_hot_key_is_written_in_parts(spark, tmp_path):
    """A key with nearly all rows does not end in one file."""
    hot = spark.range(200_000).select(F.lit(1).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
        K.create_bucketed(hot, "t_hot", "k", 8, f"{tmp_path}/hot")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    assert len(spark.table("t_hot").inputFiles()) > 1
    assert spark.table("t_hot").count() == 200_000
    spark.sql("DROP TABLE t_hot")


@pytest.mark.parametrize("call", [1, 2, 3])
def test_replace_after_a_crash_between_switches(spark, stored, monkeypatch, call):
    name, df, _ = stored
    new = spark.range(1, 400, 40).select(F.col("id").alias("k"), F.lit("new").alias("v"))
    crash_at(monkeypatch, K, "switch_partition", call)
    with pytest.raises(Crash):
        K.replace_in_buckets(spark, name, new)
    spark.sql(f"REFRESH TABLE {name}")
    assert K.bucketed_rows(spark, name).count() == 400                # every bucket whole
    monkeypatch.undo()
    K.replace_in_buckets(spark, name, new)
    assert rows(K.bucketed_rows(spark, name), "k", "v") == rows(upsert_by_key(df, new, "k"), "k", "v")


def test_replace_after_a_crash_before_the_switch(spark, stored, monkeypatch):
    name, df, _ = stored
    crash_at(monkeypatch, K, "point_to")
    with pytest.raises(Crash):
        K.replace_in_buckets(spark, name, df.limit(5).withColumn("v", F.lit("new")))
    assert rows(K.bucketed_rows(spark, name), "k", "v") == rows(df, "k", "v")


# ------------------------------------------------------------------ batches

SCHEMA = "k long, v string"


def batch(spark, *keys):
    return spark.createDataFrame([(k, f"{k}/{i}") for i, k in enumerate(keys)], SCHEMA)


@pytest.mark.parametrize("at", ["write_batch", "write_marker"])
@pytest.mark.parametrize("dedupe", ["error", "none"])
def test_new_keys_after_a_crash(spark, tmp_path, monkeypatch, at, dedupe):
    """A crash between report and append, or after the append."""
    path = f"{tmp_path}/t"
    first, second = batch(spark, 1, 2, None), batch(spark, 2, 3, 4, None, *([5, 5] if dedupe == "none" else [5]))
    assert B.append_new_keys_once(first, path, "k", "007") == {"n_batch": 3, "n_skipped": 0, "n_added": 3}
    crash_at(monkeypatch, B, at)
    with pytest.raises(Crash):
        B.append_new_keys_once(second, path, "k", "008", dedupe)
    assert rows(B.committed_rows(spark, path, first.schema), "k") == rows(first, "k")
    monkeypatch.undo()
    n = second.count()
    want = {"n_batch": n, "n_skipped": 2, "n_added": n - 2}
    for _ in range(2):                                               # again, and once more when it is done
        assert B.append_new_keys_once(second, path, "k", "008", dedupe) == want
        got = rows(B.table_rows(spark, path, first.schema), "k", B.BATCH)
        assert got == sorted([(1, "007"), (2, "007"), (None, "007"), (3, "008"), (4, "008"),
                              *[(5, "008")] * (n - 4)], key=repr)


@pytest.mark.parametrize("at", ["write_batch", "write_marker"])
def test_append_after_a_crash(spark, tmp_path, monkeypatch, at):
    path = f"{tmp_path}/t"
    rows_in = batch(spark, 1, 1, None)
    crash_at(monkeypatch, B, at)
    with pytest.raises(Crash):
        B.append_batch(rows_in, path, "2025-06-12")
    monkeypatch.undo()
    for _ in range(2):
        assert B.append_batch(rows_in, path, "2025-06-12") == {"n_batch": 3, "n_skipped": 0, "n_added": 3}
    assert rows(B.committed_rows(spark, path, rows_in.schema), "k", "v") == rows(rows_in, "k", "v")


def test_batches_without_rows_and_bad_ids(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert B.append_new_keys_once(batch(spark, 1).limit(0), path, "k", "a") == {"n_batch": 0, "n_skipped": 0, "n_added": 0}
    assert B.append_batch(batch(spark, 1).limit(0), path, "b")["n_added"] == 0
    assert B.committed_rows(spark, path, batch(spark, 1).schema).count() == 0
    for bad in ("", "a/b", "_x", ".x", "ä"):
        with pytest.raises(ValueError):
            B.append_batch(batch(spark, 1), path, bad)
    with pytest.raises(ValueError):
        B.append_new_keys_once(batch(spark, 1, 1), path, "k", "c")


@pytest.mark.parametrize("call", [1, 2, 3, 4])
def test_daily_job_after_a_crash(spark, tmp_path, monkeypatch, call):
    """The orders job dies at each of its four writes and is run again."""
    from lakeops.plans.orders import run_orders_etl
    from lakeops.sinks.writers import write_csv
    d = str(tmp_path)
    customers = spark.createDataFrame([(1, "Ann"), (2, "Bob")], "customer_id long, customer_name string")
    products = spark.createDataFrame([(10, 2.5)], "product_id long, price double")
    orders, items = "order_id long, customer_id long, order_date date, total_amount double", "order_item_id long, order_id long, product_id long"
    write_csv(spark.sql("SELECT id AS order_id, 1 + id % 3 AS customer_id, date'2025-06-01' AS order_date, 2.0D AS total_amount FROM range(9)"), f"{d}/o")
    write_csv(spark.sql("SELECT id AS order_item_id, id % 9 AS order_id, 10L AS product_id FROM range(20)"), f"{d}/i")
    spark.createDataFrame([], "customer_id long, customer_name string, total_orders long, total_spent double, last_order_date date").write.parquet(f"{d}/s")

    def run():
        return run_orders_etl(spark, f"{d}/o", f"{d}/i", orders_path=f"{d}/orders", items_path=f"{d}/items", customers=customers, products=products,
                              summary_path=f"{d}/s", orders_schema=orders, items_schema=items, batch_id="2025-06-12")
    crash_at(monkeypatch, B, "write_batch" if call % 2 else "write_marker", (call + 1) // 2)
    with pytest.raises(Crash):
        run()
    monkeypatch.undo()
    for _ in range(2):
        rep = run()
        assert rep["orders"]["n_added"] == 6 and rep["items"]["n_added"] == spark.read.parquet(f"{d}/items").count() == 14
        assert rows(spark.read.parquet(rep["summary_path"]), "customer_id", "total_orders", "total_spent") == [(1, 3, 6.0), (2, 3, 6.0)]
