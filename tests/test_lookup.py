"""Lookups against a stored table in buckets: plans and rows."""

import re

import pytest
from pyspark.sql import functions as F

from lakeops.operators import lookup as U


@pytest.fixture
def table(spark, tmp_path):
    name = "t_lookup_" + re.sub(r"\W", "_", tmp_path.name)
    rows = spark.range(1000).select(F.when(F.col("id") != 3, F.col("id") * 2).alias("k"), F.col("id").alias("v"))
    U.store_by_key(rows, name, "k", 8, f"{tmp_path}/t")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield name
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    spark.sql(f"DROP TABLE {name}")


def above(plan: str, what: str) -> list[str]:
    """Operators over the line that holds ``what``, inmost first."""
    lines = plan.split("\n")
    at = next(i for i, line in enumerate(lines) if what in line)
    depth, out = len(re.match(r"[\s:+\-]*", lines[at])[0]), []
    for line in reversed(lines[:at]):
        d = len(re.match(r"[\s:+\-]*", line)[0])
        if d < depth:
            out.append(line.strip(" :+-"))
            depth = d
    return out


@pytest.mark.parametrize("many", [2, 64])
def test_stored_side_is_not_shuffled(spark, table, many):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(many))
        batch = spark.range(50).select(F.col("id").alias("k"))
        for f in (U.rows_with_stored_key, U.rows_with_new_key):
            plan = f(batch, table, "k")._jdf.queryExecution().executedPlan().toString()
            up = above(plan, "Bucketed: true")
            join = next(i for i, x in enumerate(up) if "Join" in x)
            assert not any("Exchange" in x for x in up[:join]), plan
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_rows(spark, table):
    batch = spark.createDataFrame([(2, "a"), (2, "a"), (3, "b"), (6, "c"), (None, "d")], "k int, x string")
    key = lambda df: sorted((r.k is None, r.k or 0, r.x) for r in df.collect())
    assert key(U.rows_with_stored_key(batch, table, "k")) == [(False, 2, "a"), (False, 2, "a")]
    assert key(U.rows_with_new_key(batch, table, "k")) == [(False, 3, "b"), (False, 6, "c")]      # the table has a NULL
    assert U.rows_with_new_key(batch.limit(0), table, "k").count() == 0
    new = spark.createDataFrame([(5, 1), (5, 2), (4, 3), (None, 4)], "k long, v long")
    for _ in range(2):
        U.append_new_keys_stored(new, table, "k")
        assert spark.table(table).count() == 1002
    assert key(U.rows_with_stored_key(batch.withColumn("k", F.lit(5)), table, "k"))[0][1] == 5
    with pytest.raises(ValueError):
        U.rows_with_new_key(batch, table, "x", "v")


def test_empty_table_and_hot_key(spark, tmp_path):
    U.store_by_key(spark.createDataFrame([], "k long"), "t_lookup_empty", "k", 4, f"{tmp_path}/e")
    hot = spark.range(3000).select(F.lit(7).cast("long").alias("k")).union(spark.sql("SELECT CAST(NULL AS LONG)"))
    assert U.rows_with_new_key(hot, "t_lookup_empty", "k").count() == 3001
    assert U.rows_with_stored_key(hot, "t_lookup_empty", "k").count() == 0
    U.store_by_key(hot, "t_lookup_hot", "k", 4, f"{tmp_path}/h")
    assert U.rows_with_stored_key(hot, "t_lookup_hot", "k").count() == 3000
    assert U.rows_with_new_key(hot, "t_lookup_hot", "k").count() == 0
    for n in ("t_lookup_empty", "t_lookup_hot"):
        spark.sql(f"DROP TABLE {n}")
