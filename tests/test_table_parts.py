"""Tables written in parts, and the shuffle files that a write leaves."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF_ORACLE
from lakeops.sinks import writers as W


def shuffle_files(spark) -> set[str]:
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f.rsplit("/", 1)[-1] for f in found.splitlines() if "/shuffle_" in f}


def test_a_written_table_leaves_no_shuffle(spark, tmp_path):
    rows = spark.range(5000).groupBy((F.col("id") % 700).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    before = shuffle_files(spark)
    W.overwrite_table(rows, path=str(tmp_path / "t"))
    assert not shuffle_files(spark) - before
    assert spark.read.parquet(str(tmp_path / "t")).count() == 700


def test_result_table_leaves_no_shuffle(spark):
    before = shuffle_files(spark)
    out = entry.queries()["ctas_legs_costs_result"](spark, SF_ORACLE)
    assert not shuffle_files(spark) - before
    want = entry.queries()["legs_costs_result"](spark, SF_ORACLE)
    assert out.schema == want.schema and out.count() == want.count() > 0
    assert out.exceptAll(want).isEmpty()


def test_every_row_is_in_one_part(spark, tmp_path):
    """Null keys and repeated rows too; a part may be empty."""
    rows = spark.createDataFrame([(None, 1), (None, 1), (3, 2), (3, 2), (4, None), (-7, 5)], "k long, v int")
    for parts in (1, 3, 9):
        name, path = f"lakeops_parts_{parts}", str(tmp_path / f"p{parts}")
        W.drop_table(spark, name)
        W.overwrite_table_in_parts(rows, name, path, "k", parts, fmt="orc", compression="zstd")
        assert sorted(map(tuple, spark.read.orc(path).collect()), key=repr) == sorted(map(tuple, rows.collect()), key=repr)
        assert spark.table(name).count() == 6
        W.drop_table(spark, name)


def test_setting_is_put_back(spark, tmp_path):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    W.overwrite_table(spark.range(3), path=str(tmp_path / "t"))
    assert spark.conf.get(key, None) == before
