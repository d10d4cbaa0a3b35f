"""Files written in key order: what Parquet's statistics say."""

import glob

import pyarrow.parquet as pq

from lakeops.sinks.writers import write_clustered


def ranges(folder, column):
    out = []
    for f in glob.glob(f"{folder}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.names.index(column)
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at).statistics
            out.append((s.min, s.max))
    return sorted(out)


def test_a_key_filter_needs_few_files(spark, tmp_path):
    df = spark.range(40_000).selectExpr("(id * 7919) % 10000 AS k", "id AS v").repartition(8)
    write_clustered(df, f"{tmp_path}/c", ["k"], 16)
    got = ranges(f"{tmp_path}/c", "k")
    assert len(got) > 8
    assert all(a[1] <= b[0] for a, b in zip(got, got[1:], strict=False))
    assert max(sum(lo <= k <= hi for lo, hi in got) for k in range(0, 10_000, 37)) <= 2
    df.sortWithinPartitions("k").write.parquet(f"{tmp_path}/own")             # each task on its own: every file has every key's range
    assert sum(lo <= 5000 <= hi for lo, hi in ranges(f"{tmp_path}/own", "k")) == 8


def test_a_hot_key_spans_files_and_no_row_is_lost(spark, tmp_path):
    df = spark.range(30_000).selectExpr("IF(id % 3 > 0, 5, id) AS k", "id AS v").union(spark.sql("SELECT CAST(NULL AS LONG), 1L"))
    write_clustered(df, f"{tmp_path}/h", ["k"], 8)
    back = spark.read.parquet(f"{tmp_path}/h")
    assert back.columns == ["k", "v"] and back.exceptAll(df).isEmpty() and back.count() == 30_001
    assert sum(lo is not None and lo <= 5 <= hi for lo, hi in ranges(f"{tmp_path}/h", "k")) >= 4
    write_clustered(df.limit(0), f"{tmp_path}/e", ["k"], 8)
