"""Replace by key without rewriting the table.

The rows of a table lie in ``n`` folders by a hash of their key, the
partitions of a catalog table.  A batch reads and rewrites only the folders
that its keys fall into; the new files go to a folder of their own and the
catalog's partitions are pointed at them afterwards, one by one.  Files of
other buckets, and the old files of the rewritten ones, are not touched, so a
query that was planned before the switch still finds what it planned to read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators.keyed import next_version, table_location, upsert_by_key
from lakeops.session import scratch_path

BUCKET = "key_bucket"
_KEY, _COUNT = "bucketed.key", "bucketed.count"


def bucket_of(key: Column, key_type: str, buckets: int) -> Column:
    """Bucket of a key.  The hash depends on the type, so the key takes the
    table's; zero and minus zero are one key; NULL is a key like any other."""
    key = key.cast(key_type)
    if key_type in ("float", "double"):
        key = key + F.lit(0.0).cast(key_type)
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_buckets(df: DataFrame, path: str) -> None:
    """One folder per bucket.  ``rebalance`` cuts a bucket that is larger than
    the others into several tasks (and files), whatever its keys."""
    df.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(path)


def create_bucketed(rows: DataFrame, table: str, key: str, buckets: int, location: str) -> None:
    """Make ``table`` of these rows, in ``buckets`` folders below ``location``.

    Takes any number of rows, repeated and NULL keys included.  An existing
    table of this name is an error.
    """
    if buckets < 1:
        raise ValueError("at least one bucket is needed")
    if BUCKET in rows.columns:
        raise ValueError(f"column name {BUCKET!r} is taken by the table layout")
    spark = rows.sparkSession
    kind = rows.schema[key].dataType.simpleString()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    spark.sql(f"CREATE TABLE {table} ({columns}, {BUCKET} INT) USING parquet PARTITIONED BY ({BUCKET}) "
              f"LOCATION '{location}' TBLPROPERTIES ('{_KEY}' = '{key}', '{_COUNT}' = '{buckets}')")
    version = next_version(location)
    write_buckets(rows.withColumn(BUCKET, bucket_of(F.col(key), kind, buckets)), version)
    written = spark.read.schema(spark.table(table).schema).parquet(version)
    point_to(spark, table, version, touched_buckets(written))


def table_layout(spark: SparkSession, table: str) -> tuple[str, int]:
    """Key column and number of buckets of a table made by :func:`create_bucketed`."""
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    if _KEY not in props:
        raise ValueError(f"{table} has no key buckets")
    return props[_KEY], int(props[_COUNT])


def touched_buckets(rows: DataFrame) -> list[int]:
    """Their distinct buckets: at most as many as the table has."""
    return sorted(r[0] for r in rows.select(BUCKET).distinct().collect())


def switch_partition(spark: SparkSession, table: str, bucket: int, folder: str) -> None:
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({BUCKET} = {bucket}) LOCATION '{folder}'")
    spark.sql(f"ALTER TABLE {table} PARTITION ({BUCKET} = {bucket}) SET LOCATION '{folder}'")


def point_to(spark: SparkSession, table: str, version: str, buckets: list[int]) -> None:
    for b in buckets:
        switch_partition(spark, table, b, f"{version}/{BUCKET}={b}")
    spark.sql(f"REFRESH TABLE {table}")


def bucketed_rows(spark: SparkSession, table: str) -> DataFrame:
    """The table without its layout column."""
    return spark.table(table).drop(BUCKET)


def replace_in_buckets(spark: SparkSession, table: str, new: DataFrame, null_safe: bool = True) -> list[int]:
    """Stored rows whose key is in ``new`` go, all of ``new`` comes in; return
    the buckets that were rewritten.

    Only these buckets are scanned (partition pruning), shuffled and written.
    Columns are matched by name and take the table's types.  An empty batch
    changes nothing.  A job that dies while the files are written leaves the
    table as it was.  One that dies between two switches leaves each bucket
    wholly old or wholly new, and running the same batch again ends as if
    nothing had happened, as replacing by the same rows twice changes nothing.
    One writer at a time.  A batch with keys in every bucket rewrites the
    whole table, as :func:`~lakeops.operators.keyed.replace_by_key_table` does.
    """
    key, buckets = table_layout(spark, table)
    stored = spark.table(table)
    fields = [f for f in stored.schema.fields if f.name != BUCKET]
    kind = stored.schema[key].dataType.simpleString()
    staged = scratch_path(spark, "replace_batch")
    new.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in fields]) \
        .withColumn(BUCKET, bucket_of(F.col(key), kind, buckets)).write.parquet(staged)
    batch = spark.read.schema(stored.schema).parquet(staged)
    touched = touched_buckets(batch)
    if touched:
        version = next_version(table_location(spark, table))
        write_buckets(upsert_by_key(stored.filter(F.col(BUCKET).isin(touched)), batch, key, null_safe), version)
        point_to(spark, table, version, touched)
    return touched
