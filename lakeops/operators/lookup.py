"""Key lookups against a large stored table that is never shuffled.

The stored table is written once in Spark's own buckets of its key.  A batch
is reduced to its distinct keys, these are shuffled to the table's buckets and
meet it there; the few keys that were found are then joined back to the batch.
So what moves grows with the batch, not with the table, and a key that a third
of the batch has is one row when it meets the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.operators.keyed import anti_join, semi_join

_SLOT = "__lakeops_slot"
_FOUND = "__lakeops_key"


def store_by_key(rows: DataFrame, table: str, key: str, buckets: int, path: str) -> None:
    """Write ``rows`` as a table in ``buckets`` buckets of ``key``.

    Rows are brought together by bucket first, so that a bucket is one file
    and not one for each task; a bucket far larger than the others (a hot or
    NULL key) is cut into several tasks and files.
    """
    slot = F.pmod(F.hash(F.col(key)), F.lit(buckets))
    rows.withColumn(_SLOT, slot).hint("rebalance", _SLOT).drop(_SLOT) \
        .write.bucketBy(buckets, key).format("parquet").option("path", path).saveAsTable(table)


def bucket_count(spark: SparkSession, table: str, key: str) -> int:
    """Buckets of the table; they must be of this key alone."""
    found = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    if found.get("Bucket Columns", "").strip("[]`") != key:
        raise ValueError(f"{table} has no buckets of {key!r}")
    return int(found["Num Buckets"])


def found_keys(batch: DataFrame, table: str, key: str, table_key: str | None = None) -> DataFrame:
    """The batch's distinct keys that the stored table has, in the table's
    buckets.  NULL is never found."""
    spark = batch.sparkSession
    table_key = table_key or key
    stored = spark.table(table).select(F.col(table_key).alias(_FOUND))
    kind = stored.schema[_FOUND].dataType
    keys = batch.select(F.col(key).cast(kind).alias(key)).filter(F.col(key).isNotNull())
    # The partial aggregate comes before the shuffle, the final one uses its partitioning.
    keys = keys.distinct().repartition(bucket_count(spark, table, table_key), key)
    return keys.join(stored, F.col(key) == F.col(_FOUND), "left_semi")


def rows_with_stored_key(batch: DataFrame, table: str, key: str, table_key: str | None = None) -> DataFrame:
    """Batch rows whose key the stored table has (J1, S6); NULL matches nothing."""
    return semi_join(batch, found_keys(batch, table, key, table_key), key)


def rows_with_new_key(batch: DataFrame, table: str, key: str, table_key: str | None = None) -> DataFrame:
    """Batch rows whose key the stored table has not (J2, K1).  A NULL key is
    new unless the table has one."""
    rest = anti_join(batch, found_keys(batch, table, key, table_key), key)
    has_null = batch.sparkSession.table(table).filter(F.col(table_key or key).isNull()) \
        .select(F.lit(True).alias(_FOUND)).limit(1)                  # one row at most
    return rest.join(F.broadcast(has_null), rest[key].isNull() == has_null[_FOUND], "left_anti")


def append_new_keys_stored(batch: DataFrame, table: str, key: str) -> None:
    """Append the batch rows with new keys to the bucketed table itself (K1).

    The rows are written below the table's folder in its buckets.  A run after
    a finished one adds nothing, as its keys are stored by then.  Where keys
    repeat inside a batch and a run may die while its files are committed, load
    by :func:`lakeops.operators.batches.append_new_keys_once`.
    """
    spark = batch.sparkSession
    new = rows_with_new_key(batch, table, key)
    new.select(*spark.table(table).columns).write.mode("append").insertInto(table)
