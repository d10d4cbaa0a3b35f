"""Keyed loads: semi/anti joins, insert-only-new-keys, replace-by-key.

(J1, J2, J3, K1, K2, A17, F4, F5, F8, U3)

The original jobs shipped batch keys to the database as a literal
``IN (...)`` tuple; that text breaks for one- and zero-element batches and
grows with the batch.  Here every key test is a join: Spark shuffles both
sides on the key (or broadcasts a side whose measured size is under the
AQE threshold), so nothing passes through the driver.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.session import scratch_path
from lakeops.sinks.writers import set_table_location

_K = "__lakeops_key"


def _key_cond(left: DataFrame, right_key: Column, key: str, null_safe: bool) -> Column:
    return left[key].eqNullSafe(right_key) if null_safe else (left[key] == right_key)


def semi_join(df: DataFrame, ref: DataFrame, key: str, ref_key: str | None = None,
              null_safe: bool = False) -> DataFrame:
    """Rows of ``df`` whose ``key`` occurs in ``ref``."""
    r = ref.select(F.col(ref_key or key).alias(_K))
    return df.join(r, _key_cond(df, r[_K], key, null_safe), "left_semi")


def anti_join(df: DataFrame, ref: DataFrame, key: str, ref_key: str | None = None,
              null_safe: bool = False) -> DataFrame:
    """Rows of ``df`` whose ``key`` does not occur in ``ref``.

    Unlike ``NOT IN (list)``, a NULL among the reference keys does not
    empty the result.  With ``null_safe`` a NULL key matches a NULL key.
    """
    r = ref.select(F.col(ref_key or key).alias(_K))
    return df.join(r, _key_cond(df, r[_K], key, null_safe), "left_anti")


def check_unique(df: DataFrame, key: str | list[str]) -> bool:
    """True when no key value repeats (one aggregate over the key column)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).count().filter(F.col("count") > 1).isEmpty()


def dedupe_batch(batch: DataFrame, key: str, dedupe: str = "error") -> DataFrame:
    """Policy for a key repeated inside one batch.

    ``error`` (default) raises, ``first`` keeps one row per key (the smallest
    of its rows, so a run again keeps the same), ``none`` keeps all rows as the
    original loader did.
    """
    if dedupe == "none":
        return batch
    if dedupe == "first":
        rest = [c for c in batch.columns if c != key]
        one = batch.groupBy(key).agg(F.min(F.struct(*rest)).alias("_row")) if rest else batch.distinct()
        return one.select(*[F.col(key) if c == key else F.col("_row")[c].alias(c) for c in batch.columns])
    if dedupe == "error":
        if not check_unique(batch, key):
            raise ValueError(f"batch has repeated values of key {key!r}")
        return batch
    raise ValueError(f"unknown dedupe policy {dedupe!r}")


def new_key_rows(batch: DataFrame, stored: DataFrame, key: str,
                 dedupe: str = "none") -> DataFrame:
    """Batch rows whose key is not stored yet (K1, lazy).  A NULL key is a key
    like any other: once stored, it is not added again."""
    return anti_join(dedupe_batch(batch, key, dedupe), stored, key, null_safe=True)


def insert_new_keys(batch: DataFrame, stored: DataFrame, key: str,
                    dedupe: str = "none") -> DataFrame:
    """Stored rows plus the batch rows with new keys (K1 as a pure plan)."""
    new = new_key_rows(batch, stored, key, dedupe)
    return stored.unionByName(new.select(*stored.columns))


def insert_new_keys_report(batch: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """One row: ``n_batch``, ``n_skipped`` (key already stored), ``n_added``.

    Stored keys are de-duplicated by an aggregate whose hash partitioning the
    join reuses, then each batch key is flagged by a left join: one shuffle
    per side, one aggregate.
    """
    hits = stored.select(F.col(key).alias(_K)).dropDuplicates([_K]).withColumn("_hit", F.lit(1))
    b = batch.select(key)
    j = b.join(hits, b[key].eqNullSafe(hits[_K]), "left")
    return j.agg(F.count(F.lit(1)).alias("n_batch"),
                 F.count("_hit").alias("n_skipped"),
                 F.count_if(F.col("_hit").isNull()).alias("n_added"))


def append_new_keys(batch: DataFrame, target_path: str, key: str,
                    dedupe: str = "error", fmt: str = "parquet") -> dict[str, int]:
    """Append the batch rows with new keys to a table folder; return counts.

    The batch is written to the shared folder once, so the check of its keys,
    the report and the append read it instead of computing it again.  Appending while the same folder is
    scanned is safe: the scan lists its files when the job is planned.
    """
    spark = batch.sparkSession
    path = scratch_path(spark, "batch")
    batch.write.parquet(path)
    batch = dedupe_batch(spark.read.schema(batch.schema).parquet(path), key, dedupe)
    stored = spark.read.format(fmt).load(target_path)
    report = insert_new_keys_report(batch, stored, key).first().asDict()
    if report["n_added"] > 0:
        new_key_rows(batch, stored, key).select(*stored.columns) \
            .write.mode("append").format(fmt).save(target_path)
    return report


def upsert_by_key(stored: DataFrame, new: DataFrame, key: str,
                  null_safe: bool = True) -> DataFrame:
    """Replace by key: stored rows whose key is absent from ``new``, plus all
    of ``new`` (K2, U3).  Rows for other keys stay.

    The key match is NULL-safe by default: a NULL key replaces the stored
    NULL-key row instead of being appended again on every run.
    """
    kept = anti_join(stored, new, key, null_safe=null_safe)
    return kept.unionByName(new.select(*stored.columns))


def upsert_report(stored: DataFrame, new: DataFrame, key: str,
                  null_safe: bool = True) -> DataFrame:
    """One row: ``n_replaced``, ``n_added``, ``n_kept``, ``n_total``.

    Both key sets are reduced to distinct keys (partial aggregation) and
    outer-joined once.
    """
    s = stored.select(F.col(key).alias(_K)).dropDuplicates([_K]).withColumn("_s", F.lit(1))
    n = new.select(F.col(key).alias("_nk")).dropDuplicates(["_nk"]).withColumn("_n", F.lit(1))
    cond = s[_K].eqNullSafe(n["_nk"]) if null_safe else (s[_K] == n["_nk"])
    j = s.join(n, cond, "full_outer")
    both = F.col("_s").isNotNull() & F.col("_n").isNotNull()
    return j.agg(F.count_if(both).alias("n_replaced"),
                 F.count_if(F.col("_s").isNull()).alias("n_added"),
                 F.count_if(F.col("_n").isNull()).alias("n_kept"),
                 F.count_if(F.col("_n").isNotNull() | F.col("_s").isNotNull()).alias("n_total"))


def next_version(location: str) -> str:
    """A new folder beside ``location``: the next version of the same table."""
    return f"{location.rstrip('/').rsplit('__v', 1)[0]}__v{uuid.uuid4().hex[:12]}"


def replace_by_key_path(stored_path: str, new: DataFrame, key: str, out_path: str | None = None,
                        fmt: str = "parquet", null_safe: bool = True) -> str:
    """Write ``upsert_by_key`` of a stored folder to a *new* folder beside it;
    return it.

    Plain Parquet has no ``MERGE``/``DELETE``, and Spark refuses to overwrite
    a folder the same plan reads; the staged folder is the new version, and
    readers switch to it after the write job has committed.
    """
    spark = new.sparkSession
    stored = spark.read.format(fmt).load(stored_path)
    out_path = out_path or next_version(stored_path)
    upsert_by_key(stored, new, key, null_safe).write.mode("overwrite").format(fmt).save(out_path)
    return out_path


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    for r in rows:
        if r[0] == "Location":
            return r[1]
    raise ValueError(f"no location for table {table}")


def replace_by_key_table(spark: SparkSession, table: str, new: DataFrame, key: str,
                         null_safe: bool = True) -> str:
    """Replace-by-key on a catalog table: write the merged rows to a sibling
    folder of the current location, then switch the table to it in one
    metadata step.  Returns the new location."""
    out = next_version(table_location(spark, table))
    upsert_by_key(spark.table(table), new, key, null_safe).write.mode("overwrite").parquet(out)
    set_table_location(spark, table, out)
    return out


def items_with_unit_price(items: DataFrame, orders: DataFrame, products: DataFrame, *,
                          order_key: str, product_key: str, price_col: str,
                          items_order_key: str | None = None, items_product_key: str | None = None,
                          out_col: str = "unit_price") -> DataFrame:
    """Items of known orders with the product price as ``unit_price``.

    An item whose order or product is unknown is dropped.  The order test is
    a semi join (orders is keyed); the price comes from an inner join.
    NULL keys never match (Spark's rule; pandas would match NaN with NaN).
    """
    known = semi_join(items, orders, items_order_key or order_key, order_key)
    return with_unit_price(known, products, product_key=product_key, price_col=price_col,
                           items_product_key=items_product_key, out_col=out_col)


def with_unit_price(items: DataFrame, products: DataFrame, *, product_key: str, price_col: str,
                    items_product_key: str | None = None, out_col: str = "unit_price") -> DataFrame:
    """Items of known products with the product price."""
    p = products.select(F.col(product_key).alias(_K), F.col(price_col).alias(out_col))
    return items.join(p, items[items_product_key or product_key] == p[_K], "inner").drop(_K)
