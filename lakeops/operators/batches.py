"""Appends that can be run again.

Every batch has an id and a folder of its own in the table
(``batch_id=...``), which a second run overwrites instead of adding to it, and
a marker beside the table, written last, which holds the batch's report.  A
batch with a marker is done: running it again reads the report and writes
nothing.  One without is done again from the start; what its first run had
added is left out when the stored keys are looked up, and is replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType
from pyspark.errors import AnalysisException

from lakeops.operators.keyed import dedupe_batch, insert_new_keys_report, new_key_rows
from lakeops.session import scratch_path

BATCH = "batch_id"
_REPORT = "n_batch long, n_skipped long, n_added long, batch_id string"


def marker_path(path: str) -> str:
    return f"{path.rstrip('/')}__batches"


def _scan(spark: SparkSession, path: str, schema) -> DataFrame:
    """A folder partitioned by batch; ids stay text ('007' is not 7).  A folder
    that is not there yet is an empty table."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def batch_report(spark: SparkSession, path: str, batch_id: str) -> dict[str, int] | None:
    """Report of a finished batch, or None."""
    done = _scan(spark, marker_path(path), _REPORT).filter(F.col(BATCH) == batch_id).drop(BATCH).first()
    return done.asDict() if done else None


def table_rows(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All rows of the table with their batch, also those of an unfinished one."""
    return _scan(spark, path, StructType(schema.fields).add(BATCH, StringType()))


def committed_rows(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows of finished batches.  The join with the markers is on the
    partition column, so folders of other batches are not read (dynamic
    partition pruning)."""
    done = _scan(spark, marker_path(path), _REPORT).select(BATCH)
    return table_rows(spark, path, schema).join(done, BATCH, "left_semi").select(*schema.fieldNames())


def write_batch(rows: DataFrame, path: str, batch_id: str) -> None:
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{BATCH}={batch_id}")


def write_marker(spark: SparkSession, path: str, batch_id: str, report: dict[str, int]) -> None:
    """One row in one file: it is there as a whole or not at all."""
    row = [(report["n_batch"], report["n_skipped"], report["n_added"])]
    spark.createDataFrame(row, "n_batch long, n_skipped long, n_added long").coalesce(1) \
        .write.mode("overwrite").parquet(f"{marker_path(path)}/{BATCH}={batch_id}")


def _checked(batch_id: str) -> str:
    """Ids name folders, so they are plain words."""
    if not batch_id or not all(c.isascii() and (c.isalnum() or c in "-_.") for c in batch_id) or batch_id[0] in "._":
        raise ValueError(f"batch id {batch_id!r}: letters, digits, '-', '_' and '.' only, none of the last two in front")
    return batch_id


def append_batch(batch: DataFrame, path: str, batch_id: str) -> dict[str, int]:
    """Append all rows of the batch once (K4); return its report."""
    spark = batch.sparkSession
    done = batch_report(spark, path, _checked(batch_id))
    if done:
        return done
    write_batch(batch, path, batch_id)
    n = spark.read.schema(batch.schema).parquet(f"{path.rstrip('/')}/{BATCH}={batch_id}").count()
    report = {"n_batch": n, "n_skipped": 0, "n_added": n}
    write_marker(spark, path, batch_id, report)
    return report


def append_new_keys_once(batch: DataFrame, path: str, key: str, batch_id: str, dedupe: str = "error") -> dict[str, int]:
    """Append the batch rows whose key no other batch has stored, once (K1).

    The stored keys are those of all other batches' folders, so a run after a
    crash at any point counts and writes what the first would have, also if
    ``dedupe`` is ``none`` and keys repeat inside the batch.  The batch is
    written to the shared folder once, so that the key check, the report and
    the append see the same rows.  Batches are loaded one at a time: two that
    run at once do not see each other's keys.  A NULL key is a key like any
    other.  An empty batch leaves a marker and an empty folder.
    """
    spark = batch.sparkSession
    done = batch_report(spark, path, _checked(batch_id))
    if done:
        return done
    staged = scratch_path(spark, "batch")
    batch.write.parquet(staged)
    rows = dedupe_batch(spark.read.schema(batch.schema).parquet(staged), key, dedupe)
    stored = table_rows(spark, path, batch.schema).filter(F.col(BATCH) != batch_id)
    report = insert_new_keys_report(rows, stored, key).first().asDict()
    write_batch(new_key_rows(rows, stored, key), path, batch_id)
    write_marker(spark, path, batch_id, report)
    return report
