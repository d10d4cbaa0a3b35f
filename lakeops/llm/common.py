"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeops.session import scratch_path

#: ``[^\x20\x09-\x0D]+`` is what ``bytes.split()`` returns: the six ASCII
#: white-space bytes separate, every other byte belongs to a word.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table of the folder.  Python workers import this package by name:
    where it is not installed, tell them where the driver has it."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def doc_bytes(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` with the text as UTF-8 bytes, a null text as empty:
    the Python side then neither decodes nor encodes."""
    return docs.select(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: cuts
    the lineage, and a lost executor costs a re-read instead of the work."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def arrow_batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)],
        schema=schema)
