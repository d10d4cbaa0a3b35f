"""File and catalog sources.

* CSV is read with an explicit schema (or as strings, cast explicitly).  Types
  found in the values, which cost a full extra pass, and rows that do not parse
  are in :mod:`lakeops.sources.inference`.
* Parquet scans are lazy; column pruning and filter pushdown happen when
  later ``select``/``filter`` calls are planned, so a key scan reads one
  column (``ReadSchema`` in ``explain``).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Full-table scan of ``{sf_dir}/{name}.parquet`` (S3)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_tables(spark: SparkSession, sf_dir: str,
                names: Iterable[str] = TABLES, views: bool = False) -> dict[str, DataFrame]:
    """Lazy scans for several tables; optionally register temp views."""
    out = {}
    for n in names:
        df = read_table(spark, sf_dir, n)
        if views:
            df.createOrReplaceTempView(n)
        out[n] = df
    return out


def key_scan(df: DataFrame, key: str) -> DataFrame:
    """Single-column key scan (S4): the pruned scan reads only ``key``."""
    return df.select(key)


def sql_scan(spark: SparkSession, df: DataFrame, view: str,
             query: str | None = None) -> DataFrame:
    """SQL over a catalog/temp view."""
    df.createOrReplaceTempView(view)
    return spark.sql(query or f"SELECT * FROM {view}")


def read_csv(spark: SparkSession, path: str, schema: StructType | str,
             header: bool = True, **options) -> DataFrame:
    """CSV with a header row and declared types."""
    return (spark.read.option("header", header).option("mode", "FAILFAST")
            .options(**options).schema(schema).csv(path))


def read_csv_strings(spark: SparkSession, path: str, header: bool = True,
                     **options) -> DataFrame:
    """CSV with a header and no inference: every column is a string."""
    return spark.read.option("header", header).options(**options).csv(path)


def cast_to_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Cast string columns to a target schema by name.

    Appending an all-string frame to a typed table is rejected by Spark's
    store assignment, so the cast is explicit.  Under ANSI mode a value
    that does not parse raises instead of turning into NULL.
    """
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def literal_rows(spark: SparkSession, rows: list[tuple], schema: StructType | str) -> DataFrame:
    """Literal rows to a frame (S9).  For small, fixed lookup data only."""
    return spark.createDataFrame(rows, schema)
