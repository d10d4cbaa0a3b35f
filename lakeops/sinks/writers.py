"""Writers (K3-K9).

Every write is one distributed job: each task writes its own part files,
nothing is gathered on the driver.  Replacing a table that is also read
by the same plan is done by writing a *new* directory and then pointing
the table at it (``ALTER TABLE ... SET LOCATION``), never by overwriting
the directory being read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True,
              **options) -> str:
    """Directory of CSV parts with a header row in every part (K5).

    The original job wrote without a header and read back with one, losing
    the first row of each part; the header is on by default here.
    """
    df.write.mode(mode).option("header", header).options(**options).csv(path)
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] | None = None,
                  sort_within: Sequence[str] | None = None) -> str:
    w_df = df.sortWithinPartitions(*sort_within) if sort_within else df
    w = w_df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], fmt: str = "csv",
                      mode: str = "overwrite", max_records_per_file: int | None = None) -> str:
    """One report folder per group, written by one job (K6).

    ``partitionBy`` lets every task write the groups it holds; rows are not
    shuffled so that one task holds a whole group, which would put a hot
    group on a single task.  ``max_records_per_file`` bounds file sizes.
    """
    w = df.write.mode(mode).partitionBy(*by)
    if fmt == "csv":
        w = w.option("header", True)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.format(fmt).save(path)
    return path


def create_table(spark: SparkSession, name: str, columns_ddl: str, location: str | None = None,
                 fmt: str = "parquet", properties: dict[str, str] | None = None, replace: bool = False) -> None:
    """``CREATE TABLE [IF NOT EXISTS] name (cols) USING fmt`` (K7, K8).  A sort
    key takes effect when rows are written: see :func:`overwrite_table`."""
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    sql = f"CREATE TABLE IF NOT EXISTS {name} ({columns_ddl}) USING {fmt}"
    if location:
        sql += f" LOCATION '{location}'"
    if properties:
        props = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
        sql += f" TBLPROPERTIES ({props})"
    spark.sql(sql)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def append(df: DataFrame, target: str, *, is_path: bool = False, fmt: str = "parquet") -> None:
    """Append rows to a table (by column name) or to a Parquet folder (K4)."""
    if is_path:
        df.write.mode("append").format(fmt).save(target)
    else:
        spark = df.sparkSession
        cols = spark.table(target).columns
        df.select(*cols).write.mode("append").insertInto(target)


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of every write inside are removed as it ends, not when
    the driver happens to collect its garbage: what is written is read from its
    table from then on."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def overwrite_table(df: DataFrame, name: str | None = None, path: str | None = None,
                    sort_within: Sequence[str] | None = None, fmt: str = "parquet",
                    properties: dict[str, str] | None = None, **options) -> None:
    """Create-table-as-select after drop (K3).  ``sort_within`` is the
    column-store ``ORDER BY`` key (O3); no key means no sort.  ``properties``
    become table properties (K8), ``options`` are the writer's."""
    out = df.sortWithinPartitions(*sort_within) if sort_within else df
    w = out.write.mode("overwrite").format(fmt).options(**options)
    if path:
        w = w.option("path", path)
    if name:
        with shuffles_released(df.sparkSession):
            w.saveAsTable(name)
        if properties:
            props = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
            df.sparkSession.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({props})")
    elif path:
        with shuffles_released(df.sparkSession):
            w.save()
    else:
        raise ValueError("name or path required")


def overwrite_table_in_parts(df: DataFrame, name: str, path: str, key: str, parts: int, fmt: str = "parquet", **options) -> None:
    """Create-table-as-select whose rows come in ``parts`` by a hash of ``key``,
    each in a job of its own: the shuffle files of one part are gone before
    the next one's are written, so the disk holds the table and those of a
    part.  Pays where ``key`` is the key of the joins, as the scans then leave
    the other parts' rows out; the table is whole when the last part is in."""
    for part in range(parts):
        rows = df.filter(F.pmod(F.xxhash64(key), F.lit(parts)) == part)
        if part == 0:
            overwrite_table(rows, name=name, path=path, fmt=fmt, **options)
        else:
            with shuffles_released(df.sparkSession):
                rows.write.mode("append").format(fmt).options(**options).option("path", path).saveAsTable(name)


def write_clustered(df: DataFrame, path: str, keys: Sequence[str], files: int, mode: str = "overwrite") -> str:
    """Rows in key order over the whole folder (O3): files hold consecutive key
    ranges, from a sample of the keys, and are sorted inside, so the minimum
    and maximum that Parquet keeps let a filter on the first key skip most
    files and row groups.

    Rows that agree in all keys are dealt over several files by a hash of their
    columns where one key holds many of them: the hash is a last sort key.
    """
    rows = df.withColumn("__lakeops_tie", F.xxhash64(*df.columns))
    order = [*keys, "__lakeops_tie"]
    rows.repartitionByRange(files, *order).sortWithinPartitions(*order).drop("__lakeops_tie").write.mode(mode).parquet(path)
    return path


def set_table_location(spark: SparkSession, name: str, location: str) -> None:
    """Point a table at a freshly written directory, then drop cached plans."""
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
    spark.sql(f"REFRESH TABLE {name}")


#: Comments, quoted text, a separator, or anything else of a SQL script.
_SCRIPT_PIECE = re.compile(
    r"""(?P<comment>--[^\n]*|/\*.*?\*/)|'(?:\\.|[^'\\])*'|"(?:\\.|[^"\\])*"|`[^`]*`|(?P<end>;)|.""", re.S)


def split_statements(script: str) -> list[str]:
    """The statements of a SQL text: cut at semicolons outside quotes and
    comments; a piece of nothing but comments is no statement."""
    out, piece, real = [], "", False
    for m in _SCRIPT_PIECE.finditer(script + "\n;"):
        if m["end"]:
            out += [piece.strip()] if real else []
            piece, real = "", False
        else:
            piece += m[0]
            real = real or not (m["comment"] or m[0].isspace())
    return out


def run_sql_script(spark: SparkSession, statements: str | Sequence[str]) -> DataFrame | None:
    """Run SQL statements in order and return the last result (K9): a list of
    them, or one text that :func:`split_statements` cuts.  Empty entries are
    skipped."""
    last = None
    for stmt in split_statements(statements) if isinstance(statements, str) else statements:
        s = stmt.strip()
        if s:
            last = spark.sql(s)
    return last
