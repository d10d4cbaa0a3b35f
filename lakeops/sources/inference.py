"""CSV without a declared schema, and CSV with rows that do not parse.

Types are found by one aggregate over all rows (no sample): for every column
and every type, whether all of its values are of that type.  The result has
the size of the schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from lakeops.session import scratch_path
from lakeops.sources.files import read_csv_strings

#: Types from narrow to wide, each with the form of its values.  A column
#: takes the first that all its values have and can be cast to, else string.
#: Whole numbers are doubles too, and dates are timestamps.
TYPES = (
    ("bigint", r"^[+-]?[0-9]+$"),
    ("double", r"^([+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?|NaN|[+-]?Infinity)$"),
    ("date", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"),
    ("timestamp_ntz", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?)?$"),
    ("boolean", r"^([tT]rue|[fF]alse|TRUE|FALSE)$"),
)
_BAD, _FILE = "__lakeops_bad", "__lakeops_file"


def _all(x: Column, kind: str, form: str) -> Column:
    return F.every(x.isNull() | (x.rlike(form) & x.try_cast(kind).isNotNull()))


def inferred_types(strings: DataFrame) -> DataFrame:
    """``position, column, type`` of every column of an all-string frame.

    NULLs fit every type; a column of NULLs alone, or of a table without rows,
    is a string.  Numbers too large for ``bigint`` are doubles.
    """
    aggs = []
    for i, name in enumerate(strings.columns):
        x = F.col(f"`{name}`")
        aggs += [F.count(x).alias(f"{i}_n"), *[_all(x, kind, form).alias(f"{i}_{kind}") for kind, form in TYPES]]
    one = strings.agg(*aggs)
    rows = []
    for i, name in enumerate(strings.columns):
        kind = F.when(F.col(f"{i}_n") == 0, "string")
        for t, _ in TYPES:
            kind = kind.when(F.col(f"{i}_{t}"), t)
        rows.append(F.struct(F.lit(i).alias("position"), F.lit(name).alias("column"), kind.otherwise("string").alias("type")))
    return one.select(F.inline(F.array(*rows)))


def cast_inferred(strings: DataFrame) -> DataFrame:
    """The frame with every column in its inferred type."""
    kinds = [r["type"] for r in inferred_types(strings).orderBy("position").collect()]
    return strings.select(*[F.col(f"`{c}`").cast(k).alias(c) for c, k in zip(strings.columns, kinds, strict=True)])


def read_csv_inferred(spark: SparkSession, path: str, header: bool = True, **options) -> DataFrame:
    """CSV with types found in its values: two passes, one over all columns
    for the types and one, pruned as usual, for the rows.  Types follow the
    content, so a job that appends to a table should declare them instead."""
    return cast_inferred(read_csv_strings(spark, path, header, **options))


def read_csv_apart(spark: SparkSession, path: str, schema: StructType | str, header: bool = True,
                   **options) -> tuple[DataFrame, DataFrame]:
    """``good, bad``: the rows that parse, and ``file, text`` of those that do
    not (a value not of its column's type, too few or too many values).

    The file is parsed once, with all columns, into the shared folder: Spark
    checks only the columns that a query reads, so that without it a row could
    be good in one query and bad in the next.  Empty lines are no rows.
    """
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    staged = scratch_path(spark, "csv")
    full = StructType(schema.fields).add(_BAD, StringType())
    raw = (spark.read.option("header", header).options(**options).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", _BAD).schema(full).csv(path))
    raw.select(*[f"`{c}`" for c in full.names], F.col("_metadata.file_path").alias(_FILE)).write.parquet(staged)
    back = spark.read.schema(StructType(full.fields).add(_FILE, StringType())).parquet(staged)
    good = back.filter(F.col(_BAD).isNull()).select(*[f"`{c}`" for c in schema.names])
    return good, back.filter(F.col(_BAD).isNotNull()).select(F.col(_FILE).alias("file"), F.col(_BAD).alias("text"))
