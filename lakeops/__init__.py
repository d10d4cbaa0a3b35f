"""lakeops: batch table work on Spark.

Every operator is a function DataFrame -> DataFrame (or a small report
DataFrame) built on public ``pyspark.sql`` / ``pyspark.ml`` APIs.  See
README.md for the module map.
"""

__version__ = "0.1.0"
