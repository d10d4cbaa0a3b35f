"""Session and scratch-location helpers.

Jobs never pick a machine-local folder on a cluster: staged writes and
lineage cuts go to the shared folder the cluster names in
``spark.checkpoint.dir``.  Only where that setting is absent in a local
run (a laptop or a test) is one made, under the system temp folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, app_name: str = "lakeops",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Get or create a session with the settings this library relies on.

    * AQE on (runtime coalescing, skew-join splitting, broadcast of sides
      whose *measured* size is under ``autoBroadcastJoinThreshold``).
    * UTC session zone, so ``timestamp`` columns print the same everywhere
      (the test data is ``timestamp_ntz`` and is zone-free anyway).
    * UI off: no web server.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true")
          .config("spark.ui.showConsoleProgress", "false"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir).  If neither is set, a local run gets one under the temp
    folder; on a cluster that is an error, as executors would write to their
    own disks.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    master = spark.sparkContext.master
    if not root and (not master.startswith("local") or master.startswith("local-cluster")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="lakeops-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return f"{root}/lakeops/{name}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared checkpoint folder and read back: a table
    whose size the planner knows.  Rows that meet a small one (a row per group)
    are not shuffled by its key, which would put a group on a single task."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
