"""Written tables that cut lineage: durable, columnar and shared by all executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

# Folders made by this process, by application.
_made: dict[str, list[str]] = {}


def scratch_root(spark: SparkSession) -> str:
    """Folder the cluster names for checkpoints; a temporary one only in local mode where none is set."""
    root = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="churnkit-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def new_path(spark: SparkSession, label: str) -> str:
    """Fresh folder name below the scratch root."""
    path = f"{scratch_root(spark)}/churnkit/{label}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def materialize(df: DataFrame, label: str = "table", path: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet and read it back.

    Unlike a cache it survives lost executors, unlike a checkpoint it is columnar, so later passes
    read only the columns they need and the planner knows its size.
    """
    spark = df.sparkSession
    path = path or new_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> int:
    """Delete the scratch tables this application made; frames that still read them end with them."""
    paths = _made.pop(spark.sparkContext.applicationId, [])
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)
    return len(paths)
