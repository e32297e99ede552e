"""Session settings that the library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A split skewed join is worth the extra shuffle it may cause further down.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM never compiles methods above 8000 bytes. Wide projections exceed that as one method;
    # below this limit Spark generates several small ones instead, which run about five times faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


BYTES_PER_TASK = 128 << 20
FEWEST_TASKS, MOST_TASKS = 200, 200_000


def tasks_for(input_bytes: int) -> int:
    """Shuffle partitions for so much input; adaptive execution merges what turns out to be small."""
    return min(MOST_TASKS, max(FEWEST_TASKS, -(-input_bytes // BYTES_PER_TASK)))


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Size of files and folders, as their file systems report it."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for path in paths:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        total += target.getFileSystem(conf).getContentSummary(target).getLength()
    return total


def size_shuffles(spark: SparkSession, *paths: str) -> int:
    """Set the session's shuffle partitions by the size of a job's inputs."""
    tasks = tasks_for(stored_bytes(spark, *paths))
    spark.conf.set("spark.sql.shuffle.partitions", str(tasks))
    return tasks


def build_session(
    app: str = "churnkit", master: str | None = None, input_bytes: int | None = None, **settings: str
) -> SparkSession:
    """Get a session with the recommended settings; ``settings`` (dots as ``__``) win over them.

    ``input_bytes`` sizes the shuffles so that a task's share fits in memory; adaptive execution
    merges what turns out to be small.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    sized = {}
    if input_bytes:
        sized["spark.sql.shuffle.partitions"] = str(tasks_for(input_bytes))
    chosen = SETTINGS | sized | {name.replace("__", "."): value for name, value in settings.items()}
    for name, value in chosen.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the recommended settings to a session that exists already."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark
