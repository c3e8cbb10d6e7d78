"""Session helpers.

``get_session`` is for tests, the benchmark and scripts; library code takes
the caller's session. ``shared_dir`` returns a fresh folder under the
cluster's shared checkpoint folder (``spark.checkpoint.dir``), which is where
every intermediate table, CSV round trip and stream checkpoint is written.
Without the setting, a session on one machine (``local[...]``) gets a temporary
folder; on a cluster, whose machines share no such folder, it is an error.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter for the plans in this package. AQE re-plans joins
# from measured sizes (sort-merge -> broadcast only when the measured side
# is small) and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # cell-level stages explode every row 7x after the shuffle; keep small
    # shuffles spread over the cores instead of coalescing them to one task
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "ouzel", driver_memory: str | None = None) -> SparkSession:
    """A session with ``DEFAULT_CONF``; ``driver_memory`` only takes effect
    when this call starts the JVM (in local mode it is the executors' heap)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Read from ``spark.checkpoint.dir`` (or an already set SparkContext
    checkpoint folder). When neither is set: a temporary folder if driver and
    executors are one process, else a ``RuntimeError``.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir is not set: {master} needs a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="ouzel-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new, unique path below the shared checkpoint folder; its writer makes the folder."""
    root = checkpoint_root(spark)
    return f"{root.rstrip('/')}/ouzel/{name}-{uuid.uuid4().hex[:12]}"


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) as Hadoop objects: the same store that Spark's writers use."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def delete(spark: SparkSession, path: str) -> None:
    """Removes a folder that this package has written."""
    fs, p = hadoop_path(spark, path)
    fs.delete(p, True)


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to ``path`` and read back: computed once, the lineage cut, nothing cached."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
