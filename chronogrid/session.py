"""Session settings the package relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import chronogrid

# Runtime SQL settings. The time zone is pinned because every `ts` is UTC; the
# co-partition setting lets a join on (item_id, chunk, ts) reuse a layout by
# (item_id, chunk) instead of shuffling again.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings to a session someone else created.

    The few Python functions of the package travel to the executors by value, so the
    package need not be installed there.
    """
    cloudpickle.register_pickle_by_value(chronogrid)
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", app: str = "chronogrid") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    parallelism = 8 if cores == "*" else int(cores)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(parallelism))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


SCRATCH_SETTING = "chronogrid.scratch.dir"


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written intermediates.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset,
    ``chronogrid.scratch.dir`` can name one; on a local master, where driver and
    executors share one disk, a temporary folder is made and remembered there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SCRATCH_SETTING, None)
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.partition("[")[0] == "local":
        root = tempfile.mkdtemp(prefix="chronogrid-")
        spark.conf.set(SCRATCH_SETTING, root)
        return root
    raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the scratch folder, in a folder of this application's own."""
    run = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/chronogrid/{run}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """Write a reused intermediate once and read it back.

    Unlike a cached frame the files survive the loss of executors. They stay until
    `clear_scratch`, since frames made from them are evaluated later.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hand_back(spark: SparkSession) -> None:
    """Let the driver drop what finished steps have left.

    Plans and results of past jobs are garbage on the driver, but its heap grows to the limit
    before they go, and shuffle files stay on the executors' disks until then. Only what
    nothing refers to any more is dropped.
    """
    spark.sparkContext._jvm.System.gc()


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote to the scratch folder, once its results are stored."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(f"{scratch_root(spark)}/chronogrid/{context.applicationId}")
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
