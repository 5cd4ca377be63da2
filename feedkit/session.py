"""Session helpers: settings worth having on a cluster, and the shared folder for written intermediates."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from feedkit.errors import SharedDirUnset

# Passed to ``SparkSession.builder.config(map=...)``; no operator changes a session's settings by itself.
# AQE sizes shuffle partitions, splits skewed join partitions and turns small sides into broadcasts at run time.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session, where driver and executors share one machine, may fall back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise SharedDirUnset("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="feedkit-")
        atexit.register(shutil.rmtree, _local_dirs[app], ignore_errors=True)
    return _local_dirs[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing uses yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The rows as a parquet table in the shared folder."""
    path = fresh_path(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_by(df: DataFrame, column: str) -> DataFrame:
    """The rows as a parquet table with one folder per value of a column, so that a filter on it reads those files alone."""
    path = fresh_path(df.sparkSession, "stage")
    df.write.partitionBy(column).parquet(path)
    ordered = df.select(*[c for c in df.columns if c != column], column)
    return df.sparkSession.read.schema(ordered.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to the shared checkpoint folder and go on from there. Survives the loss of executors."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark) + "/checkpoints")
    return df.checkpoint(eager=True)


def sweep(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of what has been written: it does so once the driver has collected the plans.

    The event of a query's end holds its plan until all listeners have seen it, hence the pause.
    """
    time.sleep(0.5)
    gc.collect()
    spark.sparkContext._jvm.System.gc()


class Scratch:
    """Writes intermediate tables into a folder of its own below the shared one, and deletes that folder at the end."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = fresh_path(spark, name)
        self.tables = 0

    def written(self, df: DataFrame) -> DataFrame:
        """The rows as a table of the folder."""
        self.tables += 1
        path = f"{self.folder}/{self.tables}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def sweep(self) -> None:
        """``sweep`` of the session."""
        sweep(self.spark)

    def drop(self) -> None:
        """Deletes the folder. Nothing that reads its tables may be used afterwards."""
        sc = self.spark.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
