"""Session defaults and the folder that all executors share."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

_shipped: set[str] = set()


def build(master: str = "local[8]", shuffle_partitions: int = 8, memory: str = "8g", **extra: str) -> SparkSession:
    """A local session with this engine's defaults; on a cluster the caller brings its own."""
    builder = SparkSession.builder.master(master).appName("marlstone").config("spark.driver.memory", memory)
    settings = DEFAULTS | {"spark.sql.shuffle.partitions": str(shuffle_partitions)} | extra
    for key, value in settings.items():
        builder = builder.config(key, value)
    return ship(builder.getOrCreate())


def ship(spark: SparkSession) -> SparkSession:
    """Give the executors this package, for sessions whose executors don't have it installed; once a session is enough."""
    root = os.path.dirname(os.path.abspath(__file__))
    if spark.sparkContext.applicationId not in _shipped:
        _shipped.add(spark.sparkContext.applicationId)
        folder = tempfile.mkdtemp(prefix="marlstone-package-")  # the driver serves it from here to all executors
        atexit.register(shutil.rmtree, folder, True)
        spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(folder, "marlstone-package"), "zip", os.path.dirname(root), os.path.basename(root)))
    return spark


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.split("[")[0] == "local"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every executor reaches.

    Only a purely local session may fall back to a folder of its own; on a cluster an
    unset folder is an error, because a machine-local path would lose data with its host.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if not named:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="marlstone-shared-")
        spark.sparkContext.setCheckpointDir(named)
        return named
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named


_made: list[str] = []


def scratch(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder, which :func:`clean` deletes."""
    path = os.path.join(shared_dir(spark), f"{purpose}-{uuid.uuid4().hex}")
    _made.append(path)
    return path


def clean(spark: SparkSession) -> int:
    """Delete every scratch folder of this process, once nothing reads frames made from them any more; how many."""
    gone, _made[:] = list(_made), []
    for path in gone:
        remove(spark, path)
    return len(gone)


def tasks(spark: SparkSession) -> int:
    """Into how many tasks to spread work that weighs far more than its rows' bytes.

    AQE sizes shuffle partitions by bytes; groups that stand for files or models need a fixed
    number instead, which ``repartition(n, ...)`` keeps.
    """
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism)


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage through a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def keep_at(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to ``path`` as Parquet and read from there."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keep(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder, for results that several branches read."""
    return keep_at(df, scratch(df.sparkSession, purpose))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
