"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import functools
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the local bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("lendloom")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@functools.cache
def _own_folder() -> str:
    """One folder of this process, for a local master; it goes when the process ends."""
    folder = tempfile.mkdtemp(prefix="lendloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def _shared_folder(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.startswith("local["):
        return _own_folder()
    raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one, for written tables and sinks."""
    return f"{_shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def set_checkpoint_folder(spark: SparkSession) -> None:
    """Checkpoints go to the shared folder, unless the session has one already."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(_shared_folder(spark))


def show_package(spark: SparkSession) -> None:
    """Python workers on this machine find the package where the driver did; a cluster gets it with --py-files."""
    here, environment = os.path.dirname(os.path.dirname(os.path.abspath(__file__))), spark.sparkContext.environment
    if here not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [here, environment.get("PYTHONPATH", "")]))


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage through reliable storage, so that a lost executor costs no recomputation."""
    set_checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str, *by: str) -> DataFrame:
    """Rows written once to the shared folder as Parquet, in folders by the columns ``by``: every use reads the columns it needs, and none works them out again."""
    path = scratch_dir(df.sparkSession, name)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.parquet(path)
