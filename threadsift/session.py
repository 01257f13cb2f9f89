"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once for each application, so that their
    Python workers can import it wherever they were started. Spark itself serves the
    archive, which lies in the driver's own folder."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parent
        name = os.path.join(tempfile.mkdtemp(prefix="threadsift-package-"), package.name)
        context.addPyFile(shutil.make_archive(name, "zip", package.parent, package.name))
        _SHIPPED.add(context.applicationId)


def local_session(cores: int = 8, app: str = "threadsift", **extra: str) -> SparkSession:
    """A session on this machine, for tests and the benchmark. On a cluster the
    session comes from spark-submit and needs ``SETTINGS``, ``spark.checkpoint.dir``
    and ``ship``."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.files.minPartitionNum", str(cores))
        .config("spark.driver.memory", os.environ.get("THREADSIFT_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in
    ``spark.checkpoint.dir``. A folder of this machine is used only when the
    setting is missing and Spark itself runs on this machine."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="threadsift-"))
    return context.getCheckpointDir()


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder of the shared folder for one job."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder. What is used several times is then
    computed once, losing an executor costs no more than a read, and later steps
    read only the columns they need."""
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def finished(spark: SparkSession, path: str) -> bool:
    """Whether Spark wrote a whole table to a folder, of any file system it can reach."""
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done)
