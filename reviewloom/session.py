"""Session settings and the shared folder for data that must outlive a job."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SHARED_DIR = "spark.checkpoint.dir"
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_SHIPPED: set[str] = set()


def build_session(app: str, master: str | None = None, shuffle_partitions: int | None = None,
                  **conf: str) -> SparkSession:
    """Session with the settings the operators are written for.

    ``shuffle_partitions`` is the number of partitions a shuffle *starts* with. AQE merges small
    ones but never splits below that number, so size it from the input: about one per 128 MB of
    shuffled data (some 50,000 for a few TB of kept reviews), at least two per core.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
    }
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf)
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only where the session names none and runs in one process, as in a local test, is a fresh local
    folder set. On a cluster its executors would each write to their own disk, so that is an error.
    """
    named = spark.conf.get(SHARED_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError(f"{SHARED_DIR} must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="reviewloom-"))
        named = spark.sparkContext.getCheckpointDir()
    return named


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has used yet.

    All paths of an application share one folder, which can go when the application has ended.
    """
    folder = f"{shared_dir(spark).rstrip('/')}/{spark.conf.get('spark.app.id')}"
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def land(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return it as read back.

    Used where the rows must be computed once, for example after calls to an outside service:
    a lost executor then re-reads the table instead of repeating the calls.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers of this application the package.

    The archive is made on the driver, once, and Spark sends it to the executors.
    """
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        package = os.path.dirname(os.path.abspath(__file__))
        name = os.path.join(tempfile.mkdtemp(prefix="package-"), os.path.basename(package))
        spark.sparkContext.addPyFile(shutil.make_archive(name, "zip", os.path.dirname(package),
                                                         os.path.basename(package)))
        _SHIPPED.add(app)


def prepare_workers(spark: SparkSession) -> None:
    """Give the Python workers of this application the package, and small batches of rows.

    Rows with long texts travel a few hundred at a time, unless the session names another number than
    Spark's default.
    """
    if spark.conf.get(ARROW_ROWS) == "10000":
        spark.conf.set(ARROW_ROWS, "512")
    ship_package(spark)
