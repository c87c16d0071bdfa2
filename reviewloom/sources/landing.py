"""Landed files that are replaced as a whole, without a folder for each.

Rows of many files lie together in versions, sorted by file, so that a reader of a few files skips the rest by the
statistics of Parquet. A version counts once its commit is there: a table of the files that it replaces,
moved into place at once. Readers take each file from the last commit that names it, so they see a file as it was or as
it is, never a mixture, and a write that fails is not seen at all.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reviewloom.functions.names import data_file
from reviewloom.operators.skew import spread_join

FILE, VERSION = "source_file", "version"
_DATA, _COMMITS = "data", "commits"
#: Commits that may come in between before a writer gives up.
_TRIES = 100


def _fs(spark: SparkSession, path: str):
    """Hadoop's file system of a path; only names pass through it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), spark._jvm.org.apache.hadoop.fs.Path


def replace_files(df: DataFrame, path: str, files: DataFrame | None = None) -> None:
    """Replace the files (``source_file``) that ``df`` holds below ``path``, all of them at once.

    ``files`` lists in ``filename`` what is replaced, so that files without rows become empty; by default those
    that ``df`` has rows of. A file of any size is split over as many tasks as its rows need.
    """
    spark, base, version = df.sparkSession, path.rstrip("/"), uuid.uuid4().hex
    data = f"{base}/{_DATA}/{VERSION}={version}"
    df.hint("rebalance", FILE).sortWithinPartitions(FILE).write.parquet(data)
    written = spark.read.schema(df.schema).parquet(data)
    names = (written.select(FILE) if files is None else files.select(data_file("filename").alias(FILE))).distinct()
    staged = f"{base}/.staged-{version}"
    names.withColumn(VERSION, F.lit(version)).write.parquet(staged)
    fs, at = _fs(spark, base)
    fs.mkdirs(at(f"{base}/{_COMMITS}"))
    for _ in range(_TRIES):
        taken = [s.getPath().getName() for s in fs.listStatus(at(f"{base}/{_COMMITS}"))]
        number = max([int(n.split("=")[1]) for n in taken if n.startswith("number=")], default=0) + 1
        place = at(f"{base}/{_COMMITS}/number={number}")
        if not fs.exists(place) and fs.rename(at(staged), place):
            # a folder moved onto one that another writer has just put there ends up inside it
            inside = at(f"{base}/{_COMMITS}/number={number}/.staged-{version}")
            if not fs.exists(inside):
                return
            fs.rename(inside, at(staged))
    raise RuntimeError(f"no commit after {_TRIES} tries: too many writers of {path}")


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """``filename, version``: every landed file and where it lies."""
    commits = spark.read.schema(f"{FILE} string, {VERSION} string, number bigint").parquet(f"{path.rstrip('/')}/{_COMMITS}")
    return commits.groupBy(FILE).agg(F.max_by(VERSION, "number").alias(VERSION)).select(
        F.col(FILE).alias("filename"), VERSION)


def read_landed(spark: SparkSession, path: str, schema: StructType | str, only: DataFrame | None = None) -> DataFrame:
    """Rows of the landed files, of ``schema`` (with ``source_file``); ``only`` lists the wanted ones in ``filename``.

    The list of files meets the rows as a table: AQE broadcasts it when it is small.
    """
    kind = spark.createDataFrame([], schema).schema if isinstance(schema, str) else schema
    current = landed_files(spark, path).withColumnRenamed("filename", FILE)
    if only is not None:
        current = current.join(only.select(data_file("filename").alias(FILE)).distinct(), FILE, "left_semi")
    rows = spark.read.schema(StructType([*kind.fields]).add(VERSION, "string")).parquet(f"{path.rstrip('/')}/{_DATA}")
    return spread_join(rows, current, [FILE, VERSION], "left_semi").select(*kind.names)


def compact(spark: SparkSession, path: str, schema: StructType | str) -> None:
    """Write all files into one version anew. Earlier versions stay for readers that have begun; nothing is deleted."""
    names = landed_files(spark, path).select("filename")
    replace_files(read_landed(spark, path, schema), path, names)

