"""Writers. ``rebalance`` lets AQE size the output files: small partitions are merged and a
partition swollen by one source or index is split."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.sources.files import CSV

TOKEN = "token"
BUCKET = "bucket"
#: Folders of a table that many small sources share. A number that stays, for a source is looked for in one of them.
BUCKETS = 64
# Leading and trailing blanks are data, which Spark would trim when writing. An empty text is
# written as nothing, not as "", and so reads back as null.
_CSV_OUT = {**CSV, "emptyValue": "", "ignoreLeadingWhiteSpace": False,
            "ignoreTrailingWhiteSpace": False}


def append_reviews(df: DataFrame, path: str, token: str | None = None) -> bool:
    """Add reviews to a CSV folder; every part file carries the header. Tells whether it has written.

    With ``token``, which names the batch, an append that is repeated adds nothing: the batch has a folder of its own,
    which is written anew until it is complete and then left alone. Readers of the folder find it like the others;
    a folder either takes tokens or does not.
    """
    target = path
    if token is not None:
        if not re.fullmatch(r"[\w.-]+", token):
            raise ValueError("a token is made of letters, digits, dots, dashes and underlines")
        target = f"{path.rstrip('/')}/{TOKEN}={token}"
        done = df.sparkSession._jvm.org.apache.hadoop.fs.Path(f"{target}/_SUCCESS")
        if done.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).exists(done):
            return False
    writer = df.write.mode("append" if token is None else "overwrite")
    writer.options(header=True, **_CSV_OUT).csv(target)
    return True


def land_reviews(df: DataFrame, path: str, fmt: str = "parquet",
                 by: str = "source_file", clustered: bool = False) -> None:
    """Replace the landed sources that ``df`` holds and leave the others alone.

    ``clustered`` says that the rows of a source already lie together, as they do straight after
    ``read_reviews``; they are then written as they are, without a shuffle.
    """
    rows = df if clustered else df.hint("rebalance", by)
    (rows.write.mode("overwrite").format(fmt)
       .option("partitionOverwriteMode", "dynamic").partitionBy(by).save(path))


def land_in_buckets(df: DataFrame, path: str, by: str = "source_file") -> None:
    """``land_reviews`` for sources that are many and small: Parquet in a fixed number of folders, not one for each.

    The sources that ``df`` holds are replaced, the others in the same folders are written again with them. Rows lie
    sorted by source, so readers of a few skip the rest by the statistics. ``read_reviews`` and ``list_landed`` read
    either kind; a table is of one kind only.
    """
    spark = df.sparkSession
    bucket = F.pmod(F.xxhash64(by), F.lit(BUCKETS)).cast("int")
    rows = df.withColumn(BUCKET, bucket)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        names = df.select(F.col(by).alias("__by")).distinct()
        touched = [r[0] for r in rows.select(BUCKET).distinct().collect()]  # ``BUCKETS`` of them at most
        landed = spark.read.schema(rows.schema).parquet(path).filter(F.col(BUCKET).isin(touched))
        rows = rows.unionByName(landed.join(names, F.col(by).eqNullSafe(F.col("__by")), "left_anti"))
    (rows.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, by).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path))


def write_manifest(df: DataFrame, path: str) -> None:
    """File names without header, replacing what is there.

    With ``pos`` they are written in its order: part files follow one another like their names.
    """
    rows = df.orderBy("pos") if "pos" in df.columns else df
    rows.select("filename").write.mode("overwrite").options(header=False, **_CSV_OUT).csv(path)


def write_clean(df: DataFrame, path: str) -> None:
    """Clean reviews as CSV with header; fails when the folder exists."""
    df.write.mode("errorifexists").options(header=True, **_CSV_OUT).csv(path)


def write_index(df: DataFrame, path: str | None = None, fmt: str = "parquet",
                options: Mapping[str, str] | None = None, by: str | None = "index_name") -> None:
    """Replace the indexes that ``df`` holds and leave the others alone.

    ``fmt`` and ``options`` name the target: a file format by default, partitioned by index name,
    or a search index through its connector, which takes the index from the options (``by=None``).
    """
    out = df.hint("rebalance", by) if by else df
    writer = out.write.format(fmt).options(**dict(options or {})).mode("overwrite")
    if by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(by)
    writer.save(path)


def preview(df: DataFrame, n: int = 5, order_by: Sequence[str] = ()) -> DataFrame:
    """Print the schema and return the first ``n`` rows, in the order given if any."""
    df.printSchema()
    return (df.orderBy(*order_by) if order_by else df).limit(n)
