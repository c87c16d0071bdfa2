"""Work lists: which files are expected, which have arrived, how they are numbered and split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.functions.names import data_file
from reviewloom.operators.skew import _int_div, number_rows, spread_join

# Counter before the first index, index name prefix, reviews kept per product.
INDEX_START = 75
INDEX_PREFIX = "comment_index_"
MAX_REVIEWS = 100_000


def _files(available: DataFrame, column: str = "filename") -> DataFrame:
    return available.select(data_file(column).alias("__file"))


def ready_files(manifest: DataFrame, available: DataFrame) -> DataFrame:
    """Manifest rows whose file exists."""
    return (manifest.withColumn("__file", data_file("filename"))
                    .join(_files(available), "__file", "left_semi").drop("__file"))


def pending_files(manifest: DataFrame, available: DataFrame) -> DataFrame:
    """Manifest rows whose file is still missing."""
    return (manifest.withColumn("__file", data_file("filename"))
                    .join(_files(available), "__file", "left_anti").drop("__file"))


def arrival_status(manifest: DataFrame, available: DataFrame) -> DataFrame:
    """Manifest rows with ``status``, ``ready`` or ``pending``."""
    arrived = _files(available).distinct().withColumn("__arrived", F.lit(True))
    status = F.when(F.col("__arrived"), "ready").otherwise("pending")
    wanted = manifest.withColumn("__file", data_file("filename"))
    return (spread_join(wanted, arrived, ["__file"], "left")
            .withColumn("status", status).drop("__file", "__arrived"))


def assign_index(manifest: DataFrame, order_by: str = "pos", start: int = INDEX_START,
                 prefix: str = INDEX_PREFIX) -> DataFrame:
    """Adds ``index_name``: the first manifest row gets ``start + 1``, missing files count too."""
    numbered = number_rows(manifest, [], order_by, "__row_no")
    number = (F.col("__row_no") + F.lit(start)).cast("string")
    return numbered.withColumn("index_name", F.concat(F.lit(prefix), number)).drop("__row_no")


def bucket_modulo(df: DataFrame, k: int = 3, order_by: str = "pos") -> DataFrame:
    """Adds ``bucket``, dealing the rows round in their order."""
    numbered = number_rows(df, [], order_by, "__row_no")
    return numbered.withColumn("bucket", F.pmod(F.col("__row_no") - 1, F.lit(k)).cast("int")
                               ).drop("__row_no")


def bucket_contiguous(df: DataFrame, k: int = 5, order_by: str = "pos") -> DataFrame:
    """Adds ``bucket``, cutting the ordered rows into ``k`` runs whose sizes differ by at most 1."""
    numbered = number_rows(df, [], order_by, "__row_no")
    # the row count, once more per row through an equi-join on a value that is always 0
    one = F.pmod(F.col(order_by), F.lit(1)).cast("int")
    total = df.groupBy(one.alias("__one")).agg(F.count(F.lit(1)).alias("__total"))
    size, longer = _int_div(F.col("__total"), F.lit(k)), F.pmod(F.col("__total"), F.lit(k))
    i = F.col("__row_no") - 1
    in_longer = i < longer * (size + 1)
    bucket = F.when(in_longer, _int_div(i, size + 1)).otherwise(
        longer + _int_div(i - longer * (size + 1), size))
    return (numbered.withColumn("__one", one).join(F.broadcast(total), "__one")
                    .withColumn("bucket", bucket.cast("int")).select(*df.columns, "bucket"))


def cap_reviews(df: DataFrame, n: int = MAX_REVIEWS, keys: Sequence[str] = ("name",),
                order_by: str = "pos", rows_per_split: int | None = None) -> DataFrame:
    """At most the first ``n`` reviews of each product."""
    return number_rows(df, keys, order_by, "__row_no", n, rows_per_split).drop("__row_no")


def cap_pages(pages: DataFrame, size: str, n: int = MAX_REVIEWS, keys: Sequence[str] = ("itemid", "shopid"),
              page_no: str = "page_no", rows_per_split: int | None = None) -> DataFrame:
    """The pages of each product up to its end: whole pages, as long as those before hold fewer than ``n`` reviews.

    ``size`` is the column with a page's number of reviews, ``page_no`` counts a product's pages from 0, each
    number once. A product ends before its first page without reviews, and before a page that is missing. Only
    numbers are sorted, a row per page; a product has ``n`` pages with a review at most.
    """
    here = Window.partitionBy(*keys).orderBy(page_no)
    before = here.rowsBetween(Window.unboundedPreceding, -1)
    # at most ``n`` pages can be kept, so later ones go before they are sorted
    sizes = pages.filter(F.col(page_no) < n).select(*keys, page_no, F.col(size).alias("__size"))
    placed = sizes.select(*keys, page_no, "__size", (F.row_number().over(here) - 1).alias("__place"),
                          F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__before"),
                          F.coalesce(F.min("__size").over(before), F.lit(1)).alias("__least"))
    kept = placed.filter((F.col("__place") == F.col(page_no)) & (F.col("__before") < n)
                         & (F.col("__least") > 0) & (F.col("__size") > 0))
    # the last kept page tells all that is needed
    last = kept.groupBy(*keys).agg(F.max(page_no).alias("__last"))
    return spread_join(pages, last, keys, rows_per_split=rows_per_split).filter(
        F.col(page_no) <= F.col("__last")).drop("__last")
