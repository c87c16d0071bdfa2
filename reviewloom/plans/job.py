"""The whole job: index what has arrived, then follow what has not."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reviewloom.functions.names import data_file
from reviewloom.functions.text import flatten_lines
from reviewloom.operators.clean import RELAXED, Profile
from reviewloom.operators.workset import MAX_REVIEWS, arrival_status, assign_index, cap_reviews
from reviewloom.plans.enrich import enrich_reviews
from reviewloom.session import land
from reviewloom.sources.files import list_files, list_landed, read_reviews
from reviewloom.sources.ratings import flatten_rating_pages
from reviewloom.sources.sinks import land_in_buckets, write_index, write_manifest
from reviewloom.streaming.arrivals import MAX_FILES, file_stream, stream_late_reviews

FILE = "source_file"


def enrich_files(spark: SparkSession, files: DataFrame, landing: str, fn: Callable[[str], str],
                 read_options: Mapping | None = None, **enrich_options) -> DataFrame:
    """Enriched reviews of ``files``, rows of ``filename, index_name``, with their index name.

    All files are one plan, each its own scope; files not asked for are not opened. ``read_options`` go
    to ``read_reviews``: ``fmt="parquet"`` for a landed table, ``mixed_headers`` for CSVs of several kinds.
    """
    # a file that is listed twice is asked about once and written to both of its indexes
    index = files.groupBy(data_file("filename").alias(FILE)).agg(
        F.array_distinct(F.collect_list("index_name")).alias("__indexes"))
    raw = read_reviews(spark, landing, only=files.select("filename"), **(read_options or {}))
    enriched = enrich_reviews(raw, fn, (FILE,), scopes=index, **enrich_options)
    return enriched.withColumn("index_name", F.explode("__indexes")).drop("__indexes")


def index_ready_files(spark: SparkSession, manifest: DataFrame, landing: str,
                      fn: Callable[[str], str], index_path: str, fmt: str = "parquet",
                      options: Mapping[str, str] | None = None, by: str | None = "index_name",
                      read_options: Mapping | None = None, **enrich_options) -> DataFrame:
    """Write the index of all manifest files that have arrived; returns those still pending.

    Index numbers count missing files too. The arrival status is landed once, so that a file that
    arrives while the job runs is pending for all of it. A landed Parquet table holds the files that
    its partitions name. ``by`` goes to ``write_index``.
    """
    landed = (read_options or {}).get("fmt", "csv") != "csv"
    here = list_landed(spark, landing) if landed else list_files(spark, landing)
    status = land(arrival_status(assign_index(manifest), here), "status")
    ready = status.filter(F.col("status") == "ready")
    write_index(enrich_files(spark, ready, landing, fn, read_options, **enrich_options), index_path, fmt,
                options, by)
    return status.filter(F.col("status") == "pending").drop("status")


def follow_pending_files(spark: SparkSession, pending: DataFrame, landing: str, sink: str,
                         checkpoint: str, available_now: bool = False,
                         profile: Profile | str = RELAXED, max_files: int | None = None,
                         status: str | None = None, set_aside: str | None = None) -> StreamingQuery:
    """Score pending files as they arrive, under the looser rules, and write them as CSV.

    Each file is read by its own header; one that lacks a column fails the stream, or goes to the table
    ``set_aside`` with the reason. ``max_files`` bounds a batch; ``status`` names a folder for what is still
    pending after each.
    """
    return stream_late_reviews(file_stream(spark, landing, max_files or MAX_FILES), sink, checkpoint, pending,
                               profile, available_now, landing, status, set_aside)


def ingest_pages(pages: DataFrame, json_col: str, landed: str, manifest: str, order_by: Sequence[str] = (),
                 max_reviews: int = MAX_REVIEWS) -> None:
    """From rating pages to landed review files and the manifest that lists them.

    Reviews go to the file of their item and shop, ``itemid_shopid.csv``, of each at most the first
    ``max_reviews``, by the page's ``order_by`` columns and the place on the page. Most products are small,
    so their files share folders; see ``land_in_buckets``. The manifest lists the files by name. Ratings without both ids belong to no file and are left out.
    """
    rows = flatten_rating_pages(pages, json_col, wide=True)
    kept = rows.filter(F.col("itemid").isNotNull() & F.col("shopid").isNotNull()).select(
        F.concat(F.concat_ws("_", "itemid", "shopid"), F.lit(".csv")).alias(FILE),
        F.col("rating_star").cast("string").alias("rating_star"),
        flatten_lines(F.coalesce("comment", F.lit(""))).alias("comment"),
        F.coalesce("name", F.lit("")).alias("name"), *order_by, "page_row")
    # the place of a review among all, as one number per file
    placed = land(kept.orderBy(FILE, *order_by, "page_row").withColumn(
        "__place", F.monotonically_increasing_id()), "pages")
    capped = cap_reviews(placed, max_reviews, [FILE], "__place")
    land_in_buckets(capped.select("rating_star", "comment", "name", FILE), landed)
    files = placed.select(FILE).distinct()
    write_manifest(files.select(F.col(FILE).alias("filename"), F.col(FILE).alias("pos")), manifest)
