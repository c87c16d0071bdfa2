"""CSV files and file listings."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.functions.names import PRODUCT_URL_PATTERN, data_file, extract_ids, file_name
from reviewloom.operators.skew import spread_join
from reviewloom.session import land

RAW_REVIEW = T.StructType([
    T.StructField("rating_star", T.StringType()),
    T.StructField("comment", T.StringType()),
    T.StructField("name", T.StringType()),
])

# Quotes inside a field are doubled, not escaped by a backslash.
CSV = {"escape": '"', "quote": '"'}
#: With a header that must agree with the columns asked for: no value is ever taken for another one.
WITH_HEADER = {**CSV, "header": True, "enforceSchema": False}
#: What lies in a landing folder itself or in its partitions, and the first part of a file in parts.
_PLAIN, _FIRST_PART = "^([^/=]+=[^/]*/)*[^/]+$", r"^([^/]+\.csv)/part-0+(?:-[^/]*-c0+)?\.[^/]+$"
#: So many file names may stand in a filter; beyond that the wanted files are joined as a table.
NAMES_IN_FILTER = 10_000

_ENCODED = "_metadata.file_name"
#: Tells parts of the same name in different folders apart.
_PLACE = "_metadata.file_path"


def read_reviews(spark: SparkSession, paths: str | Sequence[str],
                 schema: T.StructType = RAW_REVIEW, only: DataFrame | None = None,
                 fmt: str = "csv", mixed_headers: bool = False) -> DataFrame:
    """Raw reviews, all as text, plus the ``source_file`` of each row.

    CSVs have a header, which must hold the columns of ``schema`` in that order, or reading fails. With
    ``mixed_headers`` each file may have them in its own order, in any letter case and among other
    columns, at the price of a second scan for the headers; reading a file that lacks one fails. Empty fields come back as null. ``fmt="parquet"`` reads what ``land_reviews`` wrote.

    ``only`` holds the wanted files in ``filename``; no other file is opened, unless there
    are more than ``NAMES_IN_FILTER`` of them, when the others' rows go right after the scan.
    """
    if fmt != "csv":
        landed = T.StructType([*(f for f in schema if f.name != "source_file"),
                               T.StructField("source_file", T.StringType())])
        rows = spark.read.schema(landed).format(fmt).load(paths)
        if only is not None:
            rows = _of_files(rows, "source_file", only.select(data_file("filename").alias("source_file")))
        return rows.select(*[n for n in schema.names if n != "source_file"], "source_file")
    names = schema.names
    encoded = None
    if only is not None:
        encoded = _listed(spark, paths).join(
            only.select(data_file("filename").alias("source_file")).distinct(), "source_file",
            "left_semi").select("encoded")
    if not mixed_headers:
        rows = spark.read.schema(schema).options(**WITH_HEADER).csv(paths)
        rows = rows.select(*names, F.col(_ENCODED).alias("encoded"))
        order = None
    else:
        order = _header_places(spark, paths, names, encoded)
        rows = _positional(spark, paths, order)
    if encoded is not None:
        rows = _of_files(rows, "encoded", encoded)
    if order is not None:
        rows = _by_place(rows, order, schema)
    return rows.select(*names, file_name("encoded").alias("source_file"))


def read_by_header(spark: SparkSession, paths: Sequence[str],
                   schema: T.StructType = RAW_REVIEW) -> tuple[DataFrame, DataFrame]:
    """Reviews of exactly these CSV files, each read by its own header, and the files that cannot be read so.

    The first table is as ``read_reviews`` gives it with ``mixed_headers``. The second holds ``source_file`` and
    ``reason`` of the files that have no header or lack a column; none of their rows is in the first.

    A path that ends with a slash is a file in parts, a folder with its name: each part has a header, and the file
    lacks what any part lacks. Its rows are read in as many tasks as any others.
    """
    names, exact = schema.names, [re.sub(r"([\\\[\]{}*?])", r"\\\1", p) for p in paths]
    order = _header_places(spark, exact, names, None, _PLACE)
    parted = [p.rstrip("/").rpartition("/")[2] for p in paths if p.endswith("/")]
    folder = file_name(F.regexp_extract("encoded", "([^/]*)/[^/]*$", 1))
    of_file = F.when(folder.isin(parted), folder).otherwise(file_name(F.regexp_extract("encoded", "[^/]*$", 0)))
    absent = F.concat_ws(", ", *[F.when(F.get("places", F.lit(i)) == 0, n) for i, n in enumerate(names)])
    found = order.select("encoded", "places", of_file.alias("source_file"), absent.alias("absent"))
    known = found.groupBy("source_file").agg(F.max("absent").alias("absent")).select("source_file", F.when(
        F.col("absent") != "", F.concat(F.lit("no column "), "absent")).otherwise("").alias("reason"))
    asked = spark.createDataFrame([(p.rstrip("/").rpartition("/")[2],) for p in paths], "source_file string")
    lacking = asked.join(known, "source_file", "left").select(
        "source_file", F.coalesce("reason", F.lit("no header")).alias("reason")).filter("reason <> ''")
    whole = found.join(known.filter("reason = ''"), "source_file", "left_semi").select("encoded", "places", "source_file")
    rows = _of_files(_positional(spark, exact, whole, _PLACE), "encoded", whole.select("encoded"))
    return _by_place(rows, whole, schema, "source_file").select(*names, "source_file"), lacking


def _positional(spark: SparkSession, paths: str | Sequence[str], order: DataFrame,
                encoded: str = _ENCODED) -> DataFrame:
    """Lines below the headers, as wide as the last place that is asked for."""
    width = order.agg(F.max(F.array_max("places"))).first()[0] or 1
    positions = ", ".join(f"_{i} string" for i in range(max(width, 1)))
    rows = spark.read.schema(positions).options(**CSV, header=True).csv(paths)
    return rows.select("*", F.col(encoded).alias("encoded"))


def _by_place(rows: DataFrame, order: DataFrame, schema: T.StructType, *more: str) -> DataFrame:
    """The columns of ``schema`` from where each file has them, and ``more`` of ``order``; fails for a file that
    lacks one."""
    names = schema.names
    placed = spread_join(rows, order, ["encoded"], "left")
    fields = F.array(*[c for c in rows.columns if c != "encoded"])

    def field(i: int) -> Column:
        place = F.coalesce(F.col("places")[i], F.lit(0))
        lacks = F.raise_error(F.concat(F.lit(f"no column {names[i]} in the header of "), "encoded"))
        return F.when(place > 0, F.get(fields, place - 1)).otherwise(lacks.cast("string"))
    return placed.select(*[field(i).cast(schema[n].dataType).alias(n) for i, n in enumerate(names)], "encoded", *more)


def _listed(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Files by both forms of their names; nothing is opened."""
    files = spark.read.format("binaryFile").load(paths)
    return files.select(F.col(_ENCODED).alias("encoded"), file_name(_ENCODED).alias("source_file"))


def _of_files(rows: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """Rows whose file is wanted. A filter on names keeps Spark from opening the other files."""
    wanted = wanted.distinct()
    few = [r[0] for r in wanted.limit(NAMES_IN_FILTER + 1).collect()]
    if len(few) <= NAMES_IN_FILTER:
        return rows.filter(F.col(column).isin(few))
    return spread_join(rows, wanted, [column], "left_semi")


def _header_places(spark: SparkSession, paths: str | Sequence[str], names: Sequence[str],
                   wanted: DataFrame | None, encoded: str = _ENCODED) -> DataFrame:
    """``encoded, places`` for each file with a line: where its header has each column, from 1; 0 is nowhere.

    A name in the same letter case goes before one in another.
    """
    lines = spark.read.text(paths).select(
        F.regexp_replace("value", "^\ufeff", "").alias("line"), F.col(encoded).alias("encoded"),
        F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("id"))
    if wanted is not None:
        lines = _of_files(lines, "encoded", wanted)
    first = lines.filter((F.col("start") == 0) & (F.trim("line") != "")).groupBy("encoded").agg(
        F.min_by("line", "id").alias("line"))
    cells = F.split("line", ',(?=(?:[^"]*"[^"]*")*[^"]*$)')  # commas outside quotes
    header = F.transform(cells, lambda c: F.trim(F.replace(
        F.regexp_replace(F.trim(c), '^"|"$', ""), F.lit('""'), F.lit('"'))))
    low = F.transform("header", F.lower)
    places = [F.coalesce(F.nullif(F.array_position("header", n), F.lit(0)),
                         F.array_position(low, n.lower())).cast("int") for n in names]
    return land(first.select("encoded", header.alias("header")).select(
        "encoded", F.array(*places).alias("places")), "headers")


def _in_file_order(rows: DataFrame) -> DataFrame:
    """``rows`` with ``pos``, which grows by file name, then by place in the file.

    Parts of files are ranked, one row each; within a part the rows count on.
    """
    placed = rows.select("*", file_name(_ENCODED).alias("__file"),
                         F.col("_metadata.file_block_start").alias("__start"),
                         F.monotonically_increasing_id().alias("__id"))
    parts = placed.groupBy("__file", "__start").agg(F.min("__id").alias("__first"))
    rank = F.row_number().over(Window.orderBy("__file", "__start")) - 1
    ranked = parts.select("__file", "__start", "__first", rank.cast("bigint").alias("__rank"))
    pos = F.col("__rank") * F.lit(1 << 33) + F.col("__id") - F.col("__first")
    return placed.join(ranked, ["__file", "__start"]).select(*rows.columns, pos.alias("pos"))


def read_manifest(spark: SparkSession, path: str, has_header: bool = True) -> DataFrame:
    """Expected files, ``filename`` and ``pos``, which grows in file order, part file by part file."""
    return _in_file_order(spark.read.schema("filename string").options(header=has_header, **CSV).csv(path))


def read_product_urls(spark: SparkSession, path: str) -> DataFrame:
    """First column of a CSV without header as ``url``, and ``pos``."""
    return _in_file_order(spark.read.schema("url string").options(header=False, **CSV).csv(path))


def build_manifest(urls: DataFrame, url: str = "url", pattern: str = PRODUCT_URL_PATTERN,
                   item_group: int = 2, shop_group: int = 1) -> DataFrame:
    """``filename = itemid_shopid`` for every URL that has both; all other columns are kept."""
    ids = urls.withColumn("__ids", extract_ids(url, pattern, item_group, shop_group))
    kept = ids.filter(F.col("__ids.itemid").isNotNull() & F.col("__ids.shopid").isNotNull())
    name = F.concat_ws("_", F.col("__ids.itemid"), F.col("__ids.shopid"))
    return kept.withColumn("filename", name).drop("__ids", url)


def list_files(spark: SparkSession, path: str, glob: str = "*.csv", in_parts: bool = False) -> DataFrame:
    """Names of the files in folder ``path``, those ``read_reviews`` reads; nothing is opened.

    With ``in_parts`` also of the files in parts, those that only ``read_by_header`` reads.
    """
    if in_parts:
        files = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter=glob).load(path)
        return whole_files(files, path).select(F.col("source_file").alias("filename"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return files.select(file_name(_ENCODED).alias("filename"))


def whole_files(listed: DataFrame, landing: str) -> DataFrame:
    """``path, source_file`` of the files among those ``listed`` at any depth below ``landing``, a row for each.

    A large file may be a folder ``name.csv`` of parts as Spark writes them, moved in as a whole. Its first part, which
    Spark always writes, stands for it, and its path ends with a slash.
    """
    root = listed.sparkSession._jvm.org.apache.hadoop.fs.Path(landing)
    fs = root.getFileSystem(listed.sparkSession._jsc.hadoopConfiguration())
    below = F.substring("path", len(fs.makeQualified(root).toString().rstrip("/")) + 2, 2**30)
    part = F.regexp_extract(below, _FIRST_PART, 1)
    plain = below.rlike(_PLAIN)
    folder = F.regexp_extract("path", "^(.*/)[^/]*$", 1)
    return listed.filter(plain | (part != "")).select(
        F.when(plain, F.col("path")).otherwise(folder).alias("path"),
        F.when(plain, file_name(_ENCODED)).otherwise(part).alias("source_file"))


def list_landed(spark: SparkSession, path: str, by: str = "source_file") -> DataFrame:
    """Names of the files that a table written by ``land_reviews`` holds, from its partitions."""
    return spark.read.schema(f"{by} string").parquet(path).select(F.col(by).alias("filename")).distinct()
