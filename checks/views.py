"""Review data derived from the test tables, once for Spark and once as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE_SIZE = 50


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def row_id(doc_id: str, pos: str) -> Column:
    """One number per sentence that orders by document, then position."""
    return F.shiftleft(F.col(doc_id), 31) + F.col(pos)


def reviews_of(docs: DataFrame) -> DataFrame:
    pieces = docs.select("doc_id", F.col("lang").alias("scope"), F.col("source").alias("name"),
                         F.posexplode(F.split("text", r"[.\n]+")).alias("pos", "comment"))
    stars = F.pmod(F.col("doc_id") * 7 + F.col("pos") * 3, F.lit(5)) + 1
    return pieces.select("scope", "name", "doc_id", "pos", row_id("doc_id", "pos").alias("row_id"),
                         "comment", stars.cast("double").alias("rating_star"))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One review per sentence: product = source, file = language."""
    return reviews_of(table(spark, sf_dir, "documents"))


def dirty(clean: DataFrame) -> DataFrame:
    """Text ratings with nulls and ``n/a``, and missing names."""
    mixed = F.col("doc_id") + F.col("pos")
    stars = (F.when(mixed % 13 == 0, F.lit(None).cast("string"))
              .when(mixed % 11 == 0, "n/a")
              .otherwise(F.col("rating_star").cast("int").cast("string")))
    return clean.withColumn("rating_star", stars).withColumn(
        "name", F.when(mixed % 17 != 0, F.col("name")))


def reviews_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty(reviews(spark, sf_dir))


def rating_pages(spark: SparkSession, sf_dir: str, size: int = PAGE_SIZE) -> DataFrame:
    """Conversations as pages of at most ``size`` ratings in the JSON of the rating service."""
    turns = table(spark, sf_dir, "conversations")
    items = F.when(F.col("turn") % 4 == 3, F.array().cast("array<struct<name:string>>")).otherwise(
        F.array(F.struct(F.col("role").alias("name"))))
    rating = F.struct("turn", F.col("conv_id").alias("itemid"), F.col("turn").alias("shopid"),
                      (F.col("conv_id") + F.col("turn")).alias("userid"),
                      (F.col("turn") % 5 + 1).cast("int").alias("rating_star"),
                      F.col("text").alias("comment"), items.alias("product_items"))
    page = F.floor(F.col("turn") / size).alias("page_no")
    pages = turns.groupBy("conv_id", page).agg(F.sort_array(F.collect_list(rating)).alias("ratings"))
    return pages.select("conv_id", "page_no", F.to_json(
        F.struct(F.struct("ratings").alias("data"))).alias("page"))


def manifest_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(F.col("page_id").alias("pos"), "url")


URL_PATTERN = r"/([a-z]{2})/(\d+)"


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One expected file per document."""
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("filename"),
        F.col("doc_id").alias("pos"))


def available(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled documents are the files that have arrived."""
    return table(spark, sf_dir, "labels").select(
        F.concat(F.lit("doc"), F.col("doc_id").cast("string"), F.lit(".csv")).alias("filename"))


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    status = (F.when(kind == "error", "error").when(kind == "signup", "exception")
               .when(kind == "view", "validation_error").otherwise("success"))
    return table(spark, sf_dir, "events").select(
        "user_id", status.alias("status"), F.col("value").alias("response_time"))


def document_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as one product review, with empty texts and ratings from 0 to 5."""
    docs = table(spark, sf_dir, "documents")
    comments = F.transform(F.split("text", r"[.\n]+"), lambda t, i: F.struct(
        t.alias("text"), F.pmod(F.col("doc_id") + i, F.lit(6)).cast("int").alias("rating")))
    return docs.select("doc_id", F.col("source").alias("product_name"), comments.alias("comments"))


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers of a summary service: good ones, ones without summary, and plain text."""
    turns = table(spark, sf_dir, "conversations")
    good = F.to_json(F.struct(F.col("role").alias("product_name"), F.col("text").alias("summary")))
    partial = F.to_json(F.struct(F.col("role").alias("product_name")))
    answer = (F.when(F.col("turn") % 4 == 1, partial).when(F.col("turn") % 4 == 2, F.col("text"))
               .otherwise(good))
    return turns.select("conv_id", "turn", answer.alias("response"))


# --- the same views in SQL; each entry may use the ones before it ---

SQL_VIEWS: dict[str, str] = {
    "pieces": r"""
        SELECT doc_id, lang, source, regexp_split_to_array(text, '[.\n]+') AS xs FROM documents""",
    "reviews": """
        SELECT lang AS scope, source AS name, doc_id, pos, doc_id * 2147483648 + pos AS row_id,
               comment, ((doc_id * 7 + pos * 3) % 5 + 1)::DOUBLE AS rating_star
        FROM (SELECT doc_id, lang, source, unnest(xs) AS comment, unnest(range(len(xs))) AS pos
              FROM pieces)""",
    "reviews_raw": """
        SELECT scope, CASE WHEN (doc_id + pos) % 17 <> 0 THEN name END AS name, doc_id, pos, row_id,
               comment,
               CASE WHEN (doc_id + pos) % 13 = 0 THEN NULL
                    WHEN (doc_id + pos) % 11 = 0 THEN 'n/a'
                    ELSE rating_star::INT::VARCHAR END AS rating_star
        FROM reviews""",
    # cleaned text of every complete row, and its tokens
    "cleaned": r"""
        SELECT *, string_split(comments, ' ') AS tokens FROM (
            SELECT scope, name, doc_id, pos, row_id, try_cast(rating_star AS DOUBLE) AS rating_star,
                   trim(regexp_replace(regexp_replace(comment, '[^\p{L}\p{N}\s]', ' ', 'g'),
                                       '\s+', ' ', 'g')) AS comments
            FROM reviews_raw
            WHERE comment IS NOT NULL AND rating_star IS NOT NULL AND name IS NOT NULL)""",
    "relaxed": """
        SELECT * FROM cleaned
        WHERE length(comments) > 0 AND len(list_filter(tokens, lambda t: length(t) > 6)) = 0""",
    "strict_all": """
        SELECT * FROM relaxed WHERE len(tokens) >= 10 AND length(comments) <= 3000""",
    "strict": """
        SELECT scope, name, row_id, rating_star, comments FROM strict_all
        QUALIFY row_number() OVER (PARTITION BY comments ORDER BY row_id) = 1""",
    "strict_scoped": """
        SELECT scope, name, row_id, rating_star, comments FROM strict_all
        QUALIFY row_number() OVER (PARTITION BY scope, comments ORDER BY row_id) = 1""",
    "rated": """
        SELECT *, avg(rating_star) OVER (PARTITION BY scope, name) AS rating FROM strict_scoped""",
    "numbered": """
        SELECT *, row_number() OVER (PARTITION BY scope, name ORDER BY row_id) AS row_no
        FROM rated""",
    "manifest": """
        SELECT 'doc' || doc_id AS filename, doc_id AS pos FROM documents""",
    "available": """
        SELECT 'doc' || doc_id || '.csv' AS filename FROM labels""",
    "url_ids": r"""
        SELECT page_id AS pos, url, regexp_extract(url, '/([a-z]{2})/(\d+)', 2) AS itemid,
               regexp_extract(url, '/([a-z]{2})/(\d+)', 1) AS shopid
        FROM pages""",
    "url_manifest": """
        SELECT itemid || '_' || shopid AS filename, pos FROM url_ids
        WHERE itemid <> '' AND shopid <> ''""",
    "request_log": """
        SELECT user_id, value AS response_time,
               CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN 'exception'
                    WHEN 'view' THEN 'validation_error' ELSE 'success' END AS status
        FROM events""",
    "doc_comments": """
        SELECT doc_id, source AS product_name, pos, text, ((doc_id + pos) % 6)::INT AS rating
        FROM (SELECT doc_id, source, unnest(xs) AS text, unnest(range(len(xs))) AS pos
              FROM pieces)""",
}


def with_views(sql: str) -> str:
    """``sql`` behind the views it uses, directly or through others."""
    import re

    needed: list[str] = []
    text = sql
    for name in reversed(list(SQL_VIEWS)):
        if re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
            needed.append(name)
            text += SQL_VIEWS[name]
    ctes = ",\n".join(f"{name} AS ({SQL_VIEWS[name]})" for name in reversed(needed))
    body = sql.strip()
    return f"WITH {ctes}\n{body}" if needed else body
