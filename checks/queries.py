"""One query per operator, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import views as v
from checks.views import table, with_views
from reviewloom.functions import names, rating, review, spam, text
from reviewloom.operators import clean, enrich, payload, skew, stats, workset
from reviewloom.operators import keywords as keyword_lists
from reviewloom.operators import rating as product
from reviewloom.plans import job
from reviewloom.plans.enrich import enrich_reviews
from reviewloom.plans.score import score_late_reviews, score_reviews
from reviewloom.session import fresh_path, land
from reviewloom.sources import documents, files, landing, ratings, sinks
from reviewloom.streaming import arrivals
from reviewloom.streaming import pages as page_streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

SCOPE = ("scope",)
# small enough that every product counts as hot and is spread
FEW_ROWS = 7


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = with_views(sql)
        return fn
    return register


def _round(c: str) -> object:
    return F.round(c, 6).alias(c)


def _strict(spark: SparkSession, sf: str, scope: tuple[str, ...] = SCOPE) -> DataFrame:
    return clean.clean_reviews(_raw(spark, sf), clean.STRICT, scope, ["row_id"])


def _raw(spark: SparkSession, sf: str) -> DataFrame:
    return v.reviews_raw(spark, sf).select("scope", "name", "row_id", "comment", "rating_star")


def _rated(spark: SparkSession, sf: str) -> DataFrame:
    return product.with_product_rating(_strict(spark, sf), SCOPE)


# --- scoring ---

@query("""
    SELECT name, round(avg(rating_star) OVER (PARTITION BY name), 6) AS rating, comments
    FROM strict""")
def score_reviews_whole_input(spark, sf):
    return score_reviews(v.reviews_raw(spark, sf), order_by=["row_id"]).withColumn(
        "rating", F.round("rating", 6))


@query("SELECT scope, name, round(rating, 6) AS rating, comments FROM rated")
def score_reviews_per_file(spark, sf):
    return score_reviews(v.reviews_raw(spark, sf), SCOPE, order_by=["row_id"]).withColumn(
        "rating", F.round("rating", 6))


@query("""
    SELECT scope, name, round(avg(rating_star) OVER (PARTITION BY scope, name), 6)
           AS average_rating, comments AS cleaned_comment
    FROM relaxed""")
def score_late_reviews_per_file(spark, sf):
    return score_late_reviews(v.reviews_raw(spark, sf), SCOPE).withColumn(
        "average_rating", F.round("average_rating", 6))


# --- projections, filters, cleaning ---

@query("""
    SELECT row_id, name, rating_star, comment FROM reviews_raw
    WHERE comment IS NOT NULL AND rating_star IS NOT NULL AND name IS NOT NULL""")
def require_columns(spark, sf):
    return clean.require_columns(v.reviews_raw(spark, sf)).select(
        "row_id", "name", "rating_star", "comment")


@query("SELECT row_id, try_cast(rating_star AS DOUBLE) AS rating FROM reviews_raw")
def parse_rating(spark, sf):
    return v.reviews_raw(spark, sf).select("row_id",
                                           rating.parse_rating("rating_star").alias("rating"))


@query(r"""
    SELECT doc_id, trim(regexp_replace(regexp_replace(text, '[^\p{L}\p{N}\s]', ' ', 'g'),
                                       '\s+', ' ', 'g')) AS comments
    FROM documents""")
def clean_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.clean_text("text").alias("comments"))


@query(r"""
    SELECT doc_id, nfc_normalize(text) AS composed,
           trim(regexp_replace(regexp_replace(nfc_normalize(text), '[^\p{L}\p{N}\s]', ' ', 'g'),
                               '\s+', ' ', 'g')) AS comments
    FROM (SELECT doc_id, replace(replace(replace(text, 'é', 'e' || chr(769)), 'ü', 'u' || chr(776)), 'an', 'a' || chr(770)
                                 || chr(769) || 'n') AS text FROM documents)""")
def compose_accents(spark, sf):
    apart = table(spark, sf, "documents").select("doc_id", "text")
    for letter, parts in (("é", "e\u0301"), ("ü", "u\u0308"), ("an", "a\u0302\u0301n")):
        apart = apart.withColumn("text", F.replace("text", F.lit(letter), F.lit(parts)))
    return apart.select("doc_id", text.compose_accents("text").alias("composed"),
                        text.clean_text("text", compose=True).alias("comments"))


@query("""
    SELECT row_id, CASE WHEN len(list_filter(tokens, lambda t: length(t) > 6)) > 0 THEN ''
                        ELSE comments END AS comments
    FROM cleaned""")
def blank_if_long_token(spark, sf):
    rows = clean.require_columns(v.reviews_raw(spark, sf))
    return rows.select("row_id", text.blank_if_long_token(text.clean_text("comment"), 6)
                       .alias("comments"))


@query("""
    SELECT row_id, length(comments) > 0 AS has_text,
           len(list_filter(tokens, lambda t: length(t) > 6)) = 0 AS short_tokens,
           len(tokens) >= 10 AS enough_words, length(comments) <= 100 AS short_enough
    FROM cleaned""")
def cleaning_rules(spark, sf):
    rows = clean.require_columns(v.reviews_raw(spark, sf))
    return rows.select("row_id", text.cleans_to_text("comment").alias("has_text"),
                       text.cleans_to_short_tokens("comment", 6).alias("short_tokens"),
                       text.cleans_to_min_words("comment", 10).alias("enough_words"),
                       text.cleans_to_max_chars("comment", 100).alias("short_enough"))


@query("SELECT scope, name, row_id, rating_star, comments FROM strict_scoped")
def clean_reviews_strict(spark, sf):
    return _strict(spark, sf)


@query("SELECT scope, name, row_id, rating_star, comments FROM relaxed")
def clean_reviews_relaxed(spark, sf):
    return clean.clean_reviews(_raw(spark, sf), clean.RELAXED)


@query("""
    SELECT scope, comments, name, row_id FROM (SELECT *, comment AS comments FROM reviews)
    QUALIFY row_number() OVER (PARTITION BY scope, comments ORDER BY name, row_id) = 1""")
def dedup_comments(spark, sf):
    rows = v.reviews(spark, sf).select("scope", F.col("comment").alias("comments"), "name",
                                       "row_id")
    return clean.dedup_comments(rows, SCOPE, ["name", "row_id"])


# --- ratings ---

@query("""
    SELECT scope, name, round(avg(try_cast(rating_star AS DOUBLE)), 6) AS rating,
           count(*) AS n_reviews
    FROM reviews_raw GROUP BY scope, name""")
def average_rating(spark, sf):
    rows = v.reviews_raw(spark, sf).withColumn("rating_star", rating.parse_rating("rating_star"))
    return product.average_rating(rows, SCOPE, count_into="n_reviews").withColumn(
        "rating", F.round("rating", 6))


@query("SELECT name, scope, trunc(avg(rating_star))::INT AS stars FROM reviews GROUP BY name, scope")
def star_int(spark, sf):
    return product.average_rating(v.reviews(spark, sf), SCOPE).select(
        "name", "scope", rating.star_int("rating").alias("stars"))


_WITH_RATING = """
    SELECT row_id, scope, name,
           round(avg(rating_star) OVER (PARTITION BY scope, name), 6) AS rating
    FROM reviews"""


def _with_rating(spark, sf, **options):
    rows = v.reviews(spark, sf).select("row_id", "scope", "name", "rating_star")
    return product.with_product_rating(rows, SCOPE, **options).select(
        "row_id", "scope", "name", _round("rating"))


@query(_WITH_RATING)
def with_product_rating(spark, sf):
    return _with_rating(spark, sf)


@query(_WITH_RATING)
def with_product_rating_hot_keys(spark, sf):
    return _with_rating(spark, sf, rows_per_split=FEW_ROWS)


_FIRST = """
    SELECT row_id, scope, name FROM reviews
    QUALIFY name = min(name) OVER (PARTITION BY scope)"""


@query(_FIRST)
def only_first_product(spark, sf):
    rows = v.reviews(spark, sf).select("row_id", "scope", "name")
    return product.only_first_product(rows, SCOPE)


# --- payloads ---

def _payload_sql(size: int, where: str = "TRUE") -> str:
    return f"""
    SELECT scope, name AS product_name, ((row_no - 1) // {size})::INT AS part,
           count(*) AS n_comments,
           string_agg(concat_ws('|', comments, trunc(rating)::INT), chr(10) ORDER BY row_no)
               AS comments
    FROM numbered WHERE {where} GROUP BY ALL"""


def _payload(spark, sf, **options):
    p = payload.product_payload(_rated(spark, sf), "row_id", SCOPE, **options)
    lines = F.transform("comments", lambda x: F.concat_ws("|", x["text"], x["rating"]))
    return p.select("scope", "product_name", "part",
                    F.size("comments").cast("bigint").alias("n_comments"),
                    F.array_join(lines, "\n").alias("comments"))


@query(_payload_sql(3000))
def product_payload(spark, sf):
    return _payload(spark, sf)


@query(_payload_sql(5))
def product_payload_in_parts(spark, sf):
    return _payload(spark, sf, part_size=5, rows_per_split=FEW_ROWS)


@query(_payload_sql(3000, "row_no <= 3"))
def product_payload_capped(spark, sf):
    return _payload(spark, sf, max_comments=3)


@query("""
    SELECT scope, name AS product_name, 0 AS part,
           string_agg(comments || '|' || rating_star::INT, chr(10) ORDER BY row_no) AS comments
    FROM numbered WHERE rating_star IS NOT NULL GROUP BY scope, name""")
def product_payload_own_rating(spark, sf):
    rows = _rated(spark, sf).filter(F.col("rating_star").isNotNull())
    p = payload.product_payload(rows, "row_id", SCOPE, rating=rating.star_int("rating_star"))
    lines = F.transform("comments", lambda x: F.concat_ws("|", x["text"], x["rating"]))
    return p.select("scope", "product_name", "part", F.array_join(lines, "\n").alias("comments"))


@query("""
    SELECT scope, '{"product_name":"' || name || '","comments":[' ||
           string_agg('{"text":"' || comments || '"'
                      || coalesce(',"rating":' || trunc(rating)::INT, '') || '}', ','
                      ORDER BY row_no) || ']}' AS payload
    FROM numbered GROUP BY scope, name""")
def payload_json(spark, sf):
    p = payload.product_payload(_rated(spark, sf), "row_id", SCOPE)
    return payload.payload_json(p).select("scope", "payload")


# --- validation, spam, prompts ---

@query("""
    SELECT doc_id, pos, coalesce(length(text) BETWEEN 1 AND 3000 AND rating BETWEEN 1 AND 5, FALSE)
           AS valid
    FROM doc_comments""")
def valid_comment(spark, sf):
    rows = v.document_payloads(spark, sf).select("doc_id", F.posexplode("comments").alias("p", "c"))
    return rows.select("doc_id", F.col("p").cast("bigint").alias("pos"),
                       review.valid_comment("c.text", "c.rating").alias("valid"))


@query("""
    SELECT doc_id, reason IS NULL AS is_valid, reason AS reject_reason FROM (
        SELECT doc_id,
               CASE WHEN NOT (length(any_value(product_name)) BETWEEN 1 AND 200)
                         THEN 'product_name'
                    WHEN NOT (count(*) BETWEEN 1 AND 3000) THEN 'comment_count'
                    WHEN NOT bool_and(length(text) BETWEEN 1 AND 3000 AND rating BETWEEN 1 AND 5)
                         THEN 'comment' END AS reason
        FROM doc_comments GROUP BY doc_id)""")
def valid_review(spark, sf):
    return payload.valid_review(v.document_payloads(spark, sf)).select(
        "doc_id", "is_valid", "reject_reason")


_KEYWORDS = "[" + ", ".join("'" + k.lower() + "'" for k in spam.SPAM_KEYWORDS) + "]"
_WS = r"[\s\p{Z}\x0B\x1C-\x1F\x{85}]+"


def _keyword_sql(c: str) -> str:
    return f"len(list_filter({_KEYWORDS}, lambda k: contains(lower({c}), k))) > 0"


def _long_sql(c: str) -> str:
    return rf"len(list_filter(regexp_split_to_array({c}, '{_WS}'), lambda t: length(t) > 8)) > 0"


def _words_sql(c: str) -> str:
    return rf"len(list_filter(regexp_split_to_array({c}, '{_WS}'), lambda t: length(t) > 0))"


_URL_SQL = "regexp_matches({}, 'https?://[!$-_a-z]')"


def _useful_sql(c: str, r: str) -> str:
    return (f"length({c}) BETWEEN 1 AND 3000 AND {r} BETWEEN 1 AND 5 AND {_words_sql(c)} >= 4 "
            f"AND NOT ({_long_sql(c)}) AND NOT {_URL_SQL.format(c)} AND NOT ({_keyword_sql(c)})")


@query(f"SELECT page_id, {_keyword_sql('html')} AS hit FROM pages")
def has_spam_keyword(spark, sf):
    return table(spark, sf, "pages").select("page_id", spam.has_spam_keyword("html").alias("hit"))


@query(f"""
    SELECT doc_id, {_URL_SQL.format('text')} AS in_text FROM documents""")
def has_url(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.has_url("text").alias("in_text"))


@query(f"SELECT row_id, {_long_sql('comment')} AS long_token FROM reviews")
def has_long_token(spark, sf):
    return v.reviews(spark, sf).select("row_id", text.has_long_token("comment").alias("long_token"))


@query(f"""
    SELECT row_id, reason IS NOT NULL AS spam, reason FROM (
        SELECT row_id, CASE WHEN {_keyword_sql('comment')} THEN 'keyword'
                            WHEN {_URL_SQL.format('comment')} THEN 'url'
                            WHEN {_long_sql('comment')} THEN 'long_token' END AS reason
        FROM reviews)""")
def spam_verdict(spark, sf):
    return v.reviews(spark, sf).select("row_id", spam.is_spam("comment").alias("spam"),
                                       spam.spam_reason("comment").alias("reason"))


@query(f"""
    SELECT row_id, name, rating_star, comment FROM reviews
    WHERE {_useful_sql('comment', 'rating_star')}""")
def keep_valid_comments(spark, sf):
    return payload.keep_valid_comments(v.reviews(spark, sf)).select(
        "row_id", "name", "rating_star", "comment")


_USEFUL_DOCS = f"""
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i FROM doc_comments
    WHERE {_useful_sql('text', 'rating')}"""


@query(f"""
    SELECT d.doc_id, coalesce(k.n, 0)::INT AS n_comments, coalesce(k.comments, '') AS comments
    FROM documents d LEFT JOIN (
        SELECT doc_id, count(*) AS n,
               string_agg(text || '|' || rating, chr(10) ORDER BY i) AS comments
        FROM ({_USEFUL_DOCS}) GROUP BY doc_id) k USING (doc_id)""")
def filter_comment_array(spark, sf):
    kept = v.document_payloads(spark, sf).select(
        "doc_id", review.filter_comment_array("comments").alias("kept"))
    lines = F.transform("kept", lambda x: F.concat_ws("|", x["text"], x["rating"]))
    return kept.select("doc_id", F.size("kept").alias("n_comments"),
                       F.array_join(lines, "\n").alias("comments"))


_HEAD, _TAIL = (part.replace("{{", "{").replace("}}", "}")
                for part in review.PROMPT_TEMPLATE.split("{comments}"))
_TAIL_A, _TAIL_B = _TAIL.split("{product_name}")


@query(f"""
    SELECT scope, name AS product_name,
           '{_HEAD}' || string_agg('Comment ' || row_no || ': ' || comments || ' (Số sao: ' ||
                                   coalesce(trunc(rating)::INT::VARCHAR, 'None') || ')',
                                   chr(10) ORDER BY row_no)
           || '{_TAIL_A}' || name || '{_TAIL_B}' AS prompt
    FROM numbered GROUP BY scope, name""")
def build_prompt(spark, sf):
    p = payload.product_payload(_rated(spark, sf), "row_id", SCOPE)
    return payload.build_prompt(p).select("scope", "product_name", "prompt")


# --- other text functions ---

@query("SELECT doc_id, replace(replace(text, chr(10), ' '), chr(13), ' ') AS line FROM documents")
def flatten_lines(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.flatten_lines("text").alias("line"))


@query(rf"""
    SELECT doc_id, regexp_replace(trim(regexp_replace(text, '{_WS}', ' ', 'g')),
                                  '[^\p{{L}}\p{{N}}_ .,!?()\-]', '', 'g')[1:1000] AS sanitized
    FROM documents""")
def sanitize_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id",
                                                text.sanitize_text("text").alias("sanitized"))


@query(rf"""
    SELECT page_id, regexp_replace(trim(regexp_replace(html, '{_WS}', ' ', 'g')),
                                   '[^\p{{L}}\p{{N}}_ \-]', '', 'g')[1:200] AS product_name
    FROM pages""")
def sanitize_name(spark, sf):
    return table(spark, sf, "pages").select("page_id",
                                            text.sanitize_name("html").alias("product_name"))


@query("SELECT pos, nullif(itemid, '') AS itemid, nullif(shopid, '') AS shopid FROM url_ids")
def extract_ids(spark, sf):
    ids = names.extract_ids("url", v.URL_PATTERN)
    return v.manifest_urls(spark, sf).select("pos", ids.alias("ids")).select("pos", "ids.*")


@query("""
    SELECT filename, '/landing/raw/' || filename || '.csv' AS path FROM manifest
    UNION ALL SELECT filename, '/landing/raw/' || filename AS path FROM available""")
def data_path(spark, sf):
    both = v.manifest(spark, sf).select("filename").unionAll(v.available(spark, sf))
    return both.select("filename", names.data_path("filename", "/landing/raw").alias("path"))


# --- work lists ---

@query("SELECT filename, pos FROM manifest WHERE filename || '.csv' IN (SELECT filename FROM available)")
def ready_files(spark, sf):
    return workset.ready_files(v.manifest(spark, sf), v.available(spark, sf))


@query("""
    SELECT filename, pos FROM manifest
    WHERE filename || '.csv' NOT IN (SELECT filename FROM available)""")
def pending_files(spark, sf):
    return workset.pending_files(v.manifest(spark, sf), v.available(spark, sf))


@query("""
    SELECT filename, pos, CASE WHEN filename || '.csv' IN (SELECT filename FROM available)
                               THEN 'ready' ELSE 'pending' END AS status
    FROM manifest""")
def arrival_status(spark, sf):
    return workset.arrival_status(v.manifest(spark, sf), v.available(spark, sf))


@query("""
    SELECT filename, pos, 'comment_index_' || (75 + row_number() OVER (ORDER BY pos)) AS index_name
    FROM manifest""")
def assign_index(spark, sf):
    return workset.assign_index(v.manifest(spark, sf))


@query("""
    SELECT url, pos, ((row_number() OVER (ORDER BY pos) - 1) % 3)::INT AS bucket
    FROM (SELECT url, page_id AS pos FROM pages)""")
def bucket_modulo(spark, sf):
    return workset.bucket_modulo(v.manifest_urls(spark, sf), 3)


@query("""
    SELECT url, pos, (ntile(5) OVER (ORDER BY pos) - 1)::INT AS bucket
    FROM (SELECT url, page_id AS pos FROM pages)""")
def bucket_contiguous(spark, sf):
    return workset.bucket_contiguous(v.manifest_urls(spark, sf), 5)


_CAPPED = """
    SELECT row_id, name FROM reviews
    QUALIFY row_number() OVER (PARTITION BY name ORDER BY row_id) <= 100"""


@query(_CAPPED)
def cap_reviews(spark, sf):
    rows = v.reviews(spark, sf).select("row_id", "name")
    return workset.cap_reviews(rows, 100, ["name"], "row_id")


@query(_CAPPED)
def cap_reviews_hot_keys(spark, sf):
    rows = v.reviews(spark, sf).select("row_id", "name")
    return workset.cap_reviews(rows, 100, ["name"], "row_id", rows_per_split=300)


@query("SELECT row_id, row_number() OVER (ORDER BY row_id) AS row_no FROM reviews")
def number_rows_whole_input(spark, sf):
    rows = v.reviews(spark, sf).select("row_id")
    numbered = skew.number_rows(rows, [], "row_id", rows_per_split=1000)
    return numbered.select("row_id", F.col("row_no").cast("bigint").alias("row_no"))


# --- rating pages and files ---

@query("""
    SELECT conv_id, turn, (turn % 5 + 1)::INT AS rating_star,
           replace(replace(text, chr(10), ' '), chr(13), ' ') AS comment,
           CASE WHEN turn % 4 = 3 THEN '' ELSE role END AS name
    FROM conversations""")
def flatten_rating_pages(spark, sf):
    rows = ratings.flatten_rating_pages(v.rating_pages(spark, sf), "page")
    # turns count from 0 without gaps, so the place on the page gives the turn back
    turn = F.col("page_no") * v.PAGE_SIZE + F.col("page_row")
    return rows.select("conv_id", turn.alias("turn"), "rating_star", "comment", "name")


@query("""
    SELECT conv_id AS itemid, CASE WHEN turn % 4 <> 3 THEN role END AS name, turn AS shopid,
           conv_id + turn AS userid, (turn % 5 + 1)::INT AS rating_star, text AS comment
    FROM conversations""")
def flatten_rating_pages_wide(spark, sf):
    return ratings.flatten_rating_pages(v.rating_pages(spark, sf), "page", wide=True).select(
        "itemid", "name", "shopid", "userid", "rating_star", "comment")


@query("SELECT filename, pos FROM url_manifest")
def build_manifest(spark, sf):
    return files.build_manifest(v.manifest_urls(spark, sf), pattern=v.URL_PATTERN).select(
        "filename", "pos")


@query("""
    SELECT filename, 'comment_index_' || (75 + row_number() OVER (ORDER BY pos)) AS index_name
    FROM url_manifest""")
def read_manifest(spark, sf):
    path = fresh_path(spark, "manifest")
    listed = files.build_manifest(v.manifest_urls(spark, sf), pattern=v.URL_PATTERN)
    sinks.write_manifest(listed.repartition(6), path)
    manifest = files.read_manifest(spark, path, has_header=False)
    return workset.assign_index(manifest).select("filename", "index_name")


@query("SELECT url, row_number() OVER (ORDER BY page_id) AS row_no FROM pages")
def read_product_urls(spark, sf):
    path = fresh_path(spark, "urls")
    v.manifest_urls(spark, sf).orderBy("pos").select("url").write.csv(path, escape='"')
    urls = skew.number_rows(files.read_product_urls(spark, path), [], "pos")
    return urls.select("url", F.col("row_no").cast("bigint").alias("row_no"))


def _as_files(spark: SparkSession, sf: str) -> DataFrame:
    return v.reviews_raw(spark, sf).select("rating_star", text.flatten_lines("comment")
                                           .alias("comment"), "name", "scope")


@query("""
    SELECT rating_star, nullif(replace(comment, chr(13), ' '), '') AS comment, name
    FROM reviews_raw""")
def read_reviews(spark, sf):
    path = fresh_path(spark, "raw")
    rows = _as_files(spark, sf)
    # two appends, as pages come in, of which the second orders its columns in another way
    for english, order in ((True, ["rating_star", "comment", "name"]),
                           (False, ["name", "rating_star", "comment"])):
        part = rows.filter((F.col("scope") == "en") == english)
        sinks.append_reviews(part.select(*order), path)
    return files.read_reviews(spark, path, mixed_headers=True).select("rating_star", "comment", "name")


@query("""
    SELECT row_id, CASE WHEN scope = 'en' THEN rating_star END AS rating_star, comment, name,
           scope AS source_file
    FROM reviews_raw""")
def land_reviews(spark, sf):
    path = fresh_path(spark, "landed")
    rows = v.reviews_raw(spark, sf).select("row_id", "rating_star", "comment", "name",
                                           F.col("scope").alias("source_file"))
    sinks.land_reviews(rows.withColumn("rating_star", F.lit(None).cast("string")), path)
    sinks.land_reviews(rows.filter(F.col("source_file") == "en"), path)
    return spark.read.schema(rows.schema).parquet(path)


@query("""
    SELECT index_name, scope, name, round(rating, 6) AS rating, comments FROM rated JOIN (
        SELECT lang AS scope, 'comment_index_' || (75 + row_number() OVER (ORDER BY min(doc_id)))
               AS index_name
        FROM documents GROUP BY lang) USING (scope)""")
def write_index(spark, sf):
    path = fresh_path(spark, "index")
    expected = table(spark, sf, "documents").groupBy(F.col("lang").alias("scope")).agg(
        F.min("doc_id").alias("pos"))
    scored = score_reviews(v.reviews_raw(spark, sf), SCOPE, order_by=["row_id"])
    indexed = skew.spread_join(scored, workset.assign_index(expected).drop("pos"), ["scope"])
    # one call for each half of the indexes, and one of them again
    for english in (True, False, True):
        sinks.write_index(indexed.filter((F.col("scope") == "en") == english), path)
    return spark.read.schema(indexed.schema).parquet(path).select(
        "index_name", "scope", "name", _round("rating"), "comments")


@query("SELECT name, round(rating, 6) AS rating, comments FROM rated")
def write_clean(spark, sf):
    path = fresh_path(spark, "clean")
    scored = score_reviews(v.reviews_raw(spark, sf), SCOPE, order_by=["row_id"]).drop("scope")
    sinks.write_clean(scored, path)
    return spark.read.schema(scored.schema).csv(path, header=True, escape='"').select(
        "name", _round("rating"), "comments")


@query("""
    SELECT row_id, rating_star, comment, name FROM reviews_raw ORDER BY row_id LIMIT 5""")
def preview(spark, sf):
    rows = v.reviews_raw(spark, sf).select("row_id", "rating_star", "comment", "name")
    return sinks.preview(rows, order_by=["row_id"])


# --- request statistics ---

def _stats_sql(group: str = "") -> str:
    took = "response_time) FILTER (status = 'success'"
    return f"""
    SELECT {group + ',' if group else ''} count(*) AS total_requests,
           count(*) FILTER (status = 'success') AS successful_responses,
           count(*) FILTER (status = 'error') AS error_responses,
           count(*) FILTER (status = 'exception') AS exceptions,
           count(*) FILTER (status = 'validation_error') AS validation_errors,
           round(coalesce(avg({took}), 0), 6) AS avg_response_time,
           coalesce(max({took}), 0) AS max_response_time,
           coalesce(min({took}), 0) AS min_response_time
    FROM request_log {'GROUP BY ' + group if group else ''}"""


@query(_stats_sql())
def request_stats(spark, sf):
    return stats.request_stats(v.request_log(spark, sf)).withColumn(
        "avg_response_time", F.round("avg_response_time", 6))


@query(_stats_sql("user_id"))
def request_stats_per_user(spark, sf):
    return stats.request_stats(v.request_log(spark, sf), ["user_id"]).withColumn(
        "avg_response_time", F.round("avg_response_time", 6))


# --- enrichment; the outside text function is replaced by one that counts ---

def counting_function() -> Callable[[str], str]:
    def answer(payload_text: str) -> str:
        import json
        p = json.loads(payload_text)
        return json.dumps({
            "product_name": p["product_name"] + " (renamed)",
            "summary": f"{len(p['comments'])} comments, {p['comments'][0].get('rating')} stars"})
    return answer


def sometimes_failing(fn: Callable[[str], str]) -> Callable[[str], str]:
    """``fn`` that fails, by the number of comments: of four payloads one once, one twice, one always."""
    calls: dict[str, int] = {}

    def answer(payload_text: str) -> str:
        import json
        fails = {0: 0, 1: 1, 2: 2, 3: 9}[len(json.loads(payload_text)["comments"]) % 4]
        calls[payload_text] = calls.get(payload_text, 0) + 1
        if calls[payload_text] <= fails:
            raise TimeoutError("busy")
        return fn(payload_text)
    return answer


@query("""
    SELECT scope, name AS product_name, 0 AS part,
           CASE WHEN count(*) % 4 < 3 THEN count(*) || ' comments, ' || coalesce(
               trunc(any_value(rating))::INT::VARCHAR, 'None') || ' stars' END AS summary,
           CASE WHEN count(*) % 4 < 3 THEN name || ' (renamed)' END AS echoed_name,
           CASE WHEN count(*) % 4 = 3 THEN 'TimeoutError: busy' END AS error,
           least(count(*) % 4 + 1, 3)::INT AS attempts
    FROM rated GROUP BY scope, name""")
def summarize(spark, sf):
    p = payload.payload_json(payload.product_payload(_rated(spark, sf), "row_id", SCOPE))
    return enrich.summarize(p, sometimes_failing(counting_function()),
                            keys=["scope", "product_name", "part"], max_parallel=4, backoff=0.0)


def _enriched_sql(size: int, chosen: str) -> str:
    # comments, then parts, then parts of parts: the first number that fits into one payload
    sizes = " ".join(f"WHEN n <= {size ** (k + 1)} THEN ceil(n / {size ** k})::INT" for k in range(12)
                     if size ** (k + 1) < 2 ** 62)
    return f"""
    SELECT scope, name, round(rating, 6) AS rating, comments,
           CASE WHEN {chosen} THEN (CASE {sizes} END) || ' comments, '
               || coalesce(trunc(rating)::INT::VARCHAR, 'None') || ' stars' END AS summary,
           NULL::VARCHAR AS error, CASE WHEN {chosen} THEN 1 END AS attempts
    FROM (SELECT *, min(name) OVER (PARTITION BY scope) AS first_name,
                 count(*) OVER (PARTITION BY scope, name) AS n FROM numbered)"""


def _enriched(spark, sf, **options):
    return enrich_reviews(_raw(spark, sf), counting_function(), SCOPE, order_by="row_id",
                          **options).withColumn("rating", F.round("rating", 6))


@query(_enriched_sql(3000, "name = first_name"))
def enrich_reviews_first_product(spark, sf):
    return _enriched(spark, sf)


@query(_enriched_sql(4, "TRUE"))
def enrich_reviews_all_products_in_parts(spark, sf):
    return _enriched(spark, sf, products="all", part_size=4, rows_per_split=FEW_ROWS)


@query("""
    SELECT row_id, scope, name, CASE WHEN avg_stars >= 3 THEN n || ' reviews' END AS summary
    FROM (SELECT *, avg(rating_star) OVER w AS avg_stars, count(*) OVER w AS n
          FROM reviews WINDOW w AS (PARTITION BY scope, name))""")
def attach_summary(spark, sf):
    rows = v.reviews(spark, sf).select("row_id", "scope", "name", "rating_star")
    found = product.average_rating(rows, SCOPE, count_into="n").filter("rating >= 3")
    summaries = found.withColumn("summary", F.concat_ws(" ", "n", F.lit("reviews")))
    return enrich.attach_summary(rows.drop("rating_star"), summaries, SCOPE)


@query("""
    SELECT conv_id, turn, CASE WHEN turn % 4 IN (0, 3) THEN role END AS product_name,
           CASE WHEN turn % 4 IN (0, 3) THEN text END AS summary, turn % 4 IN (0, 3) AS is_valid
    FROM conversations""")
def parse_summary(spark, sf):
    parsed = review.parse_summary("response")
    return v.responses(spark, sf).select("conv_id", "turn", parsed.alias("p")).select(
        "conv_id", "turn", "p.*")


# every long word of the benchmark's texts, and a few phrases, among them ones of one and two letters
_KEYWORDS = """(SELECT unnest(regexp_extract_all(text, '[a-zA-Z]{7,}')) AS k FROM benchmark
                UNION SELECT unnest(['Q', 'zy', 'that, ', ', th', 'NEVER SEEN ANYWHERE', '']))"""


def _keywords(spark: SparkSession, sf: str) -> DataFrame:
    words = F.explode(F.regexp_extract_all("text", F.lit("[a-zA-Z]{7,}"), F.lit(0))).alias("keyword")
    few = spark.createDataFrame([(k,) for k in ("Q", "zy", "that, ", ", th", "NEVER SEEN ANYWHERE", "")],
                                "keyword string")
    return table(spark, sf, "benchmark").select(words).union(few)


@query(f"""
    SELECT DISTINCT row_id, lower(k) AS keyword FROM reviews, {_KEYWORDS}
    WHERE k <> '' AND contains(lower(comment), lower(k))""")
def keyword_hits(spark, sf):
    return keyword_lists.keyword_hits(v.reviews(spark, sf), _keywords(spark, sf), ["row_id"])


@query(f"""
    SELECT row_id, EXISTS (SELECT 1 FROM {_KEYWORDS} WHERE k <> '' AND contains(lower(comment), lower(k)))
           AS has_keyword FROM reviews""")
def mark_keywords(spark, sf):
    rows = v.reviews(spark, sf).select("row_id", "comment")
    return keyword_lists.mark_keywords(rows, _keywords(spark, sf), ["row_id"], broadcast_bytes=0).select(
        "row_id", "has_keyword")


# --- arrival ---

def _document_stream(spark: SparkSession, sf: str) -> DataFrame:
    # one file or a folder of part files; as a pattern, since the stream takes a plain path for a folder
    docs = spark.readStream.schema(table(spark, sf, "documents").schema).parquet(
        f"{sf.rstrip('/')}/documents.{{parquet}}")
    return v.dirty(v.reviews_of(docs)).withColumn("source_file", F.concat("scope", F.lit(".csv")))


@query("SELECT scope || '.csv' AS source_file, name, round(rating, 6) AS rating, comments FROM rated")
def stream_reviews(spark, sf):
    sink = fresh_path(spark, "stream")
    arrivals.stream_reviews(_document_stream(spark, sf), sink, fresh_path(spark, "progress"),
                            order_by=("row_id",), available_now=True).awaitTermination()
    return spark.read.parquet(sink).select("source_file", "name", _round("rating"), "comments")


@query("""
    SELECT scope || '.csv' AS source_file, name,
           round(avg(rating_star) OVER (PARTITION BY scope, name), 6) AS average_rating,
           comments AS cleaned_comment
    FROM relaxed WHERE scope <> 'en'""")
def stream_late_reviews(spark, sf):
    # the English file was there in time, the others are still expected
    pending = table(spark, sf, "documents").filter("lang <> 'en'").select(
        F.col("lang").alias("filename")).distinct()
    sink = fresh_path(spark, "late")
    arrivals.stream_late_reviews(_document_stream(spark, sf), sink, fresh_path(spark, "progress"),
                                 pending=pending, available_now=True).awaitTermination()
    late = spark.read.schema("source_file string, name string, average_rating double, "
                             "cleaned_comment string").csv(sink, header=True, escape='"')
    return late.withColumn("average_rating", F.round("average_rating", 6)).select(
        "source_file", "name", "average_rating", "cleaned_comment")


# --- whole jobs, from files made of the test tables ---

def _landing(spark: SparkSession, sf: str) -> str:
    """A landed table whose files are the languages."""
    path = fresh_path(spark, "landing")
    rows = v.reviews_raw(spark, sf).select(
        "row_id", "rating_star", text.flatten_lines("comment").alias("comment"), "name",
        F.concat(F.lit("lang "), F.col("scope"), F.lit(".csv")).alias("source_file"))
    sinks.land_reviews(rows, path)
    return path


_LANGUAGES = """(SELECT lang, 75 + row_number() OVER (ORDER BY lang) AS no
                 FROM (SELECT DISTINCT lang FROM documents))"""


def _language_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """A file per language, in their order; the last one is listed under a name that never comes."""
    langs = table(spark, sf, "documents").select(F.col("lang").alias("l")).distinct()
    name = F.concat(F.lit("lang "), F.col("l"))
    pos = F.ascii("l") * 1000 + F.ascii(F.substring("l", 2, 1))
    return langs.select(name.alias("filename"), pos.cast("bigint").alias("pos")).unionByName(
        spark.range(1).select(F.lit("never").alias("filename"), F.lit(10**9).cast("bigint").alias("pos")))


@query(f"""
    SELECT 'comment_index_' || no AS index_name, 'lang ' || scope || '.csv' AS source_file, name,
           round(avg(rating_star) OVER (PARTITION BY scope, name), 6) AS rating, comments,
           'landed' AS status
    FROM strict_scoped JOIN {_LANGUAGES} ON lang = scope
    UNION ALL SELECT 'comment_index_' || (76 + count(DISTINCT lang)), 'never', NULL, NULL, NULL, 'pending'
    FROM documents""")
def index_ready_files(spark, sf):
    index = fresh_path(spark, "index")
    landed = T.StructType([*files.RAW_REVIEW, T.StructField("row_id", T.LongType())])
    pending = job.index_ready_files(spark, _language_manifest(spark, sf), _landing(spark, sf),
                                    counting_function(), index, order_by="row_id",
                                    read_options={"fmt": "parquet", "schema": landed})
    rows = spark.read.parquet(index).select("index_name", "source_file", "name", _round("rating"),
                                            "comments", F.lit("landed").alias("status"))
    return rows.unionByName(pending.select(
        "index_name", F.col("filename").alias("source_file"), F.lit("pending").alias("status")),
        allowMissingColumns=True)


def _csv_landing(spark: SparkSession, sf: str) -> str:
    """A folder of CSVs, one per language, each with its own order of columns; the last file lacks one.

    Each is in parts, written by as many tasks as read the table.
    """
    folder, orders = fresh_path(spark, "landing"), [
        ("rating_star", "comment", "name"), ("name", "rating_star", "comment"), ("row_id", "comment", "name", "rating_star")]
    rows = land(v.reviews_raw(spark, sf).withColumn("comment", text.flatten_lines("comment")), "reviews")
    languages = [r[0] for r in table(spark, sf, "documents").select("lang").distinct().orderBy("lang").collect()]
    written = [(f"lang {lang}.csv", rows.filter(F.col("scope") == lang).select(*orders[i % len(orders)]))
               for i, lang in enumerate(languages)]
    for name, file in [*written, ("broken.csv", rows.select("comment", "name"))]:
        staged = f"{folder}-staged"
        file.write.mode("overwrite").options(header=True, **sinks._CSV_OUT).csv(staged)
        # into the folder under its own name and as a whole, as a crawler would move it there
        path = spark._jvm.org.apache.hadoop.fs.Path
        fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(path(folder))
        fs.rename(path(staged), path(f"{folder}/{name}"))
    return folder


@query("""
    SELECT 'lang ' || scope || '.csv' AS source_file, name,
           round(avg(rating_star) OVER (PARTITION BY scope, name), 6) AS rating, comments, NULL AS reason
    FROM relaxed
    UNION ALL SELECT 'broken.csv', NULL, NULL, NULL, 'no column rating_star'""")
def stream_files_by_header(spark, sf):
    sink, aside = fresh_path(spark, "stream"), fresh_path(spark, "aside")
    arrivals.stream_reviews(arrivals.file_stream(spark, _csv_landing(spark, sf), max_files=2), sink,
                            fresh_path(spark, "progress"), "relaxed", available_now=True,
                            set_aside=aside).awaitTermination()
    rows = spark.read.parquet(sink).select("source_file", "name", _round("rating"), "comments")
    return rows.unionByName(spark.read.parquet(aside).select("source_file", "reason"), allowMissingColumns=True)


@query("""
    SELECT 'lang ' || scope || '.csv' AS source_file, name,
           round(avg(rating_star) OVER (PARTITION BY scope, name), 6) AS average_rating,
           comments AS cleaned_comment
    FROM relaxed WHERE scope <> 'en'""")
def follow_pending_files(spark, sf):
    # every file of the folder comes in, and all but the English one are waited for
    pending = _language_manifest(spark, sf).filter("filename <> 'lang en'")
    sink = fresh_path(spark, "late")
    job.follow_pending_files(spark, pending, _csv_landing(spark, sf), sink, fresh_path(spark, "progress"),
                             available_now=True).awaitTermination()
    late = spark.read.schema("source_file string, name string, average_rating double, "
                             "cleaned_comment string").csv(sink, header=True, escape='"')
    return late.withColumn("average_rating", F.round("average_rating", 6)).select(
        "source_file", "name", "average_rating", "cleaned_comment")


@query("""
    SELECT DISTINCT 'lang ' || lang || '.csv' AS source_file, 'ready' AS status FROM documents
    UNION ALL SELECT 'never.csv', 'overdue'""")
def track_arrivals(spark, sf):
    listed, sink = fresh_path(spark, "manifest"), fresh_path(spark, "told")
    sinks.write_manifest(_language_manifest(spark, sf), listed)
    expected = spark.readStream.schema("filename string").csv(listed)
    query = arrivals.track_arrivals(spark, expected, _csv_landing(spark, sf), sink, fresh_path(spark, "progress"),
                                    patience=3, every="0 seconds")
    return arrivals.await_decided(query, _language_manifest(spark, sf), sink).select("source_file", "status")


@query("""
    SELECT filename, index_name, rating_star, comment, name FROM (
        SELECT conv_id || '_' || turn || '.csv' AS filename, 'comment_index_' ||
               (75 + row_number() OVER (ORDER BY conv_id || '_' || turn || '.csv')) AS index_name,
               (turn % 5 + 1)::VARCHAR AS rating_star,
               replace(replace(text, chr(10), ' '), chr(13), ' ') AS comment,
               CASE WHEN turn % 4 = 3 THEN '' ELSE role END AS name
        FROM conversations)""")
def ingest_pages(spark, sf):
    landed, listed = fresh_path(spark, "landed"), fresh_path(spark, "manifest")
    job.ingest_pages(v.rating_pages(spark, sf), "page", landed, listed, ["conv_id", "page_no"])
    manifest = workset.assign_index(files.read_manifest(spark, listed, has_header=False))
    rows = files.read_reviews(spark, landed, fmt="parquet", only=manifest.select("filename"))
    return rows.join(manifest, rows["source_file"] == manifest["filename"]).select(
        "filename", "index_name", "rating_star", "comment", "name")


# pages of two ratings, of which a product takes whole ones until it has five; each conversation is a product
_CAPPED_TURNS = """
    SELECT conv_id, turn, turn // 2 AS page_no, turn % 2 AS page_row, (turn % 5 + 1)::VARCHAR AS rating_star,
           replace(replace(text, chr(10), ' '), chr(13), ' ') AS comment,
           CASE WHEN turn % 4 = 3 THEN '' ELSE role END AS name
    FROM conversations
    QUALIFY count(*) OVER (PARTITION BY conv_id ORDER BY turn // 2) - count(*) OVER (PARTITION BY conv_id, turn // 2) < 5"""


def _small_pages(spark: SparkSession, sf: str) -> DataFrame:
    return v.rating_pages(spark, sf, 2).select(
        F.col("conv_id").alias("itemid"), F.pmod("conv_id", F.lit(7)).alias("shopid"), "page_no", "page")


@query(f"SELECT conv_id AS itemid, page_no, page_row, rating_star, comment, name FROM ({_CAPPED_TURNS})")
def cap_pages(spark, sf):
    pages = _small_pages(spark, sf).withColumn("n", ratings.page_size("page"))
    kept = workset.cap_pages(pages, "n", 5, rows_per_split=FEW_ROWS)
    return ratings.landed_reviews(kept.select("itemid", "page_no", "page"), "page")


@query(f"""
    SELECT conv_id || '_' || conv_id % 7 || '.csv' AS source_file, page_no, page_row, rating_star, comment, name,
           true AS complete FROM ({_CAPPED_TURNS})""")
def ingest_page_stream(spark, sf):
    # three waves, in which a product's pages come in any order; its empty page tells where it ends
    waves, landed, listed = (fresh_path(spark, n) for n in ("pages", "landed", "manifest"))
    pages = land(_small_pages(spark, sf), "pages")
    ends = pages.groupBy("itemid", "shopid").agg(F.max("page_no").alias("last")).select(
        "itemid", "shopid", (F.col("last") + 1).alias("page_no"), F.lit('{"data": {"ratings": []}}').alias("page"))
    every = pages.unionByName(ends)
    for wave in range(3):
        every.filter(F.pmod(F.xxhash64("itemid", "page_no"), F.lit(3)) == wave).coalesce(1).write.mode(
            "append").parquet(waves)
    stream = spark.readStream.schema(every.schema).option("maxFilesPerTrigger", 1).parquet(waves)
    page_streams.ingest_page_stream(stream, landed, listed, fresh_path(spark, "progress"), max_reviews=5,
                                    available_now=True).awaitTermination()
    complete = spark.read.parquet(listed).select(F.col("filename").alias("source_file"), F.lit(True).alias("complete"))
    return spark.read.parquet(landed).drop("batch_id").join(complete, "source_file", "left").select(
        "source_file", "page_no", "page_row", "rating_star", "comment", "name", "complete")


@query("SELECT DISTINCT scope, comments FROM strict_all")
def stream_distinct_reviews(spark, sf):
    # copies come in different files and batches, and after a restart
    waves, sink, progress = (fresh_path(spark, n) for n in ("reviews", "distinct", "progress"))
    rows = land(v.reviews_raw(spark, sf), "reviews")
    for run in range(2):
        # each wave has as many files as the input has parts, and is a batch
        written = []
        for wave in range(2):
            rows.filter(F.pmod(F.xxhash64("row_id"), F.lit(4)) == 2 * run + wave).write.mode("append").parquet(waves)
            written.append(len(spark.read.schema(rows.schema).parquet(waves).inputFiles()))
        stream = spark.readStream.schema(rows.schema).option(
            "maxFilesPerTrigger", written[1] - written[0]).parquet(waves)
        seen = stream.select("scope", "name", "comment", "rating_star",
                             F.col("_metadata.file_modification_time").alias("seen"))
        arrivals.stream_distinct_reviews(seen, sink, progress, "seen", "30 days", scope=SCOPE,
                                         available_now=True).awaitTermination()
    return spark.read.parquet(sink).select("scope", "comments")


@query("SELECT scope, name, row_id, rating_star, comments FROM strict_scoped")
def upsert_documents(spark, sf):
    # written twice, the second time in part: a document's id is its row, so each is there once
    path = fresh_path(spark, "documents").removeprefix("file:")
    rows = land(_strict(spark, sf).select("scope", "name", "row_id", "rating_star", "comments"), "reviews")
    documents.upsert_documents(rows.withColumn("comments", F.upper("comments")), path, ["row_id"])
    documents.upsert_documents(rows, path, ["row_id"])
    documents.upsert_documents(rows.filter("row_id % 3 = 0"), path, ["row_id"])
    return documents.read_documents(spark, path, rows.schema)


@query("SELECT rating_star, comment, name FROM reviews_raw WHERE scope IN ('de', 'fr')")
def append_reviews_once(spark, sf):
    path = fresh_path(spark, "appended")
    rows = land(v.reviews_raw(spark, sf).withColumn("comment", text.flatten_lines("comment")), "reviews")
    for lang in ("de", "fr", "de"):  # the third is a repetition
        sinks.append_reviews(rows.filter(F.col("scope") == lang).select("rating_star", "comment", "name"), path, lang)
    return files.read_reviews(spark, path).select(
        "rating_star", F.coalesce("comment", F.lit("")).alias("comment"), "name")


@query("""
    SELECT row_id, name, comment, 'lang ' || scope || '.csv' AS source_file FROM reviews_raw WHERE scope <> 'fr'""")
def replace_files(spark, sf):
    # all files, then some of them again, one of which has no rows any more
    path = fresh_path(spark, "versions")
    rows = land(v.reviews_raw(spark, sf).select("row_id", "name", "comment", F.concat(
        F.lit("lang "), F.col("scope"), F.lit(".csv")).alias("source_file")), "reviews")
    landing.replace_files(rows.withColumn("comment", F.upper("comment")), path)
    landing.replace_files(rows, path)
    listed = rows.select(F.col("source_file").alias("filename")).filter("filename IN ('lang en.csv', 'lang fr.csv')")
    landing.replace_files(rows.filter("source_file = 'lang en.csv'"), path, listed)
    return landing.read_landed(spark, path, rows.schema)
