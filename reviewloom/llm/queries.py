"""The operators over the test tables, with the SQL that must agree where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.llm import (alignment, bpe, collocations, decontaminate, lengths, licenses, minhash, paragraphs,
                            quality, secrets, sharding, simhash, toxicity)
from reviewloom.session import prepare_workers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

RANK_FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare_workers(spark)
        return fn(spark, sf_dir)
    QUERIES[fn.__name__] = run
    return run


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", "text")


def tokenizer(spark: SparkSession) -> bpe.BytePairEncoding:
    return bpe.BytePairEncoding(spark, RANK_FILE, public_tokenizers.PATTERN)


@query
def op3_quality(spark, sf):
    return quality.quality(_documents(spark, sf)).select(
        "doc_id", *[f"quality.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines",
                                             "n_repeat_words", "base_failed", "kept")])


# A word lies in a repeat of k words or more exactly if it lies in a window of k words that occurs again.
def _quality_sql() -> str:
    def run(k: int) -> str:  # k words from here on, null where there are fewer
        return " || ' ' || ".join(["w", *(f"lead(w, {i}) OVER here" for i in range(1, k))])
    return rf"""
    WITH texts AS (
        SELECT doc_id, coalesce(text, '') AS text,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
        FROM documents),
    sized AS (SELECT *, len(ws) AS n_words, 35 * len(ws) // 100 + 1 AS too_long FROM texts),
    lines AS (
        SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts)
        WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
    runs AS (
        SELECT doc_id, i, {run(5)} AS five, {run(8)} AS eight
        FROM (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM texts)
        WINDOW here AS (PARTITION BY doc_id ORDER BY i)),
    windows AS (
        SELECT doc_id, k, i, count(*) OVER (PARTITION BY doc_id, k, run) AS times
        FROM (SELECT doc_id, 5 AS k, i, five AS run FROM runs
              UNION ALL SELECT doc_id, 8, i, eight FROM runs) WHERE run IS NOT NULL),
    covered AS (
        SELECT doc_id, count(DISTINCT p) FILTER (k = 5) AS covered_words,
               count(DISTINCT p) FILTER (k = 8) AS n_repeat_words
        FROM (SELECT doc_id, k, unnest(range(i, i + k)) AS p FROM windows WHERE times > 1)
        GROUP BY doc_id),
    measured AS (
        SELECT doc_id, ws, too_long, n_words, length(array_to_string(ws, '')) AS word_chars,
               length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
               coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
               coalesce(covered_words, 0) AS covered_words,
               n_words < 20 OR 100 * coalesce(n_repeat_words, 0) > 30 * n_words AS base_failed
        FROM sized LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
    -- the longest repeat only matters where the rest lets a text pass
    long_repeats AS (
        SELECT DISTINCT doc_id
        FROM (SELECT doc_id, ws, too_long, unnest(range(1, n_words - too_long + 2)) AS i FROM measured
              WHERE NOT base_failed AND covered_words >= too_long AND 100 * covered_words <= 40 * n_words)
        GROUP BY doc_id, list_slice(ws, i, i + too_long - 1) HAVING count(*) > 1)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND 100 * covered_words <= 40 * n_words
           AND doc_id NOT IN (SELECT doc_id FROM long_repeats) AS kept
    FROM measured"""


ORACLES["op3_quality"] = _quality_sql()


@query
def op4_bpe(spark, sf):
    codec = tokenizer(spark)
    encoded = _documents(spark, sf).withColumn("encoded", codec.encode("text"))
    decoded = encoded.select("doc_id", "encoded.*", codec.decode("encoded.ids").alias("decoded"))
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op6_token_counts(spark, sf):
    counted = _documents(spark, sf).select(tokenizer(spark).count("text").alias("n_tokens"))
    return lengths.length_report(lengths.length_histogram(counted))


@query
def op5_simhash(spark, sf):
    return simhash.near_duplicates(_documents(spark, sf))


@query
def op7_secrets(spark, sf):
    found = secrets.find_secrets(_documents(spark, sf))
    spans = F.col("secrets")
    base = F.filter(spans, lambda s: s["kind"] < 3)

    def of(kind: int) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")

    return found.select("doc_id", of(0).alias("n_assign"), of(1).alias("n_access"), of(2).alias("n_hex"),
                        F.sha2(secrets.span_list(base), 256).alias("base_sha256"),
                        secrets.span_list(spans).alias("spans"))


@query
def op8_sharding(spark, sf):
    text = F.coalesce("text", F.lit(""))
    sized = _documents(spark, sf).select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"))
    return sharding.shard_rows(sized, ["doc_id", "text_crc32", "size"]).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query
def op9_licenses(spark, sf):
    found = licenses.license_scan(_documents(spark, sf))
    return found.select(
        "doc_id", *[f"license.{c}" for c in ("n_words", "n_base", "first_word", "last_word")],
        licenses.joined(F.col("license.base_labels")).alias("base_labels"),
        licenses.joined(F.col("license.labels")).alias("labels"), "license.score")


_WORDS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _licenses_sql() -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    phrases = ", ".join(f"({p.split()}, '{label}')" for p, label in licenses.PHRASES)
    templates = ", ".join(f"('{label}', list_distinct({text.split()}))"
                          for label, text in licenses.TEMPLATES)
    return f"""
    WITH texts AS (SELECT doc_id, {_WORDS.format(lower)} AS ws FROM documents),
    places AS (
        SELECT doc_id, i - 1 AS place, label
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM texts),
             (VALUES {phrases}) AS phrases(words, label)
        WHERE ws[i] = words[1] AND list_slice(ws, i, i + len(words) - 1) = words),
    base AS (
        SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
               list_sort(list_distinct(list(label))) AS found
        FROM places GROUP BY doc_id),
    blocks AS (
        SELECT doc_id, list_distinct(list_slice(ws, place + 1, place + {licenses.BLOCK})) AS block
        FROM (SELECT doc_id, ws, unnest(range(0, greatest(1, len(ws) - {licenses.STEP}),
                                              {licenses.STEP})) AS place FROM texts)),
    matches AS (
        SELECT doc_id, label, len(list_intersect(block, words)) / len(words) AS share
        FROM blocks, (VALUES {templates}) AS templates(label, words)
        WHERE len(list_intersect(block, words)) >= ceil(round({licenses.THRESHOLD} * len(words), 9))),
    best AS (SELECT doc_id, max(share) AS share, list(label) AS found FROM matches GROUP BY doc_id)
    SELECT doc_id, len(ws) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
           array_to_string(coalesce(base.found, []), ',') AS base_labels,
           array_to_string(list_sort(list_distinct(list_concat(coalesce(base.found, []),
                                                               coalesce(best.found, [])))), ',') AS labels,
           CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(share, 0.0) END::DOUBLE AS score
    FROM texts LEFT JOIN base USING (doc_id) LEFT JOIN best USING (doc_id)"""


ORACLES["op9_licenses"] = _licenses_sql()


@query
def op2_decontamination(spark, sf):
    found = decontaminate.contamination(_documents(spark, sf), _table(spark, sf, "benchmark"))
    return found.select("doc_id", "contamination.contaminated",
                        F.col("contamination.items").alias("item_ids"), "contamination.equal_words")


def _held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


@query
def op1_toxicity(spark, sf):
    docs, labels = _documents(spark, sf), _table(spark, sf, "labels").select("doc_id", "toxic")
    model = toxicity.train(docs, labels, lambda doc_id: ~_held_out(doc_id))
    scored = docs.select("doc_id", _held_out(F.col("doc_id")).alias("held_out"),
                         toxicity.score(spark, model, "text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@query
def op10_paragraph_dedup(spark, sf):
    return paragraphs.dedup_report(_documents(spark, sf))


@query
def op13_alignment(spark, sf):
    rows, _ = alignment.align(_documents(spark, sf),
                              (alignment.ByteLevel, public_tokenizers.path("byte_bpe_50k.json")),
                              (alignment.Pieces, public_tokenizers.path("piece_bpe_32k.model")))
    return rows


@query
def op12_collocations(spark, sf):
    return collocations.collocations(_table(spark, sf, "documents").select("lang", "text")) \
        .withColumnRenamed("group", "lang")


def _collocations_sql() -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang,
               unnest(string_split_regex({lower}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
    worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
    totals AS (SELECT lang, sum(len(ws)) AS n FROM worded GROUP BY lang),
    counts AS (
        SELECT lang, k AS words, phrase, count(*) AS a
        FROM (SELECT lang, k, array_to_string(list_slice(ws, i, i + k - 1), ' ') AS phrase
              FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
                    FROM worded, (VALUES (1), (2), (3), (4)) AS sizes(k)))
        GROUP BY ALL HAVING count(*) >= 30),
    phrases AS (SELECT *, string_split(phrase, ' ') AS ws FROM counts WHERE words > 1),
    cuts AS (
        SELECT p.lang, p.phrase, p.a, k, l.a AS l, r.a AS r,
               (2000000::HUGEINT * p.a) // (l.a::HUGEINT + r.a) AS score
        FROM (SELECT *, unnest(range(1, words)) AS k FROM phrases) AS p
        JOIN counts AS l ON l.lang = p.lang AND l.phrase = array_to_string(list_slice(p.ws, 1, k), ' ')
        JOIN counts AS r ON r.lang = p.lang AND r.phrase = array_to_string(list_slice(p.ws, k + 1, p.words), ' ')),
    scored AS (
        SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    inside AS (
        SELECT lang, array_to_string(list_slice(ws, i, i + size - 1), ' ') AS phrase, max(a) AS longest
        FROM (SELECT *, unnest(range(1, words - size + 2)) AS i
              FROM (SELECT *, unnest(range(2, words)) AS size FROM phrases))
        GROUP BY ALL)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
           a, l, r, n::BIGINT AS n, score::BIGINT AS score
    FROM scored LEFT JOIN inside USING (lang, phrase) JOIN totals USING (lang)
    WHERE longest IS NULL OR 100::HUGEINT * longest < 80::HUGEINT * a
    QUALIFY rank <= 2000"""


ORACLES["op12_collocations"] = _collocations_sql()


@query
def op11_minhash(spark, sf):
    return minhash.near_duplicates(_documents(spark, sf))


def _minhash_sql() -> str:
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
    WITH RECURSIVE worded AS (
        SELECT doc_id, regexp_extract_all({lower}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
    shingles AS (
        SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + 4), ' ') AS s
        FROM (SELECT doc_id, ws, unnest(range(1, greatest(1, len(ws) - 4) + 1)) AS i FROM worded
              WHERE len(ws) > 0)),
    sets AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    common AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
        FROM shingles AS a JOIN shingles AS b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
    links AS (
        SELECT a, b FROM common JOIN sets AS x ON x.doc_id = a JOIN sets AS y ON y.doc_id = b
        WHERE 100 * common >= 85 * (x.n + y.n - common)),
    ends AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reached AS (
        SELECT a AS doc_id, a AS seen FROM ends
        UNION SELECT reached.doc_id, ends.b FROM reached JOIN ends ON reached.seen = ends.a),
    least AS (SELECT doc_id, min(seen) AS component_id FROM reached GROUP BY doc_id)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id,
           coalesce(component_id, doc_id) = doc_id AS kept
    FROM documents LEFT JOIN sets USING (doc_id) LEFT JOIN least USING (doc_id)"""


ORACLES["op11_minhash"] = _minhash_sql()
