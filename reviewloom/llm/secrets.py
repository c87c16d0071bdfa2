"""Secrets in texts: patterns that stand alone, and weak parts that count only beside their complement.

Everything is built from Spark's own functions. Spans are counted in code points, with the end exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.columns import column, columns, free_name
from reviewloom.session import land

# Fixed values of the base patterns. A match that is too short is dropped after matching; where that
# cannot change the other matches, the length stands in the pattern.
ASSIGN = (r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)"""
          r"([A-Za-z0-9+/_.=-]+)")
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"

# Weak parts: identifiers by their label, opaque values by their look, endpoints by their scheme.
IDENTIFIER = (r"""(?i:(?:client|account|access|user|login)[_-]?(?:id|key|name)?["']?\x20*[:=]\x20*["']?)"""
              r"[A-Za-z0-9@._-]{4,}")
OPAQUE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}"
ENDPOINT = r"(?i:https?|jdbc:[a-z]+|amqps?|mongodb|postgres|redis|s3)://[A-Za-z0-9._:/@-]{4,}"
#: Parts belong together within so many code points.
SCOPE = 200

KINDS = ("assign", "access", "hex", "identifier", "opaque", "endpoint")
_SPAN = "struct<kind:int,start:int,stop:int>"
_EMPTY = f"array<{_SPAN}>"


def _spans(text: Column, kind: str, pattern: str, keep=None) -> Column:
    """All matches of ``pattern`` that ``keep`` accepts, as spans; found by what lies between them."""
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    paired = F.arrays_zip(F.slice(between, 1, F.size(found)).alias("gap"), found.alias("match"))

    def add(held: Column, pair: Column) -> Column:
        start = held["at"] + F.length(pair["gap"])
        stop = start + F.length(pair["match"])
        span = F.struct(F.lit(KINDS.index(kind)).alias("kind"), start.alias("start"), stop.alias("stop"))
        kept = F.concat(held["spans"], F.array(span))
        if keep is not None:
            kept = F.when(keep(pair["match"]), kept).otherwise(held["spans"])
        return F.struct(stop.alias("at"), kept.alias("spans"))

    empty = F.array().cast(_EMPTY)
    walked = F.aggregate(paired, F.struct(F.lit(0).alias("at"), empty.alias("spans")), add,
                         lambda held: held["spans"])
    return F.when(text.rlike(pattern), walked).otherwise(empty)


def base_spans(text: Column) -> Column:
    """Spans of the three base kinds, one kind after the other."""
    return F.concat(
        _spans(text, "assign", ASSIGN,
               lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= ASSIGN_LEAST),
        F.when(F.contains(text, F.lit("AKIA")), _spans(text, "access", ACCESS)).otherwise(
            F.array().cast(_EMPTY)),
        _spans(text, "hex", HEX))


def weak_spans(text: Column) -> Column:
    """Spans that mean nothing on their own; opaque values mix digits, upper and lower case."""
    return F.concat(
        _spans(text, "identifier", IDENTIFIER),
        _spans(text, "opaque", OPAQUE,
               lambda m: m.rlike("[0-9]") & m.rlike("[A-Z]") & m.rlike("[a-z]")),
        _spans(text, "endpoint", ENDPOINT))


def _kind(*names: str) -> list[int]:
    return [KINDS.index(n) for n in names]


def link_parts(parts: DataFrame, key: list[str], scope: int = SCOPE) -> DataFrame:
    """The weak parts with a complement within ``scope`` code points, once each.

    ``parts``: ``key``, ``kind``, ``start``, ``stop``. An identifier needs a secret, an opaque value an
    identifier, an endpoint a base secret or access key. Weak parts that touch a base span are
    left out. An interval join: a part reaches ``scope`` beyond its ends; both sides are cut along a
    grid of that width and meet in equal cells. Spans of a kind do not overlap, so a cell
    holds few of them, whatever the text.
    """
    weak_kinds = _kind("identifier", "opaque", "endpoint")
    complements = F.when(F.col("kind") == KINDS.index("identifier"),
                         F.array(*map(F.lit, _kind("assign", "hex", "opaque")))) \
        .when(F.col("kind") == KINDS.index("opaque"), F.array(*map(F.lit, _kind("access", "identifier")))) \
        .otherwise(F.array(*map(F.lit, _kind("assign", "access", "hex"))))

    def cells(start: Column, stop: Column) -> Column:
        return F.explode(F.sequence(F.floor(start / scope), F.floor((stop - 1) / scope)))

    weak = parts.filter(F.col("kind").isin(weak_kinds)).distinct().select(
        *key, "kind", "start", "stop", complements.alias("needs"),
        cells(F.col("start"), F.col("stop")).alias("cell"))
    reach = parts.select(*[F.col(k).alias(f"r_{k}") for k in key], F.col("kind").alias("r_kind"),
                         F.col("start").alias("r_start"), F.col("stop").alias("r_stop"))
    near = reach.withColumn("r_cell", cells(F.col("r_start") - scope, F.col("r_stop") + scope))
    same = [F.col(k) == F.col(f"r_{k}") for k in key] + [F.col("cell") == F.col("r_cell")]
    linked = weak.join(near, [*same, F.array_contains("needs", F.col("r_kind")),
                              F.col("start") < F.col("r_stop") + scope,
                              F.col("r_start") - scope < F.col("stop")], "left_semi")
    base = near.filter(~F.col("r_kind").isin(weak_kinds))
    apart = linked.join(base, [*same, F.col("start") < F.col("r_stop"),
                               F.col("r_start") < F.col("stop")], "left_anti")
    # a part in several cells may meet its complement in one and a base span in another
    touched = linked.join(base, [*same, F.col("start") < F.col("r_stop"),
                                 F.col("r_start") < F.col("stop")], "left_semi")
    columns = [*key, "kind", "start", "stop"]
    return apart.select(columns).distinct().join(touched.select(columns), columns, "left_anti")


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", scope: int = SCOPE,
                 into: str = "secrets") -> DataFrame:
    """``docs`` with ``into``: an array of ``struct(kind, start, stop)`` in order of start, then kind.

    ``kind`` is the place in ``KINDS``. One row per input row; null and empty texts have no span;
    repeated rows have equal spans; an existing column of that name is replaced. Rows are told apart
    by two hashes of id and text together. Only spans leave the tasks that read the texts, and only
    of texts with weak parts; what was linked is landed, so its size decides how it is joined back.
    """
    words = F.coalesce(column(text), F.lit(""))
    number = column(doc_id)
    keyed = docs.select(F.xxhash64(number, words).alias("key_a"), F.xxhash64(words, number).alias("key_b"),
                        words.alias("words")).filter(
        F.col("words").rlike(OPAQUE) | F.col("words").rlike(IDENTIFIER) | F.col("words").rlike(ENDPOINT))
    parts = keyed.select("key_a", "key_b", F.inline(F.concat(
        base_spans(F.col("words")), weak_spans(F.col("words")))))
    linked = land(link_parts(land(parts, "parts"), ["key_a", "key_b"], scope), "linked")
    per_row = linked.groupBy("key_a", "key_b").agg(
        F.collect_set(F.struct("kind", "start", "stop")).alias("linked_spans"))
    rows = docs.select(F.struct(*columns(docs, (into,))).alias("row"),
                       F.xxhash64(number, words).alias("key_a"), F.xxhash64(words, number).alias("key_b"),
                       base_spans(words).alias("base"))
    spans = F.concat("base", F.coalesce("linked_spans", F.array().cast(_EMPTY)))
    ordered = F.transform(
        F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["stop"]))),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")))
    return rows.join(per_row, ["key_a", "key_b"], "left").select("row.*", ordered.alias(into))


def span_list(spans: Column) -> Column:
    """``kind:start:stop`` of each span, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"], s["stop"])), ",")


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", scope: int = SCOPE,
           mask: str = "[secret]") -> DataFrame:
    """``docs`` with every span in ``text`` replaced by ``mask``; spans that overlap share one mask."""
    into = free_name(docs, "spans")
    found = find_secrets(docs, doc_id, text, scope, into)
    words = column(text)

    def cut(held: Column, span: Column) -> Column:
        gap = F.substring(words, held["at"] + 1, span["start"] - held["at"])
        fresh = F.struct(F.concat(held["out"], gap, F.lit(mask)).alias("out"), span["stop"].alias("at"))
        longer = F.struct(held["out"].alias("out"), F.greatest(held["at"], span["stop"]).alias("at"))
        return F.when(span["start"] >= held["at"], fresh).otherwise(longer)

    clean = F.aggregate(column(into), F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), cut,
                        lambda held: F.concat(held["out"], F.substring(
                            words, held["at"] + 1, F.length(words))))
    return found.withColumn(text, F.when(F.size(column(into)) > 0, clean).otherwise(words)) \
        .select(*columns(docs))
