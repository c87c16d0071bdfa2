"""Scored reviews with a summary of their product."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.functions import review
from reviewloom.functions.rating import star_int
from reviewloom.operators.clean import STRICT, Profile, clean_reviews, profile_of
from reviewloom.operators.enrich import summarize_in_slices
from reviewloom.operators.payload import (build_prompt, collect_payload, part_number,
                                          payload_json, text_ordinal, valid_review)
from reviewloom.operators.rating import average_rating, first_products
from reviewloom.operators.skew import number_rows, spread_join
from reviewloom.session import fresh_path, land


def enrich_reviews(raw: DataFrame, fn: Callable[[str], str], scope: Sequence[str] = (),
                   profile: Profile | str = STRICT, products: str = "first",
                   request: str = "payload", template: str = review.PROMPT_TEMPLATE,
                   order_by: str | None = None, scopes: DataFrame | None = None,
                   part_size: int = review.MAX_COMMENTS, rows_per_split: int | None = None,
                   answers: str | None = None, **call_options) -> DataFrame:
    """``scope, name, rating, comments, summary, error, attempts`` for every kept review.

    ``products="first"`` summarises the smallest product name of each scope and leaves the others
    null, ``"all"`` summarises every product. ``fn`` gets each payload as JSON. With
    ``request="prompt"`` it gets a prompt over the useful comments, and payloads that are no valid
    review are not asked about. ``call_options`` go to ``summarize``.

    ``scopes`` restricts the job to the scopes it holds, one row each, and its further columns are
    added to the result. It meets the products, not the reviews, so the raw rows stay in place.

    A product larger than ``part_size`` is summarised part by part, then over the summaries of its
    parts, and so on until one is left, so every row of a product has the same summary. ``error`` is
    the product's first failure, which may leave the summary null, and ``attempts`` the most that one
    of its calls took. ``answers`` names a folder for the answers of the text function, from which a
    job that died can go on; see ``answers_in_slices``.

    What several later steps read is landed in the shared folder: the cleaned rows, then the numbered
    ones, and the summaries.
    """
    if products not in ("first", "all"):
        raise ValueError(f"products must be 'first' or 'all', not {products!r}")
    if request not in ("payload", "prompt"):
        raise ValueError(f"request must be 'payload' or 'prompt', not {request!r}")
    keys = [*scope, "name"]
    needed = dict.fromkeys([*keys, "rating_star", "comment", *([order_by] if order_by else [])])
    rules, order = profile_of(profile), order_by or "__ordinal"
    cleaned = clean_reviews(raw.select(*needed), rules, scope, [order_by] if order_by else [])
    if order_by is None:
        # ids of rows that may be copies are fixed by landing them
        cleaned = cleaned.withColumn(order, text_ordinal("comments") if rules.dedup
                                     else F.monotonically_increasing_id())
    cleaned = land(cleaned, "cleaned")

    lookup = average_rating(cleaned, scope, count_into="__n")
    if products == "first":
        first = first_products(lookup.select(*keys), scope).withColumn("__chosen", F.lit(True))
        lookup = lookup.join(first, keys, "left")
    else:
        lookup = lookup.withColumn("__chosen", F.lit(True))
    carried = []
    if scopes is not None:
        carried = [c for c in scopes.columns if c not in scope]
        lookup = spread_join(lookup, scopes, scope, rows_per_split=rows_per_split)

    numbered = number_rows(cleaned, keys, order, "__row_no", rows_per_split=rows_per_split)
    scored = spread_join(numbered, lookup, keys, count="__n", rows_per_split=rows_per_split)
    parts = land(scored.withColumn("part", part_number("__row_no", part_size)), "parts")
    payloads = collect_payload(parts.filter(F.col("__chosen")), keys, "__row_no",
                               F.col("comments"), star_int("rating"))
    def ask(payloads: DataFrame, first: bool) -> DataFrame:
        """Summaries of payloads, with the stars of what they sum up."""
        if request == "prompt":
            useful = payloads
            if first:
                accepted = valid_review(payloads).filter("is_valid")
                useful = accepted.withColumn("comments", review.filter_comment_array("comments"))
            requests = build_prompt(useful, template, into="request")
        else:
            requests = payload_json(payloads, into="request")
        requests = land(requests.select(*part_keys, F.get("comments", F.lit(0))["rating"].alias("stars"),
                                        "request"), "requests")
        made = summarize_in_slices(requests, fn, "request", part_keys,
                                   answers or fresh_path(raw.sparkSession, "answers"), **call_options)
        return land(made.join(requests.select(*part_keys, "stars"), part_keys), "summaries")

    part_keys = [*scope, "product_name", "part"]
    product_keys = part_keys[:-1]
    level = ask(payloads, True)
    calls = [level]
    while not level.filter(F.col("part") > 0).isEmpty():
        # products in one part are done; of the others, the parts' summaries are the comments now
        several = level.groupBy(*product_keys).agg(F.max("part").alias("__last")).filter("__last > 0")
        texts = level.filter(F.col("summary").isNotNull()).join(several, product_keys)
        renamed = texts.withColumnRenamed("product_name", "name").withColumn(
            "__row_no", F.col("part") + 1).withColumn("part", part_number("__row_no", max(2, part_size)))
        level = ask(collect_payload(renamed, keys, "__row_no", F.col("summary"), F.col("stars")), False)
        calls.append(level)
    # the last call about a product has the summary; a failure on the way stays visible
    every = reduce(DataFrame.unionByName, [c.withColumn("__level", F.lit(i)) for i, c in enumerate(calls)])
    whole = F.when(F.col("part") == 0, F.struct("__level", "summary"))
    lone = F.count_if(F.col("part") > 0)
    found = every.groupBy(*product_keys).agg(
        F.max(whole).alias("__best"), F.max("__level").alias("__top"), F.min("error").alias("error"),
        F.max("attempts").alias("attempts"), lone.alias("__parts"))
    combined = (F.col("__best.__level") == F.col("__top")) & (
        (F.col("__top") > 0) | (F.col("__parts") == 0))
    found = land(found.select(*scope, F.col("product_name").alias("name"),
                              F.when(combined, F.col("__best.summary")).alias("summary"),
                              "error", "attempts"), "products")
    return (spread_join(parts.drop("part"), found, keys, "left", rows_per_split=rows_per_split)
            .select(*keys, "rating", "comments", "summary", "error", "attempts", *carried))
