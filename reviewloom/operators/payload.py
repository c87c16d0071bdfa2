"""Nested per-product payloads, their validation, and prompts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.functions import review
from reviewloom.functions.rating import star_int
from reviewloom.functions.spam import SPAM_KEYWORDS
from reviewloom.operators.skew import _int_div, number_rows


def text_ordinal(text: Column | str) -> Column:
    """A non-negative number from the text: a stable order for deduplicated rows that carry no
    position. Copies of a text would share a number, so it does not suit rows that still have them.
    """
    return F.shiftrightunsigned(F.xxhash64(text), 1)


def part_number(row_no: str, part_size: int) -> Column:
    return _int_div(F.col(row_no) - 1, F.lit(part_size)).cast("int")


def collect_payload(numbered: DataFrame, keys: Sequence[str], row_no: str,
                    text: Column, rating: Column) -> DataFrame:
    """Arrays of ``(text, rating)`` in row order from rows that already carry their part."""
    entry = F.struct(F.col(row_no).alias("row_no"), text.alias("text"), rating.alias("rating"))
    ordered = F.sort_array(F.collect_list(entry))
    bare = F.transform(ordered, lambda x: F.struct(x["text"].alias("text"),
                                                   x["rating"].alias("rating")))
    return (numbered.groupBy(*keys, "part").agg(bare.alias("comments"))
                    .withColumnRenamed("name", "product_name"))


def product_payload(df: DataFrame, order_by: str, scope: Sequence[str] = (),
                    rating: Column | None = None, part_size: int = review.MAX_COMMENTS,
                    max_comments: int | None = None,
                    rows_per_split: int | None = None) -> DataFrame:
    """One product's comments as an array of ``(text, rating)``.

    A payload never holds more than ``part_size`` comments, the most a valid review may have: a
    larger product continues in parts 1, 2, ... so that no comment is lost and no row grows with
    the data. Products up to that size are the single part 0. ``max_comments`` asks for only the
    first comments of each product.

    ``order_by`` is an integral column, unique within a product; ``text_ordinal`` gives one for
    deduplicated rows. ``rating`` defaults to the product's average in whole stars; pass
    ``star_int("rating_star")`` for each comment's own. The keys and the order of ``df`` are read
    three times, so land it first when it is costly to compute.
    """
    keys = [*scope, "name"]
    rating = star_int("rating") if rating is None else rating
    rows = df.select(*keys, order_by, F.col("comments").alias("__text"), rating.alias("__stars"))
    numbered = number_rows(rows, keys, order_by, "__row_no", max_comments, rows_per_split)
    parts = numbered.withColumn("part", part_number("__row_no", part_size))
    return collect_payload(parts, keys, "__row_no", F.col("__text"), F.col("__stars"))


def payload_json(df: DataFrame, into: str = "payload") -> DataFrame:
    """Adds the payload as JSON text; null fields are left out."""
    return df.withColumn(into, F.to_json(F.struct("product_name", "comments")))


def valid_review(df: DataFrame) -> DataFrame:
    """Adds ``is_valid`` and ``reject_reason`` to rows of ``product_name, comments``."""
    reason = review.reject_reason("product_name", "comments")
    return df.withColumn("reject_reason", reason).withColumn(
        "is_valid", F.col("reject_reason").isNull())


def keep_valid_comments(df: DataFrame, text: str = "comment", rating: str = "rating_star",
                        keywords: Sequence[str] = SPAM_KEYWORDS) -> DataFrame:
    """Rows whose raw comment is valid, has at least four words and is no spam."""
    return df.filter(review.useful_comment(text, rating, keywords))


def build_prompt(df: DataFrame, template: str = review.PROMPT_TEMPLATE,
                 into: str = "prompt") -> DataFrame:
    """Adds the prompt for each row of ``product_name, comments``."""
    return df.withColumn(into, review.prompt_text("product_name", "comments", template))
