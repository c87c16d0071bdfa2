"""Raw reviews to scored reviews: clean, drop copies, add the product's average."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.operators.clean import RELAXED, STRICT, Profile, clean_reviews
from reviewloom.operators.rating import with_product_rating


def score_reviews(raw: DataFrame, scope: Sequence[str] = (), profile: Profile | str = STRICT,
                  order_by: Sequence[str] = (), carry: Sequence[str] = ()) -> DataFrame:
    """``scope, name, rating, comments`` for every kept review.

    ``order_by`` decides which of several copies survives, ``carry`` names further input columns
    to keep. Everything else is pruned before the shuffle.
    """
    needed = dict.fromkeys([*scope, "name", "rating_star", "comment", *order_by, *carry])
    cleaned = clean_reviews(raw.select(*needed), profile, scope, order_by)
    scored = with_product_rating(cleaned, scope)
    return scored.select(*scope, "name", "rating", "comments", *carry)


def score_late_reviews(raw: DataFrame, scope: Sequence[str] = (),
                       profile: Profile | str = RELAXED) -> DataFrame:
    """The same for files that arrive late, under the column names of their own output."""
    scored = score_reviews(raw, scope, profile)
    return scored.select(*scope, "name", F.col("rating").alias("average_rating"),
                         F.col("comments").alias("cleaned_comment"))
