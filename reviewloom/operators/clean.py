"""Cleaning and deduplication of raw reviews."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.rating import parse_rating
from reviewloom.functions.text import (clean_text, cleans_to_max_chars, cleans_to_min_words,
                                       cleans_to_short_tokens, cleans_to_text)

REQUIRED = ("comment", "rating_star", "name")


@dataclass(frozen=True)
class Profile:
    """Which cleaned comments are kept."""

    max_token_len: int = 6
    min_words: int = 1
    max_chars: int | None = None
    dedup: bool = False

    def accepts(self, raw: Column | str) -> Column:
        """The rules on the cleaned text, asked of the raw text.

        Catalyst moves filters below the cleaning projection by copying the cleaning expression
        into every one of them. Asking the raw text instead cleans only the rows that stay.
        """
        rules = [cleans_to_short_tokens(raw, self.max_token_len)]
        rules.append(cleans_to_min_words(raw, self.min_words) if self.min_words > 1
                     else cleans_to_text(raw))
        if self.max_chars is not None:
            rules.append(cleans_to_max_chars(raw, self.max_chars))
        return reduce(lambda a, b: a & b, rules)


# The main path's limits, and the looser ones for files that arrive late.
STRICT = Profile(max_token_len=6, min_words=10, max_chars=3000, dedup=True)
RELAXED = Profile(max_token_len=6)
PROFILES = {"strict": STRICT, "relaxed": RELAXED}


def profile_of(profile: Profile | str) -> Profile:
    return PROFILES[profile] if isinstance(profile, str) else profile


def require_columns(df: DataFrame, cols: Sequence[str] = REQUIRED) -> DataFrame:
    """Rows in which every given column is set (plain null tests, which reach the scan)."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))


def dedup_comments(df: DataFrame, scope: Sequence[str] = (), order_by: Sequence[str] = (),
                   text: str = "comments") -> DataFrame:
    """One row per distinct text within a scope, across products.

    The survivor is the smallest row by ``order_by``, then by its remaining columns, so the answer
    does not depend on partitioning. As an aggregate it drops copies before the shuffle; a window
    would send every copy of a popular text to one task.
    """
    keys = [*scope, text]
    rest = [*order_by, *(c for c in df.columns if c not in keys and c not in order_by)]
    if not rest:
        return df.select(*keys).distinct()
    best = F.min(F.struct(*[c for c in rest if c not in keys])).alias("__best")
    return df.groupBy(*keys).agg(best).select(*keys, "__best.*").select(*df.columns)


def clean_reviews(df: DataFrame, profile: Profile | str = STRICT, scope: Sequence[str] = (),
                  order_by: Sequence[str] = ()) -> DataFrame:
    """Raw reviews to clean ones: ``rating_star`` as double and the cleaned text as ``comments``.

    A rating that is no number stays as null and later averages ignore it. All columns of the
    input are kept but ``comment``, whose cleaned form replaces it.
    """
    rules = profile_of(profile)
    kept = require_columns(df).filter(rules.accepts("comment"))
    cleaned = (kept.withColumn("rating_star", parse_rating("rating_star"))
                   .withColumn("comments", clean_text("comment"))
                   .drop("comment"))
    return dedup_comments(cleaned, scope, order_by) if rules.dedup else cleaned
