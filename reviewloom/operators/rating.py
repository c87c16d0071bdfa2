"""Average ratings per product."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.operators.skew import spread_join


def average_rating(df: DataFrame, scope: Sequence[str] = (), rating: str = "rating_star",
                   into: str = "rating", count_into: str | None = None) -> DataFrame:
    """Average rating per product, one row per scope and name; null ratings do not count."""
    aggs = [F.avg(rating).alias(into)]
    if count_into is not None:
        aggs.append(F.count(F.lit(1)).alias(count_into))
    return df.groupBy(*scope, "name").agg(*aggs)


def with_product_rating(df: DataFrame, scope: Sequence[str] = (), rating: str = "rating_star",
                        into: str = "rating", rows_per_split: int | None = None) -> DataFrame:
    """Every row with its product's average rating."""
    keys = [*scope, "name"]
    products = average_rating(df, scope, rating, into, count_into="__n")
    return spread_join(df, products, keys, count="__n", rows_per_split=rows_per_split)


def first_products(products: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """The row of the smallest product name of each scope; an empty input gives no row."""
    rest = [c for c in products.columns if c not in scope and c != "name"]
    named = products.filter(F.col("name").isNotNull())
    first = named.groupBy(*scope).agg(F.min(F.struct("name", *rest)).alias("first"))
    # over no rows at all, an aggregate without scope still gives one
    return first.select(*scope, "first.*").filter(F.col("name").isNotNull())


def only_first_product(df: DataFrame, scope: Sequence[str] = (),
                       rows_per_split: int | None = None) -> DataFrame:
    """The rows of the first product of each scope."""
    keys = [*scope, "name"]
    products = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return spread_join(df, first_products(products, scope), keys, "left_semi", counts=products,
                       count="__n", rows_per_split=rows_per_split)
