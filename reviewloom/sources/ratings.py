"""Landed rating pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.functions.text import flatten_lines

PAGE = ("data struct<ratings: array<struct<itemid: bigint, shopid: bigint, userid: bigint, "
        "rating_star: string, comment: string, product_items: array<struct<name: string>>>>>")


def flatten_rating_pages(df: DataFrame, json_col: str, wide: bool = False) -> DataFrame:
    """One row per rating of each page, with the page's other columns and ``page_row`` from 0.

    The narrow form is what lands as raw reviews: an absent comment or product name is ``''`` and
    line breaks in comments are blanks. The wide form adds the ids and leaves values as they are.
    A page that is no JSON, or has no ratings, gives no rows.
    """
    page = F.from_json(F.col(json_col), PAGE, {"mode": "PERMISSIVE"})
    carried = [c for c in df.columns if c != json_col]
    r = df.select(*carried, F.posexplode(page["data"]["ratings"]).alias("page_row", "r"))
    name = F.get(F.col("r.product_items"), F.lit(0))["name"]
    star = F.col("r.rating_star").try_cast("int").alias("rating_star")  # as a number or in quotes
    if wide:
        return r.select(*carried, "page_row", "r.itemid", name.alias("name"), "r.shopid",
                        "r.userid", star, "r.comment")
    comment = flatten_lines(F.coalesce("r.comment", F.lit("")))
    return r.select(*carried, "page_row", star, comment.alias("comment"),
                    F.coalesce(name, F.lit("")).alias("name"))


def page_size(json_col: str) -> Column:
    """How many ratings a page holds; 0 for a page that is no JSON or has none."""
    ratings = F.from_json(F.col(json_col), PAGE, {"mode": "PERMISSIVE"})["data"]["ratings"]
    return F.when(ratings.isNull(), F.lit(0)).otherwise(F.size(ratings)).cast("bigint")


def landed_reviews(pages: DataFrame, json_col: str) -> DataFrame:
    """Reviews as they land, all as text, with the other columns of their page and ``page_row``."""
    carried = [c for c in pages.columns if c != json_col]
    return flatten_rating_pages(pages, json_col).select(
        *carried, "page_row", F.col("rating_star").cast("string").alias("rating_star"), "comment", "name")
