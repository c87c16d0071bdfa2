"""Product identifiers and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewloom.functions.text import _col

# Fixed value: how a product URL carries shop (group 1) and item (group 2).
PRODUCT_URL_PATTERN = r"i\.(\d+)\.(\d+)"


def extract_ids(c: Column | str, pattern: str = PRODUCT_URL_PATTERN, item_group: int = 2,
                shop_group: int = 1) -> Column:
    """``struct(itemid, shopid)`` of the first match; both null when nothing matches."""
    url = _col(c)

    def group(n: int) -> Column:
        return F.nullif(F.regexp_extract(url, pattern, n), F.lit(""))

    return F.struct(group(item_group).alias("itemid"), group(shop_group).alias("shopid"))


def data_file(c: Column | str) -> Column:
    """File name with ``.csv`` added where it is missing."""
    name = _col(c)
    return F.when(name.endswith(".csv"), name).otherwise(F.concat(name, F.lit(".csv")))


def file_name(encoded: Column | str) -> Column:
    """The name of a file as it is listed, from its URL-encoded form in ``_metadata``.

    Only ``%`` starts an escape there; a plus sign stands for itself.
    """
    return F.url_decode(F.replace(_col(encoded), F.lit("+"), F.lit("%2B")))


def data_path(c: Column | str, base: str) -> Column:
    """Path of a manifest entry's file below ``base``."""
    return F.concat(F.lit(base.rstrip("/") + "/"), data_file(c))
