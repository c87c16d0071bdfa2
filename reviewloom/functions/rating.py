"""Rating values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewloom.functions.text import _col


def parse_rating(c: Column | str) -> Column:
    """Rating as double; text that is no number becomes null, also under ANSI mode."""
    return _col(c).try_cast("double")


def star_int(c: Column | str) -> Column:
    """Average as whole stars, cut off rather than rounded (4.9 gives 4); null when it is infinite."""
    return _col(c).try_cast("int")
