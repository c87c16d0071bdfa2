"""Columns of tables whose names are not known beforehand."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def column(name: str) -> Column:
    """The column of exactly this name, dots and backquotes included."""
    return F.col("`" + name.replace("`", "``") + "`")


def columns(df: DataFrame, but: tuple[str, ...] = ()) -> list[Column]:
    return [column(c) for c in df.columns if c not in but]


def free_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
