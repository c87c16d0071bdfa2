"""Joins and numbering that hold when one key owns a large share of the rows.

Both start from per-key counts, which are small after map-side aggregation, and single out the
hot keys: all with more than ``rows_per_split`` rows, however many they are. The list names keys by a
64-bit digest; a key that shares its digest with a hot one is merely spread too. There are at most
rows / ``rows_per_split`` hot keys. From ``BROADCAST_FROM`` rows per split on that is less than a
thousandth of the rows' own size, by far, and the list is broadcast; below, it is joined as a table
that AQE broadcasts if it measures small.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_SPLIT = 1_000_000
BROADCAST_FROM = 100_000
#: Quantiles of a key's order; a block holds a ``QUANTILES``-th of its key at least.
QUANTILES = 1024

_DIGEST, _SPLITS, _SALT, _COUNT, _TASK = "__digest", "__splits", "__salt", "__count", "__task"
_KEY, _MARKS, _CUTS, _BLOCK, _BASE = "__key", "__marks", "__cuts", "__block", "__base"


def _hottest(counts: DataFrame, keys: Sequence[str], count: str, rows_per_split: int,
             value: Column, into: str) -> DataFrame:
    """``value`` of the hot keys by digest.

    Of keys with one digest the first in a total order over all columns of ``counts``, so that the
    aggregate behind it is read whole here as elsewhere, and Spark computes it once.
    """
    large = counts.filter(F.col(count) > rows_per_split)
    rest = [c for c in counts.columns if c not in keys]
    ranked = large.select(F.xxhash64(*keys).alias(_DIGEST), F.struct(value.alias(into), *rest).alias("__v"))
    return (ranked.groupBy(_DIGEST).agg(F.max("__v").alias("__v"))
                  .select(_DIGEST, F.col("__v")[into].alias(into)))


def _with_hot(df: DataFrame, keys: Sequence[str], hot: DataFrame, rows_per_split: int,
              how: str = "left") -> DataFrame:
    """``df`` with the hot keys' value, null for all other keys, or only the hot keys' rows (``inner``)."""
    listed = F.broadcast(hot) if rows_per_split >= BROADCAST_FROM else hot
    return df.withColumn(_DIGEST, F.xxhash64(*keys)).join(listed, _DIGEST, how).drop(_DIGEST)


def _keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))


def spread_join(rows: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "inner",
                counts: DataFrame | None = None, count: str = _COUNT,
                rows_per_split: int | None = None) -> DataFrame:
    """Equi-join ``rows`` with ``lookup``, which has at most one row per key.

    Rows of a hot key are dealt over several salts, and its lookup row is repeated once per salt.
    The salt is a hash of the row's content plus the number of the task that reads it, so copies of
    one row are dealt too, and a task that runs again deals as before. No size is assumed for ``lookup``:
    AQE turns the join into a broadcast only when the shuffled lookup turns out small.

    When ``lookup`` is an aggregate of ``rows``, let it hold their number per key in ``count``,
    which is left out of the result. Otherwise the rows are counted, or ``counts`` gives keys and
    ``count``. What lookup and counts share is computed once, because both use all of it.
    """
    rows_per_split = rows_per_split or ROWS_PER_SPLIT
    keys = list(keys)
    if how in ("inner", "left_semi"):
        # said of every side at the start, so that plans over one input stay alike and share it
        rows, lookup = _keyed(rows, keys), _keyed(lookup, keys)
        counts = _keyed(counts, keys) if counts is not None else None
    if counts is None:
        counts = lookup if count in lookup.columns else (
            rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(count)))

    def splits_of(n: str) -> Column:
        return F.ceil(F.col(n) / F.lit(rows_per_split)).cast("int")

    hot = _hottest(counts, keys, count, rows_per_split, splits_of(count), _SPLITS)
    content = [f.name for f in rows.schema if "map<" not in f.dataType.simpleString()]
    dealt = F.pmod(F.pmod(F.xxhash64(*content), F.col(_SPLITS)) + F.col(_TASK),
                   F.col(_SPLITS)).cast("int")
    salt = F.when(F.col(_SPLITS).isNull(), F.lit(0)).otherwise(dealt)
    repeats = F.coalesce(F.col(_SPLITS), F.lit(1))
    if count in lookup.columns:
        # at least as many as needed; reading the count keeps this aggregate the one of the list
        repeats = F.greatest(repeats, splits_of(count))
    marked = rows.withColumn(_TASK, F.spark_partition_id())  # before any join moves the rows
    salted_rows = (_with_hot(marked, keys, hot, rows_per_split).withColumn(_SALT, salt)
                   .drop(_SPLITS, _TASK))
    salted_lookup = (_with_hot(lookup, keys, hot, rows_per_split)
                     .withColumn(_SALT, F.explode(F.sequence(F.lit(0), repeats - 1)))
                     .drop(_SPLITS, count))
    return salted_rows.join(salted_lookup, [*keys, _SALT], how).drop(_SALT)


def number_rows(rows: DataFrame, keys: Sequence[str], order: str, into: str = "row_no",
                at_most: int | None = None, rows_per_split: int | None = None) -> DataFrame:
    """Exact 1-based numbering per key in the order of an integral, per-key unique column.

    A hot key is cut at quantiles of its order, so its blocks are alike in size whatever the values
    are. Rows are numbered inside their block, and a block starts where the counted sizes of the
    blocks before it end. No task ever sorts more than one block.

    ``at_most`` keeps only the first rows of each key. Blocks that start beyond it are left out
    before anything is sorted.
    """
    rows_per_split = rows_per_split or ROWS_PER_SPLIT
    pos = F.col(order)
    # as one struct the key is never null, so rows without a key are a group like any other;
    # without keys it is a value computed from the data, so that the joins stay equi-joins
    key = F.struct(*keys) if keys else F.struct(F.pmod(pos, F.lit(1)))
    work = rows.withColumn(_KEY, key).drop(*keys)
    marks = F.percentile_approx(pos, F.array(*[F.lit(i / QUANTILES) for i in range(1, QUANTILES)]),
                                F.lit(10 * QUANTILES))
    # rows are only counted per key; quantiles are taken of the hot keys' rows, and where there are none,
    # the empty list lets AQE leave that branch out
    counts = work.groupBy(_KEY).agg(F.count(F.lit(1)).alias(_COUNT))
    large = _hottest(counts, [_KEY], _COUNT, rows_per_split, F.lit(1), _SPLITS)
    of_hot = _with_hot(work.select(_KEY, order), [_KEY], large, rows_per_split, "inner")
    spans = of_hot.groupBy(_KEY).agg(marks.alias(_MARKS), F.count(F.lit(1)).alias(_COUNT))
    # every so many quantiles make one block; the counts of the blocks make up for what is approximate
    blocks = F.least(F.ceil(F.col(_COUNT) / F.lit(rows_per_split)), F.lit(QUANTILES))
    step = F.greatest(F.floor(F.lit(QUANTILES) / blocks), F.lit(1))
    cuts = F.filter(_MARKS, lambda _, i: F.pmod(i + 1, step) == 0)
    hot = _hottest(spans, [_KEY], _COUNT, rows_per_split, cuts, _CUTS)

    halvings = F.array(*[F.lit(1 << i) for i in range(QUANTILES.bit_length() - 1, -1, -1)])
    # binary search: how many cuts are not beyond the value
    search = F.aggregate(halvings, F.lit(0), lambda at, by: F.when(
        F.get(_CUTS, at + by - 1) <= pos, at + by).otherwise(at))
    blocked = _with_hot(work, [_KEY], hot, rows_per_split).withColumn(
        _BLOCK, F.when(F.col(_CUTS).isNotNull(), search).otherwise(F.lit(0)))
    sizes = (blocked.filter(F.col(_CUTS).isNotNull())
                    .groupBy(_KEY, _BLOCK).agg(F.count(F.lit(1)).alias(_COUNT)))
    before = Window.partitionBy(_KEY).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    bases = (sizes.select(_KEY, _BLOCK, F.sum(_COUNT).over(before).alias(_BASE))
                  .filter(F.col(_BASE).isNotNull()))

    placed = blocked.drop(_CUTS).join(bases, [_KEY, _BLOCK], "left")
    base = F.coalesce(F.col(_BASE), F.lit(0))
    if at_most is not None:
        placed = placed.filter(base < at_most)
    inside = F.row_number().over(Window.partitionBy(_KEY, _BLOCK).orderBy(order))
    numbered = placed.withColumn(into, inside)
    if at_most is not None:
        # the first test alone lets Spark cut each block before the shuffle when at_most is small
        numbered = numbered.filter(F.col(into) <= at_most).filter(F.col(into) + base <= at_most)
    out = [F.col(f"{_KEY}.{c}").alias(c) if c in keys else F.col(c) for c in rows.columns]
    return numbered.select(*out, (F.col(into) + base).alias(into))


def _int_div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)
