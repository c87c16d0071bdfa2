"""A uniform shuffle into shards of exact sizes.

Rows are dealt to parts by hash. How many rows of each part go to each block of each shard is drawn at
once, as a matrix with exact row and column sums (a multivariate hypergeometric draw, as if all rows had
been shuffled together). Each part then puts its rows in random order and deals them out by its row of
the matrix; after the exchange each block puts what it has received in random order again. The result
is a uniform permutation, and no task ever holds more than a part or a block.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.llm.columns import column

#: Rows of a part and of a block; there are ``MAX_BLOCKS`` of each at most, so that the matrix
#: stays below a million numbers. Beyond that the parts grow.
ROWS_PER_BLOCK = 100_000
MAX_BLOCKS = 1024


def draw_hypergeometric(rng: random.Random, good: int, bad: int, sample: int) -> int:
    """How many of ``sample`` items drawn without return are good. Inversion from the mode outwards
    for narrow distributions, else ratio of uniforms; both only need the density's logarithm."""
    low, high = max(0, sample - bad), min(sample, good)
    if low == high:
        return low
    total = good + bad

    def log_density(k: int) -> float:
        return -(math.lgamma(k + 1) + math.lgamma(good - k + 1) + math.lgamma(sample - k + 1)
                 + math.lgamma(bad - sample + k + 1))

    mode = min(high, max(low, (sample + 1) * (good + 1) // (total + 2)))
    top = log_density(mode)
    share = good / total
    variance = sample * share * (1 - share) * (total - sample) / max(1, total - 1)
    if variance < 25:
        near = [k for k in range(max(low, mode - 60), min(high, mode + 60) + 1)]
        weight = [math.exp(log_density(k) - top) for k in near]
        return rng.choices(near, weight)[0]
    # ratio of uniforms around the mean, for a log-concave density: the region fits in this box
    mean = sample * share
    spread = math.sqrt(2 * (variance + 0.5) / math.e) * 1.0 + math.sqrt(3 / math.e) * 0.5 + 1.0
    while True:
        u, v = rng.random(), rng.uniform(-spread, spread)
        if u == 0:
            continue
        k = math.floor(mean + 0.5 + v / u)
        if low <= k <= high and 2 * math.log(u) <= log_density(k) - top:
            return k


def communication_matrix(rows: list[int], columns: list[int], seed: int) -> list[list[int]]:
    """Counts with these row and column sums, as a random shuffle of everything would give them."""
    rng = random.Random(seed)
    left = list(columns)
    matrix = []
    for size in rows:
        drawn, pool = [], sum(left)
        for j, here in enumerate(left):
            pool -= here
            k = draw_hypergeometric(rng, here, pool, size)
            drawn.append(k)
            size -= k
            left[j] -= k
        matrix.append(drawn)
    return matrix


def _even(total: int, parts: int) -> list[int]:
    return [total // parts + (i < total % parts) for i in range(parts)]


def shard_rows(docs: DataFrame, by: list[str], shards: int = 16, seed: int = 0,
               rows_per_block: int = ROWS_PER_BLOCK, shard: str = "shard",
               slot: str = "slot") -> DataFrame:
    """``docs`` with ``shard`` and ``slot``: a uniform shuffle into shards whose sizes differ by one at most.

    ``slot`` numbers the rows of a shard from 0 without gaps. ``by`` names the columns that tell rows
    apart; rows equal in all of them are interchangeable, so a lost task's rows may be dealt again.
    Nulls are values like others. Existing columns of the two names are replaced; an empty table
    stays empty. Only the sizes of the parts reach the driver, ``MAX_BLOCKS`` numbers at most.
    """
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c not in (shard, slot)]
    keys = [column(c) for c in by]
    rows = docs.count()
    parts = min(MAX_BLOCKS, max(1, math.ceil(rows / rows_per_block)))
    per_shard = max(1, math.ceil(parts / shards))  # blocks of a shard

    def mixed(salt: str) -> Column:
        return F.xxhash64(*keys, F.lit(f"{salt}-{seed}"))

    placed = docs.select(F.struct(*[column(c) for c in kept]).alias("row"),
                         F.pmod(mixed("part"), F.lit(parts)).cast("int").alias("part"),
                         mixed("deal").alias("deal"), mixed("slot").alias("turn"))
    held = {r["part"]: r["count"] for r in placed.groupBy("part").count().collect()}
    blocks = [size for n in _even(sum(held.values()), shards) for size in _even(n, per_shard)]
    order = sorted(held)
    matrix = communication_matrix([held[p] for p in order], blocks, seed)
    begins = [sum(blocks[b // per_shard * per_shard:b]) for b in range(len(blocks))]
    bounds = []
    for p, drawn in zip(order, matrix):
        at = 0
        for b, n in enumerate(drawn):
            if n:
                bounds.append((p, at, at + n, b))
            at += n
    # where each part's rows go: the matrix itself, below a million rows by construction
    plan = spark.createDataFrame(bounds, "part int, low long, high long, block int")
    per_part = plan.groupBy("part").agg(
        F.array_sort(F.collect_list(F.struct("low", "high", "block"))).alias("cuts"))
    mine = Window.partitionBy("part").orderBy("deal", "turn")
    dealt = placed.withColumn("place", F.row_number().over(mine) - 1).join(per_part, "part")
    to = F.filter("cuts", lambda c: (c["low"] <= F.col("place")) & (F.col("place") < c["high"]))
    blocked = dealt.select("row", "turn", "deal", F.element_at(to, 1)["block"].alias("block"))
    block = Window.partitionBy("block").orderBy("turn", "deal")
    begin = F.element_at(F.array(*map(F.lit, begins)), F.col("block") + 1)
    return blocked.withColumn("nth", F.row_number().over(block) - 1).select(
        "row.*", F.floor(F.col("block") / per_shard).cast("int").alias(shard),
        (begin + F.col("nth")).cast("long").alias(slot))
