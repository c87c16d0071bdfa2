"""Exact token counts for every context limit, from one histogram of encoded lengths.

Documents are counted by their length in tokens; everything else follows from the histogram. With
``n(l)`` documents of length ``l``, the sums over ``l > limit`` and ``l <= limit`` answer how many
documents a limit cuts, how many tokens stay, and which share of documents or tokens lies below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.llm.columns import column

#: Lengths per block of the running sums: no task holds more of the histogram, and the sums of the
#: blocks are one row per this many lengths.
BLOCK = 1024


def length_histogram(lengths: DataFrame, length: str = "n_tokens") -> DataFrame:
    """``length, n_docs``: one row per length that occurs; null lengths are not counted."""
    return (lengths.select(column(length).cast("bigint").alias("length"))
            .filter(F.col("length").isNotNull())
            .groupBy("length").agg(F.count(F.lit(1)).alias("n_docs")))


def length_report(histogram: DataFrame, block: int = BLOCK) -> DataFrame:
    """What each length means as a context limit; empty for an empty histogram.

    Per ``length``: ``n_docs`` of exactly it; ``docs_longer`` and ``tokens_longer`` of the documents it
    cuts; ``tokens_kept`` if every document is cut to it; ``docs_up_to``, ``tokens_up_to`` of the
    documents it leaves whole; ``total_docs``, ``total_tokens``. A limit between two lengths answers
    like the smaller one, plus ``docs_longer`` tokens for each step above it (``tokens_kept_at``).
    """
    blocks = (histogram.groupBy(F.floor(F.col("length") / block).alias("block"))
              .agg(F.collect_list(F.struct("length", "n_docs")).alias("lengths"),  # `block` at most
                   F.sum("n_docs").alias("docs"),
                   F.sum(F.col("length") * F.col("n_docs")).alias("tokens")))
    # one row per block of lengths, a thousandth of the longest length at most
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("block").rowsBetween(Window.unboundedPreceding,
                                                     Window.unboundedFollowing)
    rows = blocks.select(
        "block", "lengths",
        F.coalesce(F.sum("docs").over(before), F.lit(0)).alias("docs_before"),
        F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("tokens_before"),
        F.sum("docs").over(everything).alias("total_docs"),
        F.sum("tokens").over(everything).alias("total_tokens"))
    inside = Window.partitionBy("block").orderBy("length")
    summed = rows.select("*", F.inline("lengths")).withColumns({
        "docs_up_to": F.col("docs_before") + F.sum("n_docs").over(inside),
        "tokens_up_to": F.col("tokens_before") + F.sum(F.col("length") * F.col("n_docs")).over(inside)})
    longer = F.col("total_docs") - F.col("docs_up_to")
    return summed.select(
        "length", "n_docs", "docs_up_to", "tokens_up_to", longer.alias("docs_longer"),
        (F.col("total_tokens") - F.col("tokens_up_to")).alias("tokens_longer"),
        (F.col("tokens_up_to") + longer * F.col("length")).alias("tokens_kept"),
        "total_docs", "total_tokens")


def answer_limits(report: DataFrame, limits: DataFrame, limit: str = "limit") -> DataFrame:
    """``limits`` with ``docs_cut`` and ``tokens_kept`` for each context limit; there are few limits.

    A limit below every length cuts all documents; null limits and empty reports answer null.
    """
    few = limits.select(column(limit).cast("bigint").alias("limit")).distinct()
    nearest = report.join(F.broadcast(few), F.col("length") <= F.col("limit")).groupBy("limit").agg(
        F.max(F.struct("length", "docs_longer", "tokens_kept")).alias("at"))
    total = report.agg(F.max("total_docs").alias("all_docs"))
    joined = limits.join(nearest.withColumnRenamed("limit", "_limit"),
                         column(limit).cast("bigint") == F.col("_limit"), "left")
    docs = F.when(column(limit).isNotNull(), F.coalesce("at.docs_longer", "all_docs"))
    step = column(limit) - F.coalesce("at.length", F.lit(0))
    kept = F.coalesce("at.tokens_kept", F.lit(0)) + docs * F.greatest(step, F.lit(0))
    return joined.join(F.broadcast(total)).select(
        *[column(c) for c in limits.columns], docs.alias("docs_cut"), kept.alias("tokens_kept"))


def quantile(report: DataFrame, share: float, of: str = "docs") -> Column:
    """Aggregate over a report: the smallest length with ``share`` of the ``docs`` or ``tokens`` up to it."""
    return F.min(F.when(F.col(f"{of}_up_to") >= share * F.col(f"total_{of}"), F.col("length")))
