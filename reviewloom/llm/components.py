"""Connected components of a graph given by its links."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.session import land


def _least(node: Column) -> Column:
    """Orders nodes at random but always alike, so that no numbering makes long descending chains."""
    return F.struct(F.xxhash64(node).alias("order"), node.alias("node"))


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node of ``links``; ``root`` is one node of its component.

    Each round maps a node to the first of itself and its neighbours and carries the links over to
    the images, until no link between different nodes is left; then the maps are chained. Rounds
    grow with the logarithm of the nodes. Neighbours are only ever reduced to their first, with
    partial sums before the shuffle, so a node may have any number of links. Each round is landed in
    the shared folder. Null ends and loops are ignored: a node with only loops has no row.
    """
    pairs = links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    pairs = land(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                 .distinct(), "links")
    maps: list[DataFrame] = []
    while not pairs.isEmpty():
        ends = pairs.select("a", "b").union(pairs.select("b", "a"))
        image = land(ends.groupBy(F.col("a").alias("node")).agg(
            F.min(_least(F.col("b"))).alias("first")).select(
                "node", F.least("first", _least(F.col("node")))["node"].alias("image")), "images")
        maps.append(image)
        of_a = image.select(F.col("node").alias("a"), F.col("image").alias("image_a"))
        of_b = image.select(F.col("node").alias("b"), F.col("image").alias("image_b"))
        pairs = land(pairs.join(of_a, "a").join(of_b, "b").filter("image_a <> image_b").select(
            F.least("image_a", "image_b").alias("a"),
            F.greatest("image_a", "image_b").alias("b")).distinct(), "links")
    if not maps:
        return pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = maps[-1].withColumnRenamed("image", "root")
    for image in reversed(maps[:-1]):
        later = found.select(F.col("node").alias("image"), F.col("root").alias("later"))
        found = image.join(later, "image", "left").select(
            "node", F.coalesce("later", "image").alias("root"))
    return found


def join_groups(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``label`` after the groups of each ``i`` and ``j`` have become one; labels are least members."""
    while True:
        a, b = label[i], label[j]
        differ = a != b
        if not differ.any():
            return label
        i, j = i[differ], j[differ]
        np.minimum.at(label, np.maximum(a, b)[differ], np.minimum(a, b)[differ])
        while True:
            shorter = label[label]
            if np.array_equal(shorter, label):
                break
            label = shorter


def split_large(rows: DataFrame, shard: str, item: str, size: int) -> DataFrame:
    """``rows`` with the shards that hold more than ``size`` rows cut up, so that each task stays bounded.

    A large shard's items are dealt to parts of half that size by hash, and each pair of parts becomes
    a shard, so any two items still meet in one. ``shard`` is a bigint.
    """
    large = (rows.groupBy(shard).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > size)
             .select(shard, F.ceil(F.col("n") / max(1, size // 2)).cast("int").alias("parts")))
    part = F.pmod(F.xxhash64(F.col(item), F.lit("part")), F.col("parts")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda other: F.xxhash64(
        F.col(shard), F.least(part, other), F.greatest(part, other)))
    others = [c for c in rows.columns if c != shard]
    return rows.join(large, shard, "left").select(*others, F.explode(
        F.when(F.col("parts").isNull(), F.array(shard)).otherwise(pairs)).alias(shard))
