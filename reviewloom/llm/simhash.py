"""SimHash fingerprints, all pairs within a few bits, and the groups they make.

Links between fingerprints are found by vantage-point trees: from a vantage point, points and queries
are split by their distance to it, and by the triangle inequality a query follows only the branches
that can hold a point near enough; queries near the boundary follow both. Over whole fingerprints this
alone would not spread the work: most distances lie within a few bits of the median, so most queries
overlap every boundary. The fingerprints are therefore first dealt to shards by the bits they share:
cut into ``max_bits + 2`` segments, two fingerprints within ``max_bits`` agree in two segments at
least. Each choice of two segments makes one forest of shards, and each shard holds one tree.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from reviewloom.llm.columns import column, columns
from reviewloom.llm.components import connected_components, join_groups, split_large
from reviewloom.session import land

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: Fingerprints in a shard; a larger one is cut into parts, and each pair of parts is a shard.
SHARD = 8192
_AT_ONCE = 65_536
_SMALL = 32


def simhash(text: bytes, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """The fingerprint of one text: bits set in over half of its shingles' hashes."""
    words = text.lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return 0
    joined = b" ".join(words)
    size = min(words_per_shingle, len(words))
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], stops[:-1] + 1])
    begin, end = starts[:len(words) - size + 1].tolist(), stops[size - 1:].tolist()
    hashed = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, len(begin), _AT_ONCE):
        hashes = np.array([hashed(joined[i:j], SEED) for i, j in
                           zip(begin[at:at + _AT_ONCE], end[at:at + _AT_ONCE])], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(begin), bitorder="little").view("<i8")[0])


def fingerprint(text: Column | str, words_per_shingle: int = SHINGLE_WORDS) -> Column:
    """SimHash of each text as a bigint that holds the 64 bits; null and empty texts have 0."""
    @arrow_udf("bigint")
    def fingerprints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([simhash(t.as_py() or b"", words_per_shingle)
                            for t in texts.cast(pa.large_binary())], pa.int64())
    return fingerprints.asNondeterministic()(text)


def fingerprint_hex(fp: Column | str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _segment_masks(max_bits: int) -> list[int]:
    """Masks of all pairs of ``max_bits + 2`` segments, as signed 64-bit numbers."""
    cuts = np.linspace(0, 64, max_bits + 3).round().astype(int).tolist()
    parts = [(1 << j) - (1 << i) for i, j in zip(cuts, cuts[1:])]
    return [int(np.array([x | y], np.uint64).view(np.int64)[0]) for x, y in combinations(parts, 2)]


def tree_groups(points: np.ndarray, max_bits: int) -> np.ndarray:
    """For each fingerprint, the first one of its group, linked by steps of ``max_bits`` at most.

    A vantage-point tree is walked with all fingerprints as queries at once. Pairs that are already in
    one group are not joined again, so a dense group costs comparisons but no list of its pairs.
    """
    label = np.arange(points.size)
    todo = [(label, label)]
    while todo:
        members, queries = todo.pop()
        if members.size * queries.size <= _SMALL ** 4 and members.size <= _SMALL ** 2:
            for at in range(0, queries.size, _SMALL ** 2):
                part = queries[at:at + _SMALL ** 2]
                q, m = np.nonzero(np.bitwise_count(points[part, None] ^ points[members]) <= max_bits)
                q, m = part[q], members[m]
                new = label[q] != label[m]
                label = join_groups(label, q[new], m[new])
            continue
        vantage = members[members.size // 2]
        to_members = np.bitwise_count(points[members] ^ points[vantage]).astype(np.int64)
        to_queries = np.bitwise_count(points[queries] ^ points[vantage]).astype(np.int64)
        near = queries[to_queries <= max_bits]
        label = join_groups(label, near, np.full(near.size, vantage))
        median = int(np.median(to_members))
        inside = to_members <= median
        if inside.all():
            inside = to_members < median
        if inside.all() or not inside.any():  # all equally far: nothing to prune, so halve
            half = members.size // 2
            todo += [(members[:half], queries), (members[half:], queries)]
            continue
        border = int(to_members[inside].max())
        outer = int(to_members[~inside].min())
        todo += [(members[inside], queries[to_queries <= border + max_bits]),
                 (members[~inside], queries[to_queries >= outer - max_bits])]
    return label


def _shard_links(max_bits: int):
    """From rows sorted by shard, each fingerprint's link to the first one of its group in the shard."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, fps = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def links(shard: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            cuts = np.flatnonzero(shard[1:] != shard[:-1]) + 1
            starts, stops = np.concatenate([[0], cuts]), np.concatenate([cuts, [shard.size]])
            label = np.arange(shard.size)
            sizes = stops - starts
            # small shards all at once: each place against the next, the one after it, and so on
            place = np.flatnonzero(np.repeat((sizes > 1) & (sizes <= _SMALL), sizes))
            step = 1
            while place.size:
                place = place[place + step < shard.size]
                place = place[shard[place] == shard[place + step]]
                near = place[np.bitwise_count(fps[place] ^ fps[place + step]) <= max_bits]
                label = join_groups(label, near, near + step)
                step += 1
            for start, stop in zip(starts[sizes > _SMALL].tolist(), stops[sizes > _SMALL].tolist()):
                label[start:stop] = start + tree_groups(fps[start:stop], max_bits)
            linked = np.flatnonzero(label != np.arange(shard.size))
            return pa.RecordBatch.from_arrays(
                [pa.array(fps[linked].view(np.int64)), pa.array(fps[label[linked]].view(np.int64))],
                ["a", "b"])

        for batch in batches:
            shard = np.concatenate([shard, batch.column(0).to_numpy()])
            fps = np.concatenate([fps, batch.column(1).to_numpy().view(np.uint64)])
            whole = np.searchsorted(shard, shard[-1]) if shard.size else 0
            if whole:  # the last shard may go on in the next batch
                yield links(shard[:whole], fps[:whole])
                shard, fps = shard[whole:], fps[whole:]
        if shard.size:
            yield links(shard, fps)
    return find


def near_links(fps: DataFrame, fp: str = "fp", max_bits: int = MAX_BITS,
               shard_size: int = SHARD) -> DataFrame:
    """``a, b``: links that join distinct fingerprints into the groups that all near pairs make.

    ``fps`` holds each fingerprint once. Every pair within ``max_bits`` is looked at, in some shard;
    of those within a shard, a spanning set is given.
    """
    masks = F.array(*[F.lit(m) for m in _segment_masks(max_bits)])
    sharded = fps.select(F.col(fp).alias("fp"), F.posexplode(masks).alias("forest", "mask")).select(
        "fp", F.xxhash64("forest", F.col("fp").bitwiseAND(F.col("mask"))).alias("shard"))
    dealt = split_large(sharded, "shard", "fp", shard_size)
    return (dealt.select("shard", "fp").repartition("shard").sortWithinPartitions("shard", "fp")
            .mapInArrow(_shard_links(max_bits), "a bigint, b bigint"))


def near_groups(fps: DataFrame, fp: str = "fp", max_bits: int = MAX_BITS,
                shard_size: int = SHARD) -> DataFrame:
    """``fp, root`` for every fingerprint that has another one within reach."""
    found = connected_components(near_links(fps, fp, max_bits, shard_size))
    return found.select(F.col("node").alias("fp"), "root")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    words_per_shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, fingerprint, component_id``: one row per row of ``docs``.

    ``component_id`` is the smallest id in the document's group, itself included. Equal texts have
    equal fingerprints and are one node. Null and empty texts have fingerprint 0, which links like
    any other; null ids have a row but name no group unless nothing else is in it (then null).
    """
    marked = land(docs.select(column(doc_id).alias("doc_id"),
                              fingerprint(column(text), words_per_shingle).alias("fp")),
                  "fingerprints")
    nodes = land(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    named = nodes.join(near_groups(nodes, max_bits=max_bits), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    of_fp = named.join(smallest, "root").select("fp", "component_id")
    return marked.join(of_fp, "fp").select(
        "doc_id", fingerprint_hex("fp").alias("fingerprint"), "component_id")


def keep_one_per_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                       words_per_shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each group, with the columns of ``docs``: the one with the smallest id.

    Null ids come last; among equal ids the text with the smaller hash stays, and of repeated rows one.
    The texts are shuffled once, after copies have been dropped where they were read.
    """
    order = F.struct(column(doc_id).isNull().alias("no_id"), column(doc_id).alias("id"),
                     F.xxhash64(column(text)).alias("hash"))
    marked = docs.select(F.struct(*columns(docs)).alias("row"),
                         order.alias("order"),
                         fingerprint(column(text), words_per_shingle).alias("fp"))
    firsts = land(marked.groupBy("fp").agg(F.min_by("row", "order").alias("row"),
                                           F.min("order").alias("order")), "firsts")
    groups = firsts.select("fp", "order").join(near_groups(firsts.select("fp"), max_bits=max_bits),
                                               "fp")
    best = groups.groupBy("root").agg(F.min(F.struct("order", "fp")).alias("best"))
    others = groups.join(best, "root").filter(F.col("fp") != F.col("best.fp")).select("fp")
    return firsts.join(others, "fp", "left_anti").select("row.*")
