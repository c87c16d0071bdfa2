"""Near-duplicate documents by MinHash signatures and a multi-index Hamming join.

A signature holds one b-bit value per hash function. Signatures are cut into chunks; by the pigeonhole
principle two signatures that differ in at most ``CHUNKS * (ERRORS + 1) - 1`` places differ in ``ERRORS`` places at
most within some chunk. The places of the allowed errors are enumerated: each choice leaves out ``ERRORS``
places of a chunk, and the rest is a key. So all pairs under the signature distance share a key.

Pairs are not listed per key. First every signature meets the first one of its key; what is confirmed on
the full sets becomes groups. Then, in keys that still hold several groups, pairs across groups are looked at,
each under the first key that it shares, save those that the distances to the first one, which are known by
then, or a long sketch rule out. What is left is confirmed on the full sets, there and then, so that pairs that
are not similar enough, of which a large group may have many, are compared and never become rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.llm import bitfilter
from reviewloom.llm.columns import column
from reviewloom.llm.components import connected_components
from reviewloom.operators.skew import spread_join
from reviewloom.session import land

SHINGLE_WORDS = 5
#: Links have at least this share of shingles in common, in hundredths.
PERCENT = 85
#: Bits of one value, chunks of a signature, values in a chunk, and errors allowed in one: all pairs that differ in
#: at most 11 of 30 values share a key.
BITS, CHUNKS, CHUNK, ERRORS = 16, 6, 5, 1
VALUES = CHUNKS * CHUNK
DISTANCE = CHUNKS * (ERRORS + 1) - 1
#: Rows of a key that one task compares, and bytes of their sets; a larger key is cut into parts, and each pair of
#: parts is compared.
GROUP, GROUP_BYTES = 2048, 64_000_000
#: Values of the long sketch, a byte each, that says which pairs across groups are worth their full sets; a pair at
#: the limit has too few in common with a probability of some 3 in a million.
SKETCH, DEVIATIONS = 512, 4.5
_SLICE_BYTES = 1_500_000
#: Hashes of texts that a task remembers to have passed on.
_SEEN = 200_000
_ODD = 0x9E3779B97F4A7C15


def _factors(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit numbers."""
    return bitfilter.spread_bits(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_ODD) + np.uint64(seed)) | np.uint64(1)


def shingle_set(text: bytes | None, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Distinct 64-bit hashes of the text's shingles, sorted; a text with fewer words is one shingle."""
    words = text.lower().split() if text else []  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return np.zeros(0, np.uint64)
    number = dict(zip(dict.fromkeys(words), range(len(words))))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, number), np.uint64, len(number))[
        np.fromiter(map(number.__getitem__, words), np.int64, len(words))]
    n = min(size, len(words))
    factors = _factors(n, n)
    mixed = np.zeros(len(words) - n + 1, np.uint64)
    for j in range(n):
        mixed += hashes[j:len(words) - n + 1 + j] * factors[j]
    return np.unique(bitfilter.spread_bits(mixed))


def signatures(sets: list[np.ndarray], values: int = VALUES, seed: int = 77, kind: str = "<u2") -> np.ndarray:
    """For each set, none of them empty, the low bits of its least hashes under ``values`` functions."""
    joined = np.concatenate(sets)
    starts = np.cumsum([0] + [s.size for s in sets[:-1]])
    found = np.empty((len(sets), values), np.uint64)
    for i, factor in enumerate(_factors(values, seed)):
        found[:, i] = np.minimum.reduceat(joined * factor, starts)
    return bitfilter.spread_bits(found).astype(kind)


def _node(shingles: np.ndarray) -> bytes:
    """Names a set: equal sets have equal names."""
    return xxhash.xxh3_128_digest(shingles.tobytes())


def _pieces(batch: pa.RecordBatch, at: int) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Rows of a batch with their texts (column ``at``), about ``_SLICE_BYTES`` at a time."""
    start, texts, size = 0, [], 0
    for text in batch.column(at).cast(pa.large_binary()):
        texts.append(text.as_py())
        size += len(texts[-1] or b"")
        if size >= _SLICE_BYTES:
            yield batch.slice(start, len(texts)), texts
            start, texts, size = start + len(texts), [], 0
    if texts:
        yield batch.slice(start, len(texts)), texts


def _sketcher(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in _pieces(batch, 1):
                sets = [shingle_set(t, size) for t in texts]
                filled = [s for s in sets if s.size]
                found = iter(signatures(filled)) if filled else iter(())
                yield pa.RecordBatch.from_arrays([
                    rows.column(0), pa.array([s.size for s in sets], pa.int64()),
                    pa.array([_node(s) if s.size else None for s in sets], pa.binary()),
                    pa.array([next(found).tobytes() if s.size else None for s in sets], pa.binary()),
                    rows.column(2)], ["doc_id", "n_shingles", "node", "signature", "text_hash"])
    return run


def chunk_keys(signature: Column | str, chunks: int = CHUNKS, chunk: int = CHUNK, errors: int = ERRORS) -> Column:
    """The keys of a signature: for each chunk, and each choice of ``errors`` places, what is left without them."""
    keys, width = [], BITS // 8
    for c in range(chunks):
        for out in combinations(range(chunk), errors):
            left = [c * chunk + p for p in range(chunk) if p not in out]
            keys.append(F.xxhash64(F.lit(len(keys)), *[F.substring(signature, width * p + 1, width) for p in left]))
    return F.array(*keys)


def _set_reader(size: int, wanted):
    """``node, shingles`` of the texts whose hash the filter may hold; a task leaves out most copies."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            hashes = batch.column(1).to_numpy().view(np.uint64)
            keep = []
            for i in np.flatnonzero(bitfilter.may_contain(wanted.value, bitfilter.spread_bits(hashes))).tolist():
                mark = int(hashes[i]), len(batch.column(0)[i].as_buffer() or b"")
                if mark not in seen:
                    if len(seen) >= _SEEN:
                        seen.clear()
                    seen.add(mark)
                    keep.append(i)
            if keep:
                for _, texts in _pieces(batch.take(pa.array(keep)), 0):
                    sets = [s for s in (shingle_set(t, size) for t in texts) if s.size]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([_node(s) for s in sets], pa.binary()),
                        pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "shingles"])
    return run


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spread = bitfilter.spread_bits(batch.column(0).to_numpy().view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(spread.view(np.int64))], ["hash"])


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sizes of the pairs' intersections."""
    for batch in batches:
        common = [np.intersect1d(np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64),
                                 assume_unique=True).size for a, b in zip(batch.column(2), batch.column(3))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(4), batch.column(5),
                                          pa.array(common, pa.int64())], ["a", "b", "n_a", "n_b", "common"])


def _similar_sizes(a: str, b: str, percent: int) -> Column:
    """Whether sets of these sizes can be similar enough at all."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


class _Corpus:
    """Texts with their sketches, and the exact similarity of pairs of them."""

    def __init__(self, docs: DataFrame, size: int, percent: int):
        self.size, self.percent = size, percent
        self.texts = docs.select("text", F.xxhash64("text").alias("text_hash"))
        kind = docs.schema["doc_id"].dataType.simpleString()
        self.rows = land(docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(
            _sketcher(size), f"doc_id {kind}, n_shingles bigint, node binary, signature binary, text_hash bigint"),
            "sketches")
        # equal sets are one node; one of its texts stands for it
        self.nodes = land(self.rows.filter("n_shingles > 0").groupBy("node").agg(
            F.min("doc_id").alias("first"), F.min("n_shingles").alias("n"), F.min("signature").alias("signature"),
            F.min("text_hash").alias("text_hash")), "nodes")

    def sets_of(self, nodes: DataFrame) -> DataFrame:
        """``node, shingles``: the full sets of some nodes, worked out again from their texts; landed."""
        needed = land(nodes.distinct(), "needed")
        hashes = needed.join(self.nodes.select("node", "text_hash"), "node").select("text_hash")
        wanted = bitfilter.build(land(hashes.mapInArrow(_spread, "hash bigint"), "hashes"), "hash")
        read = self.texts.mapInArrow(_set_reader(self.size, wanted), "node binary, shingles binary")
        # copies of a text have one set, which a task passes on once
        return land(read.groupBy("node").agg(F.min("shingles").alias("shingles")).join(
            needed, "node", "left_semi"), "sets")

    def measured(self, pairs: DataFrame) -> DataFrame:
        """``a, b, n_a, n_b, common``: the pairs with the sizes of their intersections, from the full sets; landed.

        Pairs that their sizes ``n_a, n_b`` rule out are left out.
        """
        todo = land(pairs.filter(_similar_sizes("n_a", "n_b", self.percent)).distinct(), "candidates")
        sets = self.sets_of(todo.select("a").union(todo.select("b")).toDF("node"))

        def with_set(rows: DataFrame, end: str) -> DataFrame:
            # one set may stand in most pairs, so its rows are dealt over salts
            counts = todo.groupBy(end).agg(F.count(F.lit(1)).alias("__n"))
            return spread_join(rows, sets.toDF(end, f"of_{end}"), [end], counts=counts, count="__n")
        both = with_set(with_set(todo, "a"), "b").select("a", "b", "of_a", "of_b", "n_a", "n_b")
        return land(both.mapInArrow(_common, "a binary, b binary, n_a bigint, n_b bigint, common bigint"), "measured")

    def links(self, measured: DataFrame) -> DataFrame:
        union = F.col("n_a") + F.col("n_b") - F.col("common")
        return measured.filter(F.col("common") * 100 >= union * self.percent).select("a", "b")


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Long sketches of full sets."""
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            some = batch.slice(at, 64)
            sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in some.column(1)]
            yield pa.RecordBatch.from_arrays([some.column(0), pa.array(
                [s.tobytes() for s in signatures(sets, SKETCH, 99, "u1")], pa.binary())], ["node", "sketch"])


def _first_key(mine: np.ndarray, others: np.ndarray) -> np.ndarray:
    """The number of the first key that a signature has in common with each of the others; -1 for none."""
    differ = (others != mine).reshape(-1, CHUNKS, CHUNK)
    # a chunk without errors has all its keys in common, one with an error the key that leaves out its place
    place = np.arange(CHUNKS) * CHUNK + differ.argmax(axis=2)
    place[differ.sum(axis=2) > 1] = VALUES
    first = place.min(axis=1)
    return np.where(first == VALUES, -1, first)


def _links_across(percent: int):
    """From rows sorted by shard, links that join groups, each looked for under the first key of its pair only.

    Jaccard distance is a metric: with the distances to a third set known, it is no less than their difference.
    What that and the sizes leave is asked of the long sketches, and then of the full sets. Pairs whose groups
    have become one are not looked at, so a shard gives fewer links than it has rows.
    """
    reach, share = 1 - percent / 100 + 1e-9, percent / 100
    least = SKETCH * share - DEVIATIONS * np.sqrt(SKETCH * share * (1 - share))

    def links(table: pa.Table) -> Iterator[pa.RecordBatch]:
        node, n, at = table["node"].to_pylist(), table["n"].to_numpy(), table["at"].to_numpy()
        root = np.unique(np.array(table["root"].to_pylist(), object), return_inverse=True)[1]
        away, part, alone = table["away"].to_numpy(), table["part"].to_numpy(), table["alone"].to_numpy()
        sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in table["shingles"]]

        def matrix(name: str, kind: str) -> np.ndarray:
            return np.frombuffer(b"".join(table[name].to_pylist()), kind).reshape(table.num_rows, -1)
        signature, sketch, found = matrix("signature", "<u2"), matrix("sketch", "u1"), []
        for i in range(table.num_rows - 1):
            rest = slice(i + 1, None)
            j = np.flatnonzero((root[rest] != root[i]) & ((part[rest] != part[i]) | alone[rest])
                               & ~(np.abs(away[rest] - away[i]) > reach)  # an unknown distance rules out nothing
                               & (100 * np.minimum(n[i], n[rest]) >= percent * np.maximum(n[i], n[rest]))) + i + 1
            j = j[_first_key(signature[i], signature[j]) == at[i]]
            j = j[(sketch[j] == sketch[i]).sum(axis=1) >= least]
            for other in j.tolist():
                if root[other] != root[i]:
                    common = np.intersect1d(sets[i], sets[other], assume_unique=True).size
                    if 100 * common >= percent * (n[i] + n[other] - common):
                        found.append((node[i], node[other]))
                        root[root == root[other]] = root[i]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(side, pa.binary()) for side in zip(*found)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            shard = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1).tolist(), batch.num_rows]
            for start, stop in zip(cuts, cuts[1:]):
                if start == stop:
                    continue
                if held and held[0].column(0)[0].as_py() != int(shard[start]):
                    yield from links(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(start, stop - start))
        if held:
            yield from links(pa.Table.from_batches(held))
    return run


def _dealt(rows: DataFrame, sizes: DataFrame, group: int) -> DataFrame:
    """Rows of a key as ``shard``s of ``group`` rows at most: a larger key in parts of half that, each two of which meet.

    The sets of a shard have about ``GROUP_BYTES`` at most. ``alone`` says that a shard is one part, the only place
    where the part's own rows are compared.
    """
    fill = F.greatest(F.col("__n") / group, F.col("shingles") * 8 / GROUP_BYTES)
    parts = F.when(fill > 1, F.ceil(fill * 2)).otherwise(1).cast("int")
    cut = spread_join(rows, sizes.select("key", "__n", parts.alias("parts")), ["key"], count="__n")
    part = F.pmod(F.xxhash64("node", F.lit("part")), F.col("parts")).cast("int")
    placed = cut.withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return placed.withColumn("alone", F.col("part") == F.col("other")).withColumn("shard", F.xxhash64(
        "key", F.least("part", "other"), F.greatest("part", "other"))).drop("parts", "other", "key")


def near_groups(corpus: _Corpus, group: int = GROUP) -> DataFrame:
    """``node, root`` of the nodes that have a similar one."""
    keyed = corpus.nodes.select("node", "n", F.posexplode(chunk_keys("signature")).alias("at", "key"))
    firsts = keyed.groupBy("key").agg(F.min(F.struct("node", "n")).alias("first"), F.count(F.lit(1)).alias("__n"))
    firsts = firsts.filter("__n > 1").select("key", "first.node", "first.n", "__n").toDF("key", "first", "n_first", "__n")
    shared = land(spread_join(keyed, firsts, ["key"], count="__n"), "keys")
    measured = corpus.measured(shared.filter("node <> first").select("first", "node", "n_first", "n")
                               .toDF("a", "b", "n_a", "n_b"))
    links = corpus.links(measured)
    roots = land(connected_components(links), "roots")

    # keys that hold several groups
    labelled = land(shared.join(roots, "node", "left").select(
        "key", "at", "node", "n", "first", F.coalesce("root", "node").alias("root")), "labelled")
    mixed = land(labelled.groupBy("key").agg(
        F.min("root").alias("least"), F.max("root").alias("most"), F.count(F.lit(1)).alias("__n"),
        F.sum("n").alias("shingles")).filter("least <> most").select("key", "__n", "shingles"), "mixed")
    open_rows = land(spread_join(labelled, mixed.select("key", "__n"), ["key"], count="__n"), "open")
    known = measured.select(F.col("a").alias("first"), F.col("b").alias("node"), (
        1 - F.col("common") / (F.col("n_a") + F.col("n_b") - F.col("common"))).alias("away"))
    sets = corpus.sets_of(open_rows.select("node"))
    sketches = sets.mapInArrow(_sketches, "node binary, sketch binary")
    of_node = corpus.nodes.select("node", "signature").join(sketches, "node").join(sets, "node")
    # pairs of too different sizes were not measured: their distance stays unknown
    rows = land(open_rows.join(known, ["first", "node"], "left").select("key", "at", "node", "root", "n", F.when(
        F.col("node") == F.col("first"), 0.0).otherwise(F.col("away")).alias("away")), "rows")
    dealt = _dealt(rows, mixed, group).join(of_node, "node").select(
        "shard", "at", "node", "root", "n", "away", "part", "alone", "signature", "sketch", "shingles")
    across = land(dealt.repartition("shard").sortWithinPartitions("shard").mapInArrow(
        _links_across(corpus.percent), "a binary, b binary"), "links_across")
    return land(connected_components(links.union(across)), "groups")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS,
                    percent: int = PERCENT, group: int = GROUP) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: one row per row of ``docs``.

    Documents are linked when ``100 * common >= percent * all`` of their distinct shingles of ``words`` words; a
    text with fewer words is one shingle. Null and empty texts have none and are alone. ``component_id`` is the
    smallest id in the group, ``kept`` whether it is the row's own. A null id names no group unless
    nothing else is in it: then both are null, and the row is kept. Equal ids with equal texts are all kept.
    """
    corpus = _Corpus(docs.select(column(doc_id).alias("doc_id"), column(text).cast("string").alias("text")),
                     words, percent)
    named = corpus.nodes.select("node", "first").join(near_groups(corpus, group), "node", "left").select(
        "node", "first", F.coalesce("root", "node").alias("root"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    of_node = named.join(smallest, "root").select("node", "component_id")
    found = spread_join(corpus.rows.select("doc_id", "n_shingles", "node"), of_node, ["node"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"),
                        F.col("doc_id").eqNullSafe(component).alias("kept"))
