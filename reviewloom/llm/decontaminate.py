"""Documents that hold passages of test items, found by spaced seeds.

A mask names some positions of a short window of words and ignores the others, so a seed still
matches where ignored words were replaced. Seeds of all masks are taken at every word of the items and
of the documents and joined by their hash; around each hit document and item are laid side by
side, and the best-scoring stretch must be long and equal enough.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.batches import slices
from reviewloom.llm.columns import column, columns, free_name
from reviewloom.llm.words import hashed_words
from reviewloom.session import land

#: Positions that count; six each, over seven to nine words.
MASKS = ((0, 1, 2, 3, 5, 6), (0, 1, 3, 4, 6, 8), (0, 2, 3, 5, 7, 8))
#: A passage counts from so many words on (an item of fewer words must be there as a whole), of which
#: this share must be equal.
MIN_WORDS = 13
MIN_EQUAL = 0.8
#: Words kept on each side of a run of hits: a passage of an item is checked this far around each.
AROUND = 64
#: Bits of the filter that keeps seeds of no item from leaving their task: 128 for each seed of an item
#: at least, between these bounds (128 KB and 64 MB). Each seed sets three of them, so of a million
#: seeds of no item a dozen pass.
FILTER_BITS = (1 << 20, 1 << 29)
BITS_PER_SEED = 128

_SEEDS = "key_a bigint, key_b bigint, begin bigint, words array<bigint>, hits array<struct<seed:bigint,at:bigint>>"


def seeds(words: np.ndarray, mask: tuple[int, ...], number: int) -> np.ndarray:
    """The seed of ``mask`` at each word where it fits."""
    n = words.size - mask[-1]
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, 0x9E3779B97F4A7C15 + number, np.uint64)
    for offset in mask:
        out ^= words[offset:offset + n]
        out *= np.uint64(0xFF51AFD7ED558CCD)
        out ^= out >> np.uint64(32)
    return out


def _item_seeds(masks: tuple[tuple[int, ...], ...]):
    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, bounds = hashed_words([t.as_py() for t in batch.column(1).cast(pa.large_binary())])
            parts = [words[a:b] for a, b in zip(bounds, bounds[1:])]
            found = [[{"seed": int(s), "at": i} for k, mask in enumerate(masks)
                      for i, s in enumerate(seeds(p, mask, k).view(np.int64))] for p in parts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([p.view(np.int64) for p in parts], pa.list_(pa.int64())),
                 pa.array(found, pa.list_(pa.struct([("seed", pa.int64()), ("at", pa.int64())])))],
                ["item", "words", "seeds"])
    return take


def _stretches(masks: tuple[tuple[int, ...], ...], bits: int, filled: np.ndarray, around: int):
    """From rows (two keys, text), the words around runs of hits, with the hits."""
    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[tuple] = []

        def texts() -> Iterator[pa.Array]:
            for batch in batches:
                keys.extend(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
                yield batch.column(2)

        for part in slices(texts()):
            mine, keys[:len(part)] = keys[:len(part)], []
            words, bounds = hashed_words(part)
            ats, found = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
            for k, mask in enumerate(masks):
                s = seeds(words, mask, k)
                at = np.arange(s.size)
                for shift in _shifts(bits):
                    bit = s[at] >> np.uint64(shift) & np.uint64(bits - 1)
                    at = at[(filled[(bit >> np.uint64(3)).astype(np.int64)]
                             >> (bit & np.uint64(7)).astype(np.uint8) & np.uint8(1)).astype(bool)]
                # a window must not run into the next text
                owner = np.searchsorted(bounds, at, side="right")
                at = at[at + mask[-1] < bounds[np.minimum(owner, bounds.size - 1)]]
                ats.append(at)
                found.append(s[at])
            at, seed = np.concatenate(ats), np.concatenate(found)
            order = np.argsort(at, kind="stable")
            at, seed = at[order], seed[order]
            owner = np.searchsorted(bounds, at, side="right") - 1
            far = np.flatnonzero((owner[1:] != owner[:-1]) | (at[1:] - at[:-1] > around)) + 1
            rows = []
            for run in np.split(np.arange(at.size), far):
                if run.size:
                    d = owner[run[0]]
                    begin = max(bounds[d], at[run[0]] - around)
                    stop = min(bounds[d + 1], at[run[-1]] + around)
                    rows.append((*mine[d], int(begin - bounds[d]), words[begin:stop].view(np.int64),
                                 [{"seed": int(s), "at": int(p - bounds[d])}
                                  for s, p in zip(seed[run].view(np.int64), at[run])]))
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()),
                     pa.list_(pa.struct([("seed", pa.int64()), ("at", pa.int64())]))]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             ["key_a", "key_b", "begin", "words", "hits"])
    return take


def best_stretch(equal: np.ndarray, least: int, share: float) -> int:
    """Equal words in the best stretch that holds ``least`` words and the ``share`` of equal ones; else 0.

    An equal word scores 1, another one so much less that a stretch scores 0 at exactly ``share``.
    """
    score = np.concatenate([[0.0], np.cumsum(np.where(equal, 1.0, -share / (1 - share)))])
    lowest = np.minimum.accumulate(score)
    # the first place that scores no more than the best start so far makes the longest stretch
    start = np.searchsorted(-lowest, -score - 1e-9, side="left")
    stop = np.arange(score.size)
    long_enough = (stop - start) >= least
    if not long_enough.any():
        return 0
    counted = np.concatenate([[0], np.cumsum(equal)])
    return int((counted[stop] - counted[np.minimum(start, stop)])[long_enough].max())


def _verify(least: int, share: float):
    """From candidates with both sides' words, the equal words of those that pass."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begins, shifts = batch.column(2).to_numpy(), batch.column(4).to_numpy()
            here, there = batch.column(5), batch.column(6)
            kept, counts = [], []
            for i in range(batch.num_rows):
                doc = np.asarray(here[i].values)
                item = np.asarray(there[i].values)
                first = begins[i] - shifts[i]  # the item's word beside the stretch's first
                low, high = max(0, first), min(item.size, first + doc.size)
                equal = doc[low - first:high - first] == item[low:high]
                n = best_stretch(equal, min(least, item.size), share)
                if n:
                    kept.append(i)
                    counts.append(n)
            some = batch.take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [some.column(0), some.column(1), some.column(3), pa.array(counts, pa.int64())],
                ["key_a", "key_b", "item", "equal_words"])
    return check


def _shifts(bits: int) -> tuple[int, int, int]:
    """Where in a seed its three places in the filter stand: at both ends and in the middle."""
    spare = 64 - bits.bit_length() + 1
    return 0, spare // 2, spare


def _filter_bits(tests: DataFrame) -> tuple[int, np.ndarray]:
    """The bit filter of the items' seeds: gathered in 64-bit words, never larger than its bound."""
    n = tests.count()
    low, high = FILTER_BITS
    bits = min(high, max(low, 1 << math.ceil(math.log2(BITS_PER_SEED * n + 1))))
    places = F.array(*[F.shiftrightunsigned("seed", shift).bitwiseAND(F.lit(bits - 1))
                       for shift in _shifts(bits)])
    place = F.col("place")
    words = tests.select(F.explode(places).alias("place")).groupBy(
        F.shiftright(place, 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"),
                                 place.bitwiseAND(F.lit(63)).cast("int"))).alias("set"))
    filled = np.zeros(bits // 64, np.int64)
    for row in words.toLocalIterator():
        filled[row["word"]] = row["set"]
    return bits, filled.view(np.uint8)


def find_passages(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", least: int = MIN_WORDS,
                  share: float = MIN_EQUAL) -> DataFrame:
    """``key_a, key_b, item, equal_words``: which rows of ``docs`` hold a passage of which items.

    The keys are the two hashes of id and text that ``keys`` gives. Items without an id, and of fewer
    words than the shortest mask covers, are never found. One row per key and item.
    """
    spark = docs.sparkSession
    kind = items.schema[item_id].dataType.simpleString()
    read = land(items.filter(column(item_id).isNotNull()).select(
        column(item_id).alias("item"), F.coalesce(column(item_text), F.lit("")).alias("text"))
        .distinct().mapInArrow(_item_seeds(MASKS), f"item {kind}, words array<bigint>, "
                               "seeds array<struct<seed:bigint,at:bigint>>"), "items")
    tests = read.select("item", F.inline("seeds")).withColumnRenamed("at", "item_at")
    bits, filled = _filter_bits(tests)
    shared = spark.sparkContext.broadcast(filled)

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _stretches(MASKS, bits, shared.value, AROUND)(batches)

    found = land(keys(docs, doc_id, text).select("key_a", "key_b", column(text)).mapInArrow(
        take, _SEEDS), "stretches")
    hits = found.select("key_a", "key_b", "begin", F.inline("hits"))
    pairs = hits.join(tests, "seed").select(
        "key_a", "key_b", "begin", "item", (F.col("at") - F.col("item_at")).alias("shift")).distinct()
    sides = (pairs.join(found.select("key_a", "key_b", "begin", "words"), ["key_a", "key_b", "begin"])
             .join(read.select("item", F.col("words").alias("item_words")), "item"))
    checked = sides.select("key_a", "key_b", "begin", "item", "shift", "words", "item_words").mapInArrow(
        _verify(least, share), f"key_a bigint, key_b bigint, item {kind}, equal_words bigint")
    return checked.groupBy("key_a", "key_b", "item").agg(F.max("equal_words").alias("equal_words"))


def keys(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``docs`` with two hashes that tell rows apart by id and text, null and empty texts alike."""
    words, number = F.coalesce(column(text), F.lit("")), column(doc_id)
    return docs.withColumns({"key_a": F.xxhash64(number, words), "key_b": F.xxhash64(words, number)})


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  into: str = "contamination", **options) -> DataFrame:
    """``docs`` with a struct ``into``: ``contaminated``, ``items`` (sorted ids), ``equal_words`` (the most).

    One row per input row; null and empty texts hold nothing; without items nothing is contaminated; an
    existing column of that name is replaced.
    """
    found = find_passages(docs.select(column(doc_id), column(text)), items, doc_id, text,
                          **options)
    per_row = land(found.groupBy("key_a", "key_b").agg(
        F.array_sort(F.collect_set("item")).alias("items"),
        F.max("equal_words").alias("equal_words")), "contaminated")
    kept = columns(docs, (into,))
    words, number = F.coalesce(column(text), F.lit("")), column(doc_id)
    rows = docs.select(F.struct(*kept).alias("row"), F.xxhash64(number, words).alias("key_a"),
                       F.xxhash64(words, number).alias("key_b"))
    return rows.join(per_row, ["key_a", "key_b"], "left").select("row.*", F.struct(
        F.col("items").isNotNull().alias("contaminated"),
        F.coalesce("items", F.array().cast(per_row.schema["items"].dataType)).alias("items"),
        F.coalesce("equal_words", F.lit(0)).cast("bigint").alias("equal_words")).alias(into))


def drop_contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                      **options) -> DataFrame:
    """The rows of ``docs`` that hold no passage of an item, with their columns."""
    into = free_name(docs, "found")
    return contamination(docs, items, doc_id, text, into, **options).filter(
        ~column(into)["contaminated"]).select(*columns(docs))
