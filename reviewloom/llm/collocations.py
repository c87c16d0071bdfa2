"""Phrases that stand together more often than their parts would by themselves.

Two passes over the texts. The first keeps Misra-Gries summaries: each slice of texts counts the hashes of its
n-grams, the counts are dealt to hash partitions, and a partition merges them into a summary whose capacity
exceeds its mass (all occurrences dealt to it) divided by the threshold, so that no frequent n-gram can be
lost. The second pass counts exactly, by their words, the n-grams whose hashes survived.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.llm import bitfilter
from reviewloom.llm.columns import column
from reviewloom.operators.skew import spread_join
from reviewloom.session import land

MIN_COUNT = 30
MAX_WORDS = 4
TOP = 2000
#: A phrase goes when a longer one that holds it has this share of its count.
CONTAINED_PERCENT = 80
SCALE = 2_000_000
UNKNOWN = "und"

#: Text that a task counts at once.
SLICE_BYTES = 4_000_000
#: Text per hash partition; some 45 million n-grams of four words at most.
PARTITION_BYTES = 128_000_000
#: Keys in a row of the first shuffle, and entries that a summary takes in before it is cut back.
_ROW_KEYS = 4096
_BUFFER = 1_000_000
#: Phrases that one task ranks.
_RANKED = 50_000
_ODD = 0x9E3779B97F4A7C15

# only A-Z change case; a line feed stands for every separator of pieces, a blank for those of words
_TABLE = bytes(b + 32 if 65 <= b <= 90 else 10 if 10 <= b <= 13 or b in b".,;:!?" else 32 if b == 9 else b
               for b in range(256))


class Slice:
    """The words of some texts as numbers, one after the other; number 0 ends a piece."""

    def __init__(self, texts: list[bytes | None], groups: list[str]):
        number: defaultdict[bytes, int] = defaultdict(itertools.count().__next__)
        number[b"\n"], number[b""]
        codes = [np.zeros(0, np.int64)]
        for text in texts:
            words = ((text or b"").translate(_TABLE).replace(b"\n", b" \n ") + b" \n").split(b" ")
            found = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
            codes.append(found[found != 1])
        names: defaultdict[str, int] = defaultdict(itertools.count().__next__)
        of = np.fromiter(map(names.__getitem__, groups), np.int64, len(groups))
        self.codes = np.concatenate(codes)
        self.group = np.repeat(of, [c.size for c in codes[1:]])
        self.words, self.groups = list(number), list(names)
        self._word_hash = np.fromiter(map(xxhash.xxh64_intdigest, self.words), np.uint64, len(self.words))
        self._group_hash = np.fromiter(map(xxhash.xxh64_intdigest, self.groups), np.uint64, len(self.groups))
        places = np.arange(self.codes.size)
        ends = np.where(self.codes == 0, places, self.codes.size)
        self._left = np.minimum.accumulate(ends[::-1])[::-1] - places  # words up to the end of the piece

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Where phrases of ``n`` words begin, and their hashes (uint64)."""
        at = np.flatnonzero(self._left >= n)
        keys = self._group_hash[self.group[at]] + np.uint64(n)
        for j in range(n):
            keys += self._word_hash[self.codes[at + j]] * np.uint64((2 * j + 1) * _ODD % 2**64)
        return at, bitfilter.spread_bits(keys)

    def count_phrases(self, at: np.ndarray, n: int) -> Iterator[tuple[str, bytes, int]]:
        """Group, phrase and times of the phrases of ``n`` words that begin at ``at``; told apart by their words."""
        ident = self.group[at]
        for j in range(n):
            _, ident = np.unique(ident * len(self.words) + self.codes[at + j], return_inverse=True)
        _, first, times = np.unique(ident, return_index=True, return_counts=True)
        for place, count in zip(at[first].tolist(), times.tolist()):
            phrase = b" ".join([self.words[c] for c in self.codes[place:place + n].tolist()])
            yield self.groups[self.group[place]], phrase, count


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[Slice]:
    texts, groups, size = [], [], 0
    for batch in batches:
        for group, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary())):
            texts.append(text.as_py())
            groups.append(group)
            size += len(texts[-1] or b"")
            if size >= SLICE_BYTES:
                yield Slice(texts, groups)
                texts, groups, size = [], [], 0
    if texts:
        yield Slice(texts, groups)


def _short(keys: np.ndarray, bits: int) -> np.ndarray:
    """The hash partition in the upper 32 bits, a key within it in the lower ones."""
    return (keys >> np.uint64(64 - bits)) << np.uint64(32) | keys & np.uint64(0xFFFFFFFF)


def _planes(values: np.ndarray) -> bytes:
    """32-bit numbers byte by byte, so that the upper bytes of small ones lie together and compress."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _slice_counts(max_words: int, bits: int):
    """Per slice and hash partition one row with the mass, then rows of keys, as differences, and counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            keys = np.concatenate([_short(part.grams(n)[1], bits) for n in range(1, max_words + 1)])
            found, times = np.unique(keys, return_counts=True)
            cuts = np.searchsorted(found, np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(32)).tolist()
            for partition, (start, stop) in enumerate(zip(cuts, cuts[1:])):
                if start == stop:
                    continue
                ends = [*range(start, stop, _ROW_KEYS), stop]
                low = [(found[i:j] & np.uint64(0xFFFFFFFF)).astype(np.uint32) for i, j in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays([
                    pa.array([partition] * len(ends), pa.int32()),
                    pa.array([int(times[start:stop].sum())] + [None] * len(low), pa.int64()),
                    pa.array([None] + [_planes(np.diff(k, prepend=np.uint32(0))) for k in low], pa.binary()),
                    pa.array([None] + [_planes(times[i:j]) for i, j in zip(ends, ends[1:])], pa.binary())],
                    ["partition", "mass", "keys", "times"])
    return run


class MisraGries:
    """Counts of at most ``capacity`` keys of a stream; mergeable.

    A key seen ``f`` times has a count ``c`` with ``f - lost <= c <= f``, 0 where it has none, and ``lost`` is
    at most the mass divided by ``capacity + 1``.
    """

    def __init__(self, capacity: int):
        self.capacity, self.lost = capacity, 0
        self.keys, self.times = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self._new: list[tuple[np.ndarray, np.ndarray]] = []
        self._size = 0

    def add(self, keys: np.ndarray, times: np.ndarray, at_once: int = _BUFFER) -> None:
        self._new.append((keys, times.astype(np.int64)))
        self._size += keys.size
        if self._size >= at_once:
            self.merge()

    def merge(self) -> None:
        if not self._new:
            return
        keys = np.concatenate([self.keys, *[k for k, _ in self._new]])
        times = np.concatenate([self.times, *[t for _, t in self._new]])
        self._new, self._size = [], 0
        order = np.argsort(keys)
        keys, times = keys[order], times[order]
        first = np.flatnonzero(np.concatenate([[keys.size > 0], keys[1:] != keys[:-1]]))
        keys, times = keys[first], np.add.reduceat(times, first) if first.size else times
        if keys.size > self.capacity:
            cut = int(np.partition(times, -self.capacity - 1)[-self.capacity - 1])
            stay = times > cut
            keys, times, self.lost = keys[stay], times[stay] - cut, self.lost + cut
        self.keys, self.times = keys, times


def _survivors(min_count: int):
    """Hashes that may stand for ``min_count`` occurrences, from rows sorted by partition, masses first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, mass, summary = None, 0, None

        def found() -> pa.RecordBatch:
            keys = np.zeros(0, np.uint64)
            if summary is not None:
                summary.merge()
                stay = summary.keys[summary.times + summary.lost >= min_count].astype(np.uint64)
                keys = bitfilter.spread_bits(np.uint64(partition << 32) | stay)
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], ["hash"])

        for batch in batches:
            for row in range(batch.num_rows):
                here = batch.column(0)[row].as_py()
                if here != partition:
                    yield found()
                    partition, mass, summary = here, 0, None
                more = batch.column(1)[row].as_py()
                if more is not None:
                    mass += more
                    continue
                if summary is None:
                    summary = MisraGries(mass // min_count + 1)
                keys = np.cumsum(_from_planes(batch.column(2)[row].as_py()), dtype=np.uint32)
                summary.add(keys, _from_planes(batch.column(3)[row].as_py()))
        yield found()
    return run


def _exact_counts(max_words: int, bits: int, known: Broadcast):
    """Per slice: times of the phrases that may be frequent, and, without phrase, the number of words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            totals = np.bincount(part.group[part.codes != 0], minlength=len(part.groups)).tolist()
            yield pa.RecordBatch.from_arrays([
                pa.array(part.groups, pa.string()), pa.array([0] * len(totals), pa.int32()),
                pa.array([None] * len(totals), pa.string()), pa.array(totals, pa.int64())],
                ["group", "words", "phrase", "times"])
            for n in range(1, max_words + 1):
                at, keys = part.grams(n)
                at = at[bitfilter.may_contain(known.value, bitfilter.spread_bits(_short(keys, bits)))]
                rows = part.count_phrases(at, n)
                while some := list(itertools.islice(rows, 20_000)):
                    groups, phrases, times = zip(*some)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(groups, pa.string()), pa.array([n] * len(some), pa.int32()),
                        pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(times, pa.int64())],
                        ["group", "words", "phrase", "times"])
    return run


def frequent_phrases(docs: DataFrame, text: str = "text", group: str = "lang", min_count: int = MIN_COUNT,
                     max_words: int = MAX_WORDS, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """``group, words, phrase, times``: exact counts of all phrases of up to ``max_words`` words that occur
    ``min_count`` times within their group; the row without phrase has the group's number of words.

    Phrases are space-joined and lie within a piece. Null texts are empty, a null group is ``und``, and a
    group without words has the count 0. Repeated rows count each time. The result is landed.
    """
    chosen = docs.select(F.coalesce(column(group).cast("string"), F.lit(UNKNOWN)).alias("group"),
                         column(text).cast("string").alias("text"))
    size = chosen.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(4, (size // partition_bytes).bit_length())
    rows = chosen.mapInArrow(_slice_counts(max_words, bits), "partition int, mass bigint, keys binary, times binary")
    survivors = land(
        rows.repartition("partition").sortWithinPartitions("partition", F.col("mass").asc_nulls_last())
        .mapInArrow(_survivors(min_count), "hash bigint"), "survivors")
    known = bitfilter.build(survivors, "hash")
    counted = chosen.mapInArrow(_exact_counts(max_words, bits, known),
                                "group string, words int, phrase string, times bigint")
    return land(counted.groupBy("group", "words", "phrase").agg(F.sum("times").alias("times"))
                .filter((F.col("words") == 0) | (F.col("times") >= min_count)), "phrases")


def _parts(phrases: DataFrame) -> DataFrame:
    """Every cut of every phrase, with its two sides."""
    words = F.split("phrase", " ")
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    return cuts.select(
        "group", "phrase", "a", "k", F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice(words, F.col("k") + 1, F.col("words")), " ").alias("right"))


def _within(phrases: DataFrame) -> DataFrame:
    """``group, phrase, longest``: the largest count of a longer phrase that holds the phrase."""
    words = F.split("phrase", " ")
    longer = phrases.filter("words > 2").withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
    placed = longer.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
    return placed.select("group", F.array_join(F.slice(words, F.col("at"), F.col("size")), " ").alias("phrase"),
                         "a").groupBy("group", "phrase").agg(F.max("a").alias("longest"))


def _best(kept: DataFrame, top: int, phrases: int) -> DataFrame:
    """The first ``top`` phrases of each group with their ``rank``.

    A group's phrases are dealt over salts, about ``_RANKED`` to each, and only the best of a salt are ranked
    among all; so no task sorts a large group.
    """
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salts = -(-phrases // max(_RANKED, 2 * top))
    if salts > 1:
        salt = F.pmod(F.xxhash64("phrase"), F.lit(salts))
        here = Window.partitionBy("group", "__salt").orderBy(*order)
        kept = kept.withColumn("__salt", salt).withColumn("__place", F.row_number().over(here)).filter(
            F.col("__place") <= top).drop("__salt", "__place")
    return kept.withColumn("rank", F.row_number().over(Window.partitionBy("group").orderBy(*order))).filter(
        F.col("rank") <= top)


def _wide(value) -> F.Column:
    return value.cast("decimal(19,0)")


def collocations(docs: DataFrame, text: str = "text", group: str = "lang", min_count: int = MIN_COUNT,
                 max_words: int = MAX_WORDS, top: int = TOP, contained_percent: int = CONTAINED_PERCENT,
                 partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """``group, rank, phrase, a, l, r, n, score``: each group's best phrases of two words and more.

    ``a`` is the phrase's count, ``l`` and ``r`` those of its two sides at the cut where
    ``floor(SCALE * a / (l + r))`` is least (the first of equal ones), which is its score. Phrases inside a longer one
    with ``contained_percent`` of their count are left out. Ranks go by score, count, and the phrase's bytes. Products
    are decimals, which hold any two 64-bit numbers' product. See ``frequent_phrases`` for nulls, empty
    and repeated rows; an empty table, and a group without frequent phrases, has no rows.
    """
    counts = frequent_phrases(docs, text, group, min_count, max_words, partition_bytes)
    totals = counts.filter("words = 0").select("group", F.col("times").alias("n"))
    known = counts.filter("words > 0").select("group", "phrase", "times")
    phrases = counts.filter("words > 1").select("group", "words", "phrase", F.col("times").alias("a"))

    def side(name: str, into: str) -> DataFrame:
        return known.select("group", F.col("phrase").alias(name), F.col("times").alias(into))

    # many phrases begin or end with the same word, so its rows are dealt over salts
    cuts = spread_join(spread_join(_parts(phrases), side("left", "l"), ["group", "left"]),
                       side("right", "r"), ["group", "right"])
    score = F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * _wide(F.col("a")),
                            _wide(F.col("l")) + _wide(F.col("r")))
    scored = cuts.groupBy("group", "phrase", "a").agg(
        F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    held = _wide(F.col("longest")) * 100 >= _wide(F.col("a")) * contained_percent
    kept = scored.join(_within(phrases), ["group", "phrase"], "left").filter(
        F.col("longest").isNull() | ~held).select("group", "phrase", "a", "cut.l", "cut.r", "cut.score")
    return _best(kept, top, phrases.count()).join(totals, "group").select(
        "group", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
