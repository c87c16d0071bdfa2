"""Passages that repeat across documents, found paragraph by paragraph.

A text is cut into paragraphs at places that only the words around them decide, so a passage has the
same cuts wherever it was pasted, whatever lines it was broken into. Equal paragraphs are one class.
Lines, and blocks between blank lines, are paragraphs too. Near-equal ones meet by MinHash bands over
shingles of five words; every two that collide are compared exactly, and classes that are similar enough
make clusters. Of each cluster the first occurrence stays; the others are extended, word by word, as far
as they go on like it.

Most paragraphs occur once. So a first pass sends only half of each hash, to find those that may repeat; a second one
keeps the paragraphs whose class or band key is among them, and only these are written and shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.llm import bitfilter
from reviewloom.llm.columns import column
from reviewloom.llm.components import connected_components, join_groups, split_large
from reviewloom.llm.words import hashed_words
from reviewloom.session import land

SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: Wanted share of the pairs at exactly ``SIMILARITY`` that meet in a band.
RECALL = 0.95
#: A cut is the lowest of this many places on both sides: what lies between two cuts has seven words at
#: least and thirteen on average.
REACH = 6
#: A passage that holds no whole paragraph is found by runs of ``SEED_WORDS`` words: any ``LONG`` words in a
#: row of a paragraph that long hold one. No passage of 51 words is without both.
SEED_WORDS, LONG = 8, 18
#: Repeats of fewer words in a row are left alone.
MIN_WORDS = 15
#: Classes that meet in one band of one task; larger meetings are split.
BUCKET = 2048
#: Up to so many sets are compared one by one.
_FEW = 24
#: Hashes are counted in this many parts, by their highest bits, and sent as their lowest 32.
_PART_BITS = 11
_HIGHEST = np.uint64(2**64 - 1)


def bands_for(similarity: float = SIMILARITY, recall: float = RECALL) -> int:
    """Bands of a single row. Shingles of five words are rare enough for one row to keep strangers
    apart, and what still collides is compared anyway; more rows would need more bands."""
    return math.ceil(round(math.log(1 - recall) / math.log(1 - similarity), 9))


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x ^ np.uint64(salt)) * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    return x * np.uint64(0xC4CEB9FE1A85EC53)


def cut_places(words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where paragraphs begin: the start of each text that has words, and the lowest places between."""
    owner = np.repeat(np.arange(bounds.size - 1), np.diff(bounds))
    height = np.full(words.size, _HIGHEST)
    pair = np.flatnonzero(owner[1:] == owner[:-1])
    height[pair] = _mix(words[pair] + np.uint64(3) * words[pair + 1], 0x9E3779B97F4A7C15) >> np.uint64(1)
    padded = np.full(words.size + REACH * bounds.size, _HIGHEST)  # texts do not see each other
    at = np.arange(words.size) + REACH * (owner + 1)
    padded[at] = height
    lowest = height < _HIGHEST
    for step in range(1, REACH + 1):
        lowest &= (height < padded[at - step]) & (height <= padded[at + step])
    lowest[bounds[:-1][np.diff(bounds) > 0]] = True
    return np.flatnonzero(lowest)


def shingles(words: np.ndarray) -> np.ndarray:
    """Hash of the five words from each word on, where there are five."""
    n = words.size - SHINGLE_WORDS + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(SHINGLE_WORDS):
        out = _mix(out + words[k:k + n], k + 1)
    return out


def words_by_line(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashed words, where each text's begin, where each line's begin, and each text's first line."""
    lines = [t.split(b"\n") for t in texts]
    words, ends = hashed_words([line for several in lines for line in several])
    first = np.concatenate([np.zeros(1, np.int64), np.cumsum([len(x) for x in lines], dtype=np.int64)])
    return words, ends[first], ends, first


def blocks(ends: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of what lies between lines without words, in texts that have such lines."""
    full = np.diff(ends) > 0
    begins, closes = full.copy(), full.copy()
    begins[1:] &= ~full[:-1]
    closes[:-1] &= ~full[1:]
    begins[first[:-1]], closes[first[1:] - 1] = full[first[:-1]], full[first[1:] - 1]
    text = np.searchsorted(first, np.flatnonzero(begins), side="right") - 1
    several = np.bincount(text, minlength=first.size)[text] > 1
    return ends[:-1][begins][several], ends[1:][closes][several]


def paragraphs(words: np.ndarray, bounds: np.ndarray, ends: np.ndarray, first: np.ndarray,
               bands: int, cuts: np.ndarray | None = None) -> tuple:
    """Starts, sizes, hashes and band keys of all paragraphs of at least five words: what lies between
    two ``cut_places``, each line, and each block between blank lines.

    What lies between cuts has keys of its own: a line would always collide with a part of itself.
    """
    cuts = cut_places(words, bounds) if cuts is None else cuts
    block_starts, block_stops = blocks(ends, first)
    # a text's last paragraph ends with it
    parts = np.stack([cuts, np.append(cuts[1:], words.size)[:cuts.size]])
    wholes = np.stack([np.append(ends[:-1], block_starts), np.append(ends[1:], block_stops)])
    parts, wholes = (x[:, x[1] - x[0] >= SHINGLE_WORDS] for x in (parts, wholes))
    if wholes.size:
        wholes = np.unique(wholes, axis=1)  # a block may be a line
    starts, stops = np.concatenate([parts, wholes], axis=1)
    whole = np.arange(starts.size) >= parts.shape[1]
    hashes = span_hashes(words, starts, stops)
    keys = np.zeros((bands, starts.size), np.uint64)
    if starts.size:
        found = np.full(words.size, _HIGHEST)
        each = shingles(words)
        found[:each.size] = each
        # shingles that begin up to there lie inside
        edges = np.stack([starts, stops - SHINGLE_WORDS + 1], axis=1).ravel()
        for k in range(bands):
            lowest = np.minimum.reduceat(_mix(found, 101 + k), edges)[::2]
            keys[k] = np.where(whole, _mix(lowest, 307 + k), _mix(lowest, 211 + k))
    return starts, stops - starts, hashes, keys


def span_hashes(words: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Hashes of the words from each start to its stop, wherever they stand."""
    base = np.uint64(0x9E3779B97F4A7C15 | 1)
    powers = np.cumprod(np.full(words.size + 1, base))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * powers[:-1])])
    inverse = np.cumprod(np.full(words.size + 1, np.uint64(pow(int(base), -1, 2**64))))
    return _mix((sums[stops] - sums[starts]) * inverse[starts] + (stops - starts).astype(np.uint64), 7)


def seeds(words: np.ndarray, bounds: np.ndarray, cuts: np.ndarray | None = None) -> np.ndarray:
    """Starts of runs of ``SEED_WORDS`` words in long paragraphs, chosen by the words around them: each
    has the lowest hash of some ``LONG - SEED_WORDS + 1`` neighbouring runs."""
    cuts = cut_places(words, bounds) if cuts is None else cuts
    sizes = np.diff(np.append(cuts, words.size))
    runs = np.where(sizes >= LONG, sizes - SEED_WORDS + 1, 0)
    owner = np.repeat(np.arange(cuts.size), runs)
    at = np.arange(owner.size) + np.repeat(cuts - np.cumsum(runs) + runs, runs)
    height = span_hashes(words, at, at + SEED_WORDS)
    window = LONG - SEED_WORDS + 1
    reach = np.ones(at.size, np.int64)
    left, right = np.ones(at.size, bool), np.ones(at.size, bool)
    for step in range(1, window):
        same = owner[step:] == owner[:-step]
        left[:step] = right[max(0, at.size - step):] = False
        left[step:] &= same & (height[:-step] > height[step:])
        right[:-step] &= same & (height[step:] >= height[:-step])
        reach += left
        reach += right
    return at[reach >= window]


def _pieces(texts: pa.Array, bands: int) -> tuple:
    """Where texts begin; places, sizes and classes of their paragraphs, then of their seeds; and the paragraphs'
    band keys."""
    words, bounds, ends, first = words_by_line([t.as_py() for t in texts.cast(pa.large_binary())])
    cuts = cut_places(words, bounds)
    starts, sizes, hashes, keys = paragraphs(words, bounds, ends, first, bands, cuts)
    more = seeds(words, bounds, cuts)
    starts = np.concatenate([starts, more])
    sizes = np.concatenate([sizes, np.full(more.size, SEED_WORDS, sizes.dtype)])
    hashes = np.concatenate([hashes, span_hashes(words, more, more + SEED_WORDS)])
    return bounds, starts, sizes, hashes, keys


def _short(hashes: np.ndarray) -> np.ndarray:
    """What is counted of hashes: their part, and 32 bits within it."""
    spread = bitfilter.spread_bits(hashes)
    return (spread >> np.uint64(64 - _PART_BITS) << np.uint64(32)) | (spread & np.uint64(2**32 - 1))


def _once_or_twice(values: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Each value: once, or twice if it has several owners."""
    order = np.lexsort((owner, values))
    values, owner = values[order], owner[order]
    fresh = np.ones(values.size, bool)
    fresh[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values = values[fresh]
    few = np.ones(values.size, bool)
    few[2:] = values[2:] != values[:-2]
    return values[few]


def _count(bands: int):
    """From (text), the short hashes of classes, by text, and of band keys, by class; packed by their part."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds, starts, _, classes, keys = _pieces(batch.column(0), bands)
            owner = np.searchsorted(bounds, starts, side="right") - 1
            short = np.sort(_short(np.concatenate([_once_or_twice(classes, owner), *[
                _once_or_twice(k, classes[:k.size]) for k in keys]])))
            parts, first = np.unique(short >> np.uint64(32), return_index=True)
            low = short.astype(np.uint32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(parts.astype(np.int32)), pa.array(
                    [x.tobytes() for x in np.split(low, first[1:])] if first.size else [], pa.binary())],
                ["part", "hashes"])
    return count


def _several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From packed hashes sorted by part, those that came more than once."""
    now, held = None, []

    def found() -> pa.RecordBatch:
        low = np.sort(np.frombuffer(b"".join(held), np.uint32))
        again = np.unique(low[1:][low[1:] == low[:-1]]).astype(np.uint64)
        known = bitfilter.spread_bits(np.uint64((now or 0) << 32) | again)
        return pa.RecordBatch.from_arrays([pa.array(known.view(np.int64))], ["hash"])

    for batch in batches:
        for part, hashes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if part != now:
                yield found()
                now, held = part, []
            held.append(hashes)
    yield found()


def repeated_hashes(texts: DataFrame, bands: int) -> Broadcast:
    """Bits of the hashes that may repeat: of classes in several texts, of band keys with several classes."""
    packed = texts.mapInArrow(_count(bands), "part int, hashes binary")
    return bitfilter.build(land(packed.repartition("part").sortWithinPartitions("part")
                                .mapInArrow(_several, "hash bigint"), "repeated"), "hash")


def _cut(bands: int, known: Broadcast | None = None):
    """From (id, key, text), one row per paragraph and, without band keys, per seed.

    Of ``known`` hashes: the rows of a text's classes that are among them or have a band key there; other keys are null.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds, starts, sizes, hashes, keys = _pieces(batch.column(2), bands)
            more = starts.size - keys.shape[1]
            keys = np.concatenate([keys, np.zeros((bands, more), np.uint64)], axis=1)
            hit = np.ones(keys.shape, bool)
            hit[:, starts.size - more:] = False
            if known is not None:
                of = keys.shape[1] - more
                for k in range(bands):
                    hit[k, :of] = bitfilter.may_contain(known.value, bitfilter.spread_bits(_short(keys[k, :of])))
                kept = hit.any(axis=0) | bitfilter.may_contain(known.value, bitfilter.spread_bits(_short(hashes)))
                # a class stays with all its places, whichever of them has the key
                kept = np.isin(hashes, np.unique(hashes[kept]))
                starts, sizes, hashes, keys, hit = starts[kept], sizes[kept], hashes[kept], keys[:, kept], hit[:, kept]
            owner = np.searchsorted(bounds, starts, side="right") - 1
            rows = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows),
                 pa.array((starts - bounds[owner]).astype(np.int32)), pa.array(sizes.astype(np.int32)),
                 pa.array(hashes.view(np.int64)), *[pa.array(k.view(np.int64), mask=~h) for k, h in zip(keys, hit)]],
                ["doc_id", "key", "at", "n", "class", *[f"band{k}" for k in range(bands)]])
    return cut


def _colliding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (bucket, class), the rows of buckets that hold more than one class."""
    bucket, item = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def several(bucket: np.ndarray, item: np.ndarray) -> pa.RecordBatch:
        fresh = np.ones(bucket.size, bool)
        fresh[1:] = (bucket[1:] != bucket[:-1]) | (item[1:] != item[:-1])
        bucket, item = bucket[fresh], item[fresh]
        same = bucket[1:] == bucket[:-1]
        kept = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        return pa.RecordBatch.from_arrays([pa.array(bucket[kept]), pa.array(item[kept])],
                                          ["bucket", "class"])

    for batch in batches:
        bucket = np.concatenate([bucket, batch.column(0).to_numpy()])
        item = np.concatenate([item, batch.column(1).to_numpy()])
        if not bucket.size:
            continue
        # the last bucket may go on; of a very long one, equal neighbours have gone by then
        whole = np.searchsorted(bucket, bucket[-1])
        if whole:
            yield several(bucket[:whole], item[:whole])
        bucket, item = bucket[whole:], item[whole:]
        fresh = np.ones(item.size, bool)
        fresh[1:] = item[1:] != item[:-1]
        bucket, item = bucket[fresh], item[fresh]
    if bucket.size:
        yield several(bucket, item)


def _marks(key: np.ndarray, item: np.ndarray) -> np.ndarray:
    """Hash of a class within the text of a key."""
    return bitfilter.spread_bits(key.view(np.uint64) ^ bitfilter.spread_bits(item.view(np.uint64)))


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (key, class), their marks and those of the texts."""
    for batch in batches:
        key = batch.column(0).to_numpy()
        marks = np.concatenate([_marks(key, batch.column(1).to_numpy()),
                                bitfilter.spread_bits(np.unique(key).view(np.uint64))])
        yield pa.RecordBatch.from_arrays([pa.array(marks.view(np.int64))], ["hash"])


def _shingles_of(wanted: Broadcast):
    """From (key, text), the distinct shingles of the paragraphs whose class is wanted of this text; their sets are
    equal wherever a class stands."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = bitfilter.may_contain(
                wanted.value, bitfilter.spread_bits(batch.column(0).to_numpy().view(np.uint64)))
            batch = batch.filter(pa.array(asked))
            words, bounds, ends, lines = words_by_line(
                [t.as_py() for t in batch.column(1).cast(pa.large_binary())])
            starts, sizes, hashes, _ = paragraphs(words, bounds, ends, lines, 0)
            owner = np.searchsorted(bounds, starts, side="right") - 1
            here = np.flatnonzero(bitfilter.may_contain(
                wanted.value, _marks(batch.column(0).to_numpy()[owner], hashes)))
            first = here[np.unique(hashes[here], return_index=True)[1]]
            hashes = hashes.view(np.int64)
            each = shingles(words).view(np.int64)
            sets = [np.unique(each[s:s + n - SHINGLE_WORDS + 1])
                    for s, n in zip(starts[first].tolist(), sizes[first].tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes[first]), pa.array(sets, pa.list_(pa.int64()))], ["class", "shingles"])
    return cut


def _few_groups(sets: list[set[int]], similarity: float) -> list[int]:
    """``similar_groups`` for a handful of sets."""
    label = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            if label[i] != label[j]:
                shared = len(a & sets[j])
                if shared >= similarity * (len(a) + len(sets[j]) - shared) - 1e-9:
                    low, high = sorted((label[i], label[j]))
                    label = [low if x == high else x for x in label]
    return label


def similar_groups(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """For each set the first one of its group, linked by exact Jaccard similarity.

    Each set is held against all sets that are not in its group yet, through the list of all shingles.
    """
    label = np.arange(len(sets))
    sizes = np.array([s.size for s in sets])
    everything = np.concatenate(sets)
    of = np.repeat(label, sizes)
    order = np.argsort(everything, kind="stable")
    everything, of = everything[order], of[order]
    for i, mine in enumerate(sets):
        if (label == label[i]).all():
            break
        low = np.searchsorted(everything, mine, side="left")
        high = np.searchsorted(everything, mine, side="right")
        hits = np.concatenate([of[a:b] for a, b in zip(low, high)])
        shared = np.bincount(hits, minlength=len(sets))
        near = np.flatnonzero(shared >= similarity * (sizes + sizes[i] - shared) - 1e-9)
        label = join_groups(label, near, np.full(near.size, i))
    return label


def _verify(similarity: float):
    """From rows (bucket, class, shingles) sorted by bucket, each class's link to the first of its group."""
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, items, sets = None, [], []

        def links() -> list[tuple[int, int]]:
            if len(items) <= _FEW:
                label = _few_groups([set(s) for s in sets], similarity) if len(items) > 1 else []
            else:
                label = similar_groups([np.array(s, np.int64) for s in sets], similarity).tolist()
            return [(items[i], items[j]) for i, j in enumerate(label) if i != j]

        def rows(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([a for a, _ in pairs], pa.int64()),
                                               pa.array([b for _, b in pairs], pa.int64())], ["a", "b"])

        for batch in batches:
            found = []
            for bucket, item, shingles_ in zip(*(c.to_pylist() for c in batch.columns)):
                if bucket != now:
                    found += links()
                    now, items, sets = bucket, [], []
                items.append(item)
                sets.append(shingles_)
            yield rows(found)
        yield rows(links())
    return verify


def _sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (id, key, text, spans of the text), the words before each span, backwards, and after it.

    They go as far as the cut after the next one and the words that decide it: two texts that are equal
    beyond it have the whole next paragraph in common, which is a span of its own.
    """
    for batch in batches:
        words, bounds = hashed_words([t.as_py() for t in batch.column(2).cast(pa.large_binary())])
        owner = np.repeat(np.arange(batch.num_rows), batch.column(3).value_lengths().to_numpy())
        spans = batch.column(3).flatten()
        start, stop = (spans.field(k).to_numpy().astype(np.int64) + bounds[owner] for k in range(2))
        cuts = cut_places(words, bounds)
        low = cuts[np.maximum(np.searchsorted(cuts, start, side="right") - 2, 0)] - REACH - 2
        low = np.maximum(low, bounds[owner])
        high = np.append(cuts, [words.size] * 2)[np.searchsorted(cuts, stop, side="left") + 1] + REACH + 3
        high = np.minimum(high, bounds[owner + 1])

        def several(first: np.ndarray, size: np.ndarray, step: int) -> pa.Array:
            offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(size)])
            place = np.repeat(first, size) + step * (np.arange(offsets[-1]) - np.repeat(offsets[:-1], size))
            return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)),
                                            pa.array(words[place].view(np.int64)))
        rows = pa.array(owner)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(rows), batch.column(1).take(rows), *spans.flatten(),
             several(start - 1, start - low, -1), several(stop, high - stop, 1)],
            ["doc_id", "key", "start", "stop", "exact", "link", "first_doc", "twin", "left", "right"])


def _in_common(a: str, b: str) -> Column:
    """How many items two arrays begin with alike."""
    differ = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    return F.when(differ > 0, differ - 1).otherwise(F.size(a)).cast("int")


def extended_spans(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The outermost of the ``found`` spans of each stretch of a text, as far as their words go on like
    those of their ``twin`` in another document; and the twins, as far as any goes."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    stretch = Window.partitionBy("doc_id", "key", "exact", "stretch")
    edges = land(
        _numbered(found, "stretch", "exact").withColumns({"low": F.min("start").over(stretch),
                                                          "high": F.max("stop").over(stretch)})
        .filter((F.col("start") == F.col("low")) | (F.col("stop") == F.col("high")))
        .filter(~F.col("doc_id").eqNullSafe(F.col("twin.doc_id")))
        .select("doc_id", "key", "start", "stop", "exact", "link", "first_doc", "twin"), "edges")
    twins = edges.select("twin.doc_id", "twin.key", F.col("twin.at").alias("start"),
                         (F.col("twin.at") + F.col("twin.n")).alias("stop"), "exact", "link",
                         F.lit(None).cast(edges.schema["first_doc"].dataType).alias("first_doc")).distinct()

    def of_text(spans: DataFrame, twin: bool) -> DataFrame:
        return spans.select("doc_id", "key", F.struct(
            "start", "stop", "exact", "link", "first_doc", F.lit(twin).alias("twin")).alias("span"))
    wanted = of_text(edges, False).union(of_text(twins, True)).groupBy(
        F.col("doc_id").alias("id"), F.col("key").alias("k")).agg(F.collect_set("span").alias("spans"))
    words = F.coalesce("text", F.lit(""))
    texts = docs.select("doc_id", F.xxhash64("doc_id", words).alias("key"), words.alias("text"))
    texts = texts.join(wanted, texts["doc_id"].eqNullSafe(F.col("id")) & (texts["key"] == F.col("k")))
    sides = land(texts.select("doc_id", "key", "text", "spans").mapInArrow(
        _sides, f"doc_id {kind}, key bigint, start int, stop int, exact boolean, link bigint, "
                f"first_doc {kind}, twin boolean, left array<bigint>, right array<bigint>"), "sides")
    twin = sides.filter("twin").groupBy("exact", "link").agg(
        F.first(F.struct("left", "right")).alias("of"))
    grown = land(sides.filter("not twin").join(twin, ["exact", "link"]).select(
        "doc_id", "key", "start", "stop", "exact", "link", "first_doc",
        _in_common("left", "of.left").alias("before"), _in_common("right", "of.right").alias("after")),
        "grown")
    most = grown.groupBy("exact", "link").agg(F.max("before").alias("before"), F.max("after").alias("after"))

    def out(spans: DataFrame, removed: bool) -> DataFrame:
        return spans.select("doc_id", "key", (F.col("start") - F.col("before")).alias("start"),
                            (F.col("stop") + F.col("after")).alias("stop"), "first_doc",
                            F.lit(removed).alias("removed"))
    return out(grown, True).union(out(twins.join(most, ["exact", "link"]), False))


def paragraph_table(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    bands: int = 0, known: Broadcast | None = None) -> DataFrame:
    """``doc_id, key, at, n, class`` and band keys: one row per paragraph of five words and more. Seeds
    are rows without band keys.

    ``key`` tells rows with the same id apart by their text; ``at`` counts words from 0. With ``known``, the bits of
    ``repeated_hashes``, paragraphs and seeds that surely have nothing in common with others are left out.
    """
    number, words = column(doc_id), F.coalesce(column(text), F.lit(""))
    kind = docs.schema[doc_id].dataType.simpleString()
    columns = "".join(f", band{k} bigint" for k in range(bands))
    return docs.select(number.alias("doc_id"), F.xxhash64(number, words).alias("key"),
                       words.alias("text")).mapInArrow(
        _cut(bands, known), f"doc_id {kind}, key bigint, at int, n int, class bigint{columns}")


def similar_classes(docs: DataFrame, table: DataFrame, bands: int, similarity: float = SIMILARITY,
                    bucket_size: int = BUCKET) -> DataFrame:
    """``class, root`` for the classes that are similar to another one; equal texts are one class."""
    keys = [F.col(f"band{k}") for k in range(bands)]
    table = table.filter(F.coalesce(*keys).isNotNull())
    met = land(table.select(F.explode(F.array(*keys)).alias("bucket"), "class").filter("bucket is not null")
               .repartition("bucket").sortWithinPartitions("bucket", "class")
               .mapInArrow(_colliding, "bucket bigint, class bigint"), "colliding")
    # of each class the paragraph of one text; no text is shuffled for it
    first = table.select("class", "key").groupBy("class").agg(F.min("key").alias("key"))
    wanted = bitfilter.build(land(met.select("class").distinct().join(first, "class").select("key", "class")
                                  .mapInArrow(_asked, "hash bigint"), "asked"), "hash")
    words = F.coalesce("text", F.lit(""))
    sets = docs.select(F.xxhash64("doc_id", words).alias("key"), words.alias("text")).mapInArrow(
        _shingles_of(wanted), "class bigint, shingles array<bigint>")
    sets = land(sets.groupBy("class").agg(F.min("shingles").alias("shingles")), "shingles")
    dealt = split_large(met, "bucket", "class", bucket_size)
    links = (dealt.join(sets, "class").select("bucket", "class", "shingles").repartition("bucket")
             .sortWithinPartitions("bucket", "class").mapInArrow(_verify(similarity), "a bigint, b bigint"))
    return connected_components(links).select(F.col("node").alias("class"), "root")


def repeated_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                      similarity: float = SIMILARITY, recall: float = RECALL,
                      min_words: int = MIN_WORDS) -> DataFrame:
    """One row per paragraph that lies in a passage repeated in another document, and one more where the
    passage goes on beyond it.

    ``doc_id, key, start, stop`` name its words, ``first_doc`` the smallest id with a paragraph of its
    cluster, ``removed`` whether an earlier occurrence stays instead. Paragraphs that touch or overlap
    are one passage, ``run``, which has ``min_words`` words or more; ``island`` numbers the connected parts
    of a text that are removed. Rows with equal ids are one document, null ids another.
    """
    bands = bands_for(similarity, recall)
    docs = docs.select(column(doc_id).alias("doc_id"), column(text).alias("text"))
    known = repeated_hashes(docs.select(F.coalesce("text", F.lit("")).alias("text")), bands)
    table = land(paragraph_table(docs, bands=bands, known=known), "paragraphs")
    similar = land(similar_classes(docs, table, bands, similarity), "similar")
    classes = table.groupBy("class").agg(
        F.min(F.struct("doc_id", "at", "key", "n")).alias("first"), F.min("doc_id").alias("low"),
        F.max("doc_id").alias("high"), F.max(F.col("doc_id").isNull()).alias("no_id"))
    rooted = classes.join(similar, "class", "left").withColumn("root", F.coalesce("root", "class"))
    clusters = rooted.groupBy("root").agg(
        F.min("first").alias("first"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.max("no_id").alias("no_id")).filter(
        (F.col("low") < F.col("high")) | (F.col("no_id") & F.col("low").isNotNull()))
    members = rooted.select("class", "root", F.col("first").alias("own")).join(clusters.select("root", "first"), "root")
    found = table.select("doc_id", "key", "at", "n", "class").join(members, "class")
    # a line and a paragraph inside it may be of one cluster: what overlaps the first occurrence stays with it
    stays = (F.struct("doc_id", "key").eqNullSafe(F.struct("first.doc_id", "first.key"))
             & (F.col("at") < F.col("first.at") + F.col("first.n"))
             & (F.col("at") + F.col("n") > F.col("first.at")))
    # words go on alike beside equal paragraphs; beside similar ones, where no equal one is in another document
    exact = ~F.col("doc_id").eqNullSafe(F.col("own.doc_id"))
    found = land(found.select(
        "doc_id", "key", F.col("at").alias("start"), (F.col("at") + F.col("n")).alias("stop"),
        exact.alias("exact"), F.when(exact, F.col("class")).otherwise(F.col("root")).alias("link"),
        F.when(exact, F.col("own")).otherwise(F.col("first")).alias("twin"),
        F.col("first.doc_id").alias("first_doc"), (~stays).alias("removed")), "found")
    spans = found.select("doc_id", "key", "start", "stop", "first_doc", "removed").union(
        extended_spans(docs, found))
    run = Window.partitionBy("doc_id", "key", "run")
    size = F.max("stop").over(run) - F.min("start").over(run)
    return _numbered(_numbered(spans, "run").withColumn("size", size).filter(F.col("size") >= min_words)
                     .drop("size"), "island", "removed")


def _numbered(spans: DataFrame, name: str, *by: str) -> DataFrame:
    """``spans`` with a number for those of one text, and of one ``by``, that touch or overlap."""
    in_order = Window.partitionBy("doc_id", "key", *by).orderBy("start", "stop")
    reach = F.max("stop").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    return spans.withColumn("gap", F.coalesce(F.col("start") > reach, F.lit(True)).cast("int")) \
        .withColumn(name, F.sum("gap").over(in_order)).drop("gap")


def dedup_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per row of ``docs``: what of it repeats, and with whom.

    ``doc_id``; ``component_id``, the smallest id reachable over shared passages, itself included;
    ``linked_docs``, the sorted ids that hold its repeated passages first; ``n_repeated`` passages in a
    row; ``n_removed`` stretches with ``removed_words`` words that stay elsewhere; ``removed_spans``, their
    places in words. Null and empty texts repeat nothing.
    """
    number, words = column(doc_id), F.coalesce(column(text), F.lit(""))
    found = land(repeated_passages(docs, doc_id, text, **options), "passages")
    parts = found.groupBy(F.col("doc_id").alias("id"), "key", "removed", "island").agg(
        F.collect_set("first_doc").alias("docs"), F.collect_set("run").alias("runs"),
        F.min("start").alias("start"), F.max("stop").alias("stop"))
    span = F.when(F.col("removed"), F.struct("start", "stop"))
    per_doc = parts.groupBy("id", "key").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("docs")))).alias("linked_docs"),
        F.size(F.array_distinct(F.flatten(F.collect_list("runs")))).cast("bigint").alias("n_repeated"),
        F.count_if("removed").alias("n_removed"),
        F.sum(F.when(F.col("removed"), F.col("stop") - F.col("start")).otherwise(0)).alias("removed_words"),
        F.array_sort(F.collect_list(span)).alias("removed_spans"))
    groups = land(connected_components(found.select("doc_id", "first_doc").distinct(), "doc_id", "first_doc"),
                  "document_groups")
    least = groups.groupBy("root").agg(F.min("node").alias("component_id"))
    named = groups.join(least, "root").select(F.col("node").alias("node"), "component_id")
    rows = docs.select(number.alias("doc_id"), F.xxhash64(number, words).alias("key"))
    joined = rows.join(per_doc.withColumnRenamed("key", "k"),
                       rows["doc_id"].eqNullSafe(F.col("id")) & (rows["key"] == F.col("k")), "left")
    joined = joined.join(named, joined["doc_id"] == named["node"], "left")
    zero = F.lit(0).cast("bigint")
    return joined.select(
        "doc_id", F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("linked_docs", F.array().cast(per_doc.schema["linked_docs"].dataType)).alias("linked_docs"),
        F.coalesce("n_repeated", zero).alias("n_repeated"), F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("removed_words", zero).alias("removed_words"),
        F.coalesce("removed_spans", F.array().cast(per_doc.schema["removed_spans"].dataType))
        .alias("removed_spans"))
