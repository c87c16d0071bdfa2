"""Quality rules on whole texts, with repetition measured by suffix arrays.

Words are runs of bytes other than blank, tab, newline, vertical tab, form feed and carriage return.
All texts of a slice share one suffix array over their words: equal words of different texts get
different numbers, so no two suffixes of different texts begin alike, and one vectorised prefix
doubling serves them all. Neighbours in the array give the longest common prefixes; the interval
around a suffix with the longest prefix is the largest repeated substring that begins there. The spans
of these substrings are united, and a text passes if they cover a small enough part of it and the
longest of them is short enough.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql.functions import arrow_udf

from reviewloom.llm.batches import slices
from reviewloom.llm.columns import column, columns, free_name

# Fixed values of the base rules.
MIN_WORDS = 20
WINDOW = 8
MAX_REPEAT_PERCENT = 30
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"

# The verdict of the suffix arrays: repeats of five words and more may cover so many percent of the
# words, and the longest may be so many percent of the text.
MIN_REPEAT = 5
MAX_COVERED_PERCENT = 40
MAX_LONGEST_PERCENT = 35

MEASURES = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
            "n_repeat_words bigint, covered_words bigint, longest_repeat bigint, "
            "repeat_spans array<struct<start:bigint,stop:bigint>>")


def longest_matches(codes: np.ndarray) -> np.ndarray:
    """For each position, the length of the longest substring that begins there and somewhere else too.

    ``codes`` are non-negative numbers. The suffix array is refined by prefix doubling, only among
    suffixes that still agree; the ranks of each doubling give the common prefixes afterwards.
    """
    n = codes.size
    if n == 0:
        return np.zeros(0, np.int64)
    sa = np.argsort(codes, kind="stable")
    rank = np.empty(n, np.int64)
    new = np.concatenate([[True], codes[sa][1:] != codes[sa][:-1]])
    rank[sa] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels, length = [rank.astype(np.int32)], 1
    agree = _shared(new)
    first = np.flatnonzero(agree & ~new)  # slots that share at least a word with the slot before
    while agree.any():
        slots = np.flatnonzero(agree)
        at = sa[slots]
        behind = np.where(at + length < n, rank[np.minimum(at + length, n - 1)] + 1, 0)
        key = rank[at] * (n + 1) + behind
        order = np.argsort(key, kind="stable")
        key, at = key[order], at[order]
        sa[slots] = at
        head = np.concatenate([[True], key[1:] != key[:-1]])
        rank = rank.copy()
        rank[at] = np.maximum.accumulate(np.where(head, slots, 0))
        new[slots] = head
        agree = _shared(new)
        length *= 2
        levels.append(rank.astype(np.int32))
    i, j = sa[first - 1], sa[first]
    common = np.zeros(first.size, np.int64)
    for level in range(len(levels) - 1, -1, -1):
        a, b = i + common, j + common
        inside = np.maximum(a, b) < n
        same = inside & (levels[level][np.where(inside, a, 0)] == levels[level][np.where(inside, b, 0)])
        common[same] += 1 << level
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, i, common)
    np.maximum.at(longest, j, common)
    return longest


def _shared(new: np.ndarray) -> np.ndarray:
    """Slots in groups of two or more, where ``new`` marks the first slot of each group."""
    return ~(new & np.concatenate([new[1:], [True]]))


def _covered(longest: np.ndarray, least: int) -> np.ndarray:
    """Positions inside the union of the repeats of at least ``least`` words."""
    at = np.flatnonzero(longest >= least)
    edge = np.zeros(longest.size + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + longest[at], -1)
    return np.cumsum(edge[:-1]) > 0


def measure_slice(texts: list[bytes | None], min_repeat: int) -> pa.StructArray:
    """The figures of ``MEASURES`` for each text."""
    counts = np.zeros((4, len(texts)), np.int64)
    codes: list[np.ndarray] = []
    base = 0
    for i, text in enumerate(texts):
        words = text.split() if text else []  # bytes split at exactly these six characters
        if words:
            number = dict.fromkeys(words)
            for k, word in enumerate(number, base):
                number[word] = k
            base += len(number)
            codes.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
            packed = b"".join(words)
            lines = [line for line in text.split(b"\n") if line.strip()]
            counts[:, i] = (len(words), len(packed.decode()),
                            len(packed) - len(packed.translate(None, SYMBOLS)),
                            len(lines) - len(set(lines)))
    longest = longest_matches(np.concatenate([np.zeros(0, np.int64), *codes]))
    ends = np.cumsum(counts[0])
    starts = ends - counts[0]
    some = np.flatnonzero(counts[0])

    def per_text(values: np.ndarray, how: np.ufunc) -> np.ndarray:
        out = np.zeros(len(texts), np.int64)
        if some.size:
            out[some] = how.reduceat(values, starts[some])
        return out

    covered = _covered(longest, min_repeat)
    edges = np.diff(np.concatenate([[0], covered.astype(np.int8), [0]]))
    # a text's last word and the next text's first may both be covered, but by different repeats
    cut = starts[some][1:]
    cut = cut[covered[cut] & covered[cut - 1]] if cut.size else cut
    span_starts = np.sort(np.concatenate([np.flatnonzero(edges == 1), cut]))
    span_stops = np.sort(np.concatenate([np.flatnonzero(edges == -1), cut]))
    owner = np.searchsorted(ends, span_starts, side="right")
    offsets = np.searchsorted(owner, np.arange(len(texts) + 1))
    spans = pa.StructArray.from_arrays(
        [pa.array(span_starts - starts[owner]), pa.array(span_stops - starts[owner])],
        ["start", "stop"])
    return pa.StructArray.from_arrays(
        [*map(pa.array, counts), pa.array(per_text(_covered(longest, WINDOW).astype(np.int64), np.add)),
         pa.array(per_text(covered.astype(np.int64), np.add)),
         pa.array(per_text(longest, np.maximum)),
         pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans)],
        ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words",
         "longest_repeat", "repeat_spans"])


def measures(text: Column | str, min_repeat: int = MIN_REPEAT) -> Column:
    """A struct of ``MEASURES``; a null text counts as one without words.

    ``repeat_spans`` are the united spans, in words, of all repeats of ``min_repeat`` words or more.
    """
    @arrow_udf(f"struct<{MEASURES.replace(' bigint', ':bigint').replace('repeat_spans ', 'repeat_spans:')}>")
    def measure(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in slices(batches):
            yield measure_slice(part, min_repeat)
    return measure.asNondeterministic()(text)  # else a filter on it would ask it twice


def base_failed(measured: Column) -> Column:
    """Too few words, or too many of them in windows that occur again."""
    return ((measured["n_words"] < MIN_WORDS)
            | (100 * measured["n_repeat_words"] > MAX_REPEAT_PERCENT * measured["n_words"]))


def repeats_allowed(measured: Column, max_covered: int = MAX_COVERED_PERCENT,
                    max_longest: int = MAX_LONGEST_PERCENT) -> Column:
    """The repeats cover few enough words, and the longest is short enough, both in percent."""
    return ((100 * measured["covered_words"] <= max_covered * measured["n_words"])
            & (100 * measured["longest_repeat"] <= max_longest * measured["n_words"]))


def quality(docs: DataFrame, text: str = "text", min_repeat: int = MIN_REPEAT,
            max_covered: int = MAX_COVERED_PERCENT, max_longest: int = MAX_LONGEST_PERCENT,
            into: str = "quality") -> DataFrame:
    """``docs`` with a struct ``into``: the measures, ``base_failed`` and ``kept``.

    One row per input row, repeated rows included; an existing column of that name is replaced. Null
    and empty texts have no words and fail. Nothing is shuffled.
    """
    measured = column(into)
    return docs.withColumn(into, measures(column(text), min_repeat)).withColumn(
        into, measured.withField("base_failed", base_failed(measured)).withField(
            "kept", ~base_failed(measured) & repeats_allowed(measured, max_covered, max_longest)))


def keep_good(docs: DataFrame, text: str = "text", **options: int) -> DataFrame:
    """The rows whose text passes, with the columns of ``docs``."""
    into = free_name(docs, "quality")
    judged = quality(docs, text, into=into, **options)
    return judged.filter(column(into)["kept"]).select(*columns(docs))
