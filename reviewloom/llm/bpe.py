"""Byte-level BPE: texts to packed token ids and back.

A slice of the corpus is encoded at once. Its texts are split into words by the vocabulary's pattern,
equal words are taken once, and the merges are replayed over all of them: an inverted index leads from
a merge to the word positions where it applies, merges are taken in rank order, and each one looks
anew only at the neighbours it touched. Words do not influence each other, so slices of any size give
the same ids, and no word ever has to leave the task that read it.
"""

from __future__ import annotations

import base64
import heapq
import itertools
import os
import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql.functions import arrow_udf

from reviewloom.llm.batches import slices

MAX_RANK_FILE_BYTES = 64_000_000
#: Text encoded at once; a task that also decodes holds two workers.
SLICE_BYTES = 4_000_000
ENCODED = "struct<n_tokens:bigint,ids:binary>"
ID_TYPE = np.dtype("<u4")
_NONE = np.int32(2**31 - 1)
# Every word of a pattern that lets only a single leading space stand before other characters, and
# splits other white space as below, lies within one such chunk. Chunks repeat, so the pattern itself
# is only asked of the distinct ones.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CHUNK = re.compile(rf" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")


def _ranks(rank_file: bytes) -> dict[bytes, int]:
    return {base64.b64decode(piece): int(rank)
            for piece, rank in map(bytes.split, rank_file.splitlines()) if piece}


@lru_cache(maxsize=4)
def _pieces(rank_file: bytes) -> dict[int, bytes]:
    return {rank: piece for piece, rank in _ranks(rank_file).items()}


class Vocabulary:
    """Ranks of a byte-level BPE: the pieces, and for two adjacent pieces the piece they merge into."""

    def __init__(self, rank_file: bytes, pattern: str):
        self.rank_of = _ranks(rank_file)
        self.pattern = regex.compile(pattern)
        self.size = max(self.rank_of.values()) + 1
        self.byte_ids = np.array([self.rank_of[bytes([b])] for b in range(256)], np.int32)
        pairs = sorted((self.rank_of[piece[:cut]] * self.size + self.rank_of[piece[cut:]], rank)
                       for piece, rank in self.rank_of.items() for cut in range(1, len(piece))
                       if piece[:cut] in self.rank_of and piece[cut:] in self.rank_of)
        self._pairs = np.array([p for p, _ in pairs] + [2**62], np.int64)
        self._merged = np.array([r for _, r in pairs] + [_NONE], np.int32)
        every = np.repeat(self.byte_ids, 256), np.tile(self.byte_ids, 256)
        self.byte_pairs = self.merged(*every).reshape(256, 256)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the piece that each pair merges into; ``_NONE`` where there is none."""
        key = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self._pairs, key)
        return np.where((self._pairs[at] == key) & (right >= 0), self._merged[at], _NONE)


@lru_cache(maxsize=4)
def _vocabulary(rank_file: bytes, pattern: str) -> Vocabulary:
    return Vocabulary(rank_file, pattern)


def _one_word(word: bytes, vocab: Vocabulary) -> list[int]:
    """The merges of one word, one at a time: lowest rank first, leftmost among equals."""
    pieces = [word[i:i + 1] for i in range(len(word))]
    while len(pieces) > 1:
        rank, at = min((vocab.rank_of.get(pieces[i] + pieces[i + 1], vocab.size), i)
                       for i in range(len(pieces) - 1))
        if rank == vocab.size:
            break
        pieces[at:at + 2] = [pieces[at] + pieces[at + 1]]
    return [vocab.rank_of[p] for p in pieces]


def _leftmost(pos: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Of merges that share a piece with the next one, every second from the left."""
    chained = np.concatenate([[False], following[:-1] == pos[1:]])
    if not chained.any():
        return pos
    index = np.arange(pos.size)
    run_start = np.maximum.accumulate(np.where(chained, 0, index))
    return pos[(index - run_start) % 2 == 0]


def replay_merges(words: list[bytes], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all words, one after the other, and where each word's ids begin (and the last end)."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths)
    starts, n = ends - lengths, int(lengths.sum())
    data = np.frombuffer(b"".join(words), np.uint8)
    token = np.append(vocab.byte_ids[data], np.int32(-1))
    after, before = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
    after[ends - 1] = n
    before[starts] = n
    rank_at = np.full(n + 1, _NONE, np.int32)
    rank_at[:n - 1] = vocab.byte_pairs[data[:-1], data[1:]]
    rank_at[ends - 1] = _NONE

    order = np.flatnonzero(rank_at < _NONE).astype(np.int32)
    order = order[np.argsort(rank_at[order], kind="stable")]
    found, first = np.unique(rank_at[order], return_index=True)
    places: dict[int, list[np.ndarray]] = {
        rank: [part] for rank, part in zip(found.tolist(), np.split(order, first[1:]))}
    pending = found.tolist()  # ascending, hence a heap
    odd: list[np.ndarray] = []
    while pending:
        rank = heapq.heappop(pending)
        parts = places.pop(rank)
        pos = parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))
        pos = pos[rank_at[pos] == rank]
        if not pos.size:
            continue
        pos = _leftmost(pos, after[pos])
        gone = after[pos]
        beyond = after[gone]
        token[pos] = rank
        token[gone] = -1
        after[pos] = beyond
        before[beyond] = pos
        rank_at[gone] = _NONE
        left = before[pos]
        touched = np.concatenate([pos, left[left < n]])
        now = vocab.merged(token[touched], token[after[touched]])
        rank_at[touched] = now
        some = now < _NONE
        touched, now = touched[some], now[some]
        if not touched.size:
            continue
        if now.min() < rank:  # would have come before the rest of this rank in its word
            odd.append(touched[now < rank])
        if touched.size == 1:
            groups = [(int(now[0]), touched)]
        else:
            by = np.argsort(now, kind="stable")
            now, touched = now[by], touched[by]
            cuts = np.flatnonzero(now[1:] != now[:-1]) + 1
            heads = now[np.concatenate([[0], cuts])].tolist()
            bounds = [0, *cuts.tolist(), touched.size]
            groups = [(r, touched[bounds[i]:bounds[i + 1]]) for i, r in enumerate(heads)]
        for r, part in groups:
            if r in places:
                places[r].append(part)
            else:
                places[r] = [part]
                heapq.heappush(pending, r)
    token = token[:n]
    live = token >= 0
    counts = np.add.reduceat(live, starts, dtype=np.int64) if n else np.zeros(0, np.int64)
    ids, offsets = token[live], np.concatenate([[0], np.cumsum(counts)])
    if odd:
        again = np.unique(np.searchsorted(ends, np.concatenate(odd), side="right")).tolist()
        parts = np.split(ids, offsets[1:-1])
        for w in again:
            parts[w] = np.array(_one_word(words[w], vocab), np.int32)
        ids = np.concatenate(parts)
        offsets = np.concatenate([[0], np.cumsum([p.size for p in parts])])
    return ids, offsets


def _gather(begin: np.ndarray, size: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the entries that ``codes`` name, one after the other, and where each one's begin."""
    sizes = size[codes]
    stops = np.concatenate([[0], np.cumsum(sizes)])
    return np.arange(stops[-1]) + np.repeat(begin[codes] - stops[:-1], sizes), stops


class _Numbering(defaultdict):
    """Numbers items in order of first sight."""

    def __init__(self):
        super().__init__(itertools.count().__next__)

    def of(self, items: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, items), np.int32, len(items))


def _word_ids(words: list[str], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of distinct words, with where each word's begin and how many they are.

    A word that is a piece has that piece's id; the others go through the merges.
    """
    packed = [w.encode() for w in words]
    whole = np.fromiter((vocab.rank_of.get(w, -1) for w in packed), np.int64, len(packed))
    cut, single = np.flatnonzero(whole < 0), np.flatnonzero(whole >= 0)
    ids, offsets = replay_merges([packed[i] for i in cut.tolist()], vocab)
    begin, size = np.zeros(len(words), np.int64), np.ones(len(words), np.int64)
    begin[cut], size[cut] = offsets[:-1], np.diff(offsets)
    begin[single] = ids.size + np.arange(single.size)
    return np.concatenate([ids, whole[single].astype(np.int32)]), begin, size


def encode_slice(texts: list[bytes | None], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all texts, one after the other, and where each text's ids begin."""
    chunks, words = _Numbering(), _Numbering()
    chunk_of = [chunks.of(_CHUNK.findall(text.decode()) if text else []) for text in texts]
    found: list[str] = []
    word_ends = np.zeros(len(chunks) + 1, np.int64)
    for i, chunk in enumerate(chunks, 1):
        found += vocab.pattern.findall(chunk)
        word_ends[i] = len(found)
    word_of = words.of(found)
    ids, begin, size = _word_ids(list(words), vocab)
    flat, bounds = _gather(begin, size, word_of)
    ids, bounds = ids[flat], bounds[word_ends]  # now of the distinct chunks
    text_ends = np.cumsum([0, *(c.size for c in chunk_of)])
    flat, stops = _gather(bounds[:-1], np.diff(bounds),
                          np.concatenate([np.zeros(0, np.int32), *chunk_of]))
    return ids[flat], stops[text_ends]


class BytePairEncoding:
    """Columns that encode and decode by a rank file.

    The file is read once on the driver and travels with the functions; files beyond
    ``MAX_RANK_FILE_BYTES`` are refused. ``pattern`` splits a text into words before the merges.
    """

    def __init__(self, spark: SparkSession, rank_path: str, pattern: str):
        if os.path.getsize(rank_path) > MAX_RANK_FILE_BYTES:
            raise ValueError(f"{rank_path} is larger than {MAX_RANK_FILE_BYTES} bytes")
        with open(rank_path, "rb") as file:
            ranks = spark.sparkContext.broadcast(file.read())
        self._encode = _encoder(lambda: _vocabulary(ranks.value, pattern))
        self._decode = _decoder(lambda: _pieces(ranks.value))
        self._count = _counter(lambda: _vocabulary(ranks.value, pattern))

    def encode(self, text: Column | str) -> Column:
        """``struct(n_tokens, ids)``; ``ids`` packs unsigned 32-bit little-endian ids.

        Null and empty texts have no token. Special tokens are ordinary text.
        """
        return self._encode(text)

    def decode(self, ids: Column | str) -> Column:
        """The bytes that packed ids stand for; null gives none."""
        return self._decode(ids)

    def count(self, text: Column | str) -> Column:
        """The number of tokens alone."""
        return self._count(text)


def _encoder(vocabulary: Callable[[], Vocabulary]):
    @arrow_udf(ENCODED)
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocab = vocabulary()
        for part in slices(batches, SLICE_BYTES):
            ids, bounds = encode_slice(part, vocab)
            data, cuts = ids.astype(ID_TYPE).tobytes(), (bounds * ID_TYPE.itemsize).tolist()
            yield pa.StructArray.from_arrays(
                [pa.array(np.diff(bounds)),
                 pa.array([data[a:b] for a, b in zip(cuts, cuts[1:])], pa.binary())],
                ["n_tokens", "ids"])
    return encode.asNondeterministic()  # never asked twice


def _counter(vocabulary: Callable[[], Vocabulary]):
    @arrow_udf("bigint")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocab = vocabulary()
        for part in slices(batches, SLICE_BYTES):
            yield pa.array(np.diff(encode_slice(part, vocab)[1]))
    return count.asNondeterministic()  # never asked twice


def _decoder(pieces: Callable[[], dict[int, bytes]]):
    @arrow_udf("binary")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        piece = pieces()
        for packed in batches:
            yield pa.array([b"".join(map(piece.__getitem__,
                                         np.frombuffer(ids.as_py() or b"", ID_TYPE).tolist()))
                            for ids in packed], pa.binary())
    return decode.asNondeterministic()  # never asked twice
