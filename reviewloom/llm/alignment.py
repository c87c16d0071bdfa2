"""Tokens of two tokenizers side by side, and how often each pair of ids stands linked.

Both tokenizers encode the whole text. Their tokens' bytes give the offsets where tokens end; an offset
where both end cuts the tokens into groups. White-space anchors make this cheap: at a shared end after
which both tokenizers go on with a token that begins with a space, a document is cut into windows of
token ids. Windows repeat like words do, so the groups and links of a window are worked out once and
kept by its two tuples of ids.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
from array import array
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from reviewloom.llm.columns import column
from reviewloom.operators.skew import spread_join
from reviewloom.session import land

#: Fixed value: how byte-level tokenizers cut texts into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Text that is tokenised at once.
SLICE_BYTES = 500_000
#: Windows remembered by a task; a fuller memory starts anew, which costs time and changes nothing.
MAX_WINDOWS = 600_000
#: The counts of so many id pairs are broadcast (12 bytes each); more of them are joined.
BROADCAST_PAIRS = 2_000_000
#: Links expanded at once when a slice's links are counted.
_LINKS = 4_000_000
_MARK = array("i", [-1]).tobytes()
#: Links of a group that are listed one by one.
_FEW = 64

_ALIGNED = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]


def _byte_of() -> dict[str, int]:
    """Byte-level tokenizers write each byte as a visible character: its own, else one from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {**{chr(b): b for b in visible}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


class ByteLevel:
    """A byte-level BPE of the ``tokenizers`` library, by its JSON file; encodes a space before the text.

    Where the file says that ids follow the order of the merges and words are cut by the usual pattern, as byte-level
    vocabularies do, ``tiktoken`` replays the same merges some four times faster; other files go to their own library.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = file.read()
        model = json.loads(content)
        byte_of = _byte_of()
        vocabulary = model["model"]["vocab"]
        special = {t["content"] for t in model.get("added_tokens", [])}
        self.pieces = [b""] * (1 + max(vocabulary.values()))
        for piece, number in vocabulary.items():
            if piece not in special:
                self.pieces[number] = bytes(map(byte_of.__getitem__, piece))
        self.lossless = _merges_by_id(model, len(byte_of))  # each byte is a token, and merges only join them
        if self.lossless:
            ranks = {piece: number for number, piece in enumerate(self.pieces) if piece}
            fast = tiktoken.Encoding("byte level", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
            self.encode = lambda texts: [fast.encode_ordinary(" " + t) for t in texts]
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            own = Tokenizer.from_str(content)
            own.encode_special_tokens = True
            self.encode = lambda texts: [e.ids for e in own.encode_batch_fast([" " + t for t in texts],
                                                                              add_special_tokens=False)]


def _merges_by_id(model: dict, n_bytes: int) -> bool:
    """Whether the ids are the bytes, then the merges in their order, and nothing else shapes the text."""
    bpe, words = model["model"], model.get("pre_tokenizer") or {}
    merges = [m.split(" ") if isinstance(m, str) else m for m in bpe.get("merges", [])]
    return (bpe.get("type") == "BPE" and not bpe.get("dropout") and not bpe.get("ignore_merges")
            and not bpe.get("continuing_subword_prefix") and not bpe.get("end_of_word_suffix")
            and not model.get("normalizer") and words.get("type") == "ByteLevel"
            and not words.get("add_prefix_space") and words.get("use_regex", True)
            and all(bpe["vocab"].get(a + b) == n_bytes + i for i, (a, b) in enumerate(merges)))


class Pieces:
    """A model of the ``sentencepiece`` library, by its file; it adds the space before the text itself."""

    lossless = False  # the file may normalise texts

    def __init__(self, path: str):
        self._model = SentencePieceProcessor(model_file=path)
        self.pieces = []
        for i in range(self._model.get_piece_size()):
            piece = self._model.id_to_piece(i)
            self.pieces.append(bytes([int(piece[3:5], 16)]) if self._model.is_byte(i) else
                               b"" if self._model.is_control(i) or self._model.is_unknown(i) else
                               piece.replace("▁", " ").encode())

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode(texts, num_threads=1)


@lru_cache(maxsize=4)
def _loaded(kind: Callable, path: str):
    tokenizer = kind(path)
    pieces = tokenizer.pieces
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    spaced = np.fromiter((p.startswith(b" ") for p in pieces), bool, len(pieces))
    return tokenizer, lengths, spaced


class Windows:
    """Groups and links of windows of token ids, each worked out once."""

    def __init__(self, len_a: np.ndarray, len_b: np.ndarray):
        self._len_a, self._len_b, self._size_b = len_a.tolist(), len_b.tolist(), len_b.size
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = {}  # by the ids of both sides, as bytes with a mark between them
        self.text: list[str] = []
        self.n_groups, self.n_links = array("q"), array("q")
        # the distinct linked pairs of all windows, how often each is linked, and where a window's begin
        self.pairs, self.times, self.bounds = array("q"), array("q"), array("q", [0])

    def add(self, key: bytes) -> int:
        ids = array("i", key).tolist()
        cut = ids.index(-1)
        a, b = ids[:cut], ids[cut + 1:]
        len_a, len_b = self._len_a, self._len_b
        text, links, n_links = [], {}, 0
        from_a = from_b = i = j = end_a = end_b = 0
        for x in a:
            end_a += len_a[x]
            i += 1
            while end_b < end_a:
                end_b += len_b[b[j]]
                j += 1
            if end_a != end_b:
                continue
            if i - from_a == 1 == j - from_b:
                y = b[from_b]
                text.append(f"{x}|{y}")
                pair = x * self._size_b + y
                links[pair] = links.get(pair, 0) + 1
                n_links += 1
            else:
                of_a, of_b = a[from_a:i], b[from_b:j]
                text.append(f"{','.join(map(str, of_a))}|{','.join(map(str, of_b))}")
                here = len(of_a) * len(of_b)
                n_links += here
                if here <= _FEW:
                    for left in of_a:
                        for right in of_b:
                            pair = left * self._size_b + right
                            links[pair] = links.get(pair, 0) + 1
                else:  # equal ids once, so that a long group is no list of all its links
                    times_b = Counter(of_b).items()
                    for left, n in Counter(of_a).items():
                        for right, m in times_b:
                            pair = left * self._size_b + right
                            links[pair] = links.get(pair, 0) + n * m
            from_a, from_b = i, j
        self.text.append(";".join(text))
        self.n_groups.append(len(text))
        self.n_links.append(n_links)
        self.pairs.extend(links.keys())
        self.times.extend(links.values())
        self.bounds.append(len(self.pairs))
        self.number[key] = number = len(self.text) - 1
        return number


def _windows_of(a: np.ndarray, b: np.ndarray, a_side, b_side, windows: Windows) -> tuple[list[int], np.ndarray]:
    """Numbers of the windows of some documents' tokens, one document after the other, and where in ``a`` they end.

    Both sides of each document hold the same bytes, so a document's end is a shared one.
    """
    (_, len_a, spaced_a), (_, len_b, spaced_b) = a_side, b_side
    ends_a, ends_b = np.cumsum(len_a[a]), np.cumsum(len_b[b])
    place = np.searchsorted(ends_b, ends_a)
    at = np.flatnonzero(ends_b[np.minimum(place, ends_b.size - 1)] == ends_a)  # verified shared ends
    to_b = place[at]
    last = at == a.size - 1
    marked = spaced_a[a[np.minimum(at + 1, a.size - 1)]] & spaced_b[b[np.minimum(to_b + 1, b.size - 1)]]
    anchor = last | marked  # every document begins with a space
    stops = at[anchor] + 1
    ids_a, ids_b = a.tobytes(), b.tobytes()
    number, add, found = windows.number.get, windows.add, []
    from_a = from_b = 0
    for stop_a, stop_b in zip((stops * 4).tolist(), ((to_b[anchor] + 1) * 4).tolist()):
        key = ids_a[from_a:stop_a] + _MARK + ids_b[from_b:stop_b]
        known = number(key)
        found.append(add(key) if known is None else known)
        from_a, from_b = stop_a, stop_b
    return found, stops


def _gives_back(tokenizer, ids: list[int], whole: bytes) -> bool:
    return tokenizer.lossless or b"".join(map(tokenizer.pieces.__getitem__, ids)) == whole


def _align(texts: list[str | None], a_side, b_side, windows: Windows) -> list[tuple[int, int, list[int]]]:
    """For each text its numbers of tokens and its windows; texts without tokens have none."""
    asked = [i for i, t in enumerate(texts) if t]
    fitting, all_a, all_b = [], [], []
    some = [texts[i] for i in asked]
    for i, a, b in zip(asked, a_side[0].encode(some), b_side[0].encode(some)):
        whole = b" " + texts[i].encode()
        if _gives_back(a_side[0], a, whole) and _gives_back(b_side[0], b, whole):
            fitting.append((i, len(a), len(b)))
            all_a.append(np.array(a, np.int32))
            all_b.append(np.array(b, np.int32))
    found: list[tuple[int, int, list[int]]] = [(0, 0, [])] * len(texts)
    if fitting:
        numbers, stops = _windows_of(np.concatenate(all_a), np.concatenate(all_b), a_side, b_side, windows)
        ends = np.searchsorted(stops, np.cumsum([n for _, n, _ in fitting]), side="right").tolist()
        for (i, n_a, n_b), start, stop in zip(fitting, [0, *ends], ends):
            found[i] = n_a, n_b, numbers[start:stop]
    return found


def _link_counts(documents: list[list[int]], windows: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ``document, pair`` with the number of links, in that order."""
    doc = np.repeat(np.arange(len(documents)), [len(d) for d in documents])
    window = np.fromiter(itertools.chain.from_iterable(documents), np.int64, doc.size)
    # equal windows of one document once, with their number
    of_all = max(1, len(windows.text))
    both, repeats = np.unique(doc * np.int64(of_all) + window, return_counts=True)
    doc, window = np.divmod(both, of_all)
    all_pairs, all_times, bounds = map(np.array, (windows.pairs, windows.times, windows.bounds))
    starts = bounds[window]
    sizes = bounds[window + 1] - starts
    done: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(3)]
    cuts = _pieces_of(doc, sizes)
    for start, stop in zip(cuts, cuts[1:]):
        size = sizes[start:stop]
        at = np.arange(size.sum()) + np.repeat(starts[start:stop] - np.cumsum(size) + size, size)
        pairs, times = all_pairs[at], all_times[at] * np.repeat(repeats[start:stop], size)
        of = np.repeat(doc[start:stop], size)
        order = np.lexsort((pairs, of))
        pairs, times, of = pairs[order], times[order], of[order]
        first = np.flatnonzero(np.concatenate([[True], (pairs[1:] != pairs[:-1]) | (of[1:] != of[:-1])]))
        for column_, values in zip(done, (of[first], pairs[first], np.add.reduceat(times, first))):
            column_.append(values)
    return tuple(map(np.concatenate, done))


def _pieces_of(doc: np.ndarray, sizes: np.ndarray) -> list[int]:
    """Cuts between documents, so that about ``_LINKS`` links lie between two cuts."""
    if not doc.size:
        return []
    starts = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    before = np.concatenate([[0], np.cumsum(sizes)])[starts] // _LINKS
    return [*starts[np.concatenate([[True], before[1:] != before[:-1]])].tolist(), doc.size]


def _aligner(a: tuple[Callable, str], b: tuple[Callable, str], pair_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_side, b_side = _loaded(*a), _loaded(*b)
        windows = Windows(a_side[1], b_side[1])

        def aligned(ids: pa.Array, texts: list[str | None]) -> pa.RecordBatch:
            if len(windows.text) > MAX_WINDOWS:
                windows.clear()
            found = _align(texts, a_side, b_side, windows)
            documents = [d[2] for d in found]
            doc, pairs, times = _link_counts(documents, windows)
            bounds = pa.array(np.searchsorted(doc, np.arange(len(texts) + 1)).astype(np.int32))
            groups, links = np.array(windows.n_groups, np.int64), np.array(windows.n_links, np.int64)
            digests = [hashlib.sha256(";".join(map(windows.text.__getitem__, d)).encode()).hexdigest() if d else ""
                       for d in documents]
            return pa.RecordBatch.from_arrays([
                ids, pa.array([d[0] for d in found], pa.int64()),
                pa.array([d[1] for d in found], pa.int64()),
                pa.array([int(groups[d].sum()) if d else 0 for d in documents], pa.int64()),
                pa.array([int(links[d].sum()) if d else 0 for d in documents], pa.int64()), pa.array(digests, pa.string()),
                pa.ListArray.from_arrays(bounds, pa.array(pairs).cast(pair_type)),
                pa.ListArray.from_arrays(bounds, pa.array(times))], _ALIGNED)

        for batch in batches:
            start, texts, size = 0, [], 0
            for text in batch.column(1):
                texts.append(text.as_py())
                size += len(texts[-1] or "")
                if size >= SLICE_BYTES:
                    yield aligned(batch.column(0).slice(start, len(texts)), texts)
                    start, texts, size = start + len(texts), [], 0
            if texts:
                yield aligned(batch.column(0).slice(start, len(texts)), texts)
    return run


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """``pair, a, b, n_docs, best``: how many rows hold an id pair linked, and whether its A id has no larger count."""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(
        F.count(F.lit(1)).alias("n_docs"))
    a = F.call_function("div", "pair", F.lit(size_b)).cast("int")
    counts = counts.select("pair", a.alias("a"), F.pmod("pair", F.lit(size_b)).cast("int").alias("b"), "n_docs")
    most = counts.groupBy("a").agg(F.max("n_docs").alias("most"))
    return counts.join(most, "a").select("pair", "a", "b", "n_docs", (F.col("n_docs") == F.col("most")).alias("best"))


def _scorer(known):
    """Adds up counts by the broadcast table of ``pair, n_docs, best``, sorted by pair."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n_docs, best = known.value
        for batch in batches:
            pairs, times = batch.column(1), batch.column(2).flatten().to_numpy()
            bounds = pairs.offsets.to_numpy() - pairs.offsets[0].as_py()
            at = np.searchsorted(pair, pairs.flatten().to_numpy())
            sums = []
            for values in (times * best[at], times * n_docs[at]):
                total = np.concatenate([[0], np.cumsum(values)])
                sums.append(pa.array(total[bounds[1:]] - total[bounds[:-1]]))
            yield pa.RecordBatch.from_arrays([batch.column(0), *sums], ["row", "n_best", "count_sum"])
    return run


def _scores(linked: DataFrame, counts: DataFrame, broadcast_pairs: int) -> DataFrame:
    """``row, n_best, count_sum`` of every row that has links."""
    if counts.count() <= broadcast_pairs:
        table = counts.select("pair", "n_docs", F.col("best").cast("bigint")).orderBy("pair").toArrow()
        known = linked.sparkSession.sparkContext.broadcast([c.to_numpy() for c in table.columns])
        return linked.mapInArrow(_scorer(known), "row bigint, n_best bigint, count_sum bigint")
    each = linked.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select(
        "row", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times"))
    # a few pairs stand in most documents, so the rows of a hot one are dealt over salts
    return spread_join(each, counts.select("pair", "n_docs", "best"), ["pair"]).groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("n_docs")).alias("count_sum"))


def align(docs: DataFrame, a: tuple[Callable, str], b: tuple[Callable, str], doc_id: str = "doc_id",
          text: str = "text", broadcast_pairs: int = BROADCAST_PAIRS) -> tuple[DataFrame, DataFrame]:
    """Two tables: one row per row of ``docs``, and one per linked pair of ids.

    The first holds ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``, the second
    ``a, b, n_docs, best``. ``a`` and ``b`` are each a class (``ByteLevel``, ``Pieces``) and the file it reads,
    which every executor must find. Null and empty texts, and texts that a tokenizer does not give back
    byte by byte, have zeros and an empty digest. Rows with null or equal ids are rows like any other, and
    each counts as a document; an empty table gives two empty ones.
    """
    size_a, size_b = len(_loaded(*a)[0].pieces), len(_loaded(*b)[0].pieces)
    kind, pair_type = ("int", pa.int32()) if size_a * size_b < 1 << 31 else ("bigint", pa.int64())
    chosen = docs.select(column(doc_id).alias("doc_id"), column(text).cast("string").alias("text"))
    schema = (f"doc_id {chosen.schema['doc_id'].dataType.simpleString()}, n_a bigint, n_b bigint, n_groups bigint, "
              f"n_links bigint, groups_sha256 string, pairs array<{kind}>, times array<bigint>")
    # the numbers are fixed by landing them
    aligned = land(chosen.mapInArrow(_aligner(a, b, pair_type), schema).withColumn(
        "row", F.monotonically_increasing_id()), "aligned")
    counts = land(pair_counts(aligned, size_b), "pairs")
    scores = _scores(aligned.filter(F.size("pairs") > 0).select("row", "pairs", "times"), counts, broadcast_pairs)
    rows = aligned.join(scores, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256")
    return rows, counts.select("a", "b", "n_docs", "best")
