"""Toxicity scores from logistic regression over hashed words, word pairs and skip-grams.

The model is fitted by FTRL-proximal: each weight has its own learning rate, and the L1 term leaves most
weights at exactly zero, so what is broadcast for scoring is small. Training rows are dealt to shards;
in each round every shard goes on from the same state, and the states are averaged.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from reviewloom.llm.batches import slices
from reviewloom.llm.columns import column
from reviewloom.llm.words import hashed_words
from reviewloom.session import land

#: Buckets of the hashed features, as a power of two: a model has 2**BITS weights at most (8 MB).
BITS = 20
#: The classifier is fitted on so many labelled rows at most, taken by a hash of their id.
MAX_TRAIN_ROWS = 40_000
ROWS_PER_SHARD = 20_000
ROUNDS = 6
ALPHA, BETA, L1, L2 = 2.0, 1.0, 6.0, 0.0
_SAMPLE_UNITS = 1 << 30


@dataclass(frozen=True)
class Model:
    """The weights that are not zero, by bucket, and the bias."""

    buckets: np.ndarray
    weights: np.ndarray
    bias: float


def feature_buckets(words: np.ndarray) -> list[np.ndarray]:
    """Buckets of each word, of it with the next word, and of it with the one after that."""
    shift = np.uint64(64 - BITS)
    mixed = words * np.uint64(0x9E3779B97F4A7C15)
    out = [mixed >> shift]
    for gap, salt in ((1, 0xC2B2AE3D27D4EB4F), (2, 0x165667B19E3779F9)):
        pair = (mixed[:-gap] ^ (words[gap:] + np.uint64(salt))) * np.uint64(0xFF51AFD7ED558CCD)
        pair ^= pair >> np.uint64(32)
        out.append((pair * np.uint64(0xC4CEB9FE1A85EC53)) >> shift)
    return [o.astype(np.int64) for o in out]


def slice_features(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every feature of all texts, repeats included, in no order."""
    words, bounds = hashed_words(texts)
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    owners, buckets = [], []
    for gap, found in enumerate(feature_buckets(words)):
        inside = owner[:owner.size - gap] == owner[gap:]  # not across two texts
        owners.append(owner[:owner.size - gap][inside])
        buckets.append(found[inside])
    return np.concatenate(owners), np.concatenate(buckets)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (label, order, text), each row's distinct buckets."""
    for batch in batches:
        texts = [t.as_py() for t in batch.column(2).cast(pa.large_binary())]
        owner, bucket = slice_features(texts)
        key = np.unique(owner << BITS | bucket)
        offsets = np.searchsorted(key, np.arange(len(texts) + 1) << BITS)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1),
             pa.ListArray.from_arrays(pa.array(offsets, pa.int32()),
                                      pa.array((key & (1 << BITS) - 1).astype(np.int32)))],
            ["label", "turn", "buckets"])


class _State:
    """FTRL-proximal state: ``z`` and ``n`` of each bucket, the bias last."""

    def __init__(self, z: np.ndarray, n: np.ndarray):
        self.z, self.n = z, n

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0.0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def bias(self) -> float:
        return float(-self.z[-1] / ((BETA + np.sqrt(self.n[-1])) / ALPHA))

    def learn(self, buckets: np.ndarray, label: int) -> None:
        w = np.append(self.weights(buckets), self.bias())
        at = np.append(buckets, self.z.size - 1)
        g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def _shard_round(state):
    """One pass over a shard, in the order of ``turn``; gives the changes of the state."""
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z, n = (part.astype(np.float64) for part in state.value)
        model = _State(z.copy(), n.copy())
        rows = 0
        for batch in batches:
            rows += batch.num_rows
            for label, buckets in zip(batch.column(0).to_pylist(), batch.column(1)):
                model.learn(np.asarray(buckets.values), label)
        if rows:
            at = np.flatnonzero((model.z != z) | (model.n != n))
            # and one row that counts the shard
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(at, -1).astype(np.int32)),
                 pa.array(np.append(model.z[at] - z[at], 1.0).astype(np.float32)),
                 pa.array(np.append(model.n[at] - n[at], 0.0).astype(np.float32))], ["bucket", "z", "n"])
    return learn


def train(docs: DataFrame, labels: DataFrame, eligible: Callable[[Column], Column] | None = None,
          doc_id: str = "doc_id", text: str = "text", label: str = "toxic", max_rows: int = MAX_TRAIN_ROWS) -> Model:
    """A model from the texts of labelled rows.

    ``eligible`` makes a condition on the id from its column. Labels are 0 or 1; rows without one are left out, and of
    several labels for one id the largest counts. About ``max_rows`` labelled rows are used, chosen by a
    hash of the id before texts meet labels; the whole text of each counts. Without rows every weight is 0.
    """
    spark = docs.sparkSession
    number = column(doc_id)
    marked = labels.select(number.alias("id"), column(label).cast("int").alias("label")).filter(
        F.col("label").isin(0, 1) & F.col("id").isNotNull())
    if eligible is not None:
        marked = marked.filter(eligible(F.col("id")))
    marked = marked.groupBy("id").agg(F.max("label").alias("label"))
    rows = marked.count()
    share = int(_SAMPLE_UNITS * min(1.0, max_rows / max(1, rows)))

    def chosen(column: Column) -> Column:
        return F.pmod(F.xxhash64(column, F.lit("sample")), F.lit(_SAMPLE_UNITS)) < share

    texts = docs.select(number.alias("id"), column(text).alias("text")).filter(chosen(F.col("id")))
    sample = texts.join(marked.filter(chosen(F.col("id"))), "id").select(
        "label", F.xxhash64("id", F.lit("turn")).alias("turn"), F.coalesce("text", F.lit("")).alias("text"))
    made = sample.mapInArrow(_features, "label int, turn bigint, buckets array<int>")
    shards = max(1, -(-min(rows, max_rows) // ROWS_PER_SHARD))
    # a file per shard, which each round reads again in its order
    dealt = land(made.repartition(shards, F.pmod(F.col("turn"), F.lit(shards)))
                 .sortWithinPartitions("turn").select("label", "buckets"), "features")
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    for _ in range(ROUNDS):
        state = spark.sparkContext.broadcast((z.astype(np.float32), n.astype(np.float32)))
        changes = dealt.mapInArrow(_shard_round(state), "bucket int, z float, n float")
        # one row per bucket at most, and the count of the shards
        total = changes.groupBy("bucket").agg(F.sum("z").alias("z"), F.sum("n").alias("n")).toArrow()
        state.destroy()  # its files would stay on every executor
        at, by = total["bucket"].to_numpy(), {c: total[c].to_numpy() for c in ("z", "n")}
        seen, real = by["z"][at < 0].sum(), at >= 0
        if seen:
            z[at[real]] += by["z"][real] / seen
            n[at[real]] += by["n"][real] / seen
    final = _State(z, n)
    weights = final.weights()[:-1]
    some = np.flatnonzero(weights)
    return Model(some, weights[some], final.bias())


def score(spark: SparkSession, model: Model, text: Column | str) -> Column:
    """The probability of label 1 for each text; null and empty texts get the bias alone."""
    shared = spark.sparkContext.broadcast(model)

    @arrow_udf("double")
    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = shared.value
        dense = np.zeros(1 << BITS)
        dense[known.buckets] = known.weights
        for part in slices(batches):
            owner, bucket = slice_features(part)
            hit = np.flatnonzero(dense[bucket])
            key = np.unique(owner[hit] << BITS | bucket[hit])
            total = np.full(len(part), known.bias)
            np.add.at(total, key >> BITS, dense[key & (1 << BITS) - 1])
            yield pa.array(1.0 / (1.0 + np.exp(-np.clip(total, -35, 35))))
    return scores.asNondeterministic()(text)  # never asked twice
