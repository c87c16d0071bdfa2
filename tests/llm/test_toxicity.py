import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewloom.llm import toxicity

BAD = ["vile", "rotten", "nasty", "awful"]


@pytest.fixture(scope="module")
def world(spark):
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(600):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(5, 80))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def _held(c):
    return F.crc32(c.cast("string")) % 3 == 1


def test_held_out_rows(llm, documents, world):
    rows, labels = world
    marks = llm.createDataFrame(labels + [(None, 1), (5, None), (9999, 1), (5, 1), (5, 1)],
                                "doc_id bigint, toxic int")
    docs = documents(rows)
    model = toxicity.train(docs, marks, lambda c: ~_held(c))
    scores = {r["doc_id"]: r["s"] for r in docs.withColumn("s", toxicity.score(llm, model, "text")).collect()}
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    toxic = dict(labels)
    assert all(0 <= s <= 1 for s in scores.values())
    assert np.mean([scores[i] >= 0.7 for i in held if toxic[i]]) > 0.9
    assert np.mean([scores[i] >= 0.7 for i in held if not toxic[i]]) < 0.02
    assert model.weights.size < 2000, "few weights are not zero"


def test_held_out_labels_change_nothing(llm, documents, world):
    rows, labels = world
    docs = documents(rows[:200])
    wrong = [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, y in labels]
    models = [toxicity.train(docs, llm.createDataFrame(x, "doc_id bigint, toxic int"), lambda c: ~_held(c))
              for x in (labels, wrong)]
    assert np.array_equal(models[0].buckets, models[1].buckets)
    assert np.allclose(models[0].weights, models[1].weights)


def test_odd_rows_and_no_labels(llm, documents):
    docs = documents([(1, None), (2, ""), (3, "x " * 30000), (None, "vile"), (3, "x")])
    none = llm.createDataFrame([], "doc_id bigint, toxic int")
    model = toxicity.train(docs, none)
    rows = docs.withColumn("s", toxicity.score(llm, model, "text")).collect()
    assert [r["s"] for r in rows] == [0.5] * 5
    assert documents([]).withColumn("s", toxicity.score(llm, model, "text")).count() == 0


def test_features_are_words_pairs_and_skips():
    owner, bucket = toxicity.slice_features([b"A b c", None, b"a", b"x b c"])
    assert np.bincount(owner, minlength=4).tolist() == [6, 0, 1, 6]
    mine, other = set(bucket[owner == 0].tolist()), set(bucket[owner == 3].tolist())
    assert len(mine & other) == 3  # b, c, and b with c
    assert set(bucket[owner == 2].tolist()) <= mine


def test_sample_is_bounded(llm, documents, world):
    rows, labels = world
    model = toxicity.train(documents(rows), llm.createDataFrame(labels, "doc_id bigint, toxic int"), max_rows=50)
    assert model.weights.size < 2000


def test_query(llm):
    from reviewloom.llm.queries import QUERIES
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op1_toxicity"](llm, sf).collect()
    assert len(rows) == llm.read.parquet(f"{sf}/documents.parquet").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert r["predicted"] == int(r["score"] >= 0.7) and 0 <= r["score"] <= 1
    toxic = {r["doc_id"]: r["toxic"] for r in llm.read.parquet(f"{sf}/labels.parquet").collect()}
    known = [r for r in rows if r["doc_id"] in toxic and r["held_out"]]
    high = [r["score"] for r in known if toxic[r["doc_id"]]]
    low = [r["score"] for r in known if not toxic[r["doc_id"]]]
    assert np.mean([[a > b for b in low] for a in high]) > 0.8
