import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from reviewloom.llm import sharding


def _rows(llm, n, text="same"):
    return llm.range(n).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"))


def test_sizes_and_slots_are_exact(llm):
    for n, shards, block in ((0, 16, 10), (1, 16, 10), (15, 16, 10), (1000, 16, 7), (1003, 5, 100_000)):
        out = sharding.shard_rows(_rows(llm, n), ["doc_id", "text"], shards, rows_per_block=block).collect()
        assert sorted(r["doc_id"] for r in out) == list(range(n))
        slots = {}
        for r in out:
            slots.setdefault(r["shard"], []).append(r["slot"])
        sizes = [len(slots.get(s, [])) for s in range(shards)]
        assert max(sizes) - min(sizes) <= 1
        assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_same_seed_same_answer(llm):
    def of(seed):
        return {r["doc_id"]: (r["shard"], r["slot"]) for r in
                sharding.shard_rows(_rows(llm, 300).repartition(3), ["doc_id"], 4, seed, 20).collect()}
    assert of(1) == of(1) != of(2)


def test_every_shard_takes_rows_from_everywhere(llm):
    out = sharding.shard_rows(_rows(llm, 4000), ["doc_id"], 4, rows_per_block=100).collect()
    shard = np.array([r["shard"] for r in sorted(out, key=lambda r: r["doc_id"])])
    for part in np.split(shard, 8):
        counts = np.bincount(part, minlength=4)
        assert abs(counts - 125).max() < 60  # six standard deviations
    slot = np.array([r["slot"] for r in sorted(out, key=lambda r: r["doc_id"])])
    assert abs(np.corrcoef(slot, np.arange(4000))[0, 1]) < 0.1


def test_nulls_repeats_and_clashing_names(llm):
    docs = llm.createDataFrame([(1, None, 9), (None, "x", 9), (1, None, 9), (1, None, 9)],
                               "doc_id bigint, text string, shard int").withColumn("part", F.lit("p"))
    out = sharding.shard_rows(docs, ["doc_id", "text"], 3)
    assert sorted(out.columns) == sorted(["doc_id", "text", "part", "shard", "slot"])
    rows = out.collect()
    assert Counter(r["doc_id"] for r in rows) == {1: 3, None: 1}
    assert sorted(Counter(r["shard"] for r in rows).values()) == [1, 1, 2]


def test_matrix_has_its_sums():
    rng = random.Random(2)
    for seed in range(30):
        rows = [rng.randrange(0, 500) for _ in range(rng.randrange(1, 9))]
        columns = sharding._even(sum(rows), rng.randrange(1, 9))
        matrix = sharding.communication_matrix(rows, columns, seed)
        assert [sum(r) for r in matrix] == rows and [sum(c) for c in zip(*matrix)] == columns


def test_draws_follow_the_law():
    rng = random.Random(9)
    for good, bad, sample in ((3, 5, 4), (40, 60, 30), (1000, 3000, 800), (10**9, 10**9, 10**6)):
        drawn = np.array([sharding.draw_hypergeometric(rng, good, bad, sample) for _ in range(4000)])
        share = good / (good + bad)
        variance = sample * share * (1 - share) * (good + bad - sample) / (good + bad - 1)
        assert abs(drawn.mean() - sample * share) < 5 * (variance / 4000) ** 0.5
        assert 0.9 < drawn.var() / variance < 1.1


def test_query(llm):
    from reviewloom.llm.queries import QUERIES
    import zlib
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in llm.read.parquet(f"{sf}/documents.parquet").collect()}
    df = QUERIES["op8_sharding"](llm, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "Cartesian"))
    rows = df.collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 1, zlib.crc32(data))
        assert r["law"] == "rows" and r["grown_shard"] is None
    sizes = Counter(r["shard"] for r in rows)
    assert set(sizes) == set(range(16)) and max(sizes.values()) - min(sizes.values()) <= 1
