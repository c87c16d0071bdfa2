import random

import pytest
from pyspark.sql import functions as F

from reviewloom.operators import skew
from reviewloom.operators.skew import number_rows, spread_join


def numbered_by_hand(rows):
    by_key = {}
    for k, v in rows:
        by_key.setdefault(k, []).append(v)
    return {(k, v): i for k, vs in by_key.items() for i, v in enumerate(sorted(vs), 1)}


@pytest.fixture(scope="module")
def uneven(spark):
    rnd = random.Random(1)
    values = rnd.sample(range(-500, 500), 400) + rnd.sample(range(10**15, 10**15 + 900), 300)
    rows = [("hot", v) for v in values] + [(f"k{v % 30}", v) for v in range(300)]
    return rows, spark.createDataFrame(rows, "k string, v long").repartition(5).cache()


@pytest.mark.parametrize("split", [1, 7, 50, 10**6])
def test_numbering_is_exact_for_any_block_size(uneven, split):
    rows, df = uneven
    got = {(r.k, r.v): r.n for r in number_rows(df, ["k"], "v", "n", rows_per_split=split).collect()}
    assert got == numbered_by_hand(rows)


@pytest.mark.parametrize("split", [5, 10**6])
@pytest.mark.parametrize("cap", [1, 40, 650])
def test_numbering_up_to_a_cap(uneven, split, cap):
    rows, df = uneven
    got = {(r.k, r.v): r.n
           for r in number_rows(df, ["k"], "v", "n", cap, rows_per_split=split).collect()}
    assert got == {kv: n for kv, n in numbered_by_hand(rows).items() if n <= cap}


def test_numbering_without_keys(spark):
    df = spark.range(1000).withColumn("v", F.col("id") * 37 - 500).repartition(4)
    got = sorted((r.v, r.n) for r in number_rows(df, [], "v", "n", rows_per_split=13).collect())
    assert [n for _, n in got] == list(range(1, 1001))


def test_numbering_over_the_whole_bigint_range(spark):
    values = [-2**63, -2**62, -5, -1, 0, 1, 3, 2**62, 2**63 - 1]
    df = spark.createDataFrame([("k", v) for v in values], "k string, v long")
    got = sorted((r.v, r.n) for r in number_rows(df, ["k"], "v", "n", rows_per_split=2).collect())
    assert got == list(zip(values, range(1, 10)))


def test_blocks_are_alike_whatever_the_values_are(spark):
    """One far value would leave blocks of equal width all but one empty."""
    values = [*range(99_999), 10**15]
    df = spark.createDataFrame([(v,) for v in values], "v long").withColumn("k", F.lit("hot"))
    numbered = number_rows(df, ["k"], "v", "n", rows_per_split=1000)
    assert sorted((r.v, r.n) for r in numbered.collect()) == list(zip(values, range(1, 100_001)))
    sizes = block_sizes(df, 1000)
    assert sum(sizes) == 100_000 and max(sizes) <= 2000 and len(sizes) >= 50


def block_sizes(df, split):
    """Rows per block, seen through a numbering that does not add the blocks up."""
    bare = skew.F.coalesce
    try:
        skew.F.coalesce = lambda *cols: F.lit(0)  # every block then starts at 1
        plan = number_rows(df, ["k"], "v", "n", rows_per_split=split)
    finally:
        skew.F.coalesce = bare
    firsts = sorted(r.v for r in plan.filter("n = 1").collect())
    values = sorted(r.v for r in df.collect())
    places = [values.index(v) for v in firsts] + [len(values)]
    return [b - a for a, b in zip(places, places[1:])]


def test_every_key_above_the_limit_is_spread(spark):
    """However many there are: none is left to one task because others are larger."""
    df = spark.range(60_000).select(F.concat(F.lit("k"), F.col("id") % 12_000).alias("k"), "id")
    counts = df.groupBy("k").agg(F.count("*").alias("n"))
    hot = skew._hottest(counts, ["k"], "n", 4, F.col("n"), "value")
    assert hot.count() == 12_000
    joined = spread_join(df, counts.drop("n").withColumn("x", F.lit(1)), ["k"], rows_per_split=4)
    assert joined.count() == 60_000


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
@pytest.mark.parametrize("split", [1, 20, 10**6])
def test_spread_join_equals_a_plain_join(uneven, spark, how, split):
    _, df = uneven
    lookup = spark.createDataFrame([("hot", 1.0), ("k1", 2.0), ("k2", None), ("other", 3.0)],
                                   "k string, x double")
    want = sorted(df.join(lookup, "k", how).collect(), key=str)
    for auto in ("-1", "10MB"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)
        try:
            got = sorted(spread_join(df, lookup, ["k"], how, rows_per_split=split).collect(), key=str)
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert got == want


def test_only_keys_above_the_limit_are_hot(uneven):
    _, df = uneven
    counts = df.groupBy("k").agg(F.count("*").alias("n"))
    hot = skew._hottest(counts, ["k"], "n", 100, F.col("n"), "value").collect()
    assert [r.value for r in hot] == [700]


def test_rows_without_a_key_are_a_group_like_any_other(spark):
    rows = [(None if i % 3 else "k", "s", i) for i in range(100)]
    df = spark.createDataFrame(rows, "k string, s string, v long")
    for split in (4, 10**6):
        got = {(r.k, r.v): r.n
               for r in number_rows(df, ["s", "k"], "v", "n", rows_per_split=split).collect()}
        assert got == numbered_by_hand([(k, v) for k, _, v in rows])
        joined = spread_join(df, spark.createDataFrame([("k", 1)], "k string, x int"), ["k"], "left",
                             rows_per_split=split).collect()
        assert sorted((r.v, r.x) for r in joined) == [
            (v, 1 if k else None) for k, _, v in rows]


def test_keys_with_one_digest_are_spread_together(uneven, spark, monkeypatch):
    rows, df = uneven
    monkeypatch.setattr(skew.F, "xxhash64", lambda *cols: F.lit(1).cast("bigint"))
    got = {(r.k, r.v): r.n for r in number_rows(df, ["k"], "v", "n", rows_per_split=9).collect()}
    assert got == numbered_by_hand(rows)
    lookup = spark.createDataFrame([("hot", 1.0), ("k1", 2.0)], "k string, x double")
    want = sorted(df.join(lookup, "k", "left").collect(), key=str)
    assert sorted(spread_join(df, lookup, ["k"], "left", rows_per_split=9).collect(), key=str) == want


def test_copies_of_one_row_are_dealt_too(spark):
    rows = spark.createDataFrame([("hot", "same")] * 400, "k string, c string").repartition(8)
    lookup = spark.createDataFrame([("hot", 1)], "k string, x int")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "64",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        sizes = (spread_join(rows, lookup, ["k"], rows_per_split=50)
                 .groupBy(F.spark_partition_id()).count().collect())
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sum(r["count"] for r in sizes) == 400
    assert max(r["count"] for r in sizes) <= 100  # twice the fair share of 8 splits


def test_rows_with_maps_are_spread(spark):
    rows = spark.createDataFrame([("hot", i, {"a": i}) for i in range(40)], "k string, i int, m map<string,int>")
    lookup = spark.createDataFrame([("hot", 1)], "k string, x int")
    got = spread_join(rows, lookup, ["k"], rows_per_split=5).collect()
    assert sorted((r.i, r.m["a"], r.x) for r in got) == [(i, i, 1) for i in range(40)]
