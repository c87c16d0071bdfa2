import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from reviewloom.llm import bitfilter, collocations


def _plain(rows, least=30, longest=4, top=2000):
    """From ``(lang, text)`` rows, the plain way."""
    times, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", brute.lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                times[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, count in times.items():
        phrases = {p: a for p, a in count.items() if a >= least and len(p) > 1}
        ranked = []
        for p, a in phrases.items():
            score, _, l, r = min((2_000_000 * a // (count[p[:k]] + count[p[k:]]), k, count[p[:k]], count[p[k:]])
                                 for k in range(1, len(p)))
            if not any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q)))
                       for q, b in phrases.items()):
                ranked.append((-score, -a, " ".join(p).encode(), l, r))
        for i, (score, a, phrase, l, r) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, i, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def _corpus():
    rng = random.Random(3)
    words = ["the", "of", "New", "York", "times", "a", "état", "ŒUVRE", "x\x00y", " ", "don't"]
    rows = [("en", " ".join(rng.choices(words, k=rng.randrange(60))) + rng.choice([".", "\n", "\x0b", " "])
             + "New York Times,new\tYORK  state of mind; " * rng.randrange(3)) for _ in range(120)]
    rows += [(None, "one two three four five! " * 40), ("und", "one two"), ("de", "ja ja " * 40), ("", "b c d\r" * 31),
             ("fr", "rare words only"), ("fr", None), (None, ""), ("es", None), ("xx", ".;:")]
    return rows + rows[:20]


def _table(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id bigint, lang string, text string")


@pytest.mark.parametrize("options,ranked", [({}, 50_000), ({"partition_bytes": 50}, 50_000), ({"top": 3}, 6)])
def test_equals_plain_counts(llm, options, ranked, monkeypatch):
    monkeypatch.setattr(collocations, "_RANKED", ranked)
    rows = _corpus()
    docs = _table(llm, rows).repartition(3).withColumn("phrase", F.lit(1)).withColumn("group", F.lit("g"))
    found = collocations.collocations(docs, **options)
    assert found.columns == ["group", "rank", "phrase", "a", "l", "r", "n", "score"]
    got = sorted(map(tuple, found.collect()))
    assert got == _plain(rows, top=options.get("top", 2000)) and len({g[0] for g in got}) >= 3


def test_ties_and_top(llm):
    rows = [("en", f"{a}{i} {b}{i}") for i in range(5) for a, b in [("x", "y"), ("é", "z")] for _ in range(30)]
    found = collocations.collocations(_table(llm, rows), top=3)
    assert sorted(map(tuple, found.collect())) == _plain(rows, top=3)


def test_no_rows(llm):
    assert collocations.collocations(_table(llm, [])).count() == 0
    assert collocations.collocations(_table(llm, [("en", None), (None, "a b")])).count() == 0
    counts = collocations.frequent_phrases(_table(llm, [("en", None), (None, "a b")]))
    assert sorted(map(tuple, counts.collect())) == [("en", 0, None, 0), ("und", 0, None, 2)]


def test_a_very_long_text(llm):
    rng = random.Random(8)
    rows = [("en", " ".join(f"w{int(rng.paretovariate(0.6))}" for _ in range(150_000))), ("en", "w1 w1 w2")]
    found = collocations.collocations(_table(llm, rows))
    assert sorted(map(tuple, found.collect())) == _plain(rows)


def test_no_frequent_key_leaves_a_summary():
    rng = np.random.default_rng(5)
    stream = rng.zipf(1.2, 300_000).astype(np.uint32)
    true = Counter(stream.tolist())
    least = 50
    left, right = (collocations.MisraGries(stream.size // least + 1) for _ in range(2))
    for at in range(0, stream.size, 1000):
        keys, times = np.unique(stream[at:at + 1000], return_counts=True)
        (left if at % 2000 else right).add(keys, times, at_once=500)
    left.merge(), right.merge()
    left.add(right.keys, right.times)
    left.merge()
    lost = left.lost + right.lost
    kept = dict(zip(left.keys.tolist(), left.times.tolist()))
    assert len(kept) <= left.capacity < len(true) and 0 < lost < least
    assert all(true[k] - lost <= kept.get(k, 0) <= true[k] for k in true)
    assert {k for k, n in true.items() if n >= least} <= set(kept)


def test_rows_come_back_from_planes():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**32, 9000, dtype=np.uint32))
    parts = np.diff(keys, prepend=np.uint32(0))
    assert np.array_equal(np.cumsum(collocations._from_planes(collocations._planes(parts)), dtype=np.uint32), keys)


def test_partitions_with_several_batches():
    def batch(rows):
        return pa.RecordBatch.from_arrays([
            pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()),
            pa.array([r[2] and collocations._planes(np.diff(np.array(r[2], np.uint32), prepend=np.uint32(0)))
                      for r in rows], pa.binary()),
            pa.array([r[3] and collocations._planes(np.array(r[3])) for r in rows], pa.binary())],
            ["partition", "mass", "keys", "times"])

    rows = [(2, 40, None, None), (2, 25, None, None), (2, None, [5, 9], [30, 10]), (2, None, [5, 7], [1, 24]),
            (6, 29, None, None), (6, None, [1], [29])]
    want = bitfilter.spread_bits(np.array([(2 << 32) | 5], np.uint64)).view(np.int64).tolist()
    for cut in range(1, 6):
        found = collocations._survivors(30)(iter([batch(rows[:cut]), batch(rows[cut:])]))
        assert [h for b in found for h in b.column(0).to_pylist()] == want


def test_filter_keeps_what_it_holds(llm):
    hashes = bitfilter.spread_bits(np.arange(5000, dtype=np.uint64))
    table = llm.createDataFrame([(int(h),) for h in hashes.view(np.int64)], "h bigint")
    for bits in (bitfilter.MAX_BITS, 1 << 16):
        known = bitfilter.build(table, "h", bits).value
        assert bitfilter.may_contain(known, hashes).all()
        others = bitfilter.spread_bits(np.arange(10_000, 60_000, dtype=np.uint64))
        assert bitfilter.may_contain(known, others).mean() < (0.01 if bits > 1 << 16 else 0.1)
    none = bitfilter.build(table.filter("h = 1"), "h").value
    assert not bitfilter.may_contain(none, hashes).any()
