import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from reviewloom.llm import components, simhash


def _prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghijkl") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def _corpus():
    rng = random.Random(4)
    base = [_prose(rng, 200) for _ in range(8)]
    rows = [(i * 10, t) for i, t in enumerate(base)]
    rows += [(i * 10 + 1, t) for i, t in enumerate(base)]
    for i, t in enumerate(base):
        words = t.split()
        words[rng.randrange(len(words))] = "changed"
        rows.append((i * 10 + 2, " ".join(words)))
    rows += [(900, None), (901, ""), (902, " \n"), (903, "one two"), (904, "One  TWO"), (905, "ÄÖ ÄÖ"),
             (906, "x " * 5000)]
    return rows


def test_fingerprints():
    for _, text in _corpus():
        assert simhash.simhash((text or "").encode()) % 2**64 == brute.fingerprint(text)


def test_groups_agree_with_all_pairs(documents):
    rows = _corpus()
    prints = {i: brute.fingerprint(t) for i, t in rows}
    want = brute.groups(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    got = simhash.near_duplicates(documents(rows).withColumn("fp", F.lit(1))).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert {r["doc_id"]: r["fingerprint"] for r in got} == {i: f"{p:016x}" for i, p in prints.items()}
    assert len(set(want.values())) < len(want)


def _points(n):
    rng = np.random.default_rng(7)
    base = rng.integers(0, 2**63, n, dtype=np.uint64)
    near = base[:n // 4].repeat(3)
    for _ in range(5):
        near = near ^ (np.uint64(1) << rng.integers(0, 64, near.size, dtype=np.uint64))
    dense = base[0] ^ np.array([1 << i for i in range(40)], np.uint64)
    return np.unique(np.concatenate([base, near, dense]))


def _plain(points, bits):
    label = np.arange(points.size)
    for i in range(points.size):
        near = np.flatnonzero(np.bitwise_count(points ^ points[i]) <= bits)
        label = components.join_groups(label, near, np.full(near.size, i))
    return label


def test_trees_find_what_all_pairs_find():
    points = _points(3000)
    assert np.array_equal(simhash.tree_groups(points, 4), _plain(points, 4))


@pytest.mark.parametrize("size", [8192, 8])
def test_shards_lose_no_link(llm, size):
    points = _points(400)
    fps = llm.createDataFrame([(int(p),) for p in points.view(np.int64)], "fp bigint")
    found = {r["fp"]: r["root"] for r in simhash.near_groups(fps, shard_size=size).collect()}
    label = _plain(points, 4)
    signed = points.view(np.int64).tolist()
    for i, p in enumerate(signed):
        members = np.flatnonzero(label == label[i])
        assert (p in found) == (members.size > 1)
        assert len({found.get(signed[m]) for m in members}) == 1
    assert len(set(found.values())) == sum((label == i).sum() > 1 for i in range(points.size))


def test_one_of_each_group_stays(documents):
    rows = _corpus() + [(0, _corpus()[0][1]), (None, _corpus()[0][1])]
    docs = documents(rows).withColumn("row", F.lit("x")).withColumn("order", F.lit(3))
    kept = simhash.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    prints = {i: brute.fingerprint(t) for i, t in _corpus()}
    want = brute.groups(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want.values()))


def test_empty(documents):
    assert simhash.near_duplicates(documents([])).count() == 0
    assert simhash.keep_one_per_group(documents([])).count() == 0


def test_components_of_long_paths_stars_and_rings(llm):
    path = [(i, i + 1) for i in range(60)]
    star = [(1000, 1001 + i) for i in range(200)]
    ring = [(2000 + i, 2000 + (i + 1) % 30) for i in range(30)]
    links = llm.createDataFrame(path + star + ring + [(5000, 5000), (None, 1)], "a bigint, b bigint")
    found = {r["node"]: r["root"] for r in components.connected_components(links).collect()}
    for part in (range(61), range(1000, 1201), range(2000, 2030)):
        assert len({found[i] for i in part}) == 1
    assert len(set(found.values())) == 3 and 5000 not in found
    none = llm.createDataFrame([], "a bigint, b bigint")
    assert components.connected_components(none).count() == 0
