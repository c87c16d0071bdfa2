import random
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from reviewloom.llm import minhash


def _set(text):
    words = brute.WORD.findall(brute.lower(text))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def _plain(rows):
    """``(n_shingles, component_id, kept)`` by id."""
    sets = {i: _set(t) for i, t in rows}

    def linked(a, b):
        return bool(sets[a]) and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    found = brute.groups(sorted(sets), linked)
    return {i: (len(sets[i]), found[i], found[i] == i) for i in sets}


def _prose(rng, n):
    return ["".join(rng.choice("abcdefghijkl") for _ in range(rng.randrange(2, 9))) for _ in range(n)]


def _corpus(seed=2):
    rng = random.Random(seed)
    rows, texts = [], []
    for _ in range(12):
        words = _prose(rng, rng.randrange(60, 400))
        for _ in range(6):  # chains: each a little further from the first, links at and around the limit
            texts.append(" ".join(words))
            words = list(words)
            for _ in range(rng.randrange(4)):
                words[rng.randrange(len(words))] = rng.choice(["changed", "other", "Word"])
            words = words[:len(words) - rng.randrange(8)]
    texts += [texts[0]] * 5 + [texts[1].upper().replace(" ", "\n\t")] * 3
    texts += [None, None, "", " \n", "one", "One", "one two", "a b c d", "A  B C D", "a b c d e", "a b c d e f",
              "x " * 4000, "x " * 50, "ÄÖ É ÄÖ É ÄÖ É", "äö é äö é äö é", "\x1c a b c d"]
    shared = " ".join(_prose(rng, 80))
    texts += [shared + " " + " ".join(_prose(rng, rng.randrange(8, 60))) for _ in range(40)]
    rng.shuffle(texts)
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    return rows


def _found(rows):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows.collect()}


@pytest.mark.parametrize("group", [minhash.GROUP, 4])
def test_groups_agree_with_all_pairs(documents, group):
    rows = _corpus()
    want = _plain(rows)
    docs = documents(rows).repartition(3).withColumn("node", F.lit("x")).withColumn("key", F.lit(1))
    found = minhash.near_duplicates(docs, group=group)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert _found(found) == want
    assert 20 < len({c for _, c, _ in want.values()}) < len(want) - 20


def test_all_pairs_under_the_signature_distance_share_a_key(llm):
    rng = np.random.default_rng(1)
    one = rng.integers(0, 2**16, minhash.VALUES, dtype=np.uint16)
    signatures, wrong = [one], [0]
    for n in range(minhash.DISTANCE + 1):
        for _ in range(40):
            other = one.copy()
            other[rng.permutation(minhash.VALUES)[:n]] += 1
            signatures.append(other)
            wrong.append(n)
    # the hardest case: as many errors in every chunk as still are too many, but for one chunk
    for chunk in range(minhash.CHUNKS):
        other = one.copy()
        for c in range(minhash.CHUNKS):
            at = c * minhash.CHUNK + rng.permutation(minhash.CHUNK)[:minhash.ERRORS + (c != chunk)]
            other[at] += 1
        signatures.append(other)
    assert (signatures[-1] != one).sum() == minhash.DISTANCE
    table = llm.createDataFrame([(i, s.tobytes()) for i, s in enumerate(signatures)], "i int, s binary")
    keys = {r["i"]: set(r["k"]) for r in table.select("i", minhash.chunk_keys("s").alias("k")).collect()}
    assert len(keys[0]) == minhash.CHUNKS * comb(minhash.CHUNK, minhash.ERRORS)
    assert all(keys[0] & k for k in keys.values())
    far = [one + 1] * 3
    table = llm.createDataFrame([(i, s.tobytes()) for i, s in enumerate(far)], "i int, s binary")
    assert not any(keys[0] & set(r["k"]) for r in table.select(minhash.chunk_keys("s").alias("k")).collect())


def test_recall_at_the_limit():
    """Pairs at a similarity of exactly 0.85 share a key but for a few in 100,000."""
    rng = np.random.default_rng(6)
    sets, n = [], 1500
    for _ in range(n):
        pool = np.unique(rng.integers(0, 2**63, 100, dtype=np.uint64))
        sets += [pool[:185 // 2 + 0], np.concatenate([pool[:85], pool[92:100]])]
    close = [len(np.intersect1d(a, b)) / len(np.union1d(a, b)) for a, b in zip(sets[::2], sets[1::2])]
    assert 0.84 < np.mean(close) < 0.86
    found = minhash.signatures(sets)
    same = (found[::2] == found[1::2]).reshape(n, minhash.CHUNKS, minhash.CHUNK)
    agree = same.mean()
    assert abs(agree - 0.85) < 0.01
    met = ((~same).sum(axis=2) <= minhash.ERRORS).any(axis=1)
    assert met.mean() >= 0.999
    p = sum(comb(minhash.CHUNK, e) * 0.15**e * 0.85**(minhash.CHUNK - e) for e in range(minhash.ERRORS + 1))
    assert (1 - p) ** minhash.CHUNKS < 5e-5


def test_links_across_lose_none():
    """What the shards of all keys give joins the groups that similar pairs join, and holds similar pairs only."""
    rng = np.random.default_rng(9)
    pool = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    base, sets = rng.permutation(pool)[:220], []
    for _ in range(60):
        kept = rng.permutation(base)[:rng.integers(190, 221)]
        sets.append(np.unique(np.concatenate([kept, rng.permutation(pool)[:rng.integers(0, 20)]])))

    def jaccard(a, b):
        return np.intersect1d(a, b).size / np.union1d(a, b).size
    signatures, sketches = minhash.signatures(sets), minhash.signatures(sets, minhash.SKETCH, 99, "u1")
    root, part = [i % 7 for i in range(60)], [i % 3 for i in range(60)]
    found = []
    for c in range(minhash.CHUNKS):
        for out in range(minhash.CHUNK):
            left = [c * minhash.CHUNK + p for p in range(minhash.CHUNK) if p != out]
            keys = {}
            for i, s in enumerate(signatures):
                keys.setdefault(s[left].tobytes(), []).append(i)
            for members in keys.values():
                for x, y in [(0, 0), (1, 1), (2, 2), (0, 1), (0, 2), (1, 2)]:
                    here = [i for i in members if part[i] in (x, y)]
                    if len(here) < 2:
                        continue
                    first = members[0]
                    table = pa.RecordBatch.from_arrays([
                        pa.array([1] * len(here), pa.int64()), pa.array([c * minhash.CHUNK + out] * len(here)),
                        pa.array([bytes([i]) for i in here]), pa.array([bytes([root[i]]) for i in here]),
                        pa.array([sets[i].size for i in here], pa.int64()),
                        pa.array([None if i % 11 == 3 else 1 - jaccard(sets[first], sets[i]) for i in here], pa.float64()),
                        pa.array([part[i] for i in here]), pa.array([x == y] * len(here)),
                        pa.array([signatures[i].tobytes() for i in here]), pa.array([sketches[i].tobytes() for i in here]),
                        pa.array([sets[i].tobytes() for i in here])],
                        ["shard", "at", "node", "root", "n", "away", "part", "alone", "signature", "sketch", "shingles"])
                    links = []
                    for some in minhash._links_across(85)(iter([table.slice(0, 1), table.slice(1)])):
                        links += zip(some["a"].to_pylist(), some["b"].to_pylist())
                    assert len(links) < len(here)
                    found += [(a[0], b[0]) for a, b in links]
    want = {(i, j) for i, j in combinations(range(60), 2) if jaccard(sets[i], sets[j]) >= 0.85}

    def joined(pairs):
        label = list(root)
        for a, b in pairs:
            label = [label[a] if x == label[b] else x for x in label]
        return [label.index(x) for x in label]
    assert {tuple(sorted(p)) for p in found} <= want and len(found) > 3
    assert joined(found) == joined(want) != joined([])


def test_null_and_equal_ids_and_no_rows(documents):
    text = " ".join(_prose(random.Random(1), 50))
    rows = [(None, text), (7, text), (7, text), (9, text + " more"), (None, "alone and without id"), (None, None)]
    found = sorted((repr(tuple(r)) for r in minhash.near_duplicates(documents(rows)).collect()))
    assert found == sorted(map(repr, [(None, 46, 7, False), (7, 46, 7, True), (7, 46, 7, True), (9, 47, 7, False),
                                      (None, 1, None, True), (None, 0, None, True)]))
    assert minhash.near_duplicates(documents([])).count() == 0
    assert _found(minhash.near_duplicates(documents([(1, None), (2, "")]))) == {1: (0, 1, True), 2: (0, 2, True)}


def test_a_very_long_text(documents):
    words = _prose(random.Random(4), 60_000)
    other = list(words)
    other[100] = "changed"
    rows = [(1, " ".join(words)), (2, " ".join(other)), (3, " ".join(words[:45_000]))]
    assert _found(minhash.near_duplicates(documents(rows))) == _plain(rows)
