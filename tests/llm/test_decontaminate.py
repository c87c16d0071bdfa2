import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewloom.llm import decontaminate as d


def _words(rng, n):
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 8))) for _ in range(n)]


@pytest.fixture(scope="module")
def world():
    rng = random.Random(11)
    items = {i: _words(rng, 40) for i in range(30)}
    items[30] = _words(rng, 10)
    items[31] = _words(rng, 3)
    rows, want = [], {}
    for i in range(30):
        passage = list(items[i])
        if i % 3 == 1:
            for at in range(3, 40, 6):
                passage[at] = "other"
        if i % 3 == 2:
            passage = passage[10:26]
        rows.append((i, " ".join(_words(rng, 80) + [passage[0].title(), *passage[1:]] + _words(rng, 50))))
        want[i] = [i]
    rows += [(100 + i, " ".join(_words(rng, 150))) for i in range(20)]
    rows += [(200, None), (201, ""), (202, "one"), (203, " ".join(items[30])), (204, " ".join(items[3] + items[4])),
             (205, " ".join(items[31])), (206, "x " * 20000), (207, rows[0][1]), (207, rows[0][1])]
    want |= {203: [30], 204: [3, 4], 207: [0]}
    return {i: " ".join(w) for i, w in items.items()}, rows, want


def _items(llm, items):
    return llm.createDataFrame([*items.items(), (None, "a b c"), (40, None), (41, "")],
                               "item_id bigint, text string")


def test_planted_passages_and_nothing_else(llm, documents, world):
    items, rows, want = world
    docs = documents(rows).withColumn("key_a", F.lit("x")).withColumn("items", F.lit(0))
    got = d.contamination(docs, _items(llm, items)).collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: r["contamination"]["items"] for r in got if r["contamination"]["contaminated"]} == want
    assert all(r["contamination"]["equal_words"] >= 10 for r in got if r["doc_id"] in want)


def test_clean_rows_stay_whole(llm, documents, world):
    items, rows, want = world
    docs = documents(rows).withColumn("found", F.lit(1))
    kept = d.drop_contaminated(docs, _items(llm, items))
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, _ in rows if i not in want)


def test_empty_tables(llm, documents, world):
    items, rows, _ = world
    assert d.contamination(documents([]), _items(llm, items)).count() == 0
    none = llm.createDataFrame([], "item_id string, text string")
    got = d.contamination(documents(rows[:3]), none).collect()
    assert [r["contamination"]["contaminated"] for r in got] == [False] * 3


@pytest.mark.parametrize("seed", range(30))
def test_best_stretch(seed):
    rng = np.random.default_rng(seed)
    equal = rng.random(rng.integers(1, 40)) < 0.8
    want = 0
    for stop in range(1, equal.size + 1):
        # the longest stretch up to here that scores no less than any other start gives
        scores = [(equal[i:stop].sum() - 4.0 * (~equal[i:stop]).sum(), stop - i) for i in range(stop)]
        best = max(scores, key=lambda s: (round(s[0], 6), s[1]))
        if best[1] >= 5 and best[0] >= -1e-9:
            want = max(want, int(equal[stop - best[1]:stop].sum()))
    got = d.best_stretch(equal, 5, 0.8)
    assert got >= want
    if got:  # what is found holds enough equal words
        assert any(equal[i:j].sum() >= got and equal[i:j].mean() >= 0.8 - 1e-9
                   for i in range(equal.size) for j in range(i + 5, equal.size + 1))


def test_masks_ignore_their_gaps():
    words = np.arange(1, 40, dtype=np.uint64)
    for number, mask in enumerate(d.MASKS):
        changed = words.copy()
        gap = next(i for i in range(mask[-1]) if i not in mask)
        changed[gap] = 999
        assert d.seeds(words, mask, number)[0] == d.seeds(changed, mask, number)[0]
        changed[mask[1]] = 999
        assert d.seeds(words, mask, number)[0] != d.seeds(changed, mask, number)[0]
