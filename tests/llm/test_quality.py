import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import covered, quality as plain
from reviewloom.llm import quality

CLEAN = " ".join(f"word{i}" for i in range(60))
CASES = [None, "", " \n\t ", "one", CLEAN, " ".join(["same"] * 50), CLEAN + "\n" + CLEAN,
         "\n".join([CLEAN[:80]] * 6), "In. " * 7 + "On. " * 7 + "At. " * 9, "a b c d e " * 30,
         "## $$ <b> & | %%\n" + CLEAN, "ü\xa0é " + CLEAN, "long " * 5000]


def _random(seed):
    rng = random.Random(seed)
    return " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(0, 90)))


def test_figures_agree_with_plain_counts(documents):
    texts = CASES + [_random(i) for i in range(120)]
    rows = quality.quality(documents(list(enumerate(texts)) + [(0, texts[4]), (None, CLEAN)])).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        q = r["quality"]
        assert (q["n_words"], q["word_chars"], q["n_symbols"], q["n_dup_lines"], q["n_repeat_words"],
                q["base_failed"], q["kept"]) == plain(r["text"])
        spans = {p for s in q["repeat_spans"] for p in range(s["start"], s["stop"])}
        assert spans == covered((r["text"] or "").encode().split(), quality.MIN_REPEAT)


@pytest.mark.parametrize("seed", range(20))
def test_longest_matches(seed):
    rng = np.random.default_rng(seed)
    codes = rng.integers(0, 3, rng.integers(0, 40))
    found = quality.longest_matches(codes)
    for i in range(codes.size):
        best = 0
        for j in range(codes.size):
            k = 0
            while i != j and max(i, j) + k < codes.size and codes[i + k] == codes[j + k]:
                k += 1
            best = max(best, k)
        assert found[i] == best


def test_kept_rows_have_the_columns_of_the_input(documents):
    docs = documents([(1, CLEAN), (2, "short"), (3, None)]).withColumn("quality", F.lit(1)).withColumn(
        "a.b", F.lit(2))
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert [r["doc_id"] for r in kept.collect()] == [1]
    assert quality.keep_good(documents([])).count() == 0


def test_texts_are_measured_once(documents):
    plan = quality.keep_good(documents([(1, CLEAN)]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan
