import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from reviewloom.llm import paragraphs as p


def _words(rng, n):
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 8))) for _ in range(n)]


@pytest.fixture(scope="module")
def world():
    """Passages pasted in the middle of lines, across lines, at both ends; near copies; clean texts."""
    rng = random.Random(21)
    texts = {}
    for k in range(40):
        passage = _words(rng, rng.randrange(55, 90))
        for copy in range(2 + k % 3):
            before, after = _words(rng, rng.randrange(0, 70)), _words(rng, rng.randrange(0, 70))
            words = before + passage + after
            glue = [rng.choice([" ", " ", " ", "\n", ".\n"]) for _ in words]
            texts[k * 10 + copy] = "".join(w + g for w, g in zip(words, glue))
    clean = {1000 + i: " ".join(_words(rng, 120)) for i in range(40)}
    return texts, clean


def test_passages_are_caught_and_clean_texts_left_alone(documents, world):
    texts, clean = world
    rows = [*texts.items(), *clean.items(), (2000, None), (2001, ""), (2002, "one two three"), (None, "x y z")]
    docs = documents(rows).withColumn("key", F.lit("k")).withColumn("first", F.lit(1))
    got = {r["doc_id"]: r for r in p.dedup_report(docs).collect()}
    assert set(got) == {i for i, _ in rows}
    for i in texts:
        assert got[i]["component_id"] == i // 10 * 10, "every copy is linked to the first one"
        assert got[i]["linked_docs"][0] == i // 10 * 10
        assert {x // 10 for x in got[i]["linked_docs"]} == {i // 10}
        assert (got[i]["n_removed"] > 0) == (i % 10 > 0), "the first occurrence stays"
        assert got[i]["removed_words"] == sum(s["stop"] - s["start"] for s in got[i]["removed_spans"])
    for i in [*clean, 2000, 2001, 2002, None]:
        assert got[i]["component_id"] == i and got[i]["n_repeated"] == 0
    assert brute.shared_runs({**texts, **clean}, 51) == set(texts)


def test_exact_jaccard_decides(documents):
    rng = random.Random(2)
    long = _words(rng, 300)
    near = list(long)
    near[150] = "changed"
    report = p.dedup_report(documents([(1, " ".join(long)), (2, " ".join(near)), (3, " ".join(_words(rng, 300)))]))
    assert {r["doc_id"]: r["component_id"] for r in report.collect()} == {1: 1, 2: 1, 3: 3}


@pytest.mark.parametrize("seed", range(10))
def test_similar_groups(seed):
    rng = random.Random(seed)
    sets = [np.unique(rng.sample(range(30), rng.randrange(5, 25))) for _ in range(40)]
    sets += [np.unique(np.append(s[1:], 99)) for s in sets[:10]]

    def near(i, j):
        a, b = set(sets[i].tolist()), set(sets[j].tolist())
        return len(a & b) / len(a | b) >= 0.8
    want = brute.groups(range(len(sets)), near)
    got = p.similar_groups([np.asarray(s, np.int64) for s in sets], 0.8)
    assert got.tolist() == [want[i] for i in range(len(sets))]
    assert p._few_groups([set(s.tolist()) for s in sets], 0.8) == got.tolist()


def _variants(n):
    """Texts of one paragraph's length whose shingle sets differ by one or two at the ends."""
    rng = random.Random(8)
    core = _words(rng, 60)
    return [(i, " ".join([f"head{i}"] * (i % 2) + core + [f"tail{i}"])) for i in range(n)]


@pytest.mark.parametrize("size", [4, 2048])
def test_split_buckets_lose_no_link(documents, size):
    docs = documents(_variants(30)).select("doc_id", "text")
    table = p.paragraph_table(docs, bands=2)
    roots = {r["class"]: r["root"] for r in p.similar_classes(docs, table, 2, 0.8, size).collect()}
    whole = {r["class"]: r["root"] for r in p.similar_classes(docs, table, 2, 0.8, 10**6).collect()}

    def parts(found):
        by = {}
        for c, r in found.items():
            by.setdefault(r, set()).add(c)
        return sorted(map(sorted, by.values()))
    assert parts(roots) == parts(whole)


def test_cuts_depend_on_nearby_words_only():
    rng = np.random.default_rng(3)
    passage = rng.integers(0, 2**63, 200, dtype=np.uint64)
    cuts = []
    for before in (0, 5, 33):
        words = np.concatenate([rng.integers(0, 2**63, before, dtype=np.uint64), passage,
                                rng.integers(0, 2**63, 20, dtype=np.uint64)])
        at = p.cut_places(words, np.array([0, words.size])) - before
        cuts.append(set(at[(at > 10) & (at < 185)].tolist()))
    assert cuts[0] == cuts[1] == cuts[2] and len(cuts[0]) > 8


def test_bands():
    assert p.bands_for(0.8, 0.95) == 2 and p.bands_for(0.8, 0.99) == 3


def test_repeated_rows_and_empty(documents, world):
    texts, _ = world
    row = (5, texts[0])
    got = p.dedup_report(documents([row, row, (6, "short")])).collect()
    assert [r["n_repeated"] for r in got] == [0, 0, 0], "rows with one id are one document"
    assert p.dedup_report(documents([])).count() == 0


def _jaccard(a, b):
    a, b = ({tuple(w[i:i + p.SHINGLE_WORDS]) for i in range(len(w) - p.SHINGLE_WORDS + 1)} for w in (a, b))
    return len(a & b) / len(a | b)


@pytest.mark.parametrize("glue", ["\n", "\n\n"])
def test_near_copies_of_whole_paragraphs_are_removed_whole(documents, glue):
    """Lines, and blocks of lines between blank lines, with changed words; all 0.8 similar and more."""
    rng = random.Random(31)
    rows, near = [], {}
    for k in range(60):
        words = _words(rng, rng.randrange(50, 101))
        changed = list(words)
        for at in rng.sample(range(len(words)), 1 if len(words) < 95 else 2):
            changed[at] = "changed"
        for copy, body in enumerate((words, changed)):
            if glue == "\n\n":
                body = [w + ("\n" if i % (9 + copy) == 8 else "") for i, w in enumerate(body)]
            before = _words(rng, rng.randrange(5, 30))
            rows.append((10 * k + copy, " ".join(before) + glue + " ".join(body) + glue + "the end"))
            near[10 * k + copy] = (len(before), len(before) + len(words))
        assert _jaccard(words, changed) >= 0.8
    got = {r["doc_id"]: r for r in p.dedup_report(documents(rows), recall=0.9999).collect()}
    for i, (start, stop) in near.items():
        assert got[i]["component_id"] == i // 10 * 10
        if i % 10:
            assert any(s["start"] <= start and stop <= s["stop"] for s in got[i]["removed_spans"])


def test_passages_are_removed_to_their_ends(documents):
    """Exact passages of 51 and 52 words within other words are all found, and to their last word."""
    rng = random.Random(41)
    rows, planted = [], {}
    for k in range(300):
        passage = _words(rng, 51 + k % 2)
        for copy in range(2):
            before, after = _words(rng, rng.randrange(10, 60)), _words(rng, rng.randrange(10, 60))
            rows.append((10 * k + copy, " ".join(before + passage + after)))
            planted[10 * k + copy] = (len(before), len(before) + len(passage))
    got = {r["doc_id"]: r for r in p.dedup_report(documents(rows)).collect()}
    for i, span in planted.items():
        spans = [tuple(s) for s in got[i]["removed_spans"]]
        if i % 10 == 0:
            assert spans == []
        else:
            assert len(spans) == 1 and got[i]["linked_docs"] == [i - 1]
            start, stop = spans[0]
            # a similar paragraph at an end may bring a few words more
            assert start <= span[0] and span[1] <= stop and stop - start <= span[1] - span[0] + 12


def test_every_51_words_hold_a_paragraph_or_a_seed():
    rng = np.random.default_rng(5)
    for _ in range(2000):
        passage = rng.integers(0, 2**63, 51, dtype=np.uint64)
        found = []
        for _ in range(2):
            before = rng.integers(0, 2**63, 30, dtype=np.uint64)
            words = np.concatenate([before, passage, rng.integers(0, 2**63, 30, dtype=np.uint64)])
            bounds = np.array([0, words.size])
            cuts, more = p.cut_places(words, bounds), p.seeds(words, bounds)
            units = [*zip(cuts[:-1].tolist(), cuts[1:].tolist()), *((a, a + p.SEED_WORDS) for a in more.tolist())]
            found.append({(a - 30, b - 30) for a, b in units if a >= 30 and b <= 81})
        assert found[0] & found[1]


def test_what_occurs_once_is_neither_written_nor_shuffled(spark, documents, world):
    texts, clean = world
    rows = [*texts.items(), *clean.items(), (3000, clean[1000]), (3000, clean[1000]), (None, clean[1001])]
    docs = documents(rows).select("doc_id", "text")
    known = p.repeated_hashes(docs.select("text"), 2)
    whole, kept = p.paragraph_table(docs, bands=2), p.paragraph_table(docs, bands=2, known=known)
    assert kept.filter(F.col("doc_id").between(1002, 2000)).isEmpty(), "clean texts have nothing in common"
    assert kept.count() < 0.7 * whole.count()
    columns = ["doc_id", "key", "at", "n", "class"]
    assert kept.select(columns).exceptAll(whole.select(columns)).isEmpty()
    several = whole.groupBy("class").agg(F.countDistinct("key").alias("n")).filter("n > 1").select("class")
    keys = F.explode(F.array("band0", "band1"))
    met = whole.select(keys.alias("bucket"), "class").filter("bucket is not null")
    buckets = met.groupBy("bucket").agg(F.countDistinct("class").alias("n")).filter("n > 1").select("bucket")
    needed = several.union(met.join(buckets, "bucket").select("class")).distinct()
    lost = whole.join(needed, "class").select(columns).exceptAll(kept.select(columns))
    assert lost.isEmpty(), "every place of a class that repeats or collides stays"
    kept_met = kept.select(keys.alias("bucket"), "class").join(buckets, "bucket").distinct()
    assert kept_met.count() == met.join(buckets, "bucket").distinct().count()
