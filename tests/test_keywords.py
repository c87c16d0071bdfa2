import random
import time

import pytest
from pyspark.sql import functions as F

from reviewloom.functions.spam import has_spam_keyword
from reviewloom.operators import keywords as lists
from reviewloom.operators.keywords import keyword_hits, mark_keywords


def _texts(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "i int, comment string")


def _list(spark, keywords):
    return spark.createDataFrame([(k,) for k in keywords], "keyword string")


TEXTS = [None, "", "a", "ab", "Abc", "xxABCxx abc", "ship cod ngay", "SĐT: 09", "sđ t", "q.u*x [y] \\d", "ab" * 2000,
         "ĐẶT HÀNG", "no such thing", "aaa"]
KEYWORDS = ["abc", "ABC", "", None, "b", "đ", "sđ", "sđt", "ship cod", "q.u*x", "[y]", "\\d", "đặt hàng", "nowhere",
            "ngay!", "abab", "zz", "aaaa"]


@pytest.mark.parametrize("limit", [10**6, 0])
def test_hits_are_those_of_contains(spark, limit):
    found = keyword_hits(_texts(spark, TEXTS), _list(spark, KEYWORDS), ["i"], broadcast_bytes=limit)
    want = {(i, k.lower()) for i, t in enumerate(TEXTS) if t for k in KEYWORDS if k and k.lower() in t.lower()}
    got = [tuple(r) for r in found.collect()]
    assert set(got) == want and len(got) == len(want)
    marked = mark_keywords(_texts(spark, TEXTS), _list(spark, KEYWORDS), ["i"], broadcast_bytes=limit)
    hit = {i for i, _ in want}
    assert {r.i: r.has_keyword for r in marked.collect()} == {
        i: None if t is None else i in hit for i, t in enumerate(TEXTS)}


def test_no_keywords_and_no_texts(spark):
    none = _list(spark, [None, ""])
    assert keyword_hits(_texts(spark, TEXTS), none, ["i"]).count() == 0
    assert {r.has_keyword for r in mark_keywords(_texts(spark, TEXTS), none, ["i"]).collect()} == {None, False}
    assert mark_keywords(_texts(spark, []), _list(spark, KEYWORDS), ["i"]).count() == 0


def test_a_hundred_thousand_keywords_equal_the_pattern(spark):
    rng = random.Random(7)
    letters = "abcdefghijklmnopqrstuvwxyzđêô "
    keywords = {"".join(rng.choices(letters, k=rng.randrange(5, 9))) for _ in range(105_000)}
    texts = ["".join(rng.choices(letters, k=rng.randrange(30))).upper() for _ in range(3000)]
    texts += [f"before {k} after" for k in rng.sample(sorted(keywords), 200)]
    assert len(keywords) > 100_000
    rows = _texts(spark, texts).repartition(4)
    marked = mark_keywords(rows, _list(spark, sorted(keywords)), ["i"])
    by_pattern = rows.select("i", has_spam_keyword("comment", sorted(keywords)[:400]).alias("p"))
    got = {r.i: r.has_keyword for r in marked.collect()}
    # the pattern of all is too large to compile, so it answers for a few and Python for the rest
    assert all(got[r.i] for r in by_pattern.collect() if r.p)
    assert got == {i: any(t.lower()[a:a + n] in keywords for n in range(5, 9) for a in range(len(t)))
                   for i, t in enumerate(texts)}


def test_the_cost_of_a_long_text_is_in_proportion_to_its_length(spark):
    rng = random.Random(3)
    long = "".join(rng.choices("abcdefgh ", k=600_000))
    rows = _texts(spark, [long, long + " needle", None])
    begun = time.monotonic()
    found = keyword_hits(rows, _list(spark, ["Needle", "nowhere"]), ["i"]).collect()
    assert [tuple(r) for r in found] == [(1, "needle")]
    assert time.monotonic() - begun < 45


ODD = ["a", "na", "nation", "national", "nationality", "Nations", "x|y", "(?i)", "a.b*", "^$", "\\E", "[z", "-]", "&&", "#", " ", "\n",
       "e\u0301t\u00e9", "\U0001f600", "\U0001f600\U0001f601!", "\ufffd", "ß", "İ", "long phrase " * 9, "long phrase " * 7 + "ends",
       "b" * 64, "b" * 64 + "c", "d" * 64 + "ef", "d" * 64 + "g"]


@pytest.mark.parametrize("limit", [10**6, 0])
@pytest.mark.parametrize("bytes_, patterns, alike", [(24_000, 16, 8), (40, 1000, 0), (24_000, 0, 8)])
def test_marks_are_those_of_contains_however_the_list_is_cut(spark, monkeypatch, limit, bytes_, patterns, alike):
    monkeypatch.setattr(lists, "PATTERN_BYTES", bytes_)
    monkeypatch.setattr(lists, "PATTERNS", patterns)
    monkeypatch.setattr(lists, "ALIKE", alike)
    rng = random.Random(patterns + alike)
    letters = "abcdefg x|.\U0001f600đ\n"
    wide = [*map(chr, range(0x4e00, 0x4f00)), *map(chr, range(0x1f600, 0x1f640)), *map(chr, range(0x61, 0x180))]
    for words in (ODD[3:], ODD, [w for w in ODD if len(w) > 64],
                  ["".join(rng.choices(letters, k=rng.randrange(1, 9))) for _ in range(60)],
                  ["".join(rng.choices(wide, k=rng.randrange(1, 5))) for _ in range(300)]):
        texts = [None, "", *ODD, *[w.upper() + "!" for w in words], *[w[:-1] for w in words], *["." + w[1:] for w in words]]
        texts += ["".join(rng.choices(letters, k=rng.randrange(12))) for _ in range(100)]
        texts += ["long phrase " * 20 + "ends", "b" * 200, "d" * 66 + "e", "d" * 70 + "ef"]
        low = {r.i: r.l for r in _texts(spark, texts).select("i", F.lower("comment").alias("l")).collect()}
        asked = {r.k for r in _list(spark, words).select(F.lower("keyword").alias("k")).collect()}
        marked = mark_keywords(_texts(spark, texts), _list(spark, [*words, None, ""]), ["i"], broadcast_bytes=limit)
        got = [tuple(r) for r in marked.select("i", "comment", "has_keyword").collect()]
        assert sorted(got) == [(i, t, None if t is None else any(k in low[i] for k in asked))
                               for i, t in enumerate(texts)]


@pytest.mark.parametrize("patterns", [16, 0])
def test_a_mark_is_of_all_rows_of_its_keys(spark, monkeypatch, patterns):
    monkeypatch.setattr(lists, "PATTERNS", patterns)
    rows = spark.createDataFrame([(1, "has needle"), (1, "nothing"), (1, None), (1, "has needle"), (None, "needle"),
                                  (2, "nothing")], "i int, comment string")
    for limit in (10**6, 0):
        got = mark_keywords(rows, _list(spark, ["needle"]), ["i"], broadcast_bytes=limit).collect()
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, [
            (1, "has needle", True), (1, "nothing", True), (1, None, None), (1, "has needle", True),
            (None, "needle", False), (2, "nothing", False)]))


def _nodes(plan):
    yield plan
    if plan.nodeName().startswith("AdaptiveSparkPlan"):
        below = [plan.executedPlan()]
    elif "QueryStage" in plan.nodeName():
        below = [plan.plan()]
    else:
        below = [plan.children().apply(i) for i in range(plan.children().size())]
    for node in below:
        yield from _nodes(node)


def test_marking_makes_no_row_per_character_and_shuffles_no_texts(spark):
    rng = random.Random(11)
    texts = ["".join(rng.choices("abcdefghijkl ", k=150)) for _ in range(500)] + ["the needle"]
    words = ["".join(rng.choices("abcdefghijkl", k=rng.randrange(4, 9))) for _ in range(400)] + ["needle"]
    rows = _texts(spark, texts).withColumn("comment", F.concat("comment", F.lit("")))
    marked = mark_keywords(rows, _list(spark, words), ["i"], broadcast_bytes=0).select("i", "has_keyword")
    got = dict(map(tuple, marked.collect()))
    assert got == {i: any(w in t for w in words) for i, t in enumerate(texts)} and any(got.values())
    nodes = list(_nodes(marked._jdf.queryExecution().executedPlan()))
    made = [n.metrics().get("numOutputRows").get().value() for n in nodes if n.nodeName() == "Generate"]
    assert made and max(made) <= len(texts)
    shuffled = " ".join(n.output().toString() for n in nodes if n.nodeName() == "Exchange")
    assert "i#" in shuffled and "comment#" not in shuffled and "__low#" not in shuffled


def test_marking_a_long_text_is_in_proportion_to_its_length(spark):
    rng = random.Random(5)
    long = "".join(rng.choices("abcdefgh ", k=600_000))
    rows = _texts(spark, [long, long + " needle", long + "y" * 70, None])
    begun = time.monotonic()
    marked = mark_keywords(rows, _list(spark, ["Needle", "nowhere", "y" * 70, "y" * 69 + "z"]), ["i"], broadcast_bytes=0)
    assert [r.has_keyword for r in marked.orderBy("i").collect()] == [False, True, True, None]
    assert time.monotonic() - begun < 45
