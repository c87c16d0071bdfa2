import json

import pytest
from pyspark.sql import functions as F

from reviewloom.functions import review
from reviewloom.functions.rating import star_int
from reviewloom.operators.payload import (build_prompt, keep_valid_comments, payload_json,
                                          product_payload, text_ordinal, valid_review)

SCORED = "name string, rating double, rating_star double, row_id long, comments string"
REVIEW = "product_name string, comments array<struct<text:string,rating:int>>"


@pytest.fixture(scope="module")
def scored(spark):
    rows = [("p", 4.9, float(i % 5), i * 3, f"text {i}") for i in range(10)]
    rows += [("q", 0.9, 1.0, 1, "only"), ("r", None, None, 2, "no stars")]
    return spark.createDataFrame(rows, SCORED).repartition(5)


def as_dict(payloads):
    return {(r.product_name, r.part): [tuple(c) for c in r.comments] for r in payloads.collect()}


def test_payload_carries_the_cut_average_in_row_order(scored):
    got = as_dict(product_payload(scored, order_by="row_id"))
    assert got == {("p", 0): [(f"text {i}", 4) for i in range(10)], ("q", 0): [("only", 0)],
                   ("r", 0): [("no stars", None)]}


def test_payload_with_own_rating(scored):
    got = as_dict(product_payload(scored, order_by="row_id", rating=star_int("rating_star")))
    assert got[("p", 0)][:6] == [(f"text {i}", i % 5) for i in range(6)]


@pytest.mark.parametrize("split", [1, 4, None])
def test_larger_products_continue_in_parts(scored, split):
    got = as_dict(product_payload(scored, order_by="row_id", part_size=4, rows_per_split=split))
    assert {k: len(c) for k, c in got.items()} == {("p", 0): 4, ("p", 1): 4, ("p", 2): 2,
                                                  ("q", 0): 1, ("r", 0): 1}
    assert [t for k in sorted(got) if k[0] == "p" for t, _ in got[k]] == [
        f"text {i}" for i in range(10)]


def test_capped_payload(scored):
    got = as_dict(product_payload(scored, order_by="row_id", max_comments=3))
    assert [len(got[k]) for k in sorted(got)] == [3, 1, 1]


def test_order_without_a_position_is_stable(spark, scored):
    answers = {json.dumps(sorted(map(str, product_payload(
        scored.withColumn("o", text_ordinal("comments")).repartition(n), "o").collect())))
        for n in (1, 3, 7)}
    assert len(answers) == 1


def test_payload_json(scored):
    texts = {r.product_name: r.payload
             for r in payload_json(product_payload(scored, order_by="row_id")).collect()}
    assert texts["q"] == '{"product_name":"q","comments":[{"text":"only","rating":0}]}'
    assert texts["r"] == '{"product_name":"r","comments":[{"text":"no stars"}]}'


@pytest.mark.parametrize("text,rating,ok", [
    ("a", 1.0, True), ("a", 5.0, True), ("", 3.0, False), (None, 3.0, False), ("a", 0.0, False),
    ("a", 6.0, False), ("a", 4.5, False), ("a", None, False), ("a" * 3000, 3.0, True),
    ("a" * 3001, 3.0, False)])
def test_valid_comment(spark, text, rating, ok):
    df = spark.createDataFrame([(text, rating)], "t string, r double")
    assert df.select(review.valid_comment("t", "r")).first()[0] is ok


@pytest.mark.parametrize("name,comments,reason", [
    ("p", [("a", 1)], None), ("", [("a", 1)], "product_name"), ("p" * 200, [("a", 1)], None),
    ("p" * 201, [("a", 1)], "product_name"), (None, [("a", 1)], "product_name"),
    ("p", [], "comment_count"), ("p", None, "comment_count"), ("p", [("a", 1)] * 3000, None),
    ("p", [("a", 1)] * 3001, "comment_count"), ("p", [("a", 1), ("b", 9)], "comment"),
    ("p", [("a", 1), (None, 2)], "comment")])
def test_valid_review(spark, name, comments, reason):
    row = valid_review(spark.createDataFrame([(name, comments)], REVIEW)).first()
    assert (row.is_valid, row.reject_reason) == (reason is None, reason)


COMMENTS = [("một hai ba bốn", 5), ("một hai ba", 5), ("a b c d http://x", 5),
            ("a b c d sđt", 4), ("a b c d", 0), ("a b c dàidàidài", 3), ("a b\tc\nd", 1)]


def test_useful_comments_as_rows_and_as_array(spark):
    df = spark.createDataFrame(COMMENTS, "comment string, rating_star int")
    assert [r.comment for r in keep_valid_comments(df).collect()] == [COMMENTS[0][0], COMMENTS[6][0]]
    arr = spark.createDataFrame([("p", COMMENTS)], REVIEW)
    kept = arr.select(review.filter_comment_array("comments").alias("k")).first().k
    assert [tuple(c) for c in kept] == [COMMENTS[0], COMMENTS[6]]


def test_prompt_equals_string_formatting(spark):
    comments = [("đẹp {product_name} \\1 $2", 5), ("{comments}", 1)]
    df = spark.createDataFrame([("Áo {x}", comments)], REVIEW)
    lines = "\n".join(f"Comment {i + 1}: {t} (Số sao: {r})" for i, (t, r) in enumerate(comments))
    want = review.PROMPT_TEMPLATE.format(comments=lines, product_name="Áo {x}")
    assert build_prompt(df).first().prompt == want
    assert build_prompt(df, "{product_name}|{product_name}").first().prompt == "Áo {x}|Áo {x}"


def test_prompt_without_comments(spark):
    df = spark.createDataFrame([("p", [])], REVIEW)
    assert build_prompt(df, "<{comments}>").first().prompt == "<>"


def test_responses(spark):
    texts = ['{"product_name":"p","summary":"s"}', '{"product_name":"p"}', "no json", "", None,
             '{"summary":"s"}', '{"product_name":"p","summary":"s","extra":1}', "[]"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [tuple(r.p) for r in df.select("i", review.parse_summary("t").alias("p"))
           .orderBy("i").collect()]
    ok, bad = ("p", "s", True), (None, None, False)
    assert got == [ok, bad, bad, bad, bad, bad, ok, bad]


def test_keep_valid_comments_uses_own_keywords(spark):
    df = spark.createDataFrame([("a b c magic", 5), ("a b c sđt", 5)],
                               "comment string, rating_star int")
    assert [r.comment for r in keep_valid_comments(df, keywords=["magic"]).collect()] == ["a b c sđt"]
    assert df.filter(F.lit(True)).count() == 2
