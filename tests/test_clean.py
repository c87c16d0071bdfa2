import pytest
from pyspark.sql import functions as F

from reviewloom.functions.rating import parse_rating, star_int
from reviewloom.operators.clean import (RELAXED, STRICT, clean_reviews, dedup_comments,
                                        require_columns)
from reviewloom.operators.rating import (average_rating, only_first_product, with_product_rating)
from reviewloom.plans.score import score_late_reviews, score_reviews

TEN = "một hai ba bốn năm sáu bảy tám chín mười"
RAW = "rating_star string, comment string, name string"


def test_ratings_that_are_no_numbers_become_null(column):
    got = column(["5", " 4 ", "n/a", "", "0", "6", "4.5", None], parse_rating)
    assert got == [5.0, 4.0, None, None, 0.0, 6.0, 4.5, None]


def test_stars_are_cut_off(column):
    assert column([4.9, 4.5, 0.9, 5.0, None, float("inf")], star_int, "double") == [
        4, 4, 0, 5, None, None]


def test_require_columns(spark):
    df = spark.createDataFrame([("5", "a", "n"), (None, "a", "n"), ("5", None, "n"), ("5", "a", None),
                                ("", "", "")], RAW)
    assert require_columns(df).count() == 2


def test_strict_and_relaxed_limits(spark):
    nine = TEN.rsplit(" ", 1)[0]
    long_ok, too_long = "ab " * 999 + "abc", "ab " * 1000 + "ab"
    assert (len(long_ok), len(too_long)) == (3000, 3002)
    rows = [("5", TEN, "p"), ("5", nine, "p"), ("5", TEN + " sevenab", "p"), ("5", long_ok, "p"),
            ("5", too_long, "p"), ("5", "!!!", "p"), ("5", TEN + "!", "p"), ("x", "ok", "p"),
            ("5", "a" * 7, "p")]
    df = spark.createDataFrame(rows, RAW)
    strict = {r.comments for r in clean_reviews(df, STRICT).collect()}
    assert strict == {TEN, long_ok}
    relaxed = sorted(r.comments for r in clean_reviews(df, "relaxed").collect())
    assert relaxed == sorted([TEN, nine, long_ok, too_long, TEN, "ok"])


def test_equal_text_of_two_products_counts_once_whatever_the_partitioning(spark):
    rows = [("scope1", n, float(s), i, f"text {i % 11}") for i, (n, s) in enumerate(
        [(f"p{k % 5}", k % 5 + 1) for k in range(200)])]
    df = spark.createDataFrame(rows, "scope string, name string, rating_star double, row_id long, "
                                     "comments string")
    answers = set()
    for parts in (1, 3, 7, 13):
        shuffled = df.orderBy(F.rand(parts)).repartition(parts)
        kept = dedup_comments(shuffled, ["scope"], ["name", "row_id"])
        answers.add(tuple(sorted(tuple(r) for r in kept.collect())))
    assert len(answers) == 1 and len(next(iter(answers))) == 11
    best = {}
    for r in sorted(rows, key=lambda r: (r[1], r[3])):
        best.setdefault(r[4], r)
    assert next(iter(answers)) == tuple(sorted(best.values()))


def test_dedup_without_other_columns(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "comments string")
    assert sorted(r[0] for r in dedup_comments(df).collect()) == ["a", "b"]


def test_scope_keeps_files_apart(spark):
    df = spark.createDataFrame([("f1", "5", TEN, "p"), ("f2", "1", TEN, "p")], "f string, " + RAW)
    assert clean_reviews(df, STRICT, ["f"]).count() == 2
    assert clean_reviews(df, STRICT).count() == 1
    got = {(r.f, r.rating) for r in score_reviews(df, ["f"]).collect()}
    assert got == {("f1", 5.0), ("f2", 1.0)}


def test_averages_ignore_what_is_no_rating(spark):
    df = spark.createDataFrame([("5", TEN, "p"), ("n/a", TEN + " a", "p"), ("2", TEN + " b", "p"),
                                ("n/a", TEN + " c", "q")], RAW)
    got = {r.name: r.rating for r in score_reviews(df).collect()}
    assert got == {"p": 3.5, "q": None}
    assert score_reviews(df).columns == ["name", "rating", "comments"]


def test_late_reviews_have_their_own_columns(spark):
    df = spark.createDataFrame([("5", "ngon", "p"), ("4", "ngon", "p")], RAW)
    late = score_late_reviews(df)
    assert late.columns == ["name", "average_rating", "cleaned_comment"]
    assert [tuple(r) for r in late.collect()] == [("p", 4.5, "ngon")] * 2


def test_hot_products_get_the_same_rating(spark):
    rows = [("s", "hot" if i % 3 else f"p{i % 40}", float(i % 5), i) for i in range(900)]
    df = spark.createDataFrame(rows, "scope string, name string, rating_star double, row_id long")
    plain = sorted(map(tuple, with_product_rating(df, ["scope"]).collect()))
    assert sorted(map(tuple, with_product_rating(df, ["scope"], rows_per_split=10).collect())) == plain
    avg = {r.name: r.rating for r in average_rating(df, ["scope"]).collect()}
    assert all(r[-1] == pytest.approx(avg[r[1]]) for r in plain) and len(plain) == 900


def test_first_product_per_scope_and_of_nothing(spark):
    df = spark.createDataFrame([("a", "z", 1), ("a", "y", 2), ("a", "y", 3), ("b", "x", 4), ("a", None, 5)],
                               "scope string, name string, i int")
    for split in (None, 1):
        got = sorted(r.i for r in only_first_product(df, ["scope"], rows_per_split=split).collect())
        assert got == [2, 3, 4]
    assert [r.i for r in only_first_product(df).collect()] == [4]
    assert only_first_product(df.filter("i > 9")).count() == 0
    assert score_reviews(spark.createDataFrame([], RAW)).count() == 0


def test_relaxed_profile_keeps_copies(spark):
    df = spark.createDataFrame([("5", "a!", "p"), ("5", "a", "p")], RAW)
    assert clean_reviews(df, RELAXED).count() == 2
