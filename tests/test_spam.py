import random

import pytest

from reviewloom.functions import spam


def test_every_keyword_is_found_in_any_case_and_inside_words(column):
    words = list(spam.SPAM_KEYWORDS)
    assert len(words) == len(set(words)) == 148
    texts = [f"x{w.upper()}x" for w in words]
    assert all(column(texts, spam.has_spam_keyword))


@pytest.mark.parametrize("value,hit", [("mua online di", True), ("SĐT 09", True), ("gửi Ship COD", True),
                                       ("quá đẹp", False), ("", False), ("dịch vụ tốt", False)])
def test_keyword_examples(column, value, hit):
    assert column([value], spam.has_spam_keyword) == [hit]


def test_pattern_equals_one_test_per_keyword(column):
    rnd = random.Random(3)
    pieces = [w[:k] for w in spam.SPAM_KEYWORDS for k in (2, len(w) - 1, len(w))] + [" ", "a", "."]
    texts = ["".join(rnd.choices(pieces, k=rnd.randint(1, 3))) for _ in range(800)]
    want = [any(k.lower() in t.lower() for k in spam.SPAM_KEYWORDS) for t in texts]
    assert 100 < sum(want) < 800
    assert column(texts, spam.has_spam_keyword) == want


def test_own_keyword_list_is_taken_literally(column):
    keywords = ["a.b", "C++", "x|y", "[z]"]
    texts = ["a.b", "axb", "c++", "cc", "x|y", "x", "[z]", "z"]
    got = column(texts, lambda c: spam.has_spam_keyword(c, keywords))
    assert got == [True, False] * 4
    assert column(["a", None], lambda c: spam.has_spam_keyword(c, [])) == [False, False]


def test_verdict_and_reason(column):
    texts = ["ok ngon", "xem http://a.b", "gọi sđt", "tám ký tự dàidàidài", "ftp www.x"]
    assert column(texts, spam.is_spam) == [False, True, True, True, True]
    assert column(texts, spam.spam_reason) == [None, "keyword", "keyword", "long_token", "keyword"]
    assert column(["http://a"], lambda c: spam.spam_reason(c, ["zz"])) == ["url"]
