import random
import re

import pytest
from pyspark.sql import functions as F

from reviewloom.functions import names, text

# letters and digits of several scripts, marks, punctuation, and all sorts of whitespace
ALPHABET = list("ab1Zđàñß漢ए٣_") + ["\u0301", "\U0001F600", "\U00010400"] + \
    list(" \t\n\r\x0b\x0c\x1c\x1f\x85\u3000\u00a0\u2003\u2028") + list(".,!?()-'\"/:@#$%")


def random_texts(n=600, seed=5):
    rnd = random.Random(seed)
    out = ["", " ", "...", "\u00a0", "a" * 6, "a" * 7, "a" * 8, "a" * 9, "abc.def", "1234567"]
    for _ in range(n):
        words = rnd.randint(0, 14)
        out.append("".join("".join(rnd.choices(ALPHABET, k=rnd.randint(1, 5)))
                           + rnd.choice([" ", "", ". ", "\u00a0", "\n"]) for _ in range(words)))
    return out


def test_clean_text_keeps_letters_and_digits(column):
    got = column(["  Giá   rẻ!!! \t đẹp\x0b1 ", "đe\u0323p", "???", "", None, "a\u00a0b",
                  "a_b-c"], text.clean_text)
    # a decomposed accent is no letter and turns into a blank
    assert got == ["Giá rẻ đẹp 1", "đe p", "", "", None, "a b", "a b c"]


def test_clean_text_is_idempotent(column):
    once = column(random_texts(), text.clean_text)
    assert column(once, text.clean_text) == once


@pytest.mark.parametrize("word,kept", [("a" * 6, True), ("a" * 7, False), ("aaa.aaaa", True),
                                       ("quá" * 2, True), ("quá" * 2 + "x", False)])
def test_long_token_blanks_the_whole_comment(column, word, kept):
    cleaned = column([f"ok {word} ok"], text.clean_text)[0]
    got = column([cleaned], text.blank_if_long_token)[0]
    assert got == (cleaned if kept else "")


def test_rules_on_raw_text_equal_rules_on_cleaned_text(spark):
    df = spark.createDataFrame([(t,) for t in random_texts()], "v string")
    cleaned = df.withColumn("c", text.clean_text("v")).withColumn("ts", F.split("c", " "))
    differs = cleaned.filter(
        (text.cleans_to_text("v") != (F.length("c") > 0))
        | (text.cleans_to_short_tokens("v", 6)
           != (F.length(text.blank_if_long_token("c", 6)) == F.length("c")))
        | (text.cleans_to_short_tokens("v", 6) != ~F.exists("ts", lambda t: F.length(t) > 6))
        | (text.cleans_to_min_words("v", 4) != (F.size("ts") >= 4))
        | (text.cleans_to_max_chars("v", 12) != (F.length("c") <= 12)))
    assert differs.count() == 0


def test_cleaned_length_limit_looks_at_the_cleaned_text(column):
    padded = "!" * 5000 + "a b"
    exact, over = "a " * 1499 + "ab", "a " * 1500 + "a"
    assert len(exact) == 3000 and len(over) == 3001
    got = column([padded, exact, over], lambda c: text.cleans_to_max_chars(c, 3000))
    assert got == [True, True, False]


def test_word_rules_on_raw_text_follow_unicode_whitespace(column):
    texts = random_texts(seed=6)
    got = column(texts, lambda c: text.has_min_words(c, 4))
    assert got == [len(t.split()) >= 4 for t in texts]
    got = column(texts, lambda c: text.has_long_token(c, 8))
    assert got == [any(len(w) > 8 for w in t.split()) for t in texts]


@pytest.mark.parametrize("value,found", [
    ("http://a", True), ("see https://x.y/z now", True), ("https://", False), ("http:// x", False),
    ("HTTP://a", False), ("http://é", False), ("https://%41", True), ("http://!", True),
    ("http://~", False), ("ttp://a", False)])
def test_url(column, value, found):
    assert column([value], text.has_url) == [found]


def test_flatten_lines_replaces_one_for_one(column):
    assert column(["a\r\nb\n\nc", "x", None], text.flatten_lines) == ["a  b  c", "x", None]


def test_sanitize(column):
    texts = [t for t in random_texts(seed=7) if "\u0301" not in t]

    def plain(t, keep, n):
        return re.sub(keep, "", " ".join(t.split()))[:n]

    assert column(texts, lambda c: text.sanitize_text(c, 20)) == [
        plain(t, r"[^\w\s.,!?()-]", 20) for t in texts]
    assert column(texts, lambda c: text.sanitize_name(c, 10)) == [
        plain(t, r"[^\w\s-]", 10) for t in texts]
    assert column(["x" * 1500], text.sanitize_text) == ["x" * 1000]
    assert column(["x" * 300], text.sanitize_name) == ["x" * 200]


def test_extract_ids(column):
    got = column(["https://m/name-i.12.345?sp=i.9.9", "i.1.2 i.3.4", "no ids", "i.12", None],
                 names.extract_ids)
    assert [(r.itemid, r.shopid) for r in got] == [
        ("345", "12"), ("2", "1"), (None, None), (None, None), (None, None)]


def test_data_path(column):
    got = column(["1_2", "1_2.csv", "csv"], lambda c: names.data_path(c, "/data/raw/"))
    assert got == ["/data/raw/1_2.csv", "/data/raw/1_2.csv", "/data/raw/csv.csv"]


def test_accents_apart_are_composed_only_when_asked(column):
    import unicodedata

    from reviewloom.functions.text import clean_text, compose_accents
    letters = "".join(chr(c) for c in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)] if chr(c).isalpha())
    whole = ["Rất tốt, Đẹp lắm!", letters, "plain", "", None, "가각", "ạ́", "́x", "q̇"]
    apart = [t and unicodedata.normalize("NFD", t) for t in whole]
    want = [t and unicodedata.normalize("NFC", t) for t in whole]
    assert column(apart, compose_accents) == want
    assert column(apart, lambda c: clean_text(c, compose=True)) == column(want, clean_text)
    assert column(apart[:1], clean_text) == ["Ra t to t Đe p la m"]
    assert column(whole[:1], clean_text) == ["Rất tốt Đẹp lắm"]
