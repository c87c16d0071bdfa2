"""Text rules for comments and product names.

Word tests are single regular expressions on the raw text instead of split-and-filter lambdas, so
they stay inside generated code and can sit below the projection that cleans the text.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as Unicode-aware string splitting sees it; Java's own \s is ASCII only.
SPACE = r"\s\p{Z}\x0B\x1C-\x1F\x85"

# A token of cleaned text is exactly a maximal run of these characters in the raw text, because
# everything else is turned into a blank.
WORD_CHAR = r"[\p{L}\p{N}]"
NON_WORD_CHAR = r"[^\p{L}\p{N}]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flatten_lines(c: Column | str) -> Column:
    """Newlines and carriage returns become blanks, one for one."""
    return F.translate(_col(c), "\n\r", "  ")


def compose_accents(c: Column | str) -> Column:
    """Letters with separate accents become one character each (Unicode's canonical composition).

    Only texts with an accent of their own, or with parts of Korean syllables, are handed to Python; for the
    others it gets a null.
    """
    @F.pandas_udf("string")
    def composed(texts: pd.Series) -> pd.Series:
        import unicodedata
        return texts.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")
    text = _col(c)
    return F.coalesce(composed(F.when(text.rlike(r"[\p{M}\u1100-\u11FF]"), text)), text)


def clean_text(c: Column | str, compose: bool = False) -> Column:
    """Everything but letters, digits and whitespace becomes a blank; blanks collapse; trim.

    A separate accent is neither, so it splits its word. ``compose`` joins accents and letters first.
    """
    text = compose_accents(c) if compose else _col(c)
    blanked = F.regexp_replace(text, r"[^\p{L}\p{N}\s]", " ")
    return F.trim(F.regexp_replace(blanked, r"\s+", " "))


def blank_if_long_token(c: Column | str, max_token_len: int = 6) -> Column:
    """Cleaned text, or ``''`` when any of its blank-separated tokens is longer than the limit."""
    cleaned = _col(c)
    return F.when(cleaned.rlike(rf"[^ ]{{{max_token_len + 1}}}"), F.lit("")).otherwise(cleaned)


def cleans_to_text(c: Column | str) -> Column:
    """Raw text that still holds something after ``clean_text``."""
    return _col(c).rlike(WORD_CHAR)


def cleans_to_short_tokens(c: Column | str, max_token_len: int = 6) -> Column:
    """Raw text whose cleaned form has no token longer than the limit."""
    return ~_col(c).rlike(rf"{WORD_CHAR}{{{max_token_len + 1}}}")


def cleans_to_min_words(c: Column | str, min_words: int) -> Column:
    """Raw text whose cleaned form has at least ``min_words`` tokens."""
    # tied to the start, so that a text with too few words is walked once
    return _col(c).rlike(
        rf"^{NON_WORD_CHAR}*+(?:{WORD_CHAR}++{NON_WORD_CHAR}++){{{min_words - 1}}}{WORD_CHAR}")


def cleans_to_max_chars(c: Column | str, max_chars: int) -> Column:
    """Raw text whose cleaned form is no longer than the limit.

    Cleaning never lengthens a text, so only raw texts above the limit are cleaned to find out.
    """
    raw = _col(c)
    return (F.length(raw) <= max_chars) | (F.length(clean_text(raw)) <= max_chars)


def has_min_words(c: Column | str, min_words: int) -> Column:
    """At least ``min_words`` whitespace-separated words in raw text."""
    return _col(c).rlike(
        rf"^[{SPACE}]*+(?:[^{SPACE}]++[{SPACE}]++){{{min_words - 1}}}[^{SPACE}]")


def has_long_token(c: Column | str, max_token_len: int = 8) -> Column:
    """Any whitespace-separated token of raw text longer than the limit."""
    return _col(c).rlike(rf"[^{SPACE}]{{{max_token_len + 1}}}")


def has_url(c: Column | str) -> Column:
    """``http://`` or ``https://`` followed by at least one URL character."""
    return _col(c).rlike(r"https?://[a-z!$-_]")


def _collapse(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(_col(c), rf"[{SPACE}]+", " "))


def sanitize_text(c: Column | str, max_chars: int = 1000) -> Column:
    """Collapse whitespace, keep word characters and ``.,!?()-``, cut to ``max_chars``."""
    kept = F.regexp_replace(_collapse(c), r"[^\p{L}\p{N}_ .,!?()\-]", "")
    return F.substring(kept, 1, max_chars)


def sanitize_name(c: Column | str, max_chars: int = 200) -> Column:
    """Collapse whitespace, keep word characters, blanks and ``-``, cut to ``max_chars``."""
    kept = F.regexp_replace(_collapse(c), r"[^\p{L}\p{N}_ \-]", "")
    return F.substring(kept, 1, max_chars)
