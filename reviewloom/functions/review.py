"""The contract of a product review: what is valid, how it is prompted, what comes back."""

from __future__ import annotations

from collections.abc import Sequence
from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.functions.spam import SPAM_KEYWORDS, is_spam
from reviewloom.functions.text import _col, has_min_words

# Limits of a valid product review.
MAX_TEXT = 3000
MAX_NAME = 200
MAX_COMMENTS = 3000
MIN_STARS, MAX_STARS = 1, 5
MIN_WORDS = 4

# One prompt line per comment, and the prompt around the lines.
PROMPT_LINE = "Comment {number}: {text} (Số sao: {rating})"
PROMPT_TEMPLATE = """
    Định dạng trả lời:
    {{
        "product_name": "string",
        "summary": "string",
    }}
    "summary" :nội dung tóm tắt đến từ các comments tiêu cực và tích cực, hãy viết mạch lạc nhưng vẫn phải chi tiết, độ dài tối thiểu 30 từ.
    "comments" :các comment liên quan đến sản phẩm.
    Đây là các comment: {comments} về sản phẩm {product_name}.
    """

COMMENT = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("rating", T.IntegerType()),
])
SUMMARY = T.StructType([
    T.StructField("product_name", T.StringType()),
    T.StructField("summary", T.StringType()),
])


def valid_comment(text: Column | str, rating: Column | str) -> Column:
    """Text of 1 to 3000 characters and a whole rating from 1 to 5; false for nulls."""
    t, r = _col(text), _col(rating)
    ok = (F.length(t).between(1, MAX_TEXT)
          & r.between(MIN_STARS, MAX_STARS) & (r == F.floor(r)))
    return F.coalesce(ok, F.lit(False))


def useful_comment(text: Column | str, rating: Column | str,
                   keywords: Sequence[str] = SPAM_KEYWORDS) -> Column:
    """Valid, at least four words, and not spam."""
    return valid_comment(text, rating) & has_min_words(text, MIN_WORDS) & ~is_spam(text, keywords)


def filter_comment_array(comments: Column | str,
                         keywords: Sequence[str] = SPAM_KEYWORDS) -> Column:
    """The useful comments of one product's array, in their order."""
    return F.filter(_col(comments), lambda x: useful_comment(x["text"], x["rating"], keywords))


def reject_reason(product_name: Column | str, comments: Column | str) -> Column:
    """Why a product review is refused, or null. One bad comment refuses the whole product."""
    name, arr = _col(product_name), _col(comments)
    return (F.when(name.isNull() | ~F.length(name).between(1, MAX_NAME), "product_name")
             .when(arr.isNull() | ~F.size(arr).between(1, MAX_COMMENTS), "comment_count")
             .when(~F.forall(arr, lambda x: valid_comment(x["text"], x["rating"])), "comment"))


def _render(template: str, fields: dict[str, Column]) -> Column:
    """``str.format`` over columns: inserted values are never scanned for placeholders, and a
    missing value reads ``None`` rather than making the whole text null."""
    parts: list[Column] = []
    for literal, field, _, _ in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if field is not None:
            parts.append(F.coalesce(fields[field], F.lit("None")))
    return F.concat(*parts)


def prompt_lines(comments: Column | str, line: str = PROMPT_LINE) -> Column:
    """The comments numbered from 1, one line each."""
    numbered = F.transform(_col(comments), lambda x, i: _render(line, {
        "number": (i + 1).cast("string"), "text": x["text"],
        "rating": x["rating"].cast("string")}))
    return F.array_join(numbered, "\n")


def prompt_text(product_name: Column | str, comments: Column | str,
                template: str = PROMPT_TEMPLATE, line: str = PROMPT_LINE) -> Column:
    return _render(template, {"comments": prompt_lines(comments, line),
                              "product_name": _col(product_name)})


def parse_summary(c: Column | str) -> Column:
    """``struct(product_name, summary, is_valid)`` from a response; nulls when it is unusable."""
    parsed = F.from_json(_col(c), SUMMARY, {"mode": "PERMISSIVE"})
    valid = F.coalesce(parsed["product_name"].isNotNull() & parsed["summary"].isNotNull(),
                       F.lit(False))

    def kept(field: str) -> Column:
        return F.when(valid, parsed[field]).alias(field)

    return F.struct(kept("product_name"), kept("summary"), valid.alias("is_valid"))
