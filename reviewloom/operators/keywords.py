"""Keyword lists of any length: which texts hold any of many phrases, and which ones.

A pattern of all keywords is tried at every place of every text, so its cost grows with the list. Here the list is
indexed: each keyword is filed under its rarest trigram, as the texts have it, and a text meets only the keywords
that are filed under one of its own trigrams. ``contains`` then decides.

To say only whether a text holds any keyword, a list of moderate length is written as patterns of its own shape: what
begins alike is named once, and places where the next characters rule every keyword out are left at once.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.operators.skew import spread_join
from reviewloom.session import land

GRAM = 3
#: An index of so many bytes of text is broadcast; a larger one is joined.
BROADCAST_BYTES = 32_000_000
#: Patterns name so many characters of a keyword; ``contains`` decides about longer ones.
BEGIN = 64
#: Bytes of a pattern, which each row is charged for, and patterns of a list, each of which reads the texts.
PATTERN_BYTES = 24_000
PATTERNS = 16
#: Keywords of so many characters up to the next number share a look ahead; fewer than ``ALIKE`` need none.
LENGTHS = (1, 2, 4, 7)
ALIKE = 8
#: Ways on that are tried one after the other, as those of an alphabet; of more, a part is chosen first.
WAYS = 32


def grams(text: Column, sizes: Sequence[int]) -> Column:
    """Distinct runs of ``sizes`` characters, in one pass over the text for each size; none where it is shorter.

    Beside characters outside the basic plane there are runs that begin inside one; a keyword and the texts
    that hold it have the same.
    """
    runs = [F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{s}}}))"), F.lit(1)) for s in sizes]
    return F.array_distinct(F.concat(*runs))


def _among(placed: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows whose gram is wanted; grams of up to ``BROADCAST_BYTES`` in all meet the rows where these are made."""
    bytes_ = wanted.agg(F.sum(F.octet_length("gram"))).first()[0] or 0
    return placed.join(F.broadcast(wanted) if bytes_ <= BROADCAST_BYTES else wanted, "gram", "left_semi")


def _asked(keywords: DataFrame, keyword: str) -> DataFrame:
    """``keyword``: those that are neither null nor empty, in lower case and once. Landed."""
    return land(keywords.select(F.lower(keyword).alias("keyword")).filter("keyword <> ''").distinct(), "keywords")


def index_keywords(keywords: DataFrame, texts: DataFrame, keyword: str = "keyword",
                   text: str = "comment") -> tuple[DataFrame, list[int]]:
    """``gram, keyword``: each keyword, in lower case and once, under that of its trigrams which the fewest texts hold.

    A keyword of one or two characters is its own gram; the second result lists the sizes of all grams. Keywords
    with a gram that no text holds can match nothing and are left out, as are null and empty ones. Landed.
    """
    asked = _asked(keywords, keyword)
    size = F.least(F.length("keyword"), F.lit(GRAM))
    sizes = sorted(r[0] for r in asked.select(size.alias("s")).distinct().collect())  # three numbers at most
    if not sizes:
        return asked.select(F.lit("").alias("gram"), "keyword"), []
    filed = asked.select("keyword", F.explode(reduce(lambda found, s: F.when(size == s, grams(
        F.col("keyword"), [s])).otherwise(found), sizes, F.array().cast("array<string>"))).alias("gram"))
    # only grams of keywords are counted, however many others the texts have
    wanted = land(filed.select("gram").distinct(), "grams")
    met = _among(texts.select(F.explode(grams(F.lower(text), sizes)).alias("gram")), wanted)
    counts = met.groupBy("gram").agg(F.count(F.lit(1)).alias("n_texts"))
    least = filed.join(counts, "gram", "left").groupBy("keyword").agg(
        F.min(F.struct(F.coalesce("n_texts", F.lit(0)).alias("n_texts"), "gram")).alias("best"))
    found = least.filter("best.n_texts > 0").select("best.gram", "keyword")
    return land(found, "keyword_index"), sizes


def keyword_hits(texts: DataFrame, keywords: DataFrame, keys: Sequence[str], keyword: str = "keyword",
                 text: str = "comment", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``keys, keyword``: one row for each keyword that a text holds anywhere, in lower case, inside words too.

    ``keys`` tell the rows of ``texts`` apart. Null texts hold nothing. An index up to ``broadcast_bytes`` meets the
    texts where they are read; a larger one is joined with their grams, and the texts with what that leaves.
    """
    index, sizes = index_keywords(keywords, texts, keyword, text)
    if not sizes:
        return texts.select(*keys, F.lit("").alias("keyword")).filter(F.lit(False))
    low = texts.select(*keys, F.lower(text).alias("__low"))
    bytes_ = index.agg(F.sum(F.octet_length("gram") + F.octet_length("keyword"))).first()[0] or 0
    placed = low.select("*", F.explode(grams(F.col("__low"), sizes)).alias("gram"))
    if bytes_ <= broadcast_bytes:
        met = placed.join(F.broadcast(index), "gram")
    else:
        # of a text's grams few are in the index, and only these are shuffled
        here = _among(placed.select(*keys, "gram"), index.select("gram").distinct())
        pairs = here.join(index, "gram").select(*keys, "keyword")
        met = pairs.join(low, list(keys))
    return met.filter(F.contains("__low", "keyword")).select(*keys, "keyword")


def _literal(text: str) -> str:
    return "".join(c if c.isalnum() else f"\\x{{{ord(c):x}}}" for c in text)


def _any_of(characters: Iterable[str]) -> str:
    """A class of the characters, if all are of Latin-1; beyond, where classes are tried one by one, of any other too."""
    known = sorted(set(characters))
    more = "\\x{100}-\\x{10ffff}" if known[-1] > "\xff" else ""
    return f"[{_literal(''.join(c for c in known if c <= '\xff'))}{more}]"


def _either(ways: Sequence[tuple[str, str]]) -> str:
    """One of the patterns, each after its first character and in the order of these; many are searched as a tree."""
    if len(ways) <= WAYS:
        return "|".join(pattern for _, pattern in ways)
    size = -(-len(ways) // WAYS)
    parts = [ways[i:i + size] for i in range(0, len(ways), size)]
    return "|".join(f"(?=[{_literal(part[0][0])}-{_literal(part[-1][0])}])(?:{_either(part)})" for part in parts)


def _branches(words: Sequence[str], at: int = 0) -> str:
    """A pattern of what ``words`` hold from place ``at`` on; sorted, alike before it, and none begins with another."""
    ends, ways = [], []
    for first, group in groupby(words, key=lambda w: w[at]):
        alike = list(group)
        if len(alike) > 1:
            ways.append((first, _literal(first) + _branches(alike, at + 1)))
        elif len(alike[0]) > at + 1 or first > "\xff":
            ways.append((first, _literal(alike[0][at:])))
        else:
            ends.append(first)
    either = "|".join(([_any_of(ends)] if ends else []) + ([_either(ways)] if ways else []))
    return either if bool(ends) + len(ways) == 1 else f"(?:{either})"


def _patterns(words: Sequence[str]) -> list[str]:
    """Patterns of ``PATTERN_BYTES`` each, as a rule, that together match each of ``words``, sorted as above, anywhere."""
    if not words:
        return []
    ways = []
    for low, high in zip(LENGTHS, (*LENGTHS[1:], BEGIN + 1), strict=True):
        alike = [w for w in words if low <= len(w) < high]
        if len(alike) > ALIKE and low > 1:
            ahead = "".join(_any_of(w[i] for w in alike) for i in range(low))
            ways.append(f"(?={ahead}){_branches(alike)}")
        elif alike:
            ways.append(_branches(alike))
    pattern = "|".join(ways)
    if len(pattern.encode()) <= PATTERN_BYTES or len(words) == 1:
        return [pattern]
    return _patterns(words[:len(words) // 2]) + _patterns(words[len(words) // 2:])


def _begins(asked: DataFrame) -> tuple[list[str], list[str]] | None:
    """Patterns of the keywords of up to ``BEGIN`` characters, and of the first characters of longer ones.

    Keywords that begin with another one are left out: a text that holds them holds the other. None if there would be
    more than ``PATTERNS``.
    """
    begin = F.substring("keyword", 1, BEGIN + 1)
    begins = asked.select(begin.alias("begin")).distinct()
    if (begins.agg(F.sum(F.octet_length("begin"))).first()[0] or 0) > PATTERNS * PATTERN_BYTES:
        return None
    least: list[str] = []
    for word in sorted(r[0] for r in begins.collect()):
        if not (least and word.startswith(least[-1])):
            least.append(word)
    whole = _patterns([w for w in least if len(w) <= BEGIN])
    longer = _patterns(sorted({w[:BEGIN] for w in least if len(w) > BEGIN}))
    return (whole, longer) if len(whole) + len(longer) <= PATTERNS else None


def _holders(texts: DataFrame, keywords: DataFrame, keys: Sequence[str], keyword: str, text: str,
             broadcast_bytes: int) -> DataFrame:
    """``keys`` of the texts that hold any of the keywords, as ``keyword_hits`` finds them."""
    asked = _asked(keywords, keyword)
    patterns = _begins(asked)
    if patterns is None:
        return keyword_hits(texts, keywords, keys, keyword, text, broadcast_bytes).select(*keys)
    low = texts.select(*keys, F.lower(text).alias("__low"))
    index = asked.select(F.substring("keyword", 1, BEGIN).alias("gram"), "keyword")
    bytes_ = index.agg(F.sum(F.octet_length("gram") + F.octet_length("keyword"))).first()[0] or 0
    holders = texts.select(*keys).filter(F.lit(False))
    # the first whole keyword says it all; of the beginnings of longer ones any may be the one
    for cut, some in zip((r"(?s)\A.*?({})", "(?=({}))"), patterns, strict=True):
        if not some:
            continue
        found = F.concat(*[F.regexp_extract_all("__low", F.lit(cut.format(p)), F.lit(1)) for p in some])
        placed = low.select("*", F.explode(F.array_distinct(found)).alias("gram"))
        if bytes_ <= broadcast_bytes:
            met = placed.join(F.broadcast(index), "gram").filter(F.contains("__low", "keyword"))
        else:
            met = placed.select(*keys, "gram").join(index, "gram")
            if some is patterns[1]:
                begun = low.filter(reduce(Column.__or__, [F.col("__low").rlike(p) for p in some]))
                met = met.join(begun, list(keys)).filter(F.contains("__low", "keyword"))
        holders = holders.union(met.select(*keys))
    return holders


def mark_keywords(texts: DataFrame, keywords: DataFrame, keys: Sequence[str], keyword: str = "keyword",
                  text: str = "comment", into: str = "has_keyword", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``texts`` with whether they hold any of the keywords, as ``spam.has_spam_keyword`` would say; null for null."""
    hit = _holders(texts, keywords, keys, keyword, text, broadcast_bytes).distinct()
    # asked before the join, so that texts which nobody selects are not shuffled
    known = texts.withColumn("__known", F.col(text).isNotNull())
    found = spread_join(known, hit.withColumn("__hit", F.lit(True)), list(keys), "left")
    said = F.when(F.col("__known"), F.coalesce("__hit", F.lit(False)))
    return found.withColumn(into, said).drop("__hit", "__known")
