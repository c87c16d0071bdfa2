"""License notices in texts: fixed phrases, and blocks that contain most of a known notice.

The blocks of a text are windows of ``BLOCK`` words, every ``STEP`` words, so a notice that fits
in ``STEP`` words lies whole in one of them, however its lines are broken. A block matches a template if it
holds a large enough share of the template's distinct words. Matches are found by an exact set-similarity
join: words are ordered by how often the whole corpus uses them, rarest first; a block that shares
enough words must share one of the template's first few (prefix filter), must have enough template words
at all (length filter), and, from the first shared word on, enough must be left on both sides
(positional filter). What passes is counted exactly.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from reviewloom.llm.batches import slices
from reviewloom.llm.columns import column
from reviewloom.llm.words import words_of

# Phrases whose words stand consecutively.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Opening words of well-known public notices.
TEMPLATES = (
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are "
            "permitted provided that the following conditions are met"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms "
            "of the gnu general public license"),
    ("gpl", "licensed under the gnu general public license version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or "
            "without fee is hereby granted"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this "
            "software and associated documentation files"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("public-domain", "this is free and unencumbered software released into the public domain"),
)
THRESHOLD = 0.85
BLOCK, STEP = 64, 32
#: Templates travel with the functions; their words are refused beyond this number.
MAX_TEMPLATE_WORDS = 100_000

FOUND = ("struct<n_words:bigint,n_base:bigint,first_word:bigint,last_word:bigint,"
         "base_labels:array<string>,labels:array<string>,score:double,"
         "blocks:array<struct<start:bigint,template:int,containment:double>>>")


def needed(template_words: int, threshold: float = THRESHOLD) -> int:
    """Shared words that make a template of so many distinct words match."""
    return math.ceil(round(threshold * template_words, 9))


def _vocabulary(templates: tuple[tuple[str, str], ...]) -> set[bytes]:
    words = {w for _, text in templates for w in words_of(text.encode())}
    if len(words) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"templates have more than {MAX_TEMPLATE_WORDS} words")
    return words


def word_counts(docs: DataFrame, text: str, words: set[bytes]) -> dict[bytes, int]:
    """How often the whole corpus uses each of ``words``; one number per template word is collected."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: defaultdict[bytes, int] = defaultdict(int)
        for part in slices(batch.column(0) for batch in batches):
            for t in part:
                for w in filter(words.__contains__, words_of(t)):
                    total[w] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()),
                                          pa.array(list(total.values()), pa.int64())], ["word", "n"])
    counted = docs.select(column(text)).mapInArrow(count, "word binary, n bigint")
    found = {bytes(r["word"]): r["n"] for r in
             counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    return {w: found.get(w, 0) for w in words}


class _Index:
    """Templates by the words of their prefixes, all in one order of words."""

    def __init__(self, templates: tuple[tuple[str, str], ...], counts: dict[bytes, int],
                 threshold: float):
        self.order = {w: i for i, w in enumerate(sorted(counts, key=lambda w: (counts[w], w)))}
        self.sets = [sorted({self.order[w] for w in words_of(text.encode())}) for _, text in templates]
        self.needed = [needed(len(s), threshold) for s in self.sets]
        self.least = min(self.needed, default=0)
        self.prefix: defaultdict[int, list[tuple[int, int]]] = defaultdict(list)
        for t, words in enumerate(self.sets):
            for place, w in enumerate(words[:len(words) - self.needed[t] + 1]):
                self.prefix[w].append((t, place))

    def matches(self, block: list[int]) -> Iterator[tuple[int, float]]:
        """Templates that ``block``, distinct words in order, holds enough of."""
        if len(block) < self.least:
            return
        tried = set()
        for place, w in enumerate(block):
            for t, at in self.prefix.get(w, ()):
                if t not in tried:
                    tried.add(t)  # the first shared word of the two
                    least = self.needed[t]
                    if (len(block) >= least
                            and 1 + min(len(block) - place - 1, len(self.sets[t]) - at - 1) >= least):
                        shared = len(set(block).intersection(self.sets[t]))
                        if shared >= least:
                            yield t, shared / len(self.sets[t])


def _places(words: list[bytes], phrase: list[bytes]) -> list[int]:
    found, at = [], -1
    while True:
        try:
            at = words.index(phrase[0], at + 1)
        except ValueError:
            return found
        if words[at:at + len(phrase)] == phrase:
            found.append(at)


def scan_text(text: bytes | None, index: _Index, labels: list[str]) -> tuple:
    """One row of ``FOUND``."""
    words = words_of(text)
    base, starts = set(), []
    present = set(words)
    for phrase, label in PHRASES:
        parts = [p.encode() for p in phrase.split()]
        if present.issuperset(parts):
            places = _places(words, parts)
            if places:
                base.add(label)
                starts += places
    blocks = []
    if not present.isdisjoint(index.order):
        known = [(i, index.order[w]) for i, w in enumerate(words) if w in index.order]
        # only windows around a word that stands in some template's prefix can match
        starts_of = {s for i, w in known if w in index.prefix
                     for s in range(max(0, (i - BLOCK) // STEP + 1) * STEP, i + 1, STEP)}
        places = np.array([i for i, _ in known])
        for start in sorted(starts_of):
            if start and start + STEP >= len(words):
                continue  # lies in the window before
            low, high = np.searchsorted(places, [start, start + BLOCK])
            block = sorted({w for _, w in known[low:high]})
            blocks += [{"start": start, "template": t, "containment": share}
                       for t, share in sorted(index.matches(block))]
    found = base | {labels[b["template"]] for b in blocks}
    score = 1.0 if base else max((b["containment"] for b in blocks), default=0.0)
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None),
            sorted(base), sorted(found), score, blocks)


def license_scan(docs: DataFrame, text: str = "text",
                 templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD,
                 into: str = "license") -> DataFrame:
    """``docs`` with a struct ``into`` as in ``FOUND``; the corpus is read twice and nothing is shuffled
    but the counts of the templates' words.

    One row per input row; null and empty texts have no word and no label; an existing column of that
    name is replaced. ``score`` is 1 with a phrase, else the largest share of a template in a block
    that matches, else 0. The order of words only decides how much is filtered early, never a result.
    """
    index = _Index(templates, word_counts(docs, text, _vocabulary(templates)), threshold)
    return docs.withColumn(into, _scanner(index, [label for label, _ in templates])(column(text)))


def _scanner(index: _Index, labels: list[str]):
    kind = pa.struct([("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
                      ("last_word", pa.int64()), ("base_labels", pa.list_(pa.string())),
                      ("labels", pa.list_(pa.string())), ("score", pa.float64()),
                      ("blocks", pa.list_(pa.struct([("start", pa.int64()), ("template", pa.int32()),
                                                     ("containment", pa.float64())])))])

    @arrow_udf(FOUND)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in slices(batches):
            columns = zip(*(scan_text(t, index, labels) for t in part))
            yield pa.StructArray.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, kind)], fields=list(kind))
    return scan.asNondeterministic()  # never asked twice


def joined(labels: Column) -> Column:
    return F.array_join(labels, ",")
