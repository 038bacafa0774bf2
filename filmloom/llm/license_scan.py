"""License scans: phrases as they stand, and notices found by an exact containment join with templates.

A block is a window of words anywhere in the text, line breaks or not, ``STRETCH`` times as long as the template at most. A
template stands in a block if the block holds at least ``THRESHOLD`` of the template's distinct words. Words are ordered by
how many texts of the whole corpus hold them, rarest first; a text with such a block must share one of a template's first
words in that order (prefix filter), hold enough template words at all (length filter) and still have enough words to come
after the first shared one (positional filter). Over what passes, the window slides from template word to template word and
is counted exactly. The templates are a parameter with a bound, so each task holds them all; no table grows with the documents.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from fractions import Fraction
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filmloom.llm.common import slices

WORD_BYTES = rb"[0-9a-z\x80-\xff]+"
#: Phrases and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "released under the mit license"),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc0", "to the extent possible under law all copyright and related rights have been waived"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
)
THRESHOLD = Fraction(9, 10)
#: Words of a window per word of the template: room for a few words in between.
STRETCH = Fraction(3, 2)
MOST_TEMPLATES = 10_000

BLOCKS = "array<struct<label:string,first_word:long,n_words:long,score:double>>"
OUTPUT = {
    "n_words": "long",
    "n_base": "long",
    "first_word": "long",
    "last_word": "long",
    "base_labels": "string",
    "labels": "string",
    "score": "double",
    "blocks": BLOCKS,
}


def words(text: bytes, pattern: re.Pattern) -> list[bytes]:
    return pattern.findall(text)


def template_words(templates) -> list[tuple[str, list[bytes]]]:
    pattern = re.compile(WORD_BYTES)
    found = [(label, words(text.encode().lower(), pattern)) for label, text in templates]
    if len(found) > MOST_TEMPLATES or not all(w for _, w in found):
        raise ValueError(f"templates need words, and there may be {MOST_TEMPLATES} at most")
    return found


def text_frequency(docs: DataFrame, text: str, vocabulary: frozenset[bytes]) -> dict[bytes, int]:
    """In how many texts each template word occurs; as many rows as the templates have words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern, seen = re.compile(WORD_BYTES), Counter()
        for part in slices(batches, text, 4 << 20):
            for whole in part.column(text).to_pylist():
                seen.update(vocabulary.intersection(words((whole or "").encode().lower(), pattern)))
        columns = [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["word", "n"])

    counted = docs.select(text).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r["word"]): r["n"] for r in counted.collect()}


class TemplateIndex:
    """Prefix words of every template, in the corpus order of words."""

    def __init__(self, templates, frequency: dict[bytes, int], threshold: Fraction):
        every = frozenset().union(*(w for _, w in templates))
        sizes = [(label, frozenset(w), ceil(STRETCH * len(w))) for label, w in templates]
        self.rank = {w: i for i, w in enumerate(sorted(every, key=lambda w: (frequency.get(w, 0), w)))}
        self.templates = [(label, tokens, ceil(threshold * len(tokens)), width) for label, tokens, width in sizes]
        self.prefix: dict[bytes, list[tuple[int, int]]] = {}
        for t, (_, tokens, need, _) in enumerate(self.templates):
            ordered = sorted(tokens, key=self.rank.__getitem__)
            for place, word in enumerate(ordered[: len(ordered) - need + 1]):
                self.prefix.setdefault(word, []).append((t, place))

    def candidates(self, text: set[bytes]) -> list[int]:
        """Templates with enough of their words anywhere in a text."""
        own = sorted((w for w in text if w in self.rank), key=self.rank.__getitem__)
        found, tried = [], set()
        for i, word in enumerate(own):
            for t, place in self.prefix.get(word, ()):
                _, tokens, need, _ = self.templates[t]
                if t in tried:
                    continue
                tried.add(t)  # the first shared prefix word: nothing shared stands before it
                if len(own) < need or 1 + min(len(own) - i - 1, len(tokens) - place - 1) < need:
                    continue
                if len(tokens.intersection(own)) >= need:
                    found.append(t)
        return found

    def blocks(self, row: list[bytes]) -> list[tuple[str, int, int, float]]:
        """Label, first word, number of words and score; of windows that overlap, the best, then shortest, then first."""
        found = []
        for t in self.candidates(set(row)):
            label, tokens, need, width = self.templates[t]
            places = [i for i, w in enumerate(row) if w in tokens]
            held, left, end, best = Counter(), 0, -1, None
            for right in places:
                held[row[right]] += 1
                while right - places[left] >= width or held[row[places[left]]] > 1:  # a word that comes again isn't needed
                    word = row[places[left]]
                    held[word] -= 1
                    if not held[word]:
                        del held[word]
                    left += 1
                if len(held) < need:
                    continue
                first = places[left]
                mine = (-len(held), right - first + 1, first)
                if best is not None and first > end:
                    found.append((label, best[2], best[1], -best[0] / len(tokens)))
                    best = None
                best, end = mine if best is None else min(best, mine), right
            if best is not None:
                found.append((label, best[2], best[1], -best[0] / len(tokens)))
        return found


def scan(docs: DataFrame, text: str = "text", templates=TEMPLATES, threshold: Fraction = THRESHOLD) -> DataFrame:
    """Adds word and phrase counts, labels, the best template score, and every matched block.

    Only A-Z are lower-cased. A null text counts as empty and has no words. Rows are independent; repeated rows and null keys
    need no rule, an empty table gives an empty table. Columns called like an output are replaced.
    """
    named = template_words(templates)
    index = TemplateIndex(named, text_frequency(docs, text, frozenset().union(*(w for _, w in named))), threshold)
    phrases = [(p.encode().split(b" "), label) for p, label in PHRASES]
    added = list(OUTPUT)
    keep = [c for c in docs.columns if c not in added]
    schema = T.StructType([docs.schema[c] for c in keep] + list(T._parse_datatype_string(", ".join(f"{k} {v}" for k, v in OUTPUT.items()))))
    kind = pa.list_(
        pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("score", pa.float64())])
    )

    def judge(whole: str, pattern: re.Pattern) -> tuple:
        places, base, labels, blocks, best = [], set(), set(), [], 0.0
        row = words(whole.encode().lower(), pattern)
        for label, first, n, score in index.blocks(row):
            labels.add(label)
            best = max(best, score)
            blocks.append({"label": label, "first_word": first, "n_words": n, "score": score})
        for phrase, label in phrases:
            start = -1
            for _ in range(row.count(phrase[0])):
                start = row.index(phrase[0], start + 1)
                if row[start : start + len(phrase)] == phrase:
                    places.append(start)
                    base.add(label)
        first, last = (min(places), max(places)) if places else (None, None)
        return len(row), len(places), first, last, ",".join(sorted(base)), ",".join(sorted(base | labels)), best, blocks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = re.compile(WORD_BYTES)
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), kind]
        for part in slices(batches, text, 4 << 20):
            rows = [judge(x or "", pattern) for x in part.column(text).to_pylist()]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays([*map(part.column, keep), *columns], names=[*keep, *added])

    return docs.mapInArrow(run, schema)

