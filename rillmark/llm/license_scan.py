"""License scan with a positional index of rare words.

Templates are word sequences. A word's weight is its inverse document frequency over all documents. Each template is
filed under its rarest words that occur at all and the rarest word of its mandatory phrases, as postings (template,
position). As those phrases must stand whole, that one word proposes every place that can count. A document looks up
the rare words it holds; a word at place p with posting (t, q) proposes that t starts at p - q. Places proposed for a template are
scored by the weights of the template's words that stand at their relative positions, and count only if the
template's mandatory phrases stand there whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.llm.common import map_batches, text_or_empty

WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


@dataclass(frozen=True)
class Template:
    """A license text: its label, its words, the phrases that must stand in it, and the share of weight it needs."""

    label: str
    text: str
    mandatory: tuple[str, ...]
    share: float = 0.6


#: The phrases of the contract.
PHRASES = (
    Template("cc-by", "cc by", ("cc by",), 1.0),
    Template("gpl", "general public license", ("general public license",), 1.0),
    Template("reserved", "all rights reserved", ("all rights reserved",), 1.0),
)
#: Well-known license notices.
NOTICES = (
    Template("apache", "licensed under the apache license version 2 0", ("apache license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("source and binary forms",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("gpl-notice", "this work is licensed under the gnu general public license version 3", ("gnu general public license",)),
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("free of charge", "obtaining a copy")),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
)


def words_of(text: bytes) -> list[bytes]:
    """Words of a text in UTF-8, with A-Z in lower case."""
    return WORD.findall(text.lower())


class RareIndex:
    """Templates filed under their rarest words and the rarest of their mandatory phrases."""

    def __init__(self, base: tuple[Template, ...], notices: tuple[Template, ...], df: dict[bytes, int], n_docs: int, rare: int) -> None:
        self.templates = [*base, *notices]
        self.n_base = len(base)
        self.words = [words_of(t.text.encode()) for t in self.templates]
        self.idf = {w: math.log((n_docs + 1) / (df.get(w, 0) + 1)) + 1 for ws in self.words for w in ws}
        self.phrases = []
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for t, ws in enumerate(self.words):
            self.phrases.append([(self.find(p, ws), p) for p in map(words_of, (m.encode() for m in self.templates[t].mandatory))])
            there = sorted({w for w in ws if df.get(w, 0)}, key=lambda w: (-self.idf[w], w))
            must = [w for w in there if any(w in p for _, p in self.phrases[t])]
            for w in {*there[:rare], *must[:1]}:
                self.postings[w] += [(t, q) for q, x in enumerate(ws) if x == w]

    @staticmethod
    def find(part: list[bytes], whole: list[bytes]) -> int:
        for k in range(len(whole) - len(part) + 1):
            if whole[k : k + len(part)] == part:
                return k
        raise ValueError(f"a template lacks its mandatory phrase {part}")

    def scan(self, words: list[bytes]) -> tuple[list[int], set[str], set[str], float]:
        """Base places, base labels, labels of notices, best score."""
        postings = self.postings
        starts = {(t, p - q) for p, w in enumerate(words) if w in postings for t, q in postings[w]}
        places: list[int] = []
        base: set[str] = set()
        found: set[str] = set()
        best = 0.0
        for t, start in starts:
            if any(start + k < 0 or words[start + k : start + k + len(p)] != p for k, p in self.phrases[t]):
                continue
            own = self.words[t]
            total = sum(self.idf[w] for w in own)
            same = sum(self.idf[w] for k, w in enumerate(own) if 0 <= start + k < len(words) and words[start + k] == w)
            score = same / total
            if t < self.n_base:
                places.append(start)
                base.add(self.templates[t].label)
                best = 1.0
            elif score >= self.templates[t].share:
                found.add(self.templates[t].label)
                best = max(best, min(1.0, score))
        return places, base, found, best


def word_counts(docs: DataFrame, text_col: str, vocabulary: set[bytes]) -> tuple[dict[bytes, int], int]:
    """In how many of all documents each word of the templates stands, and the number of documents.

    Tasks count, Spark adds up; one number per template word reaches the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        n = 0
        for batch in batches:
            n += batch.num_rows
            for text in batch.column(0):
                seen.update(vocabulary.intersection(words_of(text.as_py().encode())))
        rows = [("", n), *((w.decode(), c) for w, c in sorted(seen.items()))]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], names=["word", "n"])

    parts = docs.select(text_or_empty(text_col)).mapInArrow(count, "word string, n bigint")
    total = {r[0]: r[1] for r in parts.groupBy("word").agg(F.sum("n")).collect()}
    return {w.encode(): c for w, c in total.items() if w}, total.get("", 0)


def license_scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    base: tuple[Template, ...] = PHRASES,
    notices: tuple[Template, ...] = NOTICES,
    rare: int = 3,
) -> DataFrame:
    """One row per document: ``id_col, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``n_base`` counts all places of base phrases, ``first_word`` and ``last_word`` are the smallest and largest. ``rare``
    is the number of words a template is filed under, next to one of its mandatory phrases, which finds every place.

    * Null and empty texts have no words, no places, empty labels and score 0. Texts may be of any length.
    * Places that overlap all count; of equally rare words the alphabetically first is used.
    * Repeated rows and null ids give a row each. Other columns are ignored. An empty table gives an empty result.
    """
    vocabulary = {w for t in (*base, *notices) for w in words_of(t.text.encode())}
    df, n_docs = word_counts(docs, text_col, vocabulary)
    index = RareIndex(base, notices, df, n_docs, rare)
    id_type = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64()]

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text in batch.column(1):
            words = words_of(text.as_py().encode())
            places, own, found, score = index.scan(words)
            first, last = (min(places), max(places)) if places else (None, None)
            rows.append((len(words), len(places), first, last, ",".join(sorted(own)), ",".join(sorted(own | found)), score))
        columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    schema = (
        f"`{id_col}` {id_type}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
        "base_labels string, labels string, score double"
    )
    return map_batches(docs.select(F.col(id_col), text_or_empty(text_col)), scan, schema)
