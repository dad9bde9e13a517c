"""Benchmark decontamination by pigeonhole edit matching.

A passage with at most k errors against a test item holds, of k + 1 pieces of the item, at least one unchanged. All
pieces are searched at once with an Aho-Corasick automaton; where one is found, the window in which the whole item
would lie is verified with Myers' bit-parallel distance. Texts are compared as their words, lower-cased, with one
space between them, so case, punctuation and line breaks don't matter.
"""

from __future__ import annotations

import re
from collections import defaultdict

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.llm.common import blocks_of, map_batches, text_or_empty

WORDS = re.compile(r"[^\W_]+")
#: So many words of a short item tell a passage; fewer are everyday speech ("yes", "the war").
WORDS_OF_PASSAGE = 3


def plain(text: str | None) -> str:
    return " ".join(WORDS.findall((text or "").lower()))


def myers(pattern: str, text: str) -> tuple[int, int]:
    """The least edit distance of the pattern to any stretch of the text, and where the first such one ends."""
    m = len(pattern)
    places: dict[str, int] = {}
    for i, c in enumerate(pattern):
        places[c] = places.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, now = full, 0, m
    best, end = m, 0
    for i, c in enumerate(text):
        same = places.get(c, 0)
        cross = same | down
        along = (((same & up) + up) ^ up) | same
        plus = down | (full & ~(along | up))
        minus = up & along
        if plus & top:
            now += 1
        elif minus & top:
            now -= 1
            if now < best:
                best, end = now, i + 1
        plus = plus << 1 & full
        minus = minus << 1 & full
        up = minus | (full & ~(cross | plus))
        down = plus & cross
    return best, end


class Matcher:
    """Test items, cut into pieces. Equal items are searched once.

    Items under ``min_chars`` are searched exactly, as whole words; those of fewer than ``WORDS_OF_PASSAGE`` words match whole
    texts only.
    """

    def __init__(self, items: list[tuple[int, str]], error_rate: float, min_chars: int) -> None:
        names: dict[str, list[int]] = defaultdict(list)
        for name, text in items:
            if clean := plain(text):
                names[clean].append(name)
        self.short = {t: n for t, n in names.items() if len(t) < min_chars}
        self.items = [(t, n, int(len(t) * error_rate)) for t, n in names.items() if len(t) >= min_chars]
        #: from here on, short items without a budget
        self.exact = len(self.items)
        self.items += [(t, n, 0) for t, n in self.short.items() if t.count(" ") + 1 >= WORDS_OF_PASSAGE]
        self.short = {t: n for t, n in self.short.items() if t.count(" ") + 1 < WORDS_OF_PASSAGE}
        pieces: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for j, (text, _, budget) in enumerate(self.items):
            cuts = [k * len(text) // (budget + 1) for k in range(budget + 2)]
            for x, y in zip(cuts, cuts[1:]):
                pieces[text[x:y]].append((j, x))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in pieces.items():
            self.automaton.add_word(piece, (len(piece), uses))
        if pieces:
            self.automaton.make_automaton()

    def find(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item, distance, budget, end in the plain text) with the least distance of each item within its budget."""
        clean = plain(text)
        found = [(name, 0, 0, len(clean)) for name in self.short.get(clean, ())]
        if not self.items or not clean:
            return found
        starts: dict[int, set[int]] = defaultdict(set)
        for end, (size, uses) in self.automaton.iter(clean):
            for j, x in uses:
                starts[j].add(end + 1 - size - x)
        for j, places in starts.items():
            item, names, budget = self.items[j]
            if j >= self.exact:
                ends = [x + len(item) for x in places if clean[max(0, x - 1) : x] in ("", " ") and clean[x + len(item) : x + len(item) + 1] in ("", " ")]
                found += [(name, 0, 0, min(ends)) for name in names if ends]
                continue
            best, at, done = budget + 1, 0, -1
            for start in sorted(places):
                low = max(0, start - budget)
                high = min(len(clean), start + len(item) + budget)
                if high <= done:
                    continue
                low = max(low, done - len(item) - budget) if done >= 0 else low
                distance, end = myers(item, clean[low:high])
                done = high
                if distance < best:
                    best, at = distance, low + end
                    if not best:
                        break
            if best <= budget:
                found += [(name, best, budget, at) for name in names]
        return found


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_chars: int) -> list[list[tuple[int, str]]]:
    """The items in blocks of about ``block_chars`` characters, each small enough to be sent to all tasks."""
    rows = items.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).filter("id IS NOT NULL")
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    count = blocks_of(total, block_chars)
    part = F.pmod(F.xxhash64("id", "text"), F.lit(count))
    return [[(r[0], r[1]) for r in rows.filter(part == k).collect()] for k in range(count)]


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    error_rate: float = 0.08,
    min_chars: int = 25,
    block_chars: int = 8_000_000,
) -> DataFrame:
    """One row per document and test item found in it: ``id_col, item_id_col, distance, budget, end``.

    An item may have ``error_rate`` times its length in edits; ``end`` is where it ends in the document's plain text.
    The items are sent to the tasks in blocks of ``block_chars`` characters, one pass over the documents each.

    * Null and empty texts hold nothing; items without words or without an id are not searched.
    * An item under ``min_chars`` characters is found without errors and as whole words only; if it has one or two
      words, only in documents that consist of it. Equal items are all reported. Of equally good places the first counts.
    * Texts may be of any length; each is searched whole. Repeated rows and null document ids give rows of their own.
    * Other columns are ignored. Empty tables give an empty result.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    item_type = items.schema[item_id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, `{item_id_col}` {item_type}, distance int, budget int, end bigint"
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    return _union([map_batches(rows, _searcher(block, error_rate, min_chars, (id_col, item_id_col)), schema) for block in item_blocks(items, item_id_col, item_text_col, block_chars)])


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _searcher(block: list[tuple[int, str]], error_rate: float, min_chars: int, names: tuple[str, str]):
    made: list[Matcher] = []

    def search(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        if not made:
            made.append(Matcher(block, error_rate, min_chars))
        rows, owners = [], []
        for i, text in enumerate(batch.column(1)):
            for found in made[0].find(text.as_py()):
                owners.append(i)
                rows.append(found)
        if not rows:
            return None
        kinds = [None, pa.int32(), pa.int32(), pa.int64()]
        columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(owners)), *columns], names=[*names, "distance", "budget", "end"]
        )

    return search


def drop_contaminated(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    error_rate: float = 0.08,
    min_chars: int = 25,
    block_chars: int = 8_000_000,
) -> DataFrame:
    """The documents that hold no test item, all columns unchanged. Each row is judged where it is read; none moves."""
    place = docs.columns.index(text_col)
    for block in item_blocks(items, item_id_col, item_text_col, block_chars):
        docs = map_batches(docs, _cleaner(block, place, error_rate, min_chars), docs.schema)
    return docs


def _cleaner(block: list[tuple[int, str]], place: int, error_rate: float, min_chars: int):
    made: list[Matcher] = []

    def clean(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not made:
            made.append(Matcher(block, error_rate, min_chars))
        return batch.filter(pa.array([not made[0].find(t.as_py()) for t in batch.column(place)], pa.bool_()))

    return clean
