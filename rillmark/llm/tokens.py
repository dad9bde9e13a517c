"""Token ids of texts with a public vocabulary, by way of cached units.

The tokenizers library encodes each unit of its own splitting once; ids of repeated units come from a cache. Texts of
Latin-1 characters are split into units by a pattern that cuts them as the vocabulary's own does. Texts that hold other
characters or a special token are first cut into chunks, but only where that splitting must cut as well, so the ids
equal those of the whole text:

* ``drop`` (white space is dropped before merging): at every space;
* ``lead`` (a space belongs to the word after it): before a single space between two characters that aren't white
  space; the space stays with the chunk that follows.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator

import numpy as np

from rillmark.llm.common import kept

CUT = re.compile(r"(?<=\S) (?=\S)")
#: The letters, numbers and white space of Latin-1.
L, N, S = "a-zA-ZªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼-¾", r"\t-\r \x85\xa0"
ENDINGS = "'(?:[stmd]|re|ve|ll)"
#: How the vocabulary with word ends (lower-cased text) and that with leading spaces split text.
SPLITS = {
    "drop": re.compile(rf"[{L}]+|{ENDINGS}|[{N}]|[^{S}{L}{N}]+"),
    "lead": re.compile(rf" ?[{L}]+|{ENDINGS}| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"),
}
#: Characters of text that are cut at a time.
SEGMENT = 1 << 20
#: Longer units and chunks are encoded but not kept.
KEEP_CHARS = 64


def is_latin(text: str) -> bool:
    try:
        return text.isascii() or bool(text.encode("latin-1"))
    except UnicodeEncodeError:
        return False


def vocabulary_path(name: str) -> str:
    """A path as it is, or the place of a file of the public vocabularies."""
    if os.path.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder_for(vocabulary: str, spaces: str) -> ChunkEncoder:
    """An encoder whose cache tasks that follow each other in a worker process share."""
    return kept(("tokens", vocabulary, spaces), lambda: ChunkEncoder(vocabulary, spaces))


class Recent:
    """Ids of strings met lately, in two halves: when the new one is full it becomes the old one, from which strings that
    are met again move over, so frequent strings stay.
    """

    def __init__(self, entries: int, encode: Callable[[list[str]], list[bytes]]) -> None:
        self.half, self.encode = max(1, entries // 2), encode
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def known(self, wanted: set[str]) -> dict[str, bytes]:
        """A dictionary that has the ids of all these strings."""
        missing = wanted.difference(self.new)
        if len(self.new) + len(missing) > self.half:
            self.old, self.new = self.new, {}
            missing = wanted
        fresh = missing.difference(self.old)
        self.new.update([(p, self.old[p]) for p in missing.difference(fresh)])
        short = [p for p in fresh if len(p) <= KEEP_CHARS]
        if short:
            self.new.update(zip(short, self.encode(short)))
        if len(short) == len(fresh):
            return self.new
        other = [p for p in fresh if len(p) > KEEP_CHARS]
        return {p: self.new[p] for p in wanted if len(p) <= KEEP_CHARS} | dict(zip(other, self.encode(other)))


class ChunkEncoder:
    """Ids as little-endian unsigned 32-bit bytes.

    ``cache_entries`` bounds the cache of units, and half of it that of chunks.
    """

    def __init__(self, vocabulary: str, spaces: str, cache_entries: int = 1_200_000) -> None:
        from tokenizers import Tokenizer

        if spaces not in ("drop", "lead"):
            raise ValueError("spaces is 'drop' or 'lead'")
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(vocabulary_path(vocabulary))
        self.lead = spaces == "lead"
        self.split = SPLITS[spaces].findall
        self.units = Recent(cache_entries, self.encode_units)
        self.chunks = Recent(cache_entries // 2, self.encode_chunks)
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self.border = np.zeros(max(names.values()) + 1, dtype=bool)
        for name, i in names.items():
            self.border[i] = name.startswith("Ġ") if self.lead else name.endswith("</w>")

    def raw(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def joined(self, units: list[str]) -> list[bytes] | None:
        """Ids of many units by one call; None if the ids don't show where each unit ends.

        With ``lead`` the first token of a unit, and no other, starts with the mark of a space; with ``drop`` the last
        token of a unit that isn't split, and no other, ends with the mark of a word's end.
        """
        text = " ".join(units)
        found = self.tokenizer.encode_batch_fast([" " + text if self.lead else text], add_special_tokens=False)
        ids = np.array(found[0].ids, dtype="<u4")
        marks = np.flatnonzero(self.border[ids])
        if len(marks) != len(units):
            return None
        cuts = [*(4 * marks).tolist(), 4 * len(ids)] if self.lead else [0, *(4 * marks + 4).tolist()]
        raw = ids.tobytes()
        return [raw[x:y] for x, y in zip(cuts, cuts[1:])]

    def encode_units(self, units: list[str]) -> list[bytes]:
        """Ids of each of many units; with ``lead``, those after a space are joined."""
        if not self.lead:
            return self.joined(units) or self.raw(units)
        words = [u for u in units if u[0] == " " and not u.isspace()]
        made = dict(zip(words, self.joined([u[1:] for u in words]) or self.raw(words))) if words else {}
        other = [u for u in units if u not in made]
        made.update(zip(other, self.raw(other) if other else []))
        return [made[u] for u in units]

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of each of many chunks, by their units where the pattern tells them."""
        before = " " if self.lead else ""
        split, get = self.units_of([before + p for p in chunks])
        other = [p for p, units in zip(chunks, split) if units is None]
        found = self.joined(other) if self.lead and other else None
        made = iter(found or self.raw([before + p for p in other]))
        return [next(made) if units is None else b"".join(map(get, units)) for units in split]

    def units_of(self, texts: list[str]) -> tuple[list[list[str] | None], Callable[[str], bytes]]:
        """The units of each text, None where the pattern isn't known to cut as the tokenizer does, and their ids."""
        # all letters of Latin-1 are in composed form, and stay so when they are lower-cased
        split = [
            None if not is_latin(t) or any(name in t for name in self.special) else self.split(t if self.lead else t.lower())
            for t in texts
        ]
        return split, self.units.known(set().union(*(units for units in split if units))).__getitem__

    def by_chunks(self, texts: list[str]) -> list[bytes]:
        """Ids of each of any texts, cut where that is right."""
        split = [CUT.split(t) if self.lead else t.split(" ") for t in texts]
        # the chunk at the start of a text has no space before it
        starts = self.raw([parts.pop(0) for parts in split]) if self.lead else [b""] * len(texts)
        get = self.chunks.known(set().union(*split)).__getitem__
        return [start + b"".join(map(get, parts)) for start, parts in zip(starts, split)]

    def segments(self, text: str) -> Iterator[str]:
        """The text in pieces of about ``SEGMENT`` characters, parted at cuts; with ``lead`` the space is the next piece's."""
        at = 0
        while cut := CUT.search(text, at + SEGMENT):
            yield text[at : cut.start()]
            at = cut.start() if self.lead else cut.end()
        yield text[at:]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text. Unknown units of all the texts are encoded together; long texts go segment by segment."""
        if max(map(len, texts), default=0) > SEGMENT:
            return [b"".join(ids for s in self.segments(t) for ids in self.encode_segments([s])) for t in texts]
        return self.encode_segments(texts)

    def encode_segments(self, texts: list[str]) -> list[bytes]:
        split, get = self.units_of(texts)
        other = [t for t, units in zip(texts, split) if units is None]
        made = iter(self.by_chunks(other) if other else [])
        return [next(made) if units is None else b"".join(map(get, units)) for units in split]

    def encode_batch(self, texts: list[str], at_once: int = 256) -> Iterator[bytes]:
        """Ids of many texts, some at a time."""
        for k in range(0, len(texts), at_once):
            yield from self.encode(texts[k : k + at_once])
