"""Shingle sets of texts and their SuperMinHash signatures, for whole batches of documents at a time."""

from __future__ import annotations

import numpy as np
import xxhash

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input reaches every bit of the output."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def shingle_set(text: str, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text.

    A-Z counts as a-z, words are parted by ASCII white space. A text of fewer words is one shingle, one without
    words has none.
    """
    parts = text.encode().lower().split()
    if not parts:
        return np.zeros(0, dtype="u8")
    n = min(words, len(parts))
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), dtype="u8", count=len(parts))
    rows = len(parts) - n + 1
    total = np.full(rows, n, dtype="u8")
    for k in range(n):
        total = mix(total * U(0x9E3779B97F4A7C15) + hashes[k : k + rows])
    return np.unique(total)


def set_digest(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart, as two signed numbers; they don't depend on any order."""
    one = mix(shingles ^ U(0xA0761D6478BD642F)).sum(dtype="u8")
    two = mix(shingles + U(0xE7037ED1A0B428DB)).sum(dtype="u8")
    return int(one.astype("i8")), int(two.astype("i8"))


def super_minhash(sets: list[np.ndarray], size: int) -> np.ndarray:
    """Signatures of some non-empty sets, one row each.

    Every element walks through a permutation of the places of its own; at step j it offers j plus a random fraction
    to the place it comes to, and the least offer of all elements stays. A set is finished as soon as all its places
    hold offers below j: later steps only offer more. An offer is j in the upper, the fraction in the lower 32 bits.
    """
    out = np.full((len(sets), size), np.iinfo(np.uint64).max, dtype="u8")
    flat = out.reshape(-1)
    elements = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets), dtype=np.int64), [len(s) for s in sets])
    places: np.ndarray | None = None
    kind = np.uint8 if size <= 256 else np.uint16
    for j in range(size):
        drawn = mix(elements + U(0x9E3779B97F4A7C15 * (2 * j + 1) % 2**64))
        k = j + (((drawn >> U(32)) * U(size - j)) >> U(32)).astype(np.int64)
        offer = (drawn & U(0xFFFFFFFF)) | U(j << 32)
        if j == 0:
            at, first = k, k
        else:
            rows = np.arange(len(elements))
            if places is None:
                places = np.tile(np.arange(size, dtype=kind), (len(elements), 1))
                places[:, 0] = first
                places[rows, first] = 0
            at = places[rows, k].astype(np.int64)
            places[rows, k] = places[:, j]
            places[:, j] = at
        np.minimum.at(flat, owner * size + at, offer)
        open_sets = np.zeros(len(sets), dtype=bool)
        there = np.unique(owner)
        open_sets[there] = out[there].max(axis=1) >= U((j + 1) << 32)
        stay = open_sets[owner]
        if not stay.any():
            break
        if not stay.all():
            elements, owner = elements[stay], owner[stay]
            first = first[stay]
            places = None if places is None else places[stay]
    return out


def band_hashes(signatures: np.ndarray, rows: int) -> np.ndarray:
    """One signed 64-bit hash per band of so many places; bands differ even where their places agree."""
    bands = signatures.shape[1] // rows
    total = np.tile(np.arange(bands, dtype="u8"), (len(signatures), 1))
    for k in range(rows):
        total = mix(total * U(0x9E3779B97F4A7C15) + signatures[:, k : bands * rows : rows])
    return total.astype("i8")


def rows_per_band(size: int, similarity: float, miss: float = 1e-6) -> int:
    """The most places per band with which a pair of that similarity shares no band at most that often."""
    fit = [r for r in range(1, size + 1) if (1 - similarity**r) ** (size // r) <= miss]
    return max(fit, default=1)
