"""Words of texts as numbers, n-grams as 64-bit keys, and sorted keys as compact bytes."""

from __future__ import annotations

import numpy as np
import xxhash
import zstandard

from rillmark.llm.minhash import U, mix

#: A byte that UTF-8 never holds: it stands between texts, or between pieces of a text.
BORDER = b"\xff"
STEP = U(0x9E3779B97F4A7C15)


class Words(dict):
    """Numbers words in the order they come; 0 is the border."""

    def __init__(self) -> None:
        super().__init__({BORDER: 0})
        self.names: list[bytes] = [BORDER]
        self.hashes = np.zeros(1, dtype="u8")
        self.done = 1

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self.names)
        self.names.append(word)
        return n

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.int32, count=len(words))

    def hashed(self) -> np.ndarray:
        """A 64-bit hash of each word, by number."""
        if self.done < len(self.names):
            new = np.fromiter(map(xxhash.xxh3_64_intdigest, self.names[self.done :]), dtype="u8", count=len(self.names) - self.done)
            self.hashes, self.done = np.concatenate([self.hashes, new]), len(self.names)
        return self.hashes


def chained(hashes: np.ndarray, n: int, start: int = 0) -> np.ndarray:
    """A key for each run of ``n`` adjacent words, from the words' hashes."""
    rows = max(0, len(hashes) - n + 1)
    total = np.full(rows, (start + n) % 2**64, dtype="u8")
    for k in range(n):
        total = mix(total * STEP + hashes[k : k + rows])
    return total


def counted(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in ascending order, and how often each comes or what its weights add up to."""
    if not len(keys):
        return keys, np.zeros(0, dtype=np.int64)
    if weights is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, weights = keys[order], weights[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    if weights is None:
        return keys[starts], np.diff(starts, append=len(keys))
    return keys[starts], np.add.reduceat(weights.astype(np.int64), starts)


def pack_numbers(values: np.ndarray) -> bytes:
    """Whole numbers that are not negative, as bytes: the planes of their bytes, compressed."""
    values = np.ascontiguousarray(values, dtype="<u8")
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 0
    planes = values.view(np.uint8).reshape(-1, 8)[:, :width].T
    return zstandard.ZstdCompressor(level=1).compress(bytes([width]) + np.ascontiguousarray(planes).tobytes())


def unpack_numbers(data: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(data)
    width = raw[0]
    if not width:
        return np.zeros(0, dtype="u8")
    planes = np.frombuffer(raw, np.uint8, offset=1).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    out[:, :width] = planes.T
    return out.reshape(-1).view("<u8")


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending keys, as bytes of their differences."""
    return pack_numbers(np.diff(keys, prepend=U(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack_numbers(data), dtype="u8")
