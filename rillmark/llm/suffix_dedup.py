"""Removal of repeated byte strings by distributed difference-cover sampling of suffixes.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere else. Sorting every suffix of a
corpus takes many times its size, so suffixes are first thinned out, on names instead of bytes:

1. Documents are parsed into short phrases whose borders depend on nearby content only, so equal strings are parsed
   alike. Of the sequence of phrase names, positions 1 and 2 modulo 3 are sampled: a difference cover, in which any
   two positions have a common sampled place at most two further on. Sampled triples of names are sorted.
2. Triples that occur once go. What is left of the sampled names decides, for each place of the text, whether a
   suffix there can share its first ``length`` bytes with another: all triples of one residue inside must recur.
3. These remaining suffixes get names for their whole ``length``-byte prefixes, which are sorted; equal neighbours
   are repeats.

Documents that are equal as a whole go as a whole; one part of the input speaks for them in both sorts. Names are
64-bit hashes. In both sorts each part of the input sends a name once, however often it occurs there, so a
string that stands in a third of all documents is one row per part.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.llm.common import blocks_of, filesystem, new_folder, stored, text_or_empty, write_file
from rillmark.llm.minhash import mix

U = np.uint64
#: Bytes of the grams that decide on borders, and grams among which the least makes a border. With these, a string of
#: 200 bytes holds at least three whole triples whose borders depend on that string alone.
GRAM, SPREAD = 4, 24
#: Places of a long document that are looked at together.
SEGMENT = 1 << 21
#: Names that a task gathers before it sends them.
GATHER = 4_000_000
BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 17)
        _POWERS[:] = [np.cumprod(np.full(size, x, dtype="u8")) for x in (U(BASE), U(pow(BASE, -1, 2**64)))]
    return _POWERS[0][:n], _POWERS[1][:n]


def sums_of(data: np.ndarray) -> np.ndarray:
    """Running sums from which the name of any stretch follows."""
    up, _ = powers(len(data))
    return np.concatenate([np.zeros(1, dtype="u8"), np.cumsum((data.astype("u8") + U(1)) * up)])


def names(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = powers(len(sums))
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype("u8") * U(0xD6E8FEB86659FD93))


def slide(values: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Least or greatest of each ``width`` neighbours."""
    of = np.minimum if least else np.maximum
    have = 1
    while 2 * have <= width:
        values = of(values[:-have], values[have:])
        have *= 2
    return of(values[: len(values) - (width - have)], values[width - have :]) if have < width else values


def borders(data: np.ndarray) -> np.ndarray:
    """Places whose gram has the least hash of some ``SPREAD`` neighbouring grams."""
    n = len(data) - GRAM + 1
    grams = sum(data[k : n + k].astype("u4") << np.uint32(8 * k) for k in range(GRAM))
    hashed = grams * np.uint32(0x9E3779B1)
    hashed ^= hashed >> np.uint32(15)
    hashed *= np.uint32(0x85EBCA77)
    hashed ^= hashed >> np.uint32(13)
    low = slide(hashed, SPREAD, True)
    edge = np.zeros(SPREAD - 1, dtype="u4")
    return np.flatnonzero(hashed == slide(np.concatenate([edge, low, edge]), SPREAD, False))


@dataclass
class Segment:
    """Part of a document: the places it owns, with what a string that starts there can reach."""

    data: np.ndarray
    owned: int
    length: int

    def __post_init__(self) -> None:
        self.sums = sums_of(self.data)
        self.borders = borders(self.data)
        b = self.borders
        phrase = names(self.sums, b[:-1], b[1:] + GRAM)
        self.triples = mix(mix(phrase[:-2] * U(BASE) + phrase[1:-1]) * U(BASE) + phrase[2:]) if len(phrase) > 2 else phrase[:0]

    def sampled(self) -> np.ndarray:
        """Triples at the places of the difference cover."""
        return self.triples[np.arange(len(self.triples)) % 3 != 0]

    def remaining(self, recur: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, name of the prefix) of the suffixes that may be repeats, given the sorted triples that recur."""
        count = len(self.triples)
        place = np.arange(count) % 3
        known = member(self.triples, recur) & (place != 0)
        if not known.any():
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype="u8")
        before = np.zeros(len(self.data) + 1, dtype=np.int64)
        before[self.borders + 1] = 1
        before = np.cumsum(before)
        starts = np.arange(self.owned)
        # triples whose borders are all decided by the string itself
        low = before[starts + SPREAD - 1]
        high = before[starts + self.length - SPREAD - GRAM + 2] - 3
        fits = np.zeros(len(starts), dtype=bool)
        for residue in (1, 2):
            lacking = np.concatenate([[0], np.cumsum((place == residue) & ~known)])
            fits |= lacking[np.clip(high, 0, count)] <= lacking[np.clip(low, 0, count)]
        at = np.flatnonzero(fits)
        return at, names(self.sums, at, at + self.length)


def packed(ordered: np.ndarray) -> bytes:
    """Ascending names as the first one and the gaps, in as many bytes as the widest gap takes."""
    if not len(ordered):
        return b""
    gaps = np.diff(ordered)
    width = max(1, -(-int(gaps.max()).bit_length() // 8)) if len(gaps) else 1
    octets = np.ascontiguousarray(gaps.astype("<u8").view("u1").reshape(-1, 8)[:, :width])
    return bytes([width]) + int(ordered[0]).to_bytes(8, "little") + octets.tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    if not len(raw):
        return np.zeros(0, dtype="u8")
    width = raw[0]
    octets = np.frombuffer(raw, "u1", offset=9).reshape(-1, width)
    gaps = np.zeros((len(octets) + 1, 8), dtype="u1")
    gaps[1:, :width] = octets
    gaps[0] = np.frombuffer(raw, "u1", 8, 1)
    return np.cumsum(gaps.view("<u8").reshape(-1), dtype="u8")


def member(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), dtype=bool)
    at = np.searchsorted(ordered, values)
    return ordered[np.minimum(at, len(ordered) - 1)] == values


def segments(data: bytes, length: int) -> Iterator[tuple[int, Segment]]:
    """A document's segments with their first places; together they own each place where a string can start."""
    whole = np.frombuffer(data, dtype="u1")
    last = len(whole) - length + 1
    for at in range(0, max(0, last), SEGMENT):
        owned = min(SEGMENT, last - at)
        yield at, Segment(whole[at : at + owned + length - 1], owned, length)


def sent(gathered: list[np.ndarray], part: int, buckets: int) -> Iterator[tuple]:
    """Rows ``bucket, part, names, several`` of the distinct names gathered; several: it occurred more than once."""
    if not gathered:
        return
    found, count = np.unique(np.concatenate(gathered), return_counts=True)
    bucket = ((found >> U(32)) * U(buckets) >> U(32)).astype(np.int64)
    cuts = np.searchsorted(bucket, np.arange(buckets + 1))
    for k in np.unique(bucket).tolist():
        x, y = cuts[k], cuts[k + 1]
        yield k, part, packed(found[x:y]), np.packbits(count[x:y] > 1).tobytes()


SENT = "bucket bigint, part bigint, names binary, several binary"


def gather(docs: DataFrame, buckets: int, length: int, copies: str, folder: str | None) -> DataFrame:
    """Names of sampled triples or, given the triples that recur, of the prefixes of the remaining suffixes.

    Of equal documents, those of one part speak for all.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size, now, recur, known = 0, None, np.zeros(0, dtype="u8"), {}

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal size
            rows = list(sent(held, now, buckets))
            held.clear()
            size = 0
            for k in range(0, len(rows), 64):
                columns = [pa.array(c) for c in zip(*rows[k : k + 64])]
                yield pa.RecordBatch.from_arrays(columns, names=["bucket", "part", "names", "several"])

        for batch in batches:
            for part, text in zip(batch.column(0).to_pylist(), batch.column(2)):
                if part != now:
                    yield from flush()
                    now = part
                    recur = read_names(folder, part) if folder else recur
                    known = read_copies(copies, part)
                data = text.as_py().encode()
                if len(data) < length or known and known.get(hashlib.sha256(data).digest()) is False:
                    continue
                for _, segment in segments(data, length):
                    held.append(segment.remaining(recur)[1] if folder else segment.sampled())
                    size += len(held[-1])
                if size >= GATHER:
                    yield from flush()
        yield from flush()

    return docs.mapInArrow(each, SENT)


def sort_out(rows: DataFrame, recurring: bool, purpose: str) -> str:
    """Sort the names of each bucket; give each part those of its names that recur, or those that don't, as a file."""

    def compare(table: pa.Table) -> pa.Table:
        parts = table.column("part").to_pylist()
        lists = [unpacked(x.as_py()) for x in table.column("names")]
        several = [np.unpackbits(np.frombuffer(x.as_buffer(), "u1"), count=len(n)).astype(bool) for x, n in zip(table.column("several"), lists)]
        ordered = np.sort(np.concatenate(lists))
        again = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        keep = [(member(x, again) | s) == recurring for x, s in zip(lists, several)]
        return pa.table({"part": pa.array(parts, pa.int64()), "names": pa.array([packed(x[k]) for x, k in zip(lists, keep)], pa.binary())})

    folder = new_folder(rows.sparkSession, purpose)

    def write(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        found = np.unique(np.concatenate([unpacked(x.as_py()) for x in table.column("names")]))
        write_file(f"{folder}/{part}.names", [packed(found)])
        return pa.table({"part": pa.array([part], pa.int64()), "n": pa.array([len(found)], pa.int64())})

    back = rows.groupBy("bucket").applyInArrow(compare, "part bigint, names binary").filter(F.length("names") > 0)
    stored(back.groupBy("part").applyInArrow(write, "part bigint, n bigint"), purpose + "-index")
    return folder


def read_names(folder: str, part: int) -> np.ndarray:
    """The names sorted out for a part; none if it has no file."""
    fs, path = filesystem(f"{folder}/{part}.names")
    if fs.get_file_info(path).is_file:
        with fs.open_input_file(path) as source:
            return unpacked(source.read())
    return np.zeros(0, dtype="u8")


def find_copies(rows: DataFrame, length: int) -> str:
    """Files with the digests of each part's documents that have a copy anywhere, and whether the part speaks for them."""
    folder = new_folder(rows.sparkSession, f"suffix-copies-{uuid.uuid4().hex[:6]}")
    long = rows.filter(F.octet_length("text") >= length)
    here = stored(long.groupBy("part", F.unhex(F.sha2("text", 256)).alias("digest")).count(), "suffix-digests")
    several = here.groupBy("digest").agg(F.sum("count").alias("n"), F.min("part").alias("owner")).filter("n > 1")
    known = here.join(stored(several, "suffix-several"), "digest").select("part", "digest", (F.col("part") == F.col("owner")).alias("own"))

    def write(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        lines = [d + bytes([o]) for d, o in zip(table.column("digest").to_pylist(), table.column("own").to_pylist())]
        write_file(f"{folder}/{part}.copies", [b"".join(lines)])
        return pa.table({"part": pa.array([part], pa.int64()), "n": pa.array([len(lines)], pa.int64())})

    stored(known.groupBy("part").applyInArrow(write, "part bigint, n bigint"), "suffix-copies-index")
    return folder


def read_copies(folder: str, part: int) -> dict[bytes, bool]:
    """Digests of a part's documents that have copies, with whether the part speaks for them."""
    fs, path = filesystem(f"{folder}/{part}.copies")
    if not fs.get_file_info(path).is_file:
        return {}
    with fs.open_input_file(path) as source:
        raw = source.read()
    return {raw[k : k + 32]: bool(raw[k + 32]) for k in range(0, len(raw), 33)}


def suffix_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 200,
    bucket_bytes: int = 24 << 20,
    with_kept: bool = False,
) -> DataFrame:
    """One row per document: ``id_col, n_bytes, n_removed, n_spans, kept_sha256`` and, if asked for, ``kept`` (binary).

    ``length`` is at least 200. The texts are first written to the shared folder with the number of their part, as all
    passes have to see the same parts, also after executors come or go.

    * Texts are UTF-8 bytes; null is empty. Strings don't cross documents, and are judged on the input: overlapping
      repeats all go, and so do all occurrences. What is kept may part a character.
    * Texts shorter than ``length`` and empty ones are kept whole. Texts may be of any length.
    * Repeated rows are repeats like any other. Null ids are reported as they are. Other columns are ignored.
    * An empty table gives an empty result.
    """
    if length < 200:
        raise ValueError("strings of less than 200 bytes do not hold three triples")
    part = F.spark_partition_id().cast("bigint").alias("part")
    rows = stored(docs.select(part, F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")), "suffix-texts")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = blocks_of(total, bucket_bytes)
    copies = find_copies(rows, length)
    recur = sort_out(gather(rows, buckets, length, copies, None), True, f"suffix-triples-{uuid.uuid4().hex[:6]}")
    single = sort_out(gather(rows, buckets, length, copies, recur), False, f"suffix-prefixes-{uuid.uuid4().hex[:6]}")
    id_type = docs.schema[id_col].dataType.simpleString()

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, again, alone, known = None, None, None, {}
        for batch in batches:
            out: list[tuple] = []
            for own, text in zip(batch.column(0).to_pylist(), batch.column(2)):
                if own != now:
                    now, again, alone, known = own, read_names(recur, own), read_names(single, own), read_copies(copies, own)
                data = text.as_py().encode()
                step = np.zeros(len(data) + 1, dtype=np.int32)
                copied = len(data) >= length and known and hashlib.sha256(data).digest() in known
                if copied:
                    step[[0, -1]] = 1, -1
                for at, segment in () if copied else segments(data, length):
                    places, found = segment.remaining(again)
                    places = places[~member(found, alone)] + at
                    np.add.at(step, places, 1)
                    np.add.at(step, places + length, -1)
                gone = np.cumsum(step[:-1]) > 0
                spans = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1])) if len(gone) else 0
                kept = np.frombuffer(data, "u1")[~gone].tobytes()
                out.append((len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            columns = [pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds[: 4 + with_kept])]
            labels = [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            yield pa.RecordBatch.from_arrays([batch.column(1), *columns], names=labels[: 5 + with_kept])

    schema = f"`{id_col}` {id_type}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return rows.mapInArrow(remove, schema + (", kept binary" if with_kept else ""))
