"""Token ids in binary files of compressed bit planes.

A file holds documents in order. Their ids, one after the other, are cut into blocks of a fixed number of ids; each
block is transposed into bit planes (or byte planes), and each plane is compressed with zstandard by itself. At the
end stand the table of documents, the chunk index (ids and plane sizes of each block), and a footer of fixed size:

    magic | planes of block 0 | planes of block 1 | ... | document table | chunk index | footer
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillmark.llm.common import filesystem, new_folder, stored, text_or_empty, write_file
from rillmark.llm.tokens import encoder_for

MAGIC = b"RILLTOK1"
#: sizes of document table and chunk index, ids per block, bits per plane, number of documents, number of ids
FOOTER = struct.Struct("<QQIIQQ")


def to_planes(ids: np.ndarray, bits: int) -> list[bytes]:
    """The planes of a block, lowest first: ``bits`` is 1 or 8. Planes above the largest id are left out."""
    width = max(1, int(ids.max()).bit_length())
    if bits == 8:
        octets = ids.astype("<u4").view("u1").reshape(-1, 4)
        return [np.ascontiguousarray(octets[:, k]).tobytes() for k in range(-(-width // 8))]
    octets = ids.astype("<u4").view("u1").reshape(-1, 4)[:, : -(-width // 8)]
    grid = np.unpackbits(octets, axis=1, bitorder="little")[:, :width]
    packed = np.packbits(np.ascontiguousarray(grid.T), axis=1, bitorder="little")
    return [row.tobytes() for row in packed]


def from_planes(planes: list[bytes], n: int, bits: int) -> np.ndarray:
    octets = np.zeros((n, 4), dtype="u1")
    if bits == 8:
        for k, plane in enumerate(planes):
            octets[:, k] = np.frombuffer(plane, dtype="u1")
    elif planes:
        packed = np.frombuffer(b"".join(planes), dtype="u1").reshape(len(planes), -1)
        grid = np.unpackbits(packed, axis=1, count=n, bitorder="little").T
        whole = np.packbits(np.ascontiguousarray(grid), axis=1, bitorder="little")
        octets[:, : whole.shape[1]] = whole
    return octets.view("<u4").reshape(-1)


class FileBuilder:
    """Makes the parts of a file; holds one block of ids and the table of documents."""

    def __init__(self, block_ids: int, bits: int, level: int) -> None:
        self.block_ids, self.bits = block_ids, bits
        self.compress = zstandard.ZstdCompressor(level=level).compress
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_ids = 0
        self.names: list[int | None] = []
        self.lengths: list[int] = []
        self.index: list[tuple[int, list[int]]] = []

    def block(self, ids: np.ndarray) -> bytes:
        planes = [self.compress(p) for p in to_planes(ids, self.bits)]
        self.index.append((len(ids), [len(p) for p in planes]))
        return b"".join(planes)

    def add(self, name: int | None, ids: np.ndarray) -> Iterator[bytes]:
        self.names.append(name)
        self.lengths.append(len(ids))
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        self.n_ids += len(ids)
        if self.n_waiting >= self.block_ids:
            whole = np.concatenate(self.waiting)
            full = len(whole) // self.block_ids * self.block_ids
            for at in range(0, full, self.block_ids):
                yield self.block(whole[at : at + self.block_ids])
            self.waiting, self.n_waiting = [whole[full:]], len(whole) - full

    def end(self) -> Iterator[bytes]:
        if self.n_waiting:
            yield self.block(np.concatenate(self.waiting))
        names = np.array([n or 0 for n in self.names], dtype="<i8")
        there = np.packbits(np.array([n is not None for n in self.names], dtype=bool))
        lengths = np.array(self.lengths, dtype="<u8")
        table = self.compress(names.tobytes() + lengths.tobytes() + there.tobytes())
        index = self.compress(b"".join(struct.pack(f"<II{len(p)}I", n, len(p), *p) for n, p in self.index))
        yield table + index
        yield FOOTER.pack(len(table), len(index), self.block_ids, self.bits, len(self.names), self.n_ids)


class TokenFile:
    """A file for reading: the document table, and any block through the chunk index."""

    def __init__(self, path: str) -> None:
        fs, inner = filesystem(path)
        self.file = fs.open_input_file(inner)
        size = self.file.size()
        n_table, n_index, self.block_ids, self.bits, n_docs, self.n_ids = FOOTER.unpack(
            self.file.read_at(FOOTER.size, size - FOOTER.size)
        )
        tail = size - FOOTER.size - n_table - n_index
        self.expand = zstandard.ZstdDecompressor().decompress
        table = self.expand(self.file.read_at(n_table, tail))
        self.names = np.frombuffer(table, "<i8", n_docs)
        self.lengths = np.frombuffer(table, "<u8", n_docs, 8 * n_docs)
        self.there = np.unpackbits(np.frombuffer(table, "u1", offset=16 * n_docs), count=n_docs).astype(bool)
        index = self.expand(self.file.read_at(n_index, tail + n_table)) if n_index else b""
        self.blocks: list[tuple[int, int, tuple[int, ...]]] = []
        at, place = 0, len(MAGIC)
        while at < len(index):
            n, planes = struct.unpack_from("<II", index, at)
            sizes = struct.unpack_from(f"<{planes}I", index, at + 8)
            at += 8 + 4 * planes
            self.blocks.append((place, n, sizes))
            place += sum(sizes)

    def block(self, k: int) -> np.ndarray:
        place, n, sizes = self.blocks[k]
        raw = self.file.read_at(sum(sizes), place)
        planes, at = [], 0
        for s in sizes:
            planes.append(self.expand(raw[at : at + s]))
            at += s
        return from_planes(planes, n, self.bits)

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """(id, token ids) in file order; one block and one document are held."""
        k, left = 0, np.zeros(0, dtype="<u4")
        for name, there, n in zip(self.names.tolist(), self.there.tolist(), self.lengths.tolist()):
            parts = [left]
            have = len(left)
            while have < n:
                parts.append(self.block(k))
                have += len(parts[-1])
                k += 1
            whole = np.concatenate(parts) if len(parts) > 1 else left
            left = whole[n:]
            yield (name if there else None), whole[:n]

    def close(self) -> None:
        self.file.close()


def write_token_files(
    docs: DataFrame,
    vocabulary: str,
    spaces: str = "drop",
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    folder: str | None = None,
    block_ids: int = 1 << 16,
    plane_bits: int = 1,
    level: int = 3,
) -> DataFrame:
    """Write all documents in ascending order of id; one row per file: ``file_no, path, n_docs, n_tokens, start``.

    The documents are parted by ranges of (id, hash of the text), so files follow each other in that order and rows
    that repeat an id do not pile up unless they are equal. ``start`` is the number of ids in all files before.

    * Null texts are empty: only the end id. Null ids come first. Ids are whole numbers (64 bit, signed).
    * Texts may be of any length; a task holds one document's ids and one block.
    * An empty table writes no file. Other columns are ignored.
    """
    spark: SparkSession = docs.sparkSession
    target = folder or new_folder(spark, "token-files")
    rows = docs.select(F.col(id_col).cast("bigint").alias("_id"), text_or_empty(text_col).alias("_text"))
    ordered = rows.repartitionByRange("_id", F.xxhash64("_text")).sortWithinPartitions("_id", "_text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        build = FileBuilder(block_ids, plane_bits, level)
        encoder = encoder_for(vocabulary, spaces)
        end = np.array([end_id], dtype="<u4").tobytes()
        path = f"{target}/ids-{number:06d}.bin"

        def parts() -> Iterator[bytes]:
            yield MAGIC
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    some = batch.slice(at, 256)
                    names, texts = some.column(0).to_pylist(), some.column(1).to_pylist()
                    for name, ids in zip(names, encoder.encode_batch(texts)):
                        yield from build.add(name, np.frombuffer(ids + end, "<u4"))
            if build.names:
                yield from build.end()

        write_file(path, parts())
        if build.names:
            found = [[number], [path], [len(build.names)], [build.n_ids]]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["file_no", "path", "n_docs", "n_tokens"])

    files = stored(ordered.mapInArrow(write, "file_no bigint, path string, n_docs bigint, n_tokens bigint"), "token-index")
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_token_files(files: DataFrame, id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """One row per document of the files: ``id_col, start, n_tokens, ids_crc32`` and, if asked for, ``ids``.

    ``ids_crc32`` is the unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers.
    """
    count = max(1, files.count())
    schema = f"`{id_col}` bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<bigint>" if with_ids else "")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                source = TokenFile(path)
                rows: list[tuple] = []
                held = 0
                for name, ids in source.documents():
                    row = (name, start, len(ids), zlib.crc32(ids.tobytes()))
                    rows.append((*row, ids.tolist()) if with_ids else row)
                    start += len(ids)
                    held += len(ids) if with_ids else 1
                    if held >= 50_000:
                        yield pack(rows)
                        rows, held = [], 0
                if rows:
                    yield pack(rows)
                source.close()

    def pack(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
        names = [id_col, "start", "n_tokens", "ids_crc32", "ids"]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays(columns, names=names[: len(columns)])

    return files.select("path", "start").repartition(count).mapInArrow(read, schema)
