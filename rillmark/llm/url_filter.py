"""URL filter over sorted digest arrays.

Rules (host, path prefix, verdict) are hashed to 64-bit xxhash keys and written as sorted arrays that tasks
memory-map. A URL is looked up under each of its host suffixes joined with each prefix of its path that is as
long as some rule's path; the keys of a whole batch are found by one vectorised binary search, and stored full
strings decide, so equal digests of different strings do no harm.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark.llm.common import blocks_of, filesystem, map_batches, new_folder, write_file

#: The rules of the contract.
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]

MAGIC = b"RILLURL1"
ADDRESS = re.compile(r".*?://([^/?#]*)([^?#]*)", re.DOTALL)
UPPER = {c: c + 32 for c in range(65, 91)}


def split_url(url: str | None) -> tuple[str, str]:
    """Host with A-Z lower-cased, and path; both empty without ``://``."""
    found = ADDRESS.match(url) if url else None
    return (found[1].translate(UPPER), found[2]) if found else ("", "")


def pack_rules(hosts: list[str], paths: list[str], verdicts: list[str]) -> list[bytes]:
    """A block file: header, sorted keys, host lengths, verdicts, offsets of strings, strings."""
    texts = [(h + p).encode() for h, p in zip(hosts, paths)]
    keys = np.array([xxhash.xxh64_intdigest(t) for t in texts], dtype="<u8")
    order = np.argsort(keys, kind="stable")
    texts = [texts[i] for i in order]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype("<u8")
    host_bytes = np.array([len(hosts[i].encode()) for i in order], dtype="<u4")
    block = np.array([verdicts[i] == "block" for i in order], dtype="u1")
    head = MAGIC + struct.pack("<Q", len(texts))
    return [head, keys[order].tobytes(), offsets.tobytes(), host_bytes.tobytes(), block.tobytes(), b"".join(texts)]


class RuleBlock:
    """One block file: mapped into memory where the file system is local, else read once."""

    def __init__(self, path: str) -> None:
        fs, inner = filesystem(path)
        if fs.type_name == "local":
            raw = np.memmap(inner, dtype="u1", mode="r")
        else:
            with fs.open_input_file(inner) as source:
                raw = np.frombuffer(source.read_buffer(), dtype="u1")
        if raw[:8].tobytes() != MAGIC:
            raise ValueError(f"{path} is no rule block")
        n = struct.unpack("<Q", raw[8:16].tobytes())[0]
        at = 16
        self.keys = raw[at : at + 8 * n].view("<u8")
        at += 8 * n
        self.offsets = raw[at : at + 8 * (n + 1)].view("<u8")
        at += 8 * (n + 1)
        self.host_bytes = raw[at : at + 4 * n].view("<u4")
        at += 4 * n
        self.block = raw[at : at + n]
        self.strings = raw[at + n :]

    def probe(self, keys: np.ndarray, texts: list[bytes]) -> Iterator[tuple[int, int]]:
        """(candidate, rule) where digest and full string agree."""
        low = np.searchsorted(self.keys, keys, "left")
        high = np.searchsorted(self.keys, keys, "right")
        for i in np.flatnonzero(high > low):
            for r in range(low[i], high[i]):
                if self.strings[self.offsets[r] : self.offsets[r + 1]].tobytes() == texts[i]:
                    yield int(i), r


def build_index(rules: DataFrame, rules_per_block: int) -> tuple[list[str], list[int]]:
    """Write the block files as a Spark job; give their names and the distinct lengths of rule paths.

    Per block one name comes to the driver, and per distinct length of a path one number.
    """
    spark: SparkSession = rules.sparkSession
    host = F.translate(F.coalesce("host", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    clean = rules.select(host.alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
    clean = clean.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    folder = new_folder(spark, "url-rules")
    lengths = sorted(r[0] for r in clean.select(F.length("path")).distinct().collect())
    count = blocks_of(clean.count(), rules_per_block)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [b for b in batches if len(b)]
        if held:
            rows = pd.concat(held)
            path = f"{folder}/block-{TaskContext.get().partitionId():05d}.idx"
            write_file(path, pack_rules(rows["host"].tolist(), rows["path"].tolist(), rows["verdict"].tolist()))
            yield pd.DataFrame({"path": [path]})

    dealt = clean.repartition(count, F.xxhash64("host", "path"))
    return sorted(r[0] for r in dealt.mapInPandas(write, "path string").collect()), lengths


def url_filter(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
    rules_per_block: int = 2_000_000,
) -> DataFrame:
    """One row per page: ``id_col, url, host, path, rule, verdict``.

    ``rules`` has ``host, path, verdict`` (``block`` or ``allow``). A rule fits its host and all subdomains if the
    path starts with the rule's path. The longest rule (host and path together) wins, of equally long ones the
    longer host; a rule listed with both verdicts blocks. Pages without a rule get ``default`` and a null rule.

    * A null URL, or one without ``://``, has an empty host and path; only a rule with an empty host could fit.
    * Rows are judged one by one, so repeated rows and null ids give a row each; other columns are ignored.
    * An empty rule list gives every page ``default``; an empty table gives an empty result.
    * Nothing is shuffled but the rules. A block holds ``rules_per_block`` rules; tasks map one block at a time.
    """
    paths, lengths = build_index(rules, rules_per_block)
    id_type = pages.schema[id_col].dataType.simpleString()
    opened: dict[str, RuleBlock] = {}

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = [split_url(u) for u in batch.column(1).to_pylist()]
        texts: list[bytes] = []
        owner: list[int] = []
        hosts: list[int] = []
        for i, (host, path) in enumerate(parts):
            labels = host.split(".")
            for k in range(len(labels)):
                suffix = ".".join(labels[k:])
                size = len(suffix.encode())
                for n in lengths:
                    if n > len(path):
                        break
                    texts.append((suffix + path[:n]).encode())
                    owner.append(i)
                    hosts.append(size)
        keys = np.fromiter(map(xxhash.xxh64_intdigest, texts), dtype="u8", count=len(texts))
        best: dict[int, tuple[int, int, str, str]] = {}
        for name in paths:
            if name not in opened:
                opened[name] = RuleBlock(name)
            rules_here = opened[name]
            for c, r in rules_here.probe(keys, texts):
                if rules_here.host_bytes[r] != hosts[c]:
                    continue
                rule = texts[c].decode()
                found = (len(rule), hosts[c], rule, "block" if rules_here.block[r] else "allow")
                if owner[c] not in best or found > best[owner[c]]:
                    best[owner[c]] = found
        none = (0, 0, None, default)
        won = [best.get(i, none) for i in range(len(parts))]
        columns = [
            batch.column(0),
            batch.column(1),
            pa.array([p[0] for p in parts], pa.string()),
            pa.array([p[1] for p in parts], pa.string()),
            pa.array([w[2] for w in won], pa.string()),
            pa.array([w[3] for w in won], pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=[id_col, "url", "host", "path", "rule", "verdict"])

    schema = f"`{id_col}` {id_type}, url string, host string, path string, rule string, verdict string"
    return map_batches(pages.select(F.col(id_col), F.col(url_col).cast("string")), judge, schema)
