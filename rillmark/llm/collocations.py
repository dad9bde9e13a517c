"""Phrases whose words stand together more often than apart.

Frequent n-grams are found in two passes over the texts. The first gives every n-gram occurrence a short key; keys are
dealt to hash partitions, each of which merges the tasks' counts in a Misra-Gries summary. With more counters than
mass / threshold no n-gram of that frequency can be lost, however its occurrences are spread. The keys that survive are
counted exactly and become a table of bits. The second pass counts, as text, the n-grams whose key has its bit set, so
the counts and the threshold hold exactly whatever keys collide.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillmark.llm.common import filesystem, kept, new_folder, stored, text_or_empty, write_file
from rillmark.llm.minhash import U
from rillmark.llm.ngrams import BORDER, Words, chained, counted, pack_numbers, pack_sorted, unpack_numbers, unpack_sorted

#: What ends a piece.
ENDS = b".,;:!?\n\x0b\x0c\r"
PIECES = bytes.maketrans(ENDS, BORDER * len(ENDS))
SPACE = re.compile(rb"[ \t]")
#: Bytes of text that are cut into words at a time.
SEGMENT = 1 << 22
#: Keys, or distinct n-grams, that a task holds before it sends their counts.
HELD = 1 << 21
#: Distinct words that a task numbers before it starts anew.
KNOWN = 1 << 19
#: Occurrences that a hash partition shall get.
PARTITION_MASS = 1 << 20
MOST_FILTER_BITS = 33


def pieces(texts: list[bytes]) -> Iterator[tuple[list[bytes], int]]:
    """The words of texts, with borders, a segment at a time, and how many words at its start were there before."""
    held: list[bytes] = []
    size = 0
    for text in texts:
        if len(text) <= SEGMENT:
            held.append(text)
            size += len(text)
            if size < SEGMENT:
                continue
            yield words_of(BORDER.join(held)), 0
            held, size = [], 0
            continue
        # a long text is cut at white space; the words before the cut are repeated, so no n-gram is lost
        at, before = 0, b""
        while at < len(text):
            cut = SPACE.search(text, at + SEGMENT)
            end = cut.start() if cut else len(text)
            words = words_of(before + b" " + text[at:end])
            yield words, len(words_of(before))
            before, at = b" ".join(words[-2:]), end
    if held:
        yield words_of(BORDER.join(held)), 0


def words_of(text: bytes) -> list[bytes]:
    """Words in lower case (A-Z only); a border stands between pieces."""
    return text.lower().translate(PIECES).replace(BORDER, b" \xff ").split()


def by_lang(batch: pa.RecordBatch) -> dict[str, list[bytes]]:
    out: dict[str, list[bytes]] = {}
    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        out.setdefault(lang, []).append(text)
    return out


def starts_of(ids: np.ndarray, n: int, seen: int) -> np.ndarray:
    """Where a run of n words starts that holds no border and ends after the first ``seen`` words."""
    rows = len(ids) - n + 1
    if rows <= 0:
        return np.zeros(0, dtype=np.int64)
    fit = ids[:rows] != 0
    for k in range(1, n):
        fit &= ids[k : k + rows] != 0
    fit[: max(0, seen - n + 1)] = False
    return np.flatnonzero(fit)


def keys_of(hashes: np.ndarray, n: int, lang: str, bits: int) -> np.ndarray:
    return chained(hashes, n, start=xxhash.xxh3_64_intdigest(lang.encode())) >> U(64 - bits)


def key_counts(docs: DataFrame, words: int, bits: int, part_bits: int) -> DataFrame:
    """The first pass: (part, mass, names, counts) of the n-gram keys of a stretch of text."""
    shift = U(bits - part_bits)

    def send(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        names, counts = counted(np.concatenate(held))
        parts = (names >> shift).astype(np.int64)
        cuts = np.flatnonzero(np.diff(parts, prepend=-1))
        rows = [(int(parts[a]), names[a:b], counts[a:b]) for a, b in zip(cuts, [*cuts[1:], len(parts)])]
        for at in range(0, len(rows), 1024):
            some = rows[at : at + 1024]
            columns = [
                pa.array([p for p, _, _ in some], pa.int64()),
                pa.array([int(c.sum()) for _, _, c in some], pa.int64()),
                pa.array([pack_sorted(k) for _, k, _ in some], pa.binary()),
                pa.array([pack_numbers(c) for _, _, c in some], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "mass", "names", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size, known = 0, Words()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for lang, texts in by_lang(batch.slice(at, 256)).items():
                    for some, seen in pieces(texts):
                        ids = known.numbers(some)
                        hashes = known.hashed()[ids]
                        for n in range(1, words + 1):
                            found = keys_of(hashes, n, lang, bits)[starts_of(ids, n, seen)]
                            held.append(found)
                            size += len(found)
                        if size >= HELD:
                            yield from send(held)
                            held, size = [], 0
                        if len(known) > KNOWN:
                            known = Words()
        if size:
            yield from send(held)

    return docs.mapInArrow(count, "part bigint, mass bigint, names binary, counts binary")


def merged(keys: np.ndarray, counts: np.ndarray, more: tuple[np.ndarray, np.ndarray], capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Two Misra-Gries summaries in one of at most ``capacity`` counters.

    Counters of the same key add up. If there are too many, the largest that finds no room is taken from all of them.
    So no count is too low by more than mass / (capacity + 1).
    """
    keys, counts = counted(np.concatenate([keys, more[0]]), np.concatenate([counts, more[1]]))
    if len(keys) > capacity:
        counts = counts - np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1]
        keys, counts = keys[counts > 0], counts[counts > 0]
    return keys, counts


def survivors(parts: list[tuple[int, bytes, bytes]], threshold: int) -> np.ndarray:
    """The keys of a partition with ``threshold`` occurrences or more: a summary first, then an exact count of what it holds."""
    mass = sum(m for m, _, _ in parts)
    capacity = mass // threshold + 1
    keys, counts = np.zeros(0, dtype="u8"), np.zeros(0, dtype=np.int64)
    for _, names, numbers in parts:
        keys, counts = merged(keys, counts, (unpack_sorted(names), unpack_numbers(numbers).astype(np.int64)), capacity)
    exact = np.zeros(len(keys), dtype=np.int64)
    for _, names, numbers in parts if len(keys) else []:
        found, times = unpack_sorted(names), unpack_numbers(numbers).astype(np.int64)
        place = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
        here = keys[place] == found
        exact[place[here]] += times[here]
    return keys[exact >= threshold]


def bit_table(counts: DataFrame, threshold: int, bits: int, part_bits: int, filter_bits: int) -> str:
    """Write a table of bits that says which keys are frequent: a file per partition. Gives the folder."""
    folder = new_folder(counts.sparkSession, "frequent-keys")
    shift, width = U(bits - filter_bits), 1 << (filter_bits - part_bits)

    def write(key: tuple, table: pa.Table) -> pa.Table:
        part = key[0].as_py()
        rows = zip(*(table.column(c).to_pylist() for c in ("mass", "names", "counts")))
        found = survivors(list(rows), threshold)
        flags = np.zeros(width, dtype=np.uint8)
        flags[((found >> shift) - U(part * width)).astype(np.int64)] = 1
        write_file(f"{folder}/{part}.bits", [np.packbits(flags).tobytes()])
        return pa.table({"part": pa.array([part], pa.int64()), "n": pa.array([len(found)], pa.int64())})

    stored(counts.groupBy("part").applyInArrow(write, "part bigint, n bigint"), "frequent-index")
    return folder


def read_bits(folder: str, part_bits: int, filter_bits: int) -> np.ndarray:
    """All bits, as bytes. A partition without a file has no frequent key."""
    fs, path = filesystem(folder)
    size = max(1, (1 << (filter_bits - part_bits)) // 8)
    table = np.zeros(size << part_bits, dtype=np.uint8)
    for info in fs.get_file_info(pafs.FileSelector(path, allow_not_found=True)):
        name, _, kind = info.base_name.rpartition(".")
        if kind == "bits":
            with fs.open_input_file(info.path) as source:
                table[int(name) * size : (int(name) + 1) * size] = np.frombuffer(source.read(), np.uint8)
    return table


def phrase_counts(docs: DataFrame, words: int, bits: int, part_bits: int, filter_bits: int, folder: str) -> DataFrame:
    """The second pass: (lang, n, phrase, c), the counts of a stretch of text, for n-grams whose key has its bit set.

    Rows of n = 0 count all words.
    """
    shift = U(bits - filter_bits)
    schema = "lang string, n int, phrase string, c bigint"

    def send(lang: str, n: int, held: list[np.ndarray], names: list[bytes]) -> Iterator[pa.RecordBatch]:
        found, counts = counted(np.concatenate(held))
        for at in range(0, len(found), 20_000):
            some = found[at : at + 20_000]
            ids = [((some >> U(21 * k)) & U((1 << 21) - 1)).tolist() for k in reversed(range(n))]
            columns = [
                pa.array([lang] * len(some), pa.string()),
                pa.array(np.full(len(some), n, dtype=np.int32)),
                pa.array([b" ".join([names[i] for i in run]) for run in zip(*ids)], pa.binary()).cast(pa.string()),
                pa.array(counts[at : at + 20_000].astype(np.int64)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "n", "phrase", "c"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = kept(("frequent", folder), lambda: read_bits(folder, part_bits, filter_bits))
        held: dict[tuple[str, int], list[np.ndarray]] = {}
        total: dict[str, int] = {}
        size, known = 0, Words()

        def all_sent() -> Iterator[pa.RecordBatch]:
            for (lang, n), keys in held.items():
                yield from send(lang, n, keys, known.names)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for lang, texts in by_lang(batch.slice(at, 256)).items():
                    for some, seen in pieces(texts):
                        if len(known) > KNOWN or len(known) + len(some) >= 1 << 21:
                            yield from all_sent()
                            held, size, known = {}, 0, Words()
                        ids = known.numbers(some)
                        hashes, wide = known.hashed()[ids], ids.astype("u8")
                        total[lang] = total.get(lang, 0) + int(np.count_nonzero(ids[seen:]))
                        for n in range(1, words + 1):
                            starts = starts_of(ids, n, seen)
                            bit = keys_of(hashes, n, lang, bits)[starts] >> shift
                            hit = (table[(bit >> U(3)).astype(np.int64)] >> (U(7) - (bit & U(7))).astype(np.uint8)) & 1
                            starts = starts[hit == 1]
                            if len(starts):
                                # the words' numbers side by side are an exact key within the task
                                run = sum(wide[starts + k] << U(21 * (n - 1 - k)) for k in range(n))
                                held.setdefault((lang, n), []).append(run)
                                size += len(run)
                        if size >= HELD:
                            yield from all_sent()
                            held, size, known = {}, 0, Words()
        yield from all_sent()
        none = [0] * len(total), [None] * len(total)
        columns = zip((list(total), *none, list(total.values())), (pa.string(), pa.int32(), pa.string(), pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in columns], names=["lang", "n", "phrase", "c"])

    return docs.mapInArrow(count, schema)


def frequent_ngrams(docs: DataFrame, words: int = 3, threshold: int = 10, lang_col: str = "lang", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(lang, n, phrase, f) of all n-grams that occur ``threshold`` times in a language, and (lang, total) of all words."""
    if not 1 <= words <= 3:
        raise ValueError("words is 1, 2 or 3: the numbers of a phrase's words must fit 64 bits")
    texts = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("_lang"), text_or_empty(text_col).cast("binary").alias("_text")
    )
    # words take two bytes each at least, so this bounds all occurrences
    mass = words * (texts.agg(F.sum(F.length("_text") / 2 + 1).alias("n")).first()["n"] or 0)
    part_bits = max(6, int(mass / 3 / PARTITION_MASS).bit_length())
    bits = min(60, max(32, int(mass).bit_length() + 6, part_bits + 8))
    filter_bits = max(part_bits + 3, min(MOST_FILTER_BITS, int(mass).bit_length() - 3))
    folder = bit_table(key_counts(texts, words, bits, part_bits), threshold, bits, part_bits, filter_bits)
    local = phrase_counts(texts, words, bits, part_bits, filter_bits, folder)
    counts = local.groupBy("lang", "n", "phrase").agg(F.sum("c").alias("f"))
    found = stored(counts.filter((F.col("f") >= threshold) | (F.col("n") == 0)), "frequent-phrases")
    return found.filter("n > 0"), found.filter("n = 0").select("lang", F.col("f").alias("total"))


def best_of(df: DataFrame, group: str, order: list, limit: int, shares: tuple[int, ...] = (256, 16)) -> DataFrame:
    """The first ``limit`` rows of each group, ranked from 1. A large group is ranked in shares first."""
    for n in shares:
        share = F.pmod(F.xxhash64("phrase"), F.lit(n))
        w = Window.partitionBy(group, "_share").orderBy(*order)
        df = df.withColumn("_share", share).withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= limit).drop("_rank", "_share")
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= limit)


def collocations(
    docs: DataFrame,
    words: int = 3,
    threshold: int = 10,
    per_lang: int = 2000,
    inside_percent: int = 50,
    lang_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """The strongest phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    Texts are lower-cased (A-Z), split into pieces at ``.,;:!?`` and line ends, and those into words at spaces and tabs.
    A phrase of 2 to ``words`` words that occurs ``a >= threshold`` times is cut where floor(10^6 a^2 / (l r)) is lowest, the
    first such place on a tie. Phrases that stand ``inside_percent`` of the time in one longer phrase are left out.

    * A null language is ``und``; a null text is empty and has no words; an empty table gives no rows.
    * Repeated rows count each time. Other columns are ignored. Texts may be of any length.
    * Products have up to 38 digits, so counts up to 10^15 are exact.
    """
    frequent, totals = frequent_ngrams(docs, words, threshold, lang_col, text_col)
    part = F.col("_words")
    long = frequent.filter("n > 1").withColumn("_words", F.split("phrase", " "))

    # a phrase inside a longer one: the most frequent of those that hold it
    def joined(at, size):
        return F.array_join(F.slice(part, at, size), " ")

    inner = [F.struct((F.lit(i)).alias("i"), F.lit(k).alias("k")) for k in range(2, words) for i in range(1, words - k + 2)]
    kept_rows = long
    if inner:
        held = long.withColumn("_in", F.explode(F.array(*inner))).filter("_in.k < n AND _in.i + _in.k - 1 <= n")
        held = held.select("lang", joined(F.col("_in.i"), F.col("_in.k")).alias("phrase"), "f")
        held = held.groupBy("lang", "phrase").agg(F.max("f").alias("_longer"))
        kept_rows = long.join(held, ["lang", "phrase"], "left").filter(
            F.col("_longer").isNull() | (100 * F.col("_longer") < inside_percent * F.col("f"))
        )
    cuts = kept_rows.select("lang", "phrase", F.col("f").alias("a"), "n", "_words", F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("_left"), joined(F.col("k") + 1, F.col("n")).alias("_right"))
    left = frequent.select("lang", F.col("phrase").alias("_left"), F.col("f").alias("l"))
    right = frequent.select("lang", F.col("phrase").alias("_right"), F.col("f").alias("r"))
    cuts = cuts.join(left, ["lang", "_left"]).join(right, ["lang", "_right"])
    score = F.expr("CAST(1000000 AS DECIMAL(38,0)) * CAST(a AS DECIMAL(19,0)) * a div (CAST(l AS DECIMAL(19,0)) * r)")
    best = cuts.select("lang", "phrase", "a", F.struct(score.alias("score"), "k", "l", "r").alias("c"))
    best = best.groupBy("lang", "phrase", "a").agg(F.min("c").alias("c")).select("lang", "phrase", "a", "c.l", "c.r", "c.score")
    ranked = best_of(best, "lang", [F.col("score").desc(), F.col("a").desc(), F.col("phrase")], per_lang)
    out = ranked.join(totals.withColumnRenamed("total", "n"), "lang")
    return out.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("bigint").alias("score"))
