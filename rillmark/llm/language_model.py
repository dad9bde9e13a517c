"""Log-probabilities of texts under an n-gram model of the corpus, by a weighted automaton with backoff.

The model is a chain of smoothed n-grams: P(w | h) = (c(hw) + m P(w | h')) / (c(h) + m), where h' is the history
without its first word and P(w) = (c(w) + 1) / (N + V + 1). As an automaton, each history that was seen is a state, each
n-gram that was seen an arc with the logarithm of its probability, and each state has a failure arc to the state of the
shorter history, weighing log(m / (c(h) + m)).

Neither the corpus nor the model is ever in one place. A task cuts its texts into blocks, writes each to a file and
sends the keys of the block's distinct n-grams, with their counts in training texts, to hash partitions. A partition adds
up what all blocks have counted and answers each block with the totals of just the keys that it asked for. With these
the block is the part of the automaton that its texts can reach, and one traversal from left to right scores them.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.llm.common import filesystem, new_folder, stored, text_or_empty, write_file
from rillmark.llm.minhash import U
from rillmark.llm.ngrams import Words, chained, counted, pack_numbers, pack_sorted, unpack_numbers, unpack_sorted

#: Bytes of a block; only a longer text makes it larger.
BLOCK_BYTES = 1 << 23
#: Bits of a key beyond those that number the bytes of the corpus.
SPARE_BITS = 22
#: Keys that a hash partition shall get.
PARTITION_KEYS = 1 << 20
ORDERS = (1, 2, 3)


def held_out(name: int | None, of: int, rest: int) -> bool:
    """Whether a text is kept from training; the id null counts as an empty text."""
    return zlib.crc32(b"" if name is None else str(name).encode()) % of == rest


def numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct value, in ascending order, and for each value the number of its like."""
    order = np.argsort(values)
    fresh = np.diff(values[order], prepend=-1) != 0
    number = np.empty(len(values), dtype=np.int32)
    number[order] = np.cumsum(fresh) - 1
    return order[fresh], number


class Block:
    """Some texts as one row of tokens, with the distinct n-grams of each order.

    Token 0 stands before the first text and ends each text, so it is the end of one and the start of the next.
    ``at[n]`` has the number of the n-gram that ends at each token. A run that holds the start of a text anywhere but at
    its first place isn't one; there stands a number beyond the last.
    """

    def __init__(self, texts: list[bytes]) -> None:
        known = Words()
        rows = [known.numbers(t.lower().split()) for t in texts]
        self.lengths = np.array([len(r) + 1 for r in rows], dtype=np.int64)
        end = np.zeros(1, dtype=np.int32)
        s = self.tokens = np.concatenate([end, *[x for r in rows for x in (r, end)]])
        hashes = known.hashed()
        start = s[:-1] == 0
        self.at = {1: s}
        self.fit = {1: np.arange(len(s)) > 0}
        self.first = {1: np.arange(len(hashes))}
        self.keys = {1: chained(hashes, 1)}
        for n in ORDERS[1:]:
            # a run of three or more must not have the start of a text behind its first place
            inside = ~np.concatenate([[True], start]) if n > 2 else self.fit[1]
            self.fit[n] = self.fit[n - 1] & inside & (np.arange(len(s)) >= n - 1)
            places = np.flatnonzero(self.fit[n])
            at = self.at[n] = np.zeros(len(s), dtype=np.int32)
            one, at[places] = numbered((self.at[n - 1][places - 1].astype(np.int64) << 32) | s[places])
            at[~self.fit[n]] = len(one)
            self.first[n] = places[one]
            self.keys[n] = chained(hashes[s], n)[self.first[n] - n + 1]

    def counts(self, n: int, train: np.ndarray) -> np.ndarray:
        """How often each n-gram comes in the texts of the mask."""
        mask = np.concatenate([[False], np.repeat(train, self.lengths)]) & self.fit[n]
        return np.bincount(self.at[n][mask], minlength=len(self.keys[n]))[: len(self.keys[n])]


def write_block(folder: str, number: int, seq: int, names: list, texts: list[bytes]) -> str:
    """Write ids and texts to a file that is named after them; gives the name."""
    batch = pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(texts, pa.binary())], names=["name", "text"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    data = sink.getvalue().to_pybytes()
    block = f"{number:06d}-{seq:06d}-{zlib.crc32(data):08x}"
    write_file(f"{folder}/{block}.arrow", [data])
    return block


def read_block(folder: str, block: str) -> tuple[list, list[bytes]]:
    fs, path = filesystem(f"{folder}/{block}.arrow")
    with fs.open_input_file(path) as source, pa.ipc.open_stream(source) as found:
        table = found.read_all()
    return table.column("name").to_pylist(), table.column("text").to_pylist()


def asked(docs: DataFrame, folder: str, bits: dict[int, int], part_bits: int, of: int, rest: int) -> DataFrame:
    """(block, part, k1, c1, k2, c2, k3, c3): the keys of a block's n-grams and their counts in training texts."""
    columns = [f"{c}{n}" for n in ORDERS for c in "kc"]

    def send(number: int, seq: int, names: list, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        name = write_block(folder, number, seq, names, texts)
        block, train = Block(texts), ~np.array([held_out(x, of, rest) for x in names])
        by_part: dict[int, list[bytes | None]] = {}
        for i, n in enumerate(ORDERS):
            # the counts of keys that are equal, if ever that happens, add up, here as everywhere
            keys, counts = counted(block.keys[n] >> U(64 - bits[n]), block.counts(n, train))
            parts = (keys >> U(bits[n] - part_bits)).astype(np.int64)
            cuts = np.flatnonzero(np.diff(parts, prepend=-1)).tolist()
            for a, b in zip(cuts, [*cuts[1:], len(parts)]):
                row = by_part.setdefault(int(parts[a]), [None] * len(columns))
                row[2 * i : 2 * i + 2] = pack_sorted(keys[a:b]), pack_numbers(counts[a:b])
        rows = sorted(by_part.items())
        for at in range(0, len(rows), 64):
            some = rows[at : at + 64]
            arrays = [pa.array([name] * len(some)), pa.array([p for p, _ in some], pa.int64())]
            arrays += [pa.array([r[i] for _, r in some], pa.binary()) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays(arrays, names=["block", "part", *columns])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, seq = TaskContext.get().partitionId(), 0
        names: list = []
        texts: list[bytes] = []
        size = 0
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if texts and size + len(text) > BLOCK_BYTES:
                    yield from send(number, seq, names, texts)
                    names, texts, size, seq = [], [], 0, seq + 1
                names.append(name)
                texts.append(text)
                size += len(text) + 8
        if texts:
            yield from send(number, seq, names, texts)

    return docs.mapInArrow(ask, "block string, part bigint, " + ", ".join(f"{c} binary" for c in columns))


def answered(questions: DataFrame) -> DataFrame:
    """(block, part, t1, t2, t3): training totals of the keys that a block asked for; a row without block has N and V."""

    def answer(key: tuple, table: pa.Table) -> pa.Table:
        blocks = table.column("block").to_pylist()
        out: list[list[bytes | None]] = []
        tokens = distinct = 0
        for n in ORDERS:
            keys = [None if k is None else unpack_sorted(k) for k in table.column(f"k{n}").to_pylist()]
            counts = [None if c is None else unpack_numbers(c) for c in table.column(f"c{n}").to_pylist()]
            there = [k for k in keys if k is not None]
            names, totals = counted(np.concatenate(there), np.concatenate([c for c in counts if c is not None])) if there else ([], [])
            if n == 1:
                tokens, distinct = int(np.sum(totals)), int(np.count_nonzero(totals))
            out.append([None if k is None else pack_numbers(totals[np.searchsorted(names, k)].astype(np.uint64)) for k in keys])
        rows = len(blocks)
        columns = [pa.array([*blocks, None], pa.string()), pa.array([key[0].as_py()] * (rows + 1), pa.int64())]
        columns += [pa.array([*o, None], pa.binary()) for o in out]
        columns += [pa.array([None] * rows + [x], pa.int64()) for x in (tokens, distinct)]
        return pa.Table.from_arrays(columns, names=["block", "part", "t1", "t2", "t3", "tokens", "words"])

    schema = "block string, part bigint, t1 binary, t2 binary, t3 binary, tokens bigint, words bigint"
    return questions.groupBy("part").applyInArrow(answer, schema)


class Automaton:
    """The states and arcs that a block's texts can reach.

    ``arcs[n]`` weighs the arc of each n-gram of order n, leaving the state of its first n - 1 words; an n-gram that was
    never seen has no arc, which a positive weight says. ``failing[n]`` weighs the failure arc of the state of n words.
    """

    def __init__(self, block: Block, counts: dict[int, np.ndarray], tokens: int, distinct: int, strength: dict[int, float]) -> None:
        self.base = np.log10((counts[1] + 1) / (tokens + distinct + 1))
        chance = (counts[1] + 1) / (tokens + distinct + 1)
        self.arcs = {1: array("d", self.base.tobytes())}
        self.failing: dict[int, array] = {}
        for n in ORDERS[1:]:
            m, last = strength[n], block.first[n]
            of_history = counts[n - 1][block.at[n - 1][last - 1]]
            chance = (counts[n] + m * chance[block.at[n - 1][last]]) / (of_history + m)
            self.arcs[n] = array("d", np.append(np.where(counts[n] > 0, np.log10(chance), 1.0), 1.0).tobytes())
            self.failing[n - 1] = array("d", np.append(np.log10(m / (counts[n - 1] + m)), 0.0).tobytes())
        self.states = {n: np.append(counts[n] > 0, False).tobytes() for n in (1, 2)}

    def traverse(self, tokens: list[int], twos: list[int], threes: list[int]) -> float:
        """The log-probability of one text: its tokens, and the numbers of the n-grams that end at each."""
        arcs1, arcs2, arcs3 = self.arcs[1], self.arcs[2], self.arcs[3]
        failing1, failing2 = self.failing[1], self.failing[2]
        words, pairs = self.states[1], self.states[2]
        # the start of a text is a state if any text was trained on
        level, state = (1, 0) if words[0] else (0, 0)
        before = 0
        total = 0.0
        for word, two, three in zip(tokens, twos, threes):
            if level == 2:
                weight = arcs3[three]
                if weight > 0:
                    total += failing2[state]
                    level, state = 1, before
            if level == 1:
                weight = arcs2[two]
                if weight > 0:
                    total += failing1[state]
                    level = 0
            if level == 0:
                weight = arcs1[word]
            total += weight
            # the longest history that the model has; a pair whose words were seen together includes its last word
            if pairs[two]:
                level, state = 2, two
            elif words[word]:
                level, state = 1, word
            else:
                level = 0
            before = word
        return total


def language_model_scores(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    held_out_of: int = 7,
    held_out_rest: int = 2,
    strength: tuple[float, float] = (1000.0, 10.0),
) -> DataFrame:
    """Score every text: ``id_col, held_out, n_tokens, n_known, train_tokens, base_score, score`` (log10).

    Texts whose CRC-32 of the id, modulo ``held_out_of``, is ``held_out_rest`` are kept from training. Tokens are the words
    (A-Z lower-cased, parted by ASCII white space) and one end per text. ``strength`` is m for pairs and for triples.

    * A null text is empty: one token, the end. A null id counts as an empty text where its checksum is taken.
    * Repeated rows count each time. Texts may be of any length; a task holds one block or one text.
    * An empty table gives no rows. Without training texts N = V = 0, and every token has probability 1.
    * Other columns are ignored. Ids are whole numbers. Words are told apart by hashes of 64 bits, n-grams by
      hashes of 22 bits more than number the corpus's bytes (64 at most): one in millions shares its count with another.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "text-blocks")
    texts = docs.select(F.col(id_col).cast("bigint").alias("_id"), text_or_empty(text_col).cast("binary").alias("_text"))
    size = texts.agg(F.sum(F.length("_text")).alias("n")).first()["n"] or 0
    part_bits = max(6, int(size / 3 / PARTITION_KEYS).bit_length())
    narrow = min(64, max(part_bits, int(size).bit_length() + SPARE_BITS))
    bits = {n: 64 if n == 1 else narrow for n in ORDERS}
    answers = stored(answered(asked(texts, folder, bits, part_bits, held_out_of, held_out_rest)), "model-answers")
    whole = answers.filter("block IS NULL").agg(F.sum("tokens").alias("n"), F.sum("words").alias("v")).first()
    tokens, distinct = whole["n"] or 0, whole["v"] or 0
    strengths = dict(zip(ORDERS[1:], strength))
    names = [id_col, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def score(key: tuple, table: pa.Table) -> pa.Table:
        ids, texts = read_block(folder, key[0].as_py())
        block = Block(texts)
        rows = sorted(table.select(["part", "t1", "t2", "t3"]).to_pylist(), key=lambda r: r["part"])
        counts = {}
        for n in ORDERS:
            keys, place = np.unique(block.keys[n] >> U(64 - bits[n]), return_inverse=True)
            cuts = np.searchsorted(keys, [U(r["part"]) << U(bits[n] - part_bits) for r in rows]).tolist() if rows else []
            found = np.zeros(len(keys), dtype=np.int64)
            for r, a in zip(rows, cuts):
                if r[f"t{n}"] is not None:
                    got = unpack_numbers(r[f"t{n}"]).astype(np.int64)
                    found[a : a + len(got)] = got
            counts[n] = found[place]
        machine = Automaton(block, counts, tokens, distinct, strengths)
        ends = np.cumsum(block.lengths) + 1
        starts = ends - block.lengths
        known = np.add.reduceat((counts[1] > 0)[block.tokens].astype(np.int64), starts)
        base = np.add.reduceat(machine.base[block.tokens], starts)
        scores = [
            machine.traverse(*(block.at[n][a:b].tolist() for n in ORDERS)) for a, b in zip(starts.tolist(), ends.tolist())
        ]
        columns = [
            pa.array(ids, pa.int64()),
            pa.array([held_out(i, held_out_of, held_out_rest) for i in ids], pa.bool_()),
            pa.array(block.lengths),
            pa.array(known),
            pa.array([tokens] * len(ids), pa.int64()),
            pa.array(base),
            pa.array(scores, pa.float64()),
        ]
        return pa.Table.from_arrays(columns, names=names)

    schema = f"`{id_col}` bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return answers.filter("block IS NOT NULL").select("block", "part", "t1", "t2", "t3").groupBy("block").applyInArrow(score, schema)
