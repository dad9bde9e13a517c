"""Best-fit packing with a swap-based local search.

Documents become token ids and, where longer than a sequence, pieces. Each task packs the pieces it has made: a best-fit
pass in order of falling length, then exchanges between all underfull bins. A set of pieces is finished when the waste is
under one sequence, as no packing of it has fewer bins then, or when no move of one or two documents and no exchange of
one for one, two for one or one for two is left that raises the sum of squared fills.

Bins that are full stay as they are. The pieces of the others, a few numbers each, meet those of other tasks in further
rounds, in sets of bounded size and of the emptiest bins, until one set holds them all or a round empties no bin any more. So the number of
sequences hardly depends on how the documents were dealt to tasks. No text is shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.llm.common import stored, text_or_empty
from rillmark.llm.tokens import encoder_for

Bin = list[tuple[int, int]]


def best_fit(lengths: list[int], capacity: int) -> list[Bin]:
    """Bins of (length, item): each item, longest first, goes where it leaves the least room."""
    bins: list[Bin] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        n = lengths[item]
        fitting = rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            k = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, k = capacity, len(bins)
            bins.append([])
        bins[k].append((n, item))
        by_room[room - n].append(k)
        rooms |= 1 << (room - n)
    return bins


class Search:
    """Underfull bins by room, with indexes of the single documents and the pairs that bins of each room hold.

    A set of lengths is a whole number with a bit per length, so all exchanges of one gain are looked up by a shift.
    Bit 0 stands for no document at all.
    """

    def __init__(self, bins: list[Bin], capacity: int) -> None:
        self.bins, self.capacity = bins, capacity
        self.fill = [sum(n for n, _ in b) for b in bins]
        self.waste = sum(capacity - f for f in self.fill)
        #: per room, singles and pairs: which bins hold a length, the lengths, and the lengths at this room or more
        self.holding: list[tuple[dict[int, dict[int, None]], ...]] = [({}, {}) for _ in range(capacity + 1)]
        self.here = [[0] * (capacity + 1) for _ in range(2)]
        self.upward = [[0] * (capacity + 2) for _ in range(2)]
        for k in range(len(bins)):
            self.enter(k)

    def underfull(self, k: int) -> bool:
        return 0 < self.fill[k] < self.capacity

    def lengths(self, k: int) -> tuple[int, int]:
        singles = pairs = 0
        for n, _ in self.bins[k]:
            pairs |= singles << n
            singles |= 1 << n
        return singles | 1, pairs

    def enter(self, k: int) -> None:
        if self.underfull(k):
            room = self.capacity - self.fill[k]
            for kind, found in enumerate(self.lengths(k)):
                for n in bits(found):
                    self.holding[room][kind].setdefault(n, {})[k] = None
                self.here[kind][room] |= found
                self.carry(kind, room)

    def leave(self, k: int) -> None:
        if self.underfull(k):
            room = self.capacity - self.fill[k]
            for kind, found in enumerate(self.lengths(k)):
                holding = self.holding[room][kind]
                for n in bits(found):
                    del holding[n][k]
                    if not holding[n]:
                        del holding[n]
                        self.here[kind][room] ^= 1 << n
                self.carry(kind, room)

    def carry(self, kind: int, room: int) -> None:
        here, upward = self.here[kind], self.upward[kind]
        while room and upward[room] != (now := upward[room + 1] | here[room]):
            upward[room] = now
            room -= 1

    def step(self, k: int) -> tuple[int, int] | None:
        """The exchange of this bin with another that brings most to the one of them that gains, if any raises the sum."""
        if not self.seek(k):
            return None
        self.leave(k)
        found = self.seek(k)
        if not found:
            self.enter(k)
            return None
        gives, other, out, back = found
        self.leave(other)
        giver, taker = (k, other) if gives else (other, k)
        go, come = take(self.bins[giver], *out), take(self.bins[taker], *back)
        self.bins[giver] += come
        self.bins[taker] += go
        for x in (giver, taker):
            self.fill[x] = sum(n for n, _ in self.bins[x])
            self.enter(x)
        if not self.fill[giver]:
            self.waste -= self.capacity
        return giver, taker

    def seek(self, k: int) -> tuple[bool, int, tuple[int, int], tuple[int, int]] | None:
        """(whether the bin gives, the other bin, what the giver gives, what it gets), each as (kind, length).

        With a gain of g the sum rises if the taker's room less g is smaller than the giver's room.
        """
        own, room = self.lengths(k), self.capacity - self.fill[k]
        here, upward = self.here, self.upward
        largest = self.capacity
        while largest and not upward[0][largest]:
            largest -= 1
        for gain in range(max(largest, room), 0, -1):
            for mine, other in KINDS:
                given = own[mine] >> gain
                if gain <= largest and given & upward[other][gain]:
                    for r in range(gain, min(largest, gain + room - 1) + 1):
                        if hit := given & here[other][r]:
                            n = (hit & -hit).bit_length() - 1
                            return True, next(iter(self.holding[r][other][n])), (mine, n + gain), (other, n)
                if gain <= room and own[mine] << gain & upward[other][least := room - gain + 1]:
                    for r in range(largest, least - 1, -1):
                        if hit := own[mine] << gain & here[other][r]:
                            n = (hit & -hit).bit_length() - 1
                            return False, next(iter(self.holding[r][other][n])), (other, n), (mine, n - gain)
        return None


#: Singles against singles or none, singles against pairs, pairs against singles or none.
KINDS = ((0, 0), (0, 1), (1, 0))


def bits(found: int) -> Iterator[int]:
    while found:
        yield (found & -found).bit_length() - 1
        found &= found - 1


def take(held: Bin, kind: int, n: int) -> Bin:
    """Take one document (kind 0) or two (kind 1) of that length together out of a bin."""
    if not n:
        return []
    if not kind:
        chosen = [next(x for x in held if x[0] == n)]
    else:
        chosen = next([held[i], held[j]] for i in range(len(held)) for j in range(i) if held[i][0] + held[j][0] == n)
    for x in chosen:
        held.remove(x)
    return chosen


def local_search(bins: list[Bin], capacity: int) -> list[Bin]:
    """Move one or two documents, or exchange one for one, two for one or one for two, until none of it helps.

    Every underfull bin waits in a queue, emptiest first; it is tried against all others as giver and as taker, and
    waits again when its contents change. So when the queue is empty, no two bins are left between which a step would
    raise the sum of squared fills. Each step raises it, so the search ends; it ends early when the waste is under one
    bin, as no packing has fewer bins then.
    """
    if sum(capacity - sum(n for n, _ in b) for b in bins) < capacity:
        return bins
    search = Search(bins, capacity)
    waiting = {k for k in range(len(bins)) if search.underfull(k)}
    queue = [(search.fill[k], k) for k in waiting]
    heapify(queue)
    while queue and search.waste >= capacity:
        fill, k = heappop(queue)
        if fill != search.fill[k] or k not in waiting:
            continue
        waiting.discard(k)
        for changed in search.step(k) or ():
            if search.underfull(changed):
                waiting.add(changed)
                heappush(queue, (search.fill[changed], changed))
            else:
                waiting.discard(changed)
    return [b for b in bins if b]


def pack(lengths: list[int], capacity: int) -> list[Bin]:
    return local_search(best_fit(lengths, capacity), capacity)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: whole sequences, before them what is left over."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity
    return [(0, first)] * bool(first) + [(at, capacity) for at in range(first, n, capacity)]


#: Bits for the sequences of a task, and for the tasks of a round, in a sequence number.
COUNT_BITS, TASK_BITS = 28, 28


def pack_documents(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = 1024,
    spaces: str = "lead",
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    pieces_at_once: int = 65_536,
) -> DataFrame:
    """One row per piece: ``id_col, piece, start, length, ids_crc32, sequence_id, offset``.

    A sequence number is made of the round, the task's number and a count. ``pieces_at_once`` bounds what a task packs
    together; pieces of underfull sequences are packed again, with those of other sets, as long as that empties any.

    * Null and empty texts are a piece of the end id alone. Texts may be of any length; no piece is dropped.
    * Repeated rows and null ids are packed like any other. Other columns are ignored.
    * Pieces of equal length keep their order. An empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col), text_or_empty(text_col))
    id_type = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "open"]
    kinds = [None, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
    schema = f"`{id_col}` {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint, open boolean"

    class Task:
        """Packs what one task has, set after set."""

        def __init__(self, round_no: int, id_kind: pa.DataType) -> None:
            self.number = (round_no << (COUNT_BITS + TASK_BITS)) | (TaskContext.get().partitionId() << COUNT_BITS)
            self.id_kind, self.again = id_kind, round_no > 0
            self.waiting: list[tuple] = []
            self.whole: list[tuple] = []

        def put(self, row: tuple) -> Iterator[pa.RecordBatch]:
            if row[3] == capacity:
                self.whole.append((*row, self.next(), 0, False))
            else:
                self.waiting.append(row)
            if len(self.waiting) >= pieces_at_once:
                yield from self.packed()
            if len(self.whole) >= 10_000:
                yield self.batch(self.whole)
                self.whole = []

        def next(self) -> int:
            self.number += 1
            return self.number - 1

        def packed(self) -> Iterator[pa.RecordBatch]:
            found = []
            bins = sorted(pack([w[3] for w in self.waiting], capacity), key=lambda held: sum(n for n, _ in held))
            rooms = [capacity - sum(n for n, _ in held) for held in bins]
            # the first time all underfull bins are open, later the emptiest, with half of the room, so sets get fewer
            wanted = sum(rooms) / 2 if self.again else capacity * len(bins)
            for held, room in zip(bins, rooms):
                place, number, left = 0, self.next(), room > 0 and wanted > 0
                wanted -= room
                for n, item in held:
                    found.append((*self.waiting[item], number, place, left))
                    place += n
            self.waiting = []
            yield self.batch(found)

        def end(self) -> Iterator[pa.RecordBatch]:
            if self.waiting:
                yield from self.packed()
            if self.whole:
                yield self.batch(self.whole)

        def batch(self, found: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array(c, k or self.id_kind) for c, k in zip(zip(*found), kinds)]
            return pa.RecordBatch.from_arrays(columns, names=names)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(vocabulary, spaces)
        end = end_id.to_bytes(4, "little")
        task = None
        for batch in batches:
            task = task or Task(0, batch.column(0).type)
            some = (batch.slice(at, 256) for at in range(0, batch.num_rows, 256))
            for name, ids in ((n, i) for b in some for n, i in zip(b.column(0).to_pylist(), encoder.encode_batch(b.column(1).to_pylist()))):
                ids += end
                for k, (start, n) in enumerate(cut(len(ids) // 4, capacity)):
                    yield from task.put((name, k, start, n, zlib.crc32(ids[4 * start : 4 * (start + n)])))
        if task:
            yield from task.end()

    def again(round_no: int):
        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            task = None
            for batch in batches:
                task = task or Task(round_no, batch.column(0).type)
                for row in zip(*(batch.column(k).to_pylist() for k in range(5))):
                    yield from task.put(row)
            if task:
                yield from task.end()

        return each

    done = stored(rows.mapInArrow(first, schema), "packed")
    parts = [done.filter("NOT open")]
    left, before, round_no = done.filter("open"), None, 0
    while True:
        size = left.agg(F.count(F.lit(1)).alias("pieces"), F.count_distinct("sequence_id").alias("bins")).first()
        sets = -(-size["pieces"] // pieces_at_once)
        if not sets or before is not None and (before[0] == 1 or sets >= before[0] and size["bins"] >= before[1]):
            break
        before, round_no = (sets, size["bins"]), round_no + 1
        mixed = left.select(*names[:5]).repartition(sets, F.xxhash64(*names[:5], F.lit(round_no)))
        found = stored(mixed.mapInArrow(again(round_no), schema), "packed")
        parts.append(found.filter("NOT open"))
        left = found.filter("open")
    return reduce(DataFrame.unionByName, [*parts, left]).drop("open")
