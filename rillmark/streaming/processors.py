"""Keyed state and timers on streams, with ``transformWithState``.

For answers that are due at a time of their own, which need timers. ``in_order`` holds the events
of a key until the watermark passes them and then feeds them, in event-time order, to a small step
function; what needs no timer runs on the batch operators (``turns``). So results do not depend on how
events were cut into micro-batches, and they equal those of the batch operators. State
of a key lives in one task; rows wait there no longer than the watermark delay.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from rillmark.columns import Names, names
from rillmark.session import STATE_STORE

Memory = tuple | None


@dataclass(frozen=True)
class Step:
    """What to do with each event of a key, in event-time order.

    ``take(memory, event)`` returns the new memory and the rows to send; ``event`` has
    the kept columns and ``at``, its time in epoch microseconds. ``due(memory)`` names the
    next time in microseconds at which ``fire(memory, time)`` shall run, if any.
    """

    memory: str
    output: str
    take: Callable[[Memory, Row], tuple[Memory, list[tuple]]]
    due: Callable[[tuple], int | None] = lambda memory: None
    fire: Callable[[tuple, int], tuple[Memory, list[tuple]]] | None = None


class InOrder(StatefulProcessor):
    """Runs a ``Step`` over the events of a key once the watermark has passed them."""

    def __init__(self, step: Step, held: T.StructType, output: T.StructType, keys: int) -> None:
        self.step, self.held_schema, self.output, self.keys = step, held, output, keys

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", self.held_schema)
        self.memory = handle.getValueState("memory", self.step.memory)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        fields = self.held_schema.fieldNames()
        new = [tuple(row[f] for f in fields) for row in rows]
        if new:
            self.held.appendList(new)
            self.handle.registerTimer(self._ms(min(e[0] for e in new)))
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs()
        waiting = [Row(**dict(zip(self.held_schema.fieldNames(), e))) for e in self.held.get()]
        ready = sorted((e for e in waiting if self._ms(e["at"]) <= passed), key=lambda e: (e["at"], e["seq"]))
        rest = [tuple(e) for e in waiting if self._ms(e["at"]) > passed]
        memory = self.memory.get() if self.memory.exists() else None
        sent: list[tuple] = []
        for event in ready:
            memory = self._fire_until(memory, event["at"], sent)
            memory, out = self.step.take(memory, event)
            sent += out
        memory = self._fire_until(memory, passed * 1000 + 1, sent)
        if ready:
            self.held.put(rest) if rest else self.held.clear()
        self.memory.clear() if memory is None else self.memory.update(memory)
        due = self.step.due(memory) if memory is not None else None
        for at in (min((e[0] for e in rest), default=None), due):
            if at is not None:
                self.handle.registerTimer(max(self._ms(at), passed + 1))
        for values in sent:
            yield Row(**dict(zip(self.output.fieldNames(), (*key, *values))))

    def close(self) -> None:
        pass

    def _fire_until(self, memory: Memory, before: int, sent: list[tuple]) -> Memory:
        while memory is not None and self.step.fire:
            at = self.step.due(memory)
            if at is None or at >= before:
                break
            memory, out = self.step.fire(memory, at)
            sent += out
        return memory

    @staticmethod
    def _ms(at: int) -> int:
        return at // 1000


def use_state_store(df: DataFrame) -> None:
    """Stateful processors need the RocksDB state store."""
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


def _fields(df: DataFrame, columns: Iterable[str]) -> list[T.StructField]:
    return [T.StructField(c, df.schema[c].dataType) for c in columns]


def in_order(df: DataFrame, *, key: Names, ts: str, seq: str, keep: Names, step: Step) -> DataFrame:
    """Run a step over the events of each key in event-time order; needs a watermark on ``ts``.

    ``seq`` is a whole-number column that orders events of the same time.
    """
    use_state_store(df)
    keys, kept = names(key), [c for c in names(keep) if c != seq]
    ready = df.withColumns({"at": F.unix_micros(ts), "seq": F.col(seq).cast("bigint")})
    ready = ready.select(*keys, ts, "at", "seq", *kept)
    held = T.StructType(_fields(ready, ["at", "seq", *kept]))
    output = T.StructType(_fields(df, keys) + T._parse_datatype_string(step.output).fields)
    return ready.groupBy(*keys).transformWithState(
        InOrder(step, held, output, len(keys)), output, "append", "EventTime"
    )


def running_total_step(wait_us: int) -> Step:
    """Count since the beginning, sent ``wait_us`` after the first event since the last report."""

    def take(memory: Memory, e: Row) -> tuple[Memory, list[tuple]]:
        total, report_at = memory or (0, None)
        return (total + 1, e["at"] + wait_us if report_at is None else report_at), []

    return Step(
        memory="total bigint, report_at bigint",
        output="reported_us bigint, total bigint",
        take=take,
        due=lambda memory: memory[1],
        fire=lambda memory, at: ((memory[0], None), [(at, memory[0])]),
    )


class Alarms(StatefulProcessor):
    """Sets a timer for each event and tells when it was set and when it rang."""

    def __init__(self, wait_ms: int, event_time: bool) -> None:
        self.wait, self.event_time = wait_ms, event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "n bigint")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        clock = timerValues.getCurrentWatermarkInMs() if self.event_time else now
        n = self.seen.get()[0] if self.seen.exists() else 0
        for row in rows:
            at = row["ms"] if self.event_time else now
            n += 1
            self.handle.registerTimer(at + self.wait)
            yield Row(key=key[0], kind="set", time_ms=at, clock_ms=clock)
        self.seen.update((n,))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        clock = timerValues.getCurrentWatermarkInMs() if self.event_time else now
        yield Row(key=key[0], kind="rang", time_ms=expiredTimerInfo.getExpiryTimeInMs(), clock_ms=clock)

    def close(self) -> None:
        pass


def alarms(df: DataFrame, *, key: str, ts: str, wait_ms: int, event_time: bool = True) -> DataFrame:
    """A timer ``wait_ms`` after each event, on event time or on the machine's clock."""
    use_state_store(df)
    kind = df.schema[key].dataType.simpleString()
    ready = df.select(F.col(key).alias("key"), ts, F.unix_millis(ts).alias("ms"))
    rung = ready.groupBy("key").transformWithState(
        Alarms(wait_ms, event_time),
        f"key {kind}, kind string, time_ms bigint, clock_ms bigint",
        "append",
        "EventTime" if event_time else "ProcessingTime",
    )
    return rung.withColumnRenamed("key", key)


class LastSeen(StatefulProcessor):
    """The key's previous value, forgotten when it has not been written for the time to live."""

    def __init__(self, ttl_ms: int) -> None:
        self.ttl = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "value string", ttlDurationMs=self.ttl)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        previous = self.last.get()[0] if self.last.exists() else None
        for row in sorted(rows, key=lambda r: r["seq"]):
            yield Row(key=key[0], seq=row["seq"], current=row["value"], previous=previous)
            previous = row["value"]
        self.last.update((previous,))

    def close(self) -> None:
        pass


def last_seen_with_ttl(df: DataFrame, *, key: str, seq: str, value: str, ttl_ms: int) -> DataFrame:
    """Each value with the key's previous one, which lives ``ttl_ms`` of processing time."""
    use_state_store(df)
    kind = df.schema[key].dataType.simpleString()
    ready = df.select(
        F.col(key).alias("key"), F.col(seq).cast("bigint").alias("seq"), F.col(value).cast("string").alias("value")
    )
    seen = ready.groupBy("key").transformWithState(
        LastSeen(ttl_ms), f"key {kind}, seq bigint, current string, previous string", "append", "ProcessingTime"
    )
    return seen.withColumnRenamed("key", key)
