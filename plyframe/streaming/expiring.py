"""Table slots with a time to live: keyed state, event-time timers, generations.

A session is a user, a slot of its table event_id % SLOTS. An event writes its slot; a purchase is a search, which ages the table by a
generation. A slot that isn't written for LIFE expires: it leaves the state and is reported with the time at which it was due. Expiry
doesn't depend on how events are cut into batches: a slot that is overdue when it is written again expires first, others by a timer once
the watermark, DELAY behind the newest event, reaches it. What is still alive at the end isn't reported. State is a table of SLOTS entries a
session, so it is bounded by sessions that have written lately; the rows of a session in one batch are sorted in memory, which
maxFilesPerTrigger bounds.

Defined cases: events later than the watermark are dropped by the engine; events without a user are a session of their own; a slot that is
written again exactly when it is due has expired.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from .requests import GENERATIONS, _events, _run

SLOTS, LIFE_HOURS, DELAY = 8, 36, "1 hour"
FOUND = "user_id long, slot int, entry long, generation int, written timestamp, due timestamp"
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LIFE_MS = LIFE_HOURS * 3_600_000


class Slots(StatefulProcessor):
    """A session's table as one value: its generation, the time of its pending timer in milliseconds, and by slot the entry, its generation and
    when it was written, in microseconds. One value is read and written for a session's rows of a batch, and one timer is pending, for the
    slot that is due first: calls to the store, not rows, are what a session costs."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.table = handle.getValueState("table", "generation int, timer long, " + ", ".join(f"entry{i} long, generation{i} int, written{i} long" for i in range(SLOTS)))

    def _read(self) -> tuple[int, int | None, dict[int, tuple]]:
        held = self.table.get()
        if held is None:
            return 0, None, {}
        return held[0], held[1], {i: tuple(held[2 + 3 * i : 5 + 3 * i]) for i in range(SLOTS) if held[2 + 3 * i] is not None}

    def _write(self, generation: int, timer: int | None, slots: dict[int, tuple]) -> None:
        """The state, with a timer for the first slot that is due unless one as early is pending."""
        first = min((self._due(held) for held in slots.values()), default=None)
        if first is not None and (timer is None or first < timer):
            self.handle.registerTimer(first)
            timer = first
        self.table.update((generation, timer, *(x for i in range(SLOTS) for x in slots.get(i, (None, None, None)))))

    @staticmethod
    def _due(held: tuple) -> int:
        """The first millisecond by which a slot has expired."""
        return -(-held[2] // 1000) + LIFE_MS

    @staticmethod
    def _gone(key: tuple, slot: int, held: tuple) -> tuple:
        return (key[0], slot, *held, held[2] + 1000 * LIFE_MS)

    @staticmethod
    def _table(key: tuple, gone: list[tuple]) -> Iterator[pd.DataFrame]:
        if gone:
            user, slot, entry, generation, written, due = zip(*gone)
            at = lambda us: np.array(us, "int64").view("datetime64[us]")
            yield pd.DataFrame({"user_id": user, "slot": np.array(slot, "int32"), "entry": entry, "generation": np.array(generation, "int32"), "written": at(written), "due": at(due)})

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = [[part[c].to_numpy() for c in ("at", "event_id", "event_type")] for part in rows]
        ats, events, kinds = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((events, ats))
        generation, timer, slots = self._read()
        gone = []
        for at, event, kind in zip(ats[order].tolist(), events[order].tolist(), kinds[order].tolist()):
            if kind == "purchase":
                generation = (generation + 1) % GENERATIONS
            slot = event % SLOTS
            held = slots.get(slot)
            if held and held[2] + 1000 * LIFE_MS <= at:
                gone.append(self._gone(key, slot, held))
            slots[slot] = (event, generation, at)
        self._write(generation, timer, slots)
        yield from self._table(key, gone)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """All slots whose timers the watermark has passed leave at once; the next one that is due gets the timer. A timer that an earlier one
        has replaced finds nothing."""
        now, mark = expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()
        generation, timer, slots = self._read()
        due = [(slot, held) for slot, held in slots.items() if self._due(held) <= mark]
        for slot, _ in due:
            del slots[slot]
        self._write(generation, None if timer == now else timer, slots)
        yield from self._table(key, [self._gone(key, slot, held) for slot, held in due])

    def close(self) -> None:
        pass


def expiring(events: DataFrame) -> DataFrame:
    """The slots that expire. events: event_id, ts, user_id, event_type."""
    rows = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", DELAY)
    rows = rows.select("ts", "event_id", "user_id", "event_type", F.unix_micros("ts").alias("at"))
    return rows.groupBy("user_id").transformWithStateInPandas(Slots(), FOUND, "append", "EventTime")


def expired_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots that expire, through the streaming engine, over all events that are there."""
    before = spark.conf.get(STORE, None)
    spark.conf.set(STORE, ROCKS)  # timers need this store
    try:
        rows = _run(expiring(_events(spark, sf_dir)), "append")
    finally:
        spark.conf.set(STORE, before) if before else spark.conf.unset(STORE)
    kind = dict(spark.read.parquet(f"{sf_dir}/events.parquet").dtypes)["ts"]
    return rows.select("user_id", "slot", "entry", "generation", F.col("written").cast(kind).alias("written"), F.col("due").cast(kind).alias("due"))


QUERIES = {"t4_expired_slots": expired_slots}
#: By the next write of each slot; the newest event sets the watermark.
ORACLE_SQL = {
    "t4_expired_slots": f"""WITH e AS (SELECT *, CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) % {GENERATIONS} AS INTEGER) AS generation FROM events),
n AS (SELECT *, CAST(event_id % {SLOTS} AS INTEGER) AS slot, lead(ts) OVER (PARTITION BY user_id, event_id % {SLOTS} ORDER BY ts, event_id) AS next, ts + INTERVAL {LIFE_HOURS} HOUR AS due FROM e)
SELECT user_id, slot, event_id AS entry, generation, ts AS written, due FROM n WHERE CASE WHEN next IS NULL THEN due <= (SELECT max(ts) FROM events) - INTERVAL {DELAY} ELSE next >= due END"""
}
