"""A session's rows of a batch cost a fixed number of calls to the state store; slots due at the watermark itself."""

import datetime as dt

import pandas as pd

from plyframe.streaming import expiring as E
from plyframe.streaming.requests import _run

HOUR_US = 3_600_000_000


class Store:
    """Stands for the handle, its value and its timers; counts calls."""

    def __init__(self):
        self.calls, self.value, self.timers = 0, None, []

    def getValueState(self, *_):
        return self

    getMapState = getValueState

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value

    def registerTimer(self, at):
        self.calls += 1
        self.timers.append(at)


class Now:
    def __init__(self, at):
        self.at = at

    def getExpiryTimeInMs(self):
        return self.at

    getCurrentWatermarkInMs = getExpiryTimeInMs


def test_calls_do_not_grow_with_slots(spark):
    store, slots = Store(), E.Slots()
    slots.init(store)
    rows = pd.DataFrame([(i * HOUR_US, i, "purchase" if i % 3 == 0 else "view") for i in range(8)], columns=["at", "event_id", "event_type"])
    assert list(slots.handleInputRows((1,), iter([rows]), None)) == []
    assert store.calls == 3 and store.timers == [E.LIFE_MS]
    # three slots are behind the watermark: they leave at once, and the next is given the timer
    gone = list(slots.handleExpiredTimer((1,), Now(2 * 3_600_000 + E.LIFE_MS + 1), Now(E.LIFE_MS)))
    assert [tuple(x)[:4] for x in gone[0].itertuples(index=False)] == [(1, 0, 0, 1), (1, 1, 1, 1), (1, 2, 2, 1)]
    assert store.calls == 6 and store.timers[1:] == [3 * 3_600_000 + E.LIFE_MS]


def test_slots_due_at_the_watermark(spark, tmp_path):
    """User 1 has a slot due before the watermark and one due at it, user 2 only the latter: all three expire."""
    start = dt.datetime(2024, 1, 1)
    hours = lambda h: start + dt.timedelta(hours=h)
    rows = [(0, hours(0), 1, "view"), (1, hours(1), 1, "view"), (9, hours(1), 2, "view"), (2, hours(2), 1, "view"), (3, hours(1 + E.LIFE_HOURS + 1), 3, "view")]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string").coalesce(1).write.parquet(str(tmp_path / "in"))
    before = spark.conf.get(E.STORE, None)
    spark.conf.set(E.STORE, E.ROCKS)
    try:
        got = _run(E.expiring(spark.readStream.schema("event_id long, ts timestamp, user_id long, event_type string").parquet(str(tmp_path / "in"))), "append").collect()
    finally:
        spark.conf.set(E.STORE, before) if before else spark.conf.unset(E.STORE)
    assert sorted(r["entry"] for r in got) == [0, 1, 9]
