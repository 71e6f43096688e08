"""Expiring slots in several batches against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from plyframe.streaming import expiring as E

START = dt.datetime(2024, 1, 1)


def make(seed=4, n=400):
    rng = random.Random(seed)
    times = sorted(START + dt.timedelta(minutes=rng.randint(0, 20 * 24 * 60)) for _ in range(n))
    rows = [(i, t, rng.choice([1, 1, 1, 2, None]), rng.choice(["view", "purchase"])) for i, t in enumerate(times)]
    exact = START + dt.timedelta(days=30)
    # written again exactly when due, and just before
    rows += [(8 * 1000, exact, 9, "view"), (8 * 1001, exact + dt.timedelta(hours=E.LIFE_HOURS), 9, "view"), (8 * 1002, exact + dt.timedelta(hours=2 * E.LIFE_HOURS, seconds=-1), 9, "view")]
    return rows


def expected(rows):
    end = max(r[1] for r in rows) - dt.timedelta(hours=1)
    age, slots, out = {}, {}, []
    life = dt.timedelta(hours=E.LIFE_HOURS)
    for event, at, user, kind in sorted(rows, key=lambda r: (r[1], r[0])):
        age[user] = (age.get(user, 0) + (kind == "purchase")) % E.GENERATIONS
        held = slots.get((user, event % E.SLOTS))
        if held and held[2] + life <= at:
            out.append((user, event % E.SLOTS, *held, held[2] + life))
        slots[user, event % E.SLOTS] = (event, age[user], at)
    out += [(user, slot, *held, held[2] + life) for (user, slot), held in slots.items() if held[2] + life <= end]
    return sorted(out, key=str)


@pytest.mark.parametrize("files", [1, 5])
def test_expiry_does_not_depend_on_batches(spark, tmp_path, files):
    rows = sorted(make(), key=lambda r: (r[1], r[0]))
    kinds = "event_id long, ts timestamp, user_id long, event_type string"
    size = -(-len(rows) // files)
    for k in range(files):
        spark.createDataFrame(rows[k * size : (k + 1) * size], kinds).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    before = spark.conf.get(E.STORE, None)
    spark.conf.set(E.STORE, E.ROCKS)
    try:
        stream = spark.readStream.schema(kinds).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        got = E._run(E.expiring(stream), "append").collect()
    finally:
        spark.conf.set(E.STORE, before) if before else spark.conf.unset(E.STORE)
    assert sorted(((r["user_id"], r["slot"], r["entry"], r["generation"], r["written"], r["due"]) for r in got), key=str) == expected(rows)
    assert any(r["entry"] == 8000 for r in got) and not any(r["entry"] == 8001 for r in got)


def test_late_rows_of_hourly_windows(spark, tmp_path):
    """Rows within 30 days of the newest one of the batches before the last count, older ones are dropped."""
    import time

    from plyframe.streaming.requests import _run, hourly

    day = lambda d, m=0: START + dt.timedelta(days=d, minutes=m)
    batches = [[(day(0), "view"), (day(60), "view")], [(day(50), "view")], [(day(31), "view"), (day(29), "view"), (day(0, 5), "view"), (day(60, 10), "view")]]
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, "ts timestamp, event_type string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(1.1)  # files are read in the order of their times
    stream = spark.readStream.schema("ts timestamp, event_type string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = _run(hourly(stream), "update").groupBy("hour").agg(F.max_by("events", "batch").alias("n")).collect()
    assert {r["hour"]: r["n"] for r in got} == {day(0): 1, day(31): 1, day(50): 1, day(60): 2}
