"""Request streams: a command a row, state by session.

A stream of events stands for a stream of commands; a user is a session. State is kept by key in the state store, so it is
bounded by the number of sessions; a session's commands are ordered, so they meet in one task by nature.

Views stand for `setoption`, clicks for `position`, purchases for `go`, any other type for `ucinewgame`.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Searches a table tells apart.
GENERATIONS = 32
KEPT = "option double, position double, generation long, searches long, resets long, requests long, last_request string"


def fold(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """A session's commands in order. An option and a position hold until they are set again; a search ages the table by a
    generation; a reset clears the table, so ageing starts anew, and leaves option and position as they are."""
    option, position, generation, searches, resets, requests, last = state.get if state.exists else (None, None, 0, 0, 0, 0, None)
    rows = pd.concat(list(parts)).sort_values(["ts", "event_id"])
    for kind, value in zip(rows["event_type"], rows["value"]):
        requests, last = requests + 1, kind
        if kind == "view":
            option = value
        elif kind == "click":
            position = value
        elif kind == "purchase":
            generation, searches = (generation + 1) % GENERATIONS, searches + 1
        else:
            generation, resets = 0, resets + 1
    now = (option, position, generation, searches, resets, requests, last)
    state.update(now)
    names = [c.split()[0] for c in KEPT.split(", ")]
    yield pd.DataFrame([(*key, *now)], columns=["user_id", *names]).astype({"option": "float64", "position": "float64"})


def session_state(requests: DataFrame) -> DataFrame:
    """The state of each session that a batch of requests has touched."""
    return requests.groupBy("user_id").applyInPandasWithState(fold, f"user_id long, {KEPT}", KEPT, "update", GroupStateTimeout.NoTimeout)


def _place(spark: SparkSession) -> str:
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        where = os.path.join(tempfile.gettempdir(), "plyframe-stream")
    return f"{where.rstrip('/')}/stream-{uuid.uuid4().hex}"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def _run(stream: DataFrame, mode: str) -> DataFrame:
    """All that is there, through the streaming engine: the rows of each batch, with its number as `batch`. A batch that runs twice
    replaces its rows."""
    spark = stream.sparkSession
    path = _place(spark)

    def keep(rows: DataFrame, n: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/out/batch={n}")

    query = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/checkpoint").foreachBatch(keep).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(f"{_ddl(stream)}, batch long").parquet(f"{path}/out")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{c}` {k}" for c, k in df.dtypes)


def run_available(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each session's state after all requests that are there."""
    rows = _run(session_state(_events(spark, sf_dir)), "update")
    return rows.groupBy("user_id").agg(F.max_by(F.struct(*[c.split()[0] for c in KEPT.split(", ")]), "batch").alias("s")).select("user_id", "s.*")


def hourly(events: DataFrame) -> DataFrame:
    """Counts by hour of event time and type. A watermark of 30 days bounds the open windows: a row is dropped if its window ended before the
    watermark that the batch before its own worked with, 30 days behind the newest row of still earlier batches."""
    kind = dict(events.dtypes)["ts"]
    e = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "30 days")
    counts = e.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("events"))
    return counts.select(F.col("w.start").cast(kind).alias("hour"), "event_type", "events")


def windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress events by hour of event time through the streaming engine. All that is there is one batch, so no row is late."""
    rows = _run(hourly(_events(spark, sf_dir)), "update")
    return rows.groupBy("hour", "event_type").agg(F.max_by("events", "batch").alias("events"))


def command_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log of commands, one for each event, written as text and followed as a stream; its requests are parsed as they come: how many
    name which position or limit, by their word, their moves and their depth."""
    from ..plans.text import _requests, parse_limits, parse_positions
    from ..sources.commands import register

    register(spark)
    path = _place(spark)
    _requests(spark, sf_dir).select("text").write.text(f"{path}/log")
    lines = spark.readStream.format("command_log").option("path", f"{path}/log").load().select(F.concat_ws(":", "file", F.col("at").cast("string")).alias("id"), "text")
    asked = parse_positions(lines).select("id", F.lit("position").alias("word"), F.col("n_moves").cast("long").alias("n"), F.col("fen").alias("body"))
    limits = parse_limits(lines).select("id", F.lit("go").alias("word"), F.col("depth").alias("n"), F.col("searchmoves").alias("body"))
    rows = _run(asked.unionByName(limits), "append")
    return rows.groupBy("word", "n", "body").agg(F.count(F.lit(1)).alias("requests"), F.countDistinct("id").alias("places"))


QUERIES = {"s1_command_log": command_log, "t1_session_state": run_available, "t6_event_windows": windowed}

def _log_oracle() -> str:
    from ..plans.text import ORACLE_SQL as TEXT

    return f"""WITH r AS (SELECT 'position' AS word, CAST(n_moves AS BIGINT) AS n, fen AS body FROM ({TEXT["s2_position_request"]}) UNION ALL SELECT 'go', CAST(depth AS BIGINT), searchmoves FROM ({TEXT["s4_limits_request"]}))
SELECT word, n, body, count(*) AS requests, count(*) AS places FROM r GROUP BY ALL"""


ORACLE_SQL = {
    "s1_command_log": _log_oracle(),
    "t1_session_state": f"""WITH e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
r AS (SELECT user_id, max(n) FILTER (event_type NOT IN ('view', 'click', 'purchase')) AS reset FROM e GROUP BY user_id)
SELECT user_id, arg_max(value, n) FILTER (event_type = 'view') AS "option", arg_max(value, n) FILTER (event_type = 'click') AS "position",
  count(*) FILTER (event_type = 'purchase' AND n > coalesce(reset, 0)) % {GENERATIONS} AS generation, count(*) FILTER (event_type = 'purchase') AS searches,
  count(*) FILTER (event_type NOT IN ('view', 'click', 'purchase')) AS resets, count(*) AS requests, arg_max(event_type, n) AS last_request FROM e JOIN r USING (user_id) GROUP BY user_id""",
    "t6_event_windows": "SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS events FROM events GROUP BY ALL",
}
