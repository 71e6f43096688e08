"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents are shuffled by a hash and laid end to end; the stream is cut into blocks of equally many words,
and starts over when it ends. Slot i of the schedule takes the golden-ratio point frac(i * phi), whose place in the
cumulative target shares names the slot's source; the r-th slot of a source takes block r of its stream. A source's last
block is cut so that it takes its target to the word; the few blocks that the schedule, whose discrepancy is
logarithmic, leaves out stand at its end.

No step gathers a source in one task: running sums and ranks go by buckets (documents by leading hash bits, slots by runs
of 65,536) and only bucket totals are accumulated in one window.

Defined cases: null text has size 0; a null source is a source, the last; empty sources have target 0; documents without
words are never taken; repeated rows are documents of their own, told apart by a number; an empty table gives an empty result; columns other
than doc_id, text and source are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, only

PHI = 0.6180339887498949
CELLS = 4096
RUN = 65_536
#: Words: runs of characters other than ASCII white space.
WORDS = r"[^\x20\x09-\x0D]+"


def measured(docs: DataFrame, seed: int = 0) -> DataFrame:
    """doc_id, source, size, sk (shuffle key), h, tie (a number among identical rows); texts are read once.

    The shuffle key hashes doc_id, text and tie, so rows without doc_id, or the same row many times, are spread like any others.
    """
    rows = only(docs, doc_id="long", text="string", source="string")
    text = F.coalesce("text", F.lit(""))
    rows = rows.select("doc_id", "source", F.regexp_count(text, F.lit(WORDS)).cast("long").alias("size"), F.xxhash64(text).alias("h"))
    lots = materialize(rows.groupBy("doc_id", "source", "size", "h").agg(F.count(F.lit(1)).alias("n")), "mix-lots")
    ties = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("tie")
    few = lots.where(F.col("n") <= RUN).select("doc_id", "source", "size", "h", ties)
    # a lot of many identical rows is written out by as many tasks as it has runs
    many = lots.where(F.col("n") > RUN).withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {RUN}")))).repartition("h", "doc_id", "source", "run")
    many = many.select("doc_id", "source", "size", "h", F.explode(F.sequence(F.col("run") * RUN, F.least(F.col("n"), (F.col("run") + 1) * RUN) - 1)).alias("tie"))
    return materialize(few.unionByName(many).withColumn("sk", F.xxhash64(F.lit(seed), "doc_id", "h", "tie")), "mix-sizes")


def source_targets(meas: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: float = 3.0) -> DataFrame:
    """One row a source: src (its number), source, source_size, target, lo and hi (share of the schedule).

    Targets share all words by weight but stop at `most` times a source's size; the excess is shared again. In the order of
    source_size / weight the stopped sources come first, so one running sum finds them.
    """
    sources = meas.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())  # a row a source
    sources = sources.withColumn("src", (F.row_number().over(order) - 1).cast("int"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    sources = sources.withColumn("w", F.element_at(cycle, F.pmod("src", F.lit(len(weights))) + 1)).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    by_cap = Window.orderBy(F.col("cap") / F.col("w"), "src")
    before, every = by_cap.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weight = F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    sources = sources.withColumn("level", left / weight).withColumn("stopped", F.col("cap") <= F.col("w") * F.col("level"))
    # the first source that isn't stopped sets the level for all after it
    level = F.min(F.when(~F.col("stopped"), F.struct(F.col("cap") / F.col("w"), "src", "level"))).over(every)["level"]
    sources = sources.withColumn("target", F.when(F.col("stopped"), F.col("cap")).otherwise(F.least("cap", F.col("w") * level)))
    upto, total = F.sum("target").over(Window.orderBy("src")), F.sum("target").over(every)
    share = F.when(total > 0, upto / total).otherwise(F.lit(0.0))
    return sources.withColumn("hi", share).withColumn("lo", F.coalesce(F.lag(share).over(Window.orderBy("src")), F.lit(0.0))).select("src", "source", "source_size", "target", "lo", "hi")


def schedule(sources: DataFrame, block: int) -> DataFrame:
    """One row a block taken: slot, src, rank. sources: of source_targets."""
    spark = sources.sparkSession
    need = F.ceil(F.floor(F.col("target") + 0.5) / block).cast("long")
    total = sources.agg(F.sum("target")).first()[0] or 0
    slots = math.ceil(total / block)
    cells = sources.where("hi > lo").select("src", "lo", "hi", F.explode(F.sequence(F.floor(F.col("lo") * CELLS), F.least(F.lit(CELLS), F.floor(F.col("hi") * CELLS)))).alias("cell"))
    point = F.col("id").cast("double") * PHI
    points = spark.range(slots).select(F.col("id").alias("slot"), (point - F.floor(point)).alias("point")).withColumn("cell", F.floor(F.col("point") * CELLS))
    dealt = points.join(cells, "cell").where("point >= lo and point < hi").select("slot", "src", F.expr(f"slot div {RUN}").alias("run"))
    counts = dealt.groupBy("src", "run").agg(F.count(F.lit(1)).alias("n"))
    starts = counts.select("src", "run", (F.sum("n").over(Window.partitionBy("src").orderBy("run")) - F.col("n")).alias("start"))
    ranked = dealt.withColumn("r", F.row_number().over(Window.partitionBy("src", "run").orderBy("slot"))).join(starts, ["src", "run"])
    ranked = ranked.select("slot", "src", (F.col("start") + F.col("r") - 1).alias("rank"))
    needs = sources.select("src", need.alias("need"))
    given = counts.groupBy("src").agg(F.sum("n").alias("given"))
    short = needs.join(given, "src", "left").where(F.col("need") > F.coalesce("given", F.lit(0)))
    missing = short.select("src", F.explode(F.sequence(F.coalesce("given", F.lit(0)), F.col("need") - 1)).alias("rank"))
    late = missing.select((F.lit(slots) + F.col("rank")).alias("slot"), "src", "rank")
    return ranked.join(needs, "src").where("rank < need").select("slot", "src", "rank").unionByName(late)


def streams(meas: DataFrame, sources: DataFrame, per_task: int = 20_000) -> DataFrame:
    """Each document with src, its place `at` in its source's shuffled stream, and a key (b, r) unique within src."""
    n = meas.count()
    bits = max(4, min(40, math.ceil(math.log2(max(1, n) / per_task)) if n > per_task else 4))
    rows = meas.join(sources, meas["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    rows = rows.withColumn("b", F.shiftrightunsigned("sk", 64 - bits))
    sums = rows.groupBy("src", "b").agg(F.sum("size").alias("s"))
    starts = sums.select("src", "b", (F.sum("s").over(Window.partitionBy("src").orderBy("b")) - F.col("s")).alias("start"))
    own = Window.partitionBy("src", "b").orderBy("sk", "doc_id", "h", "size", "tie")
    rows = rows.withColumn("r", F.row_number().over(own)).withColumn("upto", F.sum("size").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.join(starts, ["src", "b"]).withColumn("at", F.col("start") + F.col("upto") - F.col("size"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: int = 3, block: int = 1024, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(placements, documents).

    placements: slot, src, rank, doc_id, b, r, first and last: words first..last-1 of the document stand in that slot.
    documents: doc_id, source, h (hash of the text), size, source_size, target, src, b, r.
    """
    meas = measured(docs, seed)
    sources = materialize(source_targets(meas, weights, most), "mix-sources")
    rows = materialize(streams(meas, sources), "mix-streams")
    slots = schedule(sources, block)
    taken = F.floor(F.col("target") + 0.5)
    turns = rows.where("size > 0").withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
    turns = turns.withColumn("a", F.col("at") + F.col("turn") * F.col("source_size")).withColumn("z", F.least(F.col("a") + F.col("size"), taken)).where("z > a")
    parts = turns.withColumn("rank", F.explode(F.sequence(F.expr(f"a div {block}"), F.expr(f"(z - 1) div {block}"))))
    parts = parts.select("src", "rank", "doc_id", "b", "r", (F.greatest(F.col("a"), F.col("rank") * block) - F.col("a")).alias("first"), (F.least(F.col("z"), (F.col("rank") + 1) * block) - F.col("a")).alias("last"))
    return parts.join(slots, ["src", "rank"]), rows.select("doc_id", "source", "h", "size", "source_size", "target", "src", "b", "r")


def _counted(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: int = 3, block: int = 1024, seed: int = 0) -> DataFrame:
    placements, rows = mix(docs, weights, most, block, seed)
    key = ["src", "b", "r"]
    counts = placements.groupBy(*key).agg(F.sum(F.col("last") - F.col("first")).alias("taken"))
    return rows.join(counts, key, "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))


def mix_counts(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: int = 3, block: int = 1024, seed: int = 0) -> DataFrame:
    """One row per row of docs: doc_id, size, source_size, target, taken."""
    return _counted(docs, weights, most, block, seed).select("doc_id", "size", "source_size", "target", "taken")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: each document as often as the mix takes it, whole: taken / size times, rounded up. Rows that share doc_id,
    source and text are taken alike, as often as on average."""
    counts = _counted(docs).groupBy("doc_id", "source", "h").agg(F.sum("taken").alias("taken"), F.sum("size").alias("size")).where("taken > 0")
    counts = counts.select(F.col("doc_id").alias("_cd"), F.col("source").alias("_cs"), F.col("h").alias("_ch"), F.ceil(F.col("taken") / F.col("size")).cast("int").alias("_times"))
    held = docs.select(F.struct("*").alias("_row"), F.col("doc_id").cast("long").alias("_d"), F.col("source").cast("string").alias("_s"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("_h"))
    met = held.join(counts, held["_d"].eqNullSafe(counts["_cd"]) & held["_s"].eqNullSafe(counts["_cs"]) & (held["_h"] == counts["_ch"]))
    return met.select("_row", F.explode(F.sequence(F.lit(1), F.col("_times")))).select("_row.*")
