"""Sharding by a k-d tree over document metadata, in DataFrame operations only.

A node of the tree stands for a range of shards. It is split along its widest dimension (extent within the node over the
extent in all documents) at the weighted median, that is where the bytes to the left are in proportion to the left
shards, until a leaf is one shard and so holds the target bytes. Dimensions: log of the size, share of bytes in other
than ASCII characters. A document's coordinate along a dimension is continued by the text's CRC-32, so a cut falls
between texts, never within equal ones. Medians are exact: three histograms of 16 bits each narrow the 48-bit key; a
histogram has at most 65,536 bins a node, whatever the number of documents.

Equal texts go to one shard. A text whose copies weigh over 1/HEAVY of a shard would unbalance every cut near it; there
are fewer than HEAVY * shards of them, so these are dealt to shards first, largest first to the lightest shard, and the
tree's shares are what is then left of each shard's target. A text that outweighs a whole shard still stays whole; the
other shards share the rest equally.

Defined cases: null text has no bytes and size 1; empty texts are equal texts; null doc_id is a value like another;
repeated rows get slots of their own; an empty table gives an empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, only, small

DIMENSIONS = ("d0", "d1")
HEAVY = 200
LAW = "bytes"


def metadata(docs: DataFrame) -> DataFrame:
    """doc_id, size, crc, h (hash of the text), d0, d1: all that sharding reads."""
    text = F.col("text")
    raw = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    rows = only(docs, doc_id="long", text="string")
    spare = F.coalesce(F.octet_length(text) - F.char_length(text), F.lit(0))
    return rows.select(
        "doc_id",
        (raw + 1).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("crc"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("h"),
        F.least(F.lit(65535), F.floor(F.log2((raw + 1).cast("double")) * 2048)).cast("long").alias("d0"),
        F.least(F.lit(65535), F.floor(F.when(raw > 0, spare / raw).otherwise(F.lit(0.0)) * 65536)).cast("long").alias("d1"),
    )


def _fill(heavy: list[int], shards: int, total: int) -> tuple[list[int], list[float]]:
    """The shard of each heavy text (given largest first), and the bytes that the tree owes each shard."""
    load = [(0, s) for s in range(shards)]
    given = [0] * shards
    at = []
    for weight in heavy:
        w, s = heapq.heappop(load)
        at.append(s)
        given[s] = w + weight
        heapq.heappush(load, (w + weight, s))
    # the level to which the others are filled
    rest, low, high = total - sum(given), 0.0, float(total)
    for _ in range(100):
        mid = (low + high) / 2
        if sum(max(0.0, mid - g) for g in given) < rest:
            low = mid
        else:
            high = mid
    return at, [max(0.0, high - g) for g in given]


def _cuts(rows: DataFrame, goal: dict[int, float]) -> dict[int, int]:
    """For each node the 48-bit cut: keys below it go left. rows: node, key, size. goal: bytes wanted on the left."""
    spark = rows.sparkSession
    fixed = {n: 0 for n in goal}  # leading bits found so far
    below = {n: 0 for n in goal}  # bytes of keys with smaller leading bits
    for shift in (32, 16, 0):
        state = small(spark, [(n, fixed[n], float(goal[n] - below[n])) for n in goal], {"node": "int", "fixed": "long", "goal": "double"})
        lead = F.shiftright("key", shift)
        near = rows.join(F.broadcast(state), "node").where(F.shiftright(lead, 16) == F.col("fixed"))
        counts = near.groupBy("node", "goal", lead.bitwiseAND(65535).alias("bin")).agg(F.sum("size").alias("w"))
        counts = counts.withColumn("upto", F.sum("w").over(Window.partitionBy("node").orderBy("bin")))
        bins = F.struct("bin", "w", "upto")
        found = counts.groupBy("node").agg(F.min(F.when(F.col("upto") >= F.col("goal"), bins)).alias("cut"), F.max(bins).alias("last")).collect()
        for r in found:  # a row a node
            n, cut = r["node"], r["cut"] or r["last"]
            below[n] += cut["upto"] - cut["w"]
            fixed[n] = fixed[n] << 16 | cut["bin"]
            if shift == 0 and goal[n] - below[n] > cut["w"] / 2:
                fixed[n] += 1  # the median text itself goes left: nearer to the goal
        for n in set(goal) - {r["node"] for r in found}:
            fixed[n] <<= 16
    return fixed


def kd_shards(meta: DataFrame, shards: int) -> DataFrame:
    """meta with the column shard."""
    total = meta.agg(F.sum("size")).first()[0] or 0
    groups = meta.groupBy("crc", "h", "size").agg(F.sum("size").alias("w"))
    heavy = groups.where(F.col("w") > total / (shards * HEAVY)).orderBy(F.desc("w"), "crc", "h", "size").collect()  # fewer than HEAVY * shards rows
    at, owed = _fill([r["w"] for r in heavy], shards, total)
    if heavy:
        placed = small(meta.sparkSession, [(r["crc"], r["h"], r["size"], s) for r, s in zip(heavy, at)], {"crc": "long", "h": "long", "size": "long", "_given": "int"})
        meta = meta.join(F.broadcast(placed), ["crc", "h", "size"], "left")
    else:
        meta = meta.withColumn("_given", F.lit(None).cast("int"))
    spark = meta.sparkSession
    meta = meta.withColumn("node", F.when(F.col("_given").isNull(), F.lit(0)))
    ranges = {0: (0, shards)}  # node -> its shards, from and to
    full: dict[str, int] = {}
    for _ in range((shards - 1).bit_length()):
        extent = [F.struct(F.min(d).alias("a"), F.max(d).alias("b")).alias(d) for d in DIMENSIONS]
        boxes = {r["node"]: r for r in meta.where("node is not null").groupBy("node").agg(F.sum("size").alias("w"), *extent).collect()}  # a row a node
        full = full or {d: max([1, *(r[d]["b"] - r[d]["a"] for r in boxes.values())]) for d in DIMENSIONS}
        widest, goal, split = {}, {}, {}
        for n, (a, b) in ranges.items():
            if b - a > 1:
                mid, box = (a + b) // 2, boxes.get(n)
                left, whole = sum(owed[a:mid]), sum(owed[a:b])
                widest[n] = max(DIMENSIONS, key=lambda d: (box[d]["b"] - box[d]["a"]) / full[d] if box else 0)
                goal[n] = (box["w"] if box else 0) * (left / whole if whole else 0.5)
                split[n] = mid
        plan = small(spark, list(widest.items()), {"node": "int", "along": "string"})
        along = F.coalesce(*[F.when(F.col("along") == d, F.col(d)) for d in DIMENSIONS])
        rows = meta.join(F.broadcast(plan), "node").select("node", "size", (along * F.lit(1 << 32) + F.col("crc")).alias("key"))
        cuts = _cuts(rows, goal)
        step = small(spark, [(n, widest[n], cuts[n]) for n in split], {"node": "int", "along": "string", "cut": "long"})
        right = (along * F.lit(1 << 32) + F.col("crc") >= F.col("cut")).cast("int")
        child = F.when(F.col("cut").isNull(), F.col("node")).otherwise(2 * F.col("node") + 1 + right)
        meta = meta.join(F.broadcast(step), "node", "left").withColumn("node", child).drop("along", "cut")
        halves = {2 * n + k: r for n, mid in split.items() for k, r in ((1, (ranges[n][0], mid)), (2, (mid, ranges[n][1])))}
        ranges = {n: r for n, r in ranges.items() if n not in split} | halves
    leaves = small(spark, [(n, a) for n, (a, _) in ranges.items()], {"node": "int", "leaf": "int"})
    return meta.join(F.broadcast(leaves), "node", "left").withColumn("shard", F.coalesce("_given", "leaf"))


def with_slots(rows: DataFrame, by: str, order: list[str], spread: Column, per_task: int = 50_000) -> DataFrame:
    """rows with slot: gapless from 0 within each value of `by`, by buckets so that no task holds a whole shard."""
    n = rows.count()
    buckets = max(16, n // per_task)
    rows = rows.withColumn("_b", F.pmod(spread, F.lit(buckets)))
    counts = rows.groupBy(by, "_b").agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(by).orderBy("_b"))
    starts = counts.select(by, "_b", (upto - F.col("_n")).alias("_start"))
    own = F.row_number().over(Window.partitionBy(by, "_b").orderBy(*order))
    return rows.withColumn("_r", own).join(starts, [by, "_b"]).withColumn("slot", F.col("_start") + F.col("_r") - 1).drop("_b", "_r", "_start")


def shard(docs: DataFrame, shards: int = 16) -> DataFrame:
    """One row per row of docs: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    meta = materialize(metadata(docs), "shard-meta")
    placed = with_slots(kd_shards(meta, shards), "shard", ["doc_id", "h"], F.xxhash64("doc_id", "h"))
    return placed.select("doc_id", "size", F.col("crc").alias("text_crc32"), F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
