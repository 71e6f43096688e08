"""As-of join of versioned state: what a key held just before each reading.

Updates and readings are laid in one order and cut into stretches of about equally many rows, whatever their keys; within a stretch a
key's rows are merged in order, and the last version before a stretch is carried into it. So a key with most of the rows is spread over
as many tasks as stretches, and the only step by key alone sees one row a stretch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .stored import stored


def as_of(readings: DataFrame, updates: DataFrame, key: str, order: list[str], value: str, stretches: int | None = None) -> DataFrame:
    """readings with `value`: that of the last update of the same key that comes before in `order`, null if there is none.

    order: columns of both sides that tell all rows apart as far as it matters; an update with the same order as a reading comes
    after it. A version whose value is null is a version: it isn't passed over. Keys that are null match nothing.
    """
    spark = readings.sparkSession
    names = readings.columns
    kept = readings.select(F.struct(*names).alias("_row"), F.col(key).alias("_key"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], F.lit(0).alias("_kind"), F.lit(None).cast(dict(updates.dtypes)[value]).alias("_value"))
    made = updates.where(F.col(key).isNotNull()).select(F.lit(None).cast(kept.schema["_row"].dataType).alias("_row"), F.col(key).alias("_key"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], F.lit(1).alias("_kind"), F.col(value).alias("_value"))
    at = [f"_o{i}" for i in range(len(order))]
    rows = kept.unionByName(made)
    n = stretches or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = stored(rows.repartitionByRange(n, *at).withColumn("_s", F.spark_partition_id()), "as-of")
    version = F.when(F.col("_kind") == 1, F.struct(F.col("_value").alias("v")))
    merged = Window.partitionBy("_key", "_s").orderBy(*at, "_kind").rowsBetween(Window.unboundedPreceding, 0)
    inside = rows.withColumn("_last", F.last(version, ignorenulls=True).over(merged)).where("_kind = 0")
    ends = rows.where("_kind = 1").groupBy("_key", "_s").agg(F.max_by(F.struct(F.col("_value").alias("v")), F.struct(*at)).alias("_end"))
    # a key's stretches: where it has updates or readings, a row each
    there = rows.groupBy("_key", "_s").agg(F.lit(1).alias("_one")).join(ends, ["_key", "_s"], "left")
    carried = there.select("_key", "_s", F.last("_end", ignorenulls=True).over(Window.partitionBy("_key").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)).alias("_carried"))
    met = inside.join(carried, ["_key", "_s"], "left")
    return met.select(*[F.col("_row")[c].alias(c) for c in names], F.coalesce("_last", "_carried")["v"].alias(value))
