"""Tables written to the folder that driver and executors share: they cut lineage and survive lost executors."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir; where that is unset, below a temporary folder if all runs on this machine."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        where = os.path.join(tempfile.gettempdir(), "plyframe-core")
    return f"{where.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """df, written once and read from there."""
    path = path or shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcastable(df: DataFrame, rows: int, most: int = 2_000_000) -> DataFrame:
    """df, broadcast if its counted rows are few, else left to the planner."""
    from pyspark.sql import functions as F

    return F.broadcast(df) if rows <= most else df
