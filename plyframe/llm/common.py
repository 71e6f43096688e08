"""What the corpus operators share: intermediate tables, group attachment and running offsets."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where that is unset, a temporary one if all run on this machine."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        where = os.path.join(tempfile.gettempdir(), "plyframe-shared")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it again: cuts lineage, survives lost executors, is computed once."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._written = path
    return back


def discard(*written: DataFrame) -> None:
    """Delete tables of materialize() that nothing reads any more."""
    for df in written:
        if path := getattr(df, "_written", None):
            spark = df.sparkSession
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


#: Bytes of an Arrow batch, so that what a worker holds doesn't depend on how long texts are.
BATCH_BYTES = "4m"


def in_batches(rows: DataFrame, work, schema: str | T.StructType) -> DataFrame:
    """rows.mapInArrow in batches of bounded bytes, unless the application was started with a bound of its own."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not rows.sparkSession.sparkContext.getConf().contains(setting):
        rows.sparkSession.conf.set(setting, BATCH_BYTES)
    return rows.mapInArrow(work, schema)


def text_column(name: str = "text") -> Column:
    """The text, null counting as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def only(df: DataFrame, **kinds: str) -> DataFrame:
    """The named columns alone, cast; whatever else the table holds can't clash with working columns."""
    return df.select([df[c].cast(k).alias(c) if k else df[c] for c, k in kinds.items()])


def small(spark: SparkSession, rows: list[tuple], columns: dict[str, str]) -> DataFrame:
    """A few rows of whole numbers, strings and nulls as an inline table, which no Python worker has to make."""

    def text(x: object) -> str:
        return "NULL" if x is None else "'" + x.replace("'", "''") + "'" if isinstance(x, str) else str(x)

    kinds = ", ".join(f"CAST({c} AS {k}) AS {c}" for c, k in columns.items())
    held = ", ".join("(" + ", ".join(map(text, r)) + ")" for r in rows)
    if not rows:
        return spark.sql(f"SELECT {', '.join(f'CAST(NULL AS {k}) AS {c}' for c, k in columns.items())} WHERE false")
    return spark.sql(f"SELECT {kinds} FROM VALUES {held} AS t({', '.join(columns)})")


def attach_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, spread: Column) -> DataFrame:
    """rows joined to their group by key, however large one group is.

    groups has one row a key with its number of rows in `size`. A group that holds over one thousandth of all rows is
    hot; there are fewer than 1000 such groups whatever the input, so they are broadcast. Their rows take
    `spread`, a hash of the row cast to the key's type, as the key of the shuffled join and so don't meet in one task.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    hot = groups.where(F.col(size) > max(1000, total / 1000))
    values = [c for c in groups.columns if c != key]
    hot = F.broadcast(hot.select(F.col(key).alias("_hk"), *[F.col(c).alias(f"_h_{c}") for c in values]))
    cold = groups.where(F.col(size) <= max(1000, total / 1000)).select(F.col(key).alias("_ck"), *[F.col(c).alias(f"_c_{c}") for c in values])
    found = rows.join(hot, F.col(key) == F.col("_hk"), "left").withColumn("_jk", F.when(F.col("_hk").isNull(), F.col(key)).otherwise(spread))
    found = found.join(cold, F.col("_jk") == F.col("_ck"), "left")
    return found.select(*[F.col(c) for c in rows.columns], *[F.coalesce(f"_h_{c}", f"_c_{c}").alias(c) for c in values])


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs but the rows with a doc_id and text hash (h) of `gone`."""
    return _by_row(docs, gone, "left_anti").select("_row.*")


def one_each(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """docs with one of each lot of rows that share doc_id and text. rows: doc_id, h of all of them that may."""
    often = materialize(rows.groupBy("doc_id", "h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id", "h"), "repeated-rows")
    if often.isEmpty():
        return docs
    once = _by_row(docs, often, "left_semi").dropDuplicates(["_doc_id", "_h"]).select("_row.*")
    return without(docs, often).unionByName(once)


def _by_row(docs: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """_row (all columns, whose names can't clash), _doc_id and _h of docs, joined to rows (doc_id, h)."""
    held = docs.select(F.struct("*").alias("_row"), F.col("doc_id").cast("long").alias("_doc_id"), F.xxhash64(text_column()).alias("_h"))
    rows = rows.select("doc_id", "h")
    return held.join(rows, held["_doc_id"].eqNullSafe(rows["doc_id"]) & (held["_h"] == rows["h"]), how)


def schema(text: str) -> T.StructType:
    return T._parse_datatype_string(text)
