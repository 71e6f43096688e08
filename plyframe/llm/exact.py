"""Exact deduplication by a persistent digest index.

The index is a table bucketed and sorted by digest. New data is reduced to one row a digest, the digests that the index
has are removed by a sort-merge anti-join that needs no shuffle of the index, and the rest is appended. Each row names its
batch: verdicts leave a batch's own rows out of account and what is there isn't appended again, so a batch may be run twice.

Defined cases: null text counts as empty; empty texts are equal to one another; of equal texts of one batch the row with
the largest doc_id stays (null doc_id is smaller than any); rows repeated with the same doc_id and text are one document
and share the verdict; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import attach_groups, discard, materialize, one_each, only, text_column


class DigestIndex:
    """digest (32 bytes), keep_id, batch; one table in the warehouse. buckets: of a new table; one that exists keeps its own."""

    def __init__(self, spark: SparkSession, table: str, buckets: int | None = None):
        self.spark, self.table = spark, table
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def create(self) -> None:
        """An empty index, unless there is one. A compaction that was broken off is undone."""
        if not self._exists(self.table) and self._exists(f"{self.table}_old"):
            self.spark.sql(f"ALTER TABLE {self.table}_old RENAME TO {self.table}")
        if self._exists(self.table):
            told = {r["col_name"]: r["data_type"] for r in self.spark.sql(f"DESCRIBE EXTENDED {self.table}").collect()}
            self.buckets = int(told["Num Buckets"])
        else:
            self._write(self.spark.createDataFrame([], "digest binary, keep_id long, batch long"), self.table, "error")

    def _exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(table)

    def _write(self, df: DataFrame, table: str, mode: str) -> None:
        df.write.mode(mode).format("parquet").bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(table)

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def before(self, batch: int) -> DataFrame:
        """The index without that batch's rows. Batches after it have none of its digests."""
        return self.read().where(F.col("batch") != batch)

    def unseen(self, groups: DataFrame, batch: int = -1) -> DataFrame:
        """The groups whose digest no other batch has: a sort-merge anti-join that leaves the index where it is."""
        return groups.join(self.before(batch).select("digest").hint("merge"), "digest", "left_anti")

    def append(self, groups: DataFrame, batch: int = 0) -> None:
        """Add digest and keep_id of groups that unseen() returned and that aren't there yet, as one sorted file a bucket."""
        rows = groups.select("digest", "keep_id", F.lit(batch).cast("long").alias("batch"))
        if not self.read().where(F.col("batch") == batch).isEmpty():  # the batch has been run before
            rows = materialize(rows.join(self.read().select("digest").hint("merge"), "digest", "left_anti"), "digest-rest")
        self._write(rows.repartition(self.buckets, "digest"), self.table, "append")

    def compact(self) -> None:
        """Rewrite the index with one sorted file a bucket, after many appends. The old table goes once the new one is whole and in its place."""
        self.create()
        new, old = f"{self.table}_new", f"{self.table}_old"
        for left in (new, old):
            self.spark.sql(f"DROP TABLE IF EXISTS {left}")
        self._write(self.read().repartition(self.buckets, "digest"), new, "error")
        self.spark.sql(f"ALTER TABLE {self.table} RENAME TO {old}")
        self.spark.sql(f"ALTER TABLE {new} RENAME TO {self.table}")
        self.spark.sql(f"DROP TABLE {old}")

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id and the text's SHA-256 (binary), kept in the shared folder: texts are read once."""
    rows = only(docs, doc_id="long", text="string")
    return materialize(rows.select("doc_id", F.unhex(F.sha2(text_column().cast("binary"), 256)).alias("digest")), "digests")


def exact_dedup(docs: DataFrame, index: DigestIndex, batch: int = 0) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256, known.

    known: another batch of the index, which was run earlier, has the text; then keep_id is the earlier document and nothing is kept.
    """
    rows = digests(docs)
    groups = materialize(rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "digest-groups")
    index.create()
    fresh = materialize(index.unseen(groups, batch), "digest-fresh")
    earlier = index.before(batch).select("digest", F.col("keep_id").alias("_old"))
    seen = groups.join(earlier.hint("merge"), "digest").select("digest", F.col("_old").alias("keep_id"), "group_size", F.lit(True).alias("known"))
    verdicts = materialize(fresh.withColumn("known", F.lit(False)).unionByName(seen), "digest-verdicts")
    index.append(fresh, batch)
    discard(groups, fresh)
    found = attach_groups(rows, verdicts, "digest", "group_size", F.unhex(F.sha2(F.col("doc_id").cast("string"), 256)))
    return found.select(
        "doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & ~F.col("known")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "known",
    )


def dedup_once(docs: DataFrame) -> DataFrame:
    """exact_dedup against an index of its own, which goes once the verdicts are written."""
    index = DigestIndex(docs.sparkSession, f"digest_index_{uuid.uuid4().hex}")
    found = exact_dedup(docs, index)
    index.drop()
    return found


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that stay, one row of each text; of rows that share doc_id and text one stays."""
    held = docs.select(F.struct("*").alias("_row"), F.col("doc_id").cast("long").alias("_id"), F.sha2(text_column().cast("binary"), 256).alias("_sha"))
    found = dedup_once(docs).where("kept")
    keep = found.select(F.col("doc_id").alias("_keep"), F.col("text_sha256").alias("_text")).distinct()
    stay = held.join(keep, held["_id"].eqNullSafe(keep["_keep"]) & (held["_sha"] == keep["_text"]), "left_semi").select("_row.*")
    often = found.groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if often.isEmpty():
        return stay
    return one_each(stay, stay.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_column()).alias("h")))
