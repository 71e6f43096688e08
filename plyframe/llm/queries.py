"""The queries of the corpus operators, as the driver registers them, with SQL where SQL can express the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import fold, toxicity

    found = toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), fold() != 1)
    return found.select("doc_id", (fold() == 1).alias("held_out"), "score", "predicted")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact import dedup_once

    return dedup_once(_table(spark, sf_dir, "documents")).drop("known")


OP2_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .bpe import encode

    return encode(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=False)


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix_counts

    return mix_counts(_table(spark, sf_dir, "documents"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import license_scan

    return license_scan(_table(spark, sf_dir, "documents"))


def op5_brown_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .brown import brown_scores
    from .toxicity import fold

    found = brown_scores(_table(spark, sf_dir, "documents"), fold(of=10) != 0)
    return found.select("doc_id", (fold(of=10) == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op6_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix import repeat_removal

    return repeat_removal(_table(spark, sf_dir, "documents"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .neardup import near_groups

    return near_groups(_table(spark, sf_dir, "documents"), percent=85)


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .topk import top_k

    return top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


OP8_SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum([q.e[i] * c.e[i] FOR i IN range(1, len(q.e) + 1)]) AS BIGINT) AS score
  FROM v AS q JOIN v AS c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS "rank", vec_id, score FROM s
)
SELECT query_id, "rank", vec_id, score FROM r WHERE "rank" <= 10
"""


def op10_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import shard

    return shard(_table(spark, sf_dir, "documents"))


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import find

    return find(_table(spark, sf_dir, "documents"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .resampling import resample

    return resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .whitening import whiten

    return whiten(_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_source_mixing": op3_source_mixing,
    "op4_license_scan": op4_license_scan,
    "op5_brown_scores": op5_brown_scores,
    "op6_repeat_removal": op6_repeat_removal,
    "op7_near_dedup": op7_near_dedup,
    "op8_exact_top_k": op8_exact_top_k,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_kd_sharding": op10_kd_sharding,
    "op11_pii": op11_pii,
    "op12_resampling": op12_resampling,
    "op13_whitening": op13_whitening,
}
ORACLE_SQL = {"op2_exact_dedup": OP2_SQL, "op8_exact_top_k": OP8_SQL}
