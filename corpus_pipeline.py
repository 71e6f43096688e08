"""The corpus pipeline: toxicity, exact dedup, near-dedup, mixing, BPE.

Each stage works on the rows that the one before it kept, written as Parquet and read again, and all but the last return the
columns of documents as they were:

* toxicity: a model of the labels outside the held-out third scores every whole text; rows from 0.7 on go, each by its own text.
* exact_dedup: of equal texts (null counts as empty) the row with the largest doc_id stays.
* near_dedup: five-word shingles, links from a Jaccard similarity of 80 % on (op7_near_dedup asks for 85 %); of each group of linked
  documents one with the smallest doc_id stays. Rows with a null doc_id take no part and stay.
* source_mixing: documents are repeated, or left out, as the mix takes them, whole.
* byte_bpe: doc_id with the ids of the text.

Defined cases: null and empty texts pass toxicity as they score lowest, are one text to exact_dedup, groups of their own to
near_dedup, and have no words for the mix, which never takes them; rows repeated with the same doc_id and text are reduced to one by
exact_dedup; extra columns are kept up to source_mixing, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plyframe.llm import bpe, exact, mixing, neardup, toxicity

STAGES = [
    ("toxicity", toxicity.stage),
    ("exact_dedup", exact.stage),
    ("near_dedup", neardup.stage),
    ("source_mixing", mixing.stage),
    ("byte_bpe", bpe.stage),
]

#: SQL can't express the model, the sketches or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read by the next."""
    from plyframe.llm.common import materialize

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline-{name}")
    return docs
