"""The toxicity stage rejects rows by their own text; its model is trained in a task."""

import os

from test_llm import toxic_rows


def test_rows_that_share_an_id_have_verdicts_of_their_own(spark, tmp_path):
    from plyframe.llm.toxicity import stage

    rows = toxic_rows()
    bad, good = "vilify vilifyer vilifying " * 10, rows[1][1]
    table = [(i, t) for i, t, _ in rows] + [(None, bad), (None, good), (None, None), (5000, bad), (5000, good)]
    docs = spark.createDataFrame(table, "doc_id long, text string")
    spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    out = stage(spark, docs, str(tmp_path))
    assert out.columns == docs.columns
    got = {(r["doc_id"], r["text"]) for r in out.collect()}
    assert {(None, good), (None, None), (5000, good)} <= got and not {(None, bad), (5000, bad)} & got


def test_the_driver_gets_the_model_alone(spark, monkeypatch):
    """Training on the driver fails; the scores are those of train() on sample()."""
    from pyspark.sql import functions as F

    from plyframe.llm import toxicity as T

    rows = toxic_rows()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    train, driver = T.train, os.getpid()
    expected = {r["doc_id"]: r["score"] for r in T.score(docs, train(*T.sample(docs, labels, F.lit(True)))).collect()}

    def elsewhere(*a):
        if os.getpid() == driver:
            raise AssertionError("trained on the driver")
        return train(*a)

    monkeypatch.setattr(T, "train", elsewhere)
    got = {r["doc_id"]: r["score"] for r in T.toxicity(docs, labels, F.lit(True)).collect()}
    assert got.keys() == expected.keys() and all(abs(got[i] - expected[i]) < 1e-6 for i in got)
