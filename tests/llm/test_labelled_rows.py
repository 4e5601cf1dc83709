"""Operators 5 and 10 use every labelled row, and their thresholds are exact."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from invdex.llm import quality, toxicity
from invdex.llm.labelled import labelled


def test_no_labelled_row_is_left_out(spark):
    labels = spark.range(230_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    rows = labelled(labels, "quality")
    assert rows.filter("y = 1").count() == 115_000 and rows.filter("y = 0").count() == 115_000
    twice = spark.createDataFrame([(1, 0), (1, 1), (None, 1), (2, None), (3, 0)], "doc_id bigint, quality int")
    assert sorted((r.doc_id, r.y) for r in labelled(twice, "quality").collect()) == [(1, 1), (3, 0)]


@pytest.mark.parametrize("n", [1, 7, 1000, 1001, 2500])
def test_quantile_is_exact(spark, n):
    values = [random.Random(n + k).random() for k in range(n)]
    df = spark.createDataFrame([(v,) for v in values], "score double")
    assert quality.quantile(df, "score", 0.001) == sorted(values)[math.ceil(0.001 * n) - 1]
    assert quality.quantile(df.limit(0), "score", 0.001) is None


@pytest.mark.parametrize("seed", range(4))
def test_threshold_by_ranges_equals_the_sorted_one(spark, seed):
    rnd = random.Random(seed)
    rows = [(round(rnd.gauss(0.4 * y, 0.5), 1 + seed % 2), y) for y in (rnd.random() < 0.3 for _ in range(200))]
    rows = [(x, int(y)) for x, y in rows]
    df = spark.createDataFrame(rows, "x double, y int")
    want = toxicity.best_threshold(np.array([x for x, _ in rows]), np.array([y for _, y in rows]))
    assert toxicity.fitted_threshold(df) == pytest.approx(want, rel=1e-12)
    assert toxicity.fitted_threshold(df.filter("x <= 0")) == 1.0
    assert toxicity.fitted_threshold(df.limit(0)) == 1.0


def test_labels_beyond_broadcast_give_the_same_rows(spark, monkeypatch):
    rows = [(i, " ".join(f"w{(i * k) % 17}" for k in range(1, 14)) + (" zorg" if i % 4 == 0 else "")) for i in range(60)] + [(None, "a b c"), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0), int(i % 4 == 0)) for i in range(60)], "doc_id bigint, quality int, toxic int")

    def both():
        q = quality.assess(docs, labels).select("doc_id", "n_words", "kept", F.round("score", 9))
        return sorted(map(str, q.collect())), sorted(map(str, toxicity.score(docs, *toxicity.fit(docs, labels)).select(
            "doc_id", "predicted", F.round("score", 9)).collect()))

    want = both()
    monkeypatch.setattr(quality, "broadcast_if_small", lambda df: df)
    monkeypatch.setattr(toxicity, "is_small", lambda df: False)
    assert both() == want
