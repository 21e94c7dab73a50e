"""The threshold of the quality rules covers all labelled rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from crowdtape.llm import anomaly


@pytest.mark.parametrize("good, bad", [(2100, 40), (3, 2), (5, 0)])
def test_threshold_is_that_of_the_sorted_scores(spark, good, bad):
    rng = np.random.default_rng(good)
    clean = np.concatenate([rng.uniform(0.3, 0.5, good - 2), [0.45, 0.45]])
    junk = rng.uniform(0.4, 0.7, bad)
    rows = [(True, float(x)) for x in clean] + [(False, float(x)) for x in junk]
    found = anomaly.calibrate(spark.createDataFrame(rows, "good boolean, anomaly double"))
    least = np.sort(clean)[-1 - int(anomaly.MAX_FALSE_REJECTS * good)]
    above = junk[junk > least]
    assert found == (pytest.approx((least + above.min()) / 2) if bad else anomaly.DEFAULT_THRESHOLD)


def test_false_rejects_are_bounded_over_all_labels(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(anomaly, "LABELLED_ROWS", 12)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    judged = anomaly.judge(docs, labels, ["doc_id"]).where("NOT base_failed")
    rows = judged.join(labels.where("quality > 0"), F.col("row.doc_id") == labels.doc_id).select("kept").collect()
    assert len(rows) > 12 and all(r.kept for r in rows)  # 0.2 % of so few rows is none
