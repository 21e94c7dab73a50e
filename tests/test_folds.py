"""What the folds and the scores are read from."""

import sys
from pathlib import Path

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors

from crowdtape import plans

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as registry  # noqa: E402


def test_folds_do_not_keep_the_partitions_of_a_shuffle(spark):
    seen = []

    class Seen(LogisticRegression):
        def _fit(self, dataset):
            seen.append(dataset.rdd.getNumPartitions())
            return super()._fit(dataset)

    days = [(n, float(n % 2), Vectors.dense([float(n % 2), 1.0])) for n in range(40)]
    data = spark.createDataFrame(days, ["date", "label", "features"]).repartition(64)
    model = plans.cross_validate(data, Seen(maxIter=1), k=2)
    assert len(model.avgMetrics) == 1 and len(seen) == 3
    assert max(seen) < 64


def test_scores_are_kept_for_several_batches(spark, tmp_path):
    path = str(tmp_path)
    texts = [(0, "the the"), (1, "of")]
    spark.createDataFrame(texts, "doc_id bigint, text string").write.parquet(f"{path}/documents.parquet")
    kept = []
    scorer = registry._scorer(spark, path, lambda scores: kept.append(scores.localCheckpoint()) or kept[-1])
    for _ in range(2):
        posts = spark.createDataFrame([("4",), ("7",)], "id string")
        assert scorer(posts).count() == 2
    assert len(kept) == 1
