import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from lapsewise.operators import selection, weighting


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    a = rng.normal(1e6, 1, size=400)
    data = [
        (f"u{i}", int(i % 4 == 0), float(a[i]), float(2 * a[i] + rng.normal() * 0.05), float(-a[i]), 7.0,
         float(rng.integers(0, 5)))
        for i in range(400)
    ]
    return spark.createDataFrame(data, "userId string, churn int, a double, b double, c double, flat double, n double").cache()


COLUMNS = ["a", "b", "c", "flat", "n"]


def test_correlation_matches_numpy_despite_large_means(table):
    pairs = {(a, b): r for a, b, r in selection.correlation_pairs(table, COLUMNS)}
    frame = table.toPandas()
    assert len(pairs) == 10
    for (a, b), r in pairs.items():
        if "flat" in (a, b):
            assert r is None
        else:
            assert r == pytest.approx(np.corrcoef(frame[a], frame[b])[0, 1], abs=1e-9)


def test_only_positively_redundant_earlier_columns_go(table):
    # a and b are one signal, c is its mirror image: only the earlier of the positive pair goes.
    assert selection.correlated_features(table, COLUMNS) == ["a"]
    assert selection.correlated_features(table, ["b", "a", "c"]) == ["b"]
    assert selection.features_to_keep(table, COLUMNS) == ["b", "c", "flat", "n"]
    labelled = table.withColumn("twin", F.col("churn") * 3.0)
    assert selection.correlated_features(labelled, ["twin"], include_label=True) == ["churn"]
    assert rows(selection.feature_correlation(table, ["a", "flat"])) == [("a", "flat", None)]


def test_chi2_by_hand(spark):
    data = [("a", 0, 1.0, 0.0), ("b", 0, 3.0, 0.0), ("c", 1, 8.0, 0.0), ("d", 1, -1.0, 0.0)]
    table = spark.createDataFrame(data, "userId string, churn int, x double, zero double")
    # Row d is left out; x: total 12, expected 8 and 4, observed 4 and 8.
    scores = selection.chi2_scores(table, ["zero", "x"]).collect()
    assert [r.feature for r in scores] == ["x", "zero"]
    assert scores[0].score == pytest.approx(16 / 8 + 16 / 4) and scores[1].score is None
    assert selection.best_features(table, ["zero", "x"], 1) == ["x"]


def test_min_max(table):
    scaled = selection.min_max_scaled(table, COLUMNS)
    low, high = scaled.agg(F.min("a"), F.max("a")).first()
    assert (low, high) == (0.0, 1.0)
    assert rows(scaled.select("flat").distinct()) == [(0.5,)]


def test_class_weights_sum_to_rows(table):
    assert rows(weighting.class_weights(table)) == [(0, 300, 400 / 2 / 300), (1, 100, 2.0)]
    assert weighting.with_class_weight(table).agg(F.sum("weight")).first()[0] == pytest.approx(400)


def test_split_is_a_partition_and_ignores_partitioning(table):
    train, test = weighting.train_test_split(table)
    assert rows(train.select("userId").intersect(test.select("userId"))) == []
    assert train.count() + test.count() == 400 and 240 < train.count() < 320
    moved, _ = weighting.train_test_split(table.repartition(13).orderBy(F.desc("userId")))
    assert rows(moved, "userId") == rows(train, "userId")
    other, _ = weighting.train_test_split(table, seed=7)
    assert rows(other, "userId") != rows(train, "userId")
    folds = weighting.with_fold(table, 5).groupBy("fold").count().collect()
    assert {r.fold for r in folds} == set(range(5)) and min(r["count"] for r in folds) > 40
    assert sum(part.count() for part in weighting.random_split(table, [0.7, 0.3], 42)) == 400


def test_confusion_metrics_match_mllib(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator

    rng = np.random.default_rng(5)
    data = [(int(y), float(p)) for y, p in zip(rng.integers(0, 2, 300), rng.random(300) < 0.4)]
    predictions = spark.createDataFrame(data, "churn int, prediction double")
    mine = weighting.confusion_metrics(predictions).first()
    names = {"accuracy": "accuracy", "f1_score": "f1", "precision": "weightedPrecision", "recall": "weightedRecall"}
    for name, metric in names.items():
        other = MulticlassClassificationEvaluator(labelCol="churn", metricName=metric).evaluate(predictions)
        assert mine[name] == pytest.approx(other)
    hard = BinaryClassificationEvaluator(labelCol="churn", rawPredictionCol="prediction").evaluate(predictions)
    assert mine.auc_hard == pytest.approx(hard)


def test_majority_model_has_hard_auc_of_half(spark):
    predictions = spark.createDataFrame([(0, 0.0)] * 87 + [(1, 0.0)] * 26, "churn int, prediction double")
    m = weighting.confusion_metrics(predictions).first()
    assert m.auc_hard == 0.5 and m.accuracy == pytest.approx(0.7699, abs=1e-4)
    assert m.precision == pytest.approx(m.accuracy**2)
