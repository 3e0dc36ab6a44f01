import pytest
from conftest import rows

from lapsewise.operators.cleaning import clean
from lapsewise.plans import churn_job, features, modelling
from lapsewise.plans.modelling import Training
from lapsewise.schema import FEATURES
from lapsewise.sources import activity_log, write_json_table
from lapsewise.storage import new_path, write_and_reload

KEPT = ["count_logs", "avg_session_length", "page_home_hourly", "page_add_to_playlist_hourly", "level", "gender"]
SMALL = {
    "RandomForestClassifier": {"numTrees": 3, "maxDepth": 3},
    "LogisticRegression": {"maxIter": 5},
    "GBTClassifier": {"maxIter": 2, "maxDepth": 3},
    "LinearSVC": {"maxIter": 3},
}


@pytest.fixture(scope="module")
def table(spark):
    log = clean(activity_log(spark, "/root/testdata/sf0.01", profile=False))
    return write_and_reload(features.feature_table(log), "features-test")


def test_grids_and_texts():
    rf = modelling.classifier("RandomForestClassifier")
    assert len(modelling.tuning_grid(rf)) == 9
    assert modelling.grid_as_text(modelling.tuning_grid(rf)) == ["maxDepth: 5, 10, 15", "numTrees: 20, 50, 100"]
    assert len(modelling.tuning_grid(modelling.classifier("LogisticRegression"))) == 9
    assert len(modelling.tuning_grid(modelling.classifier("LinearSVC"))) == 4
    assert len(modelling.tuning_grid(modelling.classifier("GBTClassifier"))) == 1
    assert modelling.grid_as_text(modelling.default_grid()) == []
    assert list(modelling.swept_feature_counts(FEATURES[:29])) == [4, 8, 12, 16, 20, 24, 28]


def test_every_classifier_trains_and_scores(table):
    done = modelling.train_and_evaluate(table, KEPT, 4, Training(cross_validate=False, params=SMALL))
    assert [r["model"] for r in done.metrics] == modelling.SWEPT
    for row, model in zip(done.metrics, done.models):
        assert 0 <= row["f1_score"] <= 1 and 0 <= row["auc"] <= 1 and row["num_best_features"] == 4
        predicted = modelling.predictions(model, done.test_df)
        assert {r.prediction for r in predicted.select("prediction").distinct().collect()} <= {0.0, 1.0}
        importance = modelling.feature_importance(model)
        assert sorted(r.feature for r in importance.collect()) == sorted(model.features)


def test_cross_validation_is_repeatable(table):
    training = Training(kinds=["DecisionTreeClassifier"], folds=3)
    first = modelling.train_and_evaluate(table, KEPT, 4, training)
    again = modelling.train_and_evaluate(table.repartition(5), KEPT, 4, training)
    for name in ("f1_score", "f1_score_train", "accuracy", "auc", "auc_hard"):
        assert first.metrics[0][name] == pytest.approx(again.metrics[0][name]), name
    assert first.metrics[0]["cross_validation"] and first.metrics[0]["num_params"] == 1


def test_cross_validation_equals_spark_cross_validator(table):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator

    from lapsewise.operators.weighting import with_fold

    training = Training(folds=2, params={"LogisticRegression": {"maxIter": 3}})
    frame = modelling.model_frame(table, KEPT, True)
    est = training.estimator("LogisticRegression")
    grid = modelling.ParamGridBuilder().addGrid(est.regParam, [0.0, 0.5]).build()
    pipe = modelling.pipeline(est, KEPT)
    model, averages = modelling.cross_validate(pipe, grid, frame, training)
    evaluator = MulticlassClassificationEvaluator(labelCol="churn", metricName="f1")
    spark_cv = CrossValidator(
        estimator=pipe, estimatorParamMaps=grid, evaluator=evaluator, numFolds=2, foldCol="fold"
    ).fit(with_fold(frame, 2))
    assert averages == pytest.approx(spark_cv.avgMetrics)
    assert list(model.stages[-1].coefficients) == pytest.approx(list(spark_cv.bestModel.stages[-1].coefficients))


def test_tuning_reports_best_setting(table):
    training = Training(kinds=["LinearSVC"], tune=True, folds=2, params={"LinearSVC": {"maxIter": 2}})
    done = modelling.train_and_evaluate(table, KEPT, 4, training)
    trained, row = done.models[0], done.metrics[0]
    assert row["num_params"] == 4 == len(trained.avg_metrics)
    assert row["best_params"] == modelling.setting_as_text(trained.best_setting())
    assert row["param_grid"] == ["regParam: 0.0, 0.05, 0.1, 0.2"]


def test_selection_on_training_part_only(table):
    done = modelling.train_and_evaluate(
        table, KEPT, 3, Training(kinds=["DecisionTreeClassifier"], cross_validate=False), fit_selection_on_train=True
    )
    assert len(done.models[0].features) == 3


def test_batch_job(spark):
    out = new_path(spark, "job")
    write_json_table(activity_log(spark, "/root/testdata/sf0.01"), f"{out}/log")
    training = Training(kinds=["DecisionTreeClassifier", "LogisticRegression"], folds=2, params=SMALL)
    churn_job.run(spark, f"{out}/log", f"{out}/run", training=training, ks=[4], importance_k=4,
                  importance_of="DecisionTreeClassifier")
    assert spark.read.parquet(f"{out}/run/features").count() == 150
    metrics = spark.read.parquet(f"{out}/run/metrics")
    assert rows(metrics, "model") == [("DecisionTreeClassifier",), ("LogisticRegression",)]
    importance = spark.read.parquet(f"{out}/run/importance")
    assert importance.count() == 4
    assert importance.agg({"cumulative_coefficient": "max"}).first()[0] == pytest.approx(1.0)
