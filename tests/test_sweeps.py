"""A sweep that is stopped goes on where it ended; its rows do not depend on that."""

import time
from threading import Lock

import pytest
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.sql import functions as F

from lapsewise.operators.cleaning import clean
from lapsewise.plans import catalog, features, modelling
from lapsewise.plans.job_table import JobTable
from lapsewise.plans.modelling import Training
from lapsewise.sources import activity_log
from lapsewise.storage import new_path, write_and_reload

KEPT = ["count_logs", "avg_session_length", "page_home_hourly", "level"]
METRICS = ["seed", "num_best_features", "model", "f1_score", "accuracy", "auc", "best_params", "num_params"]


@pytest.fixture(scope="module")
def table(spark):
    log = clean(activity_log(spark, "/root/testdata/sf0.001", profile=False))
    return write_and_reload(features.feature_table(log), "features-test").select("userId", (F.hash("userId") % 2 == 0).cast("int").alias("churn"), *KEPT)


def run(table, jobs, **options):
    training = Training(kinds=["DecisionTreeClassifier", "LinearSVC"], folds=2, parallelism=3, **{"params": {"LinearSVC": {"maxIter": 2}}, **options})
    done = modelling.sweep(table, KEPT, [2, 3], training, seeds=(1, 2), jobs=jobs)
    return sorted(tuple(r) for r in done.select(METRICS).collect())


def test_a_stopped_sweep_goes_on(spark, table, monkeypatch):
    whole = run(table, new_path(spark, "jobs"), tune=True)
    assert len(whole) == 8 and {r[2] for r in whole} == {"DecisionTreeClassifier", "LinearSVC"}
    fits, right = [], modelling.fold_score

    def counted(*args):
        fits.append(args)
        if len(fits) == 14:
            raise RuntimeError("stopped")
        return right(*args)

    monkeypatch.setattr(modelling, "fold_score", counted)
    jobs = new_path(spark, "jobs")
    with pytest.raises(RuntimeError):
        run(table, jobs, tune=True)
    before = JobTable(spark, f"{jobs}/units", modelling.UNIT_SCHEMA, modelling.UNIT_KEYS).finished().count()
    assert 0 < before < 40
    fits[:] = [None] * 20
    assert run(table, jobs, tune=True) == whole
    assert len(fits) - 20 == 40 - before
    fits[:] = [None] * 20
    assert run(table, jobs, tune=True) == whole and len(fits) == 20


def test_other_training_or_data_is_other_work(spark, table):
    jobs = new_path(spark, "jobs")
    first = run(table, jobs, cross_validate=False)
    unweighted = run(table, jobs, cross_validate=False, class_weight=False)
    fewer = run(table.limit(table.count() - 1), jobs, cross_validate=False)
    assert len(first) == len(unweighted) == len(fewer) == 8
    assert run(table.repartition(5), jobs, cross_validate=False) == first
    rows = JobTable(spark, f"{jobs}/metrics", modelling.SWEPT_SCHEMA, modelling.SWEPT_KEYS).finished()
    assert rows.count() == 24


def test_open_units_are_those_without_a_row(spark):
    schema = modelling.UNIT_SCHEMA
    jobs = JobTable(spark, new_path(spark, "units"), schema, modelling.UNIT_KEYS)
    unit = ("w", 1, 2, "m", "s")
    planned = modelling._keys(spark, [(*unit, n) for n in range(4)], schema, modelling.UNIT_KEYS)
    for n in (1, 3, 3):
        jobs.add(dict(zip(schema.names, (*unit, n, 0.5, 1.0))))
    jobs.flush(now=False)
    assert jobs.open_units(planned).count() == 4
    jobs.flush()
    assert sorted(r.fold for r in jobs.open_units(planned).collect()) == [0, 2] and jobs.of(planned).count() == 2


def test_settings_of_the_same_model_are_fitted_once(table, spark, monkeypatch):
    fits, right = [], modelling.fold_score
    monkeypatch.setattr(modelling, "fold_score", lambda *args: fits.append(args) or right(*args))
    jobs = new_path(spark, "jobs")

    def swept(tune):
        training = Training(kinds=["LogisticRegression"], folds=2, tune=tune, params={"LogisticRegression": {"maxIter": 2}})
        done = modelling.sweep(table, KEPT, [2], training, jobs=jobs).collect()
        return done[0].num_params, len(fits)

    # Nine settings, three of them without a penalty; the default one is among them.
    assert swept(tune=True) == (9, 14)
    assert swept(tune=False) == (1, 14)
    frame = modelling.model_frame(table, KEPT[:2], class_weight=True)
    training = Training(folds=2, tune=True, params={"LogisticRegression": {"maxIter": 2}})
    averages = modelling.train("LogisticRegression", frame, KEPT[:2], training).avg_metrics
    assert len(averages) == 9 and averages[0] == averages[1] == averages[2] and len(fits) == 28


def test_scores_of_grid_points_need_no_last_fit(spark, table, monkeypatch):
    training = Training(kinds=["LogisticRegression", "DecisionTreeClassifier"], folds=2, tune=True, seed=1, params={"LogisticRegression": {"maxIter": 2}})
    done = modelling.train_and_evaluate(table, KEPT, 2, training)
    expected = [(m.kind, modelling.setting_as_text(p), a) for m in done.models for p, a in zip(m.grid, m.avg_metrics)]

    def unwanted(*_):
        raise AssertionError("a fit on all rows or a metric row")

    for name in ("final_fit", "metric_row"):
        monkeypatch.setattr(modelling, name, unwanted)
    monkeypatch.setattr(catalog, "written_features", lambda *_: table)
    monkeypatch.setattr(catalog, "candidates", lambda _: KEPT)
    assert [tuple(r) for r in modelling.grid_scores(table, KEPT, 2, training).collect()] == expected
    assert [r.model for r in catalog.cv_metrics(spark, "").collect()] == ["LogisticRegression"]


def test_forests_remember_nodes_and_grow_the_same_trees(spark, table):
    prepared = modelling.prepare(modelling.model_frame(table, KEPT, True), KEPT, Training(folds=2))
    trees = []
    for params in ({}, {"cacheNodeIds": False}):
        est = modelling.classifier("RandomForestClassifier", maxDepth=15, numTrees=5, **params)
        assert est.getCacheNodeIds() == (not params)
        trees.append(est.fit(prepared.fitted(None)).toDebugString.split("\n", 1)[1])
    prepared.close()
    assert trees[0] == trees[1]


def test_a_fold_score_leaves_the_trees_in_the_jvm(spark, table, monkeypatch):
    """PySpark's class for a forest asks the JVM for every tree, while the other fits wait."""
    prepared = modelling.prepare(modelling.model_frame(table, KEPT, True), KEPT, Training(folds=2))
    settings = {"RandomForestClassifier": {"numTrees": 4}, "GBTClassifier": {"maxIter": 2}, "LinearSVC": {"maxIter": 2}}
    evaluator = modelling.MulticlassClassificationEvaluator(labelCol="churn", metricName="f1")
    expected = {}
    for kind, params in settings.items():
        model = modelling.classifier(kind, **params).fit(prepared.fitted(0))
        expected[kind] = evaluator.evaluate(model.transform(prepared.held(0)))

    class Unwanted:
        def __get__(self, model, kind=None):
            if model is not None:
                raise AssertionError("the trees were asked for")

    for wrapped in (RandomForestClassificationModel, GBTClassificationModel):
        monkeypatch.setattr(wrapped, "trees", Unwanted())
    found = {kind: modelling.fold_score(prepared, modelling.classifier(kind, **params), {}, 0) for kind, params in settings.items()}
    prepared.close()
    assert found == expected


def test_long_fits_begin_first(spark, table, monkeypatch):
    order = []
    monkeypatch.setattr(modelling, "fold_score", lambda prepared, est, *_: order.append(type(est).__name__) or 0.5)
    kinds = ["LogisticRegression", "RandomForestClassifier", "LinearSVC"]
    training = Training(kinds=kinds, folds=2, parallelism=1)
    found = modelling.grid_scores(table, KEPT, 2, training).collect()
    assert [r.model for r in found] == kinds
    longest = ["LinearSVC"] * 2 + ["RandomForestClassifier"] * 2 + ["LogisticRegression"] * 2
    assert order == longest
    order.clear()
    monkeypatch.setattr(modelling.SweepRound, "finish", lambda self, kind, scores: {n: None for n in modelling.METRIC_SCHEMA.names} | {"model": kind, "num_best_features": len(self.features), "seed": 42})
    modelling.sweep(table, KEPT, [2, 3], training, jobs=new_path(spark, "jobs"))
    assert order == longest * 2


def test_fewer_fits_at_once_on_many_rows(table, monkeypatch):
    training = Training(kinds=["RandomForestClassifier"], folds=5, parallelism=6)
    running, most, lock = [], [], Lock()

    def slow(*_):
        with lock:
            running.append(1)
            most.append(len(running))
        time.sleep(0.2)
        with lock:
            running.pop()
        return 0.5

    monkeypatch.setattr(modelling, "fold_score", slow)
    modelling.grid_scores(table, KEPT, 2, training)
    assert max(most) == 5
    most.clear()
    monkeypatch.setattr(modelling, "ROWS_PER_PARTITION", 2)
    modelling.grid_scores(table, KEPT, 2, training)
    assert max(most) == 2
    monkeypatch.undo()
    rows = modelling.ROWS_PER_PARTITION
    assert [Training().at_once(n) for n in (0, rows, 2 * rows, 8 * rows, 80 * rows)] == [16, 16, 8, 2, 2]
    assert Training(parallelism=1).at_once(8 * rows) == 1
