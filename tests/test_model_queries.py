"""The registered model queries ask for the whole job; training itself is tested in test_models."""

import pytest

from lapsewise.plans import catalog, modelling
from lapsewise.schema import FEATURES


class Asked(Exception):
    pass


@pytest.fixture
def asked(monkeypatch):
    """What a query asks of the trainer: feature counts and training."""

    def run(name, names=FEATURES[:29]):
        def stop(table, candidates, ks, training, **other):
            raise Asked(list(ks) if not isinstance(ks, int) else [ks], training)

        monkeypatch.setattr(catalog, "once", lambda spark, sf, name, build: build())
        monkeypatch.setattr(catalog, "written_features", lambda spark, sf: None)
        monkeypatch.setattr(catalog, "candidates", lambda table: names)
        monkeypatch.setattr(modelling, "sweep", stop)
        monkeypatch.setattr(modelling, "train_and_evaluate", stop)
        with pytest.raises(Asked) as found:
            catalog.queries()[name](None, "")
        return found.value.args

    return run


def test_sweeps_take_every_classifier_and_feature_count(asked):
    ks, training = asked("experiment_sweep")
    assert ks == [4, 8, 12, 16, 20, 24, 28] and training == modelling.Training()
    assert training.kinds == modelling.SWEPT and training.folds == 5
    ks, training = asked("tuning_sweep")
    assert ks == [4, 8, 12, 16, 20, 24] and training == modelling.Training(kinds=modelling.TUNED, tune=True)
    assert asked("tuning_sweep", FEATURES[:17])[0] == [4, 8, 12, 16]
    assert asked("grid_search")[1] == training


@pytest.mark.parametrize(
    "name", ["predict_rf", "predict_lr", "predict_gbt", "predict_svc", "predict_dt", "evaluation", "cv_metrics",
             "grid_search", "model_metrics", "feature_importance"]
)
def test_models_have_full_size(asked, name):
    ks, training = asked(name)
    assert ks == [8] and training.params == {} and training.folds == 5


def test_refit_has_the_forest_of_the_reference(asked):
    ks, training = asked("best_model_refit")
    assert ks == [12] and training.folds == 5
    assert training.params == {"RandomForestClassifier": {"maxDepth": 5, "numTrees": 100}}
