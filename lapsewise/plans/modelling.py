"""Training, tuning and evaluation of MLlib classifiers on the feature table."""

import hashlib
import time
from collections import defaultdict, deque
from collections.abc import Callable, Iterable
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, field, replace
from threading import Lock

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import MinMaxScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.ml.wrapper import JavaModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapsewise.operators.ranking import area_under_curve
from lapsewise.operators.selection import best_features
from lapsewise.operators.weighting import confusion_metrics, train_test_split, with_class_weight, with_fold
from lapsewise.plans.job_table import JobTable
from lapsewise.storage import checkpointed, shared_root, write_and_reload

METRIC_SCHEMA = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("accuracy", T.DoubleType()),
        T.StructField("accuracy_train", T.DoubleType()),
        T.StructField("f1_score", T.DoubleType()),
        T.StructField("f1_score_train", T.DoubleType()),
        T.StructField("precision", T.DoubleType()),
        T.StructField("recall", T.DoubleType()),
        T.StructField("auc_hard", T.DoubleType()),
        T.StructField("auc_hard_train", T.DoubleType()),
        T.StructField("auc", T.DoubleType()),
        T.StructField("auc_train", T.DoubleType()),
        T.StructField("training_time", T.DoubleType()),
        T.StructField("cross_validation", T.BooleanType()),
        T.StructField("param_grid", T.ArrayType(T.StringType())),
        T.StructField("best_params", T.StringType()),
        T.StructField("num_best_features", T.IntegerType()),
        T.StructField("seed", T.IntegerType()),
        T.StructField("num_params", T.IntegerType()),
    ]
)

IMPORTANCE_SCHEMA = T.StructType(
    [T.StructField("feature", T.StringType()), T.StructField("coefficient", T.DoubleType())]
)

FOLD_SCHEMA = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("setting", T.StringType()),
        T.StructField("avg_f1", T.DoubleType()),
    ]
)

Setting = dict[Param, object]
Grid = list[Setting]

#: Training rows per partition. A fit is a chain of short jobs, so a small table is better off in one task.
ROWS_PER_PARTITION = 50_000


def partitions_of(rows: int) -> int:
    return max(1, -(-rows // ROWS_PER_PARTITION))


def classifier(kind: str, weighted: bool = True, seed: int = 42, **params) -> Estimator:
    """One of the five classifiers by its class name."""
    columns = {"featuresCol": "features", "labelCol": "churn"}
    if weighted:
        columns["weightCol"] = "weight"
    seeded = {**columns, "seed": seed}
    # Rows that remember their node need not be led through every tree from its root at each level; the trees are the same.
    makers = {
        "RandomForestClassifier": lambda: RandomForestClassifier(**seeded, **{"cacheNodeIds": True, **params}),
        "LogisticRegression": lambda: LogisticRegression(**columns, **params),
        "GBTClassifier": lambda: GBTClassifier(**seeded, **params),
        "LinearSVC": lambda: LinearSVC(**columns, **params),
        "DecisionTreeClassifier": lambda: DecisionTreeClassifier(**seeded, **params),
    }
    return makers[kind]()


SWEPT = ["RandomForestClassifier", "LogisticRegression", "GBTClassifier", "LinearSVC", "DecisionTreeClassifier"]
TUNED = ["RandomForestClassifier", "LogisticRegression", "LinearSVC", "GBTClassifier"]
#: Long fits are begun first, so that none of them runs on alone at the end.
LONGEST_FIRST = ["LinearSVC", "RandomForestClassifier", "GBTClassifier", "LogisticRegression", "DecisionTreeClassifier"]


def default_grid() -> Grid:
    return ParamGridBuilder().build()


def tuning_grid(est: Estimator) -> Grid:
    """Grid searched for each tuned classifier; boosted trees keep their defaults."""
    grid = ParamGridBuilder()
    if isinstance(est, RandomForestClassifier):
        grid = grid.addGrid(est.maxDepth, [5, 10, 15]).addGrid(est.numTrees, [20, 50, 100])
    elif isinstance(est, LogisticRegression):
        grid = grid.addGrid(est.regParam, [0.0, 0.1, 0.2]).addGrid(est.elasticNetParam, [0.0, 0.5, 1.0])
    elif isinstance(est, LinearSVC):
        grid = grid.addGrid(est.regParam, [0.0, 0.05, 0.1, 0.2])
    return grid.build()


def grid_as_text(grid: Grid) -> list[str]:
    """Each parameter of a grid with the values it takes."""
    values: dict[str, list[str]] = {}
    for setting in grid:
        for param, value in setting.items():
            seen = values.setdefault(param.name, [])
            if str(value) not in seen:
                seen.append(str(value))
    return [f"{name}: {', '.join(v)}" for name, v in values.items()]


def setting_as_text(setting: dict[Param, object]) -> str:
    return ", ".join(f"{param.name}={value}" for param, value in setting.items())


def fit_as_text(est: Estimator, setting: Setting) -> str:
    """Equal for settings that give the same model: every tuned parameter with its value, given or default.

    Without a penalty there is nothing that ``elasticNetParam`` could share out.
    """
    placed = est.copy(setting)
    names = {param.name for point in [*tuning_grid(est), setting] for param in point}
    values = {name: placed.getOrDefault(name) for name in sorted(names)}
    if values.get("regParam") == 0:
        values.pop("elasticNetParam", None)
    return ", ".join(f"{name}={value}" for name, value in values.items())


def pipeline(est: Estimator, features: list[str]) -> Pipeline:
    """Assembler, min-max scaler and classifier over the named features."""
    assembler = VectorAssembler(inputCols=features, outputCol="num_features")
    scaler = MinMaxScaler(inputCol="num_features", outputCol="features")
    return Pipeline(stages=[assembler, scaler, est])


@dataclass
class Training:
    """What to train: the classifiers, their grids, and how to validate."""

    kinds: list[str] = field(default_factory=lambda: list(SWEPT))
    tune: bool = False
    folds: int = 5
    cross_validate: bool = True
    class_weight: bool = True
    # Fits running at once, fewer on tables of many partitions. Each holds its own cached copy of the training rows.
    parallelism: int = 16
    seed: int = 42
    params: dict[str, dict] = field(default_factory=dict)

    def estimator(self, kind: str) -> Estimator:
        return classifier(kind, self.class_weight, **self.params.get(kind, {}))

    def grid(self, est: Estimator) -> Grid:
        return tuning_grid(est) if self.tune else default_grid()

    def at_once(self, rows: int) -> int:
        """Fits side by side over ``rows`` training rows, so that about ``parallelism`` tasks run.

        The driver holds the trees of every forest that is being grown, and they grow with the rows.
        """
        return min(self.parallelism, max(2, self.parallelism // partitions_of(rows)))


@dataclass
class Trained:
    kind: str
    model: PipelineModel | None
    features: list[str]
    seconds: float
    grid: Grid
    avg_metrics: list[float] | None = None

    def best_setting(self) -> dict[Param, object]:
        return self.grid[best_index(self.avg_metrics)]


class Prepared:
    """Training rows as feature vectors with their folds; the scaled rows of each fold are made once for all fits.

    Rows lie in partitions by a hash of the user and in order of users, so that what a fit draws does not
    depend on how the table was written. Fold None stands for all rows. Scaled rows are checkpointed: a fit
    is hundreds of short jobs, each of which carries the lineage of its input.
    """

    def __init__(self, assembler: VectorAssembler, scaling: MinMaxScaler, train_df: DataFrame, training: Training):
        self.assembler, self.scaling = assembler, scaling
        self.size = train_df.count()
        placed = with_fold(train_df, training.folds, training.seed)
        placed = placed.repartition(partitions_of(self.size), "userId").sortWithinPartitions("userId")
        self.columns = ["churn"] + (["weight"] if training.class_weight else [])
        self.rows = assembler.transform(placed).select(*self.columns, "fold", assembler.getOutputCol()).persist()
        self._made: dict[tuple[str, int | None], object] = {}
        self._locks: dict[tuple[str, int | None], Lock] = defaultdict(Lock)
        self._lock = Lock()

    def _once(self, what: str, fold: int | None, make: Callable[[], object]):
        with self._lock:
            mine = self._locks[what, fold]
        with mine:
            if (what, fold) not in self._made:
                self._made[what, fold] = make()
            return self._made[what, fold]

    def scaler(self, fold: int | None) -> Model:
        return self._once("scaler", fold, lambda: self.scaling.fit(self._without(fold)))

    def _without(self, fold: int | None) -> DataFrame:
        return self.rows if fold is None else self.rows.where(F.col("fold") != fold)

    def _scaled(self, rows: DataFrame, fold: int | None) -> Callable[[], DataFrame]:
        scaler = self.scaler(fold)
        return lambda: checkpointed(scaler.transform(rows).select(*self.columns, scaler.getOutputCol()))

    def fitted(self, fold: int | None) -> DataFrame:
        """Scaled rows outside the fold."""
        return self._once("fitted", fold, self._scaled(self._without(fold), fold))

    def held(self, fold: int) -> DataFrame:
        """Scaled rows of the fold, by the scaler of the others."""
        return self._once("held", fold, self._scaled(self.rows.where(F.col("fold") == fold), fold))

    def close(self) -> None:
        self._made.clear()
        self.rows.unpersist()


def prepare(train_df: DataFrame, features: list[str], training: Training) -> Prepared:
    assembler, scaling = pipeline(classifier("LogisticRegression"), features).getStages()[:2]
    return Prepared(assembler, scaling, train_df, training)


def scoring_model(est: Estimator, frame: DataFrame) -> Model:
    """A fitted model that can transform and no more.

    PySpark's own class for a forest asks the JVM for each of its trees, thousands of calls that the other threads
    have to wait for, and holds on to the trees there.
    """
    return JavaModel(est._fit_java(frame))


def fold_score(prepared: Prepared, est: Estimator, setting: Setting, fold: int) -> float:
    """Weighted F1 of the fold's rows by a model of the others."""
    evaluator = MulticlassClassificationEvaluator(labelCol="churn", metricName="f1")
    model = scoring_model(est.copy(setting), prepared.fitted(fold))
    return float(evaluator.evaluate(model.transform(prepared.held(fold))))


def final_fit(prepared: Prepared, est: Estimator, setting: Setting) -> PipelineModel:
    model = est.copy(setting).fit(prepared.fitted(None))
    return PipelineModel([prepared.assembler, prepared.scaler(None), model])


def cross_validate(
    pipe: Pipeline, grid: Grid, train_df: DataFrame, training: Training
) -> tuple[PipelineModel, list[float]]:
    """Average weighted F1 of every grid point over the folds, and the best one fitted on all rows.

    What ``CrossValidator`` with a fold column does, but folds run side by side as well as grid
    points, and a fold is assembled and scaled once for all of them.
    """
    assembler, scaling, est = pipe.getStages()
    prepared = Prepared(assembler, scaling, train_df, training)
    try:
        return _cross_validate(prepared, est, grid, training)
    finally:
        prepared.close()


def _cross_validate(
    prepared: Prepared, est: Estimator, grid: Grid, training: Training
) -> tuple[PipelineModel, list[float]]:
    with ThreadPoolExecutor(training.at_once(prepared.size)) as pool:
        # With a single grid point the final fit does not have to wait for the scores.
        final = pool.submit(final_fit, prepared, est, grid[0]) if len(grid) == 1 else None
        averages = _averages(est, grid, _submit_folds(pool, prepared, est, grid, training.folds))
        model = final.result() if final else final_fit(prepared, est, grid[best_index(averages)])
    return model, averages


def _submit_folds(pool: ThreadPoolExecutor, prepared: Prepared, est: Estimator, grid: Grid, folds: int) -> dict[str, list[Future]]:
    """The fold scores of every setting; settings of the same model share them."""
    settings = {fit_as_text(est, p): p for p in grid}
    return {text: [pool.submit(fold_score, prepared, est, p, n) for n in range(folds)] for text, p in settings.items()}


def _averages(est: Estimator, grid: Grid, scores: dict[str, list[Future]]) -> list[float]:
    found = [scores[fit_as_text(est, p)] for p in grid]
    return [sum(s.result() for s in of_point) / len(of_point) for of_point in found]


def best_index(scores: list[float]) -> int:
    return max(range(len(scores)), key=scores.__getitem__)


def train(
    kind: str, train_df: DataFrame, features: list[str], training: Training, prepared: Prepared | None = None
) -> Trained:
    """Fit one classifier and time it."""
    est = training.estimator(kind)
    grid = training.grid(est)
    started = time.time()
    shared = prepared or prepare(train_df, features, training)
    try:
        if training.cross_validate:
            model, averages = _cross_validate(shared, est, grid, training)
        else:
            model, averages = final_fit(shared, est, grid[0]), None
    finally:
        if prepared is None:
            shared.close()
    return Trained(kind, model, features, time.time() - started, grid, averages)


def model_frame(table: DataFrame, features: list[str], class_weight: bool) -> DataFrame:
    columns = ["userId", "churn", *features] + (["weight"] if class_weight else [])
    return (with_class_weight(table) if class_weight else table).select(*columns)


def predictions(trained: Trained, frame: DataFrame) -> DataFrame:
    return trained.model.transform(frame).select("userId", "churn", "rawPrediction", "prediction")


def _auc(predicted: DataFrame) -> float:
    evaluator = BinaryClassificationEvaluator(
        labelCol="churn", rawPredictionCol="rawPrediction", metricName="areaUnderROC"
    )
    return float(evaluator.evaluate(predicted))


def evaluation(trained: Trained, train_df: DataFrame, test_df: DataFrame) -> DataFrame:
    """Confusion counts and metrics of the train and the test part, in one aggregation."""
    return confusion_metrics(scored_parts(trained, train_df, test_df), ["part"])


def scored_parts(trained: Trained, train_df: DataFrame, test_df: DataFrame) -> DataFrame:
    """Both parts with the model's prediction and its raw score for leaving."""
    parts = train_df.withColumn("part", F.lit("train")).unionByName(test_df.withColumn("part", F.lit("test")))
    return trained.model.transform(parts).withColumn("score", vector_to_array("rawPrediction")[1])


def evaluation_with_auc(trained: Trained, train_df: DataFrame, test_df: DataFrame) -> DataFrame:
    """``evaluation`` with the area under the curve of the raw scores, from the written predictions."""
    scored = scored_parts(trained, train_df, test_df).select("part", "churn", "prediction", "score")
    scored = write_and_reload(scored, "predictions")
    return confusion_metrics(scored, ["part"]).join(area_under_curve(scored, "score", by=["part"]).select("part", "auc"), "part")


def metric_row(trained: Trained, train_df: DataFrame, test_df: DataFrame, training: Training) -> dict:
    parts = {row.part: row for row in evaluation(trained, train_df, test_df).collect()}
    test, fit = parts["test"], parts["train"]
    return {
        "model": trained.kind,
        "accuracy": test.accuracy,
        "accuracy_train": fit.accuracy,
        "f1_score": test.f1_score,
        "f1_score_train": fit.f1_score,
        "precision": test.precision,
        "recall": test.recall,
        "auc_hard": test.auc_hard,
        "auc_hard_train": fit.auc_hard,
        "auc": _auc(predictions(trained, test_df)),
        "auc_train": _auc(predictions(trained, train_df)),
        "training_time": trained.seconds,
        "cross_validation": training.cross_validate,
        "param_grid": grid_as_text(trained.grid),
        "best_params": setting_as_text(trained.best_setting()) if training.cross_validate else None,
        "num_best_features": len(trained.features),
        "seed": training.seed,
        "num_params": len(trained.grid),
    }


@dataclass
class Round:
    """Models and metric rows for one number of features."""

    models: list[Trained]
    metrics: list[dict]
    train_df: DataFrame
    test_df: DataFrame


def train_and_evaluate(
    table: DataFrame,
    candidates: list[str],
    k: int,
    training: Training,
    fit_selection_on_train: bool = False,
    last_fit: bool = True,
) -> Round:
    """Pick the k best features, split, then fit and score every classifier.

    Selection sees all users unless ``fit_selection_on_train``. ``table`` should be a written or
    cached table: every fold and tree level reads it again. Without ``last_fit`` there are the fold scores
    alone: no model of all training rows and no metric rows.
    """
    seen = train_test_split(table, seed=training.seed)[0] if fit_selection_on_train else table
    features = best_features(seen, candidates, k)
    frame = model_frame(table, features, training.class_weight)
    train_df, test_df = (part.persist() for part in train_test_split(frame, seed=training.seed))
    prepared = prepare(train_df, features, training)
    try:
        if last_fit:
            models = [train(kind, train_df, features, training, prepared) for kind in training.kinds]
            rows = [metric_row(m, train_df, test_df, training) for m in models]
        else:
            models, rows = fold_scored(prepared, features, training), []
    finally:
        prepared.close()
        train_df.unpersist()
        test_df.unpersist()
    return Round(models, rows, train_df, test_df)


def fold_scored(prepared: Prepared, features: list[str], training: Training) -> list[Trained]:
    """Average fold scores of every classifier's grid; the folds of all classifiers share one pool."""
    estimators = {kind: training.estimator(kind) for kind in training.kinds}
    grids = {kind: training.grid(est) for kind, est in estimators.items()}
    started = time.time()
    with ThreadPoolExecutor(training.at_once(prepared.size)) as pool:
        scores = {
            kind: _submit_folds(pool, prepared, estimators[kind], grids[kind], training.folds)
            for kind in sorted(estimators, key=LONGEST_FIRST.index)
        }
        averages = {kind: _averages(est, grids[kind], scores[kind]) for kind, est in estimators.items()}
    seconds = time.time() - started
    return [Trained(kind, None, features, seconds, grids[kind], averages[kind]) for kind in training.kinds]


def grid_scores(table: DataFrame, candidates: list[str], k: int, training: Training) -> DataFrame:
    """Average cross-validation F1 of every grid point of every classifier.

    Nothing is fitted on all training rows: no result needs it.
    """
    done = train_and_evaluate(table, candidates, k, training, last_fit=False)
    rows = [(m.kind, setting_as_text(p), float(a)) for m in done.models for p, a in zip(m.grid, m.avg_metrics)]
    return table.sparkSession.createDataFrame(rows, FOLD_SCHEMA)


def metric_table(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Metric rows, one per trained model, as a table."""
    names = METRIC_SCHEMA.names
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], METRIC_SCHEMA)


#: One fit on the rows outside a fold, scored on the fold.
UNIT_SCHEMA = T.StructType(
    [
        T.StructField("work", T.StringType()),
        T.StructField("seed", T.IntegerType()),
        T.StructField("num_best_features", T.IntegerType()),
        T.StructField("model", T.StringType()),
        T.StructField("setting", T.StringType()),
        T.StructField("fold", T.IntegerType()),
        T.StructField("f1_score", T.DoubleType()),
        T.StructField("seconds", T.DoubleType()),
    ]
)
UNIT_KEYS = ["work", "seed", "num_best_features", "model", "setting", "fold"]
#: A metric row, with the work it belongs to; the work names the grid too.
SWEPT_SCHEMA = T.StructType([T.StructField("work", T.StringType()), *METRIC_SCHEMA.fields])
SWEPT_KEYS = ["work", "seed", "num_best_features", "model"]


def table_mark(table: DataFrame) -> str:
    """A mark of the rows of a table, whatever their order."""
    row = table.agg(
        F.count("*"), F.bit_xor(F.xxhash64(*table.columns)), F.sum(F.xxhash64(F.lit(1), *table.columns).cast("decimal(38,0)"))
    ).first()
    return ":".join(str(v) for v in row)


class SweepRound:
    """The fits of all classifiers for one seed and number of features; data is prepared by the first that needs it."""

    def __init__(self, table: DataFrame, features: list[str], training: Training):
        self.table, self.features, self.training = table, features, training
        self.estimators = {kind: training.estimator(kind) for kind in training.kinds}
        self.grids = {kind: training.grid(est) for kind, est in self.estimators.items()}
        self.left = 0
        self._lock = Lock()
        self._data: tuple[Prepared, DataFrame, DataFrame] | None = None

    def data(self) -> tuple[Prepared, DataFrame, DataFrame]:
        with self._lock:
            if self._data is None:
                frame = model_frame(self.table, self.features, self.training.class_weight)
                train_df, test_df = (p.persist() for p in train_test_split(frame, seed=self.training.seed))
                self._data = prepare(train_df, self.features, self.training), train_df, test_df
            return self._data

    def close(self) -> None:
        if self._data:
            self._data[0].close()
            for part in self._data[1:]:
                part.unpersist()

    def work(self, mark: str, kind: str, with_grid: bool = False) -> str:
        """Everything a result depends on beside seed, number of features, classifier and setting."""
        t = self.training
        told = [mark, self.features, t.folds, t.cross_validate, t.class_weight, sorted(t.params.get(kind, {}).items())]
        return hashlib.sha256(repr(told + [grid_as_text(self.grids[kind])] * with_grid).encode()).hexdigest()

    def unit(self, mark: str, kind: str, setting: Setting, fold: int) -> tuple:
        text = fit_as_text(self.estimators[kind], setting)
        return self.work(mark, kind), self.training.seed, len(self.features), kind, text, fold

    def score(self, kind: str, setting: Setting, fold: int) -> tuple[float, float]:
        prepared, started = self.data()[0], time.time()
        return fold_score(prepared, self.estimators[kind], setting, fold), time.time() - started

    def finish(self, kind: str, scores: dict[tuple[str, int], tuple[float, float]]) -> dict:
        """The metric row of a classifier, its best setting by the fold scores fitted on all training rows.

        The training time is that of all its fits, one after the other; settings of the same model share a fit.
        """
        prepared, train_df, test_df = self.data()
        grid, averages, started = self.grids[kind], None, time.time()
        if self.training.cross_validate:
            folds = range(self.training.folds)
            texts = [fit_as_text(self.estimators[kind], p) for p in grid]
            averages = [sum(scores[text, n][0] for n in folds) / len(folds) for text in texts]
        best = grid[best_index(averages)] if averages else grid[0]
        model = final_fit(prepared, self.estimators[kind], best)
        seconds = time.time() - started + sum(s for _, s in scores.values())
        return metric_row(Trained(kind, model, self.features, seconds, grid, averages), train_df, test_df, self.training)


def sweep(
    table: DataFrame,
    candidates: list[str],
    ks: Iterable[int],
    training: Training,
    seeds: Iterable[int] = (42,),
    jobs: str | None = None,
) -> DataFrame:
    """Metric rows for every seed, number of features and classifier.

    Every fit of a fold is a unit of its own. All units of all rounds share one pool of
    at most ``training.parallelism`` fits; at most a few rounds hold data at once. Finished units and metric rows are
    appended to two tables in the folder ``jobs``, and units found there are not fitted again, whichever grid
    they were fitted for.
    """
    spark = table.sparkSession
    jobs = jobs or f"{shared_root(spark)}/lapsewise/jobs"
    done_units = JobTable(spark, f"{jobs}/units", UNIT_SCHEMA, UNIT_KEYS)
    done_rows = JobTable(spark, f"{jobs}/metrics", SWEPT_SCHEMA, SWEPT_KEYS)
    mark, ranked = table_mark(table), best_features(table, candidates, len(candidates))
    rounds = [SweepRound(table, ranked[:k], replace(training, seed=seed)) for seed in seeds for k in ks]
    wanted = {
        (r.work(mark, kind, with_grid=True), r.training.seed, len(r.features), kind): r for r in rounds for kind in training.kinds
    }
    planned_rows = _keys(spark, list(wanted), SWEPT_SCHEMA, SWEPT_KEYS)
    open_rows = {tuple(k): wanted[tuple(k)] for k in done_rows.open_units(planned_rows).collect()}
    if open_rows:
        _run_units(spark, mark, open_rows, training, table.count(), done_units, done_rows)
    return done_rows.of(planned_rows).select(METRIC_SCHEMA.names)


def _keys(spark: SparkSession, rows: list[tuple], schema: T.StructType, keys: list[str]) -> DataFrame:
    return spark.createDataFrame(rows, T.StructType([schema[k] for k in keys]))


def _run_units(
    spark: SparkSession, mark: str, open_rows: dict[tuple, SweepRound], training: Training, rows: int,
    done_units: JobTable, done_rows: JobTable,
) -> None:
    """Fit what is open: fold scores first, then the last fit of each classifier."""
    scores: dict[tuple, dict[tuple[str, int], tuple[float, float]]] = {key: {} for key in open_rows}
    units = {}
    for key in sorted(open_rows, key=lambda key: (key[1], key[2], LONGEST_FIRST.index(key[3]))):
        r, kind = open_rows[key], key[3]
        r.left += 1
        if training.cross_validate:
            units |= {r.unit(mark, kind, p, n): (key, p) for p in r.grids[kind] for n in range(training.folds)}
    if units:
        planned = _keys(spark, list(units), UNIT_SCHEMA, UNIT_KEYS)
        for row in done_units.of(planned).collect():  # one small row per planned unit
            found = units.pop(tuple(row[k] for k in UNIT_KEYS))
            scores[found[0]][row.setting, row.fold] = (row.f1_score, row.seconds)
    missing: dict[tuple, int] = dict.fromkeys(open_rows, 0)
    for key, _ in units.values():
        missing[key] += 1

    waiting = deque(("unit", unit) for unit in units)
    waiting.extendleft(("row", key) for key, n in missing.items() if n == 0)
    running: dict[Future, tuple] = {}
    at_once = training.at_once(rows)
    with ThreadPoolExecutor(at_once) as pool:
        try:
            while waiting or running:
                while waiting and len(running) < at_once:
                    what, name = waiting.popleft()
                    if what == "unit":
                        key, setting = units[name]
                        future = pool.submit(open_rows[key].score, name[3], setting, name[5])
                    else:
                        future = pool.submit(open_rows[name].finish, name[3], scores[name])
                    running[future] = what, name
                ended, _ = wait(running, timeout=1.0, return_when=FIRST_COMPLETED)
                for future in ended:
                    what, name = running.pop(future)
                    result = future.result()
                    if what == "unit":
                        key = units[name][0]
                        scores[key][name[4], name[5]] = result
                        done_units.add(dict(zip(UNIT_SCHEMA.names, (*name, *result))))
                        missing[key] -= 1
                        if not missing[key]:
                            # Before the units of later rounds, so that this round can let its data go.
                            waiting.appendleft(("row", key))
                    else:
                        done_rows.add({"work": name[0], **result})
                        open_rows[name].left -= 1
                        if not open_rows[name].left:
                            open_rows[name].close()
                done_units.flush(now=False)
                done_rows.flush(now=False)
        finally:
            wait(running)
            done_units.flush()
            done_rows.flush()
            for round_ in open_rows.values():
                round_.close()


def swept_feature_counts(candidates: list[str]) -> range:
    """4, 8, 12, ... below the number of candidate features."""
    return range(4, len(candidates), 4)


def feature_importance(trained: Trained) -> DataFrame:
    """Importance (trees) or coefficient (linear models) of each feature, largest first."""
    last = trained.model.stages[-1]
    linear = trained.kind in ("LogisticRegression", "LinearSVC")
    values = (last.coefficients if linear else last.featureImportances).toArray()
    spark = SparkSession.active()
    rows = [(name, float(v)) for name, v in zip(trained.features, values)]
    return spark.createDataFrame(rows, IMPORTANCE_SCHEMA).orderBy(F.desc("coefficient"), "feature")
