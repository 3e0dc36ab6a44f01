import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from lapsewise.operators import numeric, quantiles
from lapsewise.operators.quantiles import exact_quantiles
from lapsewise.operators.ranking import area_under_curve, counts_below

PROBS = {"q1": 0.25, "median": 0.5, "q3": 0.75, "p0": 0.0, "p99": 0.99, "p100": 1.0}


def check(df, groups):
    got = {r.g: r for r in exact_quantiles(df, ["g"], "v", PROBS).collect()}
    assert set(got) == set(groups)
    for g, values in groups.items():
        for name, p in PROBS.items():
            assert got[g][name] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12), (g, name)


def test_small_groups(spark):
    groups = {0: [3.0], 1: [1.0, 2.0], 2: [5.0, 5.0, 5.0, 1.0], 3: [float(x) for x in range(11)]}
    data = [(g, v) for g, vs in groups.items() for v in vs] + [(1, None)]
    check(spark.createDataFrame(data, "g int, v double"), groups)


@pytest.mark.parametrize("accuracy", [100_000, 10_000, 500])
def test_groups_beyond_the_sketch_size(spark, monkeypatch, accuracy):
    """Large groups go through the brackets: one continuous, one with few values, one lopsided."""
    monkeypatch.setattr(quantiles, "ACCURACY", accuracy)
    rng = np.random.default_rng(7)
    groups = {
        0: rng.normal(size=90_000),
        1: rng.integers(0, 9, size=60_000).astype(float),
        2: np.concatenate([np.zeros(50_000), rng.exponential(size=3_001)]),
    }
    import pandas as pd

    frame = pd.concat([pd.DataFrame({"g": g, "v": v}) for g, v in groups.items()])
    check(spark.createDataFrame(frame).repartition(7), groups)


@pytest.mark.parametrize("low, high", [(5.0, 6.0), (-9.0, -8.0), (50.0, 60.0)])
def test_a_wrong_bracket_still_gives_the_exact_value(spark, monkeypatch, low, high):
    values = {g: [float(v % 37) for v in range(g, 500)] for g in (0, 1)}
    frame = spark.createDataFrame([(g, v) for g, vs in values.items() for v in vs], "g int, v double")
    right = quantiles.brackets

    def wrong(data, by, probs):
        return right(data, by, probs).withColumns({"low": F.lit(low), "high": F.lit(high)})

    monkeypatch.setattr(quantiles, "brackets", wrong)
    check(frame, values)


def test_counts_below_equal_a_running_sum(spark):
    data = [(g, float(v), v % 3 + 1, 1) for g in ("a", "b") for v in range(300)]
    frame = spark.createDataFrame(data, "g string, v double, x long, y long").repartition(9)
    found = {(r.g, r.v): (r.below_x, r.below_y) for r in counts_below(frame, ["g"], "v", ["x", "y"]).collect()}
    for g in ("a", "b"):
        assert all(found[g, float(v)] == (sum(i % 3 + 1 for i in range(v)), v) for v in range(300))


def test_area_under_curve_equals_mllib_and_counts_ties_half(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rng = np.random.default_rng(3)
    data = [(int(y), float(np.round(rng.normal() + y, 1)), "g") for y in rng.integers(0, 2, 900)]
    frame = spark.createDataFrame(data, "churn int, score double, part string").repartition(4)
    evaluator = BinaryClassificationEvaluator(labelCol="churn", rawPredictionCol="score", numBins=0)
    found = area_under_curve(frame, "score").first()
    assert found.auc == pytest.approx(evaluator.evaluate(frame)) and found.n_positive + found.n_negative == 900
    few = [(1, 1.0, "a"), (0, 1.0, "a"), (1, 2.0, "b"), (0, 1.0, "b"), (1, 1.0, "c"), (None, 1.0, "c"), (0, None, "c")]
    by_part = area_under_curve(spark.createDataFrame(few, "churn int, score double, part string"), "score", by=["part"])
    assert rows(by_part, "part", "auc") == [("a", 0.5), ("b", 1.0), ("c", None)]


def test_summarize_matches_numpy(spark):
    values = np.random.default_rng(1).integers(0, 40, size=501).astype(float)
    df = spark.createDataFrame([(int(i % 2), float(v)) for i, v in enumerate(values)], "churn int, v double")
    for row in numeric.summarize(df, ["churn"], "v").collect():
        mine = values[row.churn :: 2]
        assert row.n == len(mine) and row.min == mine.min() and row.max == mine.max()
        assert row["mean"] == pytest.approx(mine.mean()) and row["std"] == pytest.approx(mine.std(ddof=1))
        assert [row.q1, row["median"], row.q3] == pytest.approx(list(np.quantile(mine, [0.25, 0.5, 0.75])))


def test_histogram_counts_everyone_once(spark):
    long = spark.createDataFrame(
        [(c, "m", float(v)) for v in range(101) for c in (0, 1)] + [(0, "flat", 5.0)],
        "churn int, metric string, value double",
    )
    out = numeric.histogram(long, {"m": 10, "flat": 4})
    assert out.where("metric = 'm'").agg(F.sum("n")).first()[0] == 202
    last = out.where("metric = 'm' and churn = 0 and bin = 9").first()
    assert last.n == 11 and last.percent == pytest.approx(100 * 11 / 101)
    assert rows(out.where("metric = 'flat'"), "churn", "bin", "n") == [(0, 0, 1)]


def test_box_whiskers_stop_at_data(make_log):
    views = [1, 2, 2, 3, 3, 4, 30]
    log = make_log(*[
        {"userId": f"u{i}", "page": "Help", "ts": t} for i, n in enumerate(views) for t in range(n)
    ])
    box = numeric.page_box_stats(log, ["Help"]).first()
    assert (box.n, box.q1, box["median"], box.q3) == (7, 2.0, 3.0, 3.5)
    assert (box.whisker_low, box.whisker_high, box["max"]) == (1.0, 4.0, 30.0)
