from conftest import rows

from lapsewise.plans import reports

METRICS = "model string, f1_score double, training_time double, num_best_features int, num_params int, best_params string"


def test_numeric_table_rounds_to_whole_numbers(make_log):
    cancel = {"page": "Cancellation Confirmation"}
    log = make_log(
        {"userId": "a", "ts": 1}, {"userId": "a", "ts": 2}, {"userId": "b", "ts": 1},
        {"userId": "c", "ts": 1, **cancel},
    )
    table = reports.numeric_summary_table(log, "tiny", ["count_songs"])
    # Others: 1 and 2 rows (mean and median 1.5, to even 2); churner: 1 row, no deviation.
    assert rows(table, "metric", "median_0", "mean_0", "std_0", "mean_1", "std_1", "dataset") == [
        ("count_songs", 2, 2, 1, 1, None, "tiny")
    ]


def test_rate_table_and_comparison(make_log):
    cancel = {"page": "Cancellation Confirmation"}
    mini = make_log({"userId": "a", **cancel}, {"userId": "b"}, {"userId": "c"})
    medium = make_log({"userId": "a"}, {"userId": "b", "gender": "F"})
    tables = {n: reports.churn_rate_table(log_with_browser(t), n, ["gender"]) for n, t in
              (("mini", mini), ("medium", medium))}
    assert rows(reports.compare_categories(tables)) == [("gender", "F", None, 0.0), ("gender", "M", 33.3, 0.0)]


def log_with_browser(log):
    from lapsewise.operators.cleaning import with_agent_columns

    return with_agent_columns(log)


def test_metric_reports(spark):
    metrics = spark.createDataFrame(
        [("A", 0.8, 10.0, 4, 5, "x"), ("A", 0.6, 20.0, 4, 5, "y"), ("B", 0.9, 4.0, 8, 1, "z")], METRICS
    )
    curves = {r.num_best_features: r for r in reports.metric_curves(metrics, ["A", "B"]).collect()}
    assert abs(curves[4].f1_score_A - 0.7) < 1e-12 and curves[4].f1_score_B is None
    assert curves[4].training_time_A == 15.0 and curves[8].training_time_B == 4.0
    assert rows(reports.time_per_param(metrics), "training_time") == [(2.0,), (4.0,), (4.0,)]
    assert rows(reports.best_model(metrics), "model", "best_params") == [("B", "z")]


def test_cumulative_importance(spark):
    importance = spark.createDataFrame([("a", 0.2), ("b", 0.5), ("c", 0.3)], "feature string, coefficient double")
    out = reports.cumulative_importance(importance).collect()
    assert [(r.feature, round(r.cumulative_coefficient, 9)) for r in out] == [("b", 0.5), ("c", 0.8), ("a", 1.0)]
