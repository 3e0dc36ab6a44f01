import pytest
from conftest import by_user, rows
from pyspark.sql import functions as F

from lapsewise import functions as L
from lapsewise.operators import numeric, sessions
from lapsewise.operators.cleaning import clean
from lapsewise.operators.usage import usage_table
from lapsewise.plans import features
from lapsewise.schema import BROWSERS, DEVICES, FEATURES, PAGE_RATE_FEATURES, RATED_PAGES
from lapsewise.sources import activity_log
from lapsewise.storage import new_path

MIN = L.MS_PER_MINUTE


def test_feature_table_has_39_features():
    assert len(FEATURES) == len(set(FEATURES)) == 39 and len(PAGE_RATE_FEATURES) == 16


def test_user_without_time_online(make_log):
    row = features.feature_table(make_log({"userId": "z"})).first()
    assert row.total_hours == 0 and row.page_home_hourly == 0 and row.session_interval == 0


def test_interval_of_single_and_overlapping_sessions(make_log):
    log = make_log(
        {"userId": "one", "ts": 0}, {"userId": "one", "ts": 10 * MIN},
        {"userId": "lap", "sessionId": 1, "ts": 0}, {"userId": "lap", "sessionId": 1, "ts": 10 * MIN},
        {"userId": "lap", "sessionId": 2, "ts": 5 * MIN}, {"userId": "lap", "sessionId": 2, "ts": 12 * MIN},
        {"userId": "two", "sessionId": 1, "ts": 0}, {"userId": "two", "sessionId": 2, "ts": 90 * MIN},
    )
    minutes = {u: r.session_interval for u, r in by_user(sessions.session_interval(log)).items()}
    assert minutes == {"one": 0.0, "lap": -5.0, "two": 90.0}
    # The exploratory table is in whole hours and leaves single sessions out.
    hours = {u: r.session_interval_hours for u, r in by_user(numeric.session_interval_hours(log)).items()}
    assert hours == {"lap": 0, "two": 1}


def test_latest_profile_breaks_ties_the_same_way_in_any_order(make_log):
    events = [
        {"userId": "t", "ts": 5, "level": "free"}, {"userId": "t", "ts": 5, "level": "paid"},
        {"userId": "o", "ts": 9, "level": "free", "gender": "F"}, {"userId": "o", "ts": 8, "level": "paid"},
        {"userId": "x", "ts": 1, "level": "trial", "gender": None},
    ]
    expected = [("o", 1, 0), ("t", 0, 1), ("x", None, None)]
    assert rows(features.user_info(make_log(*events))) == expected
    assert rows(features.user_info(make_log(*events[::-1]))) == expected
    table = by_user(features.feature_table(make_log(*events)))
    assert (table["x"].gender, table["x"].level) == (0, 0)


def test_missing_songs_count_once_only_in_the_exploratory_table(make_log):
    log = make_log({"userId": "n"}, {"userId": "n"}, {"userId": "m"}, {"userId": "m", "song": "s", "artist": "a"})
    assert rows(numeric.unique_songs(log), "userId", "count_unique_songs") == [("m", 2), ("n", 1)]
    table = by_user(features.feature_table(log))
    assert (table["n"].count_distinct_songs, table["m"].count_distinct_songs) == (0, 1)
    assert (table["n"].count_songs, table["n"].count_logs) == (0, 2)
    assert rows(numeric.count_songs(log), "userId", "count_songs") == [("m", 2), ("n", 2)]


def test_inner_join_loses_users_of_unrated_pages_only(make_log):
    log = make_log(
        {"userId": "play", "page": "NextSong"}, {"userId": "home", "page": "Home"},
        {"userId": "new", "page": "Brand New Page"},
    )
    assert rows(features.feature_table(log), "userId") == [("home",), ("new",), ("play",)]
    assert rows(features.feature_table(log, join="inner"), "userId") == [("home",), ("new",)]
    assert rows(features.page_counts(log), "userId") == [("home",), ("new",)]
    with pytest.raises(ValueError):
        features.feature_table(log, join="cross")


def test_usage_table_shares_and_found_values(make_log):
    log = make_log({"level": "free"}, {"level": "free"}, {"level": "paid"}, {"userId": "u2", "level": "paid"})
    shares = by_user(usage_table(log, F.col("level")))
    assert shares["u1"].free == pytest.approx(2 / 3) and shares["u2"].paid == 1.0
    counts = by_user(usage_table(log, F.col("level"), ["paid", "trial"], kind="count"))
    assert (counts["u1"].paid, counts["u1"].trial) == (1, 0)
    with pytest.raises(ValueError):
        usage_table(log, F.col("level"), kind="sum")


@pytest.fixture(scope="module")
def small(spark):
    log = clean(activity_log(spark, "/root/testdata/sf0.001", profile=False)).cache()
    return log, features.feature_table(log).cache()


def test_shares_sum_to_one(small):
    _, table = small
    for group in (DEVICES, BROWSERS):
        total = sum((F.col(c) for c in group), F.lit(0.0))
        assert table.where(F.abs(total - 1) > 1e-9).count() == 0


def test_feature_table_equals_join_of_single_tables(small):
    log, table = small
    parts = [
        features.user_info(log), features.device_usage(log), features.browser_usage(log),
        features.overall_stats(log), sessions.session_stats(log), features.page_rates_hourly(log),
        sessions.session_interval(log),
    ]
    from lapsewise.operators.labels import churn_labels

    star = churn_labels(log)
    for part in parts:
        star = star.join(part, "userId", "full_outer")
    star = star.fillna(0).select(*table.columns)
    digits = lambda df: df.select("userId", *[F.round(c, 6).alias(c) for c in df.columns[1:]])
    assert rows(digits(star)) == rows(digits(table))


def test_user_metrics_equal_single_metric_tables(small):
    log, _ = small
    together = numeric.user_metrics(log).cache()
    singles = {
        "num_sessions": numeric.num_sessions, "count_unique_songs": numeric.unique_songs,
        "count_unique_artists": numeric.unique_artists, "count_songs": numeric.count_songs,
        "max_days_since_registration": numeric.days_since_registration,
        "avg_session_length": numeric.avg_session_length, "session_interval_hours": numeric.session_interval_hours,
    }
    assert set(singles) == set(numeric.METRICS)
    for metric, single in singles.items():
        expected = rows(single(log), "userId", "churn", metric)
        assert rows(together.where(F.col(metric).isNotNull()), "userId", "churn", metric) == expected


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_create_and_load_features(spark, make_log, fmt):
    log = make_log({"userId": "a"}, {"userId": ""}, {"userId": "b", "firstName": None})
    path = new_path(spark, "features-test")
    features.create_features(log, path, fmt=fmt)
    table = features.load_features(spark, path, fmt)
    assert table.columns[:2] == ["userId", "churn"] and set(table.columns[2:]) == set(FEATURES)
    assert rows(table, "userId") == [("a",), ("b",)]
    with pytest.raises(ValueError):
        features.create_features(log, path, fmt="text")


def test_feature_table_plan(spark):
    """Two scans, four shuffles, no sort before a shuffle, one join without a shuffle of its own."""
    log = clean(activity_log(spark, "/root/testdata/sf0.01", profile=False))
    plan = features.feature_table(log)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2
    assert plan.count("Exchange hashpartitioning") == 4
    assert "SortAggregate" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
    assert len(RATED_PAGES) == 16
