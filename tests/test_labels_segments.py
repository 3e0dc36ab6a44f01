import pytest
from conftest import by_user, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from lapsewise.operators import labels, segments
from lapsewise.operators.skew import hot_keys, join_on_skewed_key

CANCEL = {"page": "Cancellation Confirmation"}


def users(prefix, n, churned, **row):
    """n users with one event, the first ``churned`` of whom cancel."""
    return [{"userId": f"{prefix}{i}", **row, **(CANCEL if i < churned else {})} for i in range(n)]


def test_gender_rates(make_log):
    log = make_log(*users("m", 250, 54, gender="M"), *users("f", 198, 45, gender="F"))
    rates = segments.churn_rate(log, "gender").collect()
    assert [(r.category, r.churn_rate) for r in rates] == [("M", 21.6), ("F", 22.727272727272727)]


def test_users_count_in_every_level_they_had(make_log):
    free_only, both, paid_only = 127, 243, 78
    log = make_log(
        *users("f", free_only, 24, level="free"),
        *users("b", both, 58, level="free"),
        *users("b", both, 58, level="paid"),
        *users("p", paid_only, 17, level="paid"),
    )
    rates = {r.category: r for r in segments.churn_rate(log, "level").collect()}
    assert rates["free"].churners + rates["free"].non_churners == 370
    assert rates["paid"].churners + rates["paid"].non_churners == 321
    assert rates["free"].churn_rate == pytest.approx(22.162162162162161)
    assert rates["paid"].churn_rate == pytest.approx(23.364485981308412)


def test_status_rates_and_missing_category(make_log):
    # Of the 99 who cancel, u59 to u98 also met an error.
    errors = [{"userId": f"u{i}", "status": 404} for i in range(59, 59 + 223)]
    log = make_log(*users("u", 448, 99, status=200), *errors, {"userId": "u0", "status": None})
    rates = {r.category: r.churn_rate for r in segments.churn_rate(log, "status", sort_by_users=False).collect()}
    assert rates == {"200": 100.0 * 99 / 448, "404": 100.0 * 40 / 223}


def test_flagged_log_equals_window_over_user(make_log):
    log = make_log(
        *[{"userId": "busy", "ts": i, "page": "Submit Downgrade" if i % 50 == 0 else "Home"} for i in range(300)],
        {"userId": "busy", "ts": 5, **CANCEL},
        *[{"userId": f"u{i}", "ts": i} for i in range(20)],
        {"userId": "u3", "page": "Submit Downgrade"},
    )
    w = Window.partitionBy("userId")
    expected = log.select(
        "userId", "ts", "page",
        F.max(labels.page_flag("Cancellation Confirmation")).over(w),
        F.sum(labels.page_flag("Submit Downgrade")).over(w),
    )
    got = labels.churn_flagged_log(log)
    assert rows(got, "userId", "ts", "page", "churn", "downgrade_count") == rows(expected)


def test_hot_key_is_spread_and_nothing_is_lost(spark):
    log = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 1000 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 997)).alias("k"),
        F.col("id").alias("ts"),
    )
    lookup = log.where("k is not null").select("k").distinct().withColumn("v", F.length("k"))
    sizes = log.where("k is not null").groupBy("k").agg(F.count("*").alias("n"))
    # A third of the rows is a little more than ten quarters of eight partitions.
    assert rows(hot_keys(sizes, "k")) == [("hot", 11)]
    inner = join_on_skewed_key(log, lookup, "k", ["ts"])
    salted = inner._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in salted and "_parts" in salted
    assert rows(inner, "k", "ts", "v") == rows(log.join(lookup, "k"), "k", "ts", "v")
    left = join_on_skewed_key(log, lookup, "k", ["ts"], how="left")
    assert left.count() == 20_000 and left.where("v is null").count() == log.where("k is null").count()


def test_user_labels(make_log):
    log = make_log(
        {"userId": "a", **CANCEL}, {"userId": "a", "page": "Submit Downgrade"},
        {"userId": "b", "page": "Submit Downgrade"}, {"userId": "b", "page": "Submit Downgrade"}, {"userId": "c"},
    )
    assert rows(labels.churn_labels(log)) == [("a", 1), ("b", 0), ("c", 0)]
    assert rows(labels.cancelled_and_downgraded(log)) == [("a",)]
    assert rows(labels.downgrade_logs(log)) == [(0, 0, 1), (0, 2, 2), (1, 1, 2)]
    assert rows(labels.downgrade_users(log)) == [(0, 0, 1), (0, 2, 1), (1, 1, 1)]
    assert rows(labels.churn_summary(log)) == [(3, 1, 2, 1, 33.3)]


def test_page_mix_leaves_out_one_sided_pages(make_log):
    log = make_log(
        {"userId": "a", **CANCEL}, {"userId": "a", "page": "Home"}, {"userId": "a", "page": "Help"},
        {"userId": "b", "page": "Home"}, {"userId": "b", "page": "Home"}, {"userId": "b", "page": "Help"},
        {"userId": "b", "page": "About"},
    )
    mix = {r.page: r for r in segments.page_mix(log).collect()}
    assert set(mix) == {"Home", "Help"}
    assert (mix["Home"].ratio_churners, mix["Home"].ratio_non_churners) == (50.0, 100.0 * 2 / 3)
    for share in ("ratio_churners", "ratio_non_churners"):
        assert sum(r[share] for r in mix.values()) == pytest.approx(100.0)
    assert segments.page_mix(log, digits=0).where("page = 'Help'").first().ratio_churners == 50.0


def test_counts_by_category(make_log):
    log = make_log({"userId": "a"}, {"userId": "a"}, {"userId": "b", "level": "paid"})
    assert rows(segments.log_counts(log, ["level", "gender"])) == [
        ("gender", "M", 3), ("level", "free", 2), ("level", "paid", 1)
    ]
    assert rows(segments.user_counts(log, ["level"])) == [("level", "free", 1), ("level", "paid", 1)]
    flagged = log.unionByName(make_log({"userId": "b", "level": "paid", **CANCEL}))
    assert rows(segments.churn_log_counts(flagged, ["level"])) == [("level", "free", 0, 2), ("level", "paid", 1, 2)]


def test_many_reports_agree_with_single_ones(make_log):
    log = make_log(*users("m", 30, 7, gender="M"), *users("f", 20, 3, level="paid", gender="F"))
    together = segments.churn_rates(log, ["gender", "level"])
    for feature in ("gender", "level"):
        alone = segments.churn_rate(log, feature)
        assert rows(together.where(F.col("feature") == feature).drop("feature")) == rows(alone)
    assert by_user(labels.mark_churn(log.select("userId").distinct(), log))["m0"].churn == 1
