"""Physical plans of all queries: nothing leaves the JVM, nothing is crossed with everything."""

import pytest
from conftest import DATA

import __spark_entry__ as entry
from checks import oracle
from lapsewise.operators import labels, segments
from lapsewise.operators.cleaning import clean
from lapsewise.plans import catalog
from lapsewise.sources import activity_log

SF = f"{DATA}/sf0.01"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# The numbered training-data operators choose their style freely; their own tests look at them.
@pytest.mark.parametrize("name", sorted(set(oracle.oracle_sql()) - {"feature_correlation", "correlated_features_dropped"}))
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    for bad in ("CartesianProduct", "NestedLoop", "PythonUDF", "ArrowEval", "BatchEval", "MapInPandas"):
        assert bad not in plan, (name, bad)


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_only_the_hot_keys_are_broadcast_for_the_flagged_log(spark, no_broadcast):
    log = clean(activity_log(spark, SF, profile=False))
    plan = plan_of(labels.churn_flagged_log(log))
    # The list of hot keys goes to both sides; the log meets the flags in a salted sort-merge join.
    assert plan.count("BroadcastHashJoin") == 2 and plan.count("SortMergeJoin") == 1
    assert "- Window [" not in plan and "_salt" in plan


def test_cancellations_are_filtered_in_the_scan(spark):
    log = spark.read.parquet(_as_log_table(spark))
    plan = plan_of(segments.churn_rate(log, "gender"))
    assert "EqualTo(page,Cancellation Confirmation)" in plan
    assert "ReadSchema: struct<userId:string,gender:string>" in plan


def test_queries_without_profile_columns_do_not_read_customers(spark):
    assert "customer.parquet" not in plan_of(catalog.queries()["churn_rate_hour"](spark, SF))
    assert "customer.parquet" in plan_of(catalog.queries()["churn_rate_state"](spark, SF))


def _as_log_table(spark) -> str:
    from lapsewise.storage import new_path

    path = new_path(spark, "log-test")
    activity_log(spark, f"{DATA}/sf0.001").write.parquet(path)
    return path


def test_reports_read_what_they_derived_once(spark):
    """After the derivation the statistics come from written values, not from the log again."""
    from lapsewise.operators import numeric
    from lapsewise.operators.cleaning import clean
    from lapsewise.sources import activity_log

    log = clean(activity_log(spark, "/root/testdata/sf0.001", profile=False))
    reports = [
        numeric.numeric_summary(log), numeric.length_by_churn(log), numeric.page_box_stats(log),
        numeric.box_stats(numeric.activity_long(log), ["metric"], "value"),
        numeric.histogram(numeric.activity_long(log), {"interactions": 5, "sessions": 5, "session_minutes": 5}, by=None),
    ]
    for report in reports:
        assert not any("events.parquet" in f for f in report.inputFiles())
