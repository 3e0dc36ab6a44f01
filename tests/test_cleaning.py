import pytest
from conftest import rows
from pyspark.sql import functions as F

from lapsewise import functions as L
from lapsewise.operators import cleaning


def test_policies_drop_anonymous_and_incomplete_rows(make_log):
    log = make_log(
        {"userId": "a"},
        {"userId": ""},
        {"userId": None},
        {"userId": "b", "sessionId": None},
        {"userId": "c", "firstName": None},
    )
    assert rows(cleaning.clean(log), "userId") == [("a",), ("c",)]
    named = cleaning.clean(log, "named")
    # The named policy looks at the first name, not at the text of the userId.
    assert rows(named, "userId") == [("",), ("a",)]
    assert "firstName" not in named.columns and "lastName" not in named.columns
    with pytest.raises(ValueError):
        cleaning.clean(log, "other")


def test_clean_log_replaces_source_columns(make_log):
    out = cleaning.clean_log(make_log({}))
    assert not {"firstName", "lastName", "location", "userAgent"} & set(out.columns)
    assert {"time", "date", "city", "state", "device", "browser", "hour", "weekday"} <= set(out.columns)


@pytest.mark.parametrize(
    "agent, device, browser",
    [
        ("Mozilla/5.0 (Windows NT 6.1; WOW64) Gecko Safari/537.36", "Windows", "Safari"),
        ("Mozilla/5.0 (iPhone; CPU iPhone OS 7) Firefox/31.0", "iPhone", "Firefox"),
        ("Mozilla/5.0 (compatible; MSIE 9.0; Trident/5.0)", "compatible", "Trident"),
        ("curl/7.0", "unknown", "curl"),
        ("", "unknown", "unknown"),
        (None, "unknown", "unknown"),
    ],
)
def test_agents(make_log, agent, device, browser):
    row = cleaning.with_agent_columns(make_log({"userAgent": agent})).first()
    assert (row.device, row.browser) == (device, browser)


@pytest.mark.parametrize(
    "location, city, state",
    [("New York, NY-NJ", "New York", "NY-NJ"), ("Nowhere", "Nowhere", None), (None, None, None)],
)
def test_places(make_log, location, city, state):
    row = cleaning.with_place_columns(make_log({"location": location})).first()
    assert (row.city, row.state) == (city, state)


def test_times_are_utc_and_monday_is_zero(make_log):
    # 2018-10-01 was a Monday.
    row = cleaning.with_time_columns(make_log({"ts": 1538352061999, "registration": 0})).first()
    assert (row.time, row.date) == ("2018-10-01 00:01:01", "2018-10-01")
    assert (row.hour, row.day, row.weekday) == (0, 1, 0)
    assert row.registration_time == "1970-01-01 00:00:00"


def test_account_age_is_cut_to_whole_days(make_log):
    log = make_log({"registration": 0, "ts": 2 * L.MS_PER_DAY - 1}, {"registration": L.MS_PER_DAY, "ts": 1})
    ages = [r.days_since_registration for r in cleaning.with_account_age(log).collect()]
    assert sorted(ages) == [0, 1]


def test_page_column(make_log):
    log = make_log({"page": "Add to Playlist"})
    assert log.select(L.page_column(F.col("page"))).first()[0] == "page_add_to_playlist"


def test_events_of_unknown_customers_stay(spark, tmp_path):
    from lapsewise.sources import activity_log

    for name in ("nation", "region", "customer"):
        table = spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
        (table.where("c_custkey % 2 = 0") if name == "customer" else table).write.parquet(f"{tmp_path}/{name}.parquet")
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.write.parquet(f"{tmp_path}/events.parquet")
    log = activity_log(spark, str(tmp_path))
    assert log.count() == events.count()
    odd = log.where("userId <> '' and cast(userId as long) % 2 = 1")
    assert odd.count() > 0 and odd.where("firstName is not null or location is not null").count() == 0
