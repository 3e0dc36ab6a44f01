"""Cleaning policies and derived event columns."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsewise import functions as L


def clean(log: DataFrame, policy: str = "identified") -> DataFrame:
    """Rows that belong to a known user and session.

    ``identified`` drops anonymous rows (null or empty userId). ``named`` asks for a first name
    instead of a non-empty userId and then drops the name columns.
    """
    known = log.dropna(how="any", subset=["userId", "sessionId"])
    if policy == "identified":
        return known.where(F.col("userId") != "")
    if policy == "named":
        return known.where(F.col("firstName").isNotNull()).drop("firstName", "lastName")
    raise ValueError(f"unknown cleaning policy: {policy}")


def with_time_columns(log: DataFrame) -> DataFrame:
    ts = F.col("ts")
    return log.withColumns(
        {
            "time": L.time_text(ts),
            "registration_time": L.time_text(F.col("registration")),
            "date": L.date_text(ts),
            "registration_date": L.date_text(F.col("registration")),
            "hour": L.hour_of_day(ts),
            "day": L.day_of_month(ts),
            "weekday": L.weekday(ts),
        }
    )


def with_place_columns(log: DataFrame) -> DataFrame:
    return log.withColumns({"city": L.city(F.col("location")), "state": L.state(F.col("location"))})


def with_agent_columns(log: DataFrame) -> DataFrame:
    return log.withColumns({"device": L.device(F.col("userAgent")), "browser": L.browser(F.col("userAgent"))})


def with_account_age(log: DataFrame) -> DataFrame:
    """Whole days between registration and the event."""
    return log.withColumn("days_since_registration", L.whole_days_between(F.col("registration"), F.col("ts")))


def clean_log(log: DataFrame) -> DataFrame:
    """Identified rows with time, place and agent columns, without the columns those replace."""
    identified = clean(log).drop("firstName", "lastName")
    derived = with_agent_columns(with_place_columns(with_time_columns(identified)))
    return derived.drop("location", "userAgent")
