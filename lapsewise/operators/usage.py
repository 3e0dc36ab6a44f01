"""How a user's events spread over the values of a category, one column per value."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapsewise.operators.categories import Category, find, listed


def usage_table(
    log: DataFrame,
    category: Column,
    values: list[str] | Category | None = None,
    kind: str = "ratio",
    name: Callable[[str], str] = str,
) -> DataFrame:
    """Per user, the share (``ratio``) or number (``count``) of events in each category value.

    Conditional counts in one aggregation: one shuffle of per-user counters, where counting, a
    window for the total and a pivot would take three. Without ``values`` they are looked up first, the
    commonest getting columns and the others one for the rest. Shares are of all events with a category.
    """
    if values is None:
        values = find(log, {"value": (category, [], name)})["value"]
    columns = values if isinstance(values, Category) else listed(values, name)
    tagged = log.select("userId", category.alias("_category"))
    counts = tagged.groupBy("userId").agg(F.count("_category").alias("_total"), *columns.counts(F.col("_category")))
    if kind == "count":
        return counts.select("userId", *columns.names)
    if kind == "ratio":
        return counts.select("userId", *[share(c, "_total").alias(c) for c in columns.names])
    raise ValueError(f"unknown usage kind: {kind}")


def share(part: str, total: str) -> Column:
    return F.coalesce(F.try_divide(F.col(part).cast("double"), F.col(total)), F.lit(0.0))
