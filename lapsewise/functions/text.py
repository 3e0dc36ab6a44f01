"""Location, user agent and page name expressions. All stay inside whole-stage codegen."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def city(location: Column) -> Column:
    return F.trim(F.get(F.split(location, ","), F.lit(0)))


def state(location: Column) -> Column:
    """Part after the first comma; null if there is none."""
    return F.trim(F.get(F.split(location, ","), F.lit(1)))


def _known(text: Column) -> Column:
    return F.when(text.isNull() | (text == ""), F.lit("unknown")).otherwise(text)


def device(agent: Column) -> Column:
    """First word inside the first parenthesis of a user agent."""
    return _known(F.regexp_extract(agent, r"\(([^;( ]*)", 1))


def browser(agent: Column) -> Column:
    """Product name of the last blank-separated token of a user agent."""
    return _known(F.substring_index(F.substring_index(agent, " ", -1), "/", 1))


def page_column(page: Column) -> Column:
    """'Thumbs Up' -> 'page_thumbs_up'."""
    return F.concat(F.lit("page_"), F.lower(F.replace(page, F.lit(" "), F.lit("_"))))
