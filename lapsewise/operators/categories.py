"""Categories that become columns: which values a log holds, and what their columns are called.

Listed values always get a column. Values found beside them get one each, the commonest first, up to ``MOST_FOUND``;
what is left goes into one column for the rest, so that no event disappears.
"""

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Columns for values that are not listed, at most.
MOST_FOUND = 40


@dataclass(frozen=True)
class Category:
    """Column of each value; ``rest`` is the column of all other values, None if there are none."""

    columns: dict[str, str] = field(default_factory=dict)
    rest: str | None = None

    @property
    def names(self) -> list[str]:
        return list(dict.fromkeys(self.columns.values())) + ([self.rest] if self.rest else [])

    def counts(self, value: Column) -> list[Column]:
        """One count per column, to be used next to other aggregates of the same groupBy."""
        of = {}
        for v, column in self.columns.items():
            of.setdefault(column, []).append(v)
        out = [F.count_if(value.isin(vs) if len(vs) > 1 else value == vs[0]).alias(c) for c, vs in of.items()]
        if self.rest:
            out.append(F.count_if(~value.isin(list(self.columns)) if self.columns else value.isNotNull()).alias(self.rest))
        return out


def listed(values: list[str], name: Callable[[str], str] = str) -> Category:
    """Columns for the listed values alone."""
    return Category({v: name(v) for v in values})


def found_values(log: DataFrame, categories: dict[str, Column], most: int) -> dict[str, list[str]]:
    """The ``most`` commonest values of each category and one more, commonest first, from one pass."""
    values = F.explode(F.array(*[F.struct(F.lit(n).alias("category"), c.cast("string").alias("value")) for n, c in categories.items()]))
    counts = log.select(values.alias("e")).select("e.*").where("value is not null").groupBy("category", "value").count()
    place = F.row_number().over(Window.partitionBy("category").orderBy(F.desc("count"), "value"))
    top = counts.withColumn("place", place).where(F.col("place") <= most + 1).orderBy("category", "place").collect()
    return {n: [r.value for r in top if r.category == n] for n in categories}


def find(
    log: DataFrame,
    categories: dict[str, tuple[Column, list[str], Callable[[str], str]]],
    taken: list[str] = (),
    most: int | None = None,
) -> dict[str, Category]:
    """Each category (value, listed values, column name of a value) with the values that the log holds beside the listed.

    Column names are made of letters, digits and underscores. A found value whose column name is that of a column of
    another category, or among ``taken``, gets the category's name in front; values of one category with the same
    column name share the column.
    """
    most = MOST_FOUND if most is None else most
    known = {n: {v: name(v) for v in values} for n, (_, values, name) in categories.items()}
    room = most + max((len(k) for k in known.values()), default=0)
    seen = found_values(log, {n: c for n, (c, _, _) in categories.items()}, room)
    used = {c.lower() for c in taken}
    out = {}
    for n, (_, _, name) in categories.items():
        others = used | {c.lower() for m, k in known.items() if m != n for c in k.values()}
        columns, extra = dict(known[n]), [v for v in seen[n] if v not in known[n]]
        for v in extra[:most]:
            column = re.sub(r"\W+", "_", name(v)) or "empty"
            columns[v] = f"{n}_{column}" if column.lower() in others else column
        rest = f"{n}_rest" if len(extra) > most or len(seen[n]) > room else None
        out[n] = Category(columns, rest)
        used |= {c.lower() for c in out[n].names}
    return out


SCHEMA = "category string, value string, column string, position int"


def to_table(spark: SparkSession, categories: dict[str, Category]) -> DataFrame:
    """(category, value, column, position); the rest has no value."""
    rows = []
    for n, c in categories.items():
        entries = list(c.columns.items()) + ([(None, c.rest)] if c.rest else [])
        rows += [(n, v, column, i) for i, (v, column) in enumerate(entries)]
    return spark.createDataFrame(rows, SCHEMA).coalesce(1)


def from_table(table: DataFrame) -> dict[str, Category]:
    rows: dict[str, list] = {}
    for r in table.orderBy("category", "position").collect():  # as many rows as columns
        rows.setdefault(r.category, []).append(r)
    return {
        n: Category({r.value: r.column for r in rs if r.value is not None}, next((r.column for r in rs if r.value is None), None))
        for n, rs in rows.items()
    }
