"""Running values over groups of any size, in two levels, so that no task holds a group.

Rows are sorted by group and order and cut into ranges of about equal size, wherever a group ends. Running values are taken
within each range; what a range owes to those before it in its group comes from one row a range and group. Of these only
a range's first group goes on from the range before, so there are no more of them than ranges: they are broadcast.

Rows that are equal in group and order stand in one range and in no set order; give an order that tells them apart.
Null groups are a group of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motionframe.session import written


def ranged(df: DataFrame, by: list[str], order: list[Column | str]) -> DataFrame:
    """df in the order of by and order, written once, with __at (rising in that order) and __range."""
    keys = [*by, *order]
    rows = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__at", F.monotonically_increasing_id())
    return written(rows, "ranged").withColumn("__range", F.shiftright("__at", 33))


def _before(rows: DataFrame, by: list[str], totals: dict[str, Column], upto: dict[str, Column]) -> DataFrame:
    """For each range and group that goes on from earlier ranges: what these give, under the names of totals."""
    per = rows.groupBy("__range", *by).agg(F.lit(True).alias("__there"), *(v.alias(f"__total_{n}") for n, v in totals.items()))
    earlier = Window.partitionBy(*by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    found = per.select("__range", *by, F.first("__there").over(earlier).alias("__more"), *(v.over(earlier).alias(f"__before_{n}") for n, v in upto.items()))
    return found.where("__more").drop("__more")


def _with_before(rows: DataFrame, before: DataFrame, by: list[str]) -> DataFrame:
    renamed = before.select(F.col("__range").alias("__r"), *(F.col(c).alias(f"__by{i}") for i, c in enumerate(by)), *(c for c in before.columns if c.startswith("__before_")))
    same = F.col("__range") == F.col("__r")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"__by{i}"))
    return rows.join(F.broadcast(renamed), same, "left").drop("__r", *(f"__by{i}" for i in range(len(by))))  # a row for each range at most


def running_sums(df: DataFrame, by: list[str], order: list[Column | str], **values: Column) -> DataFrame:
    """df and, under each name, the sum of the value over the rows of its group up to this one, this one included."""
    rows = ranged(df.withColumns({f"__v_{n}": v for n, v in values.items()}), by, order)
    before = _before(rows, by, {n: F.sum(f"__v_{n}") for n in values}, {n: F.sum(f"__total_{n}") for n in values})
    within = Window.partitionBy("__range", *by).orderBy("__at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = rows.withColumns({f"__sum_{n}": F.sum(f"__v_{n}").over(within) for n in values})
    out = _with_before(summed, before, by)
    both = {n: F.coalesce(F.col(f"__before_{n}") + F.col(f"__sum_{n}"), f"__sum_{n}", f"__before_{n}") for n in values}
    return out.select(*df.columns, *(v.alias(n) for n, v in both.items()))


def carried(df: DataFrame, by: list[str], order: list[Column | str], **values: Column) -> DataFrame:
    """df and, under each name, the last value that is not null in its group up to this row, this one included."""
    rows = ranged(df.withColumns({f"__v_{n}": v for n, v in values.items()}), by, order)
    last = {n: F.max_by(f"__v_{n}", F.when(F.col(f"__v_{n}").isNotNull(), F.col("__at"))) for n in values}
    before = _before(rows, by, last, {n: F.last(f"__total_{n}", ignorenulls=True) for n in values})
    within = Window.partitionBy("__range", *by).orderBy("__at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = rows.withColumns({f"__last_{n}": F.last(f"__v_{n}", ignorenulls=True).over(within) for n in values})
    out = _with_before(held, before, by)
    return out.select(*df.columns, *(F.coalesce(f"__last_{n}", f"__before_{n}").alias(n) for n in values))
