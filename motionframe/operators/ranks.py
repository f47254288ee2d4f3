"""Values by rank, exactly and without a sort, by radix selection over all groups and ranks at once.

Numbers are cut into cells that rise with them: first 256 cells an octave and sign, then 65,536 cells of equal width within the
cell that holds a rank, then the values themselves. Each level counts the rows of each cell, adds the counts up in order,
and goes on within the cells that hold a rank. What is shuffled are counts; a group's counts of one level, 65,536 or the
cells that its numbers are in, are the most that a task has of it. Cells decide what is counted alone: the values found
are exact, also where doubles tell longs or decimals apart too little.

Nulls are left out; NaN is above all numbers. Null groups are a group of their own. The rows (group and value alone) are
written once, and read three times.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motionframe.session import written

OCTAVE, CELLS = 256, 1 << 16
#: Over the logarithm's cells of the least double.
_LEAST = 1075 * OCTAVE


def _cell(x: Column) -> Column:
    """The first level's cell of a double."""
    size = F.abs(x)
    far = F.when(F.isnan(x) | (size == float("inf")), F.lit(float(_LEAST))).when(size == 0, F.lit(-float(_LEAST))).otherwise(F.floor(F.log2(size) * OCTAVE))
    up = far.cast("int") + _LEAST
    return F.when(F.isnan(x), F.lit(2 * _LEAST + 1)).when(x < 0, -up).otherwise(up)


def _within(x: Column) -> Column:
    """The second level's cell, between __lo and __hi."""
    share = (x - F.col("__lo")) / (F.col("__hi") - F.col("__lo"))
    return F.when(F.col("__hi") > F.col("__lo"), F.least(F.floor(share * CELLS), F.lit(CELLS))).otherwise(F.lit(0)).cast("int")


def _running(counts: DataFrame, by: list[str], order: str) -> DataFrame:
    """counts with __before and __upto, the rows of lesser cells without and with the cell's own."""
    upto = F.sum("__m").over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return counts.withColumn("__upto", upto).withColumn("__before", upto - F.col("__m"))


def values_at(df: DataFrame, value: str, by: list[str], ranks: dict[str, Callable[[Column], Column]], size: str | None = None) -> DataFrame:
    """One row for each group: for each name the value at the rank (from 0) that its function gives for the group's size.

    Under the name `size`, if one is given, the group's number of values. Groups without values have no row; a rank beyond
    the group's size gives null.
    """
    x = F.col("__v").cast("double")
    key = F.struct(*by) if by else F.struct(F.lit(1).alias("__one"))
    rows = written(df.where(F.col(value).isNotNull()).select(key.alias("__key"), F.col(value).alias("__v")), "values").withColumn("__b", _cell(x))
    per = rows.groupBy("__key", "__b").agg(F.count(F.lit(1)).alias("__m"), F.min(x).alias("__lo"), F.max(x).alias("__hi"))
    per = _running(per, ["__key"], "__b").withColumn("__n", F.sum("__m").over(Window.partitionBy("__key")))
    named = {**ranks, None: lambda n: F.lit(0)}  # rank 0 is there in every group
    asked = F.array(*(F.struct(F.lit(name).cast("string").alias("__name"), rank(F.col("__n")).cast("long").alias("__rank")) for name, rank in named.items()))
    held = (F.col("__before") <= F.col("__rank")) & (F.col("__rank") < F.col("__upto"))
    one = written(per.select("__key", "__b", "__lo", "__hi", "__n", "__before", "__upto", F.inline(asked)).where(held), "cells")
    cells = one.select("__key", "__b", "__lo", "__hi").distinct()
    inner = rows.join(cells, ["__key", "__b"]).withColumn("__c", _within(x))
    two = _running(inner.groupBy("__key", "__b", "__c").agg(F.count(F.lit(1)).alias("__m")), ["__key", "__b"], "__c")
    left = one.select("__key", "__b", "__lo", "__hi", "__n", "__name", (F.col("__rank") - F.col("__before")).alias("__rank"))
    two = written(left.join(two, ["__key", "__b"]).where(held), "cells")
    few = rows.join(two.select("__key", "__b", "__lo", "__hi").distinct(), ["__key", "__b"]).withColumn("__c", _within(x)).join(two.select("__key", "__b", "__c").distinct(), ["__key", "__b", "__c"])
    last = _running(few.groupBy("__key", "__b", "__c", "__v").agg(F.count(F.lit(1)).alias("__m")), ["__key", "__b", "__c"], "__v")
    left = two.select("__key", "__b", "__c", "__n", "__name", (F.col("__rank") - F.col("__before")).alias("__rank"))
    found = left.join(last, ["__key", "__b", "__c"]).where(held)
    out = found.groupBy("__key").agg(*(F.max(F.when(F.col("__name") == name, F.col("__v"))).alias(name) for name in ranks), F.max("__n").alias("__n"))
    return out.select(*(F.col(f"__key.{c}").alias(c) for c in by), *ranks, *([F.col("__n").alias(size)] if size else []))


def percentiles(df: DataFrame, value: str, by: list[str], named: dict[str, float]) -> DataFrame:
    """One row for each group: percentiles with linear interpolation between neighbours."""
    ranks: dict[str, Callable[[Column], Column]] = {}
    for name, p in named.items():
        ranks[f"__lo_{name}"] = lambda n, p=p: F.floor((n - 1) * p)
        ranks[f"__hi_{name}"] = lambda n, p=p: F.ceil((n - 1) * p)
    found = values_at(df, value, by, ranks, "__size")
    x = lambda p: (F.col("__size") - 1) * p
    lo, hi = lambda c: F.col(f"__lo_{c}").cast("double"), lambda c: F.col(f"__hi_{c}").cast("double")
    return found.select(*by, *((lo(c) + (hi(c) - lo(c)) * (x(p) - F.floor(x(p)))).alias(c) for c, p in named.items()))
