"""Column profiles, drift, data checks and their reports, for any DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from motionframe.operators.ranks import percentiles
from motionframe.session import written

_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def _is_number(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, _NUMBERS)


def missing(df: DataFrame, c: str) -> Column:
    """Null, or not a number."""
    return F.col(c).isNull() | F.isnan(c) if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)) else F.col(c).isNull()


def column_types(df: DataFrame) -> DataFrame:
    """(column, kind, n, n_null, n_unique): boolean, numeric, datetime, categorical (few values) or text."""
    cols = df.columns
    one = df.agg(F.count(F.lit(1)).alias("n"), *(F.count_if(missing(df, c)).alias(f"null_{i}") for i, c in enumerate(cols)), *(F.count_distinct(F.when(~missing(df, c), F.col(c))).alias(f"unique_{i}") for i, c in enumerate(cols)))

    def kind(i: int, c: str) -> Column:
        d = df.schema[c].dataType
        if isinstance(d, T.BooleanType):
            return F.lit("boolean")
        if isinstance(d, _NUMBERS):
            return F.lit("numeric")
        if isinstance(d, (T.TimestampType, T.DateType, T.TimestampNTZType)):
            return F.lit("datetime")
        u, n = F.col(f"unique_{i}"), F.col("n") - F.col(f"null_{i}")
        return F.when((u < n * 0.5) & (u <= 50), "categorical").otherwise("text")

    rows = F.array(*(F.struct(F.lit(c).alias("column"), kind(i, c).alias("kind"), F.col("n"), F.col(f"null_{i}").alias("n_null"), F.col(f"unique_{i}").alias("n_unique")) for i, c in enumerate(cols)))
    return one.select(F.inline(rows))


def _long(df: DataFrame, cols: list[str], kind: str) -> DataFrame:
    return df.select(F.inline(F.array(*(F.struct(F.lit(c).alias("column"), F.when(~missing(df, c), F.col(c)).cast(kind).alias("v")) for c in cols)))).where("v is not null")


def numeric_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Counts, moments and exact quartiles of each column, all columns in the same passes. Skew and kurtosis are the population's."""
    rows = written(_long(df, cols or [c for c in df.columns if _is_number(df, c)], "double"), "numbers")
    out = rows.groupBy("column").agg(F.count("v").alias("n"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max"), F.skewness("v").alias("skew"), F.kurtosis("v").alias("kurtosis"), F.count_if(F.col("v") == 0).alias("zeros"), F.count_if(F.col("v") < 0).alias("negatives"))
    quartiles = percentiles(rows, "v", ["column"], {"median": 0.5, "q1": 0.25, "q3": 0.75})
    return out.join(quartiles, "column").withColumn("iqr", F.col("q3") - F.col("q1"))


def value_counts(df: DataFrame, cols: list[str], top: int = 20) -> DataFrame:
    """(column, value, n, rank): the most frequent values of each column."""
    from pyspark.sql import Window

    counts = _long(df, cols, "string").groupBy("column", F.col("v").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("rank", F.row_number().over(Window.partitionBy("column").orderBy(F.col("n").desc(), "value"))).where(F.col("rank") <= top)


def categorical_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    counts = _long(df, cols, "string").groupBy("column", "v").agg(F.count(F.lit(1)).alias("c"))
    first = F.min(F.struct((-F.col("c")).alias("c"), F.col("v")))
    return counts.groupBy("column").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("n_unique"), first["v"].alias("top"), (-first["c"]).alias("freq"))


def text_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    size = F.length("v")
    return _long(df, cols, "string").groupBy("column").agg(F.avg(size).alias("avg_length"), F.min(size).alias("min_length"), F.max(size).alias("max_length"), F.count_if(F.trim("v") == "").alias("n_empty"), F.count_distinct("v").alias("n_unique"))


def profile(df: DataFrame, sample: int | None = None, seed: int = 42) -> dict[str, DataFrame]:
    """Types and row counts of all rows; the other statistics of all, or of a repeatable sample of that many rows."""
    part = df if sample is None else df.orderBy(F.xxhash64(F.lit(seed), *df.columns)).limit(sample)
    text = [c for c in df.columns if isinstance(df.schema[c].dataType, T.StringType)]
    out = {"columns": column_types(df), "numeric": numeric_profile(part)}
    return out | ({"categorical": categorical_profile(part, text), "text": text_profile(part, text)} if text else {})


def drift(base: DataFrame, now: DataFrame) -> DataFrame:
    """Two tables (column, kind, n, n_null, mean, std) compared: what changed in each column."""
    a, b = (x.select("column", *(F.col(c).alias(f"{c}_{s}") for c in ("kind", "n", "n_null", "mean", "std"))) for x, s in ((base, "a"), (now, "b")))
    both = a.join(b, "column", "full_outer")
    ratio = lambda s: F.coalesce(F.try_divide(F.col(f"n_null_{s}"), F.col(f"n_{s}")), F.lit(0.0))
    moved = lambda c, most: F.abs(F.col(f"{c}_b") - F.col(f"{c}_a")) > F.abs(F.col(f"{c}_a")) * most
    changes = F.array_compact(F.array(
        F.when(F.col("kind_a").isNull(), "added"), F.when(F.col("kind_b").isNull(), "removed"), F.when(F.col("kind_a") != F.col("kind_b"), "type"),
        F.when(F.col("kind_a").isNotNull() & F.col("kind_b").isNotNull() & (F.abs(ratio("b") - ratio("a")) > 0.05), "null_ratio"), F.when(moved("mean", 0.1), "mean"), F.when(moved("std", 0.2), "std"),
    ))
    return both.select("column", changes.alias("changes"))


# --- checks: each gives one row (check, severity, status, value)


def _result(df: DataFrame, name: str, severity: str, status: Column, value: Column) -> DataFrame:
    return df.select(F.lit(name).alias("check"), F.lit(severity).alias("severity"), status.alias("status"), value.cast("double").alias("value"))


def nan_check(df: DataFrame, most: float = 0.0, cols: list[str] | None = None) -> DataFrame:
    cols = cols or df.columns
    n = df.agg(F.count(F.lit(1)).alias("n"), reduce(lambda a, b: a + b, (F.count_if(missing(df, c)) for c in cols)).alias("bad"))
    value = F.coalesce(F.try_divide(F.col("bad"), F.col("n") * len(cols)), F.lit(0.0))
    return _result(n, "nan", "high", F.when(value > most, "fail").otherwise("pass"), value)


def shape_check(df: DataFrame, min_rows: int | None = None, max_rows: int | None = None, n_columns: int | None = None, required: list[str] = []) -> DataFrame:
    n = F.col("n")
    ok = (n >= (min_rows or 0)) & (n <= (max_rows if max_rows is not None else 2**62))
    ok = ok & F.lit((n_columns is None or n_columns == len(df.columns)) and set(required) <= set(df.columns))
    return _result(df.agg(F.count(F.lit(1)).alias("n")), "shape", "critical", F.when(ok, "pass").otherwise("fail"), n)


def range_check(df: DataFrame, column: str, low: float | None = None, high: float | None = None, allow_nan: bool = True) -> DataFrame:
    if column not in df.columns:
        return _result(df.agg(F.lit(0).alias("n")), f"range:{column}", "medium", F.lit("fail"), F.lit(None))
    v = F.when(~missing(df, column), F.col(column))
    one = df.agg(F.min(v).alias("lo"), F.max(v).alias("hi"), F.count_if(missing(df, column)).alias("nan"))
    bad = F.lit(False)
    if low is not None:
        bad = bad | (F.col("lo") < low)
    if high is not None:
        bad = bad | (F.col("hi") > high)
    status = F.when((F.col("nan") > 0) & F.lit(not allow_nan), "fail").when(F.col("lo").isNull(), "warn").when(bad, "fail").otherwise("pass")
    return _result(one, f"range:{column}", "medium", status, F.col("hi"))


def unique_check(df: DataFrame, cols: list[str], most: float = 0.0) -> DataFrame:
    """All members of groups that are equal in cols count."""
    per = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("c")).agg(F.sum("c").alias("n"), F.sum(F.when(F.col("c") > 1, F.col("c")).otherwise(0)).alias("d"))
    value = F.coalesce(F.try_divide("d", "n"), F.lit(0.0))
    return _result(per, "unique", "high", F.when(value > most, "fail").otherwise("pass"), value)


def type_check(df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """Each expected name is part of the column's type."""
    kinds = dict(df.dtypes)
    bad = [c for c, k in expected.items() if k not in kinds.get(c, "")]
    return _result(df.agg(F.count(F.lit(1)).alias("n")), "type", "medium", F.lit("fail" if bad else "pass"), F.lit(len(bad)))


def custom_check(df: DataFrame, name: str, test: Callable[[DataFrame], Column], severity: str = "medium") -> DataFrame:
    """test gives an aggregate that is true if the data pass."""
    return _result(df.agg(F.coalesce(test(df), F.lit(False)).alias("ok")), name, severity, F.when(F.col("ok"), "pass").otherwise("fail"), F.lit(None))


def suite_report(results: list[DataFrame]) -> DataFrame:
    """passed, failed, warnings, success_pct (100 if there is no check) and overall."""
    rows = reduce(DataFrame.unionByName, results)
    n = lambda s: F.count_if(F.col("status") == s)
    agg = rows.agg(n("pass").alias("passed"), n("fail").alias("failed"), n("warn").alias("warnings"), F.count(F.lit(1)).alias("total"), F.count_if((F.col("status") == "fail") & (F.col("severity") == "critical")).alias("critical"))
    pct = F.coalesce(F.try_divide(F.col("passed") * 100.0, F.col("total")), F.lit(100.0))
    return agg.select("passed", "failed", "warnings", pct.alias("success_pct"), F.when(F.col("critical") > 0, "fail").when(F.col("failed") > 0, "warn").otherwise("pass").alias("overall"))


def period_report(reports: DataFrame, end: Column, days: int) -> DataFrame:
    """Reports (dataset, at, overall, passed, failed) of the days up to end: totals of each dataset, with what failed."""
    rows = reports.where((F.col("at") > end - F.make_interval(days=F.lit(days))) & (F.col("at") <= end))
    return rows.groupBy("dataset").agg(F.count(F.lit(1)).alias("reports"), F.sum("passed").alias("passed"), F.sum("failed").alias("failed"), F.count_if(F.col("overall") != "pass").alias("not_passed"), F.count_if(F.col("overall") == "fail").alias("critical"))


def failed_checks(results: DataFrame, end: Column, days: int, critical: bool = False) -> DataFrame:
    """Of check results (dataset, at, check, severity, status, value) of the days up to end: those that failed, or the critical ones."""
    rows = results.where((F.col("at") > end - F.make_interval(days=F.lit(days))) & (F.col("at") <= end) & (F.col("status") == "fail"))
    return (rows.where("severity = 'critical'") if critical else rows).select("dataset", "check", "severity", "value", "at")
