"""KPI, trends, alerts: rates, percentiles by rank, sliding windows, cooldowns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motionframe.functions.scalar import kpi_status, micros, ratio
from motionframe.operators.alerts import fired
from motionframe.operators.ranges import running_sums
from motionframe.operators.ranks import percentiles, values_at

# Name, kind, warning, critical.
STANDARD_KPIS = [
    ("pipeline_throughput", "throughput", 100.0, 50.0),
    ("pipeline_error_rate", "error_rate", 5.0, 10.0),
    ("pipeline_success_rate", "success_rate", 95.0, 90.0),
    ("pipeline_p50_latency", "latency", 10.0, 30.0),
    ("pipeline_p95_latency", "latency", 30.0, 60.0),
    ("pipeline_p99_latency", "latency", 60.0, 120.0),
    ("storage_usage", "efficiency", 100.0, 500.0),
    ("storage_cost_monthly", "cost", 100.0, 500.0),
    ("queue_depth", "throughput", 1000.0, 5000.0),
    ("worker_utilization", "efficiency", 30.0, 10.0),
]
# Rule, metric, threshold, severity.
ALERT_RULES = [("high_error_rate", "error_rate", 10.0, "critical"), ("queue_backlog", "queue_depth", 5000.0, "warning"), ("high_latency", "p95_latency", 60.0, "warning"), ("disk_usage", "disk_percent", 90.0, "critical")]


def throughput(count: Column, seconds: Column, unit_seconds: float = 3600.0) -> Column:
    return ratio(count, seconds, 0.0, unit_seconds)


def error_rate(errors: Column, total: Column) -> Column:
    return ratio(errors, total, 0.0, 100.0)


def success_rate(ok: Column, total: Column) -> Column:
    return ratio(ok, total, 100.0, 100.0)


def availability(up: Column, total: Column) -> Column:
    return ratio(up, total, 100.0, 100.0)


def rank_percentiles(df: DataFrame, value: str, percents: list[float], by: list[str]) -> DataFrame:
    """sorted[min(int(n * p), n - 1)] of each group for each p."""
    return values_at(df, value, by, {f"p{p * 100:g}": lambda n, p=p: F.least(F.floor(n * p), n - 1) for p in percents})


def aggregate(df: DataFrame, value: str, method: str) -> DataFrame:
    """sum, avg, min, max, count, or p50, p90, p95, p99 by rank; 0 when empty; any other name is the mean."""
    if method in ("p50", "p90", "p95", "p99"):
        got = rank_percentiles(df, value, [int(method[1:]) / 100], [])
        return got.agg(F.coalesce(F.max(method), F.lit(0.0)).alias("value"))
    f = {"sum": F.sum, "min": F.min, "max": F.max, "count": lambda c: F.count(c).cast("double")}.get(method, F.avg)
    return df.agg(F.coalesce(f(value), F.lit(0.0)).alias("value"))


def quality_stats(episodes: DataFrame, passed: float = 0.7) -> DataFrame:
    """Counts and share that passes, means, sample deviation of confidence and p95 of jitter; zeros are left out of the last two."""
    good = F.count_if(F.col("quality_score") >= passed)
    length = [F.coalesce(F.avg("duration_frames"), F.lit(0.0)).alias("mean_length")] if "duration_frames" in episodes.columns else []
    w = episodes.agg(F.count(F.lit(1)).alias("total"), good.alias("passed"), (F.count(F.lit(1)) - good).alias("failed"), *length, ratio(F.count_if(F.col("quality_score") >= passed), F.count(F.lit(1))).alias("pass_rate"), F.coalesce(F.avg("confidence_score"), F.lit(0.0)).alias("mean_confidence"), F.coalesce(F.avg("jittering_score"), F.lit(0.0)).alias("mean_jitter"), F.coalesce(F.stddev_samp(F.when(F.col("confidence_score") != 0, F.col("confidence_score"))), F.lit(0.0)).alias("std_confidence"))
    return w.crossJoin(aggregate(episodes.where("jittering_score != 0"), "jittering_score", "p95").withColumnRenamed("value", "p95_jitter"))  # one row each


def stage_table(jobs: DataFrame) -> DataFrame:
    """One row for each stage: outcomes, in flight, queue and p95 of seconds by rank."""
    n = lambda *s: F.count_if(F.col("status").isin(*s))
    counts = jobs.groupBy("stage").agg(n("completed").alias("success"), n("failed").alias("fail"), n("skipped").alias("skip"), n("running").alias("inflight"), n("pending", "queued").alias("queue"))
    return counts.join(rank_percentiles(jobs.where("status = 'completed'"), "processing_sec", [0.95], ["stage"]), "stage", "left").withColumn("p95", F.coalesce("p95", F.lit(0.0)))


def sliding_rate(events: DataFrame, label: str, at: str, length: str, step: str, seconds: float) -> DataFrame:
    """Events of each label and second in sliding windows."""
    w = F.window(at, length, step)
    return events.groupBy(w.alias("w"), label).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), label, "n", (F.col("n") / seconds).alias("rate"))


def trend(metrics: DataFrame, as_of: Column, periods: int, hours: int) -> DataFrame:
    """Means over the last periods of `hours` back from as_of; period 0 is the newest."""
    p = F.floor((micros(as_of) - micros("ts")) / (hours * 3_600_000_000)).cast("int")
    return metrics.withColumn("period", p).where((F.col("period") >= 0) & (F.col("period") < periods)).groupBy("name", "period").agg(F.avg("value").alias("value"), F.count(F.lit(1)).alias("n"))


def inflight(jobs: DataFrame) -> DataFrame:
    """Jobs in flight after each start and end of a stage."""
    delta = jobs.select("stage", F.explode(F.array(F.struct(F.col("started_at").alias("ts"), F.lit(1).alias("d")), F.struct(F.col("completed_at").alias("ts"), F.lit(-1).alias("d")))).alias("e")).select("stage", "e.ts", "e.d").where("ts is not null")
    per = delta.groupBy("stage", "ts").agg(F.sum("d").alias("d"))
    return running_sums(per, ["stage"], ["ts"], inflight=F.col("d")).select("stage", "ts", "inflight")


def job_events(jobs: DataFrame) -> DataFrame:
    """A row for each start and end of a job: ts, event, and at the end its outcome and seconds."""
    start = F.struct(F.col("started_at").alias("ts"), F.lit("start").alias("event"), F.lit(None).cast("string").alias("outcome"), F.lit(None).cast("double").alias("seconds"))
    took = (micros("completed_at") - micros("started_at")) / 1e6
    end = F.struct(F.col("completed_at").alias("ts"), F.lit("end").alias("event"), F.col("status").alias("outcome"), took.cast("double").alias("seconds"))
    return jobs.select("job_key", "stage", F.inline(F.array(start, end))).where("ts is not null")


def newest(df: DataFrame, at: str, n: int, tie: str) -> DataFrame:
    """A bounded history: the newest n rows."""
    return df.orderBy(F.col(at).desc(), tie).limit(n)


def to_free(files: DataFrame, needed: int) -> DataFrame:
    """The oldest files that together free `needed` bytes. Days are summed first, so only files of the days needed are sorted."""
    day = F.to_date("modified_at")
    days = files.groupBy(day.alias("__day")).agg(F.sum("size_bytes").alias("__b"))
    before = days.select("__day", F.coalesce(F.sum("__b").over(Window.orderBy("__day").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))  # one row a day
    rows = files.withColumn("__day", day).join(before.where(F.col("__before") < needed), "__day")
    rows = running_sums(rows, [], ["modified_at", "key"], __upto=F.col("size_bytes"))
    rows = rows.withColumn("bytes_before", F.col("__upto") - F.col("size_bytes"))
    return rows.where(F.col("bytes_before") < needed).drop("__day", "__before", "__upto")


def with_status(values: DataFrame) -> DataFrame:
    """KPI values (name, value) with the status that their thresholds give."""
    spark = values.sparkSession
    known = spark.createDataFrame(STANDARD_KPIS, "name string, kind string, warning double, critical double")
    return values.join(F.broadcast(known), "name", "left").withColumn("status", kpi_status(F.col("kind"), F.col("value"), F.col("warning"), F.col("critical")))


def by_status(kpis: DataFrame, status: str | None = None, kind: str | None = None) -> DataFrame:
    if status:
        kpis = kpis.where(F.col("status") == status)
    return kpis.where(F.col("kind") == kind) if kind else kpis


def firing(context: DataFrame, rules: list[tuple] = ALERT_RULES) -> DataFrame:
    """Rows (ts, rule, severity, value) for each rule whose metric is over its threshold. context has a column for each metric."""
    each = F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(s).alias("severity"), F.col(m).cast("double").alias("value"), (F.col(m) > t).alias("on")) for r, m, t, s in rules if m in context.columns))
    return context.select("ts", F.inline(each)).where("on").drop("on")


def custom_firing(context: DataFrame, name: str, condition: str, severity: str = "warning") -> DataFrame:
    """A rule whose condition is an SQL expression over the context."""
    return context.where(F.expr(condition)).select("ts", F.lit(name).alias("rule"), F.lit(severity).alias("severity"))


def cooled(alerts: DataFrame, seconds: float, rule: str = "rule", at: str = "ts") -> DataFrame:
    """Alerts that fire: at least `seconds` after the last of the rule that fired. `alerts.fired` has silences and force too."""
    return fired(alerts, seconds, rule, at)


def histogram_rows(summary: DataFrame) -> DataFrame:
    """One row of numbers as (metric, value) rows."""
    cols = [F.col(c).cast("double").alias(c) for c in summary.columns]
    return summary.select(*cols).unpivot([], summary.columns, "metric", "value")


def weekly_quality(episodes: DataFrame, high: float = 0.7) -> DataFrame:
    week = F.date_trunc("week", "created_at").alias("week")
    rows = episodes.select(week, "quality_score", "confidence_score", "jittering_score", "interpolated_ratio")
    out = rows.groupBy("week").agg(F.count(F.lit(1)).alias("episodes"), F.count_if(F.col("quality_score") >= high).alias("high_quality"))
    for column, named in (("confidence_score", {"conf_p50": 0.5, "conf_p90": 0.9}), ("jittering_score", {"jitter_p90": 0.9}), ("interpolated_ratio", {"interpolated_p90": 0.9})):
        out = out.join(percentiles(rows, column, ["week"], named), "week", "left")
    return out
