"""Time alignment: uniform grids, interpolation between the nearest samples on both sides, masks.

Samples and grid points stand in one sorted sequence for each episode, and the nearest sample before and after each grid
point are running last and first values: one shuffle and one sort, whatever the lengths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motionframe.operators.windows import smoothed


def uniform_grid(samples: DataFrame, fps: float, by: str = "episode_id", ts: str = "ts") -> DataFrame:
    """(by, i, ts): ts = first + i / fps, before the last sample."""
    span = samples.groupBy(by).agg(F.min(ts).alias("t0"), F.max(ts).alias("t1"))
    n = F.ceil(F.round((F.col("t1") - F.col("t0")) * fps, 9))
    return span.where(n > 0).select(by, "t0", F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1)).alias("i")).select(by, "i", (F.col("t0") + F.col("i") / fps).alias(ts))


def nearest_both(grid: DataFrame, samples: DataFrame, values: list[str], by: str = "episode_id", ts: str = "ts", only: str | None = None) -> DataFrame:
    """grid with structs prev and next: the nearest samples at or before, and at or after, each point.

    only: a boolean column of samples; the others do not count for prev and next. prev_ts and next_ts are of any sample.
    """
    s = F.struct(F.col(ts).alias("ts"), *values)
    rest = [c for c in grid.columns if c not in (by, ts)]
    kind = samples.select(s.alias("s")).schema["s"].dataType
    a = grid.select(by, ts, F.struct(*rest).alias("__g") if rest else F.struct(F.lit(1).alias("one")).alias("__g"), F.lit(None).cast(kind).alias("__s"), F.lit(None).cast("double").alias("__t"), F.lit(True).alias("__is"))
    kept = F.when(F.col(only), s) if only else s
    b = samples.select(by, ts, F.lit(None).cast(a.schema["__g"].dataType).alias("__g"), kept.alias("__s"), F.col(ts).cast("double").alias("__t"), F.lit(False).alias("__is"))
    w = Window.partitionBy(by)
    last = lambda c, o: F.last(c, ignorenulls=True).over(w.orderBy(o).rangeBetween(Window.unboundedPreceding, Window.currentRow))
    up, down = F.col(ts).asc(), F.col(ts).desc()  # what follows is the last one from the end: a running value, not a scan a row
    rows = a.unionByName(b).select("*", last("__s", up).alias("prev"), last("__s", down).alias("next"), last("__t", up).alias("prev_ts"), last("__t", down).alias("next_ts"))
    return rows.where("__is").select(by, ts, *(F.col(f"__g.{c}").alias(c) for c in rest), "prev", "next", "prev_ts", "next_ts")


def _lerp(a: Column, b: Column, value: str, t: Column) -> Column:
    span = b["ts"] - a["ts"]
    return F.when(span == 0, a[value]).otherwise(a[value] + (b[value] - a[value]) * (t - a["ts"]) / span)


def resampled(samples: DataFrame, fps: float, values: list[str], conf: str | None = None, least: float = 0.3, by: str = "episode_id", ts: str = "ts", plain: list[str] = []) -> DataFrame:  # noqa: B006
    """(by, i, ts, values, plain, valid, interpolated) on one grid: one pass over the samples, whatever the number of columns.

    values are linear between confident samples, and continued past the first and last two; episodes with fewer than two
    confident samples are 0 throughout. plain columns are so too, but of all samples. A point is valid if a sample of any
    confidence is nearer than half a period, else interpolated.
    """
    w = Window.partitionBy(by)
    ok = F.coalesce(F.col(conf) >= least, F.lit(False)) if conf else F.lit(True)
    rows = samples.withColumn("__ok", ok)
    item = lambda cols: F.struct(F.col(ts).alias("ts"), *cols)
    before = lambda o: F.last("__one", ignorenulls=True).over(w.orderBy(o).rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("__one", F.when(F.col("__ok"), item(values)))
    rows = rows.withColumn("__before", before(F.col(ts).asc())).withColumn("__after", before(F.col(ts).desc()))
    near = nearest_both(uniform_grid(samples, fps, by, ts), rows, [*values, "__before", "__after"], by, ts, "__ok")
    near = near.withColumn("valid", F.least(F.coalesce(F.col(ts) - F.col("prev_ts"), F.lit(float("inf"))), F.coalesce(F.col("next_ts") - F.col(ts), F.lit(float("inf")))) < 0.5 / fps)
    out = near.select(by, "i", ts, *(_continued(v, F.col(ts)).alias(v) for v in values), "valid", (~F.col("valid")).alias("interpolated"))
    if not plain:
        return out
    return out.join(resampled(samples, fps, plain, None, least, by, ts).select(by, "i", *plain), [by, "i"])


def _continued(value: str, t: Column) -> Column:
    p, n = F.col("prev"), F.col("next")
    out = F.when(p.isNotNull() & n.isNotNull(), _lerp(p, n, value, t)).when(n.isNotNull() & n["__after"].isNotNull(), _lerp(n, n["__after"], value, t)).when(p.isNotNull() & p["__before"].isNotNull(), _lerp(p["__before"], p, value, t))
    alone = (p.isNotNull() & p["__before"].isNull() & p["__after"].isNull()) | (n.isNotNull() & n["__before"].isNull() & n["__after"].isNull())
    return F.coalesce(F.when(~alone, out), F.lit(0.0))


def resample(samples: DataFrame, fps: float, value: str = "value", conf: str | None = None, least: float = 0.3, by: str = "episode_id", ts: str = "ts") -> DataFrame:
    """(by, i, ts, value, valid, interpolated): `resampled` of one column."""
    return resampled(samples, fps, [value], conf, least, by, ts)


def aligned_channels(samples: DataFrame, fps: float, channels: list[str], conf: str, least: float = 0.3, smooth: str = "savgol", by: str = "episode_id", ts: str = "ts") -> DataFrame:
    """All channels on one grid, smoothed; confidence is resampled from all samples; low_confidence marks points below least."""
    if smooth not in ("savgol", "none"):
        raise ValueError(f"unknown smoothing {smooth!r}")
    out = resampled(samples, fps, channels, conf, least, by, ts, [conf])
    if smooth == "savgol":
        for c in channels:
            out = smoothed(out, c, out="__s", by=by, t="i").withColumn(c, F.col("__s")).drop("__s")
    return out.withColumn("low_confidence", F.col(conf) < least)


def interpolated_ratio(resampled: DataFrame, by: str = "episode_id") -> DataFrame:
    return resampled.groupBy(by).agg(F.avg(F.col("interpolated").cast("double")).alias("interpolated_ratio"))
