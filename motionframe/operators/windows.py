"""Frame-by-frame operators: differences, energy, smoothing, islands, gaps and segments. One window spec per episode."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motionframe.functions import vec as V


def order(by: str = "episode_id", t: str = "t"):
    return Window.partitionBy(by).orderBy(t)


def difference(df: DataFrame, column: str, out: str = "delta", by: str = "episode_id", t: str = "t") -> DataFrame:
    """The next value less this one; null at the end."""
    return df.withColumn(out, F.lead(column).over(order(by, t)) - F.col(column))


def velocity(df: DataFrame, column: str, fps: float, out: str = "velocity", by: str = "episode_id", t: str = "t") -> DataFrame:
    """Central differences, one-sided at the ends; 0 for a single frame."""
    w = order(by, t)
    before, after, x = F.lag(column).over(w), F.lead(column).over(w), F.col(column)
    return df.withColumn(out, F.when(before.isNull() & after.isNull(), F.lit(0.0)).when(before.isNull(), (after - x) * fps).when(after.isNull(), (x - before) * fps).otherwise((after - before) * fps / 2))


def acceleration(df: DataFrame, column: str, fps: float, out: str = "acceleration", by: str = "episode_id", t: str = "t") -> DataFrame:
    return velocity(velocity(df, column, fps, "__v", by, t), "__v", fps, out, by, t).drop("__v")


def pose_velocity(df: DataFrame, fps: float, pose: str = "pose", out: str = "velocity", by: str = "episode_id", t: str = "t") -> DataFrame:
    """The same for all joints at once: two neighbours are fetched, not one for each coordinate."""
    w = order(by, t)
    df = df.withColumn("__b", F.lag(pose).over(w)).withColumn("__a", F.lead(pose).over(w))
    diff = lambda p, q, k: F.zip_with(p, q, lambda i, j: V.times(V.sub(i, j), k))
    b, a, p = F.col("__b"), F.col("__a"), F.col(pose)
    v = F.when(b.isNull() & a.isNull(), F.transform(p, lambda j: V.zero())).when(b.isNull(), diff(a, p, fps)).when(a.isNull(), diff(p, b, fps)).otherwise(diff(a, b, fps / 2))
    return df.withColumn(out, v).drop("__a", "__b")


def _mean_norm(vectors: Column) -> Column:
    return F.aggregate(vectors, F.lit(0.0), lambda acc, v: acc + V.norm(v)) / F.size(vectors)


def motion_energy(df: DataFrame, pose: str = "pose", out: str = "energy", by: str = "episode_id", t: str = "t") -> DataFrame:
    """The mean way of the joints to the next frame; null at the end."""
    after = F.lead(pose).over(order(by, t))
    df = df.withColumn("__a", after)
    return df.withColumn(out, F.when(F.col("__a").isNotNull(), _mean_norm(F.zip_with("__a", pose, V.sub)))).drop("__a")


def moving_average(df: DataFrame, column: str, window: int = 30, out: str = "average", by: str = "episode_id", t: str = "t") -> DataFrame:
    """Over t - window/2 .. t + window/2 - 1, divided by window at the ends too; episodes shorter than it get their mean."""
    w = order(by, t)
    n = F.count(F.lit(1)).over(Window.partitionBy(by))
    mean = F.avg(column).over(Window.partitionBy(by))
    half = window // 2
    return df.withColumn(out, F.when(n < window, mean).otherwise(F.sum(column).over(w.rowsBetween(-half, window - half - 1)) / window))


def jitter(df: DataFrame, pose: str = "pose", out: str = "jitter", by: str = "episode_id", t: str = "t") -> DataFrame:
    """The mean size of the joints' second differences; 0 at both ends, and throughout episodes of under 10 frames."""
    w = order(by, t)
    df = df.withColumn("__b", F.lag(pose).over(w)).withColumn("__a", F.lead(pose).over(w)).withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(by)))
    second = F.zip_with(F.zip_with("__a", pose, V.sub), F.zip_with(pose, "__b", V.sub), V.sub)
    inner = F.col("__a").isNotNull() & F.col("__b").isNotNull() & (F.col("__n") >= 10)
    return df.withColumn(out, F.when(inner, _mean_norm(second)).otherwise(0.0)).drop("__a", "__b", "__n")


def islands(df: DataFrame, flag: Column, out: str = "run", by: str = "episode_id", t: str = "t") -> DataFrame:
    """Numbers runs of equal flags in order."""
    w = order(by, t)
    df = df.withColumn("__f", flag)
    change = F.coalesce((F.col("__f") != F.lag("__f").over(w)).cast("int"), F.lit(0))
    return df.withColumn("__c", change).withColumn(out, F.sum("__c").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumnRenamed("__f", f"{out}_flag").drop("__c")


def motion_segments(df: DataFrame, energy: str = "energy", threshold: float = 0.01, least: int = 30, most: int = 300, by: str = "episode_id", t: str = "t") -> DataFrame:
    """Runs of frames with energy over the threshold, at least `least` long, cut into pieces of `most`; shorter pieces go. End exclusive."""
    rows = islands(df.where(F.col(energy).isNotNull()), F.col(energy) > threshold, "run", by, t).where("run_flag")
    runs = rows.groupBy(by, "run").agg(F.min(t).alias("a"), (F.max(t) + 1).alias("b")).where(F.col("b") - F.col("a") >= least)
    pieces = runs.select(by, F.col("b"), F.explode(F.sequence(F.col("a"), F.col("b") - 1, F.lit(most).cast(dict(runs.dtypes)["a"]))).alias("start"))
    return pieces.select(by, "start", F.least(F.col("start") + most, F.col("b")).alias("end")).where(F.col("end") - F.col("start") >= least)


def fixed_segments(lengths: DataFrame, length: int, overlap: int, total: str = "n", by: str = "episode_id") -> DataFrame:
    """Windows of `length` every length - overlap frames, and a last one of half a window at least. lengths: (by, total)."""
    if overlap >= length:
        raise ValueError("overlap must be less than length")
    step = length - overlap
    n = F.col(total).cast("long")
    starts = F.when(n >= length, F.sequence(F.lit(0).cast("long"), n - length, F.lit(step).cast("long"))).otherwise(F.array().cast("array<bigint>"))
    rows = lengths.select(by, n.alias("n"), starts.alias("starts"))
    tail = F.when(F.size("starts") > 0, F.try_element_at("starts", F.lit(-1)) + step).otherwise(F.lit(0).cast("long"))
    rows = rows.withColumn("tail", tail)
    body = F.transform("starts", lambda s: F.struct(s.alias("start"), (s + length).alias("end")))
    last = F.when(F.col("n") - F.col("tail") >= length // 2, F.array(F.struct(F.col("tail").alias("start"), F.col("n").alias("end"))))
    return rows.select(by, F.inline(F.concat(body, F.coalesce(last, F.array().cast("array<struct<start:bigint,end:bigint>>")))))


def continuity(df: DataFrame, valid: Column, by: str = "episode_id", t: str = "t") -> DataFrame:
    """The longest run of valid frames and the longest gap."""
    runs = islands(df, valid, "run", by, t).groupBy(by, "run", "run_flag").agg(F.count(F.lit(1)).alias("n"))
    return runs.groupBy(by).agg(F.coalesce(F.max(F.when(F.col("run_flag"), F.col("n"))), F.lit(0)).alias("continuous_frames"), F.coalesce(F.max(F.when(~F.col("run_flag"), F.col("n"))), F.lit(0)).alias("max_gap_frames"))


def carried(df: DataFrame, column: str, valid: Column, out: str, by: str = "episode_id", t: str = "t") -> DataFrame:
    """The last valid value up to each frame."""
    return df.withColumn(out, F.last(F.when(valid, F.col(column)), ignorenulls=True).over(order(by, t).rowsBetween(Window.unboundedPreceding, 0)))


def gaps(samples: DataFrame, fps: float, most: float, ts: str = "ts", by: str = "episode_id") -> DataFrame:
    """Steps longer than `most` periods, as positions in the grid of fps from the first sample: [start, end)."""
    w = Window.partitionBy(by).orderBy(ts)
    rows = samples.select(by, F.col(ts).alias("a"), F.lead(ts).over(w).alias("b"), F.min(ts).over(Window.partitionBy(by)).alias("t0"))
    place = lambda c: F.ceil((F.col(c) - F.col("t0")) * fps)
    return rows.where(F.col("b") - F.col("a") > most / fps).select(by, place("a").alias("start"), place("b").alias("end"))


def split_by_gaps(grid: DataFrame, found: DataFrame, least: int, by: str = "episode_id", i: str = "i") -> DataFrame:
    """Points of a resampled grid outside of all gaps, with the number of their piece; of episodes that have a gap, pieces of
    under `least` points go. found: `gaps` of the samples."""
    starts = found.where(F.col("end") > F.col("start")).groupBy(by, F.col("start").alias(i)).agg(F.max("end").alias("__end"))
    w = Window.partitionBy(by).orderBy(i).rowsBetween(Window.unboundedPreceding, 0)
    rows = grid.join(starts, [by, i], "left").withColumn("piece", F.count("__end").over(w)).withColumn("__until", F.max("__end").over(w))
    rows = rows.where(F.coalesce(F.col(i) >= F.col("__until"), F.lit(True)))
    rows = rows.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(by, "piece")))
    has = found.where(F.col("end") > F.col("start")).select(by, F.lit(True).alias("__has")).distinct()
    return rows.join(has, by, "left").where(F.col("__has").isNull() | (F.col("__n") >= least)).select(*grid.columns, "piece")


def savgol_rows(window: int, degree: int) -> np.ndarray:
    """Row i: the weights by which a least-squares polynomial over a window gives its value at place i."""
    a = np.vander(np.arange(window) - (window - 1) / 2, degree + 1)
    return a @ np.linalg.pinv(a)


def smoothed(df: DataFrame, column: str, window: int = 11, degree: int = 3, out: str = "smoothed", by: str = "episode_id", t: str = "t") -> DataFrame:
    """Savitzky-Golay; at the ends the polynomial of the first or last window. Episodes shorter than the window use the largest odd one that fits."""
    w = order(by, t)
    n = F.count(F.lit(1)).over(Window.partitionBy(by))
    rows = df.withColumn("__n", n).withColumn("__i", F.row_number().over(w) - 1).withColumn("__v", F.collect_list(F.col(column).cast("double")).over(w.rowsBetween(-(window - 1), window - 1)))
    size = F.least(F.lit(window), F.when(F.col("__n") % 2 == 0, F.col("__n") - 1).otherwise(F.col("__n"))).cast("int")
    half = F.floor(size / 2).cast("int")
    first = F.greatest(F.lit(0), F.least(F.col("__i") - half, F.col("__n").cast("int") - size)).cast("int")
    begins = F.greatest(F.lit(0), F.col("__i") - (window - 1))
    part = F.slice("__v", (first - begins + 1).cast("int"), size)
    tables = {k: F.array(*(F.array(*(F.lit(float(x)) for x in r)) for r in savgol_rows(k, min(degree, k - 1)))) for k in range(3, window + 1, 2)}
    weights = None
    for k, table in tables.items():
        hit = F.get(table, (F.col("__i") - first).cast("int"))
        weights = (F if weights is None else weights).when(size == k, hit)
    value = F.aggregate(F.zip_with(part, weights, lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)
    return rows.withColumn(out, F.when(F.col("__n") < 3, F.col(column).cast("double")).otherwise(value)).drop("__n", "__i", "__v")
