"""Augmentation. Random numbers are digits of md5("seed|episode|operator|index"): the same however rows are dealt, and such as SQL
can state too."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motionframe.functions import vec as V
from motionframe.operators.encoding import actions
from motionframe.operators.geometry import MIRROR_PAIRS
from motionframe.operators.ranks import values_at
from motionframe.operators.temporal import nearest_both
from motionframe.session import written

SEED = 42


def digest(*keys: Column | str | int, seed: int = SEED) -> Column:
    """md5 of the seed and the keys, with | between them."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *((k if isinstance(k, Column) else F.lit(k)).cast("string") for k in keys)))


def digits(md5: Column, part: int = 0) -> Column:
    """In (0, 1): 13 hex digits of a digest, of which there are two such parts."""
    return (F.conv(F.substring(md5, 1 + 13 * part, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def uniform(*keys: Column | str | int, seed: int = SEED) -> Column:
    """In (0, 1), of the keys."""
    return digits(digest(*keys, seed=seed))


def between(u: Column, low: float, high: float) -> Column:
    return u * (high - low) + low


def mirrored(pose: Column) -> Column:
    """x changes sign, left and right joints change places."""
    place = list(range(33))
    for a, b in MIRROR_PAIRS:
        place[a], place[b] = b, a
    table = F.array(*map(F.lit, place))
    flipped = F.transform(pose, lambda j: V.vec(-j["x"], j["y"], j["z"]))
    return F.transform(flipped, lambda j, i: F.coalesce(F.get(flipped, F.get(table, i)), j))


def scaled(frames: DataFrame, low: float = 0.9, high: float = 1.1, by: str = "episode_id") -> DataFrame:
    k = between(uniform(F.col(by), "scale"), low, high)
    return frames.withColumn("pose", F.transform("pose", lambda j: V.times(j, k)))


def noisy(frames: DataFrame, sigma: float = 0.01, conf: str | None = None, by: str = "episode_id", t: str = "t") -> DataFrame:
    """Gaussian noise, times the confidence if asked."""
    size = F.lit(sigma) if conf is None else F.lit(sigma) * F.col(conf)

    def one(j: Column, i: Column) -> Column:
        def g(axis: str) -> Column:
            normal = lambda d: F.sqrt(F.log(digits(d)) * -2) * F.cos(digits(d, 1) * (2 * math.pi)) * size
            return V.let(digest(F.col(by), F.col(t), i, axis), normal)

        return V.vec(j["x"] + g("x"), j["y"] + g("y"), j["z"] + g("z"))

    return frames.withColumn("pose", F.transform("pose", one))


def sped(frames: DataFrame, speed: Column, mode: str = "speed", by: str = "episode_id", ts: str = "ts") -> DataFrame:
    """int(T / speed) frames evenly over duration / speed, both ends included.

    mode `speed` samples the motion at speed times the new time; mode `reference` samples it at the new time itself, past
    the end with the last pose.
    """
    per = frames.groupBy(by).agg(F.min(ts).alias("t0"), F.max(ts).alias("t1"), F.count(F.lit(1)).alias("n")).withColumn("s", speed)
    per = per.withColumn("m", F.floor(F.col("n") / F.col("s"))).where("m >= 2")
    grid = per.select(by, "t0", "s", ((F.col("t1") - F.col("t0")) / F.col("s") / (F.col("m") - 1)).alias("dt"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("m") - 1)).alias("i"))
    new = F.col("t0") + F.col("i") * F.col("dt")
    source = F.col("t0") + F.col("i") * F.col("dt") * F.col("s") if mode == "speed" else new
    grid = grid.select(by, "i", new.alias("new_ts"), source.alias(ts))
    near = nearest_both(grid, frames.select(by, ts, "pose"), ["pose"], by, ts)
    p, q = F.coalesce("prev", "next"), F.coalesce("next", "prev")
    k = F.when(q["ts"] > p["ts"], (F.col(ts) - p["ts"]) / (q["ts"] - p["ts"])).otherwise(0.0)
    near = near.withColumn("__k", k)  # of the sampled time: in the select below, ts would be the new one
    pose = F.zip_with(p["pose"], q["pose"], lambda a, b: V.add(a, V.times(V.sub(b, a), F.col("__k"))))
    return near.select(by, F.col("i").alias("t"), F.col("new_ts").alias(ts), pose.alias("pose"))


def _span(frames: DataFrame, by: str, ts: str) -> DataFrame:
    w = Window.partitionBy(by)
    return frames.withColumn("__t0", F.min(ts).over(w)).withColumn("__t1", F.max(ts).over(w)).withColumn("__n", F.count(F.lit(1)).over(w))


def offset(frames: DataFrame, most_seconds: float = 0.5, by: str = "episode_id", t: str = "t", ts: str = "ts") -> DataFrame:
    """A random start, at most that many seconds and a quarter of the frames in; times begin at 0."""
    rows = _span(frames, by, ts)
    fps = F.try_divide(F.col("__n") - 1, F.col("__t1") - F.col("__t0"))
    most = F.least(F.floor(fps * most_seconds), F.floor(F.col("__n") / 4))
    k = F.floor(uniform(F.col(by), "offset") * (F.coalesce(most, F.lit(0)) + 1))
    rows = rows.withColumn("__k", k).where(F.col(t) >= F.col("__k"))
    first = F.min(ts).over(Window.partitionBy(by))
    return rows.withColumn(ts, F.col(ts) - first).withColumn(t, F.col(t) - F.col("__k")).drop("__t0", "__t1", "__n", "__k")


def cropped(frames: DataFrame, least_seconds: float = 1.0, by: str = "episode_id", ts: str = "ts") -> DataFrame:
    """A random piece of at least that many seconds; times begin at 0. Shorter episodes stay whole."""
    rows = _span(frames, by, ts)
    span = F.col("__t1") - F.col("__t0")
    length = F.when(span > least_seconds, least_seconds + uniform(F.col(by), "crop") * (span - least_seconds)).otherwise(span)
    rows = rows.withColumn("__len", length).withColumn("__a", F.col("__t0") + uniform(F.col(by), "start") * (span - F.col("__len")))
    rows = rows.where((F.col(ts) >= F.col("__a")) & (F.col(ts) <= F.col("__a") + F.col("__len")))
    return rows.withColumn(ts, F.col(ts) - F.min(ts).over(Window.partitionBy(by))).drop("__t0", "__t1", "__n", "__len", "__a")


def rotated(pose: Column, yaw: Column, pitch: Column, roll: Column) -> Column:
    rows = V.euler_matrix(yaw, pitch, roll)
    return F.transform(pose, lambda j: V.matvec(rows, j))


def views(frames: DataFrame, n: int, yaw: float = 30.0, pitch: float = 10.0, roll: float = 5.0, by: str = "episode_id") -> DataFrame:
    """n random views of each episode, one angle each an episode."""
    rows = frames.withColumn("view", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    a = lambda name, most: between(uniform(F.col(by), F.col("view"), name), -most, most)
    return rows.withColumn("pose", rotated(F.col("pose"), a("yaw", yaw), a("pitch", pitch), a("roll", roll)))


def depth_normalized(frames: DataFrame, method: str = "median", eps: float = 1e-8, by: str = "episode_id") -> DataFrame:
    """z over all joints and frames of an episode: by median and MAD, to [-1, 1] by its range (as it is where the range is
    under eps), or cut at three deviations from the median."""
    z = frames.select(by, F.explode("pose").alias("p")).select(by, F.col("p.z").alias("z"))
    per = z.groupBy(by).agg(F.percentile("z", F.lit(0.5)).alias("__a"), F.min("z").alias("__lo"), F.max("z").alias("__hi"), F.stddev_pop("z").alias("__s"))
    a, lo, hi, s = (F.col(f"__{c}") for c in ("a", "lo", "hi", "s"))
    if method == "median":
        mad = z.join(per.select(by, "__a"), by).groupBy(by).agg(F.percentile(F.abs(F.col("z") - a), F.lit(0.5)).alias("__m"))
        per, new = per.join(mad, by), lambda v: (v - a) / (F.col("__m") + eps)
    elif method == "range":
        new = lambda v: F.when(hi - lo > eps, (v - lo) * 2 / (hi - lo) - 1).otherwise(v)
    elif method == "clip":
        new = lambda v: F.greatest(a - s * 3, F.least(a + s * 3, v))
    else:
        raise ValueError(f"unknown method {method!r}")
    rows = frames.join(per, by).withColumn("pose", F.transform("pose", lambda j: V.vec(j["x"], j["y"], new(j["z"]))))
    return rows.select(*frames.columns)


def augmented(frames: DataFrame, kinds: list[str] = ["spatial", "temporal", "viewpoint"], by: str = "episode_id", t: str = "t", ts: str = "ts", all_actions: bool = False) -> DataFrame:
    """Variants with source_episode_id and variant; the temporal ones get the wrists' actions, and all if asked."""
    base = frames.select(by, t, ts, "pose")
    name = lambda df, v: df.withColumn("source_episode_id", F.col(by)).withColumn("variant", F.lit(v)).withColumn(by, F.concat_ws("_", F.col(by).cast("string"), F.lit(v)))
    cast = base.withColumn(t, F.col(t).cast("bigint"))
    plain, timed = [], []
    if "spatial" in kinds:
        plain += [name(cast.withColumn("pose", mirrored(F.col("pose"))), "mirror"), name(scaled(cast, by=by), "scale"), name(noisy(cast, by=by, t=t), "noise")]
    if "viewpoint" in kinds:
        plain.append(name(views(cast, 1, by=by).drop("view"), "view"))
    if "temporal" in kinds:
        timed += [name(sped(cast, between(uniform(F.col(by), "speed"), 0.8, 1.2), by=by, ts=ts), "speed"), name(offset(cast, by=by, t=t, ts=ts), "offset"), name(cropped(cast, by=by, ts=ts), "crop")]
    out = None
    for df in [actions(x, ["eef"], by, t) for x in timed] + [actions(x, ["eef"], by, t) if all_actions else x.withColumn("action", F.lit(None).cast("array<double>")) for x in plain]:
        df = df.select(by, "source_episode_id", "variant", t, ts, "pose", "action")
        out = df if out is None else out.unionByName(df)
    return out


def augment_batch(frames: DataFrame, ratio: float = 0.5, by: str = "episode_id", **kw) -> DataFrame:
    """frames and the variants of floor(N * ratio) episodes, chosen by hash: those up to the hash at that rank."""
    ids = written(frames.select(by).distinct().withColumn("__u", uniform(F.col(by), "choose")), "episodes")
    n = int(ids.count() * ratio)
    bound = values_at(ids, "__u", [], {"__bound": lambda m: F.lit(n - 1)})
    chosen = ids.crossJoin(F.broadcast(bound)).where(F.col("__u") <= F.col("__bound")).select(by)  # one row
    new = augmented(frames.join(chosen, by, "left_semi"), by=by, **kw)
    old = frames.select(F.col(by).cast("string").alias(by), F.col(by).cast("string").alias("source_episode_id"), F.lit("original").alias("variant"), F.col("t").cast("bigint").alias("t"), "ts", "pose", F.lit(None).cast("array<double>").alias("action"))
    return old.unionByName(new.withColumn("source_episode_id", F.col("source_episode_id").cast("string")))
