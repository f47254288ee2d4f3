"""States and actions for imitation learning, made from normalised frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motionframe.functions import vec as V
from motionframe.operators.geometry import at, end_effectors, flat, hip_normalized
from motionframe.operators.windows import order, pose_velocity


def _seen(hand: Column) -> Column:
    return F.coalesce(F.exists(hand, lambda p: (p["x"] != 0) | (p["y"] != 0) | (p["z"] != 0)), F.lit(False))


def _pinch(hand: Column) -> Column:
    return V.distance(at(hand, 4), at(hand, 8))


def gripper(left: Column, right: Column) -> Column:
    """How far the hand is closed, of the right hand, else the left, else 0.5."""
    closed = lambda h: F.least(F.lit(1.0), F.greatest(F.lit(0.0), 1 - (_pinch(h) - 0.03) / 0.2))
    return F.when(_seen(right), closed(right)).when(_seen(left), closed(left)).otherwise(F.lit(0.5))


def gripper_closed(hand: Column, threshold: float = 0.05) -> Column:
    return (_pinch(hand) < threshold).cast("double")


def imitation_pairs(frames: DataFrame, fps: float, by: str = "episode_id", t: str = "t") -> tuple[DataFrame, DataFrame]:
    """(frames with state of 199 and action of 100 numbers, episodes of under 3 frames). The last frame has no action.

    state: joints, their velocities, confidence; action: way of the joints times fps, the next gripper.
    """
    sizes = Window.partitionBy(by)
    rows = frames.withColumn("__n", F.count(F.lit(1)).over(sizes))
    short = rows.where("__n < 3").groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    rows = rows.where("__n >= 3").withColumn("__p", hip_normalized(F.col("pose"))).withColumn("__g", gripper(F.col("left_hand"), F.col("right_hand")))
    rows = pose_velocity(rows, fps, "__p", "__v", by, t)
    w = order(by, t)
    rows = rows.withColumn("__q", F.lead("__p").over(w)).withColumn("__h", F.lead("__g").over(w))
    way = flat(F.zip_with("__q", "__p", lambda a, b: V.times(V.sub(a, b), fps)))
    state = F.concat(flat(F.col("__p")), flat(F.col("__v")), F.array(F.col("confidence").cast("double")))
    action = F.when(F.col("__q").isNotNull(), F.concat(way, F.array("__h")))
    return rows.select(by, t, state.cast("array<float>").alias("state"), action.cast("array<float>").alias("action")), short


def eef_pairs(frames: DataFrame, fps: float, by: str = "episode_id", t: str = "t") -> DataFrame:
    """State of joints, velocities and the wrists' confidences, action of the wrists' ways; with status for each episode of 2 frames or more."""
    rows = frames.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(by))).withColumn("__p", hip_normalized(F.col("pose"), 0.1, 2.0, True))
    rows = pose_velocity(rows, fps, "__p", "__v", by, t).withColumn("__e", end_effectors(F.col("__p")))
    nxt = F.lead("__e").over(order(by, t))
    rows = rows.withColumn("__f", nxt)
    state = F.concat(flat(F.col("__p")), flat(F.col("__v")), F.array(F.col("confidence").cast("double"), F.col("confidence").cast("double")))
    return rows.select(by, t, F.when(F.col("__n") < 2, "too_short").otherwise("ok").alias("status"), state.alias("state"), F.when(F.col("__f").isNotNull(), flat(F.zip_with("__f", "__e", V.sub))).alias("action"))


def encoding_results(pairs: DataFrame, files: DataFrame | None = None, by: str = "episode_id") -> DataFrame:
    """A row for each episode: status, sizes and error. files (by, error): all that were read, with what went wrong there."""
    per = pairs.groupBy(by).agg(F.max("status").alias("status"), F.count(F.lit(1)).alias("frames"), F.max(F.size("state")).alias("state_dim"), F.greatest(F.max(F.size("action")), F.lit(0)).alias("action_dim"))
    per = per.withColumn("error", F.when(F.col("status") != "ok", F.concat(F.lit("under 2 frames: "), F.col("frames"))))
    if files is None:
        return per
    both = files.select(by, F.col("error").alias("__error")).join(per, by, "left")
    wrong = F.coalesce("__error", "error", F.when(F.col("status").isNull(), "no frames"))
    return both.select(by, F.when(wrong.isNull(), "ok").when(F.col("__error").isNull() & (F.col("status") == "too_short"), "too_short").otherwise("error").alias("status"), F.coalesce("frames", F.lit(0)).alias("frames"), "state_dim", "action_dim", wrong.alias("error"))


def encoding_summary(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("episodes"), F.sum("frames").alias("frames"))


def nearest_objects(relative: Column, k: int) -> Column:
    """The object vectors, flat: in their order if there are k at most, else the k nearest by distance; zeros fill up to k."""
    known = F.filter(relative, lambda o: o.isNotNull())
    ranked = F.array_sort(F.transform(known, lambda o, i: F.struct(V.norm(o).alias("d"), i.alias("i"), o.alias("o"))))
    best = F.when(F.size(known) > k, F.transform(F.slice(ranked, 1, k), lambda r: r["o"])).otherwise(known)
    return F.slice(F.concat(flat(best), F.array_repeat(F.lit(0.0), 3 * k)), 1, 3 * k)


def build_state(pose: Column, velocity: Column | None = None, objects: Column | None = None, conf: Column | None = None, top_k: int = 3, with_velocity: bool = True) -> Column:
    """Positions, velocities (0 if there are none), the nearest objects, and the mean and least confidence; a number counts for both."""
    parts = [flat(pose)]
    if with_velocity:
        zeros = F.transform(flat(pose), lambda _: F.lit(0.0))
        parts.append(zeros if velocity is None else F.coalesce(flat(velocity), zeros))
    if objects is not None:
        parts.append(nearest_objects(objects, top_k))
    if conf is not None:
        parts.append(conf)
    return F.concat(*parts)


def confidence_pair(conf: Column, is_array: bool) -> Column:
    if not is_array:
        return F.array(conf, conf)
    return F.array(F.try_divide(F.aggregate(conf, F.lit(0.0), lambda a, v: a + v), F.size(conf)), F.array_min(conf))


def state_tensor(pose: Column, velocity: Column | None = None) -> Column:
    """A row of 3 or 6 numbers for each joint."""
    row = lambda j: F.array(j["x"], j["y"], j["z"])
    return F.transform(pose, row) if velocity is None else F.zip_with(pose, velocity, lambda p, v: F.concat(row(p), row(v)))


def actions(frames: DataFrame, parts: list[str] = ["eef"], by: str = "episode_id", t: str = "t") -> DataFrame:
    """action of the parts asked for: eef (wrists) or joints, quat or axis_angle of `rotation`, gripper (a column), grippers (the
    left and the right one, of left_hand and right_hand: 1 closed, 0 open or not seen); none is the wrists. Grippers are the next
    frame's; the last frame has no action."""
    w = order(by, t)
    cols = []
    for p in parts or ["eef"]:
        if p in ("eef", "joints"):
            x = end_effectors(F.col("pose")) if p == "eef" else F.col("pose")
            frames = frames.withColumn(f"__{p}", x).withColumn(f"__{p}2", F.lead(f"__{p}").over(w))
            cols.append(flat(F.zip_with(f"__{p}2", f"__{p}", V.sub)))
        elif p in ("quat", "axis_angle"):
            frames = frames.withColumn("__r2", F.lead("rotation").over(w))
            d = V.quat_delta(F.col("rotation"), F.col("__r2"))
            cols.append(d if p == "quat" else V.quat_axis_angle(d))
        elif p == "gripper":
            cols.append(F.array(F.lead("gripper").over(w)))
        elif p == "grippers":
            frames = frames.withColumn("__both", F.array(*(F.coalesce(gripper_closed(F.col(h)), F.lit(0.0)) for h in ("left_hand", "right_hand"))))
            cols.append(F.lead("__both").over(w))
        else:
            raise ValueError(f"unknown part {p!r}")
    is_last = F.lead(F.lit(1)).over(w).isNull()
    frames = frames.withColumn("action", F.when(~is_last, F.concat(*cols)))
    return frames.drop(*(c for c in frames.columns if c.startswith("__")))


def forearm_rotation(pose: Column, side: str = "left") -> Column:
    elbow, wrist = (13, 15) if side == "left" else (14, 16)
    return V.look_rotation(V.sub(at(pose, wrist), at(pose, elbow)))


def encoded(frames: DataFrame, parts: list[str] = ["eef"], by: str = "episode_id", t: str = "t", ts: str = "ts") -> tuple[DataFrame, DataFrame]:
    """(frames with state and action, a row of dt, fps and sizes for each episode)."""
    out = actions(frames, parts, by, t)
    out = out.withColumn("state", build_state(F.col("pose"), F.col("velocity") if "velocity" in frames.columns else None, conf=confidence_pair(F.col("confidence"), False)))
    first = F.array_sort(F.collect_list(F.when(F.col("__k") <= 2, F.col(ts))))  # two times
    ranked = out.withColumn("__k", F.row_number().over(order(by, t)))
    meta = ranked.groupBy(by).agg(first.alias("__f"), F.count(F.lit(1)).alias("frames"), F.max(F.size("state")).alias("state_dim"), F.max(F.size("action")).alias("action_dim"))
    dt = F.get("__f", F.lit(1)) - F.get("__f", F.lit(0))
    return out, meta.select(by, dt.alias("dt"), F.try_divide(F.lit(1.0), dt).alias("fps"), "frames", "state_dim", F.greatest("action_dim", F.lit(0)).alias("action_dim"), F.lit("+".join(parts or ["eef"])).alias("action_spec"))


def validated(pairs: DataFrame, by: str = "episode_id", ts: str = "ts") -> DataFrame:
    """Of each episode: errors (lengths of times and actions, numbers that are none), which make it invalid, notes (uneven
    steps, large values), which do not, and the sizes and ranges of states and actions."""
    w = Window.partitionBy(by).orderBy(ts)
    bad = lambda c: F.coalesce(F.exists(c, F.isnan), F.lit(False))
    least, most = lambda c: F.min(F.array_min(c)), lambda c: F.max(F.array_max(c))
    rows = pairs.withColumn("__dt", F.lead(ts).over(w) - F.col(ts))
    agg = rows.groupBy(by).agg(
        F.count("state").alias("n_states"), F.count("action").alias("n_actions"), F.count(ts).alias("n_times"),
        F.stddev_pop("__dt").alias("dt_std"), F.avg("__dt").alias("dt_mean"), F.max(bad(F.col("state"))).alias("nan_states"), F.max(bad(F.col("action"))).alias("nan_actions"),
        F.max(F.size("state")).alias("state_dim"), F.greatest(F.max(F.size("action")), F.lit(0)).alias("action_dim"),
        least("state").alias("state_min"), most("state").alias("state_max"), least("action").alias("action_min"), most("action").alias("action_max"),
    )
    large = lambda c, limit: F.greatest(F.abs(F.col(f"{c}_min")), F.abs(F.col(f"{c}_max"))) > limit
    said = lambda *found: F.array_compact(F.array(*(F.when(c, name) for name, c in found)))
    errors = said(("timestamps", F.col("n_times") != F.col("n_states")), ("actions", F.col("n_actions") != F.col("n_states") - 1), ("nan_states", F.col("nan_states")), ("nan_actions", F.col("nan_actions")))
    notes = said(("uneven", F.col("dt_std") > F.col("dt_mean") * 0.1), ("large_states", large("state", 100)), ("large_actions", large("action", 10)))
    return agg.withColumn("errors", errors).withColumn("notes", notes).withColumn("valid", F.size("errors") == 0)


def episode_stats(frames: DataFrame, array: str = "state", by: str = "episode_id") -> DataFrame:
    """Shape (rows, width) and numbers of an array column in each episode."""
    v = frames.where(F.col(array).isNotNull()).select(by, F.explode(F.transform(array, lambda x, i: F.struct(i.alias("i"), x.cast("double").alias("v")))).alias("e"))
    v = v.select(by, "e.i", "e.v")
    return v.groupBy(by).agg(F.count_if(F.col("i") == 0).alias("rows"), (F.max("i") + 1).alias("width"), F.count("v").alias("n"), F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max"))


def dataset_stats(frames: DataFrame, by: str = "episode_id") -> DataFrame:
    """Sizes and means over episodes (A15): state width, frames, confidence, hands, ready for training."""
    per = frames.groupBy(by).agg(F.count(F.lit(1)).alias("frames"), F.max(F.size("state")).alias("dim"), F.avg("confidence").alias("conf"), F.max(F.col("gripper") != 0.5).alias("hands"), F.min(F.array_min("state")).alias("lo"), F.max(F.array_max("state")).alias("hi"))
    per = per.join(episode_stats(frames, by=by).select(by, F.col("std").alias("sd")), by, "left")
    return per.agg(F.count(F.lit(1)).alias("episodes"), F.sum("frames").alias("frames"), F.max("dim").alias("state_dim"), F.avg("lo").alias("mean_min"), F.avg("hi").alias("mean_max"), F.avg("sd").alias("mean_std"), F.count_if(F.col("hands")).alias("with_hands"), F.count_if((F.col("conf") > 0.1) & (F.col("frames") >= 5)).alias("ready"), F.avg("conf").alias("mean_confidence"))
