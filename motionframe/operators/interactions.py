"""Hands and objects: pairing in a frame, classes of interaction, sessions, choices among detections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motionframe.functions.scalar import bbox_measures
from motionframe.operators.geometry import distance_2d, distance_3d, hand_measures, interaction


def by_class(objects: Column, names: list[str]) -> Column:
    return F.filter(objects, lambda o: o["class_name"].isin(names))


def by_confidence(objects: Column, least: float) -> Column:
    return F.filter(objects, lambda o: o["confidence"] >= least)


def largest(objects: Column, name: str | None = None) -> Column:
    found = F.filter(objects, lambda o: o["class_name"] == name) if name else objects
    area = lambda o: (o["bbox"][2] - o["bbox"][0]) * (o["bbox"][3] - o["bbox"][1])
    ranked = F.array_sort(F.transform(found, lambda o: F.struct((-area(o)).alias("a"), o.alias("o"))))
    return F.get(ranked, F.lit(0))["o"]


def largest_in_frame(objects: DataFrame) -> DataFrame:
    """(video_id, frame_idx, o) of rows (video_id, frame_idx, o): the largest, without gathering a frame's objects."""
    area = (F.col("o.bbox")[2] - F.col("o.bbox")[0]) * (F.col("o.bbox")[3] - F.col("o.bbox")[1])
    best = F.min(F.struct((-area).alias("a"), F.col("o").alias("o")))
    return objects.groupBy("video_id", "frame_idx").agg(best.alias("best")).select("video_id", "frame_idx", F.col("best.o").alias("o"))


#: Rows that one task sorts.
TASK_ROWS = 500_000


def tasks_for(rows: int) -> int:
    return max(1, -(-rows // TASK_ROWS))


def numbered(objects: DataFrame, tasks: int | None = None) -> DataFrame:
    """Rows (video_id, frame_idx, o) with the ordinal that each object has among those of its class in its frame, from the
    left: other classes that come and go do not change it. Frames are dealt to that many tasks, or as Spark deals them."""
    if tasks is not None:
        objects = objects.repartition(tasks, "video_id", "frame_idx")
    box = F.col("o.bbox")
    w = Window.partitionBy("video_id", "frame_idx", "o.class_name").orderBy(box[0], box[1], box[2], box[3], "o.confidence")
    return objects.select("video_id", "frame_idx", (F.row_number().over(w) - 1).alias("ordinal"), "o")


def sampled(frames: DataFrame, source_fps: float, out_fps: float, most: int | None = None, by: str = "video_id", frame: str = "frame_idx") -> DataFrame:
    """Every k-th frame, k = max(1, int(source / out)), and the first `most` of them."""
    k = max(1, int(source_fps / out_fps))
    out = frames.where(F.col(frame) % k == 0)
    return out if most is None else out.where(F.col(frame) < most * k)


def pairs(hands: DataFrame, detections: DataFrame, width: int = 1920, height: int = 1080) -> DataFrame:
    """hands (video_id, frame_idx, hand, points) with each object of the frame: distances, grasp, kind and confidence.

    Objects of one class in a frame are told apart by their ordinal.
    """
    return paired(hands, numbered(detections.select("video_id", "frame_idx", F.explode("objects").alias("o"))), width, height)


def paired(hands: DataFrame, objects: DataFrame, width: int = 1920, height: int = 1080) -> DataFrame:
    """pairs, with the objects as rows (video_id, frame_idx, ordinal, o), in an image of that size."""
    h = hands.withColumn("m", hand_measures(F.col("points"), width, height))
    rows = h.join(objects, ["video_id", "frame_idx"]).withColumn("box", bbox_measures(F.col("o.bbox"), F.lit(width), F.lit(height)))
    rows = rows.withColumn("distance", distance_2d(F.col("m.px"), F.col("m.py"), F.col("box.cx"), F.col("box.cy")))
    rows = rows.withColumn("distance_3d", distance_3d(F.get("points", F.lit(0)), F.col("box.cx") / width, F.col("box.cy") / height, F.col("o.bbox")))
    rows = rows.withColumn("i", interaction(F.col("distance"), F.col("m.grasp")))
    return rows.select("video_id", "frame_idx", "hand", F.concat_ws("#", "o.class_name", "ordinal").alias("object"), "distance", "distance_3d", F.col("m.grasp").alias("grasp"), F.col("m.open").alias("open"), "i.kind", "i.confidence")


def sessions(rows: DataFrame, fps: float, least_seconds: float = 0.1, tasks: int | None = None) -> DataFrame:
    """A session opens with any interaction and closes with an explicit none; a missing detection does not close it.

    It ends a frame before the none, and in time with the none. Its kind is the strongest, its confidence the highest.
    Objects are dealt to that many tasks, or hands and objects as Spark deals them.
    """
    key = ["video_id", "hand", "object"]
    if tasks is not None:
        rows = rows.repartition(tasks, "video_id", "object")  # a constant hand would not do as a key
    w = Window.partitionBy(*key).orderBy("frame_idx")
    none = F.col("kind") == "none"
    numbered = rows.withColumn("session", F.coalesce(F.sum(none.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # Strength of the kinds.
    rank = F.when(F.col("kind") == "grasp", 3).when(F.col("kind") == "touch", 2).when(F.col("kind") == "approach", 1).otherwise(0)
    live = lambda c: F.when(~none, c)
    agg = numbered.groupBy(*key, "session").agg(F.min(live(F.col("frame_idx"))).alias("start"), F.max(live(F.col("frame_idx"))).alias("last"), F.max(F.when(none, F.col("frame_idx"))).alias("closer"), F.max(rank).alias("r"), F.max(live(F.col("confidence"))).alias("peak_confidence"))
    agg = agg.where("start is not null").withColumn("end", F.coalesce(F.col("closer") - 1, F.col("last"))).withColumn("duration", (F.coalesce("closer", "last") - F.col("start")) / fps)
    kind = F.element_at(F.array(*map(F.lit, ("approach", "touch", "grasp"))), F.col("r"))
    return agg.where(F.col("duration") >= least_seconds).select(*key, "start", "end", "duration", kind.alias("kind"), "peak_confidence")
