"""Landmark geometry on frame tables: one row a frame, pose as array of struct(x, y, z), joints by their fixed index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motionframe.functions import vec as V

# Body landmarks in order of their index, and the parent of each.
BODY = [
    "NOSE", "LEFT_EYE_INNER", "LEFT_EYE", "LEFT_EYE_OUTER", "RIGHT_EYE_INNER", "RIGHT_EYE", "RIGHT_EYE_OUTER", "LEFT_EAR", "RIGHT_EAR",
    "MOUTH_LEFT", "MOUTH_RIGHT", "LEFT_SHOULDER", "RIGHT_SHOULDER", "LEFT_ELBOW", "RIGHT_ELBOW", "LEFT_WRIST", "RIGHT_WRIST",
    "LEFT_PINKY", "RIGHT_PINKY", "LEFT_INDEX", "RIGHT_INDEX", "LEFT_THUMB", "RIGHT_THUMB", "LEFT_HIP", "RIGHT_HIP", "LEFT_KNEE", "RIGHT_KNEE",
    "LEFT_ANKLE", "RIGHT_ANKLE", "LEFT_HEEL", "RIGHT_HEEL", "LEFT_FOOT_INDEX", "RIGHT_FOOT_INDEX",
]
PARENT = [None, 0, 1, 2, 0, 4, 5, 3, 6, 0, 0, 0, 0, 11, 12, 13, 14, 15, 16, 15, 16, 15, 16, 0, 0, 23, 24, 25, 26, 27, 28, 27, 28]
# Parents of the twelve limb joints.
LIMB_PARENT = {11: 0, 13: 11, 15: 13, 12: 0, 14: 12, 16: 14, 23: 0, 25: 23, 27: 25, 24: 0, 26: 24, 28: 26}
# Joints that training keeps.
KEPT = ["LEFT_WRIST", "RIGHT_WRIST", "LEFT_ELBOW", "RIGHT_ELBOW", "LEFT_SHOULDER", "RIGHT_SHOULDER", "LEFT_HIP", "RIGHT_HIP"]
MIRROR_PAIRS = [(i, BODY.index(n.replace("LEFT", "RIGHT"))) for i, n in enumerate(BODY) if "LEFT" in n]
SHOULDERS, ELBOWS, WRISTS, HIPS, ANKLES = (11, 12), (13, 14), (15, 16), (23, 24), (27, 28)


def each_joint(pose: Column, f) -> Column:
    return F.transform(pose, f)


def at(pose: Column, joint: int) -> Column:
    return F.get(pose, F.lit(joint))


def select_joints(pose: Column, names: list[str] = KEPT) -> Column:
    return F.array(*(at(pose, BODY.index(n)) for n in names))


def hip_normalized(pose: Column, low: float = 0.01, high: float = 2.0, fallback_mean: bool = False) -> Column:
    """Centred at the middle of the hips, by the width of the shoulders within [low, high]; a pose without hips is centred at its mean if asked."""
    centre = V.mid(at(pose, HIPS[0]), at(pose, HIPS[1]))
    width = V.distance(at(pose, SHOULDERS[0]), at(pose, SHOULDERS[1]))
    if fallback_mean:
        centre = F.when(F.size(pose) < 25, V.mean_of(pose)).otherwise(centre)
        width = F.when(F.size(pose) < 25, F.lit(1.0)).otherwise(width)
    scale = F.least(F.lit(high), F.greatest(F.lit(low), width))
    return each_joint(pose, lambda j: V.times(V.sub(j, centre), 1 / scale))


def frame_valid(conf: Column, least: float) -> Column:
    """Shoulders and hips are all seen."""
    return F.forall(F.array(*(F.get(conf, F.lit(j)) for j in (*SHOULDERS, *HIPS))), lambda c: F.coalesce(c >= least, F.lit(False)))


def body_frame(pose: Column, scale: str = "shoulder") -> Column:
    """struct(origin, rows, scale, ok): origin in the middle of the hips, x along the shoulders, z = x × up, y = z × x."""
    joints = F.struct(*(at(pose, j).alias(k) for k, j in zip(("ls", "rs", "lh", "rh"), (*SHOULDERS, *HIPS))))

    def base(p: Column) -> Column:
        origin, across = V.mid(p["lh"], p["rh"]), V.sub(p["rs"], p["ls"])
        return F.struct(origin.alias("origin"), across.alias("across"), V.sub(V.mid(p["ls"], p["rs"]), origin).alias("up"), V.distance(p["lh"], p["rh"]).alias("hips"))

    def axes(b: Column) -> Column:
        x = V.unit(b["across"])
        return F.struct(b["origin"].alias("origin"), b["hips"].alias("hips"), V.norm(b["across"]).alias("width"), V.norm(b["up"]).alias("height"), x.alias("x"), V.cross(x, V.unit(b["up"])).alias("raw"))

    def frame(c: Column) -> Column:
        size = {"shoulder": c["width"], "hip": c["hips"], "torso": c["height"], "none": F.lit(1.0)}[scale]
        ok = F.coalesce((c["width"] > 1e-6) & (c["height"] > 1e-6) & (V.norm(c["raw"]) > 1e-6), F.lit(False))
        rows = V.let(V.unit(c["raw"]), lambda z: F.array(c["x"], V.cross(z, c["x"]), z))
        return F.struct(c["origin"].alias("origin"), rows.alias("rows"), size.alias("scale"), ok.alias("ok"))

    return V.let(V.let(V.let(joints, base), axes), frame)


def apply_frame(pose: Column, frame: Column, rotate: bool = True, scale: bool = True) -> Column:
    def one(j: Column) -> Column:
        p = V.sub(j, frame["origin"])
        p = V.matvec(frame["rows"], p) if rotate else p
        return V.times(p, 1 / (frame["scale"] + 1e-8)) if scale else p

    return each_joint(pose, one)


def aligned(frames: DataFrame, pose: str = "pose", conf: str = "conf", least: float = 0.5, scale: str = "shoulder", by: str = "episode_id", order: str = "t") -> DataFrame:
    """pose in the body's own frame, with `valid`; frames that have none use the last one before them, or stay as they are."""
    w = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    own = body_frame(F.col(pose), scale)
    out = frames.withColumn("__own", own).withColumn("valid", frame_valid(F.col(conf), least) & F.col("__own.ok"))
    out = out.withColumn("__use", F.last(F.when(F.col("valid"), F.col("__own")), ignorenulls=True).over(w))
    return out.withColumn(pose, F.when(F.col("__use").isNull(), F.col(pose)).otherwise(apply_frame(F.col(pose), F.col("__use")))).withColumn("frame_scale", F.when(F.col("valid"), F.col("__own.scale"))).drop("__own", "__use")


def alignment_metrics(aligned_frames: DataFrame, pose: str = "pose", by: str = "episode_id") -> DataFrame:
    s = F.col("frame_scale")
    size = F.transform(pose, lambda j: F.greatest(F.abs(j["x"]), F.abs(j["y"]), F.abs(j["z"])))
    mean_abs = F.aggregate(F.transform(pose, lambda j: (F.abs(j["x"]) + F.abs(j["y"]) + F.abs(j["z"])) / 3), F.lit(0.0), lambda a, v: a + v) / F.size(pose)
    return aligned_frames.groupBy(by).agg(F.avg(F.col("valid").cast("double")).alias("valid_ratio"), F.min(s).alias("scale_min"), F.max(s).alias("scale_max"), F.avg(s).alias("scale_mean"), F.stddev_pop(s).alias("scale_std"), F.max(F.when(F.col("valid"), F.array_max(size))).alias("coord_max"), F.avg(F.when(F.col("valid"), mean_abs)).alias("coord_mean"))


def joint_relative(pose: Column, parents: list[int | None] | dict[int, int] = PARENT) -> Column:
    """Joints less their parents; those without one stay."""
    get = parents.get if isinstance(parents, dict) else lambda i: parents[i]
    table = F.array(*(F.lit(-1 if get(i) is None else get(i)) for i in range(len(BODY))))
    return F.transform(pose, lambda j, i: F.when(F.get(table, i) >= 0, V.sub(j, F.get(pose, F.greatest(F.get(table, i), F.lit(0))))).otherwise(j))


def joint_relative_to(pose: Column, joint: int) -> Column:
    """All joints less one of them: also the translation to a reference joint."""
    ref = at(pose, joint)
    return each_joint(pose, lambda j: V.sub(j, ref))


def end_effectors(pose: Column, hands: Column | None = None) -> Column:
    """[left, right]: the middle of each hand's 21 points if there are 42, else the wrists."""
    wrists = F.array(*(at(pose, j) for j in WRISTS))
    if hands is None:
        return wrists
    return F.when(F.size(hands) >= 42, F.array(V.mean_of(F.slice(hands, 1, 21)), V.mean_of(F.slice(hands, 22, 21)))).otherwise(wrists)


def object_relative(eef: Column, objects: Column) -> Column:
    """Objects less the left end effector; objects that are not a number give null."""
    return F.transform(objects, lambda o: F.when(~V.has_nan(o), V.sub(o, eef[0])))


def object_from_bbox(bbox: Column) -> Column:
    """(cx, cy, sqrt(w h)) of [x1, y1, x2, y2]."""
    return V.vec((bbox[0] + bbox[2]) / 2.0, (bbox[1] + bbox[3]) / 2.0, F.sqrt(F.abs((bbox[2] - bbox[0]) * (bbox[3] - bbox[1])).cast("double")))


def normalized_2d(points: Column, width: int, height: int) -> Column:
    """Pixels to [-1, 1] with the aspect ratio kept."""
    return each_joint(points, lambda p: V.vec((p["x"] / width * 2 - 1) * (width / height), p["y"] / height * 2 - 1, p["z"]))


def pixel_to_unit(points: Column, width: int, height: int) -> Column:
    return each_joint(points, lambda p: V.vec(p["x"] / width, p["y"] / height, p["z"]))


def intrinsics(width: int, height: int, fov_degrees: float = 60.0) -> tuple[float, float, float, float]:
    """(fx, fy, cx, cy) of a pinhole camera with that horizontal field of view."""
    from math import radians, tan

    f = width / (2 * tan(radians(fov_degrees) / 2))
    return f, f, width / 2, height / 2


def back_projected(points: Column, depth: Column, camera: tuple[float, float, float, float]) -> Column:
    fx, fy, cx, cy = camera
    return F.zip_with(points, depth, lambda p, d: V.vec((p["x"] - cx) * d / fx, (p["y"] - cy) * d / fy, d))


def height_scaled(pose: Column, target: float = 1.7) -> Column:
    """struct(pose, factor): the distance from the nose to the middle of the ankles becomes target."""
    h = V.distance(at(pose, 0), V.mid(at(pose, ANKLES[0]), at(pose, ANKLES[1])))
    k = F.when(h < 1e-6, F.lit(1.0)).otherwise(F.try_divide(F.lit(target), h))
    return F.struct(each_joint(pose, lambda j: V.times(j, k)).alias("pose"), k.alias("factor"))


def shoulders_to_x(pose: Column) -> Column:
    """Rotated so that the axis of the shoulders is +x; axes that are parallel to x stay, whichever way they point."""
    a = V.sub(at(pose, SHOULDERS[1]), at(pose, SHOULDERS[0]))

    def rotation(u: Column) -> Column:  # R = I + K + K² / (1 + x), K of the cross product with +x
        x, y, z = V.xyz(u)
        k = F.try_divide(F.lit(1.0), 1 + x)
        return F.array(V.vec(x, y, z), V.vec(-y, 1 - y * y * k, -y * z * k), V.vec(-z, -y * z * k, 1 - z * z * k))

    def turned(u: Column) -> Column:
        parallel = F.coalesce(F.sqrt(u["y"] * u["y"] + u["z"] * u["z"]) < 1e-6, F.lit(True))
        return F.when(parallel, pose).otherwise(V.let(rotation(u), lambda rows: each_joint(pose, lambda j: V.matvec(rows, j))))

    return V.let(V.unit(a), turned)


def flat(pose: Column) -> Column:
    return F.flatten(F.transform(pose, lambda j: F.array(j["x"], j["y"], j["z"])))


def fit_pca(frames: DataFrame, n: int, pose: str = "pose"):
    """A fitted pipeline that centres flattened poses and projects them; its save and load are Spark's own."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import PCA, StandardScaler
    from pyspark.ml.functions import array_to_vector

    rows = frames.select(array_to_vector(flat(F.col(pose))).alias("__v"))
    return Pipeline(stages=[StandardScaler(inputCol="__v", outputCol="__c", withMean=True, withStd=False), PCA(k=n, inputCol="__c", outputCol="__p")]).fit(rows)


def apply_pca(frames: DataFrame, model, pose: str = "pose", out: str = "components") -> DataFrame:
    from pyspark.ml.functions import array_to_vector, vector_to_array

    return model.transform(frames.withColumn("__v", array_to_vector(flat(F.col(pose))))).withColumn(out, vector_to_array("__p")).drop("__v", "__c", "__p")


def half(x: Column) -> Column:
    """The nearest number that float16 holds (of two, the even one); beyond its range infinity."""
    size = F.abs(x)
    guess = F.floor(F.log2(size))
    power = F.pow(F.lit(2.0), guess)
    exponent = guess + (power * 2 <= size).cast("int") - (power > size).cast("int")  # the logarithm may be off at powers of two
    step = F.pow(F.lit(2.0), F.greatest(exponent, F.lit(-14)) - 10)
    near = F.rint(x / step) * step
    return F.when((size == 0) | F.isnan(x) | (size == float("inf")), x).when(F.abs(near) > 65504, F.signum(x) * float("inf")).otherwise(near)


def reduced_precision(values: Column, kind: str = "float32") -> Column:
    """Numbers as float32, or rounded to what float16 holds."""
    if kind == "float16":
        values = F.transform(values, lambda v: half(v.cast("double")))
    return values.cast("array<float>")


def normalization_pipeline(frames: DataFrame, joints: list[str] | None = None, relative: bool = True, precision: str | None = "float32", least: float = 0.5) -> DataFrame:
    """Align, end effectors, joints less their parents, selected joints, flat and of the precision asked for."""
    out = aligned(frames, least=least).withColumn("eef", end_effectors(F.col("pose")))
    if relative:
        out = out.withColumn("pose", joint_relative(F.col("pose")))
    if joints:
        out = out.withColumn("pose", select_joints(F.col("pose"), joints))
    features = flat(F.col("pose"))
    return out.withColumn("features", reduced_precision(features, precision) if precision else features)


def hand_measures(hand: Column, width: int = 1920, height: int = 1080) -> Column:
    """struct(open, grasp, px, py): tips far from the wrist, thumb near the index finger, wrist in pixels."""
    tips = [V.distance(at(hand, j), at(hand, 0)) for j in (4, 8, 12, 16, 20)]
    open_ = sum(tips[1:], tips[0]) / 5 > 0.15
    pinch = V.distance(at(hand, 4), at(hand, 8))
    grasp = 1 - F.greatest(F.lit(0.0), F.least(F.lit(1.0), (pinch - 0.05) / (0.5 - 0.05)))
    return F.struct(open_.alias("open"), grasp.alias("grasp"), (at(hand, 0)["x"] * width).alias("px"), (at(hand, 0)["y"] * height).alias("py"))


def distance_2d(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    return F.sqrt((ax - bx) * (ax - bx) + (ay - by) * (ay - by))


def distance_3d(hand: Column, cx: Column, cy: Column, bbox: Column) -> Column:
    """Of a hand and an object's centre, both in fractions of the image; its depth is guessed from its diagonal in pixels:
    1000 / max(diagonal, 1)."""
    diag = F.sqrt(((bbox[2] - bbox[0]) * (bbox[2] - bbox[0]) + (bbox[3] - bbox[1]) * (bbox[3] - bbox[1])).cast("double"))
    depth = 1000.0 / F.greatest(diag, F.lit(1.0))
    return V.norm(V.vec(hand["x"] - cx, hand["y"] - cy, hand["z"] - depth))


def interaction(distance: Column, grasp: Column) -> Column:
    """struct(kind, confidence): a grasp's is its strength, that of a touch or an approach grows as the distance falls."""
    # Distances in pixels and the strength that a grasp takes.
    of = lambda kind, c: F.struct(F.lit(kind).alias("kind"), c.cast("double").alias("confidence"))
    near = lambda most: 1 - distance / most
    return F.when((distance < 20) & (grasp > 0.5), of("grasp", grasp)).when(distance < 30, of("touch", near(30))).when(distance < 100, of("approach", near(100))).otherwise(of("none", F.lit(0.0)))


def frame_confidence(visibility: Column) -> Column:
    return F.coalesce(F.try_divide(F.aggregate(visibility, F.lit(0.0), lambda a, v: a + v), F.size(visibility)), F.lit(0.0))


def hand_slots(hands: DataFrame) -> DataFrame:
    """(video_id, t, label, n, hand) to one row a frame: left takes left; other labels take right; without labels the first is right, the second left."""
    side = F.when(F.lower("label") == "left", "left").when(F.col("label").isNotNull(), "right").when(F.col("n") == 0, "right").otherwise("left")
    pick = lambda s: F.max_by(F.when(side == s, F.col("hand")), F.when(side == s, F.col("n"))).alias(f"{s}_hand")
    return hands.groupBy("video_id", "t").agg(pick("left"), pick("right"))
