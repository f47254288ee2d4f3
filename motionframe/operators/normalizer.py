"""The normalisation of poses as an estimator and a model: fit once, save, load, apply to any frames.

A model aligns poses with the body, takes end effectors, joints less their parents and the selected joints, sets objects
in relation to the left hand, projects the selected joints on principal components if it was fitted with some, and
gives them flat in the precision asked for. All of it is column functions; the fit alone runs Spark's PCA.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from motionframe.functions import vec as V
from motionframe.operators.geometry import KEPT, aligned, end_effectors, fit_pca, flat, joint_relative, reduced_precision, select_joints

MODEL = "config string, mean array<double>, components array<array<double>>, explained array<double>"


@dataclass
class Model:
    """components: a row each; the sign is such that a component's largest number (the first of equal ones) is positive."""

    config: dict
    mean: list[float] = field(default_factory=list)
    components: list[list[float]] = field(default_factory=list)
    explained: list[float] = field(default_factory=list)

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(json.dumps(self.config), self.mean, self.components, self.explained)]
        spark.createDataFrame(rows, MODEL).coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Model:
        r = spark.read.schema(MODEL).parquet(path).first()
        return Model(json.loads(r["config"]), list(r["mean"]), [list(c) for c in r["components"]], list(r["explained"]))

    def _projected(self, features: Column) -> Column:
        less = F.zip_with(features, F.array(*map(F.lit, self.mean)), lambda a, m: a - m)
        total = lambda c: F.aggregate(F.zip_with(less, F.array(*map(F.lit, c)), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
        return F.array(*map(total, self.components))

    def apply(self, frames: DataFrame, objects: DataFrame | None = None, by: str = "episode_id", t: str = "t") -> DataFrame:
        """frames with pose (aligned), valid, eef, relative, features, and pca and objects where there are such.

        objects: rows (by, t, k) with pos (x, y, z), relative to the left hand, or with bbox (cx, cy, w, h), given as the centre
        and the root of w * h. A frame's objects are an array of (k, x, y, z, seen) by k; what is null or NaN is not seen. A
        frame without objects has an empty array.
        """
        c = self.config
        out = aligned(frames, least=c["least"], by=by, order=t).withColumn("eef", end_effectors(F.col("pose")))
        out = out.withColumn("relative", joint_relative(F.col("pose")))
        features = flat(select_joints(F.col("pose"), c["joints"]))
        if self.components:
            out = out.withColumn("pca", V.let(features, self._projected))
        out = out.withColumn("features", reduced_precision(features, c["precision"]) if c["precision"] else features)
        if objects is None:
            return out
        if "pos" in objects.columns:
            item, seen = F.col("pos"), ~F.isnan(F.col("pos.x"))
        else:
            b = F.col("bbox")
            item, seen = V.vec(b["cx"], b["cy"], F.sqrt(b["w"] * b["h"])), ~F.isnan(b["cx"])
        each = objects.select(by, t, F.struct("k", item.alias("p"), F.coalesce(seen, F.lit(False)).alias("seen")).alias("__o"))
        per = each.groupBy(by, t).agg(F.array_sort(F.collect_list("__o")).alias("__objects"))  # of one frame
        left = F.col("eef")[0]
        place = (lambda p: V.sub(p, left)) if "pos" in objects.columns else (lambda p: p)
        told = F.transform("__objects", lambda o: F.struct(o["k"].alias("k"), *(place(o["p"])[x].alias(x) for x in "xyz"), o["seen"].alias("seen")))
        rows = out.join(per, [by, t], "left").withColumn("objects", told).drop("__objects")
        empty = F.array().cast(rows.schema["objects"].dataType)
        return rows.withColumn("objects", F.coalesce("objects", empty))


@dataclass
class Normalizer:
    """pca: how many components to fit, or None. precision: float32, float16 or None."""

    joints: list[str] = field(default_factory=lambda: list(KEPT))
    least: float = 0.5
    precision: str | None = "float32"
    pca: int | None = None

    def fit(self, frames: DataFrame, by: str = "episode_id", t: str = "t") -> Model:
        config = asdict(self)
        if self.pca is None:
            return Model(config)
        poses = aligned(frames, least=self.least, by=by, order=t).select(select_joints(F.col("pose"), self.joints).alias("pose"))
        centre, pca = fit_pca(poses, self.pca).stages
        components = pca.pc.toArray().T
        components = components * np.sign(components[np.arange(len(components)), np.abs(components).argmax(axis=1)])[:, None]
        return Model(config, centre.mean.toArray().tolist(), components.tolist(), pca.explainedVariance.toArray().tolist())
