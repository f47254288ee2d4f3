"""Quality of landmark sequences: masks, jitter, composite scores, thresholds, segments, selection, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motionframe.operators.ranks import percentiles, values_at
from motionframe.operators.windows import continuity, order
from motionframe.session import written

# Thresholds of the profile `default`.
THRESHOLDS = {"min_confidence": 0.5, "max_jitter_score": 0.3, "min_episode_frames": 30, "max_nan_ratio": 0.1, "min_visible_joints": 15, "min_pose_completeness": 0.7}


def nan_frame(pose: Column) -> Column:
    """Any coordinate, or the visibility, is not a number."""
    return F.exists(pose, lambda j: F.isnan(j["x"]) | F.isnan(j["y"]) | F.isnan(j["z"]) | F.isnan(j["visibility"]))


def sequence_jitter(frames: DataFrame, pose: str = "pose", by: str = "episode_id", t: str = "t") -> DataFrame:
    """The mean absolute second difference over joints and axes, numbers only; 0 for under 3 frames."""
    w = order(by, t)
    rows = frames.select(by, t, F.col(pose).alias("p"), F.lead(pose).over(w).alias("q"), F.lead(pose, 2).over(w).alias("r"))
    second = F.zip_with(F.arrays_zip("p", "q"), "r", lambda a, c: F.array(*(F.abs(c[k] - a["q"][k] * 2 + a["p"][k]) for k in "xyz")))
    values = rows.where("r is not null").select(by, F.explode(F.flatten(second)).alias("v"))
    per = values.groupBy(by).agg(F.avg(F.when(~F.isnan("v"), F.col("v"))).alias("jitter_score"))
    return frames.select(by).distinct().join(per, by, "left").select(by, F.coalesce("jitter_score", F.lit(0.0)).alias("jitter_score"))


def pose_quality(frames: DataFrame, conf: str | None = "confidence", joints: int = 33, thresholds: dict = THRESHOLDS, pose: str = "pose", by: str = "episode_id", t: str = "t") -> DataFrame:
    """One row an episode: ratios, means, jitter, continuity, quality_score, failure_reasons and passed."""
    rows = frames.withColumn("__nan", nan_frame(F.col(pose)))
    visible = F.size(F.filter(pose, lambda j: ~F.isnan(j["visibility"]) & (j["visibility"] > 0.5)))
    agg = [F.count(F.lit(1)).alias("total_frames"), F.count_if(F.col("__nan")).alias("nan_frames"), F.avg(visible.cast("double")).alias("visible_joints_mean")]
    if conf is not None:
        c = F.when(~F.isnan(conf), F.col(conf))
        agg += [F.coalesce(F.avg(c), F.lit(0.0)).alias("confidence_mean"), F.coalesce(F.stddev_pop(c), F.lit(0.0)).alias("confidence_std"), F.coalesce(F.min(c), F.lit(0.0)).alias("confidence_min")]
        per = rows.groupBy(by).agg(*agg)
    else:
        per = rows.groupBy(by).agg(*agg)
        vis = frames.select(by, F.explode(F.transform(pose, lambda j: j["visibility"])).alias("v")).where(~F.isnan("v"))
        per = per.join(vis.groupBy(by).agg(F.avg("v").alias("confidence_mean"), F.stddev_pop("v").alias("confidence_std")), by, "left").withColumn("confidence_min", F.lit(0.0))
    per = per.join(sequence_jitter(frames, pose, by, t), by).join(continuity(rows, ~F.col("__nan"), by, t), by)
    per = per.withColumn("nan_ratio", F.col("nan_frames") / F.col("total_frames")).withColumn("pose_completeness", F.col("visible_joints_mean") / joints)
    return judged(per, thresholds)


def judged(per: DataFrame, t: dict = THRESHOLDS) -> DataFrame:
    """Adds quality_score, failure_reasons and passed to measured episodes."""
    part = lambda v, most: F.least(F.coalesce(F.try_divide(F.col(v), F.lit(float(most))), F.lit(1.0)), F.lit(1.0))
    score = part("confidence_mean", t["min_confidence"]) * 0.3 + (1 - part("nan_ratio", t["max_nan_ratio"])) * 0.2 + (1 - part("jitter_score", t["max_jitter_score"])) * 0.2
    score = score + part("pose_completeness", t["min_pose_completeness"]) * 0.15 + F.coalesce(F.try_divide("continuous_frames", "total_frames"), F.lit(0.0)) * 0.15
    said = lambda test, text, value, most: F.when(test, F.format_string(f"{text} {most}", value))
    reasons = F.array_compact(F.array(
        said(F.col("nan_ratio") > t["max_nan_ratio"], "nan_ratio=%.2f >", F.col("nan_ratio"), t["max_nan_ratio"]),
        said(F.col("confidence_mean") < t["min_confidence"], "confidence=%.2f <", F.col("confidence_mean"), t["min_confidence"]),
        said(F.col("jitter_score") > t["max_jitter_score"], "jitter=%.2f >", F.col("jitter_score"), t["max_jitter_score"]),
        said(F.col("visible_joints_mean") < t["min_visible_joints"], "visible_joints=%.1f <", F.col("visible_joints_mean"), t["min_visible_joints"]),
        said(F.col("continuous_frames") < t["min_episode_frames"], "continuous_frames=%d <", F.col("continuous_frames"), t["min_episode_frames"]),
    ))
    return per.withColumn("quality_score", F.least(F.lit(1.0), F.greatest(F.lit(0.0), score))).withColumn("failure_reasons", reasons).withColumn("passed", F.size("failure_reasons") == 0)


def thresholds_of(configs: DataFrame, profile: str = "default") -> dict:
    """Of the active row of a profile in the table of configurations, or the defaults: one row is read."""
    row = configs.where((F.col("profile") == profile) & F.col("is_active")).limit(1).collect()
    return THRESHOLDS | ({k: row[0][k] for k in THRESHOLDS if k in configs.columns and row[0][k] is not None} if row else {})


def segment_scores(segments: DataFrame, frames: DataFrame, conf: str = "confidence", jitter: str = "jitter", least: float = 0.5, by: str = "episode_id", t: str = "t") -> DataFrame:
    """Segments [start, end) whose mean confidence is enough, with score = conf * (1 - min(10 * jitter, 1)) and ids in order.

    Segments are dealt by blocks of frames, so the join is on equal keys.
    """
    size = 64
    blocks = segments.withColumn("__b", F.explode(F.sequence(F.floor(F.col("start") / size), F.floor((F.col("end") - 1) / size))))
    rows = frames.select(by, F.floor(F.col(t) / size).alias("__b"), F.col(t).alias("__t"), conf, jitter)
    hit = blocks.join(rows, [by, "__b"]).where((F.col("__t") >= F.col("start")) & (F.col("__t") < F.col("end")))
    per = hit.groupBy(by, "start", "end").agg(F.avg(conf).alias("confidence"), F.avg(jitter).alias("jitter")).where(F.col("confidence") >= least)
    per = per.withColumn("score", F.col("confidence") * (1 - F.least(F.col("jitter") * 10, F.lit(1.0))))
    return per.withColumn("index", F.row_number().over(Window.partitionBy(by).orderBy("start", "end")) - 1)


def split_passed(scored: DataFrame) -> tuple[DataFrame, DataFrame]:
    return scored.where("passed"), scored.where(~F.col("passed"))


def top_percent(scored: DataFrame, percent: float, score: str = "quality_score", tie: str = "episode_id") -> DataFrame:
    """The best max(1, int(n * percent / 100)) rows: those over the score at that rank, and of its equals the first by tie."""
    scored = written(scored, "scored")
    n = scored.count()
    k = max(1, int(n * percent / 100))
    (bound,) = values_at(scored, score, [], {"bound": lambda m: F.greatest(m - k, F.lit(0))}).collect() or [None]
    if bound is None:  # no row has a score
        return scored.limit(0)
    over = scored.where(F.col(score) > F.lit(bound["bound"]))
    equals = scored.where(F.col(score) == F.lit(bound["bound"]))
    return over.unionByName(equals.orderBy(tie).limit(max(0, k - over.count())))


def score_stats(scored: DataFrame, columns: list[str]) -> DataFrame:
    """(metric, mean, std, min, max, median), std of the population."""
    rows = written(scored.select(F.explode(F.array(*(F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("v")) for c in columns))).alias("r")).select("r.*"), "scores")
    out = rows.groupBy("metric").agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max"))
    return out.join(percentiles(rows, "v", ["metric"], {"median": 0.5}), "metric", "left")


def failure_histogram(scored: DataFrame) -> DataFrame:
    return scored.select(F.explode("failure_reasons").alias("r")).select(F.split_part("r", F.lit("="), F.lit(1)).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def distribution(scored: DataFrame, column: str = "quality_score", category: str | None = None) -> DataFrame:
    by = [category] if category else []
    one = scored.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.avg(column).alias("mean"), F.stddev_pop(column).alias("std"), F.min(column).alias("min"), F.max(column).alias("max"), F.avg(F.col("passed").cast("double")).alias("pass_rate"))
    ranks = percentiles(scored, column, by, {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95})
    return one.join(ranks, category, "left") if category else one.crossJoin(ranks)  # one row each


def pass_rates(measured: DataFrame, grid: list[dict]) -> DataFrame:
    """The pass rate of each set of thresholds, all in one pass over the episodes."""
    cols = [F.avg(judged_pass(THRESHOLDS | g).cast("double")).alias(str(i)) for i, g in enumerate(grid)]
    one = measured.agg(*cols)
    return one.select(F.inline(F.array(*(F.struct(F.lit(i).alias("grid"), F.col(str(i)).alias("pass_rate")) for i in range(len(grid))))))


def judged_pass(t: dict) -> Column:
    return (F.col("nan_ratio") <= t["max_nan_ratio"]) & (F.col("confidence_mean") >= t["min_confidence"]) & (F.col("jitter_score") <= t["max_jitter_score"]) & (F.col("visible_joints_mean") >= t["min_visible_joints"]) & (F.col("continuous_frames") >= t["min_episode_frames"])


def quality_report(scored: DataFrame, thresholds: dict = THRESHOLDS) -> DataFrame:
    """One row: thresholds, counts and pass rate, statistics, and failure reasons as a map."""
    stats = score_stats(scored, ["quality_score", "confidence_mean", "jitter_score"]).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("metric", F.struct("mean", "std", "min", "max", "median"))))).alias("stats"))
    reasons = failure_histogram(scored).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("reason", "n")))).alias("failures"))
    summary = scored.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("passed")).alias("passed"))
    said = F.create_map(*(F.lit(x) for k, v in thresholds.items() for x in (k, float(v))))
    return summary.crossJoin(stats).crossJoin(reasons).withColumn("thresholds", said).withColumn("pass_rate", F.coalesce(F.try_divide("passed", "total"), F.lit(0.0)))  # one row each
