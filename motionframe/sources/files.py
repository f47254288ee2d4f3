"""Readers and writers: CSV, JSON and JSONL, text lists, frame and episode Parquet, manifests. Array containers: arrays.py."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from motionframe import schemas
from motionframe.functions import scalar as S
from motionframe.operators.candidates import url_column

# --- CSV (S1-S6): quotes within quoted fields are doubled, fields may have line breaks

CSV = {"header": True, "quote": '"', "escape": '"', "multiLine": True}
#: Files in one document of a manifest: about 20 MB.
MANIFEST_FILES = 100_000
WRITTEN = {"header": True, "quote": '"', "escape": '"', "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_urls_csv(spark: SparkSession, path: str) -> DataFrame:
    """The column of URLs, by name or else the first, without blank ones."""
    df = spark.read.options(**CSV).csv(path)
    c = url_column(df.columns)
    return df.select(F.trim(F.col(f"`{c}`")).alias("url")).where("url is not null and url != ''")


def write_candidates(df: DataFrame, path: str, overwrite: bool = True) -> None:
    df.select(*schemas.CANDIDATES).write.mode("overwrite" if overwrite else "append").options(**WRITTEN).csv(path)


def csv_rows(df: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """All columns as text: timestamps in ISO form, arrays and structs as JSON, null as ''."""
    kinds = dict(df.dtypes)

    def said(c: str) -> Column:
        k = kinds[c]
        col = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss") if k.startswith("timestamp") else F.to_json(c) if k.startswith(("array", "map", "struct")) else F.col(c).cast("string")
        return F.coalesce(col, F.lit("")).alias(c)

    return df.select(*map(said, fields or df.columns))


def export_videos(df: DataFrame, path: str, fields: list[str] | None = None) -> None:
    csv_rows(df, fields).write.mode("overwrite").options(**WRITTEN).csv(path)


def export_by(df: DataFrame, path: str, column: str, fields: list[str] | None = None) -> None:
    """A folder for each value of column, lower case; null is unknown."""
    key = F.lower(F.coalesce(F.nullif(F.col(column).cast("string"), F.lit("")), F.lit("unknown"))).alias("part")
    rows = df.withColumn("__part", key)
    csv_rows(rows, [*(fields or df.columns), "__part"]).withColumnRenamed("__part", f"{column}_part").write.mode("overwrite").partitionBy(f"{column}_part").options(**WRITTEN).csv(path)


def append_csv(df: DataFrame, path: str) -> None:
    csv_rows(df).write.mode("append").options(**WRITTEN).csv(path)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text; what was null or empty is null."""
    return spark.read.options(**CSV).csv(path)


def read_url_list(spark: SparkSession, path: str) -> DataFrame:
    """url and video_id of each line that is neither blank nor a comment."""
    line = F.trim("value")
    rows = spark.read.text(path).select(line.alias("url")).where("url != '' and not startswith(url, '#')")
    found = F.regexp_extract("url", r"(?:v=|/)([0-9A-Za-z_-]{11})(?:[?&/]|$)", 1)
    return rows.withColumn("video_id", F.when(found != "", found).otherwise(F.element_at(F.split("url", "/"), -1)))


# --- JSON (S7-S9, S18, S19, S21, S24)


#: Times keep their microseconds.
JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def write_documents(df: DataFrame, path: str, lines: bool = False) -> None:
    """One document a file, as other tools have it; or a line each, for many documents."""
    df.write.mode("overwrite").options(**JSON).option("maxRecordsPerFile", 0 if lines else 1).json(path)


def read_documents(spark: SparkSession, path: str, schema: str, lines: bool = False) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", not lines).json(path)


def read_poses(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """One row a frame of landmark files."""
    files = read_documents(spark, path, schemas.POSE_JSON, lines)
    return files.select(F.col("metadata.video_path").alias("video_path"), F.col("metadata.fps").alias("fps"), F.explode("frames").alias("f")).select("video_path", "fps", "f.*")


def pose_documents(frames: DataFrame) -> DataFrame:
    """One row a video in the files' form."""
    item = F.struct("frame_idx", "timestamp", "pose_confidence", "body_landmarks", "left_hand", "right_hand")
    per = frames.groupBy("video_path", "fps").agg(F.array_sort(F.collect_list(item)).alias("frames"))
    n = F.size("frames").cast("bigint")
    return per.select(F.struct("video_path", "fps", n.alias("total_frames"), n.alias("num_pose_frames")).alias("metadata"), "frames")


def write_poses(frames: DataFrame, path: str, lines: bool = False) -> None:
    write_documents(pose_documents(frames), path, lines)


def read_detections(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    files = read_documents(spark, path, schemas.DETECTIONS_JSON, lines)
    return files.select("video_path", F.explode("frames").alias("f")).select("video_path", "f.*")


def write_detections(frames: DataFrame, path: str, lines: bool = False) -> None:
    item = F.struct("frame_idx", "timestamp", "objects")
    write_documents(frames.groupBy("video_path").agg(F.array_sort(F.collect_list(item)).alias("frames")), path, lines)


def write_json(df: DataFrame, path: str) -> None:
    """Interactions, events and reports."""
    df.write.mode("overwrite").options(**JSON).json(path)


def read_contract(spark: SparkSession, path: str, stage: str) -> DataFrame:
    """JSON lines of a stage; fields that it does not know are dropped."""
    return spark.read.schema(schemas.STAGE_CONTRACTS[stage]).json(path)


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    """One row for each file of each version."""
    return spark.read.schema(schemas.MANIFEST).json(path).select("version", "created_at", F.inline("files"))


def write_manifests(entries: DataFrame, path: str, most: int = MANIFEST_FILES) -> None:
    """A document for each version, on one line; a version of more than `most` files has several, each with the version's created_at.

    Files are dealt to them by the hash of what is said of them, so one document holds all that are alike in everything.
    """
    item = F.struct("key", "sha256", "size_bytes", "file_type", "storage_class", "compression")
    n = F.count(F.lit(1))
    large = entries.groupBy(F.col("version").alias("__version")).agg(F.ceil(n / most).alias("__parts"), F.max("created_at").alias("__created")).where("__parts > 1")  # a row for `most` rows at least
    dealt = entries.join(F.broadcast(large), F.col("version").eqNullSafe(F.col("__version")), "left")
    part = F.coalesce(F.pmod(F.xxhash64(item), F.col("__parts")), F.lit(0)).alias("__part")
    created = F.max(F.coalesce("__created", "created_at")).alias("created_at")
    dealt.groupBy("version", part).agg(created, F.array_sort(F.collect_list(item)).alias("files")).drop("__part").write.mode("overwrite").options(**JSON).json(path)


def write_contexts(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**JSON).partitionBy("platform", "video_id").json(path)


def read_contexts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CONTEXT).json(path)


# --- Parquet


def write_frames(frames: DataFrame, path: str, keys: list[str] = [], compression: str = "snappy") -> None:
    """One row a frame; action is null in the last one of an episode."""
    frames.write.mode("overwrite").partitionBy(*keys).option("compression", compression).parquet(path)


def episode_rows(frames: DataFrame) -> DataFrame:
    return frames.groupBy("episode_id").agg(F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"), F.count(F.lit(1)).alias("duration"), F.max(F.size("state")).alias("state_dim"), F.greatest(F.max(F.size("action")), F.lit(0)).alias("action_dim"), F.avg("confidence").alias("quality"))


def episode_scores(frames: DataFrame, episode: str = "episode_id", confidence: str = "confidence") -> DataFrame:
    """Each episode's range of frames and scores (A16): both scores are the mean confidence, jitter is 0 until it is measured."""
    n, mean = F.count(F.lit(1)), F.avg(confidence)
    return frames.groupBy(episode).agg(F.lit(0).cast("long").alias("start_frame"), n.alias("end_frame"), n.alias("duration_frames"), mean.alias("confidence_score"), mean.alias("quality_score"), F.lit(0.0).alias("jittering_score"))


def write_episodes(frames: DataFrame, path: str, keys: list[str] = [], compression: str = "snappy") -> None:
    episode_rows(frames).write.mode("overwrite").partitionBy(*keys).option("compression", compression).parquet(path)


def load(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_shards(frames: DataFrame, path: str, shard: str = "shard") -> None:
    """A folder for each shard, its frames in order of episode and time."""
    frames.repartition(shard).sortWithinPartitions(shard, "episode_id", "t").write.mode("overwrite").partitionBy(shard).parquet(path)


def export(df: DataFrame, path: str, formats: list[str] = ["parquet", "json"]) -> dict[str, str]:
    """One folder for each format: parquet, orc, json, csv."""
    out = {}
    for f in formats:
        rows = csv_rows(df) if f == "csv" else df
        options = {"csv": WRITTEN, "json": JSON}.get(f, {})
        rows.write.mode("overwrite").format(f).options(**options).save(f"{path}/{f}")
        out[f] = f"{path}/{f}"
    return out


def write_results(df: DataFrame, path: str) -> None:
    df.write.mode("append").partitionBy("platform", "video_id", "processing_version").parquet(path)


def write_dated(df: DataFrame, path: str, at: str) -> None:
    part = lambda p: F.date_format(at, p)
    df.withColumns({"y": part("yyyy"), "m": part("MM"), "d": part("dd")}).write.mode("append").partitionBy("y", "m", "d").parquet(path)


def inventory(spark: SparkSession, path: str, digests: bool = False) -> DataFrame:
    """key, size_bytes, modified_at and file_type of all files below path; contents are read only for digests."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    cols = [F.col("path").alias("key"), F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified_at"), S.file_type(F.col("path")).alias("file_type")]
    return files.select(*cols, *([F.sha2("content", 256).alias("sha256")] if digests else []))
