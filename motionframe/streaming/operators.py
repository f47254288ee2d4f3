"""Structured Streaming: the same measures on streams of job events and candidates; files as streams, and replays."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from motionframe.session import shared_folder


def file_stream(spark: SparkSession, path: str, schema: str, files: int = 1) -> DataFrame:
    """New Parquet files, some at a time."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table, one file or a folder of them, as a stream."""
    path = f"{sf_dir}/{name}.parquet"
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path[:-1]}[{path[-1]}]")  # a pattern may match a file, a path must be a folder


def replayed(stream: DataFrame, mode: str = "append") -> DataFrame:
    """What the stream gives out for all that is there now, with the number of the micro-batch as epoch.

    Each batch is written into the shared folder under its number, so one that is run again replaces itself.
    """
    spark = stream.sparkSession
    folder = f"{shared_folder(spark)}/replay-{uuid.uuid4().hex}"

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out/epoch={epoch}")

    query = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def kpi_stream(events: DataFrame) -> DataFrame:
    """Counts and means by status, kept up to date (R1); for output mode update or complete."""
    return events.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean_value"))


def stage_metrics(events: DataFrame, length: str = "1 hour", step: str | None = None, late: str = "10 minutes", at: str = "ts") -> DataFrame:
    """Rate, errors and mean latency of each stage in windows (R2); events later than the watermark are dropped."""
    w = F.window(at, length, step) if step else F.window(at, length)
    return events.withWatermark(at, late).groupBy(w.alias("w"), "stage").agg(F.count(F.lit(1)).alias("jobs"), F.count_if(F.col("status") == "failed").alias("errors"), F.avg("value").alias("mean_latency")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "stage", "jobs", "errors", "mean_latency")


def unique_candidates(stream: DataFrame, key: str = "video_id", at: str = "ts", late: str = "1 day") -> DataFrame:
    """The first of each key within the watermark."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def status_of(event_type: Column) -> Column:
    return F.when(event_type == "error", "failed").when(event_type == "purchase", "completed").when(event_type == "signup", "pending").when(event_type == "view", "running").otherwise("skipped")
