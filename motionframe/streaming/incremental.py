"""Append what is new by key, batch by batch, without reading what is there already.

The target holds rows by commit and bucket, a bucket being the key's hash modulo their number; Bloom filters, 64 bits a row,
by commit and bucket; and a log with one row a commit, written last. A batch's keys are looked up in the filters of their
own buckets; keys that the filters don't know are new. Only where a filter knows all bits of a key is the bucket itself
read, its key column alone. A filter that is too full makes more buckets be read, and nothing else.

A commit is a checkpoint's batch. One that is in the log is not written again; one that is not, say after a failure, replaces
what it had left. Readers (`committed`) see the commits of the log alone.

A null key is a key like others. Of a batch's rows of one key the first in `order` stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from motionframe.session import written

BUCKETS, BITS, HASHES = 64, 1 << 20, 4
FILTERS = "word int, bits bigint, commit string, bucket int"
LOG = "commit string, rows bigint, new bigint, buckets_read array<int>"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _hash(key: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), key, key.isNull())


def _bits(key: Column, bits: int) -> Column:
    """The filter's bits that a key sets: structs (word, bit)."""
    at = [(F.pmod(_hash(key, 1), F.lit(bits)) + F.lit(i) * F.pmod(_hash(key, 2), F.lit(bits))) % bits for i in range(HASHES)]
    return F.array_distinct(F.array(*(F.struct(F.shiftright(p, 6).cast("int").alias("word"), F.expr("1L").alias("one"), p.bitwiseAND(63).cast("int").alias("bit")) for p in at)))


def append_new(batch: DataFrame, target: str, key: str, commit: str, order: list[str] = [], buckets: int = BUCKETS, bits: int = BITS) -> None:  # noqa: B006
    """Add the batch's rows with new keys to target, under this commit."""
    spark = batch.sparkSession
    log = _read(spark, f"{target}/log", LOG)
    if not log.where(F.col("commit") == commit).isEmpty():
        return
    rest = [c for c in batch.columns if c != key]
    first = batch.groupBy(key).agg(F.min(F.struct(*order, *(c for c in rest if c not in order))).alias("__row"))
    rows = written(first.select(key, *(F.col(f"__row.{c}").alias(c) for c in rest)).withColumn("bucket", F.pmod(_hash(F.col(key), 0), F.lit(buckets)).cast("int")), "incoming")
    there = log.select("commit")
    touched = [r["bucket"] for r in rows.select("bucket").distinct().collect()]  # of a fixed number of buckets
    filters = _read(spark, f"{target}/filters", FILTERS).where(F.col("bucket").isin(touched)).join(there, "commit", "left_semi").groupBy("bucket", "word").agg(F.bit_or("bits").alias("bits"))
    asked = rows.select(key, "bucket", F.inline(_bits(F.col(key), bits)))
    known = asked.join(filters, ["bucket", "word"], "left").groupBy(key, "bucket").agg(F.every(F.coalesce(F.getbit("bits", "bit") == 1, F.lit(False))).alias("known"))
    maybe = written(known.where("known").select(F.col(key).alias("__key"), "bucket"), "maybe")
    reread = sorted(r["bucket"] for r in maybe.select("bucket").distinct().collect())
    if reread:
        old = spark.read.schema(f"`{key}` {dict(batch.dtypes)[key]}, commit string, bucket int").parquet(f"{target}/data")
        old = old.where(F.col("bucket").isin(reread)).join(there, "commit", "left_semi").select(F.col(key).alias("__old"))
        found = maybe.join(old, F.col("__key").eqNullSafe(F.col("__old")), "left_semi").select("__key")
        rows = rows.join(found, F.col(key).eqNullSafe(F.col("__key")), "left_anti")
    rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{target}/data/commit={commit}")
    new = spark.read.schema(f"`{key}` {dict(batch.dtypes)[key]}, bucket int").parquet(f"{target}/data/commit={commit}")
    words = new.select("bucket", F.inline(_bits(F.col(key), bits))).groupBy("bucket", "word").agg(F.bit_or(F.expr("shiftleft(one, bit)")).alias("bits"))
    words.write.mode("overwrite").partitionBy("bucket").parquet(f"{target}/filters/commit={commit}")
    done = spark.createDataFrame([(commit, first.count(), new.count(), reread)], LOG)
    done.coalesce(1).write.mode("append").parquet(f"{target}/log")


def committed(spark: SparkSession, target: str) -> DataFrame:
    """The rows of all commits in the log."""
    return spark.read.parquet(f"{target}/data").join(_read(spark, f"{target}/log", LOG).select("commit"), "commit", "left_semi").drop("commit", "bucket")


def incremental(stream: DataFrame, target: str, key: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] = lambda df: df, order: list[str] = [], buckets: int = BUCKETS):  # noqa: B006
    """A started query that appends what is new by key for all that is there now."""
    run = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def write(batch: DataFrame, epoch: int) -> None:
        append_new(transform(batch), target, key, f"{run}-{epoch}", order, buckets)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
