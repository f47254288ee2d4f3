"""Dataset versions: manifest differences and checksums, shards, costs, parameter contexts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motionframe.functions import scalar as S


def manifest_diff(before: DataFrame, after: DataFrame, key: str = "key", digest: str = "sha256", size: str = "size_bytes") -> DataFrame:
    """(key, change, added_bytes, removed_bytes) of each entry that was added, removed or modified."""
    a = before.select(key, F.col(digest).alias("__a"), F.col(size).alias("__x"))
    b = after.select(key, F.col(digest).alias("__b"), F.col(size).alias("__y"))
    both = a.join(b, key, "full_outer").where(~F.col("__a").eqNullSafe(F.col("__b")))
    change = F.when(F.col("__a").isNull(), "added").when(F.col("__b").isNull(), "removed").otherwise("modified")
    return both.select(key, change.alias("change"), F.coalesce("__y", F.lit(0)).alias("added_bytes"), F.coalesce("__x", F.lit(0)).alias("removed_bytes"))


def diff_summary(diff: DataFrame) -> DataFrame:
    n = lambda c: F.count_if(F.col("change") == c).alias(c)
    return diff.agg(n("added"), n("removed"), n("modified"), F.sum("added_bytes").alias("added_bytes"), F.sum("removed_bytes").alias("removed_bytes"), F.sum(F.col("added_bytes") - F.col("removed_bytes")).alias("net_bytes"))


def checksum(entries: DataFrame, by: str = "version", digest: str = "sha256") -> DataFrame:
    """SHA-256 of all digests in order, one after another: one value for each version, of all its files.

    A version's digests are sorted on disk and streamed through one hash, so that memory does not grow with them. Null
    digests are left out; a version with no other has the hash of nothing.
    """
    rows = entries.select(F.col(by).alias("by"), F.col(digest).cast("string").alias("digest"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = last = total = None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([at, pa.array([total.hexdigest()])], names=["by", "checksum"])

        for batch in batches:
            versions = batch.column(0)
            for i, (version, value) in enumerate(zip(versions.to_pylist(), batch.column(1).to_pylist())):
                if total is None or version != last:
                    if total is not None:
                        yield row()
                    at, last, total = versions.slice(i, 1), version, hashlib.sha256()
                if value is not None:
                    total.update(value.encode())
        if total is not None:
            yield row()

    kind = rows.schema["by"].dataType.simpleString()
    out = rows.repartition("by").sortWithinPartitions("by", "digest").mapInArrow(run, f"by {kind}, checksum string")
    return out.select(F.col("by").alias(by), "checksum")


def version_order(versions: DataFrame) -> DataFrame:
    return versions.orderBy(S.parse_version(F.col("version")))


def latest_version(versions: DataFrame) -> DataFrame:
    return versions.agg(F.max_by("version", S.parse_version(F.col("version"))).alias("version"))


def shard_offsets(episodes: DataFrame, shard: str = "shard", episode: str = "episode_id", n: str = "n") -> DataFrame:
    """[start, end) of each episode's states in its shard, and of its actions, which are one fewer."""
    w = Window.partitionBy(shard).orderBy(episode).rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(w), F.lit(0))
    acts = F.greatest(F.col(n) - 1, F.lit(0))
    rows = episodes.withColumn("__a", acts)
    return rows.select(shard, episode, before(n).alias("state_start"), (before(n) + F.col(n)).alias("state_end"), before("__a").alias("action_start"), (before("__a") + F.col("__a")).alias("action_end"))


def class_costs(files: DataFrame, pattern: str = "cold", provider: str = "s3") -> DataFrame:
    """Bytes of each storage class with their cost now and in the class that suits the pattern."""
    best = S.recommended_class(F.lit(pattern), F.lit(365), provider)
    per = files.groupBy(F.coalesce("storage_class", F.lit("STANDARD")).alias("storage_class")).agg(F.sum("size_bytes").alias("bytes"))
    return per.select("storage_class", "bytes", S.storage_cost(F.col("bytes"), F.col("storage_class"), 1, provider).alias("current_cost"), S.storage_cost(F.col("bytes"), best, 1, provider).alias("optimized_cost"), best.alias("recommended_class"))


def cost_savings(files: DataFrame, pattern: str = "cold", provider: str = "s3") -> DataFrame:
    best = S.recommended_class(F.lit(pattern), F.lit(365), provider)
    one = class_costs(files, pattern, provider).agg(F.sum("bytes").alias("b"), F.sum("current_cost").alias("current"))
    opt = S.storage_cost(F.col("b"), best, 1, provider)
    return one.select(F.bround("current", 2).alias("current_cost"), F.bround(opt, 2).alias("optimized_cost"), F.bround(F.col("current") - opt, 2).alias("savings"), F.bround(S.ratio(F.col("current") - opt, F.col("current"), 0.0, 100.0), 1).alias("savings_percent"))


def context_diff(a: DataFrame, b: DataFrame, column: str = "params", key: str = "context_id", ignore: list[str] = ["captured_at"]) -> DataFrame:
    """(key, name, before, after) of each parameter that differs; a parameter that is absent is null."""
    one = lambda df, out: df.select(key, F.explode(column).alias("name", out)).where(~F.col("name").isin(ignore))
    return one(a, "before").join(one(b, "after"), [key, "name"], "full_outer").where(~F.col("before").eqNullSafe(F.col("after")))


def reproducible(diff: DataFrame, critical: list[str], key: str = "context_id") -> DataFrame:
    """Contexts with how many critical parameters differ."""
    return diff.groupBy(key).agg(F.count_if(F.col("name").isin(critical)).alias("critical"), F.count(F.lit(1)).alias("changed"))


def key_sets(a: DataFrame, b: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(keys only in b, keys only in a)."""
    x, y = a.select(key), b.select(key)
    return y.subtract(x), x.subtract(y)


def result_path(base: str, kind: Column, platform: Column, video: Column, version: Column) -> Column:
    return F.concat_ws("/", F.lit(base), kind, platform, video, version)


def dated_key(prefix: str, at: Column, name: Column) -> Column:
    return F.concat_ws("/", F.lit(prefix), F.date_format(at, "yyyy/MM/dd"), name)


def cost_recommendations(files: DataFrame, pattern: str = "cold", retention_days: int = 365) -> DataFrame:
    """(type, storage_class, recommended_class, bytes, monthly savings): files that are not compressed (7 tenths of them would
    go), and the standard class for files that are not read often. files: size_bytes, storage_class, compression."""
    to = S.recommended_class(F.lit(pattern), F.lit(retention_days))
    loose = F.coalesce(F.col("compression"), F.lit("")) == ""
    packed = files.where(loose).agg(F.sum("size_bytes").alias("bytes")).where("bytes > 0")
    packed = packed.select(F.lit("compression").alias("type"), F.lit(None).cast("string").alias("storage_class"), to.alias("recommended_class"), "bytes", S.storage_cost(F.floor(F.col("bytes") * 0.7), to).alias("savings"))
    if pattern == "hot":
        return packed
    moved = files.where("storage_class = 'STANDARD'").groupBy("storage_class").agg(F.sum("size_bytes").alias("bytes"))
    saved = S.storage_cost(F.col("bytes"), F.col("storage_class")) - S.storage_cost(F.col("bytes"), to)
    return packed.unionByName(moved.select(F.lit("storage_class").alias("type"), "storage_class", to.alias("recommended_class"), "bytes", saved.alias("savings")))
