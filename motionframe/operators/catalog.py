"""Catalogue operators: filters, joins, upserts and aggregates on tables of videos, jobs, files, keywords and versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from motionframe.functions import scalar as S
from motionframe.operators.ranges import running_sums

# --- filters


def list_by(df: DataFrame, equal: dict[str, object], newest: str, limit: int | None = None, offset: int = 0, tie: str | None = None) -> DataFrame:
    """Rows with the given values (None: any), newest first, a page of them."""
    for c, v in equal.items():
        if v is not None:
            df = df.where(F.col(c) == v)
    df = df.orderBy(F.col(newest).desc(), *([tie] if tie else []))
    if offset:
        df = df.offset(offset)
    return df.limit(limit) if limit is not None else df


def search_jobs(jobs: DataFrame, query: str | None = None, stage: str | None = None, status: str | None = None, limit: int = 100, offset: int = 0) -> DataFrame:
    """Jobs whose key, video or failure reason contains query in any case, newest first."""
    if query:
        like = "%" + query.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_") + "%"
        jobs = jobs.where(F.col("job_key").ilike(like) | F.col("video_id").ilike(like) | F.col("failure_reason").ilike(like))
    return list_by(jobs, {"stage": stage, "status": status}, "created_at", limit, offset, "job_key")


def list_keywords(keywords: DataFrame, category: int | None = None, language: str | None = None, active: bool | None = True, min_priority: int | None = None, limit: int | None = None) -> DataFrame:
    if min_priority is not None:
        keywords = keywords.where(F.col("priority") >= min_priority)
    return list_by(keywords, {"category_id": category, "language": language, "is_active": active}, "priority", limit, tie="keyword_id")


def skip_reason(max_retries: str = "max_retries", status: str = "status", retries: str = "retry_count", failure: str = "failure_type") -> Column:
    """Why a job is not run again, or null if it is: a quality failure stays one whatever the status, and each job has its limit."""
    return F.when(F.col(status) == "completed", "completed").when(F.col(failure) == "quality", "quality_failed").when(F.col(retries) >= F.col(max_retries), "retries_exhausted")


def by_prefix(df: DataFrame, column: str, prefix: str, negate: bool = False) -> DataFrame:
    """Rows whose column begins with prefix, or those whose column does not; a null is in neither."""
    found = F.col(column).startswith(prefix)
    return df.where(~found if negate else found)


def among(df: DataFrame, others: DataFrame, key: str, negate: bool = False) -> DataFrame:
    """Rows whose key others have, or those whose key they lack."""
    return df.join(others.select(key).distinct(), key, "left_anti" if negate else "left_semi")


def lookup(df: DataFrame, **equal: object) -> DataFrame:
    """Rows by id, digest, address, episode or version: each given column has its value, or one of a list."""
    for c, v in equal.items():
        df = df.where(F.col(c).isin(*v) if isinstance(v, (list, tuple, set)) else F.col(c) == v)
    return df


def queue_order(tasks: DataFrame) -> DataFrame:
    """Waiting tasks and the place, from 1, in which a queue gives them out: the highest priority first, and among equals the first that came."""
    waiting = tasks.where(F.col("status").isin("pending", "queued"))
    return running_sums(waiting, [], [F.col("priority").desc(), "created_at", "task_id"], place=F.lit(1))


def requeued(tasks: DataFrame, failed: DataFrame, retry: bool = True, key: str = "task_id") -> DataFrame:
    """tasks after those of failed (key, error) failed: one more retry and a lower priority, or failed for good at the limit."""
    hit = failed.groupBy(key).agg(F.max("error").alias("__error"), F.lit(True).alias("__hit"))
    both = tasks.join(hit, key, "left")
    tries = F.col("retry_count") + 1
    again = F.lit(retry) & (tries < F.col("max_retries"))
    new = {
        "status": F.when(again, "pending").otherwise("failed"),
        "priority": F.when(again, F.greatest(F.lit(1), F.col("priority") - 1)).otherwise(F.col("priority")),
        "retry_count": tries,
        "error": F.col("__error"),
    }
    return both.select(*(F.when(F.col("__hit"), new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in tasks.columns))


def retryable(jobs: DataFrame, kind: str = "network") -> DataFrame:
    return jobs.where((F.col("status") == "failed") & (F.col("failure_type") == kind) & (F.col("retry_count") < F.col("max_retries")))


def pending_uploads(tasks: DataFrame, limit: int | None = None) -> DataFrame:
    out = tasks.where((F.col("status") == "pending") & (F.col("retry_count") < F.col("max_retries"))).orderBy("priority", "created_at", "task_id")
    return out.limit(limit) if limit is not None else out


def without_old(tasks: DataFrame, as_of: Column, days: int) -> DataFrame:
    """tasks without those completed more than days before as_of."""
    return tasks.where(~F.coalesce((F.col("status") == "completed") & (F.col("completed_at") < as_of - F.make_interval(days=F.lit(days))), F.lit(False)))


def older_than(files: DataFrame, as_of: Column, hours: float, modified: str = "modified_at") -> DataFrame:
    return files.where(S.micros(modified) < S.micros(as_of) - F.lit(int(hours * 3_600_000_000)))


def active_versions(versions: DataFrame) -> DataFrame:
    return versions.where("is_active").orderBy(F.col("created_at").desc(), F.col("version").desc())


def deactivated(versions: DataFrame, version: str) -> DataFrame:
    return versions.withColumn("is_active", F.when(F.col("version") == version, F.lit(False)).otherwise(F.col("is_active")))


def valid_metadata(has_video: Column, duration: Column, width: Column, height: Column) -> Column:
    return F.coalesce(has_video & (duration > 0) & width.isNotNull() & height.isNotNull(), F.lit(False))


def readiness(confidence: Column, frames: Column) -> Column:
    """struct(ready, high_quality) of an episode."""
    return F.struct(((confidence > 0.1) & (frames >= 5)).alias("ready"), (confidence > 0.3).alias("high_quality"))


def to_download(videos: DataFrame, limit: int | None = None) -> DataFrame:
    out = videos.where((F.col("status") == "discovered") & F.col("url").isNotNull()).orderBy("video_id")
    return out.limit(limit) if limit is not None else out


# --- joins and upserts


def top_keywords_by(keywords: DataFrame, performance: DataFrame, metric: str, limit: int) -> DataFrame:
    return keywords.join(performance, "keyword_id").orderBy(F.col(metric).desc(), "keyword_id").limit(limit)


def insert_absent(existing: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """existing, and of the rows of new for each key that it lacks the first in order."""
    first = new.groupBy(key).agg(F.min_by(F.struct(*new.columns), F.struct(order, *(c for c in new.columns if c not in (key, order)))).alias("__r")).select("__r.*")
    return existing.unionByName(first.join(existing.select(key), key, "left_anti"), allowMissingColumns=True)


def is_blank(c: str, kind: str) -> Column:
    col = F.col(c)
    if kind == "string":
        return col.isNull() | (col == "")
    if kind.startswith("array") or kind.startswith("map"):
        return col.isNull() | (F.size(col) == 0)
    if kind in ("boolean",):
        return col.isNull() | ~col
    if kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal"):
        return col.isNull() | (col == 0)
    return col.isNull()


def fill_blanks(existing: DataFrame, new: DataFrame, key: str, columns: list[str], order: str | None = None) -> DataFrame:
    """Upsert that keeps what is there: columns that are blank take the new value, absent keys are added.

    Where new has several rows of a key, each column takes the first in order that is not blank.
    """
    kinds = dict(existing.dtypes)
    place = F.struct(*([order] if order else []), *columns)
    value = lambda c: F.min_by(c, F.when(~is_blank(c, kinds[c]), place))
    given = new.groupBy(key).agg(*(value(c).alias(f"__{c}") for c in columns))
    both = existing.join(given, key, "full_outer")
    return both.select(*(F.when(is_blank(c, kinds[c]), F.coalesce(F.col(f"__{c}"), F.col(c))).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in existing.columns))


def latest_jobs(log: DataFrame, key: str = "job_key", at: str = "updated_at", started: str = "started_at") -> DataFrame:
    """The latest row of each key, with the first start: max_by and min combine before the shuffle."""
    rest = [c for c in log.columns if c not in (key, started)]
    agg = log.groupBy(key).agg(F.max(F.struct(F.col(at).alias("__at"), *rest)).alias("__row"), F.min(started).alias(started))
    return agg.select(key, *(F.col(f"__row.{c}").alias(c) for c in rest), started)


def scores_by_prefix(episodes: DataFrame, scores: DataFrame) -> DataFrame:
    """Episodes with the score of the video that their id is made of: an equality join on the parsed id."""
    video, _ = S.parse_episode_id(F.col("episode_id"))
    return episodes.withColumn("__video", video).join(scores.withColumnRenamed("video_id", "__video"), "__video", "left").drop("__video")


def registered(episodes: DataFrame, uploads: DataFrame) -> DataFrame:
    """Episodes with the place of their upload; uploads of unknown episodes become episodes."""
    joined = episodes.join(uploads.select("episode_id", F.col("uri").alias("__uri")), "episode_id", "left").withColumn("cloud_path", F.coalesce("__uri", "cloud_path")).drop("__uri")
    fresh = uploads.join(episodes.select("episode_id"), "episode_id", "left_anti").select("episode_id", F.col("uri").alias("cloud_path"))
    return joined.unionByName(fresh, allowMissingColumns=True)


def dependants(children: DataFrame, removed: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(children to delete, children that stay) when the rows `removed` go."""
    gone = removed.select(key).distinct()
    return children.join(gone, key, "left_semi"), children.join(gone, key, "left_anti")


def not_uploaded(local: DataFrame, remote: DataFrame) -> DataFrame:
    return local.join(remote.select("key", "sha256"), ["key", "sha256"], "left_anti")


def not_done(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return todo.join(done.select(key), key, "left_anti")


def merged(table: DataFrame, changes: DataFrame, key: str, delete: str | None = None) -> DataFrame:
    """Batch maintenance by key: given values replace old ones, absent keys are inserted, flagged rows are deleted."""
    flag = F.coalesce(F.col(delete), F.lit(False)) if delete else F.lit(False)
    columns = [c for c in table.columns if c != key and c in changes.columns]
    given = changes.select(key, F.lit(True).alias("__given"), flag.alias("__gone"), *(F.col(c).alias(f"__{c}") for c in columns))
    both = table.join(given, key, "full_outer").where(~F.coalesce("__gone", F.lit(False)))
    return both.select(*(F.coalesce(F.col(f"__{c}"), F.col(c)).alias(c) if c in columns else F.col(c) for c in table.columns))


def retried(tasks: DataFrame, failed_ids: DataFrame, key: str = "task_id") -> DataFrame:
    """Failed tasks get one more retry and are pending again."""
    hit = failed_ids.select(F.col(key), F.lit(True).alias("__hit")).distinct()
    both = tasks.join(hit, key, "left")
    return both.withColumn("retry_count", F.col("retry_count") + F.coalesce(F.col("__hit").cast("int"), F.lit(0))).withColumn("status", F.when(F.col("__hit"), "pending").otherwise(F.col("status"))).drop("__hit")


def download_results(videos: DataFrame, results: DataFrame) -> DataFrame:
    """Videos after a download log: the latest result of each; success fills path and duration, failure sets the status."""
    last = results.groupBy("video_id").agg(F.max(F.struct("at", "success", "local_path", "duration_sec")).alias("r"))
    both = videos.join(last, "video_id", "left")
    ok = F.col("r.success")
    return both.select(
        *(c for c in videos.columns if c not in ("status", "local_path", "duration_sec")),
        F.when(ok, "downloaded").when(~ok, "failed").otherwise(F.col("status")).alias("status"),
        F.when(ok, F.col("r.local_path")).otherwise(F.col("local_path")).alias("local_path"),
        F.when(ok, F.coalesce("r.duration_sec", "duration_sec")).otherwise(F.col("duration_sec")).alias("duration_sec"),
    )


def duplicate_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """How many rows share their values in columns with another row, all of them counted."""
    return df.groupBy(*columns).count().where("count > 1").agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n_duplicates"))


# --- aggregates


def status_counts(jobs: DataFrame, statuses: list[str]) -> DataFrame:
    """One row, one pass: the total, the count of each status, and the depth of the queue."""
    return jobs.agg(F.count(F.lit(1)).alias("total"), *(F.count_if(F.col("status") == s).alias(s) for s in statuses), F.count_if(F.col("status").isin("pending", "queued")).alias("queue_depth"))


def pipeline_kpi(videos: DataFrame, jobs: DataFrame, episodes: DataFrame, costs: DataFrame, high_quality: float = 0.8) -> DataFrame:
    v = videos.agg(F.count(F.lit(1)).alias("total_videos"), F.count_if(F.col("status") == "downloaded").alias("downloaded"))
    e = episodes.agg(F.count(F.lit(1)).alias("total_episodes"), F.count_if(F.col("quality_score") >= high_quality).alias("high_quality"))
    ok = F.col("status") == "completed"
    j = jobs.agg((F.count_if(ok) / F.greatest(F.count(F.lit(1)), F.lit(1))).alias("success_rate"), F.coalesce(F.avg(F.when(ok, F.col("processing_sec"))), F.lit(0.0)).alias("mean_processing_sec"))
    c = costs.agg(F.coalesce(F.max_by("total_cost", "period_end"), F.lit(0.0)).alias("latest_cost"))
    return v.crossJoin(e).crossJoin(j).crossJoin(c)  # one row each


def overview(jobs: DataFrame, episodes: DataFrame, as_of: Column, hours: int, high_quality: float = 0.7) -> DataFrame:
    since = S.micros(as_of) - F.lit(hours * 3_600_000_000)
    j = jobs.where(S.micros("created_at") >= since).agg(F.count(F.lit(1)).alias("jobs"), F.round(S.ratio(F.count_if(F.col("status") == "failed"), F.count(F.lit(1)), 0.0, 100.0), 2).alias("error_pct"))
    e = episodes.where(S.micros("created_at") >= since).agg(F.count(F.lit(1)).alias("episodes"), F.count_if(F.col("quality_score") >= high_quality).alias("high_quality"))
    return j.crossJoin(e)  # one row each


def file_stats(files: DataFrame, by: list[str] | None = None) -> DataFrame:
    zero = lambda c, z: F.coalesce(c, F.lit(z))
    return files.groupBy(*(by or [])).agg(F.count(F.lit(1)).alias("n_files"), zero(F.sum("size_bytes"), 0).alias("total_bytes"), zero(F.avg("compression_ratio"), 0.0).alias("mean_ratio"))


def period_cost(costs: DataFrame, start: Column, end: Column, provider: str | None = None) -> DataFrame:
    rows = costs.where((F.col("period_start") >= start) & (F.col("period_end") <= end))
    if provider:
        rows = rows.where(F.col("provider") == provider)
    return rows.agg(F.coalesce(F.sum("total_cost"), F.lit(0.0)).alias("total_cost"))


def batch_stats(results: DataFrame) -> DataFrame:
    return results.agg(S.ratio(F.count_if(F.col("success")), F.count(F.lit(1))).alias("success_rate"), F.coalesce(F.avg(F.when(F.col("success"), F.col("seconds"))), F.lit(0.0)).alias("avg_seconds"), F.coalesce(F.avg(F.when(F.col("success"), F.col("frames"))), F.lit(0.0)).alias("frames_per_video"))


def keyword_rates(searches: DataFrame) -> DataFrame:
    """Counters of each keyword and the rates made of them; 0 where there is nothing to divide by."""
    agg = searches.groupBy("keyword_id").agg(F.count(F.lit(1)).alias("searches"), F.sum("found").alias("found"), F.sum("downloaded").alias("downloaded"), F.sum("high_quality").alias("high_quality"))
    return agg.withColumns({"videos_per_search": S.ratio(F.col("found"), F.col("searches")), "success_rate": S.ratio(F.col("downloaded"), F.col("found")), "quality_per_video": S.ratio(F.col("high_quality"), F.col("downloaded"))})


def error_summary(errors: DataFrame) -> DataFrame:
    """Counts by type, by severity and by retryable in one pass: (dimension, value, n)."""
    sets = errors.groupingSets([["error_type"], ["severity"], ["retryable"]], "error_type", "severity", "retryable").agg(F.grouping_id().alias("g"), F.count(F.lit(1)).alias("n"))
    return sets.select(F.when(F.col("g") == 3, "error_type").when(F.col("g") == 5, "severity").otherwise("retryable").alias("dimension"), F.coalesce("error_type", "severity", "retryable").alias("value"), "n")


def manifest_totals(entries: DataFrame) -> DataFrame:
    count = lambda kind: F.count_if(F.col("file_type") == kind)
    return entries.groupBy("version").agg(F.count(F.lit(1)).alias("n_files"), F.sum("size_bytes").alias("total_bytes"), count("episode_npz").alias("n_episodes"), count("video_mp4").alias("n_videos"))


def storage_summary(files: DataFrame) -> DataFrame:
    one = lambda f, c: f("key", F.struct(c, "key"))
    return files.agg(F.count(F.lit(1)).alias("n"), F.sum("size_bytes").alias("total_bytes"), F.avg("size_bytes").alias("avg_bytes"), one(F.min_by, "modified_at").alias("oldest"), one(F.max_by, "modified_at").alias("newest"))


def upload_progress(results: DataFrame) -> DataFrame:
    count = lambda s: F.count_if(F.col("status") == s)
    total, sec = F.count(F.lit(1)), F.sum("seconds")
    return results.groupBy("batch_id").agg(
        total.alias("total"), count("completed").alias("completed"), count("failed").alias("failed"), count("skipped").alias("skipped"),
        S.ratio(count("completed"), total, 0.0, 100.0).alias("success_pct"), S.ratio(F.sum(F.when(F.col("status") == "completed", F.col("size_bytes")).otherwise(0)), sec).alias("bytes_per_sec"),
    )


def recent_errors(jobs: DataFrame, n: int = 100) -> DataFrame:
    last = jobs.where(F.col("status") == "failed").orderBy(F.col("created_at").desc(), "job_key").limit(n)
    return last.groupBy("failure_type").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "failure_type")


def hourly(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy(F.date_trunc("hour", "created_at").alias("hour")).agg(F.count(F.lit(1)).alias("jobs"), F.count_if(F.col("status") == "failed").alias("errors"))


def daily_cost(costs: DataFrame) -> DataFrame:
    return costs.groupBy(F.to_date("period_end").alias("day")).agg(F.sum("total_cost").alias("cost"))


def labelled_counts(jobs: DataFrame, labels: list[str]) -> DataFrame:
    return jobs.groupBy(*labels).agg(F.count(F.lit(1)).alias("value"))


def duration_buckets(jobs: DataFrame, label: str, value: str, bounds: list[float]) -> DataFrame:
    """Cumulative buckets of each label: (label, le, n); le is null for all."""
    counts = jobs.groupBy(label).agg(*(F.count_if(F.col(value) <= b).alias(str(i)) for i, b in enumerate(bounds)), F.count(value).alias("all"))
    rows = F.array(*(F.struct(F.lit(float(b)).alias("le"), F.col(str(i)).alias("n")) for i, b in enumerate(bounds)), F.struct(F.lit(None).cast("double").alias("le"), F.col("all").alias("n")))
    return counts.select(label, F.inline(rows))


def bucket_quantile(buckets: DataFrame, label: str, q: float) -> DataFrame:
    """The quantile of each label from its cumulative buckets, by linear interpolation in the bucket that holds it."""
    w = Window.partitionBy(label).orderBy(F.col("le").asc_nulls_last())
    total = F.max("n").over(Window.partitionBy(label))
    rows = buckets.withColumns({"rank": total * q, "below": F.coalesce(F.lag("n").over(w), F.lit(0)), "lower": F.coalesce(F.lag("le").over(w), F.lit(0.0))})
    hit = rows.where((F.col("n") >= F.col("rank")) & (F.col("below") < F.col("rank")))
    return hit.select(label, F.when(F.col("le").isNull(), F.col("lower")).otherwise(F.col("lower") + (F.col("le") - F.col("lower")) * (F.col("rank") - F.col("below")) / (F.col("n") - F.col("below"))).alias("quantile"))


def stage_files(files: DataFrame) -> DataFrame:
    """Files and bytes of each stage, the first folder of a key."""
    return files.groupBy(F.split_part("key", F.lit("/"), F.lit(1)).alias("stage")).agg(F.count(F.lit(1)).alias("n_files"), F.sum("size_bytes").alias("total_bytes"))
