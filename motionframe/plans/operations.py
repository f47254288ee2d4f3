"""Queries over queues, uploads, costs, versions and names: operators that keep a catalogue in order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motionframe.functions import scalar as S
from motionframe.operators import catalog as K
from motionframe.operators import monitoring as M
from motionframe.operators import profiling as P
from motionframe.operators import versions as V
from motionframe.plans.catalogue import FILES, JOBS, files, jobs, us
from motionframe.plans.registry import Registry
from motionframe.session import table

R = Registry()


def tasks(s: SparkSession, d: str) -> DataFrame:
    j = jobs(s, d)
    return j.select(F.col("event_id").alias("task_id"), (F.col("event_id") % 7).alias("priority"), "created_at", "status", "retry_count", "max_retries", "completed_at", F.lit(None).cast("string").alias("error"))


TASKS = f"{JOBS}, tasks AS (SELECT event_id AS task_id, event_id % 7 AS priority, created_at, status, retry_count, max_retries, completed_at FROM jobs)"


def _failed(s: SparkSession, d: str) -> DataFrame:
    return tasks(s, d).where("task_id % 4 = 1").select("task_id", F.concat(F.lit("e"), F.col("task_id") % 3).alias("error"))


R.add("requeued", lambda s, d: K.requeued(tasks(s, d), _failed(s, d)).select("task_id", "priority", "status", "retry_count", "error"), f"WITH {TASKS} SELECT task_id, CASE WHEN task_id % 4 = 1 AND retry_count + 1 < max_retries THEN greatest(1, priority - 1) ELSE priority END AS priority, CASE WHEN task_id % 4 != 1 THEN status WHEN retry_count + 1 < max_retries THEN 'pending' ELSE 'failed' END AS status, CASE WHEN task_id % 4 = 1 THEN retry_count + 1 ELSE retry_count END AS retry_count, CASE WHEN task_id % 4 = 1 THEN 'e' || task_id % 3 END AS error FROM tasks")
R.add("retried", lambda s, d: K.retried(tasks(s, d), _failed(s, d)).select("task_id", "status", "retry_count"), f"WITH {TASKS} SELECT task_id, CASE WHEN task_id % 4 = 1 THEN 'pending' ELSE status END AS status, CASE WHEN task_id % 4 = 1 THEN retry_count + 1 ELSE retry_count END AS retry_count FROM tasks")
R.add(
    "queue_order",
    lambda s, d: K.queue_order(tasks(s, d)).select("task_id", "priority", "place"),
    f"WITH {TASKS} SELECT task_id, priority, row_number() OVER (ORDER BY priority DESC, created_at, task_id) AS place FROM tasks WHERE status IN ('pending', 'queued')",
)
R.add("pending_uploads", lambda s, d: K.pending_uploads(tasks(s, d), 40).select("task_id", "priority"), f"WITH {TASKS} SELECT task_id, priority FROM tasks WHERE status = 'pending' AND retry_count < max_retries ORDER BY priority, created_at, task_id LIMIT 40")
R.add("without_old", lambda s, d: K.without_old(tasks(s, d), F.lit("2024-01-31 00:00:00").cast("timestamp"), 7).select("task_id", "status"), f"WITH {TASKS} SELECT task_id, status FROM tasks WHERE NOT (status = 'completed' AND completed_at < TIMESTAMP '2024-01-24 00:00:00')")
R.add("by_prefix", lambda s, d: K.by_prefix(jobs(s, d), "video_id", "v1").groupBy("video_id").agg(F.count(F.lit(1)).alias("n")).unionByName(K.by_prefix(jobs(s, d), "video_id", "v1", True).agg(F.lit("others").alias("video_id"), F.count(F.lit(1)).alias("n"))), f"WITH {JOBS} SELECT video_id, count(*) AS n FROM jobs WHERE video_id LIKE 'v1%' GROUP BY 1 UNION ALL SELECT 'others' AS video_id, count(*) AS n FROM jobs WHERE video_id NOT LIKE 'v1%'")
R.add("customers_among", lambda s, d: K.among(table(s, d, "customer"), table(s, d, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey").select("c_custkey"), "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
R.add("customers_without", lambda s, d: K.among(table(s, d, "customer"), table(s, d, "orders").where("o_orderkey % 3 = 0").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", True).select("c_custkey"), "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 3 = 0)")
R.add("lookup", lambda s, d: K.lookup(files(s, d), storage_class=["STANDARD", "GLACIER"], key="k3").unionByName(K.lookup(files(s, d), storage_class="STANDARD_IA", key=["k4", "k7", "none"])).select("key", "sha256", "storage_class"), f"WITH {FILES} SELECT key, sha256, storage_class FROM files WHERE key IN ('k3', 'k4', 'k7')")
R.add("not_uploaded", lambda s, d: K.not_uploaded(files(s, d), files(s, d).where("size_bytes % 5 != 0").withColumn("sha256", F.when(F.col("size_bytes") % 7 == 0, "old").otherwise(F.col("sha256")))).select("key"), f"WITH {FILES} SELECT key FROM files WHERE size_bytes % 5 = 0 OR size_bytes % 7 = 0")


def costs(s: SparkSession, d: str) -> DataFrame:
    o = table(s, d, "orders")
    return o.select((F.col("o_orderdate") - F.make_interval(days=F.lit(1))).alias("period_start"), F.col("o_orderdate").alias("period_end"), F.floor("o_totalprice").alias("total_cost"), F.when(F.col("o_orderkey") % 2 == 0, "s3").otherwise("gcs").alias("provider"))


COSTS = "costs AS (SELECT o_orderdate - INTERVAL 1 DAY AS period_start, o_orderdate AS period_end, CAST(floor(o_totalprice) AS BIGINT) AS total_cost, CASE WHEN o_orderkey % 2 = 0 THEN 's3' ELSE 'gcs' END AS provider FROM orders)"
R.add("daily_cost", lambda s, d: K.daily_cost(costs(s, d)).select(F.col("day").cast("string").alias("day"), "cost"), f"WITH {COSTS} SELECT CAST(CAST(period_end AS DATE) AS VARCHAR) AS day, sum(total_cost)::BIGINT AS cost FROM costs GROUP BY 1")
R.add("period_cost", lambda s, d: K.period_cost(costs(s, d), F.lit("1995-01-01").cast("timestamp"), F.lit("1996-01-01").cast("timestamp"), "s3").select(F.col("total_cost").cast("double").alias("total_cost")), f"WITH {COSTS} SELECT coalesce(sum(total_cost), 0)::DOUBLE AS total_cost FROM costs WHERE period_start >= TIMESTAMP '1995-01-01' AND period_end <= TIMESTAMP '1996-01-01' AND provider = 's3'")
R.add("batch_stats", lambda s, d: K.batch_stats(jobs(s, d).select((F.col("status") == "completed").alias("success"), F.col("processing_sec").alias("seconds"), (F.col("event_id") % 100).alias("frames"))).select(*(F.round(c, 6).alias(c) for c in ("success_rate", "avg_seconds", "frames_per_video"))), f"WITH {JOBS} SELECT round(count_if(status = 'completed') / count(*), 6) AS success_rate, round(avg(CASE WHEN status = 'completed' THEN processing_sec END), 6) AS avg_seconds, round(avg(CASE WHEN status = 'completed' THEN event_id % 100 END), 6) AS frames_per_video FROM jobs")
R.add("manifest_totals", lambda s, d: K.manifest_totals(files(s, d).select(F.col("storage_class").alias("version"), "size_bytes", F.when(F.col("size_bytes") % 3 == 0, "episode_npz").when(F.col("size_bytes") % 3 == 1, "video_mp4").otherwise("other").alias("file_type"))), f"WITH {FILES} SELECT storage_class AS version, count(*) AS n_files, sum(size_bytes)::BIGINT AS total_bytes, count_if(size_bytes % 3 = 0)::BIGINT AS n_episodes, count_if(size_bytes % 3 = 1)::BIGINT AS n_videos FROM files GROUP BY 1")
R.add("upload_progress", lambda s, d: K.upload_progress(jobs(s, d).select(F.col("stage").alias("batch_id"), "status", (F.col("event_id") % 50).alias("seconds"), (F.col("event_id") * 10).alias("size_bytes"))).select("batch_id", "total", "completed", "failed", "skipped", F.round("success_pct", 6).alias("success_pct"), F.round("bytes_per_sec", 4).alias("bytes_per_sec")), f"WITH {JOBS} SELECT stage AS batch_id, count(*) AS total, count_if(status = 'completed')::BIGINT AS completed, count_if(status = 'failed')::BIGINT AS failed, count_if(status = 'skipped')::BIGINT AS skipped, round(count_if(status = 'completed') * 100.0::DOUBLE / count(*), 6) AS success_pct, round(sum(CASE WHEN status = 'completed' THEN event_id * 10 ELSE 0 END)::DOUBLE / sum(event_id % 50), 4) AS bytes_per_sec FROM jobs GROUP BY 1")
R.add("stage_files", lambda s, d: K.stage_files(files(s, d).withColumn("key", F.concat_ws("/", "storage_class", "key"))), f"WITH {FILES} SELECT storage_class AS stage, count(*) AS n_files, sum(size_bytes)::BIGINT AS total_bytes FROM files GROUP BY 1")
R.add("newest_events", lambda s, d: M.newest(table(s, d, "events"), "ts", 25, "event_id").select("event_id", us("ts").alias("ts_us")), "SELECT event_id, epoch_us(ts) AS ts_us FROM events ORDER BY ts DESC, event_id LIMIT 25")
R.add("histogram_rows", lambda s, d: M.histogram_rows(K.status_counts(jobs(s, d), ["completed", "failed"])), f"WITH {JOBS}, x AS (SELECT count(*)::DOUBLE AS total, count_if(status = 'completed')::DOUBLE AS completed, count_if(status = 'failed')::DOUBLE AS failed, count_if(status IN ('pending', 'queued'))::DOUBLE AS queue_depth FROM jobs) UNPIVOT x ON total, completed, failed, queue_depth INTO NAME metric VALUE value")
R.add("job_events", lambda s, d: M.job_events(jobs(s, d)).groupBy("stage", "event", "outcome").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("seconds")).alias("seconds"), F.max(us("ts")).alias("last_us")), f"WITH {JOBS}, e AS (SELECT stage, started_at AS ts, 'start' AS event, NULL AS outcome, NULL::DOUBLE AS seconds FROM jobs UNION ALL SELECT stage, completed_at, 'end', status, epoch_us(completed_at) / 1e6 - epoch_us(started_at) / 1e6 FROM jobs) SELECT stage, event, outcome, count(*) AS n, round(sum(seconds)) AS seconds, max(epoch_us(ts)) AS last_us FROM e GROUP BY 1, 2, 3")
R.add("cost_recommendations", lambda s, d: V.cost_recommendations(files(s, d).withColumn("size_bytes", F.col("size_bytes") * 1000).withColumn("compression", F.when(F.col("size_bytes") % 3000 == 0, "gzip"))), f"""WITH {FILES}, f AS (SELECT storage_class, size_bytes * 1000 AS b FROM files), p AS (SELECT CAST(sum(b) AS BIGINT) AS b FROM f WHERE b % 3000 != 0), m AS (SELECT CAST(sum(b) AS BIGINT) AS b FROM f WHERE storage_class = 'STANDARD')
SELECT 'compression' AS type, NULL AS storage_class, 'GLACIER' AS recommended_class, b AS bytes, round_even(floor(b * 0.7::DOUBLE) / 1073741824.0 * 0.004, 4) AS savings FROM p WHERE b > 0 UNION ALL SELECT 'storage_class', 'STANDARD', 'GLACIER', b, round_even(b / 1073741824.0 * 0.025, 4) - round_even(b / 1073741824.0 * 0.004, 4) FROM m""")
R.add("active_versions", lambda s, d: K.active_versions(K.deactivated(table(s, d, "part").select(F.col("p_partkey").alias("version"), (F.col("p_partkey") % 3 != 0).alias("is_active"), F.col("p_partkey").alias("created_at")), "7")).select("version"), "SELECT p_partkey AS version FROM part WHERE p_partkey % 3 != 0 AND p_partkey != 7")
R.add("episode_videos", lambda s, d: K.scores_by_prefix(jobs(s, d).select(F.concat("video_id", F.lit("_ep"), F.lpad((F.col("event_id") % 3).cast("string"), 3, "0")).alias("episode_id")), jobs(s, d).groupBy("video_id").agg(F.count(F.lit(1)).alias("score"))).groupBy("episode_id").agg(F.max("score").alias("score")), f"WITH {JOBS}, c AS (SELECT video_id, count(*) AS score FROM jobs GROUP BY 1) SELECT DISTINCT j.video_id || '_ep00' || (event_id % 3) AS episode_id, score FROM jobs j JOIN c USING (video_id)")
R.add("registered", lambda s, d: K.registered(files(s, d).where("size_bytes % 3 != 0").select(F.col("key").alias("episode_id"), F.lit("old").alias("cloud_path")), files(s, d).where("size_bytes % 2 = 0").select(F.col("key").alias("episode_id"), F.concat(F.lit("s3://b/"), "key").alias("uri"))), f"WITH {FILES} SELECT key AS episode_id, CASE WHEN size_bytes % 2 = 0 THEN 's3://b/' || key ELSE 'old' END AS cloud_path FROM files WHERE size_bytes % 3 != 0 OR size_bytes % 2 = 0")
R.add("readable", lambda s, d: jobs(s, d).select("job_key", S.format_duration(F.col("event_id") * 360).alias("took"), S.format_size(F.col("event_id") * F.col("event_id") * 1000, "TB").alias("size"), S.resolution_label(F.col("event_id") % 2000, F.col("retry_count") * 360).alias("label"), S.video_summary(F.col("job_key"), F.col("event_id") / 7, F.col("event_id") % 2000, F.col("retry_count") * 360, F.col("retry_count") * 7.5, F.lit("h264"), F.lit(None).cast("string"), F.col("event_id") * 1048576).alias("summary")), f"""WITH {JOBS}, j AS (SELECT job_key, event_id AS e, retry_count * 360 AS h, retry_count * 7.5::DOUBLE AS fps, CAST(event_id * event_id * 1000 AS DOUBLE) AS b FROM jobs)
SELECT job_key, CASE WHEN e * 360 < 60 THEN printf('%.1fs', e * 360.0::DOUBLE) WHEN e * 360 < 3600 THEN printf('%.1fm', e * 6.0::DOUBLE) ELSE printf('%.1fh', e / 10) END AS took, CASE WHEN b < 1024 THEN printf('%.2f B', b) WHEN b < 1048576 THEN printf('%.2f KB', b / 1024 + 1e-9) WHEN b < 1073741824 THEN printf('%.2f MB', b / 1048576 + 1e-9) WHEN b < 1099511627776 THEN printf('%.2f GB', b / 1073741824 + 1e-9) ELSE printf('%.2f TB', b / 1099511627776 + 1e-9) END AS size,
CASE h WHEN 2160 THEN '4K' WHEN 1440 THEN '1440p' WHEN 1080 THEN '1080p' WHEN 720 THEN '720p' WHEN 480 THEN '480p' WHEN 360 THEN '360p' ELSE (e % 2000) || 'x' || h END AS label,
concat_ws(' | ', 'File: ' || job_key, CASE WHEN e > 0 THEN printf('Duration: %dm %ds', CAST(floor(floor(e / 7) / 60) AS BIGINT), CAST(floor(e / 7) % 60 AS BIGINT)) END, CASE WHEN e % 2000 > 0 AND h > 0 THEN printf('Resolution: %dx%d', e % 2000, h) END, CASE WHEN fps > 0 THEN printf('FPS: %.2f', fps) END, 'Video Codec: h264', CASE WHEN e > 0 THEN printf('Size: %.2f MB', e::DOUBLE) END) AS summary FROM j""")
R.add("failed_checks", lambda s, d: P.failed_checks(jobs(s, d).select(F.col("stage").alias("dataset"), F.col("created_at").alias("at"), F.col("job_key").alias("check"), F.when(F.col("retry_count") > 3, "critical").otherwise("high").alias("severity"), F.when(F.col("status") == "failed", "fail").otherwise("pass").alias("status"), F.col("processing_sec").alias("value")), F.lit("2024-01-15 00:00:00").cast("timestamp"), 7, True).select("dataset", F.col("check").alias("name"), "value"), f"WITH {JOBS} SELECT stage AS dataset, job_key AS name, processing_sec AS value FROM jobs WHERE status = 'failed' AND retry_count > 3 AND created_at > TIMESTAMP '2024-01-08' AND created_at <= TIMESTAMP '2024-01-15'")


def _names(s: SparkSession, d: str) -> DataFrame:
    e, labels = F.col("event_id"), F.create_map(F.lit("b"), F.col("stage"), F.lit("a"), F.col("failure_type"))
    return jobs(s, d).select(
        "job_key", S.error_id(F.col("failure_type"), F.col("stage")).alias("error_id"), S.fingerprint(F.col("stage"), labels).alias("fingerprint"), S.params_hash(labels).alias("params"), S.result_hash(F.col("job_key")).alias("result"),
        S.search_query(F.array("stage", "failure_type"), F.when(e % 2 == 0, "or").otherwise("AND"), F.when(e % 3 == 0, "YouTube").otherwise("web")).alias("query"), F.array_join(S.split_keywords(F.concat("stage", F.lit(" ,, "), "failure_type", F.lit(","))), ";").alias("words"),
    )


R.add("names", _names, f"WITH {JOBS} SELECT job_key, substr(md5(failure_type || '|' || stage), 1, 12) AS error_id, substr(md5(stage || '|a=' || failure_type || ',b=' || stage), 1, 16) AS fingerprint, substr(md5('a:' || failure_type || ',b:' || stage), 1, 8) AS params, substr(sha256(job_key), 1, 16) AS result, CASE WHEN event_id % 6 = 0 THEN stage || ' OR ' || failure_type ELSE stage || ' ' || failure_type END AS query, stage || ';' || failure_type AS words FROM jobs")
