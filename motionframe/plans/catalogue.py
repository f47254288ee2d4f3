"""Queries over catalogue tables that are derived from events, orders, part, lineitem, customer, pages and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motionframe.functions import scalar as S
from motionframe.operators import candidates as C
from motionframe.operators import catalog as K
from motionframe.operators import monitoring as M
from motionframe.operators import profiling as P
from motionframe.operators import versions as V
from motionframe.plans.registry import Registry
from motionframe.session import table
from motionframe.streaming.operators import status_of

R = Registry()
AS_OF = "2024-01-31 00:00:00"
_STATUS = "CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'completed' WHEN 'signup' THEN 'pending' WHEN 'view' THEN 'running' ELSE 'skipped' END"
JOBS = f"""jobs AS (SELECT event_id, ts, 'web_v' || user_id || '_' || event_id AS job_key, 'v' || user_id AS video_id, {_STATUS} AS status,
 CASE user_id % 4 WHEN 0 THEN 'crawl' WHEN 1 THEN 'download' WHEN 2 THEN 'detect' ELSE 'upload' END AS stage, event_id % 5 AS retry_count, 3 AS max_retries,
 CASE event_id % 3 WHEN 0 THEN 'network' WHEN 1 THEN 'quality' ELSE 'system' END AS failure_type, 'code=' || (event_id % 7) AS failure_reason, ts AS created_at, value AS processing_sec,
 ts AS started_at, ts + to_seconds(CAST(floor(value) AS INTEGER)) AS completed_at FROM events)"""
FILES = "files AS (SELECT 'k' || o_orderkey AS key, sha256(o_orderkey || o_orderstatus) AS sha256, CAST(floor(o_totalprice) AS BIGINT) AS size_bytes, o_orderdate AS modified_at, CASE o_orderkey % 3 WHEN 0 THEN 'STANDARD' WHEN 1 THEN 'STANDARD_IA' ELSE 'GLACIER' END AS storage_class FROM orders)"


def jobs(spark: SparkSession, d: str) -> DataFrame:
    e, i = table(spark, d, "events"), F.col("event_id")
    pick = lambda c, *names: F.element_at(F.array(*map(F.lit, names)), (c % len(names) + 1).cast("int"))
    return e.select(
        i, "ts", F.concat(F.lit("web_v"), "user_id", F.lit("_"), i).alias("job_key"), F.concat(F.lit("v"), "user_id").alias("video_id"), status_of(F.col("event_type")).alias("status"),
        pick(F.col("user_id"), "crawl", "download", "detect", "upload").alias("stage"), (i % 5).alias("retry_count"), F.lit(3).alias("max_retries"), pick(i, "network", "quality", "system").alias("failure_type"),
        F.concat(F.lit("code="), i % 7).alias("failure_reason"), F.col("ts").alias("created_at"), F.col("value").alias("processing_sec"), F.col("ts").alias("started_at"), (F.col("ts") + F.make_interval(secs=F.floor("value"))).alias("completed_at"),
    )


def files(spark: SparkSession, d: str) -> DataFrame:
    o, k = table(spark, d, "orders"), F.col("o_orderkey")
    return o.select(F.concat(F.lit("k"), k).alias("key"), F.sha2(F.concat(k.cast("string"), "o_orderstatus"), 256).alias("sha256"), F.floor("o_totalprice").alias("size_bytes"), F.col("o_orderdate").alias("modified_at"), F.element_at(F.array(*map(F.lit, ("STANDARD", "STANDARD_IA", "GLACIER"))), (k % 3 + 1).cast("int")).alias("storage_class"))


def us(c: str) -> F.Column:
    return S.micros(c)


R.add("job_stats", lambda s, d: K.status_counts(jobs(s, d), ["pending", "running", "completed", "failed", "skipped"]), f"""WITH {JOBS} SELECT count(*) AS total, count_if(status='pending') AS pending, count_if(status='running') AS running, count_if(status='completed') AS completed, count_if(status='failed') AS failed, count_if(status='skipped') AS skipped, count_if(status IN ('pending','queued')) AS queue_depth FROM jobs""")
R.add("job_search", lambda s, d: K.search_jobs(jobs(s, d), "V1_", status="failed", limit=50, offset=2).select("job_key", "stage"), f"""WITH {JOBS} SELECT job_key, stage FROM jobs WHERE status='failed' AND (job_key ILIKE '%V1\\_%' ESCAPE '\\' OR video_id ILIKE '%V1\\_%' ESCAPE '\\' OR failure_reason ILIKE '%V1\\_%' ESCAPE '\\') ORDER BY created_at DESC, job_key LIMIT 50 OFFSET 2""")
R.add("job_skip_reasons", lambda s, d: jobs(s, d).select("job_key", K.skip_reason().alias("reason")).where("reason is not null"), f"""WITH {JOBS} SELECT * FROM (SELECT job_key, CASE WHEN status='completed' THEN 'completed' WHEN failure_type='quality' THEN 'quality_failed' WHEN retry_count >= max_retries THEN 'retries_exhausted' END AS reason FROM jobs) WHERE reason IS NOT NULL""")
R.add("job_retryable", lambda s, d: K.retryable(jobs(s, d)).select("job_key", "retry_count", S.backoff_seconds(F.col("retry_count")).alias("delay")), f"""WITH {JOBS} SELECT job_key, retry_count, least(pow(2.0, retry_count), 60.0) AS delay FROM jobs WHERE status='failed' AND failure_type='network' AND retry_count < max_retries""")
R.add("recent_error_counts", lambda s, d: K.recent_errors(jobs(s, d), 200), f"""WITH {JOBS}, l AS (SELECT * FROM jobs WHERE status='failed' ORDER BY created_at DESC, job_key LIMIT 200) SELECT failure_type, count(*) AS n FROM l GROUP BY 1""")
R.add("hourly_throughput", lambda s, d: K.hourly(jobs(s, d)).select(us("hour").alias("hour_us"), "jobs", "errors"), f"""WITH {JOBS} SELECT epoch_us(date_trunc('hour', created_at)) AS hour_us, count(*) AS jobs, count_if(status='failed') AS errors FROM jobs GROUP BY 1""")
R.add("labelled_counts", lambda s, d: K.labelled_counts(jobs(s, d), ["stage", "status"]), f"WITH {JOBS} SELECT stage, status, count(*) AS value FROM jobs GROUP BY 1, 2")
_B = [5.0, 10.0, 25.0, 50.0, 100.0]
R.add("duration_buckets", lambda s, d: K.duration_buckets(jobs(s, d), "stage", "processing_sec", _B), f"""WITH {JOBS}, b AS (SELECT unnest([5.0,10.0,25.0,50.0,100.0,NULL]::DOUBLE[]) AS le) SELECT stage, le, count_if(le IS NULL OR processing_sec <= le) AS n FROM jobs, b GROUP BY 1, 2""")
R.add("bucket_quantile", lambda s, d: K.bucket_quantile(K.duration_buckets(jobs(s, d), "stage", "processing_sec", _B), "stage", 0.95).select("stage", F.round("quantile", 6).alias("quantile")), f"""WITH {JOBS}, b AS (SELECT unnest([5.0,10.0,25.0,50.0,100.0,NULL]::DOUBLE[]) AS le), c AS (SELECT stage, le, count_if(le IS NULL OR processing_sec <= le) AS n FROM jobs, b GROUP BY 1, 2),
 w AS (SELECT *, max(n) OVER (PARTITION BY stage) * 0.95 AS rank, coalesce(lag(n) OVER p, 0) AS below, coalesce(lag(le) OVER p, 0.0) AS lower FROM c WINDOW p AS (PARTITION BY stage ORDER BY le ASC NULLS LAST))
 SELECT stage, round(CASE WHEN le IS NULL THEN lower ELSE lower + (le - lower) * (rank - below) / (n - below) END, 6) AS quantile FROM w WHERE n >= rank AND below < rank""")
R.add("latest_job_state", lambda s, d: K.latest_jobs(jobs(s, d).select("video_id", "event_id", "status", "started_at"), "video_id", "event_id").select("video_id", "status", us("started_at").alias("started_us")), f"""WITH {JOBS} SELECT video_id, arg_max(status, event_id) AS status, epoch_us(min(started_at)) AS started_us FROM jobs GROUP BY 1""")
R.add("error_classes", lambda s, d: table(s, d, "events").select("event_id", S.classify_error(F.element_at(F.array(*map(F.lit, ("TimeoutError", "KeyError", "OSError", "Other"))), (F.col("event_id") % 4 + 1).cast("int")), (F.col("event_id") % 600).cast("int"), F.concat(F.lit("x "), F.when(F.col("event_id") % 11 == 0, "Rate Limit").otherwise("y"))).alias("c")).select("event_id", "c.*"), """WITH e AS (SELECT event_id, ['TimeoutError','KeyError','OSError','Other'][event_id % 4 + 1] AS t, event_id % 600 AS c, event_id % 11 = 0 AS rl FROM events),
 x AS (SELECT event_id, c, rl, CASE t WHEN 'TimeoutError' THEN ['network_timeout','warning','yes'] WHEN 'KeyError' THEN ['data_missing','warning','no'] WHEN 'OSError' THEN ['system_os','error','conditional'] ELSE ['unknown','error','no'] END AS k FROM e),
 y AS (SELECT event_id, rl, CASE WHEN c = 0 THEN k WHEN c = 401 THEN ['auth_unauthorized','error','no'] WHEN c = 403 THEN ['auth_forbidden','error','no'] WHEN c = 404 THEN ['api_not_found','warning','no'] WHEN c = 429 THEN ['api_rate_limit','warning','yes'] WHEN c = 400 THEN ['api_bad_request','warning','no'] WHEN c BETWEEN 500 AND 599 THEN ['api_server_error','error','yes'] ELSE ['unknown','error','no'] END AS k FROM x)
 SELECT event_id, CASE WHEN rl THEN 'api_rate_limit' ELSE k[1] END AS error_type, k[2] AS severity, CASE WHEN rl THEN 'yes' ELSE k[3] END AS retryable FROM y""")
R.add("error_summary", lambda s, d: K.error_summary(jobs(s, d).select(F.col("failure_type").alias("error_type"), F.col("status").alias("severity"), F.col("stage").alias("retryable"))), f"""WITH {JOBS} SELECT 'error_type' AS dimension, failure_type AS value, count(*) AS n FROM jobs GROUP BY 2 UNION ALL SELECT 'severity', status, count(*) FROM jobs GROUP BY 2 UNION ALL SELECT 'retryable', stage, count(*) FROM jobs GROUP BY 2""")
R.add("rank_percentiles", lambda s, d: M.rank_percentiles(table(s, d, "events"), "value", [0.5, 0.95, 0.99], ["event_type"]), """WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) AS k, count(*) OVER (PARTITION BY event_type) AS n FROM events) SELECT event_type, max(CASE WHEN k = least(floor(n * 0.5), n - 1) + 1 THEN value END) AS p50, max(CASE WHEN k = least(floor(n * 0.95), n - 1) + 1 THEN value END) AS p95, max(CASE WHEN k = least(floor(n * 0.99), n - 1) + 1 THEN value END) AS p99 FROM r GROUP BY 1""")
R.add("stage_table", lambda s, d: M.stage_table(jobs(s, d)), f"""WITH {JOBS}, c AS (SELECT stage, count_if(status='completed') AS success, count_if(status='failed') AS fail, count_if(status='skipped') AS skip, count_if(status='running') AS inflight, count_if(status IN ('pending','queued')) AS queue FROM jobs GROUP BY 1),
 r AS (SELECT stage, processing_sec, row_number() OVER (PARTITION BY stage ORDER BY processing_sec) AS k, count(*) OVER (PARTITION BY stage) AS n FROM jobs WHERE status='completed') SELECT c.*, coalesce((SELECT max(processing_sec) FROM r WHERE r.stage = c.stage AND k = least(floor(n * 0.95), n - 1) + 1), 0.0) AS p95 FROM c""")
R.add("sliding_rate", lambda s, d: M.sliding_rate(jobs(s, d), "stage", "ts", "1 hour", "20 minutes", 3600.0).select(us("start").alias("start_us"), "stage", "n", F.round("rate", 9).alias("rate")), f"""WITH {JOBS}, k AS (SELECT unnest([0, 1, 2]) AS k), x AS (SELECT stage, (epoch_us(ts) // 1200000000 - k) * 1200000000 AS start_us FROM jobs, k) SELECT start_us, stage, count(*) AS n, round(count(*) / 3600.0, 9) AS rate FROM x GROUP BY 1, 2""")
R.add("kpi_trend", lambda s, d: M.trend(table(s, d, "events").select(F.col("event_type").alias("name"), "ts", "value"), F.to_timestamp(F.lit(AS_OF)), 24, 6).withColumn("value", F.round("value", 6)), f"""WITH x AS (SELECT event_type AS name, value, CAST((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(ts)) // 21600000000 AS INTEGER) AS period FROM events) SELECT name, period, round(avg(value), 6) AS value, count(*) AS n FROM x WHERE period >= 0 AND period < 24 GROUP BY 1, 2""")
R.add("jobs_in_flight", lambda s, d: M.inflight(jobs(s, d)).select("stage", us("ts").alias("ts_us"), "inflight"), f"""WITH {JOBS}, e AS (SELECT stage, started_at AS ts, 1 AS d FROM jobs UNION ALL SELECT stage, completed_at, -1 FROM jobs), g AS (SELECT stage, ts, sum(d) AS d FROM e GROUP BY 1, 2) SELECT stage, epoch_us(ts) AS ts_us, CAST(sum(d) OVER (PARTITION BY stage ORDER BY ts) AS BIGINT) AS inflight FROM g""")
R.add("kpi_status", lambda s, d: M.with_status(jobs(s, d).groupBy("stage").agg(M.error_rate(F.count_if(F.col("status") == "failed"), F.count(F.lit(1))).alias("value")).select(F.lit("pipeline_error_rate").alias("name"), "stage", "value")).select("stage", F.round("value", 6).alias("value"), "status"), f"""WITH {JOBS}, v AS (SELECT stage, count_if(status='failed') * 100.0 / count(*) AS value FROM jobs GROUP BY 1) SELECT stage, round(value, 6) AS value, CASE WHEN value >= 10 THEN 'critical' WHEN value >= 5 THEN 'warning' ELSE 'ok' END AS status FROM v""")
R.add("alert_firing", lambda s, d: M.firing(table(s, d, "events").select("ts", F.col("value").alias("error_rate"), (F.col("value") * 100).alias("queue_depth"))).groupBy("rule", "severity").agg(F.count(F.lit(1)).alias("n")), """SELECT 'high_error_rate' AS rule, 'critical' AS severity, count(*) AS n FROM events WHERE value > 10 UNION ALL SELECT 'queue_backlog', 'warning', count(*) FROM events WHERE value * 100 > 5000""")
R.add("alert_custom", lambda s, d: M.custom_firing(table(s, d, "events"), "hot", "value > 100 and event_type = 'error'").groupBy("rule").agg(F.count(F.lit(1)).alias("n")), "SELECT 'hot' AS rule, count(*) AS n FROM events WHERE value > 100 AND event_type = 'error' HAVING count(*) > 0")
R.add("overview", lambda s, d: K.overview(jobs(s, d), jobs(s, d).withColumn("quality_score", F.col("processing_sec") / 100), F.to_timestamp(F.lit(AS_OF)), 24 * 7), f"""WITH {JOBS}, r AS (SELECT * FROM jobs WHERE epoch_us(created_at) >= epoch_us(TIMESTAMP '{AS_OF}') - 604800000000) SELECT count(*) AS jobs, round(count_if(status='failed') * 100.0 / count(*), 2) AS error_pct, count(*) AS episodes, count_if(processing_sec / 100 >= 0.7) AS high_quality FROM r""")
R.add("pipeline_kpi", lambda s, d: K.pipeline_kpi(jobs(s, d).withColumn("status", F.when(F.col("status") == "running", "downloaded").otherwise(F.col("status"))), jobs(s, d), jobs(s, d).withColumn("quality_score", F.col("processing_sec") / 100), files(s, d).select(F.col("size_bytes").cast("double").alias("total_cost"), F.struct("modified_at", "key").alias("period_end"))).withColumns({"success_rate": F.round("success_rate", 6), "mean_processing_sec": F.round("mean_processing_sec", 6)}), f"""WITH {JOBS}, {FILES} SELECT (SELECT count(*) FROM jobs) AS total_videos, (SELECT count_if(status='running') FROM jobs) AS downloaded, (SELECT count(*) FROM jobs) AS total_episodes, (SELECT count_if(processing_sec / 100 >= 0.8) FROM jobs) AS high_quality, (SELECT round(count_if(status='completed') / greatest(count(*), 1), 6) FROM jobs) AS success_rate, (SELECT round(avg(processing_sec), 6) FROM jobs WHERE status='completed') AS mean_processing_sec, (SELECT CAST(size_bytes AS DOUBLE) FROM files ORDER BY modified_at DESC, key DESC LIMIT 1) AS latest_cost""")
R.add("quality_stats", lambda s, d: M.quality_stats(jobs(s, d).select((F.col("processing_sec") / 100).alias("quality_score"), (F.col("retry_count") / 5).alias("confidence_score"), F.col("processing_sec").alias("jittering_score"))).select(*(F.round(c, 6).alias(c) for c in ("pass_rate", "mean_confidence", "mean_jitter", "std_confidence", "p95_jitter"))), f"""WITH {JOBS}, x AS (SELECT processing_sec / 100 AS q, retry_count / 5 AS c, processing_sec AS j FROM jobs), r AS (SELECT j, row_number() OVER (ORDER BY j) AS k, count(*) OVER () AS n FROM x WHERE j != 0) SELECT round(count_if(q >= 0.7) / count(*), 6) AS pass_rate, round(avg(c), 6) AS mean_confidence, round(avg(j), 6) AS mean_jitter, round(stddev_samp(CASE WHEN c != 0 THEN c END), 6) AS std_confidence, (SELECT round(max(j), 6) FROM r WHERE k = least(floor(n * 0.95), n - 1) + 1) AS p95_jitter FROM x""")
R.add("weekly_quality", lambda s, d: M.weekly_quality(jobs(s, d).select("created_at", (F.col("processing_sec") / 100).alias("quality_score"), (F.col("retry_count") / 5).alias("confidence_score"), F.col("processing_sec").alias("jittering_score"), (F.col("event_id") % 10 / 10).alias("interpolated_ratio"))).select(us("week").alias("week_us"), "episodes", "high_quality", *(F.round(c, 6).alias(c) for c in ("conf_p50", "conf_p90", "jitter_p90", "interpolated_p90"))), f"""WITH {JOBS}, x AS (SELECT created_at, processing_sec / 100 AS q, retry_count / 5 AS c, processing_sec AS j, (event_id % 10) / 10 AS i FROM jobs) SELECT epoch_us(CAST(date_trunc('week', created_at) AS TIMESTAMP)) AS week_us, count(*) AS episodes, count_if(q >= 0.7) AS high_quality, round(quantile_cont(c, 0.5), 6) AS conf_p50, round(quantile_cont(c, 0.9), 6) AS conf_p90, round(quantile_cont(j, 0.9), 6) AS jitter_p90, round(quantile_cont(i, 0.9), 6) AS interpolated_p90 FROM x GROUP BY 1""")

# --- files, versions, costs
R.add("manifest_diff", lambda s, d: V.manifest_diff(files(s, d).where("size_bytes % 10 != 1"), files(s, d).where("size_bytes % 10 != 2").withColumn("sha256", F.when(F.col("size_bytes") % 10 == 3, F.lit("x")).otherwise(F.col("sha256")))), f"""WITH {FILES}, a AS (SELECT * FROM files WHERE size_bytes % 10 != 1), b AS (SELECT key, CASE WHEN size_bytes % 10 = 3 THEN 'x' ELSE sha256 END AS sha256, size_bytes FROM files WHERE size_bytes % 10 != 2) SELECT coalesce(a.key, b.key) AS key, CASE WHEN a.key IS NULL THEN 'added' WHEN b.key IS NULL THEN 'removed' ELSE 'modified' END AS change, coalesce(b.size_bytes, 0) AS added_bytes, coalesce(a.size_bytes, 0) AS removed_bytes FROM a FULL JOIN b ON a.key = b.key WHERE a.sha256 IS DISTINCT FROM b.sha256""")
R.add("manifest_checksum", lambda s, d: V.checksum(files(s, d).withColumn("version", F.col("storage_class"))), f"WITH {FILES} SELECT storage_class AS version, sha256(string_agg(sha256, '' ORDER BY sha256)) AS checksum FROM files GROUP BY 1")
R.add("file_stats", lambda s, d: K.file_stats(files(s, d).withColumn("compression_ratio", S.compression_ratio(F.col("size_bytes") * 2, F.col("size_bytes"))), ["storage_class"]), f"WITH {FILES} SELECT storage_class, count(*) AS n_files, CAST(sum(size_bytes) AS BIGINT) AS total_bytes, avg(size_bytes * 2 / size_bytes) AS mean_ratio FROM files GROUP BY 1")
R.add("storage_cost", lambda s, d: files(s, d).select("key", F.round(F.col("size_bytes") * 1000 / S.GIB * S.storage_rate(F.col("storage_class")), 6).alias("cost")), f"WITH {FILES} SELECT key, round(size_bytes * 1000 / 1073741824.0 * CASE storage_class WHEN 'STANDARD' THEN 0.025 WHEN 'STANDARD_IA' THEN 0.0138 ELSE 0.004 END, 6) AS cost FROM files")
R.add("class_costs", lambda s, d: V.class_costs(files(s, d).withColumn("size_bytes", F.col("size_bytes") * 1000)), f"WITH {FILES}, g AS (SELECT storage_class, CAST(sum(size_bytes * 1000) AS BIGINT) AS bytes FROM files GROUP BY 1) SELECT storage_class, bytes, round_even(bytes / 1073741824.0 * CASE storage_class WHEN 'STANDARD' THEN 0.025 WHEN 'STANDARD_IA' THEN 0.0138 ELSE 0.004 END, 4) AS current_cost, round_even(bytes / 1073741824.0 * 0.004, 4) AS optimized_cost, 'GLACIER' AS recommended_class FROM g")
R.add("cost_savings", lambda s, d: V.cost_savings(files(s, d).withColumn("size_bytes", F.col("size_bytes") * 1000)), f"""WITH {FILES}, g AS (SELECT storage_class, CAST(sum(size_bytes * 1000) AS BIGINT) AS bytes FROM files GROUP BY 1), t AS (SELECT sum(round_even(bytes / 1073741824.0 * CASE storage_class WHEN 'STANDARD' THEN 0.025 WHEN 'STANDARD_IA' THEN 0.0138 ELSE 0.004 END, 4)) AS c, round_even(sum(bytes) / 1073741824.0 * 0.004, 4) AS o FROM g) SELECT round_even(c, 2) AS current_cost, round_even(o, 2) AS optimized_cost, round_even(c - o, 2) AS savings, round_even((c - o) * 100.0 / c, 1) AS savings_percent FROM t""")
R.add("lifecycle_classes", lambda s, d: files(s, d).groupBy(S.lifecycle_class(F.datediff(F.to_date(F.lit("1999-01-01")), F.to_date("modified_at"))).alias("class")).agg(F.count(F.lit(1)).alias("n")), f"WITH {FILES}, x AS (SELECT date_diff('day', CAST(modified_at AS DATE), DATE '1999-01-01') AS a FROM files) SELECT CASE WHEN a >= 365 THEN 'GLACIER' WHEN a >= 90 THEN 'STANDARD_IA' WHEN a >= 30 THEN 'INTELLIGENT_TIERING' ELSE 'STANDARD' END AS class, count(*) AS n FROM x GROUP BY 1")
R.add("shard_offsets", lambda s, d: V.shard_offsets(table(s, d, "orders").groupBy((F.col("o_custkey") % 8).alias("shard"), F.col("o_custkey").alias("episode_id")).agg(F.count(F.lit(1)).alias("n"))), """WITH e AS (SELECT o_custkey % 8 AS shard, o_custkey AS episode_id, count(*) AS n FROM orders GROUP BY 1, 2), w AS (SELECT *, CAST(sum(n) OVER p AS BIGINT) AS se, CAST(sum(n - 1) OVER p AS BIGINT) AS ae FROM e WINDOW p AS (PARTITION BY shard ORDER BY episode_id)) SELECT shard, episode_id, se - n AS state_start, se AS state_end, ae - (n - 1) AS action_start, ae AS action_end FROM w""")
R.add("running_cleanup", lambda s, d: M.to_free(files(s, d), 5_000_000).select("key", "size_bytes", "bytes_before"), f"WITH {FILES}, w AS (SELECT key, size_bytes, CAST(coalesce(sum(size_bytes) OVER (ORDER BY modified_at, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS bytes_before FROM files) SELECT * FROM w WHERE bytes_before < 5000000")
R.add("largest_files", lambda s, d: C.top_n(files(s, d), "size_bytes", 20, "key").select("key", "size_bytes"), f"WITH {FILES} SELECT key, size_bytes FROM files ORDER BY size_bytes DESC, key LIMIT 20")
R.add("storage_summary", lambda s, d: K.storage_summary(files(s, d)).withColumn("avg_bytes", F.round("avg_bytes", 4)), f"WITH {FILES} SELECT count(*) AS n, CAST(sum(size_bytes) AS BIGINT) AS total_bytes, round(avg(size_bytes), 4) AS avg_bytes, (SELECT key FROM files ORDER BY modified_at, key LIMIT 1) AS oldest, (SELECT key FROM files ORDER BY modified_at DESC, key DESC LIMIT 1) AS newest FROM files")
R.add("version_bumps", lambda s, d: table(s, d, "orders").select("o_orderkey", S.version_text(S.bump(S.parse_version(F.concat(F.lit("v"), F.col("o_orderkey") % 7, F.lit("."), F.col("o_orderkey") % 5, F.lit(".3"))), S.suggest_bump(F.col("o_orderkey") % 2, F.floor(F.col("o_orderkey") / 2) % 2))).alias("version")), """WITH x AS (SELECT o_orderkey, o_orderkey % 7 AS a, o_orderkey % 5 AS b, (o_orderkey // 2) % 2 > 0 AS r, o_orderkey % 2 > 0 AS n FROM orders) SELECT o_orderkey, CASE WHEN r THEN 'v' || (a + 1) || '.0.0' WHEN n THEN 'v' || a || '.' || (b + 1) || '.0' ELSE 'v' || a || '.' || b || '.4' END AS version FROM x""")
R.add("old_files", lambda s, d: K.older_than(files(s, d), F.to_timestamp(F.lit("1996-06-01 00:00:00")), 24 * 30).select("key"), f"WITH {FILES} SELECT key FROM files WHERE epoch_us(modified_at) < epoch_us(TIMESTAMP '1996-06-01') - 2592000000000")

# --- upserts and maintenance
R.add("upsert_fill_blank", lambda s, d: K.fill_blanks(table(s, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.col("c_mktsegment")).alias("seg"), F.when(F.col("c_custkey") % 4 == 0, 0.0).otherwise(F.col("c_acctbal")).alias("bal")).where("c_custkey % 5 != 0"), table(s, d, "customer").select("c_custkey", F.lit("NEW").alias("seg"), F.lit(1.5).alias("bal")).where("c_custkey % 2 = 0"), "c_custkey", ["seg", "bal"]), """WITH a AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END AS seg, CASE WHEN c_custkey % 4 = 0 THEN 0.0 ELSE c_acctbal END AS bal FROM customer WHERE c_custkey % 5 != 0), b AS (SELECT c_custkey, 'NEW' AS seg, 1.5::DOUBLE AS bal FROM customer WHERE c_custkey % 2 = 0) SELECT coalesce(a.c_custkey, b.c_custkey) AS c_custkey, CASE WHEN a.seg IS NULL OR a.seg = '' THEN coalesce(b.seg, a.seg) ELSE a.seg END AS seg, CASE WHEN a.bal IS NULL OR a.bal = 0 THEN coalesce(b.bal, a.bal) ELSE a.bal END AS bal FROM a FULL JOIN b ON a.c_custkey = b.c_custkey""")
R.add("insert_absent", lambda s, d: K.insert_absent(table(s, d, "customer").where("c_custkey % 3 = 0").select("c_custkey", "c_name"), table(s, d, "customer").where("c_custkey % 2 = 0").select("c_custkey", F.lit("new").alias("c_name")), "c_custkey", "c_name"), "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE 'new' END AS c_name FROM customer WHERE c_custkey % 3 = 0 OR c_custkey % 2 = 0")
R.add("cascade_remove", lambda s, d: K.dependants(table(s, d, "orders"), table(s, d, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey")), "o_custkey")[1].groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")), "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) GROUP BY 1")
R.add("merge_changes", lambda s, d: K.merged(table(s, d, "customer").select("c_custkey", "c_acctbal"), table(s, d, "customer").where("c_custkey % 4 = 1").select("c_custkey", F.lit(7.0).alias("c_acctbal"), (F.col("c_custkey") % 8 == 1).alias("gone")), "c_custkey", "gone"), "SELECT c_custkey, CASE WHEN c_custkey % 4 = 1 THEN 7.0 ELSE c_acctbal END AS c_acctbal FROM customer WHERE c_custkey % 8 != 1")
R.add("not_done", lambda s, d: K.not_done(table(s, d, "orders").select("o_orderkey"), table(s, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey"), "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
R.add("duplicate_rows", lambda s, d: K.duplicate_rows(table(s, d, "documents"), ["text"]), "SELECT CAST(coalesce(sum(c), 0) AS BIGINT) AS n_duplicates FROM (SELECT count(*) AS c FROM documents GROUP BY text HAVING count(*) > 1)")

# --- candidates and keywords
_KW = "kw AS (SELECT l_partkey AS keyword_id, CAST(l_quantity AS BIGINT) AS found, CAST(floor(l_quantity / 2) AS BIGINT) AS downloaded, CAST(l_linenumber AS BIGINT) AS high_quality FROM lineitem)"


def searches(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "lineitem").select(F.col("l_partkey").alias("keyword_id"), F.col("l_quantity").cast("bigint").alias("found"), F.floor(F.col("l_quantity") / 2).alias("downloaded"), F.col("l_linenumber").cast("bigint").alias("high_quality"))


R.add("keyword_rates", lambda s, d: K.keyword_rates(searches(s, d)).withColumns({c: F.round(c, 6) for c in ("videos_per_search", "success_rate", "quality_per_video")}), f"WITH {_KW}, g AS (SELECT keyword_id, count(*) AS searches, CAST(sum(found) AS BIGINT) AS found, CAST(sum(downloaded) AS BIGINT) AS downloaded, CAST(sum(high_quality) AS BIGINT) AS high_quality FROM kw GROUP BY 1) SELECT *, round(CASE WHEN searches > 0 THEN found / searches ELSE 0 END, 6) AS videos_per_search, round(CASE WHEN found > 0 THEN downloaded / found ELSE 0 END, 6) AS success_rate, round(CASE WHEN downloaded > 0 THEN high_quality / downloaded ELSE 0 END, 6) AS quality_per_video FROM g")
R.add("top_keywords", lambda s, d: K.top_keywords_by(table(s, d, "part").select(F.col("p_partkey").alias("keyword_id"), F.col("p_name").alias("keyword")), K.keyword_rates(searches(s, d)).select("keyword_id", "found"), "found", 25), f"WITH {_KW}, g AS (SELECT keyword_id, CAST(sum(found) AS BIGINT) AS found FROM kw GROUP BY 1) SELECT keyword_id, p_name AS keyword, found FROM g JOIN part ON keyword_id = p_partkey ORDER BY found DESC, keyword_id LIMIT 25")
R.add("flat_keywords", lambda s, d: C.flat_keywords(table(s, d, "part").select(F.col("p_name").alias("keyword"), F.col("p_size").alias("priority")), 30), "WITH g AS (SELECT lower(trim(p_name)) AS k, p_size AS priority, p_name AS keyword, row_number() OVER (PARTITION BY lower(trim(p_name)) ORDER BY p_size DESC, p_name DESC) AS r FROM part) SELECT keyword, priority FROM g WHERE r = 1 ORDER BY priority DESC, keyword LIMIT 30")
R.add("keyword_combinations", lambda s, d: C.keyword_combinations(table(s, d, "region").select(F.col("r_name").alias("base")), table(s, d, "nation").select(F.col("n_name").alias("modifier"))), "SELECT r_name || ' ' || n_name AS keyword FROM region, nation")
R.add("title_terms", lambda s, d: C.title_terms(table(s, d, "documents"), "text"), r"""WITH w AS (SELECT regexp_replace(unnest(regexp_split_to_array(lower(text), '\s+')), '^[.,!?()\[\]{}"'']+|[.,!?()\[\]{}"'']+$', '', 'g') AS word FROM documents) SELECT word, count(*) AS n FROM w WHERE length(word) > 3 GROUP BY 1 HAVING count(*) >= 2 ORDER BY n DESC, word LIMIT 50""")
R.add("content_filter", lambda s, d: table(s, d, "documents").groupBy(C.passes_content(F.col("text"), F.col("lang"), ["tion", "est"], ["clown", "idiot"]).alias("passes"), C.passes_duration(F.col("n_chars")).alias("length_ok")).agg(F.count(F.lit(1)).alias("n")), "WITH x AS (SELECT lower(text || ' ' || lang) AS t, n_chars FROM documents) SELECT (t LIKE '%tion%' OR t LIKE '%est%') AND NOT (t LIKE '%clown%' OR t LIKE '%idiot%') AS passes, n_chars IS NULL OR n_chars BETWEEN 30 AND 1200 AS length_ok, count(*) AS n FROM x GROUP BY 1, 2")
R.add("dedupe_first", lambda s, d: C.first_seen(table(s, d, "documents").select(F.sha2("text", 256).alias("video_id"), "doc_id", "source"), "video_id", ["doc_id"]), "SELECT sha256(text) AS video_id, min(doc_id) AS doc_id, arg_min(source, doc_id) AS source FROM documents GROUP BY 1")
R.add("crawl_funnel", lambda s, d: C.crawl_funnel(table(s, d, "documents").select(F.sha2("text", 256).alias("video_id"), F.col("doc_id").alias("discovered_at"), F.col("source").alias("platform"), F.col("lang").alias("keyword"), F.col("text").alias("title"), F.lit("").alias("description"), F.col("n_chars").alias("duration_sec"))).select("platform", "keyword", "found", "duplicates", "filtered", "accepted"), f"""WITH x AS (SELECT source AS platform, lang AS keyword, lower(text || ' ') AS t, n_chars AS c, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS r FROM documents), y AS (SELECT platform, keyword, CASE WHEN r > 1 THEN 'duplicate' WHEN ({' OR '.join(f"contains(t, '{w}')" for w in C.RELEVANT)}) AND NOT ({' OR '.join(f"contains(t, '{w}')" for w in C.REJECTED)}) AND c BETWEEN 30 AND 1200 THEN 'accepted' ELSE 'filtered' END AS o FROM x)
 SELECT platform, keyword, count(*) AS found, count_if(o='duplicate') AS duplicates, count_if(o='filtered') AS filtered, count_if(o='accepted') AS accepted FROM y GROUP BY GROUPING SETS ((platform), (keyword), ())""")
R.add("relevance_score", lambda s, d: table(s, d, "documents").select("doc_id", F.round(C.relevance_score(F.col("text"), F.col("source"), F.array("lang"), F.col("n_chars") * 10, F.col("doc_id"), ["and", "the", "est", "en"]), 9).alias("score")), "SELECT doc_id, round(least(1.0, ((contains(lower(text), 'and')::INT + contains(lower(text), 'the')::INT + contains(lower(text), 'est')::INT + contains(lower(text), 'en')::INT) / 4 * 0.5 + (contains(lang, 'and')::INT + contains(lang, 'the')::INT + contains(lang, 'est')::INT + contains(lang, 'en')::INT) / 4 * 0.3 + (contains(source, 'and')::INT + contains(source, 'the')::INT + contains(source, 'est')::INT + contains(source, 'en')::INT) / 4 * 0.2) * CASE WHEN n_chars * 10 > 10000 THEN 1.1 ELSE 1.0 END * CASE WHEN doc_id > 100 THEN 1.05 ELSE 1.0 END), 9) AS score FROM documents")
R.add("technical_score", lambda s, d: table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", C.technical_score((F.col("l_partkey") % 2000).cast("int"), F.col("l_quantity"), F.col("l_extendedprice") / 50, F.col("l_extendedprice") * 100).alias("t")).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.floor(F.col("t.technical") * 10000 + 1e-6).alias("technical"), F.size("t.reasons").alias("n_reasons")), """WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_partkey % 2000 AS h, l_quantity AS f, l_extendedprice / 50 AS s, l_extendedprice * 100 / 1e6 AS b FROM lineitem) SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(floor(((CASE WHEN h < 720 THEN 0 WHEN h >= 1080 THEN 1 ELSE (h - 720) / 360.0 END) + (CASE WHEN f < 24 THEN 0 WHEN f >= 30 THEN 1 ELSE (f - 24) / 6 END) + (CASE WHEN s < 10 OR s > 1200 THEN 0 WHEN s <= 300 THEN s / 300 ELSE 1 - (s - 300) / 900 * 0.5 END) + (CASE WHEN b < 1 THEN 0.2 WHEN b >= 5 THEN 1 ELSE greatest(0.2, (b - 1) / 4) END)) / 4 * 10000 + 1e-6) AS BIGINT) AS technical, (h < 720)::INT + (f < 24)::INT + (s < 10)::INT + (s > 1200)::INT + (b < 1)::INT AS n_reasons FROM x""")
R.add("url_parse", lambda s, d: table(s, d, "pages").select("page_id", S.platform_of(F.col("url")).alias("platform"), S.url_hash(F.col("url"), 16).alias("url_hash"), S.file_type(F.col("url")).alias("file_type")), "SELECT page_id, CASE WHEN contains(lower(url), 'youtube') OR contains(lower(url), 'youtu.be') THEN 'youtube' ELSE 'unknown' END AS platform, left(sha256(url), 16) AS url_hash, 'unknown' AS file_type FROM pages")
R.add("scraped_urls", lambda s, d: C.scraped_urls(table(s, d, "pages"), r'href="[^"]*', 4), """WITH u AS (SELECT page_id, list_transform(regexp_extract_all(html, 'href="[^"]*'), lambda x: regexp_replace(x, '/+$', '')) AS l FROM pages), e AS (SELECT page_id, unnest(l) AS url, generate_subscripts(l, 1) AS i FROM u), f AS (SELECT page_id, url, min(i) AS i FROM e GROUP BY 1, 2) SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INTEGER) AS position, url FROM f QUALIFY position < 4""")
R.add("duration_parse", lambda s, d: table(s, d, "events").select("event_id", S.duration_seconds(F.concat(F.col("event_id") % 3, F.lit(":"), F.col("event_id") % 60, F.when(F.col("event_id") % 2 == 0, F.lit(":07")).otherwise(F.lit("")))).alias("seconds"), S.view_count(F.concat(F.round(F.col("value"), 1), F.lit("K views"))).alias("views")), "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN (event_id % 3) * 3600 + (event_id % 60) * 60 + 7 ELSE (event_id % 3) * 60 + event_id % 60 END AS seconds, CAST(round(round(value, 1) * 1000) AS BIGINT) AS views FROM events")

# --- profiles and checks
R.add(
    "profile_numeric",
    lambda s, d: P.numeric_profile(table(s, d, "lineitem"), ["l_quantity", "l_discount", "l_extendedprice"]).select("column", "n", "zeros", "negatives", *(F.round(c, 4).alias(c) for c in ("mean", "std", "min", "max", "median", "q1", "q3", "iqr", "skew", "kurtosis"))),
    """
    WITH x AS (UNPIVOT (SELECT l_quantity, l_discount, l_extendedprice FROM lineitem) ON l_quantity, l_discount, l_extendedprice INTO NAME "column" VALUE v),
    c AS (SELECT "column", v, v - avg(v) OVER (PARTITION BY "column") AS d FROM x)
    SELECT "column", count(*) AS n, count_if(v = 0) AS zeros, count_if(v < 0) AS negatives, round(avg(v), 4) AS mean, round(stddev_samp(v), 4) AS std, round(min(v), 4) AS min, round(max(v), 4) AS max,
      round(quantile_cont(v, 0.5), 4) AS median, round(quantile_cont(v, 0.25), 4) AS q1, round(quantile_cont(v, 0.75), 4) AS q3, round(quantile_cont(v, 0.75) - quantile_cont(v, 0.25), 4) AS iqr,
      round(avg(d * d * d) / pow(avg(d * d), 1.5), 4) AS skew, round(avg(d * d * d * d) / pow(avg(d * d), 2) - 3, 4) AS kurtosis
    FROM c GROUP BY 1
    """,
)
R.add("profile_text", lambda s, d: P.text_profile(table(s, d, "documents"), ["text", "source"]).withColumn("avg_length", F.round("avg_length", 6)), """WITH x AS (UNPIVOT (SELECT text, source FROM documents) ON text, source INTO NAME "column" VALUE v) SELECT "column", round(avg(length(v)), 6) AS avg_length, CAST(min(length(v)) AS INTEGER) AS min_length, CAST(max(length(v)) AS INTEGER) AS max_length, count_if(trim(v) = '') AS n_empty, count(DISTINCT v) AS n_unique FROM x GROUP BY 1""")
R.add("profile_categorical", lambda s, d: P.categorical_profile(table(s, d, "lineitem"), ["l_returnflag", "l_linestatus"]), """WITH x AS (UNPIVOT (SELECT l_returnflag, l_linestatus FROM lineitem) ON l_returnflag, l_linestatus INTO NAME "column" VALUE v), g AS (SELECT "column", v, count(*) AS c, row_number() OVER (PARTITION BY "column" ORDER BY count(*) DESC, v) AS r FROM x GROUP BY 1, 2) SELECT "column", CAST(sum(c) AS BIGINT) AS n, count(*) AS n_unique, max(CASE WHEN r = 1 THEN v END) AS top, max(CASE WHEN r = 1 THEN c END) AS freq FROM g GROUP BY 1""")
R.add("value_counts", lambda s, d: P.value_counts(table(s, d, "documents"), ["source", "lang"], 10), """WITH x AS (UNPIVOT (SELECT source, lang FROM documents) ON source, lang INTO NAME "column" VALUE v) SELECT "column", v AS value, count(*) AS n, CAST(row_number() OVER (PARTITION BY "column" ORDER BY count(*) DESC, v) AS INTEGER) AS rank FROM x GROUP BY 1, 2 QUALIFY rank <= 10""")
R.add("column_types", lambda s, d: P.column_types(table(s, d, "orders")).select("column", "kind", "n", "n_null", "n_unique"), """SELECT c AS "column", k AS kind, n, 0::BIGINT AS n_null, u AS n_unique FROM (SELECT count(*) AS n, unnest(['o_orderkey','o_custkey','o_orderstatus','o_totalprice','o_orderdate','o_orderpriority']) AS c, unnest(['numeric','numeric','categorical','numeric','datetime','categorical']) AS k, unnest([count(DISTINCT o_orderkey), count(DISTINCT o_custkey), count(DISTINCT o_orderstatus), count(DISTINCT o_totalprice), count(DISTINCT o_orderdate), count(DISTINCT o_orderpriority)]) AS u FROM orders)""")
R.add("check_suite", lambda s, d: P.suite_report([P.nan_check(table(s, d, "lineitem")), P.shape_check(table(s, d, "lineitem"), 1, required=["l_tax"]), P.range_check(table(s, d, "lineitem"), "l_quantity", 0, 40), P.unique_check(table(s, d, "documents"), ["text"], 0.0), P.type_check(table(s, d, "orders"), {"o_orderkey": "int", "o_totalprice": "double"}), P.custom_check(table(s, d, "events"), "positive", lambda df: F.min("value") > 0)]), """WITH x AS (SELECT count(*) AS n, count(l_orderkey) AS a, count(l_partkey) AS b, count(l_suppkey) AS c, count(l_linenumber) AS d, count(l_quantity) AS e, count(l_extendedprice) AS f, count(l_discount) AS g, count(l_tax) AS h, count(l_returnflag) AS i, count(l_linestatus) AS j, count(l_shipdate) AS k, max(l_quantity) AS hi, min(l_quantity) AS lo FROM lineitem),
c AS (SELECT n = least(a, b, c, d, e, f, g, h, i, j, k) AS ok, 'high' AS severity FROM x UNION ALL SELECT n >= 1, 'critical' FROM x UNION ALL SELECT lo >= 0 AND hi <= 40, 'medium' FROM x UNION ALL SELECT max(k) = 1, 'high' FROM (SELECT count(*) AS k FROM documents GROUP BY text) UNION ALL SELECT bool_and(contains(upper(typeof(o_orderkey)), 'INT') AND typeof(o_totalprice) = 'DOUBLE'), 'medium' FROM orders UNION ALL SELECT min(value) > 0, 'medium' FROM events)
SELECT count_if(ok)::BIGINT AS passed, count_if(NOT ok)::BIGINT AS failed, 0::BIGINT AS warnings, count_if(ok) * 100.0::DOUBLE / count(*) AS success_pct, CASE WHEN count_if(NOT ok AND severity = 'critical') > 0 THEN 'fail' WHEN count_if(NOT ok) > 0 THEN 'warn' ELSE 'pass' END AS overall FROM c""")
