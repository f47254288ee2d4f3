"""Replays: a table is read as a stream, and what the stream gave out is the result."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motionframe.functions.scalar import micros
from motionframe.plans.alerting import FIRED
from motionframe.plans.registry import Registry
from motionframe.plans.reports import INTERACTION_EVENTS, paired_frames
from motionframe.session import shared_folder, written
from motionframe.streaming import operators as O
from motionframe.streaming import stateful as S
from motionframe.streaming.incremental import committed, incremental

R = Registry()
#: Longer than any table: nothing is forgotten in a replay.
EVER = 1e9


def events(s: SparkSession, d: str) -> DataFrame:
    e = O.table_stream(s, d, "events")
    return e.withColumns({"ts": F.col("ts").cast("timestamp"), "status": O.status_of(F.col("event_type")), "stage": F.element_at(F.array(*map(F.lit, ("crawl", "detect", "encode", "upload"))), (F.col("user_id") % 4 + 1).cast("int"))})


STATUS = "CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'completed' WHEN 'signup' THEN 'pending' WHEN 'view' THEN 'running' ELSE 'skipped' END"
STAGE = "['crawl', 'detect', 'encode', 'upload'][user_id % 4 + 1]"


def stream_kpi(s: SparkSession, d: str) -> DataFrame:
    out = O.replayed(O.kpi_stream(events(s, d)), "complete")
    last = out.agg(F.max("epoch")).first()[0]
    return out.where(F.col("epoch") == last).select("status", "n", F.round("mean_value", 6).alias("mean_value"))


def stream_stage_metrics(s: SparkSession, d: str) -> DataFrame:
    out = O.replayed(O.stage_metrics(events(s, d), "1 day"), "update")
    keys = ["start", "stage"]
    last = out.groupBy(*keys).agg(F.max_by(F.struct("jobs", "errors", "mean_latency"), "epoch").alias("r"))
    return last.select(micros("start").alias("start_us"), "stage", "r.jobs", "r.errors", F.round("r.mean_latency", 6).alias("mean_latency"))


def stream_unique(s: SparkSession, d: str) -> DataFrame:
    rows = events(s, d).select(F.concat(F.lit("v"), F.col("user_id") % 50).alias("video_id"), "ts")
    return O.replayed(O.unique_candidates(rows, late="1000 days")).select("video_id")


def stream_job_states(s: SparkSession, d: str) -> DataFrame:
    rows = events(s, d).select(F.concat(F.lit("u"), "user_id").alias("job_key"), "status", "ts")
    with S.rocksdb(s):
        out = O.replayed(S.job_states(rows, keep=EVER, idle=EVER), "update")
    last = out.groupBy("job_key").agg(F.max_by(F.struct("status", "retry_count", "terminal", "updated_at"), "epoch").alias("r"))
    return last.select("job_key", "r.status", "r.retry_count", "r.terminal", micros("r.updated_at").alias("updated_us"))


def stream_alert_states(s: SparkSession, d: str) -> DataFrame:
    """The alerts, silences and resolutions of plans.alerting, as commands to one stream."""
    said = lambda when, action, seconds: F.when(when, F.struct(F.lit(action).alias("action"), seconds.cast("double").alias("seconds")))
    i = F.col("event_id")
    commands = F.array(
        said(i % 50 == 0, "silence", F.when(i % 100 == 0, 7200).otherwise(1800)),
        said(i % 97 == 0, "force", F.lit(None)),
        said(i % 97 != 0, "fire", F.lit(None)),
        said(i % 11 == 0, "resolve", F.lit(None)),
    )
    key = F.concat_ws("/", "event_type", i % 20)
    rows = events(s, d).select(F.col("event_type").alias("rule"), "ts", key.alias("fingerprint"), "value", F.inline(F.filter(commands, lambda c: c.isNotNull())))
    with S.rocksdb(s):
        out = O.replayed(S.alert_states(rows, 1800.0, forget=EVER))
    return out.select("rule", micros("ts").alias("ts_us"), "state", "fingerprint", "value", micros("fired_at").alias("fired_us"))


def stream_interactions(s: SparkSession, d: str) -> DataFrame:
    """Frames come 30 a second; a last frame of another video, a day later, lets the timers close what is open."""
    began = F.lit("2024-01-01 00:00:00").cast("timestamp")
    at = lambda seconds: (began.cast("double") + seconds).cast("timestamp")
    rows = paired_frames(s, d).select("video_id", "hand", "object", F.col("frame_idx").cast("long").alias("frame_idx"), at(F.col("frame_idx") / 30).alias("ts"), "kind", "confidence")
    beat = s.range(1).select(F.lit("end").alias("video_id"), F.lit("").alias("hand"), F.lit("").alias("object"), F.lit(0).cast("long").alias("frame_idx"), at(F.lit(86400)).alias("ts"), F.lit("none").alias("kind"), F.lit(0.0).alias("confidence"))
    frames = written(rows.unionByName(beat), "live")
    live = O.file_stream(s, frames.inputFiles()[0].rpartition("/")[0], frames.schema, files=1_000_000)
    with S.rocksdb(s):
        out = O.replayed(S.interaction_sessions(live, 30.0, 0.0))
    return out.select("video_id", "hand", "object", "start", "end", "kind", F.round("peak_confidence", 6).alias("peak_confidence"))


def incremental_append(s: SparkSession, d: str) -> DataFrame:
    """The table is appended twice, by two queries that know nothing of each other: each user's first event stays."""
    folder = f"{shared_folder(s)}/incremental-{uuid.uuid4().hex}"
    for name in ("one", "two"):
        rows = events(s, d).select("user_id", "ts", "event_id")
        incremental(rows, f"{folder}/target", "user_id", f"{folder}/{name}", order=["ts", "event_id"]).awaitTermination()
    return committed(s, f"{folder}/target").select("user_id", "event_id")


R.add("stream_kpi", stream_kpi, f"SELECT {STATUS} AS status, count(*) AS n, round(avg(value), 6) AS mean_value FROM events GROUP BY 1")
R.add(
    "stream_stage_metrics",
    stream_stage_metrics,
    f"""
    SELECT epoch_us(date_trunc('day', ts)::TIMESTAMP) AS start_us, {STAGE} AS stage, count(*) AS jobs, count_if(event_type = 'error')::BIGINT AS errors, round(avg(value), 6) AS mean_latency
    FROM events GROUP BY 1, 2
    """,
)
R.add("stream_unique", stream_unique, "SELECT DISTINCT 'v' || user_id % 50 AS video_id FROM events")
R.add(
    "stream_job_states",
    stream_job_states,
    f"""
    WITH e AS (SELECT 'u' || user_id AS job_key, {STATUS} AS status, ts FROM events),
    j AS (SELECT job_key, arg_max(status, (ts, status)) AS status, count_if(status = 'failed')::BIGINT AS retry_count, epoch_us(max(ts)) AS updated_us FROM e GROUP BY 1)
    SELECT job_key, status, retry_count, status IN ('completed', 'skipped') AS terminal, updated_us FROM j
    """,
)
R.add(
    "stream_alert_states",
    stream_alert_states,
    f"""
    WITH RECURSIVE {FIRED},
    said_of AS (
      SELECT rule, us, 2 AS rank, rule || '/' || event_id % 20 AS fingerprint, event_id FROM f
      UNION ALL SELECT event_type, epoch_us(ts), 3, event_type || '/' || event_id % 20, NULL FROM events WHERE event_id % 11 = 0),
    states AS (SELECT *, lag(rank) OVER w AS before, lag(event_id) OVER w AS was, lag(us) OVER w AS since FROM said_of WINDOW w AS (PARTITION BY fingerprint ORDER BY us, rank))
    SELECT rule, us AS ts_us, CASE rank WHEN 2 THEN 'firing' ELSE 'resolved' END AS state, fingerprint, value, CASE rank WHEN 2 THEN us ELSE since END AS fired_us
    FROM states JOIN events e ON e.event_id = coalesce(states.event_id, was) WHERE rank = 2 OR before = 2
    """,
)
R.add("stream_interactions", stream_interactions, INTERACTION_EVENTS)
R.add("incremental_append", incremental_append, "SELECT user_id, arg_min(event_id, (ts, event_id)) AS event_id FROM events GROUP BY 1")
