"""Queries over alerts: cooldown, silences, forced alerts and resolutions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motionframe.functions.scalar import micros
from motionframe.operators import alerts as A
from motionframe.operators import monitoring as M
from motionframe.plans.registry import Registry
from motionframe.session import table

R = Registry()


def raised(s: SparkSession, d: str) -> DataFrame:
    """Every event as an alert of its type's rule; one in 97 is forced."""
    e = table(s, d, "events")
    return e.select(F.col("event_type").alias("rule"), "ts", "value", "event_id", (F.col("event_id") % 97 == 0).alias("forced"))


def silences(s: SparkSession, d: str) -> DataFrame:
    """One event in 50 silences its type's rule for two hours, every other one of these for half an hour."""
    e = table(s, d, "events").where("event_id % 50 = 0")
    till = F.when(F.col("event_id") % 100 == 0, F.col("ts") + F.expr("interval 2 hours")).otherwise(F.col("ts") + F.expr("interval 30 minutes"))
    return e.select(F.col("event_type").alias("rule"), F.col("ts").alias("at"), till.alias("till"))


def firing_alerts(s: SparkSession, d: str) -> DataFrame:
    return A.fired(raised(s, d), 1800.0, tie=["event_id"], force=F.col("forced"), silences=silences(s, d))


def alert_cooldown(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "events").select(F.col("event_type").alias("rule"), "ts", "value")
    return M.cooled(rows, 3600.0).select("rule", micros("ts").alias("ts_us"), "value")


def alert_silenced(s: SparkSession, d: str) -> DataFrame:
    return firing_alerts(s, d).select("rule", micros("ts").alias("ts_us"), "event_id", "forced")


def alert_history(s: SparkSession, d: str) -> DataFrame:
    """Alerts that fired, by fingerprint: firing, or resolved by one of the events whose id 11 divides."""
    key = lambda rule: F.concat_ws("/", rule, F.col("event_id") % 20)
    shown = firing_alerts(s, d).select(key(F.col("rule")).alias("fingerprint"), "ts", "event_id")
    ends = table(s, d, "events").where("event_id % 11 = 0").select(key(F.col("event_type")).alias("fingerprint"), F.col("ts").alias("at"))
    out = A.active(shown, ends)
    return out.select("fingerprint", micros("ts").alias("ts_us"), "event_id", "state", micros("resolved_at").alias("resolved_us"))


R.add(
    "alert_cooldown",
    alert_cooldown,
    """
    WITH RECURSIVE a AS (
      SELECT event_type AS rule, epoch_us(ts) AS us, value, row_number() OVER (PARTITION BY event_type ORDER BY ts, value) AS n FROM events),
    f AS (
      SELECT rule, us, value FROM a WHERE n = 1
      UNION ALL
      SELECT rule, us, value FROM (
        SELECT rule, min(a.n) AS n FROM f JOIN a USING (rule) WHERE a.us >= f.us + 3600000000 GROUP BY rule) JOIN a USING (rule, n))
    SELECT rule, us AS ts_us, value FROM f
    """,
)

#: The alerts that no silence holds back, numbered, and those of them that fire.
FIRED = """
    said AS (
      SELECT event_type AS rule, epoch_us(ts) AS us, NULL::BOOLEAN AS is_on, event_id FROM events
      UNION ALL SELECT event_type, epoch_us(ts), true, NULL FROM events WHERE event_id % 50 = 0
      UNION ALL SELECT event_type, epoch_us(ts) + CASE WHEN event_id % 100 = 0 THEN 7200000000 ELSE 1800000000 END, false, NULL FROM events WHERE event_id % 50 = 0),
    held AS (
      SELECT rule, us, event_id, last_value(is_on IGNORE NULLS) OVER (PARTITION BY rule ORDER BY us, is_on IS NULL, is_on ROWS UNBOUNDED PRECEDING) AS silent FROM said),
    a AS (
      SELECT rule, us, event_id, event_id % 97 = 0 AS forced, row_number() OVER (PARTITION BY rule ORDER BY us, event_id) AS n
      FROM held WHERE event_id IS NOT NULL AND NOT coalesce(silent, false)),
    f AS (
      SELECT rule, us, event_id, forced, n FROM a WHERE n = 1
      UNION ALL
      SELECT rule, us, event_id, forced, n FROM (
        SELECT rule, min(a.n) AS n FROM f JOIN a USING (rule) WHERE a.n > f.n AND (a.forced OR a.us >= f.us + 1800000000) GROUP BY rule) JOIN a USING (rule, n))
"""
R.add("alert_silenced", alert_silenced, f"WITH RECURSIVE {FIRED} SELECT rule, us AS ts_us, event_id, forced FROM f")
R.add(
    "alert_history",
    alert_history,
    f"""
    WITH RECURSIVE {FIRED},
    shown AS (SELECT rule || '/' || event_id % 20 AS fingerprint, arg_max(event_id, (us, event_id)) AS event_id, max(us) AS us FROM f GROUP BY 1),
    ends AS (SELECT event_type || '/' || event_id % 20 AS fingerprint, epoch_us(ts) AS ended FROM events WHERE event_id % 11 = 0)
    SELECT fingerprint, us AS ts_us, event_id, CASE WHEN min(ended) IS NULL THEN 'firing' ELSE 'resolved' END AS state, min(ended) AS resolved_us
    FROM shown LEFT JOIN ends USING (fingerprint) WHERE ended IS NULL OR ended >= us GROUP BY 1, 2, 3
    UNION ALL
    SELECT fingerprint, us, event_id, 'firing', NULL FROM shown
    WHERE fingerprint IN (SELECT fingerprint FROM ends) AND NOT EXISTS (SELECT 1 FROM ends WHERE ends.fingerprint = shown.fingerprint AND ended >= us)
    """,
)
