"""Queries over candidates, metadata and catalogues: filters, parsers, comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from motionframe.functions.scalar import size_estimate
from motionframe.operators import candidates as C
from motionframe.operators import catalog as K
from motionframe.operators import interactions as I
from motionframe.operators import monitoring as M
from motionframe.operators import profiling as P
from motionframe.operators import versions as V
from motionframe.plans.registry import Registry
from motionframe.session import table

R = Registry()


def eid() -> Column:
    return F.col("event_id")


def events(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "events")


def add(name: str, sql: str):
    """Register the function as a query with this SQL."""

    def keep(query):
        R.add(name, query, sql)
        return query

    return keep


# --- filters

TITLES = ["Robot arm assembly", "pick & place demo", "Toy robot arm", "A cooking show", "GRASPING with care", "bin picking, simulation"]


def told(s: SparkSession, d: str) -> DataFrame:
    """Videos with one of six titles, a description for every other one, and lengths of up to 400 seconds."""
    title = F.element_at(F.array(*map(F.lit, TITLES)), (eid() % 6 + 1).cast("int"))
    return events(s, d).select(
        eid().alias("video_id"),
        title.alias("title"),
        F.when(eid() % 2 == 0, F.element_at(F.array(*map(F.lit, TITLES)), (eid() % 5 + 1).cast("int"))).alias("description"),
        F.array(F.when(eid() % 7 == 0, "CGI").otherwise("none")).alias("tags"),
        F.when(eid() % 11 != 0, eid() % 400).alias("duration"),
        (eid() % 3 * 360).alias("height"),
        (eid() % 2 * 30).alias("fps"),
        (eid() % 4 * 1000).alias("tbr"),
    )


_LIST = "[" + ", ".join(f"'{t}'" for t in TITLES) + "]"
_TOLD = f"""v AS (
  SELECT event_id AS i, lower({_LIST}[event_id % 6 + 1]) AS title, lower(coalesce(CASE WHEN event_id % 2 = 0 THEN {_LIST}[event_id % 5 + 1] END, '')) AS description,
    CASE WHEN event_id % 7 = 0 THEN 'cgi' ELSE 'none' END AS tags, CASE WHEN event_id % 11 != 0 THEN event_id % 400 END AS duration FROM events)"""
_any = lambda text, terms: "(" + " OR ".join(f"contains({text}, '{t}')" for t in terms) + ")"
_strict = lambda text: f"(NOT {_any(text, C.STRICT_REJECTED)} AND {_any(text, C.STRICT_REQUIRED)})"


@add(
    "video_filters",
    f"""
    WITH {_TOLD} SELECT i AS video_id, {_strict("title || ' ' || description")} AS strict, NOT {_any("title || ' ' || description || ' ' || tags", C.STRICT_REJECTED)} AS allowed,
      coalesce(duration, 0) BETWEEN 10 AND 300 AND {_strict("title || ' ' || description || ' ' || tags")} AS kept, duration IS NULL OR duration BETWEEN 30 AND 1200 AS length_fits FROM v
    """,
)
def video_filters(s: SparkSession, d: str) -> DataFrame:
    c = F.col
    return told(s, d).select(
        "video_id",
        C.passes_strict(c("title"), c("description")).alias("strict"),
        C.not_rejected(c("title"), c("description"), c("tags")).alias("allowed"),
        C.keep_video(c("duration"), c("title"), c("description"), c("tags")).alias("kept"),
        C.passes_duration(c("duration")).alias("length_fits"),
    )


@add(
    "video_constraints",
    f"""
    WITH {_TOLD} SELECT i AS video_id, coalesce(duration, 0) BETWEEN 60 AND 300 AND greatest(i % 3 * 360, CASE WHEN i % 5 != 0 THEN 480 ELSE 0 END) >= 480 AND greatest(i % 2 * 30, CASE WHEN i % 5 != 0 THEN 25 ELSE 0 END) >= 24
      AND (i % 4 = 0 OR i % 4 * 1000 >= 2000) AND {_strict("title || ' ' || description")} AS passes FROM v
    """,
)
def video_constraints(s: SparkSession, d: str) -> DataFrame:
    """One format, which has no video for every fifth."""
    one = F.struct(F.when(F.col("video_id") % 5 == 0, "none").otherwise("h264").alias("vcodec"), F.lit(480).alias("height"), F.lit(25).alias("fps"), F.lit(0).alias("tbr"))
    return C.passes_constraints(told(s, d).withColumn("formats", F.array(one))).select("video_id", "passes")


_LEVEL = """o AS (SELECT event_id, value % 101 / 100 * 0.6 + (event_id % 100) / 100.0::DOUBLE * 0.4 AS overall, event_id % 9 = 0 AS bad FROM events),
l AS (SELECT *, CASE WHEN bad OR overall < 0.3 THEN 'rejected' WHEN overall >= 0.85 THEN 'excellent' WHEN overall >= 0.7 THEN 'good' WHEN overall >= 0.5 THEN 'acceptable' ELSE 'poor' END AS level FROM o)"""


@add("overall_levels", f"WITH {_LEVEL} SELECT level, count(*) AS n, round(sum(overall), 4) AS total, round((SELECT avg((level != 'rejected')::INT) FROM l), 6) AS acceptance_rate FROM l GROUP BY 1")
def overall_levels(s: SparkSession, d: str) -> DataFrame:
    reasons = F.when(eid() % 9 == 0, F.array(F.lit("fps"))).otherwise(F.array().cast("array<string>"))
    scored = events(s, d).select(C.overall_score(F.col("value") % 101 / 100, eid() % 100 / 100, reasons).alias("o")).select("o.*")
    rates = C.level_distribution(scored)
    totals = scored.groupBy("level").agg(F.round(F.sum("overall"), 4).alias("total"))
    return rates.join(totals, "level").select("level", "n", "total", F.round("acceptance_rate", 6).alias("acceptance_rate"))


# --- parsers


@add(
    "search_results",
    """
    SELECT 'v' || event_id AS video_id, event_type || ' no. ' || event_id AS title, CASE WHEN event_id % 4 != 0 THEN 'u' || user_id END AS channel_name, value::VARCHAR AS view_text,
      CASE WHEN event_id % 3 = 0 THEN 'large' ELSE 'small' END AS thumbnail_url FROM events WHERE event_id % 5 != 0
    """,
)
def search_results(s: SparkSession, d: str) -> DataFrame:
    """Pages whose script holds nested results: two runs a title, one or two thumbnails, some items that are no videos."""
    run = lambda c: F.struct(c.alias("text"))
    small, large = (F.struct(F.lit(x).alias("url")) for x in ("small", "large"))
    item = F.struct(
        F.concat(F.lit("v"), eid()).alias("videoId"),
        F.struct(F.array(run(F.col("event_type")), run(F.concat(F.lit(" no. "), eid()))).alias("runs")).alias("title"),
        F.when(eid() % 4 != 0, F.struct(F.array(run(F.concat(F.lit("u"), "user_id"))).alias("runs"))).alias("ownerText"),
        F.struct(F.col("value").cast("string").alias("simpleText")).alias("viewCountText"),
        F.struct(F.when(eid() % 3 == 0, F.array(small, large)).otherwise(F.array(small)).alias("thumbnails")).alias("thumbnail"),
    )
    json = F.to_json(F.struct(F.array(F.struct(F.when(eid() % 5 != 0, item).alias("videoRenderer"))).alias("contents")))
    html = F.concat(F.lit("<html><script>var results = "), json, F.lit(" ;</script><script>var other = {};</script>"))
    pages = events(s, d).select(html.alias("html"))
    found = C.search_results(pages.select(C.embedded_json(F.col("html"), "results").alias("json")))
    return found.select("video_id", "title", "channel_name", "view_text", "thumbnail_url")


@add(
    "probe_metadata",
    """
    SELECT event_id, (event_id % 2000)::INTEGER AS width, CASE WHEN event_id % 3 = 0 THEN 0.0 ELSE round(30000.0::DOUBLE / (1000 + event_id % 3), 6) END AS fps, 'h264' AS video_codec, CASE WHEN event_id % 2 = 0 THEN 'aac' END AS audio_codec,
      CASE WHEN event_id % 5 != 0 THEN value END AS duration_sec, event_id * 1000 AS bitrate_bps FROM events
    """,
)
def probe_metadata(s: SparkSession, d: str) -> DataFrame:
    """Streams in either order, rates with a zero below, durations that are no numbers."""
    low = F.when(eid() % 3 == 0, 0).otherwise(1000 + eid() % 3).cast("string")
    video = F.format_string('{"codec_type":"video","codec_name":"h264","width":%d,"r_frame_rate":"30000/%s"}', eid() % 2000, low)
    audio = F.when(eid() % 2 == 0, ',{"codec_type":"audio","codec_name":"aac"}').otherwise("")
    length = F.when(eid() % 5 != 0, F.col("value").cast("string")).otherwise("N/A")
    json = F.concat(F.lit('{"streams":['), video, audio, F.lit('],"format":{"duration":"'), length, F.lit('","bit_rate":"'), eid() * 1000, F.lit('"}}'))
    m = C.probe_metadata(json)
    return events(s, d).select("event_id", m.alias("m")).select("event_id", "m.width", F.round("m.fps", 6).alias("fps"), "m.video_codec", "m.audio_codec", "m.duration_sec", "m.bitrate_bps")


@add("size_estimates", "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN event_id WHEN event_id % 5 = 0 THEN event_id * 2 ELSE event_id * 3 END AS bytes FROM events")
def size_estimates(s: SparkSession, d: str) -> DataFrame:
    one = lambda a, b: F.struct(a.alias("filesize"), b.alias("filesize_approx"))
    none = F.lit(None).cast("long")
    formats = F.array(one(F.when(eid() % 3 == 0, eid()), none), one(none, F.when(eid() % 5 == 0, eid() * 2)), one(eid() * 3, eid()))
    return events(s, d).select("event_id", size_estimate(formats).alias("bytes"))


# --- comparisons (J9, Q17, J10, U4) and updates


@add(
    "profile_drift",
    """
    WITH a AS (SELECT avg(l_quantity) AS q, stddev_samp(l_quantity) AS qs, avg(l_extendedprice) AS p, stddev_samp(l_extendedprice) AS ps, avg(l_tax) AS t, stddev_samp(l_tax) AS ts FROM lineitem),
    c AS (SELECT avg(l_quantity * 1.5) AS q, stddev_samp(l_quantity * 1.5) AS qs FROM lineitem), b AS (SELECT q, qs, avg(l_extendedprice) AS p, stddev_samp(l_extendedprice) AS ps, (SELECT count(*) FROM lineitem WHERE l_linenumber = 1) / (SELECT count(*) FROM lineitem) AS gone FROM lineitem, c WHERE l_linenumber > 1 GROUP BY q, qs)
    SELECT 'l_quantity' AS "column", concat_ws(',', CASE WHEN abs(b.q - a.q) > abs(a.q) * 0.1 THEN 'mean' END, CASE WHEN abs(b.qs - a.qs) > abs(a.qs) * 0.2 THEN 'std' END) AS changes FROM a, b
    UNION ALL SELECT 'l_extendedprice', concat_ws(',', CASE WHEN gone > 0.05 THEN 'null_ratio' END, CASE WHEN abs(b.p - a.p) > abs(a.p) * 0.1 THEN 'mean' END, CASE WHEN abs(b.ps - a.ps) > abs(a.ps) * 0.2 THEN 'std' END) FROM a, b
    UNION ALL SELECT 'l_tax', 'removed' UNION ALL SELECT 'l_discount', 'added'
    """,
)
def profile_drift(s: SparkSession, d: str) -> DataFrame:
    """Quantities half as high again, prices of first lines null, a column gone and one new."""
    l = table(s, d, "lineitem")
    kept = F.col("l_linenumber") > 1
    base = l.select("l_quantity", "l_extendedprice", "l_tax")
    now = l.select((F.col("l_quantity") * 1.5).alias("l_quantity"), F.when(kept, F.col("l_extendedprice")).alias("l_extendedprice"), "l_discount")
    one = lambda df: P.column_types(df).select("column", "kind", "n", "n_null").join(P.numeric_profile(df).select("column", "mean", "std"), "column", "left")
    return P.drift(one(base), one(now)).select("column", F.array_join("changes", ",").alias("changes"))


@add(
    "context_changes",
    """
    WITH e AS (SELECT event_id, event_type, value, user_id FROM events)
    SELECT event_id AS context_id, ((event_id % 20 = 0)::INT + (event_id % 30 = 0)::INT)::BIGINT AS critical, ((event_id % 20 = 0)::INT + (event_id % 30 = 0)::INT + 1)::BIGINT AS changed FROM e
    """,
)
def context_changes(s: SparkSession, d: str) -> DataFrame:
    """Two runs' parameters: the rate of every second and the model of every third differ, a seed is new, a time does not count."""
    e = events(s, d)
    of = lambda *kv: F.map_from_arrays(F.array(*(F.lit(k) for k, _ in kv)), F.array(*(v.cast("string") for _, v in kv)))
    a = e.select(eid().alias("context_id"), of(("rate", F.col("value")), ("model", F.col("event_type")), ("captured_at", F.lit("a"))).alias("params"))
    rate, model = F.when(eid() % 20 == 0, F.lit("other")).otherwise(F.col("value").cast("string")), F.when(eid() % 30 == 0, F.lit("new")).otherwise(F.col("event_type"))
    b = e.select(eid().alias("context_id"), of(("rate", rate), ("model", model), ("seed", F.col("user_id")), ("captured_at", F.lit("b"))).alias("params"))
    return V.reproducible(V.context_diff(a, b), ["rate", "model"])


@add("only_in_one", "SELECT 'new' AS side, o_custkey AS k FROM orders GROUP BY o_custkey HAVING max(o_orderkey % 2) = 0 UNION ALL SELECT 'gone', o_custkey FROM orders GROUP BY o_custkey HAVING min(o_orderkey % 2) = 1")
def only_in_one(s: SparkSession, d: str) -> DataFrame:
    o = table(s, d, "orders")
    new, gone = V.key_sets(o.where("o_orderkey % 2 = 1"), o.where("o_orderkey % 2 = 0"), "o_custkey")
    return new.select(F.lit("new").alias("side"), F.col("o_custkey").alias("k")).unionByName(gone.select(F.lit("gone").alias("side"), F.col("o_custkey").alias("k")))


@add(
    "download_results",
    """
    WITH r AS (SELECT user_id, max(event_id) AS i FROM events WHERE event_id % 4 != 0 AND user_id % 3 != 0 GROUP BY 1), v AS (SELECT DISTINCT user_id FROM events)
    SELECT 'v' || user_id AS video_id, CASE WHEN i IS NULL THEN 'discovered' WHEN i % 5 = 0 THEN 'failed' ELSE 'downloaded' END AS status, CASE WHEN i % 5 != 0 THEN 'p' || i ELSE 'old' END AS local_path,
      CASE WHEN i % 5 != 0 AND i % 2 = 0 THEN i ELSE 7 END AS duration_sec FROM v LEFT JOIN r USING (user_id)
    """,
)
def download_results(s: SparkSession, d: str) -> DataFrame:
    video = F.concat(F.lit("v"), "user_id").alias("video_id")
    videos = events(s, d).select(video, F.lit("discovered").alias("status"), F.lit("old").alias("local_path"), F.lit(7).cast("long").alias("duration_sec")).distinct()
    log = events(s, d).where("event_id % 4 != 0 and user_id % 3 != 0").select(video, eid().alias("at"), (eid() % 5 != 0).alias("success"), F.concat(F.lit("p"), eid()).alias("local_path"), F.when(eid() % 2 == 0, eid()).alias("duration_sec"))
    return K.download_results(videos, log)


# --- catalogue


@add("keyword_list", "SELECT p_partkey AS keyword_id, p_size AS priority FROM part WHERE p_size >= 20 AND p_partkey % 2 = 0 AND p_partkey % 3 != 0 ORDER BY p_size DESC, p_partkey LIMIT 30")
def keyword_list(s: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    rows = table(s, d, "part").select(k.alias("keyword_id"), F.col("p_size").alias("priority"), (k % 2).cast("int").alias("category_id"), F.lit("en").alias("language"), (k % 3 != 0).alias("is_active"))
    return K.list_keywords(rows, category=0, language="en", min_priority=20, limit=30).select("keyword_id", "priority")


@add("objects_kept", "SELECT l_orderkey, count_if(l_returnflag IN ('A', 'R'))::BIGINT AS of_class, count_if(1 - l_tax >= 0.95)::BIGINT AS confident FROM lineitem GROUP BY 1")
def objects_kept(s: SparkSession, d: str) -> DataFrame:
    item = F.struct(F.col("l_returnflag").alias("class_name"), (1 - F.col("l_tax")).alias("confidence"))
    rows = table(s, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(item).alias("objects"))
    return rows.select("l_orderkey", F.size(I.by_class(F.col("objects"), ["A", "R"])).cast("long").alias("of_class"), F.size(I.by_confidence(F.col("objects"), 0.95)).cast("long").alias("confident"))


@add(
    "episode_readiness",
    """
    SELECT event_id, coalesce(event_id % 2 = 0 AND event_id % 50 > 0 AND event_id % 3 != 0, false) AS valid, value / 100 > 0.1 AND event_id % 50 >= 5 AS ready, value / 100 > 0.3 AS high_quality FROM events
    """,
)
def episode_readiness(s: SparkSession, d: str) -> DataFrame:
    width = F.when(eid() % 3 != 0, eid())
    rows = events(s, d).select("event_id", K.valid_metadata(eid() % 2 == 0, eid() % 50, width, width).alias("valid"), K.readiness(F.col("value") / 100, eid() % 50).alias("r"))
    return rows.select("event_id", "valid", "r.ready", "r.high_quality")


@add("to_download", "SELECT 'v' || event_id AS video_id FROM events WHERE event_id % 3 = 0 AND event_id % 4 != 0 ORDER BY 1 LIMIT 50")
def to_download(s: SparkSession, d: str) -> DataFrame:
    rows = events(s, d).select(F.concat(F.lit("v"), eid()).alias("video_id"), F.when(eid() % 3 == 0, "discovered").otherwise("done").alias("status"), F.when(eid() % 4 != 0, "http://e").alias("url"))
    return K.to_download(rows, 50).select("video_id")


@add("kpis_of_status", "SELECT event_type AS name, count(*) AS n FROM events WHERE event_id % 3 = 1 AND user_id % 2 = 0 GROUP BY 1")
def kpis_of_status(s: SparkSession, d: str) -> DataFrame:
    rows = events(s, d).select(F.col("event_type").alias("name"), F.element_at(F.array(*map(F.lit, ("healthy", "warning", "critical"))), (eid() % 3 + 1).cast("int")).alias("status"), F.when(F.col("user_id") % 2 == 0, "latency").otherwise("cost").alias("kind"))
    return M.by_status(rows, "warning", "latency").groupBy("name").agg(F.count(F.lit(1)).alias("n"))
