"""Round trips: what a sink wrote into the shared folder is read by its source, and must be the given table's rows."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from motionframe import schemas
from motionframe.functions.scalar import micros
from motionframe.operators import quality as Q
from motionframe.operators import versions as V
from motionframe.plans.registry import Registry
from motionframe.plans.reports import QUALITY, scored_episodes
from motionframe.session import shared_folder, table
from motionframe.sources import arrays as A
from motionframe.sources import files as S

R = Registry()


def folder(s: SparkSession, name: str) -> str:
    return f"{shared_folder(s)}/sink-{name}-{uuid.uuid4().hex}"


def add(name: str, sql: str):
    """Register the function as a query with this SQL."""

    def keep(query):
        R.add(name, query, sql)
        return query

    return keep


# --- videos and candidates: titles with quotes, commas and blanks, lists, nulls, times


def videos(s: SparkSession, d: str) -> DataFrame:
    o = table(s, d, "orders")
    k = F.col("o_orderkey")
    return o.select(
        F.concat(F.lit("v"), k).alias("video_id"),
        F.when(k % 3 == 0, "YouTube").when(k % 3 == 1, "vimeo").alias("platform"),
        F.concat(F.lit(' say "'), "o_orderpriority", F.lit('", then '), "o_orderstatus", F.when(k % 5 == 0, "\n2nd line").otherwise("")).alias("title"),
        F.when(k % 4 != 0, F.floor("o_totalprice")).alias("duration_sec"),
        F.array("o_orderpriority", F.lit("a,b")).alias("tags"),
        F.when(k % 7 != 0, F.col("o_orderstatus")).alias("status"),
        F.col("o_orderdate").cast("timestamp").alias("discovered_at"),
    )


VIDEOS = """videos AS (
  SELECT 'v' || o_orderkey AS video_id, CASE o_orderkey % 3 WHEN 0 THEN 'YouTube' WHEN 1 THEN 'vimeo' END AS platform,
    ' say "' || o_orderpriority || '", then ' || o_orderstatus || CASE WHEN o_orderkey % 5 = 0 THEN chr(10) || '2nd line' ELSE '' END AS title,
    CASE WHEN o_orderkey % 4 != 0 THEN CAST(floor(o_totalprice) AS BIGINT) END AS duration_sec, '["' || o_orderpriority || '","a,b"]' AS tags,
    CASE WHEN o_orderkey % 7 != 0 THEN o_orderstatus END AS status, strftime(o_orderdate::TIMESTAMP, '%Y-%m-%dT%H:%M:%S') AS discovered_at
  FROM orders)"""


@add("csv_videos", f"WITH {VIDEOS} SELECT video_id, platform, title, duration_sec::VARCHAR AS duration_sec, tags, status, discovered_at FROM videos")
def csv_videos(s: SparkSession, d: str) -> DataFrame:
    path = folder(s, "videos")
    S.export_videos(videos(s, d), path)
    return S.read_csv(s, path)


@add("csv_by_platform", f"WITH {VIDEOS} SELECT video_id, title, lower(coalesce(platform, 'unknown')) AS platform_part FROM videos")
def csv_by_platform(s: SparkSession, d: str) -> DataFrame:
    path = folder(s, "by_platform")
    S.export_by(videos(s, d), path, "platform", ["video_id", "title"])
    return S.read_csv(s, path)


@add("csv_by_status", f"WITH {VIDEOS} SELECT video_id, discovered_at, lower(coalesce(status, 'unknown')) AS status_part FROM videos")
def csv_by_status(s: SparkSession, d: str) -> DataFrame:
    path = folder(s, "by_status")
    S.export_by(videos(s, d), path, "status", ["video_id", "discovered_at"])
    return S.read_csv(s, path)


@add("csv_appended", f"WITH {VIDEOS} SELECT video_id, count(*) AS n, min(title) AS title FROM (SELECT * FROM videos UNION ALL SELECT * FROM videos WHERE status = 'F') GROUP BY 1")
def csv_appended(s: SparkSession, d: str) -> DataFrame:
    path = folder(s, "appended")
    S.append_csv(videos(s, d).select("video_id", "title"), path)
    S.append_csv(videos(s, d).where("status = 'F'").select("video_id", "title"), path)
    return S.read_csv(s, path).groupBy("video_id").agg(F.count(F.lit(1)).alias("n"), F.min("title").alias("title"))


def candidates(s: SparkSession, d: str) -> DataFrame:
    p = table(s, d, "part")
    return p.select(
        F.concat(F.lit("http://e/"), "p_partkey").alias("url"),
        F.concat(F.lit("p"), "p_partkey").alias("video_id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("platform"),
        F.col("p_type").alias("keyword"),
        F.col("p_size").alias("duration_sec"),
        F.floor("p_retailprice").alias("view_count"),
        F.col("p_brand").alias("channel_name"),
        F.lit("2024-01-01").alias("discovered_at"),
        F.lit("not among the columns").alias("more"),
    )


@add(
    "csv_candidates",
    """
    SELECT 'http://e/' || p_partkey AS url, 'p' || p_partkey AS video_id, p_name AS title, p_brand AS platform, p_type AS keyword, p_size::VARCHAR AS duration_sec,
      CAST(floor(p_retailprice) AS BIGINT)::VARCHAR AS view_count, p_brand AS channel_name, '2024-01-01' AS discovered_at FROM part
    """,
)
def csv_candidates(s: SparkSession, d: str) -> DataFrame:
    """Overwritten, then appended to."""
    path, rows = folder(s, "candidates"), candidates(s, d)
    S.write_candidates(rows, path)
    S.write_candidates(rows.where("duration_sec % 2 = 0"), path)
    S.write_candidates(rows.where("duration_sec % 2 != 0"), path, overwrite=False)
    return S.read_csv(s, path)


@add("csv_urls", "SELECT 'http://e/' || p_partkey AS url FROM part WHERE p_size % 3 != 0")
def csv_urls(s: SparkSession, d: str) -> DataFrame:
    """A column of URLs by its name, blanks around them and blank ones among them."""
    path = folder(s, "urls")
    url = F.when(F.col("p_size") % 3 != 0, F.concat(F.lit("  http://e/"), "p_partkey", F.lit(" "))).otherwise(" ")
    S.export_videos(table(s, d, "part").select("p_name", url.alias("Video_URL")), path)
    return S.read_urls_csv(s, path)


@add(
    "url_list",
    """
    SELECT 'https://youtu.be/' || lpad(p_partkey::VARCHAR, 11, 'x') AS url, lpad(p_partkey::VARCHAR, 11, 'x') AS video_id FROM part WHERE p_size % 4 = 0
    UNION ALL SELECT 'http://e/videos/' || p_partkey, p_partkey::VARCHAR FROM part WHERE p_size % 4 = 1
    """,
)
def url_list(s: SparkSession, d: str) -> DataFrame:
    path, k, n = folder(s, "list"), F.col("p_partkey").cast("string"), F.col("p_size") % 4
    line = F.when(n == 0, F.concat(F.lit("https://youtu.be/"), F.lpad(k, 11, "x"))).when(n == 1, F.concat(F.lit(" http://e/videos/"), k)).when(n == 2, F.concat(F.lit("# "), k)).otherwise(" ")
    table(s, d, "part").select(line.alias("value")).write.text(path)
    return S.read_url_list(s, path)


# --- JSON: landmarks, detections, events, contracts, manifests, contexts, reports


@add(
    "json_poses",
    """
    SELECT 'v' || vec_id // 50 AS video_path, 25.0::DOUBLE AS fps, vec_id % 50 AS frame_idx, (vec_id % 50) / 25.0::DOUBLE AS timestamp, 2::INTEGER AS joints,
      embedding[1]::DOUBLE AS x0, embedding[5]::DOUBLE AS x1, CASE WHEN vec_id % 3 = 0 THEN embedding[9]::DOUBLE END AS left_x
    FROM embeddings
    """,
)
def json_poses(s: SparkSession, d: str) -> DataFrame:
    e, path = table(s, d, "embeddings"), folder(s, "poses")
    at = lambda i: F.col("embedding")[i].cast("double")
    mark = lambda i: F.struct(at(i).alias("x"), at(i + 1).alias("y"), at(i + 2).alias("z"), at(i + 3).alias("visibility"))
    hand = F.array(F.struct(at(8).alias("x"), at(9).alias("y"), at(10).alias("z")))
    frames = e.select(
        F.concat(F.lit("v"), F.floor(F.col("vec_id") / 50)).alias("video_path"),
        F.lit(25.0).alias("fps"),
        (F.col("vec_id") % 50).alias("frame_idx"),
        ((F.col("vec_id") % 50) / 25).alias("timestamp"),
        F.lit(0.5).alias("pose_confidence"),
        F.array(mark(0), mark(4)).alias("body_landmarks"),
        F.when(F.col("vec_id") % 3 == 0, hand).alias("left_hand"),
        F.lit(None).cast(f"array<{schemas.POINT}>").alias("right_hand"),
    )
    S.write_poses(frames, path)
    rows = S.read_poses(s, path)
    x = lambda c, i: F.get(F.col(c), F.lit(i))["x"]
    return rows.select("video_path", "fps", "frame_idx", "timestamp", F.size("body_landmarks").alias("joints"), x("body_landmarks", 0).alias("x0"), x("body_landmarks", 1).alias("x1"), x("left_hand", 0).alias("left_x"))


@add("json_detections", "SELECT l_returnflag || l_orderkey % 7 AS video_path, l_orderkey AS frame_idx, l_linenumber::INTEGER AS class_id, l_linestatus AS class_name, 1 - l_tax AS confidence, (l_partkey % 100)::INTEGER AS x1 FROM lineitem")
def json_detections(s: SparkSession, d: str) -> DataFrame:
    path = folder(s, "detections")
    box = F.array((F.col("l_partkey") % 100).cast("int"), F.lit(0), F.lit(9), F.lit(9))
    item = F.struct(F.col("l_linenumber").cast("int").alias("class_id"), F.col("l_linestatus").alias("class_name"), (1 - F.col("l_tax")).cast("double").alias("confidence"), box.alias("bbox"))
    video = F.concat("l_returnflag", F.col("l_orderkey") % 7).alias("video_path")
    frames = table(s, d, "lineitem").groupBy(video, F.col("l_orderkey").alias("frame_idx")).agg(F.collect_list(item).alias("objects"))
    S.write_detections(frames.withColumn("timestamp", F.col("frame_idx") / 30), path)
    return S.read_detections(s, path).select("video_path", "frame_idx", F.explode("objects").alias("o")).select("video_path", "frame_idx", "o.class_id", "o.class_name", "o.confidence", F.col("o.bbox")[0].alias("x1"))


@add("json_events", "SELECT event_id, epoch_us(ts) AS ts_us, event_type, value, props FROM events")
def json_events(s: SparkSession, d: str) -> DataFrame:
    path, e = folder(s, "events"), table(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    S.write_json(e, path)
    return s.read.schema(e.schema).json(path).select("event_id", micros("ts").alias("ts_us"), "event_type", "value", "props")


@add("json_contract", "SELECT 'v' || l_orderkey AS video_id, l_partkey AS size_bytes, CASE WHEN l_linenumber % 2 = 0 THEN l_linestatus END AS platform, NULL::VARCHAR AS sha256 FROM lineitem")
def json_contract(s: SparkSession, d: str) -> DataFrame:
    """Lines with fields that the stage does not know, and without some that it does."""
    path, l = folder(s, "contract"), table(s, d, "lineitem")
    S.write_json(l.select(F.concat(F.lit("v"), "l_orderkey").alias("video_id"), F.col("l_partkey").alias("size_bytes"), F.when(F.col("l_linenumber") % 2 == 0, F.col("l_linestatus")).alias("platform"), F.lit(1).alias("unknown_field")), path)
    return S.read_contract(s, path, "download").select("video_id", "size_bytes", "platform", "sha256")


@add("json_manifests", "SELECT o_orderpriority AS version, 'k' || o_orderkey AS key, sha256(o_orderpriority) AS sha256, o_custkey AS size_bytes, (max(o_custkey) OVER (PARTITION BY o_orderpriority)) AS created_s FROM orders")
def json_manifests(s: SparkSession, d: str) -> DataFrame:
    path, o = folder(s, "manifests"), table(s, d, "orders")
    none = F.lit(None).cast("string")
    entries = o.select(F.col("o_orderpriority").alias("version"), F.timestamp_seconds("o_custkey").alias("created_at"), F.concat(F.lit("k"), "o_orderkey").alias("key"), F.sha2("o_orderpriority", 256).alias("sha256"), F.col("o_custkey").alias("size_bytes"), F.lit("other").alias("file_type"), none.alias("storage_class"), none.alias("compression"))
    S.write_manifests(entries, path)
    return S.read_manifests(s, path).select("version", "key", "sha256", "size_bytes", F.unix_timestamp("created_at").alias("created_s"))


@add("json_contexts", "SELECT lower(event_type) AS platform, 'v' || user_id % 20 AS video_id, max(value)::VARCHAR AS rate, event_type AS model FROM events GROUP BY event_type, user_id % 20")
def json_contexts(s: SparkSession, d: str) -> DataFrame:
    path, e = folder(s, "contexts"), table(s, d, "events").groupBy("event_type", (F.col("user_id") % 20).alias("k")).agg(F.max("value").alias("value"), F.max("ts").alias("ts"))
    rows = e.select(F.lower("event_type").alias("platform"), F.concat(F.lit("v"), "k").alias("video_id"), F.col("ts").cast("timestamp").alias("captured_at"), F.create_map(F.lit("rate"), F.col("value").cast("string")).alias("params"), F.create_map(F.lit("model"), F.col("event_type")).alias("versions"), F.lit("x").alias("unknown"))
    S.write_contexts(rows.repartition("platform"), path)
    return S.read_contexts(s, path).select("platform", "video_id", F.col("params")["rate"].alias("rate"), F.col("versions")["model"].alias("model"))


@add(
    "json_quality_report",
    f"""
    WITH {QUALITY} SELECT count(*) AS total, count_if(reasons = '')::BIGINT AS passed, round(avg((reasons = '')::INT), 6) AS pass_rate, round(avg(quality_score), 6) AS mean_score,
      round(quantile_cont(jitter_score, 0.5), 6) AS median_jitter, coalesce(count_if(contains(reasons, 'jitter=')), 0)::BIGINT AS jittery, 30.0::DOUBLE AS least_frames FROM q
    """,
)
def json_quality_report(s: SparkSession, d: str) -> DataFrame:
    path = folder(s, "report")
    report = Q.quality_report(scored_episodes(s, d))
    S.write_json(report, path)
    back = s.read.schema(report.schema).json(path)
    stat = lambda metric, of: F.round(F.col("stats")[metric][of], 6)
    return back.select("total", "passed", F.round("pass_rate", 6).alias("pass_rate"), stat("quality_score", "mean").alias("mean_score"), stat("jitter_score", "median").alias("median_jitter"), F.coalesce(F.col("failures")["jitter"], F.lit(0)).alias("jittery"), F.col("thresholds")["min_episode_frames"].alias("least_frames"))


# --- Parquet, formats, shards, paths, inventories


def frames(s: SparkSession, d: str) -> DataFrame:
    """50 frames an episode; the last one has no action."""
    e = table(s, d, "embeddings")
    state = F.transform(F.slice("embedding", 1, 3), lambda x: x.cast("double"))
    t = (F.col("vec_id") % 50).cast("int")
    last = F.max(t).over(Q.Window.partitionBy(F.floor(F.col("vec_id") / 50)))
    return e.select(
        F.format_string("e%05d", F.floor(F.col("vec_id") / 50)).alias("episode_id"),
        t.alias("t"),
        (t / 30).alias("ts"),
        state.alias("state"),
        F.when(t < last, F.slice(state, 1, 2)).alias("action"),
        F.abs(F.col("embedding")[63].cast("double")).alias("confidence"),
        F.concat(F.lit("p"), F.floor(F.col("vec_id") / 50) % 3).alias("platform"),
    )


FRAMES = """frames AS (
  SELECT printf('e%05d', vec_id // 50) AS episode_id, (vec_id % 50)::INTEGER AS t, (vec_id % 50) / 30.0::DOUBLE AS ts, embedding[1]::DOUBLE AS s0,
    CASE WHEN vec_id % 50 < max(vec_id % 50) OVER (PARTITION BY vec_id // 50) THEN embedding[2]::DOUBLE END AS a1, abs(embedding[64]::DOUBLE) AS confidence, 'p' || vec_id // 50 % 3 AS platform
  FROM embeddings)"""


def _first(column: str, i: int) -> Column:
    return F.get(F.col(column), F.lit(i))


@add("parquet_frames", f"WITH {FRAMES} SELECT episode_id, t, ts, s0, a1, platform FROM frames")
def parquet_frames(s: SparkSession, d: str) -> DataFrame:
    path = folder(s, "frames")
    S.write_frames(frames(s, d), path, ["platform"])
    return S.load(s, path).select("episode_id", "t", "ts", _first("state", 0).alias("s0"), _first("action", 1).alias("a1"), "platform")


@add(
    "parquet_episodes",
    f"""
    WITH {FRAMES} SELECT episode_id, min(ts) AS start_ts, max(ts) AS end_ts, count(*) AS duration, 3::INTEGER AS state_dim,
      CASE WHEN count(a1) > 0 THEN 2 ELSE 0 END::INTEGER AS action_dim, round(avg(confidence), 9) AS quality FROM frames GROUP BY 1
    """,
)
def parquet_episodes(s: SparkSession, d: str) -> DataFrame:
    path = folder(s, "episodes")
    S.write_episodes(frames(s, d), path)
    return S.load(s, path).withColumn("quality", F.round("quality", 9))


@add("episode_scores", f"WITH {FRAMES} SELECT episode_id, 0::BIGINT AS start_frame, count(*) AS end_frame, count(*) AS duration_frames, round(avg(confidence), 9) AS confidence_score, round(avg(confidence), 9) AS quality_score, 0.0::DOUBLE AS jittering_score FROM frames GROUP BY 1")
def episode_scores(s: SparkSession, d: str) -> DataFrame:
    return S.episode_scores(frames(s, d)).withColumns({c: F.round(c, 9) for c in ("confidence_score", "quality_score")})


@add("parquet_shards", f"WITH {FRAMES} SELECT (substr(episode_id, 2)::INTEGER % 4)::INTEGER AS shard, episode_id, t, row_number() OVER (PARTITION BY substr(episode_id, 2)::INTEGER % 4 ORDER BY episode_id, t) - 1 AS place FROM frames")
def parquet_shards(s: SparkSession, d: str) -> DataFrame:
    """Where each frame stands in its shard: the episode's offset and its own place."""
    path = folder(s, "shards")
    S.write_shards(frames(s, d).withColumn("shard", (F.substring("episode_id", 2, 9).cast("int") % 4)), path)
    rows = S.load(s, path)
    offsets = V.shard_offsets(rows.groupBy("shard", "episode_id").agg(F.count(F.lit(1)).alias("n")))
    return rows.join(offsets, ["shard", "episode_id"]).select("shard", "episode_id", "t", (F.col("state_start") + F.col("t")).alias("place"))


@add("formats", f"WITH {FRAMES} SELECT f AS format, episode_id, t, round(confidence, 9) AS confidence FROM frames, (SELECT unnest(['parquet', 'orc', 'json', 'csv']) AS f)")
def formats(s: SparkSession, d: str) -> DataFrame:
    rows = frames(s, d).select("episode_id", "t", "confidence")
    paths = S.export(rows, folder(s, "formats"), ["parquet", "orc", "json", "csv"])
    read = {"csv": lambda p: S.read_csv(s, p), "json": lambda p: s.read.schema(rows.schema).json(p), "orc": s.read.orc, "parquet": s.read.parquet}
    each = [read[f](p).select(F.lit(f).alias("format"), "episode_id", F.col("t").cast("int").alias("t"), F.round(F.col("confidence").cast("double"), 9).alias("confidence")) for f, p in paths.items()]
    out = each[0]
    for x in each[1:]:
        out = out.unionByName(x)
    return out


@add(
    "result_paths",
    """
    SELECT o_orderstatus AS platform, 'v' || o_custkey % 5 AS video_id, 'r' || o_orderkey % 2 AS processing_version, o_orderkey,
      'out/episodes/' || o_orderstatus || '/v' || o_custkey % 5 || '/r' || o_orderkey % 2 AS path FROM orders
    """,
)
def result_paths(s: SparkSession, d: str) -> DataFrame:
    path, o = folder(s, "results"), table(s, d, "orders")
    rows = o.select(F.col("o_orderstatus").alias("platform"), F.concat(F.lit("v"), F.col("o_custkey") % 5).alias("video_id"), F.concat(F.lit("r"), F.col("o_orderkey") % 2).alias("processing_version"), "o_orderkey")
    S.write_results(rows.where("o_orderkey % 3 = 0"), path)
    S.write_results(rows.where("o_orderkey % 3 != 0"), path)
    back = S.load(s, path)
    return back.withColumn("path", V.result_path("out", F.lit("episodes"), F.col("platform"), F.col("video_id"), F.col("processing_version"))).select("platform", "video_id", "processing_version", "o_orderkey", "path")


@add("dated_paths", "SELECT event_id, strftime(ts, 'in/%Y/%m/%d/') || event_id AS path FROM events")
def dated_paths(s: SparkSession, d: str) -> DataFrame:
    path, e = folder(s, "dated"), table(s, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    S.write_dated(e, path, "ts")
    day = F.make_date(F.col("y").cast("int"), F.col("m").cast("int"), F.col("d").cast("int"))
    return S.load(s, path).select("event_id", V.dated_key("in", day, F.col("event_id").cast("string")).alias("path"))


@add("inventory", "SELECT n_name AS name, length('é' || n_name) + 2 AS size_bytes, sha256('é' || n_name || chr(10)) AS sha256 FROM nation")
def inventory(s: SparkSession, d: str) -> DataFrame:
    path = folder(s, "inventory")
    table(s, d, "nation").select(F.concat(F.lit("é"), "n_name").alias("value"), "n_name").write.partitionBy("n_name").text(path)
    files = S.inventory(s, path, digests=True)
    name = F.url_decode(F.regexp_replace(F.regexp_extract("key", "n_name=([^/]*)/", 1), " ", "%20"))
    return files.select(name.alias("name"), "size_bytes", "sha256")


@add(
    "array_containers",
    """
    SELECT printf('e%05d', vec_id // 50) AS episode_id, (vec_id % 50)::INTEGER AS t, (vec_id % 50) / 25.0::DOUBLE AS ts, 4::INTEGER AS width, abs(embedding[64]::DOUBLE) AS confidence,
      embedding[1]::DOUBLE AS first_x, embedding[12]::DOUBLE AS last_v, embedding[13]::DOUBLE AS left_x, embedding[24]::DOUBLE AS right_z FROM embeddings
    """,
)
def array_containers(s: SparkSession, d: str) -> DataFrame:
    """An array container an episode, with poses, both hands, confidence and times."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    hand = lambda start: F.array(F.slice(v, start, 3), F.slice(v, start + 3, 3))
    t = (F.col("vec_id") % 50).cast("int")
    rows = table(s, d, "embeddings").select(
        F.format_string("e%05d", F.floor(F.col("vec_id") / 50)).alias("episode_id"),
        t.alias("t"),
        F.slice(v, 1, 12).alias("keypoints"),
        hand(13).alias("left_hand"),
        hand(19).alias("right_hand"),
        F.abs(v[63]).alias("conf"),
        (t / 25).alias("timestamps"),
    )
    path = folder(s, "arrays")
    A.write_arrays(rows, path).write.format("noop").mode("overwrite").save()
    back = A.read_arrays(s, path)
    name = F.regexp_extract("path", r"(e\d+)\.npz", 1)
    return back.select(name.alias("episode_id"), "t", "ts", "width", "confidence", F.col("pose")[0].alias("first_x"), F.col("pose")[11].alias("last_v"), F.col("hands")[0].alias("left_x"), F.col("hands")[11].alias("right_z"))
