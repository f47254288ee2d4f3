"""Queries over frame tables: hands and bodies from embeddings, scalar series from events, detections from lineitem."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motionframe.functions import vec as V
from motionframe.functions.scalar import micros
from motionframe.operators import augment as A
from motionframe.operators import encoding as E
from motionframe.operators import geometry as G
from motionframe.operators import interactions as I
from motionframe.operators import quality as Q
from motionframe.operators import temporal as T
from motionframe.operators import windows as W
from motionframe.plans.registry import Registry
from motionframe.session import table

R = Registry()
EPISODE = 50


def _points(n: int, wrap: int | None = None) -> F.Column:
    at = lambda i: F.col("embedding")[i % wrap if wrap else i].cast("double")
    return F.array(*(V.vec(at(3 * j), at(3 * j + 1), at(3 * j + 2)) for j in range(n)))


def hands(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "embeddings")
    return e.select(F.floor(F.col("vec_id") / EPISODE).alias("episode_id"), (F.col("vec_id") % EPISODE).alias("t"), ((F.col("vec_id") % EPISODE) / 30).alias("ts"), _points(21).alias("pose"), F.abs(F.col("embedding")[63].cast("double")).alias("confidence"))


def bodies(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "embeddings")
    conf = F.abs(F.col("embedding")[63].cast("double"))
    return e.select(
        F.floor(F.col("vec_id") / EPISODE).alias("episode_id"), (F.col("vec_id") % EPISODE).alias("t"), ((F.col("vec_id") % EPISODE) / 30).alias("ts"), _points(33, 63).alias("pose"),
        F.array_repeat(F.least(conf * 10, F.lit(1.0)), 33).alias("conf"), _points(21).alias("left_hand"), _points(21).alias("right_hand"), conf.alias("confidence"),
    )


def seen_bodies(s: SparkSession, d: str) -> DataFrame:
    """With a visibility at each joint."""
    return bodies(s, d).withColumn("pose", F.transform("pose", lambda j: F.struct(j["x"].alias("x"), j["y"].alias("y"), j["z"].alias("z"), F.least(F.lit(1.0), F.abs(j["x"]) * 6).alias("visibility"))))


def series(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "events").select(F.col("user_id").alias("episode_id"), micros("ts").alias("t"), (micros("ts") / 1e6).alias("ts"), "value")


SERIES = "s AS (SELECT user_id AS episode_id, epoch_us(ts) AS t, epoch_us(ts) / 1e6 AS ts, value FROM events)"
HANDS = "h AS (SELECT vec_id // 50 AS episode_id, vec_id % 50 AS t, embedding::DOUBLE[] AS e, abs(embedding[64]::DOUBLE) AS confidence FROM embeddings)"
_WAY = "list_sum(list_transform(range(0, 21), lambda j: sqrt(pow(b.e[3*j+1]-a.e[3*j+1], 2) + pow(b.e[3*j+2]-a.e[3*j+2], 2) + pow(b.e[3*j+3]-a.e[3*j+3], 2)))) / 21"
ENERGY = f"{HANDS}, g AS (SELECT a.episode_id, a.t, a.confidence, {_WAY} AS energy FROM h a LEFT JOIN h b ON b.episode_id = a.episode_id AND b.t = a.t + 1)"


def r(c: str, n: int = 6) -> F.Column:
    return F.round(c, n).alias(c)


def exploded(df: DataFrame, column: str = "pose", keys: tuple[str, ...] = ("episode_id", "t")) -> DataFrame:
    """(keys, j, x, y, z) rounded: a form that SQL can give too."""
    return df.select(*keys, F.posexplode(column).alias("j", "p")).select(*keys, "j", *(F.round(f"p.{k}", 5).alias(k) for k in "xyz"))


R.add("velocity", lambda s, d: W.velocity(series(s, d), "value", 2.0).select("episode_id", "t", r("velocity")), f"WITH {SERIES} SELECT episode_id, t, round(CASE WHEN lag(value) OVER w IS NULL AND lead(value) OVER w IS NULL THEN 0 WHEN lag(value) OVER w IS NULL THEN (lead(value) OVER w - value) * 2 WHEN lead(value) OVER w IS NULL THEN (value - lag(value) OVER w) * 2 ELSE (lead(value) OVER w - lag(value) OVER w) * 2 / 2 END, 6) AS velocity FROM s WINDOW w AS (PARTITION BY episode_id ORDER BY t)")
R.add("difference", lambda s, d: W.difference(series(s, d), "value").select("episode_id", "t", r("delta")), f"WITH {SERIES} SELECT episode_id, t, round(lead(value) OVER (PARTITION BY episode_id ORDER BY t) - value, 6) AS delta FROM s")
R.add("acceleration", lambda s, d: W.acceleration(series(s, d), "value", 1.0).groupBy("episode_id").agg(F.round(F.sum("acceleration"), 4).alias("total")), f"WITH {SERIES}, v AS (SELECT episode_id, t, CASE WHEN lag(value) OVER w IS NULL THEN lead(value) OVER w - value WHEN lead(value) OVER w IS NULL THEN value - lag(value) OVER w ELSE (lead(value) OVER w - lag(value) OVER w) / 2 END AS v FROM s WINDOW w AS (PARTITION BY episode_id ORDER BY t)), a AS (SELECT episode_id, CASE WHEN lag(v) OVER w IS NULL THEN lead(v) OVER w - v WHEN lead(v) OVER w IS NULL THEN v - lag(v) OVER w ELSE (lead(v) OVER w - lag(v) OVER w) / 2 END AS a FROM v WINDOW w AS (PARTITION BY episode_id ORDER BY t)) SELECT episode_id, round(sum(a), 4) AS total FROM a GROUP BY 1")
R.add("moving_average", lambda s, d: W.moving_average(series(s, d), "value", 30).select("episode_id", "t", r("average", 4)), f"WITH {SERIES}, n AS (SELECT *, count(*) OVER (PARTITION BY episode_id) AS n, avg(value) OVER (PARTITION BY episode_id) AS m FROM s) SELECT episode_id, t, round(CASE WHEN n < 30 THEN m ELSE sum(value) OVER (PARTITION BY episode_id ORDER BY t ROWS BETWEEN 15 PRECEDING AND 14 FOLLOWING) / 30 END, 4) AS average FROM n")
R.add("motion_energy", lambda s, d: W.motion_energy(hands(s, d)).select("episode_id", "t", r("energy")), f"WITH {ENERGY} SELECT episode_id, t, round(energy, 6) AS energy FROM g")
R.add("pose_jitter", lambda s, d: W.jitter(hands(s, d)).select("episode_id", "t", r("jitter")), f"WITH {HANDS} SELECT a.episode_id, a.t, round(coalesce(list_sum(list_transform(range(0, 21), lambda j: sqrt(pow(b.e[3*j+1]-2*a.e[3*j+1]+c.e[3*j+1], 2) + pow(b.e[3*j+2]-2*a.e[3*j+2]+c.e[3*j+2], 2) + pow(b.e[3*j+3]-2*a.e[3*j+3]+c.e[3*j+3], 2)))) / 21, 0), 6) AS jitter FROM h a LEFT JOIN h b ON b.episode_id = a.episode_id AND b.t = a.t + 1 LEFT JOIN h c ON c.episode_id = a.episode_id AND c.t = a.t - 1")
_T = 0.21
_SEG = f"{ENERGY}, f AS (SELECT *, energy > {_T} AS m FROM g WHERE energy IS NOT NULL), i AS (SELECT *, t - row_number() OVER (PARTITION BY episode_id, m ORDER BY t) AS k FROM f), u AS (SELECT episode_id, min(t) AS a, max(t) + 1 AS b FROM i WHERE m GROUP BY episode_id, k HAVING count(*) >= 3), p AS (SELECT episode_id, unnest(range(a, b, 8)) AS start, b FROM u), seg AS (SELECT episode_id, start, least(start + 8, b) AS \"end\" FROM p WHERE least(start + 8, b) - start >= 3)"
R.add("motion_segments", lambda s, d: W.motion_segments(W.motion_energy(hands(s, d)), threshold=_T, least=3, most=8), f"WITH {_SEG} SELECT * FROM seg")
R.add("segment_scores", lambda s, d: Q.segment_scores(W.motion_segments(W.motion_energy(hands(s, d)), threshold=_T, least=3, most=8), W.motion_energy(hands(s, d)).withColumn("jitter", F.coalesce(F.col("energy") / 10, F.lit(0.0))), least=0.05).select("episode_id", "start", "end", r("confidence"), r("score")), f"WITH {_SEG}, j AS (SELECT seg.episode_id, start, \"end\", avg(confidence) AS c, avg(coalesce(energy / 10, 0)) AS q FROM seg JOIN g ON g.episode_id = seg.episode_id AND t >= start AND t < \"end\" GROUP BY 1, 2, 3 HAVING avg(confidence) >= 0.05) SELECT episode_id, start, \"end\", round(c, 6) AS confidence, round(c * (1 - least(q * 10, 1.0)), 6) AS score FROM j")
R.add("fixed_segments", lambda s, d: W.fixed_segments(series(s, d).groupBy("episode_id").agg(F.count(F.lit(1)).alias("n")), 20, 5), f"WITH {SERIES}, n AS (SELECT episode_id, count(*) AS n FROM s GROUP BY 1), b AS (SELECT episode_id, n, unnest(range(0, n - 20 + 1, 15)) AS start FROM n), l AS (SELECT n.episode_id, n.n, coalesce((SELECT max(start) + 15 FROM b WHERE b.episode_id = n.episode_id), 0) AS start FROM n) SELECT episode_id, start, start + 20 AS \"end\" FROM b UNION ALL SELECT episode_id, start, n AS \"end\" FROM l WHERE n - start >= 10")
R.add("continuity", lambda s, d: W.continuity(hands(s, d), F.col("confidence") > 0.05), f"WITH {HANDS}, i AS (SELECT episode_id, confidence > 0.05 AS v, t - row_number() OVER (PARTITION BY episode_id, confidence > 0.05 ORDER BY t) AS k FROM h), c AS (SELECT episode_id, v, k, count(*) AS n FROM i GROUP BY 1, 2, 3) SELECT episode_id, coalesce(max(CASE WHEN v THEN n END), 0) AS continuous_frames, coalesce(max(CASE WHEN NOT v THEN n END), 0) AS max_gap_frames FROM c GROUP BY 1")
R.add("carry_forward", lambda s, d: W.carried(series(s, d), "value", F.col("value") > 40, "last_value").select("episode_id", "t", "last_value"), f"WITH {SERIES} SELECT episode_id, t, last_value(CASE WHEN value > 40 THEN value END IGNORE NULLS) OVER (PARTITION BY episode_id ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_value FROM s")
R.add("gaps", lambda s, d: W.gaps(series(s, d), 1 / 3600, 20.0), f"WITH {SERIES}, w AS (SELECT episode_id, ts AS a, lead(ts) OVER p AS b, min(ts) OVER (PARTITION BY episode_id) AS t0 FROM s WINDOW p AS (PARTITION BY episode_id ORDER BY ts)) SELECT episode_id, CAST(ceil((a - t0) * (1 / 3600)) AS BIGINT) AS start, CAST(ceil((b - t0) * (1 / 3600)) AS BIGINT) AS \"end\" FROM w WHERE b - a > 20.0 / (1 / 3600)")
R.add("resample", lambda s, d: T.resample(series(s, d), 1 / 7200).select("episode_id", "i", r("value", 4), "valid", "interpolated"), f"WITH {SERIES}, g AS (SELECT episode_id, t0 + i * 7200.0 AS ts, i FROM (SELECT episode_id, t0, unnest(range(0, CAST(ceil(round((t1 - t0) * (1 / 7200), 9)) AS BIGINT))) AS i FROM (SELECT episode_id, min(ts) AS t0, max(ts) AS t1 FROM s GROUP BY 1))), p AS (SELECT g.*, s.ts AS pt, s.value AS pv FROM g ASOF LEFT JOIN s ON g.episode_id = s.episode_id AND g.ts >= s.ts), n AS (SELECT p.*, s.ts AS nt, s.value AS nv FROM p ASOF LEFT JOIN s ON p.episode_id = s.episode_id AND p.ts <= s.ts) SELECT episode_id, i, round(CASE WHEN nt = pt THEN pv ELSE pv + (nv - pv) * (ts - pt) / (nt - pt) END, 4) AS value, least(ts - pt, nt - ts) < 3600 AS valid, NOT (least(ts - pt, nt - ts) < 3600) AS interpolated FROM n")
R.add("aligned_channels", lambda s, d: T.aligned_channels(hands(s, d).select("episode_id", "ts", F.col("pose")[0]["x"].alias("x"), "confidence"), 20.0, ["x"], "confidence", 0.02).select("episode_id", "i", r("x"), r("confidence"), "valid", "low_confidence"))
R.add("hand_gripper", lambda s, d: hands(s, d).select("episode_id", "t", F.round(E.gripper(F.lit(None).cast("array<struct<x:double,y:double,z:double>>"), F.col("pose")), 6).alias("gripper"), E.gripper_closed(F.col("pose")).alias("closed")), f"WITH {HANDS}, p AS (SELECT episode_id, t, sqrt(pow(e[13]-e[25], 2) + pow(e[14]-e[26], 2) + pow(e[15]-e[27], 2)) AS p FROM h) SELECT episode_id, t, round(least(1.0, greatest(0.0, 1 - (p - 0.03) / 0.2)), 6) AS gripper, (p < 0.05)::DOUBLE AS closed FROM p")
R.add("translated_hand", lambda s, d: exploded(hands(s, d).withColumn("pose", G.joint_relative_to(F.col("pose"), 0))), f"WITH {HANDS}, j AS (SELECT unnest(range(0, 21))::INTEGER AS j) SELECT episode_id, t, j, round(e[3*j+1] - e[1], 5) AS x, round(e[3*j+2] - e[2], 5) AS y, round(e[3*j+3] - e[3], 5) AS z FROM h, j")
BODY = "b AS (SELECT vec_id // 50 AS episode_id, vec_id % 50 AS t, list_transform(range(0, 99), lambda i: embedding[i % 63 + 1]::DOUBLE) AS e FROM embeddings)"
R.add("body_normalised", lambda s, d: exploded(bodies(s, d).withColumn("pose", G.hip_normalized(F.col("pose")))), f"WITH {BODY}, c AS (SELECT *, list_transform(range(1, 4), lambda k: (e[69+k] + e[72+k]) / 2) AS o, least(2.0, greatest(0.01, sqrt(pow(e[34]-e[37], 2) + pow(e[35]-e[38], 2) + pow(e[36]-e[39], 2)))) AS w FROM b), j AS (SELECT unnest(range(0, 33))::INTEGER AS j) SELECT episode_id, t, j, round((e[3*j+1] - o[1]) / w, 5) AS x, round((e[3*j+2] - o[2]) / w, 5) AS y, round((e[3*j+3] - o[3]) / w, 5) AS z FROM c, j")
R.add("mirror", lambda s, d: exploded(bodies(s, d).withColumn("pose", A.mirrored(F.col("pose")))), f"WITH {BODY}, j AS (SELECT j::INTEGER AS j, m FROM (SELECT unnest(range(0, 33)) AS j, unnest([0, 4, 5, 6, 1, 2, 3, 8, 7, 10, 9, 12, 11, 14, 13, 16, 15, 18, 17, 20, 19, 22, 21, 24, 23, 26, 25, 28, 27, 30, 29, 32, 31]) AS m)) SELECT episode_id, t, j, round(-e[3*m+1], 5) AS x, round(e[3*m+2], 5) AS y, round(e[3*m+3], 5) AS z FROM b, j")
R.add("joint_relative", lambda s, d: exploded(bodies(s, d).withColumn("pose", G.joint_relative(F.col("pose"), G.LIMB_PARENT))), f"WITH {BODY}, j AS (SELECT j::INTEGER AS j, p FROM (SELECT unnest(range(0, 33)) AS j, unnest([NULL,NULL,NULL,NULL,NULL,NULL,NULL,NULL,NULL,NULL,NULL,0,0,11,12,13,14,NULL,NULL,NULL,NULL,NULL,NULL,0,0,23,24,25,26,NULL,NULL,NULL,NULL]) AS p)) SELECT episode_id, t, j, round(e[3*j+1] - coalesce(e[3*p+1], 0), 5) AS x, round(e[3*j+2] - coalesce(e[3*p+2], 0), 5) AS y, round(e[3*j+3] - coalesce(e[3*p+3], 0), 5) AS z FROM b, j")
R.add("height_scaled", lambda s, d: bodies(s, d).select("episode_id", "t", F.round(G.height_scaled(F.col("pose"))["factor"], 6).alias("factor")), f"WITH {BODY}, n AS (SELECT episode_id, t, sqrt(pow(e[1]-(e[82]+e[85])/2, 2) + pow(e[2]-(e[83]+e[86])/2, 2) + pow(e[3]-(e[84]+e[87])/2, 2)) AS h FROM b) SELECT episode_id, t, round(CASE WHEN h < 1e-6 THEN 1.0 ELSE 1.7 / h END, 6) AS factor FROM n")


def lines(s: SparkSession, d: str) -> DataFrame:
    """l_orderkey, l_suppkey and the detected object of each line."""
    p = table(s, d, "lineitem")
    x, y = (F.col("l_partkey") % 1800).cast("int"), (F.col("l_suppkey") % 1000).cast("int")
    o = F.struct(F.ascii("l_returnflag").alias("class_id"), F.col("l_returnflag").alias("class_name"), (1 - F.col("l_tax")).alias("confidence"), F.array(x, y, (x + 20 + F.col("l_quantity")).cast("int"), y + 20 + F.col("l_linenumber") * 10).alias("bbox"))
    return p.select("l_orderkey", "l_suppkey", o.alias("o"))


def detections(s: SparkSession, d: str) -> DataFrame:
    """A row for each object: frames have no bound on their objects."""
    return lines(s, d).select((F.col("l_suppkey") % 10).cast("string").alias("video_id"), (F.col("l_orderkey") % 200).alias("frame_idx"), "o")


def hand_detections(s: SparkSession, d: str) -> DataFrame:
    """A row for each object, on the frames of tracked_hands: lines are dealt over all frames by order.

    Where there are more frames than orders, an order's lines are seen in several frames.
    """
    n = table(s, d, "embeddings").agg(F.max("vec_id")).first()[0]
    m = table(s, d, "lineitem").agg(F.max("l_orderkey")).first()[0]
    frames = (n or 0) + 1
    slots = min(frames, (m or 0) + 1)
    at = F.explode(F.sequence(F.pmod("l_orderkey", F.lit(slots)), F.lit(frames - 1).cast("long"), F.lit(slots).cast("long")))
    rows = lines(s, d).select(at.alias("at"), "o")
    return rows.select(F.floor(F.col("at") / EPISODE).cast("string").alias("video_id"), (F.col("at") % EPISODE).alias("frame_idx"), "o")


def tracked_hands(s: SparkSession, d: str) -> DataFrame:
    """Every hand, on a frame of its own: its episode is its video."""
    points = F.transform("pose", lambda p: V.vec(F.abs(p["x"]) * 3, F.abs(p["y"]) * 3, p["z"]))
    return hands(s, d).select(F.col("episode_id").cast("string").alias("video_id"), F.col("t").alias("frame_idx"), F.lit("left").alias("hand"), points.alias("points"))


R.add("largest_object", lambda s, d: I.largest_in_frame(detections(s, d)).select("video_id", "frame_idx", F.col("o.bbox").alias("bbox")).select("video_id", "frame_idx", ((F.col("bbox")[2] - F.col("bbox")[0]) * (F.col("bbox")[3] - F.col("bbox")[1])).alias("area")), "SELECT CAST(l_suppkey % 10 AS VARCHAR) AS video_id, l_orderkey % 200 AS frame_idx, max(CAST(20 + l_quantity AS INTEGER) * CAST(20 + l_linenumber * 10 AS INTEGER)) AS area FROM lineitem GROUP BY 1, 2")
R.add("sampled_frames", lambda s, d: I.sampled(detections(s, d).select("video_id", "frame_idx").distinct(), 30.0, 10.0, 40), "SELECT DISTINCT CAST(l_suppkey % 10 AS VARCHAR) AS video_id, l_orderkey % 200 AS frame_idx FROM lineitem WHERE (l_orderkey % 200) % 3 = 0 AND l_orderkey % 200 < 120")
R.add("viewpoint", lambda s, d: exploded(bodies(s, d).withColumn("pose", A.rotated(F.col("pose"), F.lit(90.0), F.lit(0.0), F.lit(0.0)))), f"WITH {BODY}, j AS (SELECT unnest(range(0, 33))::INTEGER AS j) SELECT episode_id, t, j, round(e[3*j+1] * cos(radians(90)) + e[3*j+3] * sin(radians(90)), 5) AS x, round(e[3*j+2], 5) AS y, round(-e[3*j+1] * sin(radians(90)) + e[3*j+3] * cos(radians(90)), 5) AS z FROM b, j")
R.add("speed_change", lambda s, d: A.sped(bodies(s, d).select("episode_id", "t", "ts", "pose"), F.lit(1.25)).groupBy("episode_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.max("ts"), 6).alias("end_ts")), "WITH f AS (SELECT vec_id // 50 AS e, count(*) AS n, max((vec_id % 50) / 30) AS t FROM embeddings GROUP BY 1) SELECT e AS episode_id, CAST(floor(n / 1.25) AS BIGINT) AS n, round(t / 1.25, 6) AS end_ts FROM f")
R.add("pca_transform", lambda s, d: G.apply_pca(hands(s, d), G.fit_pca(hands(s, d), 4)).select("episode_id", "t", F.size("components").alias("k"), F.round(F.aggregate("components", F.lit(0.0), lambda a, v: a + v * v), 5).alias("energy")))
