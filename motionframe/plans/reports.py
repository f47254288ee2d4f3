"""Queries over frames whose result is a report: alignment, states and actions, quality, interactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motionframe.functions import vec as V
from motionframe.operators import augment as A
from motionframe.operators import encoding as E
from motionframe.operators import geometry as G
from motionframe.operators import interactions as I
from motionframe.operators import quality as Q
from motionframe.operators import temporal as T
from motionframe.operators import windows as W
from motionframe.plans.frames import BODY, HANDS, SERIES, bodies, exploded, hand_detections, hands, r, seen_bodies, series, tracked_hands
from motionframe.plans.registry import Registry

R = Registry()

# --- time alignment

_SPAN = f"{SERIES}, sp AS (SELECT episode_id, min(ts) AS t0, max(ts) AS t1 FROM s GROUP BY 1), g AS (SELECT episode_id, t0, unnest(range(0, CAST(ceil(round((t1 - t0) * (1 / 7200), 9)) AS BIGINT))) AS i FROM sp)"
_GRID = f"{_SPAN}, p AS (SELECT g.episode_id, g.i, g.t0 + g.i * 7200.0 AS ts, s.ts AS pt FROM g ASOF LEFT JOIN s ON g.episode_id = s.episode_id AND g.t0 + g.i * 7200.0 >= s.ts), n AS (SELECT p.*, s.ts AS nt FROM p ASOF LEFT JOIN s ON p.episode_id = s.episode_id AND p.ts <= s.ts)"
R.add("interpolated_ratio", lambda s, d: T.interpolated_ratio(T.resample(series(s, d), 1 / 7200)).select("episode_id", r("interpolated_ratio")), f"WITH {_GRID} SELECT episode_id, round(avg(CASE WHEN least(ts - pt, nt - ts) < 3600 THEN 0.0 ELSE 1.0 END), 6) AS interpolated_ratio FROM n GROUP BY 1")


def _pieces(s: SparkSession, d: str) -> DataFrame:
    found = W.gaps(series(s, d), 1 / 7200, 6.0)
    return W.split_by_gaps(T.resample(series(s, d), 1 / 7200), found, 10).groupBy("episode_id", "piece").agg(F.count(F.lit(1)).alias("n"), F.min("i").alias("first"), F.max("i").alias("last"))


R.add("split_by_gaps", _pieces, f"""WITH {_SPAN}, w AS (SELECT s.episode_id, t0, ts AS a, lead(ts) OVER (PARTITION BY s.episode_id ORDER BY ts) AS b FROM s JOIN sp USING (episode_id)),
q AS (SELECT episode_id, CAST(ceil((a - t0) * (1 / 7200)) AS BIGINT) AS b, CAST(ceil((b - t0) * (1 / 7200)) AS BIGINT) AS e FROM w WHERE b - a > 6.0 / (1 / 7200)),
k AS (SELECT g.episode_id, g.i, count(DISTINCT q.b) AS piece, coalesce(bool_or(g.i < q.e), false) AS inside FROM g LEFT JOIN q ON q.episode_id = g.episode_id AND q.e > q.b AND q.b <= g.i GROUP BY 1, 2)
SELECT episode_id, piece, count(*) AS n, min(i) AS first, max(i) AS last FROM k WHERE NOT inside GROUP BY 1, 2 HAVING count(*) >= 10 OR episode_id NOT IN (SELECT episode_id FROM q WHERE e > b)""")
_ROWS = {n: W.savgol_rows(n, min(3, n - 1)) for n in (3, 5, 7, 9, 11)}
_WEIGHTS = ", ".join(f"({n}, {i}, {k}, {float(x)!r}::DOUBLE)" for n, rows in _ROWS.items() for i, row in enumerate(rows) for k, x in enumerate(row))
R.add("smoothing_savgol", lambda s, d: W.smoothed(series(s, d), "value").select("episode_id", "t", F.round("smoothed", 5).alias("smoothed")), f"""WITH {SERIES}, k AS (SELECT * FROM (VALUES {_WEIGHTS}) AS v(size, i, k, x)),
o AS (SELECT *, row_number() OVER (PARTITION BY episode_id ORDER BY t) - 1 AS i, count(*) OVER (PARTITION BY episode_id) AS n FROM s), z AS (SELECT *, least(11, CASE WHEN n % 2 = 0 THEN n - 1 ELSE n END) AS size FROM o),
f AS (SELECT *, greatest(0, least(i - size // 2, n - size)) AS first FROM z)
SELECT a.episode_id, a.t, round(CASE WHEN a.size < 3 THEN any_value(a.value) ELSE sum(b.value * k.x) END, 5) AS smoothed FROM f a JOIN f b ON b.episode_id = a.episode_id AND b.i >= a.first AND b.i < a.first + a.size LEFT JOIN k ON k.size = a.size AND k.i = a.i - a.first AND k.k = b.i - a.first GROUP BY a.episode_id, a.t, a.size""")
R.add("depth_norm", lambda s, d: exploded(A.depth_normalized(hands(s, d).select("episode_id", "t", "pose"))).select("episode_id", "t", "j", F.floor(F.col("z") * 100 + 1e-4).alias("z")), f"WITH {HANDS}, x AS (SELECT episode_id, t, unnest(range(0, 21))::INTEGER AS j, e FROM h), z AS (SELECT episode_id, t, j, e[3*j+3] AS z FROM x), m AS (SELECT *, quantile_cont(z, 0.5) OVER (PARTITION BY episode_id) AS a FROM z), q AS (SELECT *, quantile_cont(abs(z - a), 0.5) OVER (PARTITION BY episode_id) + 1e-8 AS b FROM m) SELECT episode_id, t, j, CAST(floor(round((z - a) / b, 5) * 100 + 1e-4) AS BIGINT) AS z FROM q")
_Z = f"WITH {HANDS}, x AS (SELECT episode_id, t, unnest(range(0, 21))::INTEGER AS j, e FROM h), z AS (SELECT episode_id, t, j, e[3*j+3] AS z FROM x), m AS (SELECT *, min(z) OVER p AS lo, max(z) OVER p AS hi, quantile_cont(z, 0.5) OVER p AS a, stddev_pop(z) OVER p AS sd FROM z WINDOW p AS (PARTITION BY episode_id))"
R.add("depth_range", lambda s, d: exploded(A.depth_normalized(hands(s, d).select("episode_id", "t", "pose"), "range")).select("episode_id", "t", "j", "z"), f"{_Z} SELECT episode_id, t, j, round(CASE WHEN hi - lo > 1e-8 THEN 2 * (z - lo) / (hi - lo) - 1 ELSE z END, 5) AS z FROM m")
R.add("depth_clip", lambda s, d: exploded(A.depth_normalized(hands(s, d).select("episode_id", "t", "pose"), "clip")).select("episode_id", "t", "j", "z"), f"{_Z} SELECT episode_id, t, j, round(greatest(a - 3 * sd, least(a + 3 * sd, z)), 5) AS z FROM m")
R.add("rotation_normalised", lambda s, d: exploded(bodies(s, d).withColumn("pose", G.shoulders_to_x(F.col("pose")))), f"""WITH {BODY}, a AS (SELECT *, e[37]-e[34] AS ax, e[38]-e[35] AS ay, e[39]-e[36] AS az FROM b), n AS (SELECT *, nullif(sqrt(ax*ax + ay*ay + az*az), 0) AS l FROM a),
u AS (SELECT *, ax/l AS ux, ay/l AS uy, az/l AS uz FROM n), k AS (SELECT *, 1 / nullif(1 + ux, 0) AS k, coalesce(sqrt(uy*uy + uz*uz) < 1e-6, true) AS same FROM u), j AS (SELECT unnest(range(0, 33))::INTEGER AS j), p AS (SELECT *, e[3*j+1] AS x, e[3*j+2] AS y, e[3*j+3] AS z FROM k, j)
SELECT episode_id, t, j, round(CASE WHEN same THEN x ELSE ux*x + uy*y + uz*z END, 5) AS x, round(CASE WHEN same THEN y ELSE -uy*x + (1 - uy*uy*k)*y - uy*uz*k*z END, 5) AS y, round(CASE WHEN same THEN z ELSE -uz*x - uy*uz*k*y + (1 - uz*uz*k)*z END, 5) AS z FROM p""")

# --- states and actions


def _posed(low: float) -> str:
    """Normalised poses p, their velocities v at 30 frames a second, the hand's closing g and the number of frames n."""
    return f"""{BODY}, c AS (SELECT b.*, abs(m.embedding[64]::DOUBLE) AS conf, sqrt(pow(e[13]-e[25], 2) + pow(e[14]-e[26], 2) + pow(e[15]-e[27], 2)) AS pinch, 1 / least(2.0, greatest({low}, sqrt(pow(e[34]-e[37], 2) + pow(e[35]-e[38], 2) + pow(e[36]-e[39], 2)))) AS k FROM b JOIN embeddings m ON m.vec_id = b.episode_id * 50 + b.t),
hp AS (SELECT *, list_transform(range(1, 100), lambda i: (e[i] - (e[70 + (i-1) % 3] + e[73 + (i-1) % 3]) / 2) * k) AS p, CASE WHEN list_max(list_transform(e[1:63], lambda x: abs(x))) > 0 THEN least(1.0, greatest(0.0, 1 - (pinch - 0.03) / 0.2)) ELSE 0.5 END AS g FROM c),
pr AS (SELECT *, count(*) OVER (PARTITION BY episode_id) AS n, lag(p) OVER w AS pb, lead(p) OVER w AS pa, lead(g) OVER w AS ga FROM hp WINDOW w AS (PARTITION BY episode_id ORDER BY t)),
pv AS (SELECT *, list_transform(range(1, 100), lambda i: CASE WHEN pb IS NULL AND pa IS NULL THEN 0.0 WHEN pb IS NULL THEN (pa[i] - p[i]) * 30 WHEN pa IS NULL THEN (p[i] - pb[i]) * 30 ELSE (pa[i] - pb[i]) * 15 END) AS v FROM pr)"""


_PAIRS = f"{_posed(0.01)}, sa AS (SELECT episode_id, t, conf, g, list_transform(list_concat(p, v, [conf]), lambda x: x::FLOAT::DOUBLE) AS state, CASE WHEN pa IS NOT NULL THEN list_transform(list_concat(list_transform(range(1, 100), lambda i: (pa[i] - p[i]) * 30), [ga]), lambda x: x::FLOAT::DOUBLE) END AS action FROM pv WHERE n >= 3)"


def _sum(c: str) -> F.Column:
    return F.aggregate(F.col(c).cast("array<double>"), F.lit(0.0), lambda a, v: a + v)


def _pairs(s: SparkSession, d: str) -> DataFrame:
    return E.imitation_pairs(bodies(s, d), 30.0)[0]


R.add("states_actions", lambda s, d: _pairs(s, d).select("episode_id", "t", F.size("state").alias("state_dim"), F.coalesce(F.size("action"), F.lit(-1)).alias("action_dim"), F.round(_sum("state"), 3).alias("state_sum"), F.round(_sum("action"), 3).alias("action_sum")), f"WITH {_PAIRS} SELECT episode_id, t, len(state)::INTEGER AS state_dim, coalesce(len(action), -1)::INTEGER AS action_dim, round(list_sum(state), 3) AS state_sum, round(list_sum(action), 3) AS action_sum FROM sa")
R.add("validated_pairs", lambda s, d: E.validated(_pairs(s, d).join(bodies(s, d).select("episode_id", "t", F.when((F.col("episode_id") % 3 != 1) | (F.col("t") > 0), F.col("ts") + F.when((F.col("episode_id") % 2 == 0) & (F.col("t") > 20), 1.0).otherwise(0.0)).alias("ts")), ["episode_id", "t"])).select("episode_id", "n_states", "n_actions", "n_times", "state_dim", "action_dim", *(F.round(F.col(c).cast("double"), 3).alias(c) for c in ("state_min", "state_max", "action_min", "action_max")), F.concat_ws(",", "errors").alias("errors"), F.concat_ws(",", "notes").alias("notes"), "valid"), f"""WITH {_PAIRS}, x AS (SELECT *, CASE WHEN episode_id % 3 != 1 OR t > 0 THEN t / 30 + CASE WHEN episode_id % 2 = 0 AND t > 20 THEN 1.0 ELSE 0.0 END END AS ts FROM sa), y AS (SELECT *, lead(ts) OVER (PARTITION BY episode_id ORDER BY ts NULLS FIRST) - ts AS dt FROM x),
a AS (SELECT episode_id, count(state) AS n_states, count(action) AS n_actions, count(ts) AS n_times, stddev_pop(dt) AS ds, avg(dt) AS dm, max(len(state))::INTEGER AS state_dim, max(len(action))::INTEGER AS action_dim, min(list_min(state)) AS state_min, max(list_max(state)) AS state_max, min(list_min(action)) AS action_min, max(list_max(action)) AS action_max FROM y GROUP BY 1)
SELECT episode_id, n_states, n_actions, n_times, state_dim, action_dim, round(state_min, 3) AS state_min, round(state_max, 3) AS state_max, round(action_min, 3) AS action_min, round(action_max, 3) AS action_max, concat_ws(',', CASE WHEN n_times != n_states THEN 'timestamps' END, CASE WHEN n_actions != n_states - 1 THEN 'actions' END) AS errors, concat_ws(',', CASE WHEN ds > dm * 0.1 THEN 'uneven' END, CASE WHEN greatest(abs(state_min), abs(state_max)) > 100 THEN 'large_states' END, CASE WHEN greatest(abs(action_min), abs(action_max)) > 10 THEN 'large_actions' END) AS notes, n_times = n_states AND n_actions = n_states - 1 AS valid FROM a""")
R.add("dataset_stats", lambda s, d: E.dataset_stats(_pairs(s, d).join(bodies(s, d).select("episode_id", "t", "confidence", E.gripper(F.col("left_hand"), F.col("right_hand")).alias("gripper")), ["episode_id", "t"])).select("episodes", "frames", "state_dim", "with_hands", "ready", *(F.round(c, 4).alias(c) for c in ("mean_confidence", "mean_min", "mean_max", "mean_std"))), f"WITH {_PAIRS}, e AS (SELECT episode_id, count(*) AS frames, max(len(state)) AS dim, avg(conf) AS conf, max(g != 0.5) AS hands, min(list_min(state)) AS lo, max(list_max(state)) AS hi FROM sa GROUP BY 1), v AS (SELECT episode_id, stddev_pop(x) AS sd FROM (SELECT episode_id, unnest(state) AS x FROM sa) GROUP BY 1) SELECT count(*) AS episodes, sum(frames)::BIGINT AS frames, max(dim)::INTEGER AS state_dim, count_if(hands)::BIGINT AS with_hands, count_if(conf > 0.1 AND frames >= 5)::BIGINT AS ready, round(avg(conf), 4) AS mean_confidence, round(avg(lo), 4) AS mean_min, round(avg(hi), 4) AS mean_max, round(avg(sd), 4) AS mean_std FROM e JOIN v USING (episode_id)")
_COPY = 1_000_000  # added to the ids of copies


def _with_short(s: SparkSession, d: str) -> DataFrame:
    """All frames, and the first one of every seventh episode as an episode of its own."""
    short = bodies(s, d).where("episode_id % 7 = 3 AND t = 0").withColumn("episode_id", F.col("episode_id") + _COPY)
    return bodies(s, d).unionByName(short)


def _eef(s: SparkSession, d: str) -> DataFrame:
    return E.eef_pairs(_with_short(s, d), 30.0)


_EEF = _posed(0.1).replace("FROM b JOIN", f"FROM (FROM b UNION ALL SELECT * REPLACE (episode_id + {_COPY} AS episode_id) FROM b WHERE episode_id % 7 = 3 AND t = 0) b JOIN").replace("b.episode_id * 50", f"b.episode_id % {_COPY} * 50") + ", ef AS (SELECT episode_id, t, CASE WHEN n < 2 THEN 'too_short' ELSE 'ok' END AS status, list_concat(p, v, [conf, conf]) AS state, CASE WHEN pa IS NOT NULL THEN list_transform(range(46, 52), lambda i: pa[i] - p[i]) END AS action FROM pv)"
R.add("eef_states", lambda s, d: _eef(s, d).select("episode_id", "t", "status", F.size("state").alias("state_dim"), F.round(_sum("state"), 4).alias("state_sum"), F.round(_sum("action"), 5).alias("action_sum")), f"WITH {_EEF} SELECT episode_id, t, status, len(state)::INTEGER AS state_dim, round(list_sum(state), 4) AS state_sum, round(list_sum(action), 5) AS action_sum FROM ef")
R.add("eef_encoding", lambda s, d: E.encoding_summary(E.encoding_results(_eef(s, d))), f"WITH {_EEF}, r AS (SELECT episode_id, max(status) AS status, count(*) AS frames FROM ef GROUP BY 1) SELECT status, count(*) AS episodes, sum(frames)::BIGINT AS frames FROM r GROUP BY 1")
R.add("eef_results", lambda s, d: E.encoding_results(_eef(s, d), _with_short(s, d).select((F.col("episode_id") + F.when(F.col("t") == 7, 1000).otherwise(0)).alias("episode_id")).distinct().withColumn("error", F.when(F.col("episode_id") % 11 == 5, "unreadable"))), f"WITH {_EEF}, f AS (SELECT DISTINCT vec_id // 50 + CASE WHEN vec_id % 50 = 7 THEN 1000 ELSE 0 END AS episode_id FROM embeddings UNION SELECT vec_id // 50 + {_COPY} FROM embeddings WHERE vec_id // 50 % 7 = 3 AND vec_id % 50 = 0), r AS (SELECT episode_id, max(status) AS status, count(*) AS frames, max(len(state))::INTEGER AS state_dim, coalesce(max(len(action)), 0)::INTEGER AS action_dim FROM ef GROUP BY 1) SELECT f.episode_id, CASE WHEN f.episode_id % 11 = 5 THEN 'error' WHEN status IS NULL THEN 'error' ELSE status END AS status, coalesce(frames, 0) AS frames, state_dim, action_dim, CASE WHEN f.episode_id % 11 = 5 THEN 'unreadable' WHEN status = 'too_short' THEN 'under 2 frames: ' || frames WHEN status IS NULL THEN 'no frames' END AS error FROM f LEFT JOIN r USING (episode_id)")
R.add("episode_numbers", lambda s, d: E.episode_stats(_pairs(s, d)).select("episode_id", "rows", "width", "n", *(F.round(c, 3).alias(c) for c in ("mean", "std", "min", "max"))), f"WITH {_PAIRS}, v AS (SELECT episode_id, unnest(state) AS x, len(state) AS w FROM sa) SELECT episode_id, (SELECT count(*) FROM sa WHERE sa.episode_id = v.episode_id) AS rows, max(w)::INTEGER AS width, count(*) AS n, round(avg(x), 3) AS mean, round(stddev_pop(x), 3) AS std, round(min(x), 3) AS min, round(max(x), 3) AS max FROM v GROUP BY episode_id")

# --- quality

QUALITY = f"""{BODY}, c AS (SELECT b.*, abs(m.embedding[64]::DOUBLE) AS conf, len(list_filter(range(0, 33), lambda j: least(1.0, abs(e[3*j+1]) * 6) > 0.5)) AS seen, lead(e) OVER w AS e1, lead(e, 2) OVER w AS e2 FROM b JOIN embeddings m ON m.vec_id = b.episode_id * 50 + b.t WINDOW w AS (PARTITION BY b.episode_id ORDER BY b.t)),
me AS (SELECT episode_id, count(*) AS total_frames, avg(conf) AS confidence_mean, coalesce(avg(CASE WHEN e2 IS NOT NULL THEN list_sum(list_transform(range(1, 100), lambda i: abs(e2[i] - e1[i] * 2 + e[i]))) / 99 END), 0) AS jitter_score, avg(seen) AS visible_joints_mean FROM c GROUP BY 1),
sc AS (SELECT *, total_frames AS continuous_frames, least(confidence_mean / 0.5, 1) * 0.3 + 0.2 + (1 - least(jitter_score / 0.3, 1)) * 0.2 + least(visible_joints_mean / 33 / 0.7, 1) * 0.15 + 0.15 AS quality_score FROM me),
q AS (SELECT *, concat_ws('; ', CASE WHEN confidence_mean < 0.5 THEN printf('confidence=%.2f < 0.5', confidence_mean) END, CASE WHEN jitter_score > 0.3 THEN printf('jitter=%.2f > 0.3', jitter_score) END, CASE WHEN visible_joints_mean < 15 THEN printf('visible_joints=%.1f < 15', visible_joints_mean) END, CASE WHEN total_frames < 30 THEN printf('continuous_frames=%d < 30', total_frames) END) AS reasons FROM sc)"""


def scored_episodes(s: SparkSession, d: str) -> DataFrame:
    return Q.pose_quality(seen_bodies(s, d))


R.add("pose_quality", lambda s, d: scored_episodes(s, d).select("episode_id", "total_frames", "continuous_frames", *(r(c) for c in ("confidence_mean", "jitter_score", "visible_joints_mean", "quality_score")), F.concat_ws("; ", "failure_reasons").alias("reasons"), "passed"), f"WITH {QUALITY} SELECT episode_id, total_frames, continuous_frames, round(confidence_mean, 6) AS confidence_mean, round(jitter_score, 6) AS jitter_score, round(visible_joints_mean, 6) AS visible_joints_mean, round(quality_score, 6) AS quality_score, reasons, reasons = '' AS passed FROM q")
R.add("top_percent", lambda s, d: Q.top_percent(scored_episodes(s, d), 30).select("episode_id", r("quality_score")), f"WITH {QUALITY}, k AS (SELECT *, row_number() OVER (ORDER BY quality_score DESC, episode_id) AS k, count(*) OVER () AS n FROM q) SELECT episode_id, round(quality_score, 6) AS quality_score FROM k WHERE k <= greatest(1, floor(n * 30 / 100))")
_CUTS = [(c, j) for c in (0.0, 0.05, 0.1) for j in (0.1, 0.3, 1.0)]
R.add("pass_rate_grid", lambda s, d: Q.pass_rates(scored_episodes(s, d), [{"min_confidence": c, "max_jitter_score": j, "min_visible_joints": 3} for c, j in _CUTS]).withColumn("pass_rate", F.round("pass_rate", 6)), f"WITH {QUALITY} " + " UNION ALL ".join(f"SELECT {i}::INTEGER AS grid, round(avg((confidence_mean >= {c} AND jitter_score <= {j} AND visible_joints_mean >= 3 AND total_frames >= 30)::INT), 6) AS pass_rate FROM q" for i, (c, j) in enumerate(_CUTS)))
R.add("quality_distribution", lambda s, d: Q.distribution(scored_episodes(s, d)).select("n", *(r(c) for c in ("mean", "std", "min", "max", "p25", "p50", "p75", "p95", "pass_rate"))), f"WITH {QUALITY} SELECT count(*) AS n, round(avg(quality_score), 6) AS mean, round(stddev_pop(quality_score), 6) AS std, round(min(quality_score), 6) AS min, round(max(quality_score), 6) AS max, round(quantile_cont(quality_score, 0.25), 6) AS p25, round(quantile_cont(quality_score, 0.5), 6) AS p50, round(quantile_cont(quality_score, 0.75), 6) AS p75, round(quantile_cont(quality_score, 0.95), 6) AS p95, round(avg((reasons = '')::INT), 6) AS pass_rate FROM q")
R.add(
    "score_stats",
    lambda s, d: Q.score_stats(scored_episodes(s, d), ["quality_score", "confidence_mean", "jitter_score"]).select("metric", *(r(c) for c in ("mean", "std", "min", "max", "median"))),
    f"""
    WITH {QUALITY}, x AS (UNPIVOT (SELECT quality_score, confidence_mean, jitter_score FROM q) ON quality_score, confidence_mean, jitter_score INTO NAME metric VALUE v)
    SELECT metric, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std, round(min(v), 6) AS min, round(max(v), 6) AS max, round(quantile_cont(v, 0.5), 6) AS median FROM x GROUP BY 1
    """,
)
R.add("failure_histogram", lambda s, d: Q.failure_histogram(scored_episodes(s, d)), f"WITH {QUALITY}, x AS (SELECT unnest(string_split(reasons, '; ')) AS x FROM q WHERE reasons != '') SELECT split_part(x, '=', 1) AS reason, count(*) AS n FROM x GROUP BY 1")

# --- interactions

_PAIRED = """f AS (SELECT max(vec_id) + 1 AS frames FROM embeddings), m AS (SELECT frames, least(frames, (SELECT max(l_orderkey) FROM lineitem) + 1) AS slots FROM f),
o AS (SELECT unnest(range(l_orderkey % slots, frames, slots)) AS place, l_returnflag AS name, 1 - l_tax AS conf, l_partkey % 1800 AS x1, l_suppkey % 1000 AS y1, CAST(trunc(l_partkey % 1800 + 20 + l_quantity) AS INTEGER) AS x2, l_suppkey % 1000 + 20 + l_linenumber * 10 AS y2 FROM lineitem, m),
b AS (SELECT *, row_number() OVER (PARTITION BY place, name ORDER BY x1, y1, x2, y2, conf) - 1 AS k FROM o),
h AS (SELECT vec_id, abs(embedding[1]::DOUBLE) * 3 AS hx, abs(embedding[2]::DOUBLE) * 3 AS hy, embedding[3]::DOUBLE AS hz, sqrt(pow(abs(embedding[13]::DOUBLE) * 3 - abs(embedding[25]::DOUBLE) * 3, 2) + pow(abs(embedding[14]::DOUBLE) * 3 - abs(embedding[26]::DOUBLE) * 3, 2) + pow(embedding[15]::DOUBLE - embedding[27]::DOUBLE, 2)) AS pinch FROM embeddings),
d AS (SELECT CAST(vec_id // 50 AS VARCHAR) AS video_id, vec_id % 50 AS frame_idx, name || '#' || k AS object, 1 - greatest(0.0, least(1.0, (pinch - 0.05) / (0.5 - 0.05))) AS grasp, sqrt(pow(hx * 1920 - (x1 + x2) / 2, 2) + pow(hy * 1080 - (y1 + y2) / 2, 2)) AS distance, sqrt(pow(hx - (x1 + x2) / 2 / 1920, 2) + pow(hy - (y1 + y2) / 2 / 1080, 2) + pow(hz - 1000 / greatest(sqrt(pow(x2 - x1, 2) + pow(y2 - y1, 2)), 1), 2)) AS distance_3d FROM h JOIN b ON b.place = h.vec_id),
i AS (SELECT *, CASE WHEN distance < 20 AND grasp > 0.5 THEN 'grasp' WHEN distance < 30 THEN 'touch' WHEN distance < 100 THEN 'approach' ELSE 'none' END AS kind, CASE WHEN distance < 20 AND grasp > 0.5 THEN grasp WHEN distance < 30 THEN 1 - distance / 30 WHEN distance < 100 THEN 1 - distance / 100 ELSE 0 END AS confidence FROM d)"""


def pairing_tasks(s: SparkSession, d: str) -> int:
    """A pair for each detection: adaptive execution goes by compressed bytes, and these rows are many times as large in a task's memory."""
    return I.tasks_for(hand_detections(s, d).count())


def paired_frames(s: SparkSession, d: str, tasks: int | None = None) -> DataFrame:
    return I.paired(tracked_hands(s, d), I.numbered(hand_detections(s, d), tasks or pairing_tasks(s, d)))


def interaction_events(s: SparkSession, d: str) -> DataFrame:
    tasks = pairing_tasks(s, d)
    return I.sessions(paired_frames(s, d, tasks), 30.0, 0.0, tasks).select("video_id", "hand", "object", "start", "end", "kind", r("peak_confidence"))


R.add("interactions", lambda s, d: paired_frames(s, d).groupBy("video_id", "kind").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("confidence"), 3).alias("confidence"), F.round(F.sum("distance_3d"), 2).alias("distance_3d")), f"WITH {_PAIRED} SELECT video_id, kind, count(*) AS n, round(sum(confidence), 3) AS confidence, round(sum(distance_3d), 2) AS distance_3d FROM i GROUP BY 1, 2")
INTERACTION_EVENTS = f"""WITH {_PAIRED}, n AS (SELECT *, coalesce(sum((kind = 'none')::INT) OVER (PARTITION BY video_id, object ORDER BY frame_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS session, CASE kind WHEN 'grasp' THEN 3 WHEN 'touch' THEN 2 WHEN 'approach' THEN 1 ELSE 0 END AS k FROM i),
e AS (SELECT video_id, object, min(CASE WHEN k > 0 THEN frame_idx END) AS start, max(CASE WHEN k > 0 THEN frame_idx END) AS last, max(CASE WHEN k = 0 THEN frame_idx END) AS closer, max(k) AS k, max(CASE WHEN k > 0 THEN confidence END) AS c FROM n GROUP BY video_id, object, session)
SELECT video_id, 'left' AS hand, object, start, coalesce(closer - 1, last) AS "end", CASE k WHEN 3 THEN 'grasp' WHEN 2 THEN 'touch' ELSE 'approach' END AS kind, round(c, 6) AS peak_confidence FROM e WHERE start IS NOT NULL"""
R.add("interaction_events", interaction_events, INTERACTION_EVENTS)


# --- alignment with the body


def aligned_sql(least: float) -> str:
    """q: poses in the body's own frame, of the last valid frame up to each."""
    unit = lambda k, a, n: ", ".join(f"{a}{c} / nullif({n}, 0) AS {k}{c}" for c in "xyz")
    along = lambda x, y, z, v: f"({x} * {v[0]} + {y} * {v[1]} + {z} * {v[2]}) / (u.s + 1e-8)"
    v = ["(e[3*j+1] - u.ox)", "(e[3*j+2] - u.oy)", "(e[3*j+3] - u.oz)"]
    return f"""{BODY}, c AS (SELECT b.*, least(abs(m.embedding[64]::DOUBLE) * 10, 1.0) AS conf FROM b JOIN embeddings m ON m.vec_id = b.episode_id * 50 + b.t),
a AS (SELECT *, (e[70]+e[73])/2 AS ox, (e[71]+e[74])/2 AS oy, (e[72]+e[75])/2 AS oz, e[37]-e[34] AS ax, e[38]-e[35] AS ay, e[39]-e[36] AS az FROM c),
m AS (SELECT *, (e[34]+e[37])/2 - ox AS mx, (e[35]+e[38])/2 - oy AS my, (e[36]+e[39])/2 - oz AS mz FROM a), n AS (SELECT *, sqrt(ax*ax + ay*ay + az*az) AS wd, sqrt(mx*mx + my*my + mz*mz) AS ht FROM m),
x AS (SELECT *, {unit('x', 'a', 'wd')}, {unit('u', 'm', 'ht')} FROM n), r AS (SELECT *, xy*uz - xz*uy AS rx, xz*ux - xx*uz AS ry, xx*uy - xy*ux AS rz FROM x), l AS (SELECT *, sqrt(rx*rx + ry*ry + rz*rz) AS rn FROM r), z AS (SELECT *, {unit('z', 'r', 'rn')} FROM l),
f AS (SELECT episode_id, t, e, wd, coalesce(conf >= {least} AND wd > 1e-6 AND ht > 1e-6 AND rn > 1e-6, false) AS valid, {{'ox': ox, 'oy': oy, 'oz': oz, 'xx': xx, 'xy': xy, 'xz': xz, 'yx': zy*xz - zz*xy, 'yy': zz*xx - zx*xz, 'yz': zx*xy - zy*xx, 'zx': zx, 'zy': zy, 'zz': zz, 's': wd}} AS fr FROM z),
g AS (SELECT *, last_value(CASE WHEN valid THEN fr END IGNORE NULLS) OVER (PARTITION BY episode_id ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS u FROM f),
al AS (SELECT episode_id, t, valid, wd, CASE WHEN u IS NULL THEN e ELSE flatten(list_transform(range(0, 33), lambda j: [{along('u.xx', 'u.xy', 'u.xz', v)}, {along('u.yx', 'u.yy', 'u.yz', v)}, {along('u.zx', 'u.zy', 'u.zz', v)}])) END AS q FROM g)"""


R.add("body_alignment", lambda s, d: G.alignment_metrics(G.aligned(bodies(s, d))).select("episode_id", *(F.round(c, 5).alias(c) for c in ("valid_ratio", "scale_min", "scale_max", "scale_mean", "scale_std", "coord_max", "coord_mean"))), f"WITH {aligned_sql(0.5)}, w AS (SELECT *, CASE WHEN valid THEN wd END AS s, CASE WHEN valid THEN list_max(list_transform(q, lambda x: abs(x))) END AS mx, CASE WHEN valid THEN list_sum(list_transform(q, lambda x: abs(x))) / 99 END AS me FROM al) SELECT episode_id, round(avg(valid::INT), 5) AS valid_ratio, round(min(s), 5) AS scale_min, round(max(s), 5) AS scale_max, round(avg(s), 5) AS scale_mean, round(stddev_pop(s), 5) AS scale_std, round(max(mx), 5) AS coord_max, round(avg(me), 5) AS coord_mean FROM w GROUP BY 1")
_KEPT = [(15, 13), (16, 14), (13, 11), (14, 12), (11, 0), (12, 0), (23, 0), (24, 0)]
_FEATURES = ", ".join(f"q[{3 * j + k}] - q[{3 * p + k}]" for j, p in _KEPT for k in (1, 2, 3))
R.add("normalization_pipeline", lambda s, d: G.normalization_pipeline(bodies(s, d), G.KEPT, least=0.1).select("episode_id", "t", F.size("features").alias("width"), "valid", F.round(_sum("features"), 3).alias("total"), F.round(F.col("features")[4].cast("double"), 4).alias("fifth")), f"WITH {aligned_sql(0.1)}, v AS (SELECT *, list_transform([{_FEATURES}], lambda x: x::FLOAT::DOUBLE) AS f FROM al) SELECT episode_id, t, len(f)::INTEGER AS width, valid, round(list_sum(f), 3) AS total, round(f[5], 4) AS fifth FROM v")


# --- points and objects

_JOINTS = f"WITH {HANDS}, j AS (SELECT unnest(range(0, 21))::INTEGER AS j), x AS (SELECT episode_id, t, j, e[3*j+1] AS x, e[3*j+2] AS y, e[3*j+3] AS z FROM h, j)"
R.add("normalized_2d", lambda s, d: exploded(hands(s, d).withColumn("pose", G.normalized_2d(F.col("pose"), 640, 480))), f"{_JOINTS} SELECT episode_id, t, j, round((x / 640 * 2 - 1) * (640 / 480), 5) AS x, round(y / 480 * 2 - 1, 5) AS y, round(z, 5) AS z FROM x")
R.add("pixel_to_unit", lambda s, d: exploded(hands(s, d).withColumn("pose", G.pixel_to_unit(F.transform("pose", lambda p: V.times(p, 1000)), 640, 480))), f"{_JOINTS} SELECT episode_id, t, j, round(x * 1000 / 640, 5) AS x, round(y * 1000 / 480, 5) AS y, round(z * 1000, 5) AS z FROM x")
R.add("back_projected", lambda s, d: exploded(hands(s, d).withColumn("pose", G.back_projected(F.col("pose"), F.transform("pose", lambda p: p["z"] + 2), G.intrinsics(640, 480)))), f"{_JOINTS}, f AS (SELECT 640 / (2 * tan(radians(30))) AS f) SELECT episode_id, t, j, round((x - 320) * (z + 2) / f, 5) AS x, round((y - 240) * (z + 2) / f, 5) AS y, round(z + 2, 5) AS z FROM x, f")
R.add("nearest_objects", lambda s, d: hands(s, d).select("episode_id", "t", F.posexplode(E.nearest_objects(F.slice("pose", 1, (F.col("t") % 4 + 2).cast("int")), 3)).alias("i", "v")).withColumn("v", F.round("v", 5)), f"WITH {HANDS}, q AS (SELECT episode_id, t, e, 2 + t % 4 AS n FROM h), o AS (SELECT *, CASE WHEN n > 3 THEN list_transform(list_slice(list_sort(list_transform(range(0, n), lambda j: {{'d': sqrt(e[3*j+1]*e[3*j+1] + e[3*j+2]*e[3*j+2] + e[3*j+3]*e[3*j+3]), 'j': j}})), 1, 3), lambda r: r.j) ELSE range(0, n) END AS k FROM q), i AS (SELECT unnest(range(0, 9))::INTEGER AS i) SELECT episode_id, t, i, round(CASE WHEN i // 3 < len(k) THEN e[3*k[i // 3 + 1] + i % 3 + 1] ELSE 0 END, 5) AS v FROM o, i")
R.add("state_rows", lambda s, d: hands(s, d).select("episode_id", "t", F.posexplode(E.state_tensor(F.col("pose"), F.transform("pose", lambda p: V.times(p, -1.0)))).alias("j", "v")).select("episode_id", "t", "j", F.size("v").alias("width"), F.round(F.col("v")[1], 5).alias("y"), F.round(F.col("v")[5], 5).alias("vz")), f"{_JOINTS} SELECT episode_id, t, j, 6::INTEGER AS width, round(y, 5) AS y, round(-z, 5) AS vz FROM x")
