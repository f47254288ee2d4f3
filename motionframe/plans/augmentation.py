"""Augmented frames, one by one, with the SQL that states each variant."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motionframe.operators import augment as A
from motionframe.plans.frames import BODY, bodies
from motionframe.plans.registry import Registry

R = Registry()


def poses(s: SparkSession, d: str) -> DataFrame:
    return bodies(s, d).select("episode_id", "t", "ts", "pose")


def told(df: DataFrame) -> DataFrame:
    """Each frame's pose as three sums in which every joint has a weight of its own, and two numbers of its action."""
    weighted = lambda axis: F.round(F.aggregate(F.transform("pose", lambda j, i: j[axis] * (i + 1)), F.lit(0.0), lambda a, v: a + v), 5).alias(axis)
    act = lambda i: F.round(F.get("action", F.lit(i)), 5).alias(f"a{i}")
    rows = df.select(F.col("source_episode_id").cast("long").alias("episode_id"), "variant", F.col("t").cast("long").alias("t"), F.round("ts", 6).alias("ts"), weighted("x"), weighted("y"), weighted("z"), act(0), act(5))
    return rows


def u(*keys: str) -> str:
    """The uniform number of the keys, SQL expressions."""
    return f"(('0x' || substr(md5(concat_ws('|', '{A.SEED}', {', '.join(keys)})), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE"


def second(*keys: str) -> str:
    return u(*keys).replace(", 1, 13)", ", 14, 13)")


_MIRROR = "[0, 4, 5, 6, 1, 2, 3, 8, 7, 10, 9, 12, 11, 14, 13, 16, 15, 18, 17, 20, 19, 22, 21, 24, 23, 26, 25, 28, 27, 30, 29, 32, 31]"
_NORMAL = lambda axis: f"sqrt(-2 * ln({u('episode_id', 't', 'j', repr(axis))})) * cos({second('episode_id', 't', 'j', repr(axis))} * 2 * pi()) * 0.01"
_SQL = f"""
WITH {BODY},
spans AS (SELECT episode_id, count(*) AS n, min(t / 30) AS t0, max(t / 30) AS t1 FROM b GROUP BY 1),
ranked AS (SELECT episode_id, row_number() OVER (ORDER BY {u("episode_id", "'choose'")}) AS k, count(*) OVER () AS many FROM spans),
chosen AS (SELECT episode_id FROM ranked WHERE k <= floor(many * 0.5)),
c AS (SELECT b.*, t / 30 AS ts, n, t0, t1 FROM b JOIN spans USING (episode_id) WHERE episode_id IN (SELECT episode_id FROM chosen)),
-- a joint a row
j AS (SELECT episode_id, t, ts, unnest(range(33)) AS j, e FROM c),
p AS (SELECT episode_id, t, ts, j, e[3*j+1] AS x, e[3*j+2] AS y, e[3*j+3] AS z, e FROM j),
angles AS (SELECT episode_id, {u("episode_id", "0", "'yaw'")} * 60 - 30 AS yaw, {u("episode_id", "0", "'pitch'")} * 20 - 10 AS pitch, {u("episode_id", "0", "'roll'")} * 10 - 5 AS roll FROM chosen),
turns AS (SELECT episode_id, sin(radians(yaw)) AS sa, cos(radians(yaw)) AS ca, sin(radians(pitch)) AS sb, cos(radians(pitch)) AS cb, sin(radians(roll)) AS sc, cos(radians(roll)) AS cc FROM angles),
-- other times: the frame of the motion that a new frame shows
speeds AS (SELECT episode_id, n, t0, t1, {u("episode_id", "'speed'")} * (1.2::DOUBLE - 0.8::DOUBLE) + 0.8::DOUBLE AS s FROM spans JOIN chosen USING (episode_id)),
grid AS (SELECT episode_id, n, s, (t1 - t0) / s / (floor(n / s) - 1) AS dt, unnest(range(floor(n / s)::BIGINT)) AS i FROM speeds WHERE floor(n / s) >= 2),
near AS (SELECT episode_id, i AS t, i * dt AS ts, least(floor(i * dt * s * 30 + 1e-9), n - 1)::BIGINT AS lo, greatest(0, least(i * dt * s * 30, n - 1) - least(floor(i * dt * s * 30 + 1e-9), n - 1)) AS k, n FROM grid),
sped AS (
  SELECT near.episode_id, near.t, near.ts, list_transform(range(1, 100), lambda i: f.e[i] + (g.e[i] - f.e[i]) * k) AS e
  FROM near JOIN b f ON f.episode_id = near.episode_id AND f.t = lo JOIN b g ON g.episode_id = near.episode_id AND g.t = least(lo + 1, n - 1)),
starts AS (SELECT *, floor({u("episode_id", "'offset'")} * (coalesce(least(floor((n - 1) / nullif(t1 - t0, 0) * 0.5), floor(n / 4)), 0) + 1)) AS k FROM c),
shifted AS (SELECT episode_id, (t - k)::BIGINT AS t, ts - min(ts) OVER (PARTITION BY episode_id) AS ts, e FROM starts WHERE t >= k),
lengths AS (SELECT *, CASE WHEN t1 - t0 > 1 THEN 1 + {u("episode_id", "'crop'")} * (t1 - t0 - 1) ELSE t1 - t0 END AS len FROM c),
cuts AS (SELECT *, t0 + {u("episode_id", "'start'")} * (t1 - t0 - len) AS a FROM lengths),
cropped AS (SELECT episode_id, t, ts - min(ts) OVER (PARTITION BY episode_id) AS ts, e FROM cuts WHERE ts >= a AND ts <= a + len),
timed AS (
  SELECT *, variant AS v, lead(e) OVER (PARTITION BY episode_id, variant ORDER BY t) AS e1
  FROM (SELECT *, 'speed' AS variant FROM sped UNION ALL SELECT *, 'offset' FROM shifted UNION ALL SELECT *, 'crop' FROM cropped)),
-- all variants, a joint a row
each AS (
  SELECT episode_id, 'mirror' AS variant, t, ts, j, -e[3 * {_MIRROR}[j+1] + 1] AS x, e[3 * {_MIRROR}[j+1] + 2] AS y, e[3 * {_MIRROR}[j+1] + 3] AS z, NULL::DOUBLE AS a0, NULL::DOUBLE AS a5 FROM p
  UNION ALL SELECT episode_id, 'scale', t, ts, j, x * k, y * k, z * k, NULL, NULL FROM p JOIN (SELECT episode_id, {u("episode_id", "'scale'")} * (1.1::DOUBLE - 0.9::DOUBLE) + 0.9::DOUBLE AS k FROM chosen) USING (episode_id)
  UNION ALL SELECT episode_id, 'noise', t, ts, j, x + {_NORMAL("x")}, y + {_NORMAL("y")}, z + {_NORMAL("z")}, NULL, NULL FROM p
  UNION ALL SELECT episode_id, 'view', t, ts, j, (cc*ca - sc*sb*sa) * x - sc*cb * y + (cc*sa + sc*sb*ca) * z, (sc*ca + cc*sb*sa) * x + cc*cb * y + (sc*sa - cc*sb*ca) * z, -cb*sa * x + sb * y + cb*ca * z, NULL, NULL FROM p JOIN turns USING (episode_id)
  UNION ALL SELECT episode_id, v, t, ts, j, e[3*j+1], e[3*j+2], e[3*j+3], e1[46] - e[46], e1[51] - e[51] FROM (SELECT *, unnest(range(33)) AS j FROM timed)
  UNION ALL SELECT episode_id, 'original', t, t / 30, j, e[3*j+1], e[3*j+2], e[3*j+3], NULL, NULL FROM (SELECT *, unnest(range(33)) AS j FROM b))
SELECT episode_id, variant, t, round(any_value(ts), 6) AS ts, round(sum(x * (j + 1)), 5) AS x, round(sum(y * (j + 1)), 5) AS y, round(sum(z * (j + 1)), 5) AS z, round(any_value(a0), 5) AS a0, round(any_value(a5), 5) AS a5
FROM each GROUP BY episode_id, variant, t
"""
R.add("augmented_frames", lambda s, d: told(A.augment_batch(poses(s, d), 0.5)), _SQL)
R.add(
    "augment_batch",
    lambda s, d: A.augment_batch(poses(s, d), 0.5).groupBy("variant").agg(F.count(F.lit(1)).alias("frames"), F.count_distinct("episode_id").alias("episodes")),
    f"SELECT variant, count(*) AS frames, count(DISTINCT episode_id) AS episodes FROM ({_SQL}) GROUP BY 1",
)
