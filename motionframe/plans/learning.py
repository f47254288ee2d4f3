"""Normalised features with objects, and actions with rotations and both grippers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motionframe.functions import vec as V
from motionframe.operators import encoding as E
from motionframe.operators import geometry as G
from motionframe.operators.normalizer import Normalizer
from motionframe.plans.frames import bodies
from motionframe.plans.registry import Registry
from motionframe.plans.reports import aligned_sql
from motionframe.session import table

R = Registry()


def rounded(c, digits: int = 5):
    return F.round(c, digits)


def normalized_objects(s: SparkSession, d: str) -> DataFrame:
    """Two objects a frame, the second of them seen in every third frame; none in every seventh frame."""
    e = table(s, d, "embeddings")
    v = lambda i: F.col("embedding")[i].cast("double")
    seen = F.when(F.col("vec_id") % 3 == 0, v(6)).otherwise(F.lit(float("nan")))
    both = F.array(F.struct(F.lit(0).alias("k"), V.vec(v(0), v(1), v(2)).alias("pos")), F.struct(F.lit(1).alias("k"), V.vec(seen, v(7), v(8)).alias("pos")))
    objects = e.where("vec_id % 7 != 0").select(F.floor(F.col("vec_id") / 50).alias("episode_id"), (F.col("vec_id") % 50).alias("t"), F.inline(both))
    rows = Normalizer(least=0.1).fit(bodies(s, d)).apply(bodies(s, d), objects)
    o = lambda i, x: F.get("objects", F.lit(i))[x]
    total = F.aggregate("features", F.lit(0.0), lambda a, x: a + x.cast("double"))
    second = F.when(o(1, "seen"), rounded(o(1, "x")))
    return rows.select("episode_id", "t", "valid", rounded(total, 3).alias("total"), rounded(F.col("eef")[1]["y"]).alias("right_y"), F.size("objects").alias("n_objects"), rounded(o(0, "x")).alias("x0"), rounded(o(0, "z")).alias("z0"), second.alias("x1"))


_SELECTED = ", ".join(f"q[{3 * G.BODY.index(n) + k}]" for n in G.KEPT for k in (1, 2, 3))
R.add(
    "normalized_objects",
    normalized_objects,
    f"""
    WITH {aligned_sql(0.1)},
    v AS (SELECT al.*, episode_id * 50 + t AS vec_id, list_sum(list_transform([{_SELECTED}], lambda x: x::FLOAT::DOUBLE)) AS total FROM al)
    SELECT episode_id, t, valid, round(total, 3) AS total, round(q[50], 5) AS right_y, CASE WHEN vec_id % 7 != 0 THEN 2 ELSE 0 END::INTEGER AS n_objects,
      CASE WHEN vec_id % 7 != 0 THEN round(embedding[1]::DOUBLE - q[46], 5) END AS x0, CASE WHEN vec_id % 7 != 0 THEN round(embedding[3]::DOUBLE - q[48], 5) END AS z0,
      CASE WHEN vec_id % 7 != 0 AND vec_id % 3 = 0 THEN round(embedding[7]::DOUBLE - q[46], 5) END AS x1
    FROM v JOIN embeddings USING (vec_id)
    """,
)


def action_parts(s: SparkSession, d: str) -> DataFrame:
    """Ways of the wrists, rotations (a unit quaternion a frame) as quaternions and as axis times angle, and both grippers."""
    v = lambda i: F.col("embedding")[i].cast("double")
    q = F.array(v(0), v(1), v(2), v(3))
    size = F.sqrt(F.aggregate(q, F.lit(0.0), lambda a, x: a + x * x))
    rotation = table(s, d, "embeddings").select(F.floor(F.col("vec_id") / 50).alias("episode_id"), (F.col("vec_id") % 50).alias("t"), F.transform(q, lambda x: x / size).alias("rotation"))
    far = F.transform("left_hand", lambda p: V.times(p, 0.2))
    rows = bodies(s, d).withColumn("right_hand", F.when(F.col("t") % 5 != 0, F.col("right_hand"))).withColumn("left_hand", far).join(rotation, ["episode_id", "t"])
    out = E.actions(rows, ["eef", "quat", "axis_angle", "grippers"])
    a = lambda i: F.col("action")[i]
    return out.select("episode_id", "t", F.size("action").alias("width"), *(rounded(a(i)).alias(f"a{i}") for i in (0, 5, 6, 7, 8, 9, 10, 11, 12)), a(13).alias("left"), a(14).alias("right"))


_PINCH = "sqrt(pow(h[13] - h[25], 2) + pow(h[14] - h[26], 2) + pow(h[15] - h[27], 2))"
R.add(
    "action_parts",
    action_parts,
    f"""
    WITH n AS (SELECT vec_id // 50 AS episode_id, vec_id % 50 AS t, list_transform(embedding, lambda x: x::DOUBLE) AS h FROM embeddings),
    s AS (SELECT *, sqrt(h[1]*h[1] + h[2]*h[2] + h[3]*h[3] + h[4]*h[4]) AS m, list_transform(range(0, 99), lambda i: h[i % 63 + 1]) AS e FROM n),
    u AS (SELECT *, h[1] / m AS w, -h[2] / m AS x, -h[3] / m AS y, -h[4] / m AS z, (0.2::DOUBLE * {_PINCH} < 0.05)::INT::DOUBLE AS lft, (t % 5 != 0 AND {_PINCH} < 0.05)::INT::DOUBLE AS rgt FROM s),
    p AS (SELECT *, lead(e) OVER k AS f, lead(w) OVER k AS w1, -lead(x) OVER k AS x1, -lead(y) OVER k AS y1, -lead(z) OVER k AS z1, lead(lft) OVER k AS l1, lead(rgt) OVER k AS r1 FROM u WINDOW k AS (PARTITION BY episode_id ORDER BY t)),
    q AS (SELECT *, w1*w - x1*x - y1*y - z1*z AS qw, w1*x + x1*w + y1*z - z1*y AS qx, w1*y - x1*z + y1*w + z1*x AS qy, w1*z + x1*y - y1*x + z1*w AS qz FROM p),
    r AS (SELECT *, greatest(-1.0, least(1.0, qw)) AS c FROM q),
    g AS (SELECT *, CASE WHEN sqrt(greatest(0.0, 1 - c*c)) < 1e-6 THEN 0.0 ELSE acos(c) * 2 / sqrt(greatest(0.0, 1 - c*c)) END AS k FROM r)
    SELECT episode_id, t, CASE WHEN f IS NOT NULL THEN 15 END::INTEGER AS width, round(f[46] - e[46], 5) AS a0, round(f[51] - e[51], 5) AS a5, round(qw, 5) AS a6, round(qx, 5) AS a7, round(qy, 5) AS a8, round(qz, 5) AS a9,
      round(CASE WHEN f IS NOT NULL THEN qx * k END, 5) AS a10, round(CASE WHEN f IS NOT NULL THEN qy * k END, 5) AS a11, round(CASE WHEN f IS NOT NULL THEN qz * k END, 5) AS a12, l1 AS "left", r1 AS "right"
    FROM g
    """,
)
