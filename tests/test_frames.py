"""Frame operators against NumPy on small literal sequences."""

import math

import numpy as np
from pyspark.sql import functions as F

from motionframe.functions import vec as V
from motionframe.operators import augment as A
from motionframe.operators import encoding as E
from motionframe.operators import geometry as G
from motionframe.operators import interactions as I
from motionframe.operators import quality as Q
from motionframe.operators import temporal as T
from motionframe.operators import windows as W

RNG = np.random.default_rng(7)
P = "array<struct<x:double,y:double,z:double>>"


def rows_of(poses, episode=1, fps=30.0):
    return [(episode, t, t / fps, [tuple(map(float, j)) for j in p]) for t, p in enumerate(poses)]


def frames(spark, poses, **kw):
    return spark.createDataFrame(rows_of(poses, **kw), f"episode_id int, t int, ts double, pose {P}")


def poses_of(df, column="pose"):
    return np.array([[tuple(j) for j in r[column]] for r in df.orderBy("t").collect()])


def body(n=20):
    p = RNG.normal(0, 0.3, (n, 33, 3))
    p[:, 23], p[:, 24], p[:, 11], p[:, 12] = (0.1, 0, 0), (-0.1, 0, 0), (0.15, 0.5, 0), (-0.15, 0.5, 0)
    return p


def test_hip_normalized_and_alignment(spark):
    p = body()
    got = poses_of(frames(spark, p).withColumn("pose", G.hip_normalized(F.col("pose"))))
    assert np.allclose(got, p / 0.3)
    df = frames(spark, p).withColumn("conf", F.array_repeat(F.when(F.col("t") == 3, 0.1).otherwise(0.9), 33))
    out = G.aligned(df)
    got = poses_of(out)
    assert np.allclose((got[:, 23] + got[:, 24]) / 2, 0, atol=1e-9)
    assert [r.valid for r in out.orderBy("t").collect()] == [t != 3 for t in range(20)]
    m = G.alignment_metrics(out).first()
    assert m.valid_ratio == 0.95 and math.isclose(m.scale_mean, 0.3)


def test_velocity_energy_jitter(spark):
    p = body(12)
    v = poses_of(W.pose_velocity(frames(spark, p), 30.0), "velocity")
    assert np.allclose(v, np.gradient(p, axis=0) * 30)
    e = [r.energy for r in W.motion_energy(frames(spark, p)).orderBy("t").collect()]
    assert np.allclose(e[:-1], np.linalg.norm(np.diff(p, axis=0), axis=2).mean(axis=1)) and e[-1] is None
    j = [r.jitter for r in W.jitter(frames(spark, p)).orderBy("t").collect()]
    assert np.allclose(j[1:-1], np.linalg.norm(np.diff(p, 2, axis=0), axis=2).mean(axis=1)) and j[0] == j[-1] == 0


def test_smoothing_equals_local_polynomials(spark):
    for n in (2, 3, 7, 11, 15):
        x = RNG.normal(size=n)
        df = spark.createDataFrame([(1, t, float(v)) for t, v in enumerate(x)], "episode_id int, t int, v double")
        got = [r.smoothed for r in W.smoothed(df, "v").orderBy("t").collect()]
        k = min(11, n if n % 2 else n - 1)
        if n < 3:
            want = x
        else:
            want = []
            for i in range(n):
                a = min(max(i - k // 2, 0), n - k)
                want.append(np.polyval(np.polyfit(np.arange(k) - (k - 1) / 2, x[a : a + k], min(3, k - 1)), i - a - (k - 1) / 2))
        assert np.allclose(got, want, atol=1e-8), n


def test_rotations(spark):
    p = body(5)
    got = poses_of(frames(spark, p).withColumn("pose", G.shoulders_to_x(F.col("pose"))))
    a = got[:, 12] - got[:, 11]
    assert np.allclose(np.linalg.norm(got, axis=2), np.linalg.norm(p, axis=2)) and np.allclose(np.abs(a[:, 0]), 0.3)
    yaw, pitch, roll = 0.4, -0.3, 1.1
    ry = np.array([[math.cos(yaw), 0, math.sin(yaw)], [0, 1, 0], [-math.sin(yaw), 0, math.cos(yaw)]])
    rx = np.array([[1, 0, 0], [0, math.cos(pitch), -math.sin(pitch)], [0, math.sin(pitch), math.cos(pitch)]])
    rz = np.array([[math.cos(roll), -math.sin(roll), 0], [math.sin(roll), math.cos(roll), 0], [0, 0, 1]])
    got = poses_of(frames(spark, p).withColumn("pose", A.rotated(F.col("pose"), *(F.lit(math.degrees(x)) for x in (yaw, pitch, roll)))))
    assert np.allclose(got, p @ (rz @ rx @ ry).T)
    q = spark.range(1).select(V.look_rotation(V.vec(F.lit(1.0), F.lit(2.0), F.lit(-1.0))).alias("q"), V.look_rotation(V.zero()).alias("i")).first()
    w, x, y, z = q.q
    assert math.isclose(w * w + x * x + y * y + z * z, 1) and list(q.i) == [1, 0, 0, 0]
    turned = np.array([1 - 2 * (y * y + z * z), 2 * (x * y + w * z), 2 * (x * z - w * y)])
    assert np.allclose(turned, np.array([1, 2, -1]) / math.sqrt(6))


def test_states_and_actions(spark):
    p = body(6)
    df = frames(spark, p).withColumn("left_hand", F.array().cast(P)).withColumn("right_hand", F.array().cast(P)).withColumn("confidence", F.lit(0.5))
    short = df.where("t < 2").withColumn("episode_id", F.lit(2))
    pairs, rejects = E.imitation_pairs(df.unionByName(short), 30.0)
    rows = pairs.orderBy("t").collect()
    assert [len(r.state) for r in rows] == [199] * 6 and [None if r.action is None else len(r.action) for r in rows] == [100] * 5 + [None]
    assert np.allclose(rows[0].action[:99], ((p[1] - p[0]) / 0.3 * 30).ravel(), atol=1e-3) and rows[0].action[99] == 0.5
    assert rejects.collect()[0].episode_id == 2
    ok = E.validated(pairs.join(df.select("episode_id", "t", "ts"), ["episode_id", "t"])).first()
    assert (ok.n_states, ok.n_actions, ok.n_times, ok.errors, ok.valid) == (6, 5, 6, [], True)
    bad = E.validated(pairs.join(df.select("episode_id", "t", F.when(F.col("t") != 2, F.col("ts")).alias("ts")), ["episode_id", "t"]).withColumn("state", F.when(F.col("t") == 1, F.transform("state", lambda v: F.lit(float("nan")).cast("float"))).otherwise(F.col("state")))).first()
    assert bad.errors == ["timestamps", "nan_states"] and not bad.valid
    odd = E.validated(pairs.join(df.select("episode_id", "t", (F.col("ts") + F.when(F.col("t") > 3, 9).otherwise(0)).alias("ts")), ["episode_id", "t"])).first()
    assert "uneven" in odd.notes and odd.valid  # notes don't make it invalid


def test_resample(spark):
    ts = np.sort(RNG.uniform(0, 2, 40))
    v = np.sin(ts)
    df = spark.createDataFrame([(1, float(t), float(x)) for t, x in zip(ts, v)], "episode_id int, ts double, value double")
    rows = T.resample(df, 30.0).orderBy("i").collect()
    grid = ts[0] + np.arange(len(rows)) / 30
    assert np.allclose([r.value for r in rows], np.interp(grid, ts, v)) and all(r.valid != r.interpolated for r in rows)
    low = df.withColumn("c", F.when((F.col("ts") > 0.5) & (F.col("ts") < 1.5), 0.9).otherwise(0.1))
    got = T.resample(low, 30.0, conf="c").orderBy("i").collect()
    k = (ts > 0.5) & (ts < 1.5)
    a, b = ts[k], v[k]
    want = np.interp(grid, a, b)
    want = np.where(grid < a[0], b[0] + (b[1] - b[0]) / (a[1] - a[0]) * (grid - a[0]), want)
    want = np.where(grid > a[-1], b[-1] + (b[-1] - b[-2]) / (a[-1] - a[-2]) * (grid - a[-1]), want)
    assert np.allclose([r.value for r in got], want)
    one = T.resample(df.withColumn("c", F.when(F.col("ts") == float(ts[3]), 0.9).otherwise(0.0)), 30.0, conf="c")
    assert one.agg(F.max(F.abs("value"))).first()[0] == 0


def test_segments(spark):
    e = [0.0] * 3 + [1.0] * 5 + [0.0] + [1.0] * 2 + [0.0] + [1.0] * 9
    df = spark.createDataFrame([(1, t, x) for t, x in enumerate(e)], "episode_id int, t int, energy double")
    got = sorted((r.start, r.end) for r in W.motion_segments(df, threshold=0.5, least=3, most=4).collect())
    assert got == [(3, 7), (12, 16), (16, 20)]
    n = spark.createDataFrame([(1, 25), (2, 9), (3, 3), (4, 10)], "episode_id int, n int")
    seg = {}
    for r in W.fixed_segments(n, 10, 4).collect():
        seg.setdefault(r.episode_id, []).append((r.start, r.end))
    assert sorted(seg[1]) == [(0, 10), (6, 16), (12, 22), (18, 25)] and seg[2] == [(0, 9)] and 3 not in seg and sorted(seg[4]) == [(0, 10)]


def test_quality(spark):
    def rows(good):
        out = []
        for t in range(100 if good else 50):
            a = t / 50
            xy = [(0.5 + 0.1 * math.cos(a), 0.5 + 0.1 * math.sin(a), 0.0, 0.95)] * 33 if good else [(float("nan"),) * 4 if 10 <= t < 15 else (*map(float, RNG.random(3)), 0.4)] * 33
            out.append((1 if good else 2, t, xy, 0.9 if good else 0.4))
        return out

    df = spark.createDataFrame(rows(True) + rows(False), "episode_id int, t int, pose array<struct<x:double,y:double,z:double,visibility:double>>, confidence double")
    a, b = Q.pose_quality(df).orderBy("episode_id").collect()
    assert a.passed and not b.passed and b.nan_ratio == 0.1 and b.max_gap_frames == 5 and a.quality_score > b.quality_score and 0 <= b.quality_score <= 1
    assert {r.split("=")[0] for r in b.failure_reasons} >= {"confidence", "jitter", "visible_joints"}


def test_sessions(spark):
    k = ["approach", "touch", "grasp", "none", "none", "touch", None, "touch"]
    rows = spark.createDataFrame([("v", f, "left", "cup#0", x, 0.1 * f) for f, x in enumerate(k) if x], "video_id string, frame_idx int, hand string, object string, kind string, confidence double")
    got = [(r.start, r.end, r.kind) for r in I.sessions(rows, 30.0, 0.0).orderBy("start").collect()]
    assert got == [(0, 2, "grasp"), (5, 7, "touch")]


def test_augment(spark):
    p = body(40)
    df = frames(spark, p)
    twice = poses_of(df.withColumn("pose", A.mirrored(A.mirrored(F.col("pose")))))
    assert np.allclose(twice, p)
    once = poses_of(df.withColumn("pose", A.mirrored(F.col("pose"))))
    assert np.allclose(once[:, 11] * [-1, 1, 1], p[:, 12])
    s = A.sped(df, F.lit(2.0)).orderBy("t").collect()
    assert len(s) == 20 and math.isclose(s[-1].ts, df.agg(F.max("ts")).first()[0] / 2)
    z = poses_of(A.depth_normalized(df))[:, :, 2]
    depth = p[:, :, 2]
    med = np.median(depth)
    assert np.allclose(z, (depth - med) / (np.median(np.abs(depth - med)) + 1e-8))
    z = poses_of(A.depth_normalized(df, "range"))[:, :, 2]
    assert np.allclose(z, 2 * (depth - depth.min()) / (depth.max() - depth.min()) - 1)
    z = poses_of(A.depth_normalized(df, "clip"))[:, :, 2]
    assert np.allclose(z, np.clip(depth, med - 3 * depth.std(), med + 3 * depth.std()))
    level = df.withColumn("pose", F.transform("pose", lambda j: F.struct(j["x"].alias("x"), j["y"].alias("y"), F.lit(2.0).alias("z"))))
    assert np.allclose(poses_of(A.depth_normalized(level, "range"))[:, :, 2], 2.0)
    a, b = (sorted((r.variant, r.t, str(r.pose)) for r in A.augmented(x).collect()) for x in (df, df.repartition(7)))
    assert a == b and {v for v, _, _ in a} == {"mirror", "scale", "noise", "view", "speed", "offset", "crop"}
