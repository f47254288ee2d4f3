import numpy as np
from pyspark.sql import functions as F

from motionframe.operators import encoding as E
from motionframe.operators import geometry as G
from motionframe.operators.normalizer import Model, Normalizer
from motionframe.plans.frames import bodies

DIR = "/root/testdata/sf0.001"


def test_components_like_svd(spark, tmp_path):
    """Fitted, saved, loaded and applied: the same numbers as a singular value decomposition gives."""
    frames = bodies(spark, DIR)
    model = Normalizer(least=0.1, pca=5, precision=None).fit(frames)
    model.save(spark, f"{tmp_path}/model")
    again = Model.load(spark, f"{tmp_path}/model")
    assert again == model and again.config["pca"] == 5
    rows = again.apply(frames).select("episode_id", "t", "features", "pca").collect()
    x = np.array([r.features for r in rows])
    centred = x - x.mean(axis=0)
    _, s, vt = np.linalg.svd(centred, full_matrices=False)
    vt = vt[:5] * np.sign(vt[:5][np.arange(5), np.abs(vt[:5]).argmax(axis=1)])[:, None]
    np.testing.assert_allclose(np.array([r.pca for r in rows]), centred @ vt.T, atol=1e-6)
    np.testing.assert_allclose(again.explained, (s**2 / (s**2).sum())[:5], atol=1e-9)


def test_objects_and_precision(spark):
    frames = bodies(spark, DIR).where("episode_id = 0 and t < 3")
    model = Normalizer(least=0.1, precision="float16", joints=["LEFT_WRIST", "LEFT_HIP"]).fit(frames)
    boxes = spark.createDataFrame([(0, 1, 1, (3.0, 4.0, 4.0, 9.0)), (0, 1, 0, (float("nan"), 1.0, 1.0, 1.0)), (0, 9, 0, (1.0, 1.0, 1.0, 1.0))], "episode_id long, t long, k int, bbox struct<cx:double,cy:double,w:double,h:double>")
    rows = {r.t: r for r in model.apply(frames, boxes).collect()}
    assert [len(rows[t].objects) for t in range(3)] == [0, 2, 0]
    a, b = rows[1].objects
    assert (a.k, a.seen, b.k, b.seen) == (0, False, 1, True) and (b.x, b.y, b.z) == (3.0, 4.0, 6.0)
    exact = {r.t: r.features for r in Normalizer(least=0.1, precision=None, joints=["LEFT_WRIST", "LEFT_HIP"]).fit(frames).apply(frames).collect()}
    assert all(rows[t].features == [float(np.float16(v)) for v in exact[t]] for t in range(3)) and "pca" not in rows[0]


def test_half_precision_like_numpy(spark):
    rng = np.random.default_rng(2)
    v = [0.0, -0.0, 1.0, 2.0**-24, 2.0**-25, 1.5 * 2.0**-25, 6e-5, 65504.0, 65519.0, 65520.0, -7e4, 1 / 3, 2049.0, 2051.0, float("inf"), float("nan"), np.nextafter(8.0, 0), *(rng.choice([-1, 1], 400) * np.exp(rng.uniform(-18, 12, 400)))]
    got = spark.createDataFrame([([float(x) for x in v],)], "v array<double>").select(G.reduced_precision(F.col("v"), "float16")).first()[0]
    np.testing.assert_array_equal(np.array(got), np.array(v).astype(np.float16).astype(np.float64))


def test_two_grippers(spark):
    """[T - 1, 2]: each hand's own state in the next frame; a hand that is not seen is open."""
    hand = lambda d: [(0.0, 0.0, 0.0)] * 8 + [(d, 0.0, 0.0)] + [(0.0, 0.0, 0.0)] * 12
    pose = [(float(j), 0.0, 0.0) for j in range(33)]
    rows = [("e", t, pose, hand(d), None if t == 3 else hand(0.06 - d)) for t, d in enumerate((0.04, 0.06, 0.005, 0.02))]
    df = spark.createDataFrame(rows, f"e string, t int, pose array<{G_POINT}>, left_hand array<{G_POINT}>, right_hand array<{G_POINT}>")
    got = {r.t: r.action for r in E.actions(df, ["grippers"], "e").collect()}
    assert got == {0: [0.0, 1.0], 1: [1.0, 0.0], 2: [1.0, 0.0], 3: None}


G_POINT = "struct<x:double,y:double,z:double>"
