"""Files and streams, round trips on small inputs."""

import datetime as dt
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from motionframe import schemas
from motionframe.sources import arrays as A
from motionframe.sources import files as S

T0 = dt.datetime(2024, 1, 1)


def test_csv_and_lists(spark):
    d = tempfile.mkdtemp()
    with open(f"{d}/a.csv", "w") as f:
        f.write("title,Video_URL\nx, http://a \ny,\n")
    assert [r.url for r in S.read_urls_csv(spark, f"{d}/a.csv").collect()] == ["http://a"]
    with open(f"{d}/l.txt", "w") as f:
        f.write("# c\n\nhttps://youtu.be/abcdefghijk\nhttp://e/x/y\n")
    assert [(r.url, r.video_id) for r in S.read_url_list(spark, f"{d}/l.txt").collect()] == [("https://youtu.be/abcdefghijk", "abcdefghijk"), ("http://e/x/y", "y")]
    df = spark.createDataFrame([("a", None, ["t"], T0), ("b", "YouTube", None, None)], "video_id string, platform string, tags array<string>, at timestamp")
    S.export_by(df, f"{d}/out", "platform")
    back = S.read_csv(spark, f"{d}/out")
    assert {(r.video_id, r.platform_part) for r in back.collect()} == {("a", "unknown"), ("b", "youtube")}
    assert {r["at"] for r in S.csv_rows(df).collect()} == {"2024-01-01T00:00:00", ""}


def test_poses_json_and_arrays(spark):
    d = tempfile.mkdtemp()
    lm = [(0.01 * j, 0.02 * j, 0.03 * j, 0.9) for j in range(3)]
    frames = spark.createDataFrame([("v", 30.0, i, i / 30, 0.9, lm, None, None) for i in range(5)], "video_path string, fps double, frame_idx long, timestamp double, pose_confidence double, body_landmarks array<struct<x:double,y:double,z:double,visibility:double>>, left_hand array<struct<x:double,y:double,z:double>>, right_hand array<struct<x:double,y:double,z:double>>")
    S.write_poses(frames, f"{d}/p")
    assert S.read_poses(spark, f"{d}/p").select(*frames.columns).exceptAll(frames).count() == 0 and S.read_poses(spark, f"{d}/p").count() == 5
    S.write_poses(frames.unionByName(frames.withColumn("video_path", F.lit("w"))), f"{d}/lines", lines=True)
    assert S.read_poses(spark, f"{d}/lines", lines=True).count() == 10
    S.write_poses(frames.unionByName(frames.withColumn("video_path", F.lit("w"))), f"{d}/two")
    assert S.read_poses(spark, f"{d}/two").count() == 10
    np.savez(f"{d}/x.npz", keypoints=np.arange(24.0).reshape(2, 12), conf=np.array([0.5, 0.6]))
    rows = A.read_arrays(spark, f"{d}/x.npz").orderBy("t").collect()
    assert [(r.t, len(r.pose), r.width, r.confidence, r.hands) for r in rows] == [(0, 12, 4, 0.5, None), (1, 12, 4, 0.6, None)] and abs(rows[1].ts - 1 / 30) < 1e-12
    inv = S.inventory(spark, d, digests=True).where("endswith(key, 'x.npz')").first()
    assert inv.file_type == "episode_npz" and len(inv.sha256) == 64


def test_parquet_sinks(spark):
    d = tempfile.mkdtemp()
    f = spark.createDataFrame([("e", t, t / 30, [1.0, 2.0], [0.5] if t < 2 else None, 0.9, "p") for t in range(3)], "episode_id string, t int, ts double, state array<double>, action array<double>, confidence double, platform string")
    S.write_frames(f, f"{d}/f", ["platform"])
    assert S.load(spark, f"{d}/f").where("action is null").count() == 1
    r = S.episode_rows(f).first()
    assert (r.duration, r.state_dim, r.action_dim) == (3, 2, 1)
    assert set(S.export(f, f"{d}/x", ["parquet", "orc", "json", "csv"])) == {"parquet", "orc", "json", "csv"} and spark.read.orc(f"{d}/x/orc").count() == 3


def test_array_containers(spark):
    """Aliases, hands, rates, layouts and blocks of rows, against the arrays that were saved."""
    d = tempfile.mkdtemp()
    rng = np.random.default_rng(1)
    pose, left, right = rng.normal(size=(50, 5, 3)), rng.normal(size=(50, 21, 3)), rng.normal(size=(50, 21, 3))
    np.savez_compressed(f"{d}/a.npz", body=pose.astype(np.float32), left_hand=left, right_hand=right, metadata=np.array([25.0, 7.0]), confidences=np.linspace(0, 1, 50))
    np.savez(f"{d}/b.npz", poses=np.asfortranarray(pose[:, :, :2]), left_hand=left[:, 0], right_hand=right[:, 0], metadata=np.array([-1.0]), timestamps=np.arange(50) ** 2)
    np.savez(f"{d}/c.npz", keypoints=pose.reshape(50, 15)[:0], fps=np.array(60))
    np.savez(f"{d}/none.npz", other=np.zeros(3))
    with open(f"{d}/broken.npz", "wb") as f:
        f.write(b"no zip")
    rows = {(r.path.rpartition("/")[2], r.t): r for r in A.read_arrays(spark, d, strict=False).collect()}
    with pytest.raises(Exception, match="no pose array|not a zip"):
        A.read_arrays(spark, d).collect()
    assert len(rows) == 100
    for t in range(50):
        a, b = rows["a.npz", t], rows["b.npz", t]
        np.testing.assert_allclose(a.pose, pose[t].ravel().astype(np.float32))
        np.testing.assert_array_equal(a.hands, np.stack([left, right], axis=1)[t].ravel())
        assert a.ts == t / 25 and a.width == 3 and abs(a.confidence - t / 49) < 1e-12
        np.testing.assert_array_equal(b.pose, pose[t, :, :2].ravel())
        assert b.ts == t * t and b.width == 2 and b.hands is None and b.confidence is None
    errors = {r.path.rpartition("/")[2]: r.error for r in A.array_errors(spark, d).collect()}
    assert set(errors) == {"none.npz", "broken.npz"} and "no pose array" in errors["none.npz"]
    with open(f"{d}/a.npz", "rb") as f:
        blocks = list(A.frames_of(f, rows=7))
    assert [len(b["t"]) for b in blocks] == [7] * 7 + [1]
    np.testing.assert_allclose(np.concatenate([b["pose"] for b in blocks]), pose.reshape(50, -1).astype(np.float32))


def test_large_container_in_bounded_memory():
    """Rows of an array 40 times as large as the block: what is held at once is a block."""
    import tracemalloc

    d = tempfile.mkdtemp()
    np.savez_compressed(f"{d}/large.npz", poses=np.zeros((40 * A.ROWS, 33, 4), np.float32))
    size = 40 * A.ROWS * 33 * 4 * 4
    tracemalloc.start()
    with open(f"{d}/large.npz", "rb") as f:
        n = sum(len(b["t"]) for b in A.frames_of(f))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 40 * A.ROWS and peak < size / 4


def test_written_arrays(spark):
    f = spark.createDataFrame([(e, t, [float(t), 1.0, 2.0, 0.5], 0.25 * t) for e in ("x", "y") for t in (2, 0, 1)], "episode_id string, t int, poses array<double>, confidences double")
    d = f"file://{tempfile.mkdtemp()}/out"
    assert {(r.episode_id, r.n_frames) for r in A.write_arrays(f, d).collect()} == {("x", 3), ("y", 3)}
    back = A.read_arrays(spark, d).selectExpr("regexp_extract(path, '([a-z]+).npz', 1) episode_id", "t", "pose poses", "confidence confidences")
    assert back.exceptAll(f).count() == 0 and back.count() == 6


def test_csv_quoting(spark):
    """Quotes, commas, line breaks and blanks come back as they were; files that other tools wrote are read."""
    import csv

    d = tempfile.mkdtemp()
    texts = ['say "hi", he said', "two\nlines", " blanks ", "\\ back", "plain", None, '"']
    S.export_videos(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string"), f"{d}/a")
    assert {int(r.i): r.t for r in S.read_csv(spark, f"{d}/a").collect()} == dict(enumerate(texts))
    with open(f"{d}/b.csv", "w", newline="") as f:
        csv.writer(f).writerows([["i", "t"], *([i, t or ""] for i, t in enumerate(texts))])
    assert {int(r.i): r.t for r in S.read_csv(spark, f"{d}/b.csv").collect()} == dict(enumerate(texts))


def test_episode_scores(spark):
    f = spark.createDataFrame([("e", t, c) for t, c in enumerate((0.5, 0.75, None))], "episode_id string, t int, confidence double")
    assert tuple(S.episode_scores(f).first()) == ("e", 0, 3, 3, 0.625, 0.625, 0.0)


def test_large_manifests_have_several_documents(spark, tmp_path):
    rows = [(v, T0 + dt.timedelta(seconds=i), f"k{i}", f"s{i % 5}", i, "other", None, None) for v, n in (("a", 40), ("b", 3), (None, 9)) for i in range(n)]
    entries = spark.createDataFrame(rows, "version string, created_at timestamp, key string, sha256 string, size_bytes long, file_type string, storage_class string, compression string")
    path = str(tmp_path / "manifests")
    S.write_manifests(entries, path, 4)
    documents = spark.read.schema(schemas.MANIFEST).json(path).collect()
    assert sum(d.version == "b" for d in documents) == 1
    assert sum(d.version == "a" for d in documents) > 4 and max(len(d.files) for d in documents) <= 12
    ends = {"a": 39, "b": 2, None: 8}
    want = [(v, T0 + dt.timedelta(seconds=ends[v]), *rest) for v, _, *rest in rows]
    assert sorted(map(tuple, S.read_manifests(spark, path).collect()), key=repr) == sorted(want, key=repr)
