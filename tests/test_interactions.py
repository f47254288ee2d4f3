"""interactions, interaction_events and the choices among a frame's objects, against brute force over the tables."""

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from motionframe import plans
from motionframe.operators import interactions as I

DIR = "/root/testdata/sf0.001"
QUERIES = plans.queries()


def kinds(spark, d):
    """(video, object, frame, kind, confidence) of each hand with each object of its frame."""
    hands = {r.vec_id: [float(x) for x in r.embedding] for r in spark.read.parquet(f"{d}/embeddings.parquet").collect()}
    lines = spark.read.parquet(f"{d}/lineitem.parquet").collect()
    frames = max(hands) + 1
    slots = min(frames, max(r.l_orderkey for r in lines) + 1)
    objects = defaultdict(list)
    for r in lines:
        x, y = r.l_partkey % 1800, r.l_suppkey % 1000
        o = (ord(r.l_returnflag), r.l_returnflag, 1 - r.l_tax, [x, y, int(x + 20 + r.l_quantity), y + 20 + r.l_linenumber * 10])
        for at in range(r.l_orderkey % slots, frames, slots):
            objects[at].append(o)
    out = []
    for v, e in hands.items():
        p = [(abs(e[3 * j]) * 3, abs(e[3 * j + 1]) * 3, e[3 * j + 2]) for j in range(21)]
        grasp = 1 - max(0.0, min(1.0, (math.dist(p[4], p[8]) - 0.05) / 0.45))
        nth = Counter()
        for _, name, _, (x1, y1, x2, y2) in sorted(objects[v], key=lambda o: (o[3], o[2])):
            k = nth[name]  # among those of its class
            nth[name] += 1
            far = math.hypot(p[0][0] * 1920 - (x1 + x2) / 2, p[0][1] * 1080 - (y1 + y2) / 2)
            kind = "grasp" if far < 20 and grasp > 0.5 else "touch" if far < 30 else "approach" if far < 100 else "none"
            out.append((str(v // 50), f"{name}#{k}", v % 50, kind, {"grasp": grasp, "touch": 1 - far / 30, "approach": 1 - far / 100, "none": 0.0}[kind]))
    return hands, out


def events(rows):
    strength = ["none", "approach", "touch", "grasp"]
    by = defaultdict(list)
    for video, name, frame, kind, conf in sorted(rows, key=lambda r: r[2]):
        by[video, name].append((frame, kind, conf))
    out = []
    for (video, name), seq in by.items():
        run = []
        for frame, kind, conf in [*seq, (None, "none", 0)]:
            if kind != "none":
                run.append((frame, kind, conf))
            elif run:
                last = run[-1][0] if frame is None else frame - 1
                out.append((video, name, run[0][0], last, max((k for _, k, _ in run), key=strength.index), round(max(c for *_, c in run), 4)))
                run = []
    return sorted(out)


@pytest.fixture(scope="module")
def few_orders(spark, tmp_path_factory):
    """More frames than orders."""
    d = str(tmp_path_factory.mktemp("few"))
    spark.read.parquet(f"{DIR}/embeddings.parquet").write.parquet(f"{d}/embeddings.parquet")
    spark.read.parquet(f"{DIR}/lineitem.parquet").where("l_orderkey between 0 and 29").write.parquet(f"{d}/lineitem.parquet")
    return d


@pytest.mark.parametrize("small", [False, True])
def test_every_hand_is_paired(spark, few_orders, small):
    d = few_orders if small else DIR
    hands, want = kinds(spark, d)
    got = {(r.video_id, r.kind): r.n for r in QUERIES["interactions"](spark, d).collect()}
    assert got == Counter((video, kind) for video, _, _, kind, _ in want)
    if not small:
        assert len({(v, f) for v, _, f, _, _ in want}) == len(hands) == 500
    rows = QUERIES["interaction_events"](spark, d).collect()
    mine = sorted((r.video_id, r.object, r.start, r.end, r.kind, r.peak_confidence) for r in rows)
    theirs = events(want)
    assert [x[:5] for x in mine] == [x[:5] for x in theirs] and len(mine) > 10
    assert all(abs(a[5] - b[5]) < 2e-4 for a, b in zip(mine, theirs))


def test_sessions_in_many_tasks(spark):
    """Objects are dealt to as many tasks as are asked for, also if the hand is a constant; adaptive execution does not join them."""
    rows = spark.range(2000).select(F.concat(F.lit("v"), F.col("id") % 2).alias("video_id"), (F.col("id") % 50).alias("frame_idx"), F.lit("left").alias("hand"), F.concat(F.lit("cup#"), F.floor(F.col("id") / 50)).alias("object"), F.when(F.col("id") % 3 == 0, "touch").otherwise("none").alias("kind"), F.lit(0.5).alias("confidence"))
    dealt = I.sessions(rows, 30.0, 0.0, 7)
    assert dealt.rdd.getNumPartitions() == 7
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, I.sessions(rows, 30.0, 0.0).collect()))
    objects = rows.select("video_id", "frame_idx", F.struct(F.lit("cup").alias("class_name"), F.array(*[F.col("frame_idx").cast("int")] * 4).alias("bbox"), F.lit(0.5).alias("confidence")).alias("o"))
    assert I.numbered(objects, 7).rdd.getNumPartitions() == 7
    assert I.tasks_for(0) == 1 and I.tasks_for(36_000_000) == 72
