"""Cooldown, silences, forced alerts and running values, against plain Python."""

import datetime as dt
import random

from pyspark.sql import functions as F

from motionframe.operators import alerts as A
from motionframe.operators.ranges import carried, running_sums

T0 = dt.datetime(2024, 1, 1)
KIND = "rule string, ts timestamp, id long, forced boolean"


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def brute(alerts, seconds, silences=()):
    """Event by event, as an alert manager does it."""
    said = [(a[1], 2, a[2], a) for a in alerts if a[1] is not None] + [(s[1], 1, 0, (s[0], True)) for s in silences] + [(s[2], 0, 0, (s[0], False)) for s in silences if s[2] is not None]
    silent, last, out = set(), {}, []
    for t, kind, _, x in sorted(said, key=lambda e: (e[0], e[1], e[2])):
        if kind < 2:
            (silent.add if x[1] else silent.discard)(x[0])
        elif x[0] not in silent and (x[3] or x[0] not in last or (t - last[x[0]]).total_seconds() >= seconds):
            last[x[0]] = t
            out.append(x[2])
    return sorted(out)


def ids(df):
    return sorted(r.id for r in df.collect())


def test_fired_like_event_by_event(spark):
    """Many ties, one rule with nearly all rows, null rules and times, gaps from nothing to longer than the cooldown."""
    rng = random.Random(3)
    for seconds, span in ((30, 2000), (1, 300), (500, 400), (0, 100)):
        rows = [(rng.choice(["hot"] * 8 + ["a", None]), at(rng.randrange(span)), i, rng.choice([None, False, False, False, i % 31 == 0])) for i in range(900)]
        rows.append(("a", None, 900, True))
        df = spark.createDataFrame(rows, KIND).repartition(6)
        assert ids(A.fired(df, seconds, tie=["id"], force=F.col("forced"))) == brute(rows, seconds)
        quiet = [(rng.choice(["hot", "a", None]), at(t), at(t + rng.randrange(span // 4))) for t in range(0, span, max(1, span // 9))] + [("a", at(span - 5), None)]
        s = spark.createDataFrame(quiet, "rule string, at timestamp, till timestamp")
        assert ids(A.fired(df, seconds, tie=["id"], force=F.col("forced"), silences=s)) == brute(rows, seconds, quiet)


def test_long_chain_and_edges(spark):
    rows = [("r", at(10 * i), i, False) for i in range(700)]
    df = spark.createDataFrame(rows, KIND)
    assert ids(A.fired(df, 10.0)) == list(range(700))  # exactly the cooldown later fires
    assert ids(A.fired(df, 10.000001)) == list(range(0, 700, 2))
    assert A.fired(df.limit(0), 5.0).count() == 0
    assert A.fired(df, 5.0).columns == df.columns


def test_silence_ends_with_the_first_end(spark):
    df = spark.createDataFrame([("r", at(s), s, False) for s in (0, 10, 20, 30, 40)], KIND)
    s = spark.createDataFrame([("r", at(10), at(20)), ("r", at(15), at(100)), ("r", at(30), at(40))], "rule string, at timestamp, till timestamp")
    assert ids(A.unsilenced(df, s)) == [0, 20, 40]


def test_active(spark):
    shown = spark.createDataFrame([("a", at(1), 1), ("a", at(5), 2), ("b", at(1), 3), ("c", at(9), 4)], "fingerprint string, ts timestamp, n int")
    ends = spark.createDataFrame([("a", at(3)), ("b", at(2)), ("b", at(8)), ("c", at(8)), ("z", at(1))], "fingerprint string, at timestamp")
    got = {r.fingerprint: (r.n, r.state, r.resolved_at) for r in A.active(shown, ends).collect()}
    assert got == {"a": (2, "firing", None), "b": (3, "resolved", at(2)), "c": (4, "firing", None)}


def test_running_values(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["hot"] * 9 + ["a", None]), i, rng.choice([None, i, 3])) for i in range(3000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so that groups go over several ranges
    try:
        df = spark.createDataFrame(rows, "k string, i int, v int").repartition(5)
        sums = {r.i: r.s for r in running_sums(df, ["k"], ["i"], s=F.col("v")).collect()}
        lasts = {r.i: r.l for r in carried(df, ["k"], [F.desc("i")], l=F.col("v")).collect()}
        whole = {r.i: r.n for r in running_sums(df, [], ["i"], n=F.lit(1)).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    total, seen = {}, {}
    for k, i, v in rows:
        total[k] = total.get(k) if v is None else (total.get(k) or 0) + v
        assert sums[i] == total[k] and whole[i] == i + 1
    for k, i, v in reversed(rows):
        seen[k] = seen.get(k) if v is None else v
        assert lasts[i] == seen[k]
