"""Streams with state, over several micro-batches, and incremental runs."""

import datetime as dt
import random
import tempfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from motionframe.streaming import incremental as I
from motionframe.streaming import operators as O
from motionframe.streaming import stateful as S

T0 = dt.datetime(2024, 1, 1)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def stream(spark, parts, schema):
    """Each part is a micro-batch."""
    d = tempfile.mkdtemp()
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(d)
    return O.file_stream(spark, d, schema)


def run(df, mode="append"):
    """(rows, rows in the state store at the end)"""
    spark, d = df.sparkSession, tempfile.mkdtemp()

    def write(batch, epoch):
        batch.withColumn("epoch", F.lit(epoch)).write.mode("append").parquet(f"{d}/out")

    with S.rocksdb(spark):
        q = df.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{d}/c").trigger(availableNow=True).start()
    q.awaitTermination(300)
    assert q.exception() is None
    return spark.read.parquet(f"{d}/out").collect(), sum(o["numRowsTotal"] for o in q.lastProgress["stateOperators"])


COMMANDS = "rule string, ts timestamp, action string, fingerprint string, value double, seconds double"


def test_alerts_over_batches(spark):
    """Silence, fire, resolve, force and expiry, cut into micro-batches, as an alert manager would do it event by event."""
    rng = random.Random(2)
    rows = []
    for i in range(400):
        action = rng.choice(["fire"] * 8 + ["force", "silence", "unsilence", "resolve", "resolve"])
        rows.append((rng.choice(["a", "b", None]), at(7 * i), action, rng.choice("xyz"), float(i), rng.choice([None, 60.0, 300.0]) if action == "silence" else None))
    cooldown, forget = 100, 500
    silent, ends, last, active, want = {}, {}, {}, {}, []
    for t in range(0, 7 * 400 + 2000):
        for r in ("a", "b", None):
            if t in ends.get(r, ()):
                silent[r] = False
            for fp in [f for f, (when, _) in active.get(r, {}).items() if when + forget == t]:
                when, v = active[r].pop(fp)
                want.append((r, at(t), "expired", fp, v, at(when)))
        if t % 7 or t >= 7 * 400:
            continue
        r, ts, action, fp, v, seconds = rows[t // 7]
        if action == "silence":
            silent[r] = True
            if seconds:
                ends.setdefault(r, set()).add(t + int(seconds))
        elif action == "unsilence":
            silent[r] = False
        elif action == "resolve":
            if fp in active.get(r, {}):
                when, was = active[r].pop(fp)
                want.append((r, ts, "resolved", fp, was, at(when)))
        elif not silent.get(r) and (action == "force" or r not in last or t - last[r] >= cooldown):
            last[r] = t
            active.setdefault(r, {})[fp] = (t, v)
            want.append((r, ts, "firing", fp, v, ts))
    beat = [("beat", at(7 * 400 + 5000), "unsilence", None, None, None)]  # lets the timers run out
    got, held = run(S.alert_states(stream(spark, [rows[:150], rows[150:160], rows[160:], beat], COMMANDS), cooldown, "1 second", forget))
    assert sorted((tuple(r)[:6] for r in got), key=repr) == sorted(want, key=repr)
    assert held <= 8  # nothing but silences that nothing ends


class Held:
    """State and timers of one key, in memory, with a count of what is asked of them."""

    def __init__(self):
        self.timers, self.calls, self.states = set(), 0, {}

    def registerTimer(self, ms):
        self.timers.add(ms)
        self.calls += 1

    def deleteTimer(self, ms):
        self.timers.discard(ms)
        self.calls += 1

    def getValueState(self, name, schema):
        return self.getMapState(name, schema, schema)

    getListState = getValueState

    def getMapState(self, name, key, value):
        held, said = self.states.setdefault(name, {}), self

        class State:
            def __getattribute__(_, call):
                said.calls += 1
                one = lambda: list(held.items())
                if call == "put":
                    return lambda rows: held.update({(): rows})
                return {"exists": lambda: bool(held), "get": lambda: held[()], "update": lambda v: held.update({(): v}), "clear": held.clear, "keys": lambda: iter(list(held)), "iterator": lambda: iter(one()),
                        "containsKey": lambda k: k in held, "getValue": held.get, "updateValue": lambda k, v: held.update({k: v}), "removeKey": lambda k: held.pop(k, None)}[call]

        return State()


class Now:
    def __init__(self, ms):
        self.getCurrentWatermarkInMs = self.getExpiryTimeInMs = lambda: ms


def test_alerts_ask_little_of_their_state():
    """What a batch of many alerts and silences costs does not grow with the timers that stand and the silences that ended."""

    def cost(n):
        rows = [(at(100 * i), a, f"f{i % 7}", 1.0, s) for i in range(n) for a, s in (("silence", 30.0), ("fire", None)) if a == "fire" or i % 3 == 0]
        pdf = pd.DataFrame(rows, columns=["ts", "action", "fingerprint", "value", "seconds"])
        pdf["ts"] = pdf["ts"].astype("datetime64[ns]")
        held, alerts = Held(), S.Alerts(60.0, 1e9)
        alerts.init(held)
        out = pd.concat(alerts.handleInputRows(("r",), iter([pdf[:100], pdf[100:]]), None))
        assert len(out) == n - len(range(0, n, 3)) and len(held.timers) == 1
        held.timers.clear()
        pd.concat(alerts.handleExpiredTimer(("r",), Now(int(at(100 * n + 1000).timestamp() * 1000)), Now(0)))
        assert not held.states["ends"] and not held.states["last"] and len(held.states["active"]) == 7 and len(held.timers) == 1
        return held.calls

    assert cost(3000) == cost(300) < 100


def test_alert_life_cycle(spark):
    say = lambda s, action, fp="f", seconds=None: ("r", at(s), action, fp, 1.0, seconds)
    rows = [say(0, "fire"), say(10, "fire"), say(20, "force", "g"), say(30, "resolve"), say(31, "resolve"), say(40, "silence", None, 100.0), say(130, "force"), say(140, "fire", "h"), say(150, "resolve", "g")]
    got, _ = run(S.alert_states(stream(spark, [rows[:4], rows[4:]], COMMANDS), 60.0))
    assert sorted((r.ts, r.state, r.fingerprint) for r in got) == [(at(0), "firing", "f"), (at(20), "firing", "g"), (at(30), "resolved", "f"), (at(140), "firing", "h"), (at(150), "resolved", "g")]


def test_jobs_are_forgotten(spark):
    kind = "job_key string, status string, ts timestamp"
    parts = [
        [("j", "failed", at(0)), ("j", "running", at(5)), ("k", "failed", at(1)), (None, "failed", at(2))],
        [("j", "completed", at(9)), ("k", "failed", at(4)), ("k", "running", at(3))],
        [("z", "running", at(5000))],
        [("j", "failed", at(5001)), ("k", "running", at(5002)), ("x", "failed", None)],
    ]
    got, held = run(S.job_states(stream(spark, parts, kind), "10 seconds", keep=100.0, idle=100_000.0), "update")
    assert sorted((tuple(r)[:4] for r in got if r.epoch < 2), key=repr) == sorted([("j", "running", 1, False), ("k", "failed", 1, False), (None, "failed", 1, False), ("j", "completed", 1, True), ("k", "failed", 2, False)], key=repr)
    after = {r.job_key: (r.status, r.retry_count) for r in got if r.updated_at and r.updated_at >= at(5001)}
    assert after == {"j": ("failed", 1), "k": ("running", 2)}  # j was finished and forgotten, k was not
    many = [[(f"d{i}_{b}", "completed", at(1000 * b + i % 10)) for i in range(200)] for b in range(5)] + [[("end", "completed", at(9000))]]
    _, held = run(S.job_states(stream(spark, many, kind), "10 seconds", keep=100.0), "update")
    assert held <= 30  # of 1,000 jobs


def test_sessions_close(spark):
    kind = "video_id string, hand string, object string, frame_idx long, ts timestamp, kind string, confidence double"
    row = lambda f, k, c=0.5, o="cup": ("v", "left", o, f, at(f / 30), k, c)
    parts = [
        [row(0, "touch"), row(1, "grasp", 0.9), row(0, "approach", 0.1, "pen")],
        [row(2, "none"), row(3, "touch"), row(4, "none"), row(5, "none"), row(6, "approach", 0.2)],
        [row(30 * 3600, "none", 0.0, "far")],
    ]
    got, held = run(S.interaction_sessions(stream(spark, parts, kind), 30.0, 0.0))
    assert sorted((r.object, r.start, r.end, r.kind, r.peak_confidence) for r in got) == [("cup", 0, 1, "grasp", 0.9), ("cup", 3, 3, "touch", 0.5), ("cup", 6, 6, "approach", 0.2), ("pen", 0, 0, "approach", 0.1)]
    assert held == 0
    got, _ = run(S.interaction_sessions(stream(spark, parts, kind), 30.0, 0.05))  # frames / fps
    assert sorted((r.object, r.start) for r in got) == [("cup", 0)]


def test_sessions_ask_little_of_their_state():
    """A group of objects takes one read and one write, however many there are, and one timer."""

    def cost(n):
        rows = [(f"cup#{i}", f, at(f / 30), "touch" if f < 3 or i % 2 else "none", 0.5) for i in range(n) for f in range(5)]
        pdf = pd.DataFrame(rows, columns=["object", "frame_idx", "ts", "kind", "confidence"])
        pdf["ts"] = pdf["ts"].astype("datetime64[ns]")
        held, sessions = Held(), S.Sessions(30.0, 0.0, 60.0)
        sessions.init(held)
        out = pd.concat(sessions.handleInputRows(("v", "left", 0), iter([pdf[::2], pdf[1::2]]), None))
        assert sorted(out["object"]) == sorted(f"cup#{i}" for i in range(0, n, 2)) and set(out["end"]) == {2} and len(held.timers) == 1
        held.timers.clear()
        late = pd.concat(sessions.handleExpiredTimer(("v", "left", 0), Now(int(at(100).timestamp() * 1000)), Now(0)))
        assert len(late) == n // 2 and set(late["end"]) == {4} and not held.states["sessions"] and not held.timers
        return held.calls

    assert cost(2000) == cost(20) < 40


def target(spark):
    d = tempfile.mkdtemp()
    return d, lambda: spark.read.parquet(f"{d}/log").orderBy("commit").collect()


def test_incremental_reads_only_what_may_be_there(spark):
    d, log = target(spark)
    rows = lambda ids: spark.createDataFrame([(i, -i if i is not None else 0) for i in ids], "k long, v long")
    I.append_new(rows([*range(1000), None, None, 5, 5]), d, "k", "c1")
    I.append_new(rows(range(5000, 5300)), d, "k", "c2")
    I.append_new(rows([7, 7, None, 9000]), d, "k", "c3")
    I.append_new(rows([7, 8000]), d, "k", "c3")  # the same commit again
    one, two, three = log()
    assert (one.rows, one.new, one.buckets_read) == (1001, 1001, [])
    assert two.new == 300 and len(two.buckets_read) < 5  # hash collisions of the filter alone
    assert three.rows == 3 and three.new == 1 and 1 <= len(three.buckets_read) <= 3
    assert sorted(r.k for r in I.committed(spark, d).where("k is not null").collect()) == [*range(1000), *range(5000, 5300), 9000]
    assert I.committed(spark, d).where("k is null").count() == 1


def test_incremental_after_a_failure(spark):
    """What a commit without its log row left is not seen, and is replaced."""
    d, log = target(spark)
    batch = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 1, "z")], "k string, t int, w string")
    I.append_new(batch, d, "k", "c1", order=["t"])
    spark.createDataFrame([("c", 1, "lost", 0)], "k string, t int, w string, bucket int").write.partitionBy("bucket").parquet(f"{d}/data/commit=c2")
    assert {(r.k, r.w) for r in I.committed(spark, d).collect()} == {("a", "y"), ("b", "z")}
    I.append_new(spark.createDataFrame([("c", 1, "kept"), ("a", 0, "late")], batch.schema), d, "k", "c2", order=["t"])
    assert {(r.k, r.w) for r in I.committed(spark, d).collect()} == {("a", "y"), ("b", "z"), ("c", "kept")}
    I.append_new(batch.limit(0), d, "k", "c3")
    assert log()[-1].rows == 0 and I.committed(spark, d).count() == 3


def test_full_filters_are_still_exact(spark):
    d, log = target(spark)
    for c in range(3):
        I.append_new(spark.range(c * 300, c * 300 + 400).toDF("k"), d, "k", f"c{c}", buckets=4, bits=64)
    assert sorted(r.k for r in I.committed(spark, d).collect()) == list(range(1000))
    assert len(log()[-1].buckets_read) == 4


def test_incremental_streams(spark):
    d, log = target(spark)
    s = stream(spark, [[("a", 1), ("b", 2)], [("a", 3), ("c", 4), (None, 5)]], "k string, v int")
    for c in ("one", "two"):
        I.incremental(s, d, "k", f"{d}-{c}").awaitTermination(300)
    assert sorted((r.k or "", r.v) for r in I.committed(spark, d).collect()) == [("", 5), ("a", 1), ("b", 2), ("c", 4)]
    assert [r.new for r in log()].count(0) == 2


def test_provider_is_set_back(spark):
    before = spark.conf.get(S.PROVIDER)
    with pytest.raises(ValueError), S.rocksdb(spark):
        raise ValueError
    assert spark.conf.get(S.PROVIDER) == before
