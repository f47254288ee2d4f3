"""Stateful streams with event-time timers: alerts, job states, interaction sessions. State that is over is dropped.

Each takes a stream with a watermark (`late`) on its time column. Rows of a key within a micro-batch are taken in order of
time; what a timer does happens when the watermark passes its time, or before the key's first later row. A key's rows
of one micro-batch are in one task's memory, which the trigger's size bounds.

The state store is RocksDB's, which these operators need: start them within `rocksdb`.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def rocksdb(spark: SparkSession):
    """Queries started in here keep their state in RocksDB."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


def micros_of(t: pd.Timestamp) -> int:
    return int(t.value // 1000)


def time_of(us: int) -> pd.Timestamp:
    return pd.Timestamp(us, unit="us")


_DTYPES = {"string": object, "bigint": "int64", "double": float, "boolean": bool, "timestamp": "datetime64[ns]"}


def frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    """Rows as a frame whose columns have plain numpy types, also without rows."""
    fields = [f.split() for f in schema.split(", ")]
    return pd.DataFrame({name: pd.Series([r[i] for r in rows], dtype=_DTYPES[kind]) for i, (name, kind) in enumerate(fields)})


class _Timed(StatefulProcessor):
    """A processor whose timers stand at whole milliseconds, the first at or after a time."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle

    def wake(self, us: int) -> int:
        ms = -(-us // 1000)
        self.handle.registerTimer(ms)
        return ms

    @staticmethod
    def together(rows: Iterator[pd.DataFrame], columns: list[str]) -> list[tuple]:
        """The rows of a micro-batch, one tuple each, in order of ts and then of the others."""
        pdf = pd.concat(list(rows))
        pdf = pdf[pdf["ts"].notna()].sort_values("ts", kind="stable")
        return list(zip(pdf["ts"].map(micros_of), *(pdf[c] for c in columns)))

    def close(self) -> None:
        pass


# --- alerts

#: In what order commands of one time are taken.
RANK = {"unsilence": 0, "silence": 1, "fire": 2, "force": 2, "resolve": 3}
ACTIONS = list(RANK)
ALERT_OUT = "rule string, ts timestamp, state string, fingerprint string, value double, fired_at timestamp"


class Alerts(_Timed):
    """One rule: when it last fired, whether it is silenced and until when, and its active alerts by fingerprint.

    One timer stands, at or before the first time at which something is over; what it finds over by the watermark goes.
    """

    def __init__(self, cooldown: float, forget: float):
        self.cooldown, self.forget = int(cooldown * 1e6), int(forget * 1e6)

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.last = handle.getValueState("last", "us bigint")
        self.silent = handle.getValueState("silent", "since bigint")
        self.ends = handle.getMapState("ends", "us bigint", "n int")
        self.active = handle.getMapState("active", "fingerprint string", "us bigint, value double")
        self.due = handle.getValueState("due", "ms bigint")

    @staticmethod
    def commands(rows: Iterator[pd.DataFrame]) -> tuple[list, list[np.ndarray]]:
        """The fingerprints, and the columns us, action, fingerprint's number, value and seconds in the order in which commands are taken."""
        numbers, parts = {}, []
        for pdf in rows:
            pdf = pdf[pdf["ts"].notna()]
            said, names = pd.factorize(pdf["action"])
            shown, fps = pd.factorize(pdf["fingerprint"], use_na_sentinel=False)
            fp = np.array([numbers.setdefault(None if pd.isna(f) else f, len(numbers)) for f in fps], np.int32)[shown]
            action = np.array([ACTIONS.index(n) for n in names], np.int8)[said]
            parts.append((pdf["ts"].to_numpy("datetime64[us]").astype(np.int64), action, fp, pdf["value"].to_numpy(float), pdf["seconds"].to_numpy(float)))
        us, action, fp, value, seconds = (np.concatenate(c) for c in zip(*parts))
        fps = list(numbers)
        places = {f: i for i, f in enumerate(sorted({f or "" for f in fps}))}
        order = np.lexsort((np.array([places[f or ""] for f in fps], np.int32)[fp], np.array([RANK[a] for a in ACTIONS])[action], us))
        return fps, [c[order] for c in (us, action, fp, value, seconds)]

    def handleInputRows(self, key, rows, timerValues):
        fps, (us, action, fp, value, seconds) = self.commands(rows)
        if not len(us):  # rows without a time alone
            return
        newest = int(us[-1])
        begun = np.flatnonzero((action == ACTIONS.index("silence")) & ~np.isnan(seconds))  # NaN: it is ended by others
        ends = {int(e) for e in us[begun] + (seconds[begun] * 1e6).astype(np.int64)}
        known = {k[0] for k in self.ends.keys()}
        over = sorted(e for e in known | ends if e <= newest)
        last = self.last.get()[0] if self.last.exists() else None
        silent, out, was, now = self.silent.exists(), [], {}, {}

        def still_active(f, at):
            """(when it fired, value) of an active alert; one whose time was over before that time expires."""
            if f not in now:
                now[f] = was[f] = self.active.getValue((f,)) if self.active.containsKey((f,)) else None
            shown = now[f]
            if shown is None or shown[0] + self.forget > at:
                return shown
            now[f] = None
            out.append((time_of(shown[0] + self.forget), "expired", f, shown[1], time_of(shown[0])))
            return None

        def fire(i):
            nonlocal last
            last, f, v = int(us[i]), fps[fp[i]], float(value[i])
            still_active(f, last)
            now[f] = (last, None if v != v else v)
            out.append((time_of(last), "firing", f, v, time_of(last)))

        # Alerts that are not forced are most of the rows: from what else happens to the next, only those that fire are looked at.
        plain = np.flatnonzero(action == ACTIONS.index("fire"))
        others = np.flatnonzero(action != ACTIONS.index("fire"))
        when, place = us[plain], memoryview(plain)
        times = memoryview(when)
        steps = [(int(i), None, int(q)) for i, q in zip(others, np.searchsorted(plain, others))]
        at = np.searchsorted(us, over)  # an end comes before all else of its time
        steps += [(int(i), e, int(q)) for i, e, q in zip(at, over, np.searchsorted(plain, at))]
        steps.sort(key=lambda s: (s[0], s[1] is None))
        p = 0
        for i, end, q in [*steps, (len(us), None, len(plain))]:
            while not silent and p < q:
                if last is not None and times[p] - last < self.cooldown:
                    p = bisect_left(times, last + self.cooldown, p, q)
                    if p == q:
                        break
                fire(place[p])
                p += 1
            p = q
            if end is not None:
                silent = False
            elif i < len(us):
                said = ACTIONS[action[i]]
                if said in ("silence", "unsilence"):
                    silent = said == "silence"
                elif said == "resolve":
                    f = fps[fp[i]]
                    if (shown := still_active(f, int(us[i]))) is not None:
                        now[f] = None
                        out.append((time_of(int(us[i])), "resolved", f, shown[1], time_of(shown[0])))
                elif not silent:
                    fire(i)

        for e in known:
            if e <= newest:
                self.ends.removeKey((e,))
        later = {e for e in ends if e > newest}
        for e in later - known:
            self.ends.updateValue((e,), (1,))
        for f, shown in now.items():
            if shown is not None and shown != was[f]:
                self.active.updateValue((f,), shown)
            elif shown is None and was[f] is not None:
                self.active.removeKey((f,))
        if last is not None:
            self.last.update((last,))
        if silent:
            self.silent.update((newest,))
        elif self.silent.exists():
            self.silent.clear()
        self._wake_by([*later, *([last + self.cooldown] if last is not None else []), *(s[0] + self.forget for s in now.values() if s is not None)])
        yield frame([(key[0], *x) for x in out], ALERT_OUT)

    def _wake_by(self, times: list[int]) -> None:
        """The timer stands no later than the first of these times."""
        if not times:
            return
        ms, before = -(-min(times) // 1000), self.due.get()[0] if self.due.exists() else None
        if before is None or ms < before:
            if before is not None:
                self.handle.deleteTimer(before)
            self.due.update((self.wake(min(times)),))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()) * 1000
        self.due.clear()
        ahead, out = [], []
        for (end,) in list(self.ends.keys()):
            if end <= now:
                self.ends.removeKey((end,))
                self.silent.clear()
            else:
                ahead.append(end)
        if self.last.exists():
            if (ready := self.last.get()[0] + self.cooldown) <= now:
                self.last.clear()  # nothing to wait for any more
            else:
                ahead.append(ready)
        for (fp,), (fired, value) in list(self.active.iterator()):
            if fired + self.forget <= now:
                self.active.removeKey((fp,))
                out.append((time_of(fired + self.forget), "expired", fp, value, time_of(fired)))
            else:
                ahead.append(fired + self.forget)
        self._wake_by(ahead)
        yield frame([(key[0], *x) for x in out], ALERT_OUT)


def alert_states(commands: DataFrame, cooldown: float, late: str = "10 minutes", forget: float = 30 * 86400.0) -> DataFrame:
    """What alert commands (rule, ts, action, fingerprint, value, seconds) bring about: rows (ts, state, ...) of each rule.

    Actions: fire (unless silenced or in cooldown), force (unless silenced), silence (for `seconds`; null: until it is ended),
    unsilence, resolve (of an active fingerprint). States: firing, resolved, and expired for alerts that nobody resolved
    within `forget` seconds. A silence's end, by itself or not, ends the rule's silence. Of one time, ends come first,
    then silences, alerts and resolutions; alerts by fingerprint. Dropped: silences that ended, last times that no cooldown asks for, alerts not active.
    """
    rows = commands.select("rule", "ts", "action", "fingerprint", "value", "seconds").withWatermark("ts", late)
    return rows.groupBy("rule").transformWithStateInPandas(Alerts(cooldown, forget), ALERT_OUT, "append", "EventTime")


# --- job states

JOB_OUT = "job_key string, status string, retry_count bigint, terminal boolean, updated_at timestamp"
TERMINAL = ("completed", "skipped")


class Jobs(_Timed):
    def __init__(self, keep: float, idle: float):
        self.keep, self.idle = int(keep * 1e6), int(idle * 1e6)

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.state = handle.getValueState("job", "status string, retries bigint, us bigint, timer bigint")

    def _kept(self, status):
        return self.keep if status in TERMINAL else self.idle

    def handleInputRows(self, key, rows, timerValues):
        status, retries, at, timer = self.state.get() if self.state.exists() else (None, 0, None, None)
        for us, s in sorted(self.together(rows, ["status"])):
            if at is not None and us >= at + self._kept(status):  # forgotten by then, wherever the batches were cut
                status, retries, at = None, 0, None
            retries += s == "failed"
            if at is None or us >= at:
                status, at = s, us
        if at is None:  # rows without a time alone
            return
        if timer is not None:
            self.handle.deleteTimer(timer)
        timer = self.wake(at + self._kept(status))
        self.state.update((status, int(retries), at, timer))
        yield frame([(key[0], status, int(retries), status in TERMINAL, time_of(at))], JOB_OUT)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.state.clear()
        yield frame([], JOB_OUT)


def job_states(events: DataFrame, late: str = "10 minutes", keep: float = 86400.0, idle: float = 30 * 86400.0) -> DataFrame:
    """(job_key, status, retry_count, terminal, updated_at) after each batch: the latest status, and how often it failed.

    A finished job is forgotten `keep` seconds after its last event, any other after `idle` seconds: should it turn up
    again, it starts anew. Of a batch's events at one time the status that is last in the alphabet counts.
    """
    rows = events.select("job_key", "ts", "status").withWatermark("ts", late)
    return rows.groupBy("job_key").transformWithStateInPandas(Jobs(keep, idle), JOB_OUT, "update", "EventTime")


# --- interaction sessions

SESSION_OUT = "video_id string, hand string, object string, start bigint, end bigint, kind string, peak_confidence double"
STRENGTH = {"approach": 1, "touch": 2, "grasp": 3}


#: Groups that the hands' objects of a video are dealt to: a call of Python and a state for each.
GROUPS = 64


class Sessions(_Timed):
    """The objects of one group: their open sessions, and one timer, at the first time at which one of these is over."""

    def __init__(self, fps: float, least: float, idle: float):
        self.fps, self.least, self.idle = fps, least, int(idle * 1e6)

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.state = handle.getListState("sessions", "object string, start bigint, last bigint, kind int, peak double, seen bigint")
        self.due = handle.getValueState("due", "ms bigint")

    def _closed(self, key, name, start, end, frames, kind, peak, out):
        if frames / self.fps >= self.least:
            out.append((*key[:2], name, start, end, next(k for k, v in STRENGTH.items() if v == kind), peak))

    def _keep(self, open_: dict) -> None:
        before = self.due.get()[0] if self.due.exists() else None
        ms = -(-(min(s[4] for s in open_.values()) + self.idle) // 1000) if open_ else None
        if before is not None and before != ms:
            self.handle.deleteTimer(before)
        if not open_:
            self.state.clear()
            self.due.clear()
            return
        self.state.put([(name, *s) for name, s in open_.items()])
        if before != ms:
            self.handle.registerTimer(ms)
            self.due.update((ms,))

    def _held(self) -> dict:
        return {name: tuple(s) for name, *s in self.state.get()} if self.state.exists() else {}

    def handleInputRows(self, key, rows, timerValues):
        held, out = self._held(), []
        pdf = pd.concat(list(rows))
        said, kinds = pd.factorize(pdf["kind"])
        kind_of = np.array([0 if k == "none" else STRENGTH[k] for k in kinds], np.int8)[said]
        object_of, names = pd.factorize(pdf["object"], use_na_sentinel=False)
        names = [None if pd.isna(n) else n for n in names]
        frame_of, peak_of = pdf["frame_idx"].to_numpy(np.int64), pdf["confidence"].to_numpy(float)
        us = pdf["ts"].to_numpy("datetime64[us]").astype(np.int64)
        order = np.lexsort((us, frame_of, object_of))
        # A none does nothing where nothing is open, and most are such.
        live, first = kind_of[order] > 0, np.diff(object_of[order], prepend=-1) != 0
        before = np.where(first, np.array([n in held for n in names])[object_of[order]], np.roll(live, 1))
        order = order[live | before]
        now, start, last, kind, peak, seen = None, None, None, 0, 0.0, None
        for o, f, t, k, c in zip(*(x[order].tolist() for x in (object_of, frame_of, us, kind_of, peak_of))):
            if o != now:
                if start is not None:
                    held[names[now]] = (start, last, kind, peak, seen)
                now = o
                start, last, kind, peak, seen = held.pop(names[o], (None, None, 0, 0.0, None))
            if start is not None and t >= seen + self.idle:  # closed by then, wherever the batches were cut
                self._closed(key, names[o], start, last, last - start, kind, peak, out)
                start, last, kind, peak, seen = None, None, 0, 0.0, None
            if k == 0:
                if start is not None:
                    self._closed(key, names[o], start, f - 1, f - start, kind, peak, out)
                start, last, kind, peak, seen = None, None, 0, 0.0, None
            else:
                start, last, seen = (f if start is None else start), f, t if seen is None else max(t, seen)
                kind, peak = max(kind, k), max(peak, c)
        if start is not None:
            held[names[now]] = (start, last, kind, peak, seen)
        self._keep(held)
        yield frame(out, SESSION_OUT)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()) * 1000
        held, out = self._held(), []
        for name, (start, last, kind, peak, seen) in list(held.items()):
            if seen + self.idle <= now:
                self._closed(key, name, start, last, last - start, kind, peak, out)
                del held[name]
        self.due.clear()
        self._keep(held)
        yield frame(out, SESSION_OUT)


def interaction_sessions(rows: DataFrame, fps: float, least_seconds: float = 0.1, late: str = "10 seconds", idle: float = 60.0) -> DataFrame:
    """Sessions of (hand, object) on live frames (video_id, hand, object, frame_idx, ts, kind, confidence).

    A session is given out when a frame of kind none closes it, or when nothing of it came for `idle` seconds; nothing is
    kept of a hand and object that do not interact. The objects of a hand are dealt to groups by hash, and a group's are taken together.
    """
    group = F.pmod(F.xxhash64("object"), F.lit(GROUPS)).alias("group")
    rows = rows.select("video_id", "hand", group, "object", "frame_idx", "ts", "kind", "confidence").withWatermark("ts", late)
    return rows.groupBy("video_id", "hand", "group").transformWithStateInPandas(Sessions(fps, least_seconds, idle), SESSION_OUT, "append", "EventTime")
