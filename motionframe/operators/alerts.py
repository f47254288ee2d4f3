"""Alerts in batch: silences, cooldown, forced alerts, and which are active, for rules with any number of alerts.

An alert fires if its rule is not silenced and either it is forced or `seconds` have gone by since the rule's last alert that
fired. Whether one fires depends on all before it; here no rule is streamed through a task:

- Each alert points to the next one that would fire if it did: the first that comes `seconds` later or more. All are found
  in one sort of alerts and wanted times together.
- A rule's first alert fires, and so does each forced one. Those are marked; then all that the marked ones point to, and
  all pointers are doubled: after k rounds those up to 2^k steps away are marked. Pointers don't cross a forced alert.

So there are log2(alerts that fire in a row) rounds, each two joins on unique row numbers, whatever a rule's share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motionframe.functions.scalar import micros
from motionframe.operators.ranges import carried, running_sums
from motionframe.session import written


def unsilenced(alerts: DataFrame, silences: DataFrame, rule: str = "rule", at: str = "ts") -> DataFrame:
    """alerts without those of silenced rules. silences: rule, at and till; till null is until something ends it.

    A silence starts with its `at`. The end of any silence of a rule ends the rule's silence, also where another one
    would last longer. An alert at the very start of a silence is silenced, one at its very end is not.
    """
    on = silences.select(F.col("rule").alias("__rule"), F.explode(F.array(F.struct(F.col("at").alias("t"), F.lit(True).alias("on")), F.struct(F.col("till").alias("t"), F.lit(False).alias("on")))).alias("e"))
    events = on.select("__rule", micros("e.t").alias("__us"), F.col("e.on").alias("__on"), F.lit(None).cast(alerts.select(F.struct("*")).schema[0].dataType).alias("__row")).where("__us is not null")
    rows = alerts.select(F.col(rule).alias("__rule"), micros(at).alias("__us"), F.lit(None).cast("boolean").alias("__on"), F.struct(*alerts.columns).alias("__row"))
    # at one time: starts and ends first, and of these the starts last
    both = carried(events.unionByName(rows), ["__rule"], ["__us", F.col("__on").isNull(), "__on", "__row"], __silent=F.col("__on"))
    return both.where(F.col("__row").isNotNull() & ~F.coalesce("__silent", F.lit(False))).select("__row.*")


def fired(alerts: DataFrame, seconds: float, rule: str = "rule", at: str = "ts", tie: list[str] = [], force: Column | None = None, silences: DataFrame | None = None) -> DataFrame:  # noqa: B006
    """The alerts that fire. tie: columns that put a rule's alerts of one time in order; else their other columns do.

    Alerts without a time don't fire; a null rule is a rule of its own; `force` null is false.
    """
    columns = alerts.columns
    rest = [*tie, *(c for c in columns if c not in (rule, at, *tie))]
    forced = F.lit(False) if force is None else F.coalesce(force, F.lit(False))
    rows = alerts.where(F.col(at).isNotNull()).withColumn("__forced", forced)
    if silences is not None:
        rows = unsilenced(rows, silences, rule, at)
    if seconds <= 0:
        return rows.select(*columns)
    rows = rows.withColumn("__us", micros(at))
    # __step: the number of forced alerts up to this one; alerts of one step follow from its first
    numbered = written(running_sums(rows, [rule], ["__us", *rest], __nth=F.lit(1), __step=F.col("__forced").cast("long")).withColumn("__id", F.monotonically_increasing_id()), "alerts")
    jumps = _pointers(numbered, rule, int(seconds * 1_000_000))
    marked = reached(numbered.where((F.col("__nth") == 1) | F.col("__forced")).select("__id"), jumps)
    return numbered.join(marked, "__id", "left_semi").select(*columns)


def _pointers(numbered: DataFrame, rule: str, wait: int) -> DataFrame:
    """__id and __to, the first alert of the rule `wait` later or more, where it is of the same step."""
    alert = numbered.select(F.col(rule).alias("__rule"), "__us", F.col("__nth").alias("__n"), F.struct("__id", "__step").alias("__found"), F.lit(None).cast("long").alias("__from"), F.lit(None).cast("long").alias("__own"))
    wanted = numbered.select(F.col(rule).alias("__rule"), (F.col("__us") + wait).alias("__us"), F.lit(0).alias("__n"), F.lit(None).cast(alert.schema["__found"].dataType).alias("__found"), F.col("__id").alias("__from"), F.col("__step").alias("__own"))
    # from the latest: what was met last is the next; at one time alerts come before those that want them
    both = carried(alert.unionByName(wanted), ["__rule"], [F.desc("__us"), F.desc("__n"), "__from"], __next=F.col("__found"))
    hit = both.where(F.col("__from").isNotNull() & (F.col("__next.__step") == F.col("__own")))
    return hit.select(F.col("__from").alias("__id"), F.col("__next.__id").alias("__to"))


def reached(roots: DataFrame, jumps: DataFrame) -> DataFrame:
    """__id of all that can be reached from roots (__id) along jumps (__id, __to), by pointer doubling; paths never meet."""
    marked, jumps = written(roots, "marked"), written(jumps, "jumps")
    while True:
        new = written(marked.join(jumps, "__id").select(F.col("__to").alias("__id")), "marked")
        if new.isEmpty():
            return marked
        marked = marked.unionByName(new)
        jumps = written(jumps.join(jumps.select(F.col("__id").alias("__to"), F.col("__to").alias("__on")), "__to").select("__id", F.col("__on").alias("__to")), "jumps")


def active(alerts: DataFrame, resolved: DataFrame, key: str = "fingerprint", at: str = "ts") -> DataFrame:
    """Of the alerts that fired, the last of each key that no row of resolved (key, at) follows, and when those resolved were.

    state is firing or resolved; resolved_at is the first resolution at or after the last firing. A resolution of what
    is not active does nothing.
    """
    last = alerts.groupBy(key).agg(F.max(F.struct(F.col(at).alias("__at"), *(c for c in alerts.columns if c not in (key, at)))).alias("__row"))
    ends = resolved.select(F.col(key).alias("__key"), F.col("at").alias("__end"))
    both = last.join(ends, F.col(key).eqNullSafe(F.col("__key")) & (F.col("__end") >= F.col("__row.__at")), "left")
    out = both.groupBy(key, "__row").agg(F.min("__end").alias("resolved_at"))
    rest = [F.col(f"__row.{c}").alias(c) for c in alerts.columns if c not in (key, at)]
    return out.select(key, F.col("__row.__at").alias(at), *rest, F.when(F.col("resolved_at").isNull(), "firing").otherwise("resolved").alias("state"), "resolved_at")
