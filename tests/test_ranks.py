import math
import random

import numpy as np
from pyspark.sql import functions as F

from motionframe.operators import catalog as K
from motionframe.operators import quality as Q
from motionframe.operators.ranks import percentiles, values_at


def groups(spark):
    rng = random.Random(6)
    rows = [("even", float(i)) for i in range(2000)] + [("same", 7.0)] * 900 + [("skew", rng.paretovariate(1)) for _ in range(3000)] + [("one", -1.5), ("none", None), (None, 2.0), (None, None)]
    rng.shuffle(rows)
    by = {}
    for k, v in rows:
        if v is not None:
            by.setdefault(k, []).append(v)
    return spark.createDataFrame(rows, "k string, v double").repartition(5), {k: sorted(v) for k, v in by.items()}


def test_values_at_any_rank(spark):
    df, by = groups(spark)
    ranks = {"first": lambda n: F.lit(0), "mid": lambda n: F.floor(n / 2), "last": lambda n: n - 1}
    got = {r.k: (r.first, r.mid, r.last) for r in values_at(df, "v", ["k"], ranks).collect()}
    assert got == {k: (v[0], v[len(v) // 2], v[-1]) for k, v in by.items()}
    every = sorted(x for v in by.values() for x in v)
    (r,) = values_at(df, "v", [], {"p": lambda n: F.floor(n * 0.9)}).collect()
    assert r.p == every[math.floor(len(every) * 0.9)]
    assert values_at(df.limit(0), "v", ["k"], ranks).count() == 0


def test_hard_numbers(spark):
    """Both signs, zeros, infinities, NaN, the least and the largest doubles, and neighbours of one another."""
    rng = random.Random(8)
    near = [math.nextafter(1.0, 2.0), 1.0, math.nextafter(1.0, 0.0), 0.1 + 0.2, 0.3]
    v = [0.0, -0.0, math.inf, -math.inf, 5e-324, -5e-324, 1.7976931348623157e308, -1.7976931348623157e308, math.nan, math.nan, *near, *(-x for x in near)]
    v += [rng.choice([-1, 1]) * math.exp(rng.uniform(-700, 700)) for _ in range(500)] + [1e9 + i * 2**-20 for i in range(500)]
    df = spark.createDataFrame([(x,) for x in v], "v double").repartition(3)
    want = sorted(v, key=lambda x: (math.isnan(x), x))
    at = list(range(0, len(v), 37)) + [len(v) - 1, len(v) - 3]
    (got,) = values_at(df, "v", [], {f"r{i}": lambda n, i=i: F.lit(i) for i in at} | {"beyond": lambda n: n}, "n").collect()
    assert got.n == len(v) and got.beyond is None
    assert all(got[f"r{i}"] == want[i] or math.isnan(got[f"r{i}"]) and math.isnan(want[i]) for i in at)


def test_longs_that_doubles_do_not_tell_apart(spark):
    v = [2**62 + i for i in range(300)] + [-(2**62) - i for i in range(300)] + [2**63 - 1, -(2**63)]
    df = spark.createDataFrame([(x,) for x in v], "v long").repartition(3)
    (got,) = values_at(df, "v", [], {f"r{i}": lambda n, i=i: F.lit(i) for i in range(0, 602, 60)}).collect()
    assert all(got[f"r{i}"] == sorted(v)[i] for i in range(0, 602, 60))


def test_percentiles(spark):
    df, by = groups(spark)
    got = {r.k: (r.a, r.b) for r in percentiles(df, "v", ["k"], {"a": 0.25, "b": 0.95}).collect()}
    assert set(got) == set(by)
    assert all(np.allclose(got[k], np.percentile(by[k], [25, 95])) for k in got)


def test_top_percent_with_ties(spark):
    rows = [(i, 0.5 if i % 2 else i / 100) for i in range(40)]
    df = spark.createDataFrame(rows, "episode_id int, quality_score double")
    for percent in (1, 30, 77, 100):
        want = sorted(rows, key=lambda r: (-r[1], r[0]))[: max(1, int(40 * percent / 100))]
        assert sorted(map(tuple, Q.top_percent(df, percent).collect())) == sorted(want)


def test_upserts_take_the_first(spark):
    new = spark.createDataFrame([("a", 3, "late"), ("a", 1, "first"), ("b", 1, ""), ("b", 2, "kept")], "id string, n int, title string")
    old = spark.createDataFrame([("c", 0, "x"), ("b", 0, "")], "id string, n int, title string")
    assert sorted(map(tuple, K.insert_absent(old.where("id = 'c'"), new.where("id = 'a'"), "id", "n").collect())) == [("a", 1, "first"), ("c", 0, "x")]
    assert {(r.id, r.title) for r in K.fill_blanks(old, new, "id", ["title"], "n").collect()} == {("a", "first"), ("b", "kept"), ("c", "x")}


def test_skip_reasons(spark):
    rows = [("completed", 0, 3, "quality"), ("pending", 0, 3, "quality"), ("failed", 5, 6, "network"), ("failed", 5, 5, "network"), ("failed", 0, 3, None)]
    df = spark.createDataFrame(rows, "status string, retry_count int, max_retries int, failure_type string")
    assert [r.reason for r in df.select(K.skip_reason().alias("reason")).collect()] == ["completed", "quality_failed", None, "retries_exhausted", None]
