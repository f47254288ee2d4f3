"""Nothing is gathered into one value: checksums of versions, and the objects of frames."""

import hashlib

from motionframe import plans
from motionframe.operators import versions as V

DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_checksum_streams(spark):
    rows = [(f"v{i % 3}", hashlib.sha256(str(i * i % 1000).encode()).hexdigest()) for i in range(5000)] + [("v1", None), ("only null", None), (None, "a"), (None, "b")]
    got = V.checksum(spark.createDataFrame(rows, "version string, sha256 string").repartition(5))
    want = {v: hashlib.sha256("".join(sorted(x for w, x in rows if w == v and x)).encode()).hexdigest() for v, _ in rows}
    assert {r.version: r.checksum for r in got.collect()} == want and got.count() == len(want)
    assert "collect_list" not in plan(got)
    assert V.checksum(spark.createDataFrame([], "version string, sha256 string")).count() == 0


def test_objects_stay_rows(spark):
    for name in ("largest_object", "sampled_frames", "interactions"):
        assert "collect_list" not in plan(plans.queries()[name](spark, DIR)), name
