"""Catalogue, parsing, monitoring, version and profile operators on literal rows."""

import datetime as dt

import duckdb
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from motionframe.functions import scalar as S
from motionframe.operators import candidates as C
from motionframe.operators import catalog as K
from motionframe.operators import monitoring as M
from motionframe.operators import profiling as P
from motionframe.operators import versions as V

T0 = dt.datetime(2024, 1, 1)


def column(spark, values, kind, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.o for r in df.select("i", f(F.col("v")).alias("o")).orderBy("i").collect()]


def test_parsers(spark):
    assert column(spark, ["10:30", "0:45", "1:30:00", "2:15:30", "invalid", "", None], "string", S.duration_seconds) == [630, 45, 5400, 8130, 0, 0, 0]
    assert column(spark, ["1,234 views", "1 view", "1.5K views", "10.5M views", "2.5B views", "invalid", ""], "string", S.view_count) == [1234, 1, 1500, 10500000, 2500000000, 0, 0]
    assert column(spark, ["https://youtu.be/abc?t=1", "https://www.youtube.com/watch?v=xyz&t=2", "http://e.com/q"], "string", S.video_id_of) == ["abc", "xyz", None]
    assert column(spark, ["30000/1001", "25", "1/0", "x"], "string", lambda c: F.round(S.rational(c), 2)) == [29.97, 25.0, 0.0, 0.0]
    assert column(spark, [12, 90, 7200], "double".replace("double", "int"), S.format_duration) == ["12.0s", "1.5m", "2.0h"]
    assert column(spark, [512, 2048, 5 << 30], "bigint", S.format_size) == ["512.00 B", "2.00 KB", "5.00 GB"]
    assert column(spark, ["a_ep002_ep017", "x_episode"], "string", lambda c: S.parse_episode_id(c)[0]) == ["a_ep002", None]
    assert column(spark, [7, 1234], "int", lambda c: S.episode_id(F.lit("v"), c)) == ["v_ep007", "v_ep1234"]
    assert column(spark, ["A.MP4", "b.npz", "c.h5", "d"], "string", S.file_type) == ["video_mp4", "episode_npz", "hdf5", "unknown"]
    assert column(spark, ["a, b,,c "], "string", S.split_keywords) == [["a", "b", "c"]]


def test_large_sizes(spark):
    sizes = [e * e * 1000 for e in (1_285_227, 2_563_719, 4_363_158)]
    assert column(spark, sizes, "bigint", lambda c: S.format_size(c, "TB")) == ["1502.31 TB", "5977.80 TB", "17314.19 TB"]  # the last two are 5e-10 and less below a half
    assert column(spark, [sizes[0], 5 << 60, None], "bigint", S.format_size) == ["1.47 PB", "5120.00 PB", None]


def test_readable_of_large_ids(spark, tmp_path):
    """As the query's SQL says it, on events whose sizes are over a petabyte."""
    ids = [0, 1, 1000, 1_048_576, 1_285_227, 2_563_719, 4_363_158, 36_000_000]
    con = duckdb.connect()
    con.execute(f"CREATE TABLE events AS SELECT i::BIGINT AS event_id, TIMESTAMP '2024-01-01' AS ts, 1::BIGINT AS user_id, 'view' AS event_type, 1.5::DOUBLE AS value, '' AS props FROM unnest({ids}) AS t(i)")
    con.execute(f"COPY events TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    want = con.execute(oracle_sql()["readable"]).fetchall()
    assert sorted(map(tuple, queries()["readable"](spark, str(tmp_path)).collect())) == sorted(want)


def test_versions(spark):
    got = column(spark, ["v1.2.3", "v10.0.0", "v9.9.9", "x"], "string", lambda c: S.version_text(S.bump(S.parse_version(c), F.lit("minor"))))
    assert got[:3] == ["v1.3.0", "v10.1.0", "v9.10.0"]
    df = spark.createDataFrame([("v9.9.9",), ("v10.0.0",), ("v1.2.3",)], "version string")
    assert [r.version for r in V.version_order(df).collect()] == ["v1.2.3", "v9.9.9", "v10.0.0"] and V.latest_version(df).first().version == "v10.0.0"
    s = "key string, sha256 string, size_bytes long"
    diff = V.manifest_diff(spark.createDataFrame([("f1", "a", 100), ("f2", "b", 200)], s), spark.createDataFrame([("f1", "c", 150), ("f3", "d", 300)], s))
    r = V.diff_summary(diff).first()
    assert (r.added, r.removed, r.modified, r.added_bytes, r.removed_bytes, r.net_bytes) == (1, 1, 1, 450, 300, 150)


def test_context_diff(spark):
    s = "context_id int, params map<string,string>"
    a, b = spark.createDataFrame([(1, {"x": "1", "y": "2", "captured_at": "q"})], s), spark.createDataFrame([(1, {"x": "1", "y": "3", "z": None, "captured_at": "r"})], s)
    assert {(r.name, r.before, r.after) for r in V.context_diff(a, b).collect()} == {("y", "2", "3")}


def test_upserts(spark):
    s = "video_id string, title string, duration_sec int, tags array<string>"
    old = spark.createDataFrame([("a", "", 0, []), ("b", "keep", 5, ["t"])], s)
    new = spark.createDataFrame([("a", "A", 7, ["n"]), ("b", "B", 9, ["n"]), ("c", "C", 1, None)], s)
    got = {r.video_id: (r.title, r.duration_sec, r.tags) for r in K.fill_blanks(old, new, "video_id", ["title", "duration_sec", "tags"]).collect()}
    assert got == {"a": ("A", 7, ["n"]), "b": ("keep", 5, ["t"]), "c": ("C", 1, None)}
    log = spark.createDataFrame([("k", T0, T0, "running"), ("k", T0 + dt.timedelta(1), T0 + dt.timedelta(2), "completed")], "job_key string, started_at timestamp, updated_at timestamp, status string")
    r = K.latest_jobs(log).first()
    assert (r.status, r.started_at) == ("completed", T0)
    tasks = spark.createDataFrame([(1, 0, "failed"), (2, 1, "done")], "task_id int, retry_count int, status string")
    assert {tuple(r) for r in K.retried(tasks, tasks.where("task_id = 1").select("task_id")).collect()} == {(1, 1, "pending"), (2, 1, "done")}
    v = spark.createDataFrame([("a", "discovered", None, None), ("b", "discovered", None, 3), ("c", "x", None, None)], "video_id string, status string, local_path string, duration_sec int")
    res = spark.createDataFrame([("a", 1, False, None, None), ("a", 2, True, "/p", 9), ("b", 1, False, None, None)], "video_id string, at int, success boolean, local_path string, duration_sec int")
    assert {(r.video_id, r.status, r.local_path, r.duration_sec) for r in K.download_results(v, res).collect()} == {("a", "downloaded", "/p", 9), ("b", "failed", None, 3), ("c", "x", None, None)}


def test_kpi(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 11)], "v double")
    assert M.aggregate(df, "v", "p50").first().value == 6 and M.aggregate(df.where("v > 99"), "v", "p95").first().value == 0
    five = df.where("v <= 5")
    assert [M.aggregate(five, "v", m).first().value for m in ("sum", "avg", "min", "max", "count")] == [15, 3, 1, 5, 5]
    kpi = spark.createDataFrame([("pipeline_error_rate", 12.0), ("pipeline_success_rate", 93.0), ("pipeline_throughput", 500.0), ("other", 1.0)], "name string, value double")
    assert {r.name: r.status for r in M.with_status(kpi).collect()} == {"pipeline_error_rate": "critical", "pipeline_success_rate": "warning", "pipeline_throughput": "ok", "other": "ok"}
    z = spark.range(1).select(M.success_rate(F.lit(0), F.lit(0)).alias("s"), M.error_rate(F.lit(0), F.lit(0)).alias("e"), M.availability(F.lit(0), F.lit(0)).alias("a")).first()
    assert (z.s, z.e, z.a) == (100, 0, 100)


def test_cooldown(spark):
    at = [0, 1000, 3599, 3600, 3700, 7300]
    df = spark.createDataFrame([("a", T0 + dt.timedelta(seconds=s), float(s)) for s in at] + [("b", T0, 0.0)], "rule string, ts timestamp, value double")
    got = sorted((r.rule, r.value) for r in M.cooled(df, 3600).collect())
    assert got == [("a", 0.0), ("a", 3600.0), ("a", 7300.0), ("b", 0.0)]


def test_candidates(spark):
    df = spark.createDataFrame([("a", "Robot ARM demo", 60, 1), ("a", "Robot again", 60, 2), ("b", "toy robot", 60, 1), ("c", "cooking", 60, 1), ("d", "gripper", 5, 1), ("e", "gripper", None, 1)], "video_id string, title string, duration_sec int, discovered_at int")
    flags = C.crawl_flags(df.withColumn("description", F.lit(None).cast("string")).withColumn("platform", F.lit("p")).withColumn("keyword", F.lit("k")))
    assert sorted((r.video_id, r.outcome) for r in flags.collect()) == [("a", "accepted"), ("a", "duplicate"), ("b", "filtered"), ("c", "filtered"), ("d", "filtered"), ("e", "accepted")]
    found = flags.drop("outcome")
    told = sorted((r.platform or "", r.keyword or "", r.found, r.duplicates, r.filtered, r.accepted) for r in C.crawl_funnel(found).collect())
    assert told == [("", "", 6, 1, 3, 2), ("", "k", 6, 1, 3, 2), ("p", "", 6, 1, 3, 2)]
    assert C.crawl_funnel(found.unionByName(found)).where("platform = 'p'").first().duplicates == 7 and C.crawl_funnel(found.limit(0)).count() == 0
    nulls = found.withColumn("platform", F.lit(None).cast("string")).withColumn("video_id", F.lit(None).cast("string"))
    assert [tuple(r)[-3:] for r in C.crawl_funnel(nulls).where("g = 3").collect()] == [(5, 0, 1)]
    f = "array<struct<vcodec:string,height:int,fps:double,tbr:double>>"
    info = spark.createDataFrame([(100, 0, 0.0, 0.0, "bin picking", "", [("none", 2000, 60.0, 9.0), ("h264", 720, 30.0, 2500.0)]), (100, 0, 0.0, 0.0, "bin picking", "", [("h264", 360, 30.0, 2500.0)]), (30, 720, 30.0, 0.0, "bin picking", "", None)], f"duration int, height int, fps double, tbr double, title string, description string, formats {f}")
    assert [r.passes for r in C.passes_constraints(info).collect()] == [True, False, False]
    js = '{"contents":[{"videoRenderer":{"videoId":"x","title":{"runs":[{"text":"A"},{"text":"B"}]},"ownerText":{"runs":[{"text":"O"}]},"thumbnail":{"thumbnails":[{"url":"1"},{"url":"2"}]}}},{"other":1}]}'
    r = C.search_results(spark.createDataFrame([(js,)], "json string")).collect()
    assert [(x.video_id, x.title, x.channel_name, x.thumbnail_url) for x in r] == [("x", "AB", "O", "2")]
    page = spark.createDataFrame([('<script>var data = {"a": 1};</script>',)], "h string")
    assert page.select(C.embedded_json(F.col("h"), "data").alias("j")).first().j == '{"a": 1}'
    b = C.batches(spark.range(25), ["id"], 10).groupBy("batch").count().collect()
    assert {(x.batch, x["count"]) for x in b} == {(0, 10), (1, 10), (2, 5)}


def test_checks_and_drift(spark):
    good = spark.createDataFrame([(1.0, 4.0), (2.0, 5.0), (3.0, 6.0)], "a double, b double")
    bad = spark.createDataFrame([(1.0, 4.0), (float("nan"), None), (float("nan"), 6.0)], "a double, b double")
    assert P.nan_check(good, 0.1).first().status == "pass" and P.nan_check(bad, 0.1).first().status == "fail" and P.nan_check(bad).first().value == 0.5
    assert P.range_check(good, "zz").first().status == "fail" and P.range_check(bad.where("false"), "a", 0).first().status == "warn"
    assert P.unique_check(spark.createDataFrame([(1,), (1,), (2,)], "x int"), ["x"]).first().value == 2 / 3
    a = P.numeric_profile(good).join(P.column_types(good).select("column", "kind", "n_null"), "column")
    b = P.numeric_profile(good.select((F.col("a") * 2).alias("a"), F.lit(1).alias("c"))).join(P.column_types(good.select("a", F.lit(1).alias("c"))).select("column", "kind", "n_null"), "column")
    got = {r.column: set(r.changes) for r in P.drift(a, b).collect()}
    assert got["b"] == {"removed"} and got["c"] == {"added"} and {"mean", "std"} <= got["a"]
