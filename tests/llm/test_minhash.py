import random
import re

import numpy as np
from pyspark.sql import functions as F

from motionframe.llm import components as C
from motionframe.llm import minhash as M
from motionframe.llm import skew
from motionframe.llm.components import components
from motionframe.llm.queries import queries
from motionframe.session import written

W = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sets(text):
    w = W.findall((text or "").translate(LOW))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(docs, percent=85):
    """component_id by id, all pairs compared."""
    s = [sets(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if s[i] and s[j] and (s[i] is s[j] or 100 * len(s[i] & s[j]) >= percent * len(s[i] | s[j])):
                root[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(docs):
        ids.setdefault(find(i), []).append(d)
    return [(d, len(s[i]), min((x for x in ids[find(i)] if x is not None), default=None) if s[i] else d) for i, (d, _) in enumerate(docs)]


def check(spark, docs, dedup=False):
    d = spark.createDataFrame([(a, b, "x", 1) for a, b in docs], "doc_id long, text string, cid string, kept int")
    rows = M.near_duplicate_rows(d).collect()
    key = lambda x: tuple((v is None, v or 0) for v in x)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=key) == sorted(brute(docs), key=key)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    if not dedup:
        return
    for percent in (80, 85):
        check_dedup(spark, docs, percent)


def check_dedup(spark, docs, percent):
    """Columns that clash with names in the operator; of each component one row stays, of rows without words all."""
    d = spark.createDataFrame([(a, b, 7, b"r", [1], i) for i, (a, b) in enumerate(docs)], "doc_id long, text string, __cid int, __rep binary, __bands array<int>, __row int")
    out = M.near_dedup(d, percent=percent)
    assert out.schema == d.schema
    kept = out.collect()
    assert all(r["__cid"] == 7 and bytes(r["__rep"]) == b"r" and r["__bands"] == [1] and docs[r["__row"]] == (r.doc_id, r.text) for r in kept)
    numbered = [(i, t) for i, (_, t) in enumerate(docs)]  # by place, so that every component has a name
    groups = {}
    for (i, n, c), (d_, _) in zip(brute(numbered, percent), docs):
        groups.setdefault(c if n else ("none", i), []).append((d_ is not None, d_ or 0, i))
    got = {r["__row"] for r in kept}
    assert len(got) == len(kept) == len(groups)
    for g in groups.values():
        assert any(i in got and (a, b) == min(g)[:2] for a, b, i in g)


def make(seed=3):
    rng = random.Random(seed)
    say = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    docs = [(None, None), (0, ""), (1, " \n"), (2, "one two"), (3, "One TWO"), (4, "two one"), (None, "one\ttwo"), (5, "É a"), (6, "é a"), (None, "all null"), (None, "all  null")]
    base = say(200)
    for i in range(40):  # a chain: each differs from the one before
        base = list(base)
        base[rng.randrange(200)] = f"x{i}"
        docs.append((100 + i, " ".join(base)))
    core = say(300)
    for i in range(150):  # a large group around the threshold
        t = list(core)
        for _ in range(rng.randrange(0, 9)):
            t[rng.randrange(300)] = f"y{rng.randrange(10**6)}"
        docs.append((1000 + i, " ".join(t)))
    passage = say(60)
    docs += [(2000 + i, " ".join(passage + say(12))) for i in range(60)]  # alike, but below it
    docs += [(3000 + i, " ".join(core)) for i in range(40)] + [(3000, " ".join(core))]
    nulls = " ".join(say(80))
    docs += [(None, nulls)] * 3 + [(7, nulls + " more")] * 2
    docs.append((4000, " ".join(say(30000))))
    rng.shuffle(docs)
    return docs


def test_brute_force(spark):
    check(spark, make(), dedup=True)


def test_empty(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    assert M.near_duplicate_rows(d).count() == 0 and M.near_dedup(d).count() == 0


def test_blocks_of_a_large_bucket(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 8)
    monkeypatch.setattr(M, "SKETCH_BLOCK", 20)
    monkeypatch.setattr(M, "BLOCK_BYTES", 10_000)
    monkeypatch.setattr(skew, "HOT_KEYS", 2)
    check(spark, make(4)[:200])


def test_no_texts_are_copied_for_dissimilar_bucket_mates(spark):
    """A bucket of many rows that no sketch joins: its rows are not dealt with their texts at all."""
    rng = np.random.default_rng(1)
    n = 5000
    sketch = [rng.integers(0, 256, 96).astype(np.uint8).tobytes() for _ in range(n)]
    classes = spark.createDataFrame([(i, 50, s, list(range(i * 24, i * 24 + 24))) for i, s in enumerate(sketch)], "n long, n_shingles long, sketch binary, bands array<bigint>")
    posted = spark.createDataFrame([(0, 77, i) for i in range(n)], "band int, key long, n long")
    labels = spark.createDataFrame([], "n long, component long")
    texts = spark.createDataFrame([(i, f"t{i}") for i in range(n)], "n long, text string")
    sizes = posted.groupBy("key").count().select("key", F.ceil(M.sketch_blocks(F.col("count"))).cast("int").alias("blocks"))
    assert M._in_blocks(posted, sizes).count() == n * -(-n // M.SKETCH_BLOCK)
    assert spark.range(1).select(M.sketch_blocks(F.lit(10**9)).alias("b")).first().b == M.SKETCH_BLOCKS  # linear in the rows
    assert M.rest_links(posted, classes, labels, texts, 85).count() == 0


def test_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    for share in (0.5, 0.85):
        got = []
        for _ in range(40):
            x = rng.integers(0, 2**63, 400).astype(np.uint64)
            n = int(400 * 2 * share / (1 + share))
            y = np.concatenate([x[:n], rng.integers(0, 2**63, 400 - n).astype(np.uint64)])
            got.append(np.mean(M.signature(x) == M.signature(y)))
        assert abs(np.mean(got) - share) < 0.03 and np.std(got) < 0.08


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, x) for x in range(101, 180)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(50)] + [(5, 5), (900, 900)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    want = {x: x for x in nodes}
    for _ in range(60):
        for a, b in edges:
            if a != b:
                want[a] = want[b] = min(want[a], want[b])
    assert got == want


def test_query(spark):
    d = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    rows = queries()["op3_circulant_minhash"](spark, d).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows) == sorted(brute(docs))


def test_join_by_share(spark):
    """Keys above the share and below it, keys without facts, and null keys."""
    rows = spark.createDataFrame([("hot", i) for i in range(3000)] + [("few", i) for i in range(5)] + [("none", 1), (None, 2)], "k string, i int")
    facts = spark.createDataFrame([("hot", 3000, "h"), ("few", 5, "f"), ("unused", 0, "u")], "k string, copies long, v string")
    for how, more in (("left", [("none", 1, None), (None, 2, None)]), ("inner", [])):
        out = skew.join_by_share(rows, facts, "k", 3007, "copies", how).select("k", "i", "v").collect()
        want = [("hot", i, "h") for i in range(3000)] + [("few", i, "f") for i in range(5)] + more
        assert sorted(map(str, map(tuple, out))) == sorted(map(str, want))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_table_that_grows_is_broadcast(spark, monkeypatch):
    """Spark puts these tables, and the band keys of a far larger input, below its threshold; no join is left to that."""
    plans = {}

    def spy(df, name):
        plans.setdefault(name, []).append(plan_of(df))
        return written(df, name)

    monkeypatch.setattr(M, "written", spy)
    monkeypatch.setattr(C, "written", spy)
    d = spark.createDataFrame(make(), "doc_id long, text string")
    empty = type(d).isEmpty
    monkeypatch.setattr(type(d), "isEmpty", lambda df: plans.setdefault("isEmpty", []).append(plan_of(df)) or empty(df))
    deduped = plan_of(M.near_dedup(d))
    out = plan_of(M.near_duplicate_rows(d))
    assert {"posted", "stars", "texts", "links", "edges", "open", "rivals", "rest", "found", "isEmpty"} <= set(plans)
    assert not [name for name, found in plans.items() if any("Broadcast" in p for p in found)]
    assert "Broadcast" not in deduped
    assert out.count("BroadcastHashJoin") == 2  # keys of many rows: 10,000 at most
