import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from motionframe.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def windows(items, window=13):
    """By length: the ids of each window."""
    out = {}
    for item_id, t in items:
        v = WORD.findall((t or "").translate(LOW))
        for i in range(max(1, len(v) - window + 1) if v else 0):
            part = tuple(v[i : i + window])
            out.setdefault(len(part), {}).setdefault(part, set()).update({str(item_id)} if item_id is not None else set())
    return out


def brute(text, items, window=13, known=None):
    w = WORD.findall((text or "").translate(LOW))
    hit, found = set(), set()
    for n, of in (known or windows(items, window)).items():
        for j in range(len(w) - n + 1):
            ids = of.get(tuple(w[j : j + n]))
            if ids is not None:
                hit |= set(range(j, j + n))
                found |= ids
    return len(w), len(hit), sorted(found)


def case(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string, n_words string, item_ids int")
    b = spark.createDataFrame(items, "item_id long, text string, text2 string")
    rows = D.scan_documents(d, b, **kw).collect()
    assert len(rows) == len(docs)
    want = sorted((d[0] is None, d[0] or 0, *brute(d[1], [i[:2] for i in items])) for d in docs)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_hit, r.item_ids) for r in rows)
    assert got == want
    return rows


def make():
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(40)] + ["été", "naïve", "Ünder", "x y"]
    say = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, say(rng.choice([2, 5, 13, 14, 30])), "") for i in range(20)] + [(None, "solo item", ""), (7, None, ""), (8, "", ""), (3, "!!!", "")]
    items += items[:2]
    docs = [(None, None, "a", 1), (1, "", "a", 1), (1, "", "a", 1), (2, "...", None, None), (3, "Solo-ITEM solo item", "", 2)]
    for i in range(60):
        a, b = rng.choice(items)[1] or "", rng.choice(items)[1] or ""
        docs.append((i, f"{say(rng.randint(0, 20))}, {a.upper()}! {say(3)}\n{b}", "", 0))
    docs.append((99, say(30000) + items[0][1], "", 0))
    return docs, items


def test_against_brute_force_and_in_blocks(spark):
    docs, items = make()
    one = case(spark, docs, items)
    many = case(spark, docs, items, block_bytes=100)
    key = lambda r: (str(r.doc_id), r.n_words, r.n_hit, str(r.spans))
    assert sorted(map(key, one)) == sorted(map(key, many))


def test_two_megabytes_of_items_in_one_pass(spark):
    rng = random.Random(9)
    vocab = [f"w{rng.randrange(10**6)}" for _ in range(20_000)]
    say = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(i, " ".join(say(rng.randrange(1, 120))), "") for i in range(6000)]
    items += [(9000 + i, "the the the the the the the the " * 3 + f"end{i}", "") for i in range(300)]  # one block in many items
    assert sum(len(t) for _, t, _ in items) > 2_000_000
    docs = [(-1, "the " * 300, "", 0), (-2, "the " * 12, "", 0)]
    for i in range(150):
        w = rng.choice(items)[1].split()
        a = rng.randrange(len(w))
        docs.append((i, " ".join(say(20) + w[a : a + rng.randrange(8, 30)] + say(rng.randrange(9)) + w[-13:]), "", 0))
    d = spark.createDataFrame(docs, "doc_id long, text string, n_words string, item_ids int")
    out = D.scan_documents(d, spark.createDataFrame(items, "item_id long, text string, text2 string"))
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    known = windows([i[:2] for i in items])
    assert {r.doc_id: (r.n_words, r.n_hit, r.item_ids) for r in out.collect()} == {d[0]: brute(d[1], None, known=known) for d in docs}


def test_large_benchmark_is_narrowed_to_one_pass(spark):
    """Of many items few occur: these alone make the automaton, which sees only the texts that may have them."""
    rng = random.Random(3)
    vocab = [f"w{rng.randrange(10**6)}" for _ in range(20_000)]
    say = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(i, " ".join(say(rng.choice([1, 3, 6, 7, 12, 13, 14, 20, 60]))) + ("" if i % 9 else " été"), "") for i in range(8000)]
    items += [(None, "only once", ""), (9001, None, ""), (9002, "?!", "")]
    docs = [(-1, None, "", 0), (-2, "", "", 0), (-3, "ONLY, once", "", 0)]
    for i in range(300):
        part = rng.choice(items[:8000])[1].upper().split() if i % 10 == 0 else []
        docs.append((i, " ".join([f"z{rng.randrange(99)}" for _ in range(20)] + part + ["zz"] * (i % 3)), "", 0))
    docs.append((999, " ".join(["zz"] * 40_000) + " " + items[5][1], "", 0))
    d = spark.createDataFrame(docs, "doc_id long, text string, n_words string, item_ids int")
    b = spark.createDataFrame(items, "item_id long, text string, text2 string")
    size = 1 << 16
    assert sum(len(t or "") for _, t, _ in items) > 4 * size
    out = D.scan_documents(d, b, block_bytes=size)
    known = windows([i[:2] for i in items])
    assert {r.doc_id: (r.n_words, r.n_hit, r.item_ids) for r in out.collect()} == {x[0]: brute(x[1], None, known=known) for x in docs}
    rows = d.select("doc_id", "text")
    looked, left = D.narrowed(rows, D.distinct_items(b), "text", 13)
    said = [f" {' '.join(WORD.findall((x[1] or '').translate(LOW)))} " for x in docs]
    low = lambda t: WORD.findall(t.translate(LOW))
    stand_for = lambda w: [w[i : i + 7] for i in range(0, len(w) - 6, 7)] if len(w) >= 13 else [w] if w else []
    want = {(str(i) if i is not None else None, t) for i, t, _ in items if t and any(f" {' '.join(p)} " in d for p in stand_for(low(t)) for d in said)}
    assert {(r["item"], r["text"]) for r in left.collect()} == want and 30 < len(want) < 100
    assert len(list(D.item_pieces(left, size))) == 1
    assert looked.where(F.size("__hits") > 0).count() < 50
    assert looked.count() == len(docs)


def test_filter_that_is_too_full_changes_no_result(spark, monkeypatch):
    docs, items = make()
    want = case(spark, docs, items)
    monkeypatch.setattr(D, "filter_cells", lambda keys, n: np.full(16, 2**64 - 1, np.uint64))
    got = case(spark, docs, items, block_bytes=100)
    key = lambda r: (str(r.doc_id), r.n_words, r.n_hit, str(r.item_ids), str(r.spans))
    assert sorted(map(key, got)) == sorted(map(key, want))


def test_spans_are_in_the_original(spark):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen"
    text = "Ça va? " + item.upper().replace(" ", "\t-- ") + "; bien"
    (r,) = D.scan_documents(spark.createDataFrame([(1, text)], "doc_id long, text string"), spark.createDataFrame([(5, item)], "item_id long, text string")).collect()
    (s,) = r.spans
    assert text[s.start : s.end] == item.upper().replace(" ", "\t-- ")


def test_empty_tables_and_removal(spark):
    docs, items = make()
    d = spark.createDataFrame(docs, "doc_id long, text string, n_words string, item_ids int")
    b = spark.createDataFrame(items, "item_id long, text string, text2 string")
    none = D.scan_documents(d, b.limit(0))
    assert none.agg(F.sum("n_hit")).first()[0] == 0 and none.count() == len(docs)
    assert D.scan_documents(d.limit(0), b).count() == 0
    odd = d.withColumnRenamed("item_ids", "__text").withColumnRenamed("n_words", "__c0")
    for r in D.scan_documents(odd, b, keep=odd.columns, block_bytes=100).collect():  # names that clash with the operator's
        assert (r.doc_id, r.text, r["__c0"], r["__text"]) in docs
    kept = D.remove_contaminated(d, b)
    assert kept.schema == d.schema
    pairs = [i[:2] for i in items]
    assert kept.count() == sum(1 for x in docs if (lambda w, h, _: not (h and 20 * h >= w))(*brute(x[1], pairs)))


def test_query(spark):
    from motionframe.llm.queries import queries

    dir_ = "/root/testdata/sf0.001"
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{dir_}/benchmark.parquet").collect()]
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{dir_}/documents.parquet").collect()}
    rows = queries()["op10_decontaminate"](spark, dir_).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, h, ids = brute(texts[r.doc_id], items)
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (n, h, len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), h > 0 and 20 * h >= n)


def test_narrowing_broadcasts_no_hashes(spark):
    """Hashes of texts and of items are exploded: Spark would size either side of their join as one hash a row."""
    docs = spark.createDataFrame([("a b c d e f g h i j k l m n o",), (None,)], "text string")
    items = D.distinct_items(spark.createDataFrame([("x", "b c d e f g h i j k l m n"), ("y", "p q r")], "item_id string, text string"))
    _, left = D.narrowed(docs, items, "text", 13)
    assert "Broadcast" not in left._jdf.queryExecution().executedPlan().toString()
    assert [r["item"] for r in left.collect()] == ["x"]
