import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as P
from tests.llm.test_decontaminate import brute as contamination
from tests.llm.test_minhash import brute as components
from tests.llm.test_secrets import A as ASSIGN
from tests.llm.test_secrets import base

DIR = "/root/testdata/sf0.001"


def values(text):
    """What the base patterns find: an assignment's value, or the whole span."""
    return {ASSIGN.match(text, a).group(2) if k == "assign" else text[a:b] for k, a, b in base(text)}


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    hard = spark.createDataFrame([(-1, None, None, "s", 0), (-2, "", "en", None, 0), (-3, "123 456", "en", "s", 7), (None, "A note of the and that.", "en", "s", 1)], docs.schema)
    docs = docs.unionByName(hard)
    texts = Counter((r.doc_id, r.text) for r in docs.collect())

    one = P.identify_language(spark, docs, DIR)
    assert one.schema == docs.schema
    kept = Counter((r.doc_id, r.text) for r in one.collect())
    assert not kept - texts and {d for d, _ in (texts - kept)} == {-1, -2, -3}

    two = P.drop_near_copies(spark, one, DIR)
    assert two.schema == docs.schema
    want = [d for d, _, c in components(list(kept), 80) if d == c]
    assert sorted((r.doc_id for r in two.collect()), key=str) == sorted(want, key=str)

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    three = P.drop_contaminated(spark, two, DIR)
    left = {}
    for r in two.collect():
        n, h, _ = contamination(r.text, items)
        if not (h > 0 and 20 * h >= n):
            left[r.doc_id] = r.text
    assert {r.doc_id: r.text for r in three.collect()} == left and len(left) > 100

    four = P.redact_secrets(spark, three, DIR)
    assert four.schema == docs.schema
    after = {r.doc_id: r.text for r in four.collect()}
    assert set(after) == set(left)
    owners, repos = {}, {}
    for r in spark.read.parquet(f"{DIR}/documents.parquet").collect():
        for v in values(r.text):
            owners.setdefault(v, set()).add(r.source)
            repos.setdefault(v, set()).add(r.text)
    live = {v for v in owners if len(owners[v]) < 3 and len(repos[v]) <= 10}
    assert all((after[d] == t) == (not values(t) & live) for d, t in left.items())

    truth = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = P.encode_bpe(spark, four, DIR).collect()
    assert len(rows) == len(after)
    for r in rows:
        ids = np.array(truth.encode(after[r.doc_id], add_special_tokens=False).ids, "<u4").tobytes()
        assert bytes(r.ids) == ids and r.n_tokens == len(ids) // 4
        assert r.decoded_sha256 == hashlib.sha256(after[r.doc_id].encode()).hexdigest()


def test_run(spark):
    out = P.run(spark, DIR)
    assert out.columns == ["doc_id", "lang", "source", "ids", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 100
