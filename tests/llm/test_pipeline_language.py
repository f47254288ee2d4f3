import random
import re
import string

from pyspark.sql import functions as F

import corpus_pipeline as P

DIR = "/root/testdata/sf0.1"


def test_decisions(spark):
    """Noise goes, a wrong label and a missing one are set right, and what is clean stays as it is."""
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    long = {r.lang: r.text for r in docs.where("n_chars between 2000 and 4000").orderBy("doc_id").limit(200).collect()}
    rng = random.Random(3)
    noise = ["".join(rng.choice(string.ascii_lowercase + "    ") for _ in range(n)) for n in (80, 400, 2000)]
    hard = [(-1 - i, t, "en", "s", 0) for i, t in enumerate(noise)] + [(-10, long["fr"], "en", "s", 0), (-11, long["de"], None, "s", 0), (-12, long["es"], "es", "s", 0), (-13, noise[0][:20], "en", "s", 0)]
    out = P.identify_language(spark, docs.unionByName(spark.createDataFrame(hard, docs.schema)), DIR)
    assert {r.doc_id: r.lang for r in out.where("doc_id < 0").collect()} == {-10: "fr", -11: "de", -12: "es", -13: "en"}
    both = out.select("doc_id", F.col("lang").alias("now")).join(docs, "doc_id")
    assert 0 < both.where("now != lang").count() < 0.002 * docs.count()
    assert both.count() == docs.count()


def test_short_clean_documents_stay(spark):
    """All of sf0.1: only rows without a letter go."""
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    short = spark.createDataFrame([(-1, "A.", "en", "s", 2), (-2, "Avec.", "fr", "s", 5), (-3, "A.\nAll rights reserved.", "en", "s", 23), (-4, "1 + 1", "en", "s", 5), (-5, None, "en", "s", 0)], docs.schema)
    docs = docs.unionByName(short)
    want = sorted(r.doc_id for r in docs.select("doc_id", "text").collect() if re.search(r"[^\W\d_]", r.text or ""))
    assert {-1, -2, -3} <= set(want) and not {-4, -5} & set(want)
    assert sorted(r.doc_id for r in P.identify_language(spark, docs, DIR).select("doc_id").collect()) == want
