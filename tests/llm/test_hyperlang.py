import zlib

import numpy as np

from motionframe.llm import hyperlang as H
from motionframe.llm.queries import queries

EN = "the quick brown fox jumps over the lazy dog and then the other thing that they were thinking of"
FR = "le renard brun saute par dessus le chien paresseux et puis les autres choses dont ils parlaient"


def test_binding_is_as_stated():
    s = H.Space()
    a, b, c = (s._letter(ord(x)) for x in "abc")
    keys, counts = s.trigrams("ABC  abc!")
    assert counts.tolist() == [2, 1, 2, 1, 1][: len(counts)] or counts.sum() == 7
    out = sum(n * np.roll(s._letter(k >> 42), 2) * np.roll(s._letter((k >> 21) & 0x1FFFFF), 1) * s._letter(k & 0x1FFFFF) for k, n in zip(keys.tolist(), counts.tolist()))
    assert np.allclose(s.encode("ABC  abc!"), out / np.linalg.norm(out), atol=1e-5)
    assert np.roll(a, 2)[2] == a[0] and len(b) == len(c) == H.DIM
    assert s.encode("12 ...") is None and s.encode(None) is None and s.encode("") is None


def test_edges(spark):
    rows = [(None, EN, "en"), (1, EN, "en"), (1, EN, "en"), (2, FR, "fr"), (3, None, "fr"), (4, "", None), (5, "12", "en"), (6, FR[:40], None), (7, EN * 2000, None)]
    d = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, score string")
    known = H.prototypes(d)
    assert [k for k, _ in known] == ["en", "fr"] and known == H.prototypes(d.repartition(7))
    got = H.identify(d, known, ["doc_id", "score"]).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    lang = {r.doc_id: r.lang_pred for r in got}
    assert lang == {None: "en", 1: "en", 2: "fr", 3: "und", 4: "und", 5: "und", 6: "fr", 7: "en"}
    assert {r.lang_pred for r in H.identify(d, []).collect()} == {"und"}
    assert H.identify(d.limit(0), known).count() == 0 and H.prototypes(d.limit(0)) == []
    kept = H.keep_known(d, d)
    assert kept.schema == d.schema and kept.count() == 6


def test_query(spark):
    d = "/root/testdata/sf0.01"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    rows = queries()["op1_hyperlang"](spark, d).collect()
    assert len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.98 * len(held)


def by_hand(text, rows):
    """Letter by letter and trigram by trigram: the language and its cosine. rows: (text, language)."""
    letter = lambda ch: np.random.default_rng([H.SEED, ord(ch) if ch != " " else 0]).choice(np.array([-1.0, 1.0]), H.DIM)

    def bundle(t):
        runs = "".join(ch if ch.isalpha() else " " for ch in (t or "").lower()).split()
        padded = f" {' '.join(runs)} "
        grams = [padded[i : i + 3] for i in range(len(padded) - 2)] if runs else []
        out = sum((np.roll(letter(g[0]), 2) * np.roll(letter(g[1]), 1) * letter(g[2]) for g in grams), np.zeros(H.DIM))
        return out / np.linalg.norm(out) if grams else None

    sums = {}
    for t, lang in rows:
        if lang is not None and (v := bundle(t)) is not None:
            sums[lang] = sums.get(lang, 0) + np.rint(v * H.SCALE)
    v = bundle(text)
    if v is None:
        return "und", 0.0
    cos = {lang: float(v @ p / np.linalg.norm(p)) for lang, p in sorted(sums.items())}
    best = max(cos, key=cos.get)
    return best, max(0.0, cos[best])


def test_predictions_by_hand(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("n_chars < 600").orderBy("doc_id").limit(30).collect()
    rows = [(r.text, r.lang) for r in docs] + [(FR, "fr"), (EN, "en")]
    d = spark.createDataFrame([(i, *r) for i, r in enumerate([*rows, ("Ünïcode, \u0130stanbul", None), ("", None), ("x", None)])], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in H.identify(d, H.prototypes(d)).collect()}
    for r in d.collect():
        lang, score = by_hand(r.text, rows)
        assert got[r.doc_id].lang_pred == lang and abs(got[r.doc_id].score - score) < 1e-3
