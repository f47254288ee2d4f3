import re

import duckdb
import pytest

from motionframe.llm import licences as L
from motionframe.llm.queries import queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall((text or "").translate(str.maketrans(L.UPPER, L.LOWER)))


def brute(text):
    """Every template at every place of a text."""
    w = words_of(text)
    at = lambda p: [i for i in range(len(w) - len(p) + 1) if tuple(w[i : i + len(p)]) == p]
    base, base_labels, labels, best = [], set(), set(), 0.0
    for t in L.TEMPLATES:
        (first, phrase), *others = t.phrases
        for s in at(phrase):
            begin = [s]
            for k, p in others:
                near = [q for q in at(p) if abs(q - s - (k - first)) <= L.SLACK]
                begin.append(min(near, default=None))
            if None in begin:
                continue
            stand = sum(len(p) for _, p in t.phrases)
            for k, off, x in t.followers:
                i = begin[k] + off
                stand += 0 <= i < len(w) and w[i] == x
            labels.add(t.label)
            best = max(best, stand / len(t.words))
            if t.base:
                base.append(s)
                base_labels.add(t.label)
    return len(w), sorted(base), sorted(base_labels), sorted(labels), best


def judged(spark, texts, **more):
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    return {r.doc_id: (r.n_words, r.base_starts, r.base_labels, r.labels, r.score) for r in L.scan(d, ["doc_id"], **more).collect()}


NOTICE = {t.notice: t.notice.replace("[", "").replace("]", "") for t in L.TEMPLATES}
MIT = next(n for n in NOTICE.values() if n.startswith("permission is hereby granted free"))
TEXTS = [
    None,
    "",
    "no licence here",
    "CC BY",
    "cc-by cc by cc",
    "ALL RIGHTS RESERVED. All\trights\nreserved all rights",
    "Licensed under CC BY-NC 4.0.",
    "This work is licensed under the GNU General Public License, version 3.",
    "GNU Lesser General Public License",
    "general public license general public license",
    "lİcense general public lİcense all rights reserved",
    "K all rights reserved Kc by",
    "généra1 public license ünder mit license",
    "mit",
    "license",
    "by cc",
    "word " * 20000 + "All rights reserved " * 3 + "word " * 500,
    *NOTICE.values(),
    MIT.replace("of this software and", "of this fine piece of software and"),
    MIT.replace("documentation files", "documentation files " + "x " * 9),
    MIT.replace("without restriction", "with restriction"),
    " ".join(NOTICE.values()),
    "[" + "] [".join(NOTICE.values()).upper() + "]",
]


def test_against_brute_force(spark):
    got = judged(spark, TEXTS + TEXTS)
    for i, t in enumerate(TEXTS + TEXTS):
        n, base, base_labels, labels, score = brute(t)
        assert got[i][:4] == (n, base, base_labels, labels), t
        assert got[i][4] == pytest.approx(score, abs=1e-12), t
    assert got[6][3] == ["cc-by", "cc-by-nc-4.0"] and got[7][3] == ["gpl", "gpl-3.0"] and got[2][4] == 0


def test_anchors_follow_the_corpus(spark):
    """Other counts choose other anchors; results stay, whatever corpus is counted."""
    d = lambda texts: spark.createDataFrame([(t,) for t in texts], "text string")
    counts = L.document_counts(d(["by by", "by cc", "BY", None]).select(L.words_of(L.F.col("text")).alias("w")), "w", L.TEMPLATES)
    assert (counts["by"], counts["cc"], counts["mit"]) == (3, 1, 0)
    by_words = {p.phrase: p for p in L.postings(L.TEMPLATES, counts)}
    assert (by_words["cc", "by"].anchor, by_words["cc", "by"].second) == ("cc", "by")
    other = {p.phrase: p for p in L.postings(L.TEMPLATES, {"cc": 5, "by": 2})}
    assert (other["cc", "by"].anchor, other["cc", "by"].at) == ("by", 1)
    want = judged(spark, TEXTS)
    for corpus in ([], ["cc"] * 3 + ["all rights general public"] * 2, ["reserved license"] * 4):
        assert judged(spark, TEXTS, corpus=d(corpus)) == want


def test_edges(spark):
    """Extra columns with clashing names, null ids, no rows."""
    d = spark.createDataFrame([(None, "cc by", 1, 2, "x"), (None, "cc by", 1, 2, "x")], "doc_id long, text string, score int, words int, labels string")
    rows = L.scan(d, ["doc_id", "words"]).collect()
    assert [(r.doc_id, r.words, r.base_starts, r.labels) for r in rows] == [(None, 2, [0], ["cc-by"])] * 2
    assert L.scan(d.limit(0), ["doc_id"]).count() == 0


def test_no_python_in_the_plan(spark):
    plan = queries()["op13_licence_index"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_query(spark):
    d = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    rows = queries()["op13_licence_index"](spark, d).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, base, base_labels, labels, score = brute(texts[r.doc_id])
        ends = (base[0], base[-1]) if base else (None, None)
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) == (n, len(base), *ends, ",".join(base_labels), ",".join(labels))
        assert r.score == pytest.approx(score)
    assert sum(r.n_base > 0 for r in rows) >= 10 and {x for r in rows for x in r.labels.split(",")} >= {"cc-by-nc-4.0", "mit", "apache-2.0", "gpl-3.0"}


def test_sql_on_hard_texts(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(TEXTS)))
    got = {r[0]: r[1:] for r in con.execute(L.sql()).fetchall()}
    for i, t in enumerate(TEXTS):
        n, base, base_labels, labels, score = brute(t)
        ends = (base[0], base[-1]) if base else (None, None)
        assert got[i][:-1] == (n, len(base), *ends, ",".join(base_labels), ",".join(labels)) and got[i][-1] == pytest.approx(score)
