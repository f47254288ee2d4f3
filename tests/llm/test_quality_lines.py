import re
from collections import Counter

from motionframe.llm import quality_lines as Q
from motionframe.llm.queries import queries

W = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, n_words string, kept int"
PROSE = "It was a fine day and the ships went out to sea with all their men on board.\n"


def brute(text):
    text = text or ""
    w = W.findall(text)
    lines = [x for x in text.split("\n") if W.search(x)]
    at = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    rep = set()
    for i in range(len(w) - 2):
        if at[tuple(w[i : i + 3])] > 1:
            rep |= {i, i + 1, i + 2}
    n = len(w)
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(rep), n < 50 or 100 * len(rep) > 50 * n


def same(row, text):
    assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words, row.base_failed) == brute(text)
    assert not (row.base_failed and row.kept)


def test_rules():
    assert Q.rule("Home | News | Sport | About", 7) == "navigation"
    known = {Q.line_key("© 2020 Foo Inc. Alle Rechte vorbehalten.")}
    assert Q.rule(" © 2020 Foo Inc. Alle Rechte vorbehalten.", 7, known) == "boilerplate"
    assert Q.rule("© 2020 Foo Inc. Alle Rechte vorbehalten.", 7) is None
    assert Q.rule("© 2020 Foo Inc. Alle Rechte vorbehalten.", Q.SHORT + 1, known) is None
    assert Q.rule("no end to this", 4) == "punctuation"
    assert Q.rule("So %%% it %%% goes %%%.", 6) == "punctuation"
    assert Q.rule("He said: (yes!) and left", 5) is None
    assert Q.rule(PROSE.strip(), 16) is None


def test_edges_and_brute_force(spark):
    distinct = " ".join(f"Word{i} goes here." for i in range(60))
    docs = [(None, None), (1, ""), (1, ""), (2, " \n\n "), (3, PROSE), (4, PROSE * 5), (5, distinct), (5, distinct), (6, "a b c a b c a b"), (7, distinct + "\n" + "x | y | z | w\n" * 9), (8, "x | y | z | w\n" * 60 + distinct), (9, "z" * 200_000 + ". " + distinct), (10, "été là\x85 \x0b fin.")]
    rows = Q.measure_lines(spark.createDataFrame([(a, b, "x", 1) for a, b in docs], SCHEMA), keep=["doc_id", "n_words"]).collect()
    assert len(rows) == len(docs)
    texts = dict(docs)
    for r in rows:
        same(r, texts[r.doc_id])
    kept = {r.doc_id: r.kept for r in rows}
    assert kept[5] and kept[7] and not kept[8] and not kept[3] and kept[9]


def test_clean_and_empty(spark):
    distinct = " ".join(f"Word{i} goes here." for i in range(60))
    d = spark.createDataFrame([(1, distinct + "\nHome | a | b | c", "n", 1), (2, None, "n", 2)], SCHEMA)
    (r,) = Q.clean(d).collect()
    assert (r.doc_id, r.text, r.n_words, r.kept) == (1, distinct, "n", 1)
    assert Q.clean(d.limit(0)).count() == 0 and Q.clean(d).schema == d.schema


def brute_recurring(docs):
    """(source, text) of each row to {source: recurring lines}, stripped."""
    out, sources = {}, {}
    for source, text in docs:
        sources.setdefault(source, []).append(text or "")
    for source, texts in sources.items():
        has = {}
        for t in texts:
            drawn = None
            for line in {x.strip(W_SPACE) for x in t.split("\n")}:
                if 0 < len(W.findall(line)) <= 40:
                    drawn = drawn or Q.least_hashes(W.findall(t))
                    has.setdefault(line, []).append(drawn)
        out[source] = {
            line
            for line, rows in has.items()
            if len(rows) >= 5 and 100 * len(rows) >= len(texts) and sum(max(Counter(d).values()) for d in zip(*rows)) <= 6 * len(rows)
        }
    return out


W_SPACE = " \t\n\x0b\x0c\r"


def brute_lines(text, recurring):
    """n_lines, n_failed_lines, n_lost_words and whether at most half of the words are lost."""
    n = failed = lost = 0
    for line in (text or "").split("\n"):
        words = W.findall(line)
        if not words:
            continue
        n += 1
        seps = sum(c in "|>»›·•" for c in line)
        ends = any(re.fullmatch(r".*[.!?…。！？][\"”’»')\]]*", x, re.S) for x in words)
        symbols = sum(c in "#*$%&|<>" for c in line)
        bad = (seps >= 3 and 4 * seps >= len(words)) or (len(words) <= 40 and line.strip(W_SPACE) in recurring) or not ends or 10 * symbols > sum(map(len, words))
        failed += bad
        lost += len(words) * bad
    return n, failed, lost, 2 * lost <= len(W.findall(text or ""))


def test_least_hashes():
    words = [f"w{i % 7000}" for i in range(9000)]
    naive = [2**64 - 1] * Q.DRAWS
    h = [Q.xxhash.xxh3_64_intdigest(x) for x in words]
    for a, b, c in zip(h, h[1:], h[2:]):
        x = (3 * a + 5 * b + 7 * c) % 2**64
        x ^= x >> 31
        for k in range(Q.DRAWS):
            y = x * ((2 * k + 1) * 0x9E3779B97F4A7C15 % 2**64) % 2**64
            naive[k] = min(naive[k], y ^ (y >> 29))
    assert [v % 2**64 for v in Q.least_hashes(words)] == naive
    assert len(Q.least_hashes(["one"])) == len(Q.least_hashes(["one", "two"])) == Q.DRAWS


FURNITURE = ["Alle Rechte vorbehalten.", "Todos los derechos reservados.", "Tous droits réservés.", "Back to the start page."]


def furnished():
    """Pages of four sources that share a footer each, a group of near copies, and a source without a name."""
    prose = lambda k, n: " ".join(f"w{k}x{i} went there." for i in range(n))
    rows = [(100 * s + i, f"{prose(100 * s + i, 30)}\n {line}\n{line}", f"src{s}") for s, line in enumerate(FURNITURE) for i in range(12)]
    body = [prose(9000 + k, 10) for k in range(10)]
    rows += [(1000 + i, "\n".join([*body[: i % 10], f"Copy c{i} was here.", *body[i % 10 :]]), "src0") for i in range(60)]
    rows += [(2000 + i, f"{prose(5000 + i, 30)}\nNo source has a name here.", None) for i in range(6)]
    return rows + [(3000, None, "src1"), (3001, "", None), (3001, "", None), (None, FURNITURE[1] + "\n" + prose(1, 30), "src2")]


def test_boilerplate_is_learnt_in_any_language(spark):
    rows = furnished()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r.source: set(r.lines) for r in Q.recurring_lines(docs, source_col="source").collect()}
    expected = brute_recurring([(s, t) for _, t, s in rows])
    assert found == {s: {Q.line_key(x) for x in lines} for s, lines in expected.items() if lines}
    assert expected["src0"] == {FURNITURE[0]} and expected[None] == {"No source has a name here."}  # no line of the copies
    out = Q.measure_lines(docs, keep=["doc_id", "source"], with_text=True, source_col="source").collect()
    assert len(out) == len(rows)
    texts = {(i, s): t for i, t, s in rows}
    for r in out:
        t = texts[r.doc_id, r.source]
        assert (r.n_lines, r.n_failed_lines, r.n_lost_words, r.kept) == (*(b := brute_lines(t, expected[r.source]))[:3], b[3] and not brute(t)[5])
        assert not any(x in (r.cleaned_text or "") for x in FURNITURE if r.source == f"src{FURNITURE.index(x)}")
    assert all(r.kept for r in out if r.doc_id is not None and r.doc_id < 2000)


def test_long_lists_meet_texts_in_a_shuffle(spark, monkeypatch):
    docs = spark.createDataFrame(furnished(), "doc_id long, text string, source string")
    judged = lambda: sorted(map(str, Q.measure_lines(docs, source_col="source").collect()))
    one = judged()
    monkeypatch.setattr(Q, "LISTED", 0)
    assert judged() == one


def test_query(spark):
    d = "/root/testdata/sf0.01"
    docs = {r.doc_id: (r.source, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    rows = queries()["op7_line_quality"](spark, d).collect()
    assert len(rows) == len(docs)
    recurring = brute_recurring(docs.values())
    for r in rows:
        source, text = docs[r.doc_id]
        same(r, text)
        assert (r.n_lines, r.n_failed_lines, r.n_lost_words, r.kept) == (*(b := brute_lines(text, recurring[source]))[:3], b[3] and not r.base_failed)
    assert 0.8 < sum(r.kept for r in rows) / sum(not r.base_failed for r in rows) < 1
