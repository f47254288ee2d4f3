import hashlib
import math
import random
import re
from collections import defaultdict

from motionframe.llm import secrets as S
from motionframe.llm.queries import queries
from motionframe.session import written

A = re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
KEY = "aB3dE5gH7jK9mN1pQ3sT5vX7"
SCHEMA = "doc_id long, text string, source string, spans int, repo string"


def base(text):
    text = text or ""
    out = [("assign", *m.span()) for m in A.finditer(text) if len(m.group(2)) >= 6]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(out, key=lambda x: (x[1], S.KINDS.index(x[0])))


DOCS = [
    (None, None, None),
    (1, "", "a"),
    (1, "", "a"),
    (2, "my PassWord = 'hunter22' é api_key: abcdef token=ab", "a"),
    (3, "token=token:abcdefgh toKen ſecret=abcdefghi", "b"),
    (4, f"AKIA{'A1' * 8} AKIAAKIASHORT " + "ab12" * 6, None),
    (5, f"key {KEY} here", "a"),
    (5, f"key {KEY} here", "a"),
    (6, f"x{'9'} {KEY}", "b"),
    *[(10 + i, f"sample {KEY[::-1]} and token = exampletoken{i // 9}", f"own{i}") for i in range(6)],
    (50, "w " * 100_000 + KEY + "z", "q"),
]


def test_edges(spark):
    d = spark.createDataFrame([(a, b, c, 1, "r") for a, b, c in DOCS], SCHEMA)
    rows = S.judged(d, ["doc_id", "text"]).collect()
    assert len(rows) == len(DOCS)
    for r in rows:
        assert [(s.kind, s.start, s.end) for s in r.spans if s.kind != "opaque"] == base(r.text)
    opaque = {r.doc_id: [s for s in r.spans if s.kind == "opaque"] for r in rows}
    assert [len(opaque[i]) for i in (5, 6, 10, 50)] == [1, 1, 0, 1]
    assert (opaque[5][0].n_owners, opaque[5][0].n_repos, opaque[5][0].live) == (2, 2, True)
    assert all(s.n_owners == 6 and not s.live for r in rows if r.doc_id in range(10, 16) for s in r.spans if s.kind == "assign")


def test_redact(spark):
    d = spark.createDataFrame([(a, b, c, 1, "r") for a, b, c in DOCS], SCHEMA)
    out = S.redact(d)
    assert out.schema == d.schema and S.redact(d.limit(0)).count() == 0
    rows = {r.doc_id: r for r in out.collect()}
    assert out.count() == len(DOCS)
    assert rows[2].text == "my PassWord = '[secret]' é api_key: [secret] token=ab"
    assert rows[5].text == "key [secret] here" and rows[None].text is None
    assert rows[10].text == DOCS[9][1]


OPAQUE = re.compile("[A-Za-z0-9+/_=-]{20,}")


def entropy(s):
    return -sum(s.count(c) / len(s) * math.log2(s.count(c) / len(s)) for c in set(s))


def opaque(text, taken):
    """Long runs with both cases and digits, outside of the base spans."""
    for m in OPAQUE.finditer(text or ""):
        s = m.group()
        if any(c.islower() for c in s) and any(c.isupper() for c in s) and any(c.isdigit() for c in s) and entropy(s) >= 3.2 and not any(a < m.end() and m.start() < b for _, a, b in taken):
            yield ("opaque", *m.span())


def brute(rows):
    """For each (id, text, owner): its spans as (kind, start, end, owners, repositories, live)."""
    found, owners, repos = [], defaultdict(set), defaultdict(set)
    for _, text, owner in rows:
        spans = base(text)
        spans += opaque(text, spans)
        one = []
        for k, a, b in sorted(spans, key=lambda x: (x[1], S.KINDS.index(x[0]))):
            value = A.match(text, a).group(2) if k == "assign" else text[a:b]
            owners[value].add(owner)
            repos[value].add(text)
            one.append((k, a, b, value))
        found.append(one)
    live = lambda v: len(owners[v]) < 3 and len(repos[v]) <= 10
    return [[(k, a, b, len(owners[v]), len(repos[v]), live(v)) for k, a, b, v in one if k != "opaque" or live(v)] for one in found]


def planted():
    """Values of one to twelve owners, in a few texts or in many."""
    rng = random.Random(4)
    value = lambda: "".join(rng.choice("abcdefgXYZ0123456789") for _ in range(30)) + "aZ9"
    rows = []
    for n in range(260):
        v, owners = value(), 1 if n < 240 else 1 + n % 12
        rows += [(len(rows) + i, f"w{rng.random()} {'token = ' if n % 2 else ''}{v} end", f"own{rng.randrange(9)}{i}") for i in range(owners)]
    rows += [(9000 + i, f"copy {i} {'q1W2' * 8}x", "one") for i in range(14)]
    return rows + [(None, None, None), (None, None, None)]


def test_ownership_against_brute_force(spark):
    rows = planted()
    want = brute(rows)
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {(r.doc_id, r.text): [(s.kind, s.start, s.end, s.n_owners, s.n_repos, s.live) for s in r.spans] for r in S.judged(d, ["doc_id", "text"]).collect()}
    assert got == {r[:2]: w for r, w in zip(rows, want)}
    kinds = {(k, live) for one in want for k, *_, live in one}
    assert {("assign", True), ("assign", False), ("opaque", True)} <= kinds and ("opaque", False) not in kinds
    other = {r.doc_id: [s.live for s in r.spans if s.kind == "assign"] for r in S.judged(d.where("doc_id < 600"), ["doc_id"], corpus=d).collect()}
    assert all(v == [s[5] for s in w if s[0] == "assign"] for (i, *_), w in zip(rows, want) if (v := other.get(i)) is not None)


def test_query(spark):
    d = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{d}/documents.parquet").collect()
    want = brute([(r.doc_id, r.text, r.source) for r in docs])
    rows = {r.doc_id: r for r in queries()["op9_secret_ownership"](spark, d).collect()}
    assert len(rows) == len(docs)
    assert {live for spans in want for k, *_, live in spans if k != "opaque"} == {True, False}  # some base values are copied examples
    for doc, spans in zip(docs, want):
        r, said = rows[doc.doc_id], [":".join(map(str, s[:3])) for s in spans]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[0] == k for s in spans) for k in ("assign", "access", "hex"))
        assert r.base_sha256 == hashlib.sha256(",".join(x for x in said if not x.startswith("opaque")).encode()).hexdigest() and r.spans == ",".join(said)
        assert (r.n_owners, r.n_repos, r.n_live) == (",".join(str(s[3]) for s in spans), ",".join(str(s[4]) for s in spans), sum(s[5] for s in spans))
        classes = ["example" if not s[5] else "shared" if s[3] > 1 else "owner" for s in spans]
        assert r.classes == ",".join(classes)


def test_a_kept_column_of_the_same_name(spark):
    d = spark.createDataFrame([(1, "token = abcdefgh", "o", "mine")], "doc_id long, text string, source string, spans string")
    out = S.judged(d, ["doc_id", "spans"])
    assert out.columns == ["doc_id", "spans"] and len(out.first().spans) == 1


def test_owners_are_not_broadcast(spark, monkeypatch):
    """One row a value, of spans that were exploded: only values of very many rows (10,000 values at most) are."""
    plans = {}

    def spy(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return written(df, name)

    monkeypatch.setattr(S, "written", spy)
    d = spark.createDataFrame(DOCS, SCHEMA.split(", spans")[0])
    for rows in (S.redact(d), S.redact(d, corpus=d), S.judged(d, ["doc_id"])):
        assert "BroadcastHashJoin" not in plans["owners"]
        assert rows._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin") == 2
