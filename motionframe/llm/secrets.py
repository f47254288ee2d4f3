"""Secret scans with corpus-wide ownership: who else has the same candidate?

Candidates in a text are spans of the base patterns (assign, access, hex) and, outside of those, `opaque` runs: 20 or more
characters of `[A-Za-z0-9+/_=-]` with lower and upper case letters, digits and at least 3.2 bits of entropy a
character. Each candidate's value is hashed; hashes are counted over the corpus by distinct repositories and owners.
A value is of one of three classes:

- `example`: `WIDE` owners or more have it, or it is in more than `MAX_REPOS` repositories: widely copied, as values of
  documentation and tests are; not live;
- `shared`: of the others, those with several owners; as a credential that leaked or is passed on may be, it counts as live;
- `owner`: one owner has it; a live-looking credential of its own.

The corpus may be another table than the one that is judged: ownership is counted where the copies are, before
duplicates are removed. A value that the corpus does not have has one owner.

Base spans are reported always, with their status; opaque ones are reported only where they are live-looking, for there
the pattern alone says too little. The value of an assign span is its group 2.

In `documents` a row's source is its owner, and its text's digest stands for the repository: copies of one file are one
repository, whoever holds it.

Nulls: a null text is empty; a null owner is one owner of its own. Repeated rows are one owner and one repository, and
each has its spans. Empty tables give empty results. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motionframe.llm.common import map_rows, positional, restored
from motionframe.llm.skew import join_by_share, join_sorted
from motionframe.session import written

#: Owners from which on, and repositories beyond which, a value is a widely copied example.
WIDE, MAX_REPOS = 3, 10
KINDS = ("assign", "access", "hex", "opaque")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal, so this is [0-9a-f]+ with at least 24
_OPAQUE = re.compile(r"[A-Za-z0-9+/_=-]+")
_OPAQUE_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")
_DIGIT = re.compile("[0-9]")
CANDIDATES = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("from", pa.int64()), ("hash", pa.string())]))


def entropy(s: str) -> float:
    n = len(s)
    return -sum(c / n * math.log2(c / n) for c in Counter(s).values())


def candidates(text: str) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, start of the value) by start, then kind; the value ends where the span ends."""
    out = []
    low = text.lower()
    if any(k in low for k in ("passw", "secret", "token", "apikey", "api_key")):
        out += [("assign", m.start(), m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", m.start(), m.end(), m.start()) for m in HEX.finditer(text)]
    base = [(a, b) for _, a, b, _ in out]
    end = 0
    for m in _DIGIT.finditer(text):  # each maximal run that has a digit
        if m.start() < end:
            continue
        start, end = m.start(), _OPAQUE.match(text, m.start()).end()
        while start and text[start - 1] in _OPAQUE_CHARS:
            start -= 1
        s = text[start:end]
        if len(s) >= 20 and re.search("[a-z]", s) and re.search("[A-Z]", s) and entropy(s) >= 3.2 and not any(a < end and start < b for a, b in base):
            out.append(("opaque", start, end, start))
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def _scan(texts):
    found, repos = [], []
    for text in texts:
        got = candidates(text) if text else []
        found.append([{"kind": k, "start": a, "end": b, "from": v, "hash": hashlib.sha256(text[v:b].encode()).hexdigest()} for k, a, b, v in got])
        repos.append(hashlib.sha256(text.encode()).hexdigest() if got else None)
    return found, repos


def scan(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns `keep`, candidates and, where there are any, repo."""
    return map_rows(docs, keep, [text_col], [("candidates", CANDIDATES), ("repo", pa.string())], _scan)


def ownership(scanned: DataFrame, owner_col: str = "source") -> DataFrame:
    """For each hash: its distinct repositories and owners, and its spans."""
    one = scanned.select(F.explode("candidates.hash").alias("hash"), F.coalesce(F.concat(F.lit("="), F.col(owner_col)), F.lit("")).alias("owner"), "repo")
    by_owner = one.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("n"))
    by_repo = one.groupBy("hash", "repo").agg(F.lit(1).alias("n"))
    owners = by_owner.groupBy("hash").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("n").alias("n_spans"))
    return written(join_sorted(owners, by_repo.groupBy("hash").agg(F.sum("n").alias("n_repos")), "hash"), "owners")


def ownership_class(wide: int = WIDE, max_repos: int = MAX_REPOS) -> Column:
    return F.when((F.col("n_owners") >= wide) | (F.col("n_repos") > max_repos), "example").when(F.col("n_owners") > 1, "shared").otherwise("owner")


def _each(seen: DataFrame, corpus: DataFrame | None, owner_col: str, text_col: str, wide: int) -> DataFrame:
    """The candidates of seen, one a row: __id, c, n_owners, n_repos, class and live. corpus: None counts seen itself."""
    counted = seen if corpus is None else scan(corpus.select(F.col(owner_col).alias("__owner"), F.col(text_col).alias("__text")), ["__owner"], "__text")
    owners = ownership(counted, "__owner")
    each = written(seen.select("__id", F.explode("candidates").alias("c")).withColumn("hash", F.col("c.hash")), "spans")
    found = join_by_share(each, owners, "hash", each.count(), "n_spans")
    own = lambda c: F.coalesce(F.col(c), F.lit(1)).alias(c)  # noqa: E731  a value that the corpus does not have
    return found.select("__id", "c", own("n_owners"), own("n_repos")).withColumn("class", ownership_class(wide)).withColumn("live", F.col("class") != "example")


def judged(docs: DataFrame, keep: list[str], owner_col: str = "source", text_col: str = "text", wide: int = WIDE, corpus: DataFrame | None = None) -> DataFrame:
    """The columns `keep` and spans: array of (kind, start, end, from, hash, n_owners, n_repos, class, live), by start and kind.

    The scanned rows are written once, so that row ids hold when an executor is lost; only rows with candidates take
    part in the joins.
    """
    q = [F.col(f"`{c}`") for c in keep]
    packed = docs.select(F.struct(*q).alias("__row"), F.col(owner_col).alias("__owner"), F.col(text_col).alias("__text"))
    seen = written(scan(packed, ["__row", "__owner"], "__text").withColumn("__id", F.monotonically_increasing_id()), "secrets")
    each = _each(seen, corpus, owner_col, text_col, wide)
    each = each.where((F.col("c.kind") != "opaque") | F.col("live"))
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("c.kind"))
    span = F.struct(F.col("c.start").alias("start"), rank.alias("rank"), F.col("c.end").alias("end"), F.col("c.kind").alias("kind"), F.col("c.from").alias("from"), F.col("c.hash").alias("hash"), "n_owners", "n_repos", "class", "live")
    spans = each.groupBy("__id").agg(F.array_sort(F.collect_list(span)).alias("spans"))  # of one text
    kept = [F.col(f"__row.`{c}`") for c in keep if c != "spans"]  # of that name the computed one stays
    return join_sorted(seen, spans, "__id", "left").select(*kept, F.coalesce("spans", F.array().cast(spans.schema["spans"].dataType)).alias("spans"))


def _masked(texts, spans):
    out = []
    for text, found in zip(texts, spans):
        parts, at = [], 0
        for a, b in sorted((s["from"], s["end"]) for s in found):
            if a >= at:
                parts += [text[at:a], "[secret]"]
            at = max(at, b)
        out.append("".join(parts) + text[at:] if found else text)
    return (out,)


def redact(docs: DataFrame, owner_col: str = "source", text_col: str = "text", wide: int = WIDE, corpus: DataFrame | None = None) -> DataFrame:
    """docs with the values of live-looking candidates replaced by `[secret]`; no row goes, and all columns stay.

    The scanned rows are written once; those with candidates are joined by row id.
    """
    rows, names = positional(docs)
    owner, text = (names[docs.columns.index(c)] for c in (owner_col, text_col))
    seen = written(scan(rows, names, text).withColumn("__id", F.monotonically_increasing_id()), "secrets")
    clean = seen.where(F.size("candidates") == 0).select(*names)
    some = seen.where(F.size("candidates") > 0).withColumn("__owner", F.col(owner))
    each = _each(some, corpus, owner_col, text_col, wide).where("live")
    spans = each.groupBy("__id").agg(F.collect_list(F.struct(F.col("c.from").alias("from"), F.col("c.end").alias("end"))).alias("spans"))
    hit = join_sorted(some, spans, "__id", "left").withColumn("spans", F.coalesce("spans", F.array().cast(spans.schema["spans"].dataType)))
    masked = map_rows(hit, [n for n in names if n != text], [text, "spans"], [(text, pa.string())], _masked)
    return restored(clean.unionByName(masked), names, docs.columns)
