"""Line-first cleaning: rules judge each line, failing lines go, and a document that loses too much of its text goes too.

A line fails one of three rules, the first that applies:

- navigation: separators between its words (`|`, `>`, `»`, `›`, `·`, `•`) number at least 3 and at least a quarter of its
  words, as in menus and breadcrumbs;
- boilerplate: at most `SHORT` words, and the line recurs in its source, in any language (below);
- punctuation: no word ends a sentence, or symbols (`#*$%&|<>`) are more than a tenth of its characters without spaces.

Lines without a word never fail; they stay where their neighbours stay. The document's verdict: with words lost above
`max_lost` of all its words, it is rejected. Base counts are those of the whole text, before any line is removed.

Boilerplate is learnt from the table. A line recurs if at least `LEAST` rows and a hundredth of the rows of its source have
it, and these rows are different texts: by each of `DRAWS` least hashes of three-word windows, the commonest text among
them has at most `ALIKE` of the rows on average. In a group of near copies (Jaccard similarity 0.8 and more) that share is
0.89 on average, so the lines of copied documents are no boilerplate; where page furniture is half of each text it is 0.5.
Lines and texts are 64-bit hashes throughout; counts are combined before they are shuffled. Sources' lists reach the texts
by broadcast, so that no text is shuffled but those of sources with less than one in 10,000 rows; should the lists have over
`LISTED` lines, texts meet them in a shuffle of `SALTS` keys a source.

Nulls: a null text has no words and fails the base rules; a null doc_id is carried through; rows with a null source are one
source, and so are all rows where no source is named. Repeated rows are judged one by one, and are one text among those
that have a line. Empty tables give no rows. Columns that are not asked for are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Collection

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motionframe.llm.common import map_rows, positional, restored
from motionframe.llm.skew import join_by_share
from motionframe.session import written

MAX_LOST = 0.5
SHORT = 40
LEAST, PERCENT = 5, 1
DRAWS, ALIKE = 8, 0.75
LISTED, SALTS = 4_000_000, 64
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = re.compile(r"[#*$%&|<>]")
SEPARATORS = re.compile(r"[|>»›·•]")
SENTENCE_END = re.compile(r"[.!?…。！？]+[\"”’»')\]]*(?:[\x20\x09-\x0D]|$)")
_DRAWS = np.arange(1, 2 * DRAWS, 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)  # odd: each is a permutation
FIELDS = [
    ("n_words", pa.int64()),
    ("word_chars", pa.int64()),
    ("n_symbols", pa.int64()),
    ("n_dup_lines", pa.int64()),
    ("n_repeat_words", pa.int64()),
    ("n_lines", pa.int64()),
    ("n_failed_lines", pa.int64()),
    ("n_lost_words", pa.int64()),
]


def line_key(line: str) -> int:
    return xxhash.xxh3_64_intdigest(line.strip()) - 2**63


def rule(line: str, n_words: int, recurring: Collection[int] = ()) -> str | None:
    """The rule that a line with n_words words fails, or None; recurring: keys of its source's boilerplate."""
    separators = len(SEPARATORS.findall(line))
    if separators >= 3 and 4 * separators >= n_words:
        return "navigation"
    if recurring and n_words <= SHORT and line_key(line) in recurring:
        return "boilerplate"
    if not SENTENCE_END.search(line):
        return "punctuation"
    if 10 * len(SYMBOLS.findall(line)) > sum(map(len, WORD.findall(line))):
        return "punctuation"
    return None


def least_hashes(words: list[str]) -> list[int]:
    """DRAWS least hashes of the windows of three words; near copies have most of them in common."""
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if len(h) > 2:
        h = h[:-2] * np.uint64(3) + h[1:-1] * np.uint64(5) + h[2:] * np.uint64(7)
    h ^= h >> np.uint64(31)
    least = np.full(DRAWS, 2**64 - 1, np.uint64)
    for at in range(0, len(h), 4096):
        x = h[at : at + 4096, None] * _DRAWS
        np.minimum(least, (x ^ (x >> np.uint64(29))).min(axis=0), out=least)
    return least.view(np.int64).tolist()


def _short_lines(texts):
    drawn, keys = [], []
    for text in texts:
        lines = {x for x in (text or "").split("\n") if 0 < len(WORD.findall(x)) <= SHORT}
        keys.append(sorted({line_key(x) for x in lines}))
        drawn.append(least_hashes(WORD.findall(text)) if lines else [])
    return drawn, keys


def recurring_lines(docs: DataFrame, text_col: str = "text", source_col: str | None = None) -> DataFrame:
    """For each source, as (source, docs, lines): its rows, and the keys of the lines that recur in it."""
    source = (F.lit(None) if source_col is None else F.col(f"`{source_col}`")).cast("string").alias("source")
    rows = docs.select(source, F.col(f"`{text_col}`").alias("text"))
    rows = written(map_rows(rows, ["source"], ["text"], [("drawn", pa.list_(pa.int64())), ("lines", pa.list_(pa.int64()))], _short_lines), "lines")
    sizes = rows.groupBy("source").agg(F.count(F.lit(1)).alias("docs"))
    seen = rows.select("source", "drawn", F.explode("lines").alias("line"))
    counts = seen.groupBy("source", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST).alias("c")
    often = counts.join(sizes.alias("s"), F.expr("c.source <=> s.source")).where(f"100 * n >= {PERCENT} * docs")
    often = written(often.select("c.source", "line", "n"), "often").alias("o")
    among = seen.alias("a").join(often, F.expr("a.line = o.line and a.source <=> o.source"))
    among = among.select("o.source", "o.line", "n", F.posexplode("drawn").alias("draw", "least"))
    texts = among.groupBy("source", "line", "n", "draw", "least").agg(F.count(F.lit(1)).alias("rows"))
    commonest = texts.groupBy("source", "line", "n", "draw").agg(F.max("rows").alias("rows"))
    found = commonest.groupBy("source", "line", "n").agg(F.sum("rows").alias("rows")).where(F.col("rows") <= F.col("n") * (ALIKE * DRAWS))
    lists = found.groupBy("source").agg(F.sort_array(F.collect_list("line")).alias("lines")).alias("f")
    return sizes.alias("s").join(lists, F.expr("s.source <=> f.source")).select("s.source", "docs", "f.lines")


def repeated_words(words: list[str]) -> int:
    """Words in windows of three that occur at least twice in words."""
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    end = total = 0
    for i, w in enumerate(windows):
        if counts[w] > 1:
            total += i + 3 - max(i, end)
            end = i + 3
    return total


def _judge(texts, recurring, with_text=False):
    cols: list[list] = [[] for _ in FIELDS]
    cleaned = []
    for text, known in zip(texts, recurring):
        known = set(known or ())
        words = WORD.findall(text or "")
        dup = failed = lost = n_lines = 0
        kept, seen = [], set()
        for line in (text or "").split("\n"):
            w = WORD.findall(line)
            if w:
                n_lines += 1
                dup += line in seen
                seen.add(line)
                if rule(line, len(w), known):
                    failed += 1
                    lost += len(w)
                    continue
            kept.append(line)
        for col, v in zip(cols, (len(words), sum(map(len, words)), len(SYMBOLS.findall(text or "")), dup, repeated_words(words), n_lines, failed, lost)):
            col.append(v)
        cleaned.append(None if text is None else "\n".join(kept))
    return (*cols, cleaned) if with_text else cols


def measure_lines(
    docs: DataFrame,
    text_col: str = "text",
    keep: list[str] = ["doc_id"],
    with_text: bool = False,
    max_lost: float = MAX_LOST,
    source_col: str | None = None,
    learn_from: DataFrame | None = None,
) -> DataFrame:
    """The columns `keep`, the base counts, what the line rules removed, base_failed and kept; with_text adds cleaned_text.

    Boilerplate is learnt from `learn_from`, another table with these columns, or from docs themselves.
    """
    fields = [*FIELDS, ("cleaned_text", pa.string())] if with_text else FIELDS
    keep = [c for c in dict.fromkeys(keep) if c not in {n for n, _ in fields}]
    names = [f"__c{i}" for i in range(len(keep))]
    lists = written(recurring_lines(docs if learn_from is None else learn_from, text_col, source_col), "recurring")
    # a null source is a key of its own
    key = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-"))
    source = F.lit(None) if source_col is None else F.col(f"`{source_col}`")
    rows = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(keep, names)), F.col(f"`{text_col}`").alias("__text"), key(source).alias("__source"))
    lists = lists.select(key(F.col("source")).alias("__source"), F.col("docs").alias("__docs"), F.col("lines").alias("__lines"))
    listed = lists.agg(F.coalesce(F.sum(F.size("__lines")), F.lit(0)).alias("n")).first()["n"]
    if listed <= LISTED:
        rows = join_by_share(rows, lists, "__source", docs.count(), "__docs")
    else:
        salted = lists.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = rows.withColumn("__salt", F.pmod(F.xxhash64("__text"), F.lit(SALTS)).cast("int")).join(salted, ["__source", "__salt"], "left")
    rows = map_rows(rows, names, ["__text", "__lines"], fields, lambda texts, known: _judge(texts, known, with_text))
    rows = restored(rows, [*names, *(n for n, _ in fields)], [*keep, *(n for n, _ in fields)])
    base_failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return rows.withColumn("base_failed", base_failed).withColumn("kept", ~base_failed & (F.col("n_lost_words") <= F.col("n_words") * max_lost))


def clean(docs: DataFrame, text_col: str = "text", max_lost: float = MAX_LOST, source_col: str | None = None) -> DataFrame:
    """The documents kept, all columns as they are but for the text, which has lost its failing lines."""
    rows, names = positional(docs)
    text = names[docs.columns.index(text_col)]
    source = None if source_col is None else names[docs.columns.index(source_col)]
    kept = measure_lines(rows, text, [n for n in names if n != text], with_text=True, max_lost=max_lost, source_col=source).where("kept")
    return restored(kept.withColumn(text, F.col("cleaned_text")), names, docs.columns)
