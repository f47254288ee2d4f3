"""Licence scans with a positional index of rare words; DataFrame functions alone.

A template is a notice, a sequence of words, with mandatory key phrases, given in brackets. Words are the maximal runs of
digits, letters (A-Z lower-cased, no other letter is) and characters beyond ASCII.

- Index: of each key phrase, the word that the fewest documents of the corpus hold (the highest IDF) is its anchor, the next
  its second; the index has a posting (anchor, place in the phrase, second, its place). Equal counts: the word that is first
  in the alphabet.
- Look-up: a text's words that are anchors, with their places, meet the postings. A posting gives the place where the phrase
  would start; the second rare word must stand at its own relative place, then all the phrase's words are compared. What
  is left are the phrase's places, all of them: each holds its anchor.
- Verification: a template is found where its first key phrase stands and each of its other key phrases stands within `SLACK`
  words of its relative place. Its score there is the share of the template's words that stand in their place, taken
  relative to the key phrase before them. A document's score is the highest of its templates', 0 without any.

Base labels are templates of one phrase; their places are counted.

Two passes over the texts: one counts documents for each word of the key phrases, one looks up. Neither joins nor shuffles
texts; what is shuffled are counts of the phrases' words. A text without an anchor costs its splitting into words.

A null text is empty and an empty text has no words; both have no labels and score 0. Repeated rows are judged one by one and
each counts for the IDF. Empty tables give no rows. Columns that are not asked for are not read, and the names of those
that are do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLACK = 8
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Base phrases and their labels.
BASE = [
    ("cc-by", "[cc by]"),
    ("gpl", "[general public license]"),
    ("reserved", "[all rights reserved]"),
]
# Labels and notices of public licences, key phrases in brackets.
NOTICES = [
    ("agpl-3.0", "[gnu affero general public license]"),
    ("apache-2.0", "licensed under the [apache license version 2 0]"),
    ("apache-2.0", "you may not use this file except in [compliance with the license] you may obtain a copy of the license at http [www apache org licenses license 2 0]"),
    ("artistic-2.0", "[artistic license 2 0]"),
    ("boost-1.0", "distributed under the [boost software license version 1 0]"),
    ("bsd", "[redistribution and use in source and binary forms] with or without modification are permitted [provided that the following conditions are met]"),
    ("bsd", "[bsd license]"),
    ("cc-by-4.0", "licensed under [cc by 4 0]"),
    ("cc-by-4.0", "[creative commons attribution 4 0 international]"),
    ("cc-by-nc-4.0", "licensed under [cc by nc 4 0]"),
    ("cc-by-nc-nd-4.0", "licensed under [cc by nc nd 4 0]"),
    ("cc-by-nc-sa-4.0", "licensed under [cc by nc sa 4 0]"),
    ("cc-by-nd-4.0", "licensed under [cc by nd 4 0]"),
    ("cc-by-sa-4.0", "licensed under [cc by sa 4 0]"),
    ("cc0-1.0", "[cc0 1 0 universal]"),
    ("epl-2.0", "[eclipse public license v 2 0]"),
    ("gpl-2.0", "[gnu general public license version 2]"),
    ("gpl-3.0", "this work is licensed under the [gnu general public license version 3]"),
    ("gpl-or-later", "[this program is free software] you can redistribute it and or modify it under the terms of the [gnu general public license]"),
    ("isc", "[permission to use copy modify and or distribute this software for any purpose] with or without fee is hereby granted"),
    ("lgpl", "[gnu lesser general public license]"),
    ("mit", "released under the [mit license]"),
    ("mit", "[permission is hereby granted free of charge] to any person obtaining a copy of this software and associated documentation files the software [to deal in the software without restriction]"),
    ("mpl-2.0", "this source code form is subject to the terms of the [mozilla public license v 2 0]"),
    ("unlicense", "[this is free and unencumbered software released into the public domain]"),
]


@dataclass(frozen=True)
class Template:
    label: str
    notice: str
    base: bool = False
    words: list[str] = field(default_factory=list, compare=False)
    #: (start in words, words of the key phrase)
    phrases: list[tuple[int, tuple[str, ...]]] = field(default_factory=list, compare=False)

    def __post_init__(self) -> None:
        start = None
        for w in self.notice.split():
            if w.startswith("["):
                start = len(self.words)
            self.words.append(w.strip("[]"))
            if w.endswith("]"):
                self.phrases.append((start, tuple(self.words[start:])))

    @cached_property
    def followers(self) -> list[tuple[int, int, str]]:
        """Of each word outside of key phrases: the key phrase it is placed by, its place from that phrase's start, and itself."""
        inside = {i for s, p in self.phrases for i in range(s, s + len(p))}
        by = lambda i: max([k for k, (s, _) in enumerate(self.phrases) if s < i], default=0)
        return [(by(i), i - self.phrases[by(i)][0], w) for i, w in enumerate(self.words) if i not in inside]


TEMPLATES = [Template(*b, base=True) for b in BASE] + [Template(*n) for n in NOTICES]


def words_of(text: Column) -> Column:
    """The words of a text. Two letters beyond A-Z have lower-case forms with ASCII letters: texts with them go letter by letter."""
    text = F.coalesce(text, F.lit(""))
    odd = F.contains(text, F.lit("\u0130")) | F.contains(text, F.lit("\u212a"))
    lower = F.when(odd, F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))
    return F.array_remove(F.split(lower, NOT_WORD), "")


def document_counts(words: DataFrame, words_col: str, templates: list[Template]) -> dict[str, int]:
    """In how many rows each word of the key phrases stands; the driver gets one number a word."""
    known = sorted({w for t in templates for _, p in t.phrases for w in p})
    each = words.select(F.explode(F.array_intersect(words_col, F.array(*map(F.lit, known)))).alias("word"))
    found = {r["word"]: r["count"] for r in each.groupBy("word").count().collect()}
    return {w: found.get(w, 0) for w in known}


@dataclass(frozen=True)
class Posting:
    phrase: tuple[str, ...]
    anchor: str
    at: int
    second: str
    second_at: int


def postings(templates: list[Template], counts: dict[str, int]) -> list[Posting]:
    """One for each distinct key phrase, in alphabetical order."""
    out = []
    for phrase in sorted({p for t in templates for _, p in t.phrases}):
        anchor, second, *_ = [*sorted(set(phrase), key=lambda w: (counts.get(w, 0), w)), *phrase]
        out.append(Posting(phrase, anchor, phrase.index(anchor), second, phrase.index(second)))
    return out


def places(words: Column, index: list[Posting]) -> Column:
    """Places of key phrases: array of (phrase, its number in index, and start, the place of its first word from 0)."""
    anchors = sorted({p.anchor for p in index})
    table = F.array(
        *(
            F.struct(
                F.lit(i).alias("phrase"),
                F.lit(anchors.index(p.anchor) + 1).alias("anchor"),
                F.lit(p.at).alias("at"),
                F.lit(p.second).alias("second"),
                F.lit(p.second_at).alias("second_at"),
                F.array(*map(F.lit, p.phrase)).alias("words"),
            )
            for i, p in enumerate(index)
        )
    )
    known = F.array(*map(F.lit, anchors))
    hits = F.filter(F.transform(words, lambda w, i: F.struct(i.alias("i"), F.array_position(known, w).alias("anchor"))), lambda h: h["anchor"] > 0)

    def looked_up(hit: Column) -> Column:
        met = F.filter(table, lambda p: p["anchor"] == hit["anchor"])
        return F.transform(met, lambda p: F.struct(p["phrase"].alias("phrase"), (hit["i"] - p["at"]).alias("start"), p["second"].alias("second"), p["second_at"].alias("second_at"), p["words"].alias("words")))

    def agrees(p: Column) -> Column:
        fits = (p["start"] >= 0) & (p["start"] + F.size(p["words"]) <= F.size(words))
        return fits & (F.get(words, p["start"] + p["second_at"]) == p["second"]) & (F.slice(words, F.greatest(p["start"], F.lit(0)) + 1, F.size(p["words"])) == p["words"])

    found = F.filter(F.flatten(F.transform(hits, looked_up)), agrees)
    some = F.transform(found, lambda p: F.struct(p["phrase"].alias("phrase"), p["start"].alias("start")))
    none = F.array().cast("array<struct<phrase:int,start:int>>")
    return F.when(F.arrays_overlap(words, known), some).otherwise(none)


def _score(words: Column, found: Column, template: Template, number: dict[tuple[str, ...], int]) -> Column:
    """The template's highest score in a text; null where it is not found."""
    total = len(template.words)
    mandatory = sum(len(p) for _, p in template.phrases)
    (first, phrase), *others = template.phrases

    def near(start: Column, k: int) -> Column:
        """Places of key phrase k that suit the first one's start."""
        at, p = template.phrases[k]
        return F.filter(found, lambda q: (q["phrase"] == number[p]) & (F.abs(q["start"] - start - (at - first)) <= SLACK))

    def scored(p: Column) -> Column:
        begin = [p["start"], *(F.array_min(F.transform(near(p["start"], k), lambda q: q["start"])) for k in range(1, len(others) + 1))]
        stand = sum((F.coalesce((F.get(words, begin[k] + off) == w).cast("int"), F.lit(0)) for k, off, w in template.followers), F.lit(0))
        whole = F.lit(True)
        for b in begin[1:]:
            whole = whole & b.isNotNull()
        return F.when(whole, (stand + mandatory) / F.lit(float(total)))

    return F.array_max(F.transform(F.filter(found, lambda p: p["phrase"] == number[phrase]), scored))


def scan(docs: DataFrame, keep: list[str], text_col: str = "text", templates: list[Template] = TEMPLATES, corpus: DataFrame | None = None) -> DataFrame:
    """The columns `keep`, n_words, base_starts (places of base phrases, ascending), base_labels, labels (sorted arrays) and score.

    corpus: where documents are counted for the IDF, with the same text_col; None is docs itself.
    """
    kept = [F.col(f"`{c}`").alias(f"__keep{i}") for i, c in enumerate(keep)]
    counts = document_counts((docs if corpus is None else corpus).select(words_of(F.col(text_col)).alias("__words")), "__words", templates)
    index = postings(templates, counts)
    number = {p.phrase: i for i, p in enumerate(index)}
    words = docs.select(*kept, words_of(F.col(text_col)).alias("__words"))
    found = words.withColumn("__found", places(F.col("__words"), index))
    base = {number[p]: t.label for t in templates if t.base for _, p in t.phrases}
    none = F.array().cast("array<struct<label:string,score:double>>")
    scores = [F.struct(F.lit(t.label).alias("label"), _score(F.col("__words"), F.col("__found"), t, number).alias("score")) for t in templates]
    some = F.filter(F.array(*scores), lambda s: s["score"].isNotNull())
    judged = found.select(
        *(f"__keep{i}" for i in range(len(keep))),
        F.size("__words").cast("long").alias("n_words"),
        F.filter("__found", lambda p: p["phrase"].isin(*base)).alias("__base"),
        F.when(F.size("__found") > 0, some).otherwise(none).alias("__scores"),
    )
    label = F.create_map(*(x for i, v in base.items() for x in (F.lit(i), F.lit(v))))
    return judged.select(
        *(F.col(f"__keep{i}").alias(c) for i, c in enumerate(keep)),
        "n_words",
        F.sort_array(F.transform("__base", lambda p: p["start"].cast("long"))).alias("base_starts"),
        F.array_sort(F.array_distinct(F.transform("__base", lambda p: F.element_at(label, p["phrase"])))).alias("base_labels"),
        F.array_sort(F.array_distinct(F.transform("__scores", lambda s: s["label"]))).alias("labels"),
        F.coalesce(F.array_max(F.transform("__scores", lambda s: s["score"])), F.lit(0.0)).alias("score"),
    )


def sql() -> str:
    """The query's rows in SQL, from the templates' definition: every place of a text is tried, there is no index."""
    phrases = sorted({p for t in TEMPLATES for _, p in t.phrases})
    name = {p: f"p{i}" for i, p in enumerate(phrases)}
    stands = lambda p: " AND ".join(f"w[i + {k + 1}] = '{x}'" for k, x in enumerate(p))
    starts = ",\n  ".join(f"list_filter(range(greatest(len(w) - {len(p) - 1}, 0)), lambda i: {stands(p)}) AS {name[p]}" for p in phrases)

    def score(t: Template) -> str:
        (first, phrase), *others = t.phrases
        begin = ["s"] + [f"list_min(list_filter({name[p]}, lambda q: abs(q - s - {at - first}) <= {SLACK}))" for at, p in others]
        stand = "".join(f" + coalesce((CASE WHEN {begin[k]} + {off} >= 0 THEN w[{begin[k]} + {off + 1}] END = '{x}')::INT, 0)" for k, off, x in t.followers)
        whole = " AND ".join(["true", *(f"{b} IS NOT NULL" for b in begin[1:])])
        return f"list_max(list_transform({name[phrase]}, lambda s: CASE WHEN {whole} THEN ({sum(len(p) for _, p in t.phrases)}{stand}) / {float(len(t.words))} END))"

    base = [t for t in TEMPLATES if t.base]
    base_starts = " || ".join(name[t.phrases[0][1]] for t in base)
    base_labels = ", ".join(f"CASE WHEN len({name[t.phrases[0][1]]}) > 0 THEN '{t.label}' END" for t in base)
    scores = ",\n  ".join(f"{score(t)} AS s{i}" for i, t in enumerate(TEMPLATES))
    labels = ", ".join(f"CASE WHEN s{i} IS NOT NULL THEN '{t.label}' END" for i, t in enumerate(TEMPLATES))
    joined = lambda of: f"array_to_string(list_sort(list_distinct(list_filter([{of}], lambda x: x IS NOT NULL))), ',')"
    return f"""
WITH words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents),
found AS (SELECT doc_id, w,
  {starts}
FROM words),
scored AS (SELECT *, {base_starts} AS base,
  {scores}
FROM found)
SELECT doc_id, len(w)::BIGINT AS n_words, len(base)::BIGINT AS n_base, list_min(base)::BIGINT AS first_word, list_max(base)::BIGINT AS last_word,
  {joined(base_labels)} AS base_labels, {joined(labels)} AS labels,
  coalesce(list_max([{", ".join(f"s{i}" for i in range(len(TEMPLATES)))}]), 0.0)::DOUBLE AS score
FROM scored
"""
