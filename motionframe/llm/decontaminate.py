"""Benchmark decontamination: one Aho-Corasick automaton over the windows of all test items, one scan of each text.

Texts and items are normalised alike: A-Z becomes a-z, every other ASCII character that is no letter or digit separates
words. A window is `window` consecutive words of an item; an item with fewer words, but not none, is one window. A word
of a document is hit if it lies in an occurrence of a window. Word positions are mapped back to code points of the
original text.

The automaton's patterns are the short items and, of longer ones, every `(window + 1) // 2` words in a row: each window
holds one of these blocks whole, so the automaton is no larger than the items. Where a block occurs, the document's
windows around it are looked up among the items' windows, once each. Patterns start and end with a space, so that they
only match whole words.

A worker holds `BLOCK_BYTES` of item text (about 80 bytes of memory each). A larger benchmark is narrowed first. Its
patterns' hashes make a Bloom filter, `FILTER_BITS` bits at most whatever the benchmark, and a pass over the texts notes
which hashes each text may have. Texts that may have none are done. Items of which no hash was noted occur nowhere; those
that are left, and no others, reach the driver and the automaton, which scans the texts that are left. Where even these
items are more than a worker holds, they are taken piece after piece over those texts; the driver has one piece at a
time. What the filter lets through by chance costs time and changes no result.

Nulls: a null text has no words and is not contaminated; a null doc_id is carried through; items with a null text or
without words have no windows, and an item with a null id is left out of the list of ids but its windows do hit. Repeated
rows are judged one by one; repeated items count once for each distinct id. Extra columns of either table are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motionframe.llm.common import SPANS, map_rows, positional, restored
from motionframe.llm.skew import join_sorted
from motionframe.session import written

WINDOW = 13
BLOCK_BYTES = 4 << 20
FILTER_BITS, BITS_A_KEY, PROBES = 1 << 28, 32, 8
#: Bytes that separate words become spaces, A-Z become a-z; bytes of other letters stay.
NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_WORD = re.compile(rb"[^ ]+")
FIELDS = [("n_words", pa.int64()), ("n_hit", pa.int64()), ("item_ids", pa.list_(pa.string())), ("spans", SPANS)]


def words(text: str) -> list[bytes]:
    return text.encode().translate(NORMAL).split()


def patterns(w: list[bytes], window: int) -> list[tuple[int, int]]:
    """(first word, number of words) of the patterns that stand for an item: its blocks, or all of a short one."""
    block = (window + 1) // 2
    if len(w) < window:
        return [(0, len(w))] if w else []
    return [(i, block) for i in range(0, len(w) - block + 1, block)]


class Items:
    """The windows of items (id, text), and an automaton that finds where a text may have them."""

    def __init__(self, items: list[tuple[str | None, str]], window: int = WINDOW):
        self.window, self.block = window, (window + 1) // 2
        self.ids: list[str | None] = []
        self.windows: dict[bytes, int | list[int]] = {}  # numbers of the items that have it
        short: dict[bytes, int] = {}
        blocks: set[bytes] = set()
        for item_id, text in items:
            w = words(text)
            if not w:
                continue
            k = len(self.ids)
            self.ids.append(item_id)
            for i in range(max(1, len(w) - window + 1)):
                self._add(b" ".join(w[i : i + window]), k)
            found = [b" ".join(w[i : i + n]) for i, n in patterns(w, window)]
            if len(w) < window:
                short[found[0]] = len(w)
            else:
                blocks.update(found)
        self.automaton = ahocorasick.Automaton()
        for p in short.keys() | blocks:
            self.automaton.add_word(f" {p.decode('latin-1')} ", (short.get(p, 0), p in blocks))
        if self.ids:
            self.automaton.make_automaton()

    def _add(self, key: bytes, k: int) -> None:
        had = self.windows.get(key)
        if had is None:
            self.windows[key] = k
        elif isinstance(had, int):
            self.windows[key] = [had, k] if had != k else had
        elif had[-1] != k:
            had.append(k)

    def find(self, w: list[bytes]) -> Iterator[tuple[int, int, int | list[int]]]:
        """(first word, last word + 1, item numbers) of each window that the words have."""
        starts, seen = None, 0
        for end, (size, is_block) in self.automaton.iter((b" " + b" ".join(w) + b" ").decode("latin-1")):
            if starts is None:
                starts = np.cumsum([1] + [len(x) + 1 for x in w])  # where words start; the last is the end
            last = int(np.searchsorted(starts, end, side="left"))
            if size:
                yield last - size, last, self.windows[b" ".join(w[last - size : last])]
            if is_block:
                for i in range(max(seen, last - self.window), min(last - self.block, len(w) - self.window) + 1):
                    found = self.windows.get(b" ".join(w[i : i + self.window]))
                    if found is not None:
                        yield i, i + self.window, found
                seen = max(seen, last - self.block + 1)


def _scan(items: Items, texts, *known):
    """n_words, hit word ranges (flat: start, end, ...) and ids of each text, added to those that earlier pieces gave."""
    counts, ranges, ids = [], [], []
    old = zip(*known) if known else ((None, [], []) for _ in texts)
    for text, (_, had, had_ids) in zip(texts, old):
        w = words(text) if text is not None else []
        counts.append(len(w))
        hits, got = list(had), set()
        if w and items.ids:
            for a, b, of in items.find(w):
                if len(hits) > 1 and hits[-2] <= a <= hits[-1]:
                    hits[-1] = max(hits[-1], b)
                else:
                    hits += [a, b]
                got.update((of,) if isinstance(of, int) else of)
        ranges.append(hits)
        ids.append(sorted({x for k in got if (x := items.ids[k]) is not None}.union(had_ids)))
    return counts, ranges, ids


def _spans(texts, counts, ranges, ids):
    n_hit, spans = [], []
    for text, hits in zip(texts, ranges):
        merged: list[list[int]] = []
        for a, b in sorted(zip(hits[::2], hits[1::2])):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        n_hit.append(sum(b - a for a, b in merged))
        if merged:
            raw = text.encode()
            at = [m.span() for m in _WORD.finditer(raw.translate(NORMAL))]
            chars = lambda n: len(raw[:n].decode())
            spans.append([{"kind": "benchmark", "start": chars(at[a][0]), "end": chars(at[b - 1][1])} for a, b in merged])
        else:
            spans.append([])
    return counts, n_hit, ids, spans


def distinct_items(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item, as a string, and text of the items that have a text."""
    return benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text")).where(F.col("text").isNotNull()).distinct()


def item_pieces(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[str | None, str]]]:
    """The items, about block_bytes of text at a time, in an order that does not depend on partitions; one piece at least."""
    piece: list[tuple[str | None, str]] = []
    size = 0
    for r in items.orderBy("item", "text").toLocalIterator(prefetchPartitions=False):
        if size > block_bytes:
            yield piece
            piece, size = [], 0
        piece.append((r["item"], r["text"]))
        size += len(r["text"].encode())
    yield piece


_ODD = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(w: list[bytes], lengths: set[int]) -> Iterator[tuple[int, np.ndarray]]:
    """For each of the lengths that the words have: it and the hashes of all runs of so many words, by first word."""
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, w), dtype=np.uint64, count=len(w))
    run = one.copy()
    for n in range(1, min(max(lengths, default=0), len(w)) + 1):
        if n > 1:
            run = run[:-1] * _ODD + one[n - 1 :]
        if n in lengths:
            h = (run ^ (run >> np.uint64(31))) * (_ODD ^ np.uint64(n << 1))
            yield n, h ^ (h >> np.uint64(29))


class Filter:
    """Which of an array of hashes may be keys: a Bloom filter in 64-bit words, their number a power of two."""

    def __init__(self, cells: np.ndarray):
        self.cells, self.mask = cells, np.uint64(64 * len(cells) - 1)

    def may_have(self, hashes: np.ndarray) -> np.ndarray:
        left = hashes
        for i in range(PROBES):
            at = ((left & self.mask) + np.uint64(i) * ((left >> np.uint64(32)) | np.uint64(1))) & self.mask
            left = left[(self.cells[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1]
        return np.unique(left)


def filter_cells(keys: DataFrame, n_keys: int, most_bits: int = FILTER_BITS) -> np.ndarray:
    """The filter of the column hash, made where the keys are; only its cells, most_bits in all at most, come to the driver."""
    bits = 1 << 10
    while bits < min(BITS_A_KEY * n_keys, most_bits):
        bits *= 2
    h, mask = F.col("hash"), F.lit(bits - 1)
    step = F.shiftrightunsigned(h, 32).bitwiseOR(F.lit(1))
    at = F.explode(F.array(*((h.bitwiseAND(mask) + i * step).bitwiseAND(mask) for i in range(PROBES))))
    cell = F.shiftright("at", 6).alias("cell")
    bit = F.expr("shiftleft(1L, cast(at & 63 AS int))")
    rows = keys.select(at.alias("at")).groupBy(cell).agg(F.bit_or(bit).alias("bits")).toArrow()
    cells = np.zeros(bits // 64, np.uint64)
    cells[rows.column("cell").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return cells


def narrowed(rows: DataFrame, items: DataFrame, text: str, window: int) -> tuple[DataFrame, DataFrame]:
    """rows with n_words and __hits, the hashes of items' patterns that the text may have; and the items that may occur."""
    lengths_of = lambda w: {n for _, n in patterns(w, window)}

    def item_keys(texts):
        hashes, lengths = [], []
        for t in texts:
            w = words(t)
            by_length = dict(gram_hashes(w, lengths_of(w)))
            hashes.append(np.unique(np.array([by_length[n][i] for i, n in patterns(w, window)], np.uint64)).view(np.int64))
            lengths.append(max(by_length, default=0))
        return hashes, lengths

    numbered = written(items.withColumn("n", F.monotonically_increasing_id()), "items")
    fields = [("hashes", pa.list_(pa.int64())), ("length", pa.int64())]
    keyed = written(map_rows(numbered, ["n"], ["text"], fields, item_keys), "keys")
    keys = keyed.select("n", F.explode("hashes").alias("hash"))
    lengths = {r["length"] for r in keyed.select("length").distinct().collect()} - {0}  # none is above the window
    spark = rows.sparkSession
    held = spark.sparkContext.broadcast(filter_cells(keys, keyed.agg(F.coalesce(F.sum(F.size("hashes")), F.lit(0))).first()[0]))

    def setup():
        return Filter(held.value)

    def look(known, texts):
        counts, hits = [], []
        for t in texts:
            w = words(t) if t is not None else []
            counts.append(len(w))
            found = [known.may_have(h) for _, h in gram_hashes(w, lengths)]
            hits.append(np.concatenate(found).view(np.int64) if found else [])
        return counts, hits

    columns = list(dict.fromkeys([*rows.columns, text]))
    looked = written(map_rows(rows, columns, [text], [("n_words", pa.int64()), ("__hits", pa.list_(pa.int64()))], look, setup), "looked")
    held.destroy()
    seen = looked.select(F.explode("__hits").alias("hash")).distinct()
    occur = join_sorted(keys, seen, "hash", "left_semi").select("n").distinct()
    return looked, join_sorted(numbered, occur, "n", "left_semi").select("item", "text")


def scan_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW, keep: list[str] = ["doc_id"], block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """For each row of docs: the columns `keep`, then n_words, n_hit, item_ids (sorted) and spans in the original text."""
    keep = [c for c in dict.fromkeys(keep) if c not in {n for n, _ in FIELDS}]
    names = [f"__c{i}" for i in range(len(keep))]  # as clashing names must not meet
    text = names[keep.index(text_col)] if text_col in keep else "__text"
    rows = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(keep, names)), *([] if text in names else [F.col(f"`{text_col}`").alias(text)]))
    items = distinct_items(benchmark)
    done = None
    if (items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) > block_bytes:
        looked, items = narrowed(rows, items, text, window)
        none = [F.lit(0).cast("bigint").alias("n_hit"), F.expr("cast(array() AS array<string>)").alias("item_ids"), F.expr("cast(array() AS array<struct<kind:string,start:bigint,end:bigint>>)").alias("spans")]
        done = looked.where(F.size("__hits") == 0).select(*names, "n_words", *none)
        rows = looked.where(F.size("__hits") > 0).select(*rows.columns)
    out = _scanned(rows, items, text, names, window, block_bytes)
    out = out if done is None else out.unionByName(done)
    return out.select(*(F.col(n).alias(c) for c, n in zip(keep, names)), *(n for n, _ in FIELDS))


def _scanned(rows: DataFrame, items: DataFrame, text: str, names: list[str], window: int, block_bytes: int) -> DataFrame:
    """The columns names and FIELDS of rows, by one automaton, or by one for each piece of the items."""
    state = [("__words", pa.int64()), ("__ranges", pa.list_(pa.int64())), ("__ids", pa.list_(pa.string()))]
    pieces = item_pieces(items, block_bytes)
    piece, known = next(pieces), []
    while True:
        after = next(pieces, None)
        held = rows.sparkSession.sparkContext.broadcast(piece)

        def setup(held=held):
            return Items(held.value, window)

        def step(items, texts, *known, last=after is None):
            out = _scan(items, texts, *known)
            return _spans(texts, *out) if last else out

        if after is None:
            return map_rows(rows, names, [text, *known], FIELDS, step, setup)
        rows = written(map_rows(rows, [*names, text], [text, *known], state, step, setup), "scanned")
        held.destroy()
        piece, known = after, [n for n, _ in state]


def is_contaminated(n_hit: Column, n_words: Column, percent: int = 5) -> Column:
    """A document is contaminated if at least `percent` of its words are hit."""
    return (n_hit > 0) & (n_hit * 100 >= n_words * percent)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """docs without its contaminated rows; all its columns stay as they are."""
    rows, names = positional(docs)
    seen = scan_documents(rows, benchmark, names[docs.columns.index(text_col)], keep=names)
    return restored(seen.where(~is_contaminated(F.col("n_hit"), F.col("n_words"))), names, docs.columns)
