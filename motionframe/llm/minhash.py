"""Near-duplicates by circulant MinHash: two permutations give every coordinate of a signature.

A document's set are its distinct shingles of five words (A-Z lower-cased, split at ASCII white space); with fewer words,
the whole sequence is one shingle; without words it has none and is linked with nothing. One permutation of the 64-bit
numbers places each shingle, the place is shifted circularly by k steps, and a second permutation ranks it: coordinate k
is the least rank. 24 bands of 4 coordinates are keys. All that follows works on distinct texts, so exact copies cost one row.

1. Stars: in each band's bucket every member is paired with the bucket's least member; there are at most as many
   distinct pairs as rows in buckets.
2. Sketches: a pair goes on if the low bytes of enough of the 96 coordinates agree; a pair at the threshold fails with
   probability 1e-7.
3. Links are confirmed on full sets. The texts of bucket mates are fetched and written once; they meet in joins on one
   key, which Spark splits where a key is hot. Components of the links, by alternating stars.
4. Rest: buckets whose members are in more than one component still have pairs that were not compared. Such buckets are
   dealt into blocks, and each pair of blocks is a group. First only sketches (100 bytes a row, `SKETCH_BLOCK` rows a
   block, but `SKETCH_BLOCKS` blocks at most, so that what is shuffled is linear) meet, to find the rows that have an alike partner in another component at all; only these rows, with their
   texts, are then dealt into blocks of at most about `BLOCK` rows and `BLOCK_BYTES` of text. Of a group's alike pairs of
   different components, the most alike come first; a pair that the ones before have joined is skipped, the others are
   confirmed, and the links that join are the result: fewer than the group has rows. A pair is looked at in the first
   band that it shares. Components again.

The threshold is a parameter in percent. At 85 a pair misses the bands with probability 2e-8, at 80 with 3e-6.

Rows are written once, with a number each. Rows of one text join the text's component by the text's key; texts that at
least one in 10,000 rows has are at most 10,000, and are joined by broadcast, so no key with very many rows is shuffled.
No other table is broadcast: band keys are 24 rows a text, which Spark would size as one.

Nulls: a null text has no words. Null ids take part; a component's id is its least id that is not null, or null. Rows
that share an id share its fate in `near_duplicate_rows`; `kept` is true where the id is the component's. `near_dedup`
keeps one row of each component, one with the least id, also where ids are null or repeated, and every row without words.
Empty tables give no rows. Extra columns are not read, or carried through by `near_dedup`, whatever their names are.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motionframe.llm.common import map_rows, positional, restored
from motionframe.llm.components import components
from motionframe.llm.skew import join_by_share, join_sorted
from motionframe.session import written

PERCENT = 85
SHINGLE = 5
BANDS, ROWS = 24, 4
BLOCK, BLOCK_BYTES = 256, 4 << 20
SKETCH_BLOCK, SKETCH_BLOCKS = 512, 64
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SHIFTS = np.arange(BANDS * ROWS, dtype=np.uint64) * _STEP


def _mixed(x: np.ndarray, a: int, b: int) -> np.ndarray:
    """A permutation of the 64-bit numbers; x is changed."""
    x ^= x >> np.uint64(33)
    x *= np.uint64(a)
    x ^= x >> np.uint64(29)
    x *= np.uint64(b)
    x ^= x >> np.uint64(32)
    return x


def shingles(text: str | None, size: int = SHINGLE) -> set[bytes]:
    w = text.encode().translate(_LOWER).split() if text else []
    return {b" ".join(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def signature(hashes: np.ndarray) -> np.ndarray:
    """All coordinates of a set of 64-bit hashes, which is not empty."""
    placed = _mixed(hashes.copy(), 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)
    least = np.full(len(_SHIFTS), np.uint64(2**64 - 1))
    for at in range(0, len(placed), 2048):
        ranks = _mixed(placed[at : at + 2048, None] + _SHIFTS, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
        np.minimum(least, ranks.min(axis=0), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    keys = np.arange(BANDS, dtype=np.uint64)
    for col in least.reshape(BANDS, ROWS).T:
        keys = _mixed((keys ^ col) * _STEP, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)
    return keys.view(np.int64)


def _sign(texts):
    sizes, bands, sketches = [], [], []
    for text in texts:
        s = shingles(text)
        sizes.append(len(s))
        if s:
            least = signature(np.fromiter(map(xxhash.xxh3_64_intdigest, s), dtype=np.uint64, count=len(s)))
            bands.append(band_keys(least))
            sketches.append(least.astype(np.uint8).tobytes())
        else:
            bands.append([])
            sketches.append(None)
    return sizes, bands, sketches


def text_id(text: Column) -> Column:
    """128 bits that stand for a text."""
    return F.substring(F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256)), 1, 16)


def least_agreeing(percent: int) -> int:
    """Of a pair at the threshold fewer coordinates agree with probability 1e-7."""
    n, p = BANDS * ROWS, percent / 100
    return math.floor(n * p - 5.2 * math.sqrt(n * p * (1 - p)))


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose texts (n, text) are linked."""

    def confirm(a, b):
        """Rows come sorted by one side, so the last sets are kept."""
        out, held = [], {}
        for x, y in zip(a, b):
            held = {t: held[t] if t in held else shingles(t) for t in (x, y)}
            out.append(_linked(held[x], held[y], percent))
        return (out,)

    both = join_sorted(pairs, texts.select(F.col("n").alias("u"), F.col("text").alias("a")), "u")
    both = join_sorted(both, texts.select(F.col("n").alias("v"), F.col("text").alias("b")), "v")
    return map_rows(both, ["u", "v"], ["a", "b"], [("linked", pa.bool_())], confirm).where("linked").select("u", "v")


def _linked(s: set, t: set, percent: int) -> bool:
    small, large = sorted((len(s), len(t)))
    if not small or 100 * small < percent * large:
        return False
    inter = len(s & t)
    return 100 * inter >= percent * (len(s) + len(t) - inter)


def _filled(id_col: str) -> Column:
    return F.coalesce(F.col(id_col), F.lit(-(2**63)))


def alike(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose sketches and set sizes let them be linked."""
    agree = least_agreeing(percent)

    def compare(a, b, sizes_a, sizes_b):
        both = zip(a, b, sizes_a, sizes_b)
        return ([100 * min(m, n) >= percent * max(m, n) and int((np.frombuffer(x, np.uint8) == np.frombuffer(y, np.uint8)).sum()) >= agree for x, y, m, n in both],)

    side = lambda k: sketches.select(F.col("n").alias(k), F.col("sketch").alias(f"sketch_{k}"), F.col("n_shingles").alias(f"size_{k}"))
    both = join_sorted(join_sorted(pairs, side("u"), "u"), side("v"), "v")
    return map_rows(both, ["u", "v"], ["sketch_u", "sketch_v", "size_u", "size_v"], [("alike", pa.bool_())], compare).where("alike").select("u", "v")


def _rivals(table: pa.Table, percent: int) -> tuple[np.ndarray, Iterator[tuple[int, np.ndarray, np.ndarray]]]:
    """In a group of two blocks: its rows' names, and for each row i the later rows j of other components that are alike,
    with how many coordinates agree."""
    n, comp, size, side = (table.column(c).to_numpy() for c in ("n", "component", "n_shingles", "side"))
    same = bool(table.column("same")[0].as_py())
    sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(len(n), -1)
    agree = least_agreeing(percent)

    def pairs() -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for i in range(len(n) - 1):
            j = np.arange(i + 1, len(n))
            j = j[(comp[j] != comp[i]) & (same | (side[j] != side[i])) & (100 * np.minimum(size[j], size[i]) >= percent * np.maximum(size[j], size[i]))]
            agreed = (sketch[j] == sketch[i]).sum(axis=1)
            yield i, j[agreed >= agree], agreed[agreed >= agree]

    return n, pairs()


def _with_rivals(percent: int) -> Callable[[pa.Table], pa.Table]:
    def find(table: pa.Table) -> pa.Table:
        n, pairs = _rivals(table, percent)
        has = np.zeros(len(n), bool)
        for i, j, _ in pairs:
            has[j] = True
            has[i] |= len(j) > 0
        return pa.table({"key": table.column("key").filter(pa.array(has)), "n": pa.array(n[has], pa.int64())})

    return find


def _joining(percent: int) -> Callable[[pa.Table], pa.Table]:
    def find(table: pa.Table) -> pa.Table:
        """Links that join different components."""
        n, found = _rivals(table, percent)
        comp = table.column("component").to_numpy()
        bands = np.array(table.column("bands").to_pylist(), np.int64)[:, : table.column("band")[0].as_py()]
        texts = table.column("text").to_pylist()
        pairs = [np.zeros((0, 3), np.int64)]
        for i, j, agreed in found:
            first = ~(bands[j] == bands[i]).any(axis=1)
            pairs.append(np.stack([agreed[first], np.full(int(first.sum()), i), j[first]], axis=1))
        pairs = np.concatenate(pairs)
        root: dict[int, int] = {}

        def top(x: int) -> int:
            while (up := root.get(x, x)) != x:
                root[x] = x = root.get(up, up)
            return x

        sets: dict[int, set] = {}
        links = []
        for _, i, j in pairs[np.argsort(-pairs[:, 0], kind="stable")].tolist():
            x, y = top(int(comp[i])), top(int(comp[j]))
            if x == y:
                continue
            for k in (i, j):
                if k not in sets:
                    sets[k] = shingles(texts[k])
            if _linked(sets[i], sets[j], percent):
                root[x] = y
                links.append((max(n[i], n[j]), min(n[i], n[j])))
        return pa.table({"u": pa.array([u for u, _ in links], pa.int64()), "v": pa.array([v for _, v in links], pa.int64())})

    return find


def sketch_blocks(size: Column) -> Column:
    """Into how many blocks a bucket is dealt: each row is copied that often."""
    return F.least(size / SKETCH_BLOCK, F.lit(SKETCH_BLOCKS))


def _in_blocks(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """rows once for each group of two blocks of its bucket that it is in. sizes: (key, blocks)."""
    rows = join_sorted(rows, sizes, "key").withColumn("side", F.pmod(F.xxhash64("n", "key"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    group = F.struct("key", F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi"))
    return rows.withColumn("same", F.col("side") == F.col("other")).withColumn("group", group).drop("other", "blocks")


def rest_links(posted: DataFrame, classes: DataFrame, labels: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links of bucket mates in different components. posted: (band, key, n)."""
    rows = join_sorted(posted, labels, "n", "left").withColumn("component", F.coalesce("component", "n"))
    blocks = lambda share: F.ceil(share).cast("int").alias("blocks")
    open_ = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("component").alias("lo"), F.max("component").alias("hi")).where("size > 2 and lo != hi").select("key", blocks(sketch_blocks(F.col("size"))))
    rows = written(join_sorted(join_sorted(rows, open_.select("key"), "key"), classes.select("n", "n_shingles", "sketch", "bands"), "n"), "open")
    some = _in_blocks(rows.select("key", "n", "component", "n_shingles", "sketch"), open_).groupBy("group").applyInArrow(_with_rivals(percent), "key bigint, n bigint").distinct()
    near = written(join_sorted(join_sorted(rows, some, ["key", "n"]), texts.select("n", F.octet_length("text").alias("bytes")), "n"), "rivals")
    sizes = near.groupBy("key").agg(blocks(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("bytes") / BLOCK_BYTES)))
    return _in_blocks(join_sorted(near, texts, "n"), sizes).groupBy("group").applyInArrow(_joining(percent), "u bigint, v bigint").distinct()


def signed_rows(docs: DataFrame, text_col: str) -> DataFrame:
    """docs, written with __row, a number; __cid, which stands for the text; __size, the size of its set; bands and sketch."""
    fields = [("__size", pa.int64()), ("__bands", pa.list_(pa.int64())), ("__sketch", pa.binary())]
    cols = [c for c in docs.columns if c != text_col]
    signed = map_rows(docs, [*cols, text_col], [text_col], fields, _sign)
    return written(signed.withColumn("__cid", text_id(F.col(text_col))).withColumn("__row", F.monotonically_increasing_id()), "signed")


def near_classes(signed: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """For each distinct text that has words: cid, copies, best (its row with the least id: struct of id and row), least_id
    and component, which is the same number for all texts of a component."""
    sets = signed.where("__size > 0").groupBy(F.col("__cid").alias("cid"))
    best = F.min(F.struct(_filled(id_col).alias("id"), F.col("__row").alias("row"))).alias("best")
    classes = sets.agg(best, F.min(id_col).alias("least_id"), F.count(F.lit(1)).alias("copies"), F.min("__size").alias("n_shingles"), F.min("__bands").alias("bands"), F.min("__sketch").alias("sketch"))
    classes = written(classes.withColumn("n", F.monotonically_increasing_id()), "classes")  # n: a short name for a text
    keys = classes.select("n", F.posexplode("bands").alias("band", "key"))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("n").alias("v")).where("size > 1").select("key", "v")
    posted = written(join_sorted(keys, shared, "key"), "posted")  # buckets of two and more
    stars = written(posted.where(F.col("n") != F.col("v")).select(F.col("n").alias("u"), "v").distinct(), "stars")
    mates = join_sorted(posted.select("n").distinct(), classes.select("n", F.col("best.row").alias("__row")), "n")
    texts = written(join_sorted(signed.select("__row", F.col(text_col).alias("text")), mates, "__row").select("n", "text"), "texts")
    links = written(confirmed(alike(stars, classes, percent), texts, percent), "links")
    labels = components(links).withColumnRenamed("node", "n")
    rest = written(rest_links(posted.select("band", "key", "n"), classes, labels, texts, percent), "rest")
    if not rest.isEmpty():
        labels = components(links.union(rest)).withColumnRenamed("node", "n")
    return join_sorted(classes, labels, "n", "left").select("cid", "copies", "best", "least_id", F.coalesce("component", "n").alias("component"))


def near_duplicate_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """For each row of docs: id_col, n_shingles, component_id and kept."""
    signed = signed_rows(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "text")
    classes = written(near_classes(signed, "id", "text", percent), "named")
    least = classes.groupBy("component").agg(F.min("least_id").alias("component_id"))
    found = written(join_sorted(classes, least, "component").select("cid", "copies", "component_id"), "found")
    rows = signed.select("id", F.col("__cid").alias("cid"), F.col("__size").alias("n_shingles"))
    out = join_by_share(rows, found, "cid", rows.count(), "copies")
    out = out.withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id")))
    return out.select(F.col("id").alias(id_col), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """docs with one row of each component, one with the least id, and all rows without words; all columns stay as they are."""
    rows, names = positional(docs)
    id_, text = (names[docs.columns.index(c)] for c in (id_col, text_col))
    signed = signed_rows(rows, text)
    stays = near_classes(signed, id_, text, percent).groupBy("component").agg(F.min("best").alias("best")).select(F.col("best.row").alias("__row"))
    out = join_sorted(signed.where("__size > 0"), stays, "__row", "left_semi").unionByName(signed.where("__size = 0"))
    return restored(out, names, docs.columns)
