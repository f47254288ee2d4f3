"""Fixed virtual slots: records hash into thousands of slots, and a versioned map says which shard holds a slot.

The slot of a record depends on its key alone and never changes. Bytes are summed for each slot, a table of `n_slots`
rows at most, whatever the input. A version of the map is edited from the version before: slots leave shards that hold
more than their share, the largest first that fit, and fill those that hold the least. Only the rows of edited slots
move. The map is a folder with a table for each version, (vslot, piece, rows_each, shard). `start` writes version 1 into an
empty folder, `rebalance` edits the latest version by the bytes that it finds and writes the next one, `place` places rows
by any version that is there: the same folder is taken up by every later run, with other rows or more shards. A
version is never written twice.

Law `bytes`: sizes of shards are as near to each other as the slots' sizes allow. One key with very many rows makes one
large slot; a slot with more than a `PIECES`-th of a shard's share is cut into pieces of `rows_each` rows in the slot's
order, each with a shard of its own; a slot that was cut stays cut by the same number of rows, and what it has gained since
a version was written goes to its last piece there.

Order: rows stand by slot, key, crc and size, in ranges that Spark cuts and sorts (equal rows by a row number), so that
no key and no slot is dealt to one task. A row's place in its slot is its place in the order less the slot's start, and
`slot` is its place in its shard, without gaps from 0: both come from counts of ranges, slots and pieces.

Nulls: a null key is a key of its own, a null text has no bytes and a null crc. Repeated rows each get a place of their
own; which of two equal rows comes first makes no difference. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from motionframe.session import written

N_SLOTS = 8192
OVERHEAD = 16
PIECES = 16
#: A slot's part: (virtual slot, number of the piece).
Piece = tuple[int, int]
MAP_SCHEMA = "vslot int, piece int, rows_each long, shard int"


def vslot(key: Column, n_slots: int = N_SLOTS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_slots)).cast("int")


def slotted(docs: DataFrame, key_col: str = "doc_id", text_col: str = "text", n_slots: int = N_SLOTS) -> DataFrame:
    """key, size, text_crc32, vslot and place, written in the order of slots. The upper bits of place are the range."""
    size = (F.coalesce(F.octet_length(text_col), F.lit(0)) + OVERHEAD).cast("long")
    rows = docs.select(F.col(key_col).alias("key"), size.alias("size"), F.crc32(F.encode(text_col, "UTF-8")).alias("text_crc32"), F.monotonically_increasing_id().alias("row"))
    rows = rows.withColumn("vslot", vslot(F.col("key"), n_slots))
    order = ["vslot", "key", "text_crc32", "size", "row"]
    return written(rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("row").withColumn("place", F.monotonically_increasing_id()), "slotted")


def ranked(rows: DataFrame) -> tuple[DataFrame, dict[int, tuple[int, int]]]:
    """(rows with nth, the place in the slot; bytes and rows of each slot). The driver has counts of ranges and slots."""
    part = F.shiftright("place", 33)
    sums = rows.groupBy(part.alias("part"), "vslot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")).collect()
    parts: dict[int, int] = {}
    slots: dict[int, tuple[int, int]] = {}
    for r in sums:
        parts[r["part"]] = parts.get(r["part"], 0) + r["rows"]
        b, n = slots.get(r["vslot"], (0, 0))
        slots[r["vslot"]] = b + r["bytes"], n + r["rows"]
    spark = rows.sparkSession
    before = F.broadcast(spark.createDataFrame(_starts(parts), "__part long, __before long"))
    first = F.broadcast(spark.createDataFrame(_starts({s: n for s, (_, n) in slots.items()}), "vslot int, __first long"))
    nth = F.col("__before") + F.col("place").bitwiseAND((1 << 33) - 1) - F.col("__first")
    out = rows.join(before, part == F.col("__part")).join(first, "vslot").withColumn("nth", nth)
    return out.drop("__part", "__before", "__first"), slots


def _starts(counts: dict[int, int]) -> list[tuple[int, int]]:
    """(key, sum of the counts of lesser keys)."""
    at, out = 0, []
    for k in sorted(counts):
        out.append((k, at))
        at += counts[k]
    return out


def first_map(n_shards: int, n_slots: int = N_SLOTS) -> dict[Piece, int]:
    """Version 1: whole slots in turn."""
    return {(s, 0): s % n_shards for s in range(n_slots)}


def cut(slots: dict[int, tuple[int, int]], n_shards: int) -> dict[int, int]:
    """Of slots that are large, the rows of a piece; slots has bytes and rows. They are n_shards * PIECES at most."""
    share = sum(b for b, _ in slots.values()) / n_shards / PIECES
    return {s: max(1, int(n * share / b)) for s, (b, n) in slots.items() if n > 1 and b > share}


def _of_slot(numbers: dict[int, int], vslot_: Column) -> Column:
    """The slot's number; null for slots without one."""
    if not numbers:
        return F.lit(None).cast("int")
    return F.element_at(F.create_map(*(F.lit(x) for kv in numbers.items() for x in kv)), vslot_)


def piece(rows_each: dict[int, int], last: dict[int, int], vslot_: Column, nth: Column) -> Column:
    """The piece that a row is in; last is the number of each cut slot's last piece."""
    return F.coalesce(F.least(F.floor(nth / _of_slot(rows_each, vslot_)), _of_slot(last, vslot_)), F.lit(0)).cast("int")


def piece_sums(rows: DataFrame, slots: dict[int, tuple[int, int]], rows_each: dict[int, int], last: dict[int, int]) -> dict[Piece, tuple[int, int]]:
    """Bytes and rows of each piece of each slot; only large slots are summed again."""
    out = {(s, 0): v for s, v in slots.items() if s not in rows_each}
    if rows_each:
        large = rows.where(F.col("vslot").isin(*rows_each)).withColumn("piece", piece(rows_each, last, F.col("vslot"), F.col("nth")))
        out |= {(r["vslot"], r["piece"]): (r["bytes"], r["rows"]) for r in large.groupBy("vslot", "piece").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")).collect()}
    return out


def edited_map(old: dict[Piece, int], load: dict[Piece, int], n_shards: int) -> dict[Piece, int]:
    """The next version: the fewest slots move that leave shards above the mean, the largest of those that fit first."""
    held: dict[int, list[tuple[int, Piece]]] = {k: [] for k in range(n_shards)}
    for s, k in old.items():
        held.setdefault(k, []).append((load.get(s, 0), s))
    total = {k: sum(b for b, _ in v) for k, v in held.items()}
    mean = sum(total.values()) / n_shards
    new, loose = dict(old), []
    for k, v in held.items():
        for b, s in sorted(v, reverse=True):
            if k >= n_shards or b and total[k] - b >= mean:  # shards that are given up lose all they have
                loose.append((b, s))
                total[k] -= b
    heap = [(total[k], k) for k in range(n_shards)]
    heapq.heapify(heap)
    for b, s in sorted(loose, reverse=True):
        t, k = heapq.heappop(heap)
        new[s] = k
        heapq.heappush(heap, (t + b, k))
    return _evened(new, load, n_shards)


def _evened(slots: dict[Piece, int], load: dict[Piece, int], n_shards: int) -> dict[Piece, int]:
    """Move small slots from the fullest shard to the emptiest for as long as that narrows the gap."""
    held: list[list[tuple[int, Piece]]] = [[] for _ in range(n_shards)]
    for s, k in slots.items():
        if load.get(s, 0):
            held[k].append((load[s], s))
    total = [sum(b for b, _ in v) for v in held]
    for v in held:
        v.sort()
    for _ in range(len(slots)):
        hi, lo = max(range(n_shards), key=total.__getitem__), min(range(n_shards), key=total.__getitem__)
        gap = total[hi] - total[lo]
        fit = [x for x in held[hi] if x[0] < gap]
        if not fit:
            break
        b, s = min(fit, key=lambda x: abs(2 * x[0] - gap))
        held[hi].remove((b, s))
        held[lo].append((b, s))
        total[hi] -= b
        total[lo] += b
        slots[s] = lo
    return slots


def versions(spark: SparkSession, folder: str) -> list[int]:
    """The versions that the folder holds, rising."""
    try:
        found = spark.read.schema(MAP_SCHEMA + ", version int").parquet(folder).select("version").distinct().collect()  # one row a version
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted(r["version"] for r in found)


def write_map(spark: SparkSession, folder: str, version: int, slots: dict[Piece, int], rows_each: dict[int, int] = {}) -> None:  # noqa: B006
    """Add a version to the map in folder; one that is there already is an error."""
    rows = [(s, p, rows_each.get(s), k) for (s, p), k in sorted(slots.items())]
    spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.mode("error").parquet(f"{folder}/version={version}")


def read_map(spark: SparkSession, folder: str, version: int) -> tuple[dict[Piece, int], dict[int, int]]:
    """(shards of slots and pieces, rows_each of the slots that are cut)."""
    rows = spark.read.schema(MAP_SCHEMA).parquet(f"{folder}/version={version}").collect()  # n_slots and the pieces
    return {(r["vslot"], r["piece"]): r["shard"] for r in rows}, {r["vslot"]: r["rows_each"] for r in rows if r["rows_each"] is not None}


def _last_pieces(slots: dict[Piece, int], rows_each: dict[int, int]) -> dict[int, int]:
    last: dict[int, int] = {}
    for s, p in slots:
        if s in rows_each:
            last[s] = max(p, last.get(s, 0))
    return last


@dataclass
class Measured:
    """Records in the order of slots, with nth, their place in it; slots has the bytes and rows of each."""

    rows: DataFrame
    slots: dict[int, tuple[int, int]]
    key_col: str
    n_slots: int


def measured(docs: DataFrame, key_col: str = "doc_id", text_col: str = "text", n_slots: int = N_SLOTS) -> Measured:
    return Measured(*ranked(slotted(docs, key_col, text_col, n_slots)), key_col, n_slots)


def start(spark: SparkSession, folder: str, n_shards: int = 40, n_slots: int = N_SLOTS) -> None:
    """Version 1, whole slots in turn, if the folder holds no version."""
    if not versions(spark, folder):
        write_map(spark, folder, 1, first_map(n_shards, n_slots))


def rebalance(docs: Measured, folder: str, n_shards: int = 40) -> dict[Piece, tuple[int, int]]:
    """Write the version after the latest, edited by the bytes of docs; gives (shard before, shard now) of what moved."""
    spark = docs.rows.sparkSession
    version = versions(spark, folder)[-1]
    old, each = read_map(spark, folder, version)
    last = _last_pieces(old, each)
    rows_each = cut(docs.slots, n_shards) | each
    now = {s: max(0, -(-docs.slots.get(s, (0, 0))[1] // n) - 1) for s, n in rows_each.items()}
    pieces = [(s, p) for s in range(docs.n_slots) for p in range(max(now.get(s, 0), last.get(s, 0)) + 1)]
    before = {(s, p): old[s, min(p, last.get(s, 0))] for s, p in pieces}
    sums = piece_sums(docs.rows, docs.slots, rows_each, {s: max(n, last.get(s, 0)) for s, n in now.items()})
    new = edited_map(before, {p: b for p, (b, _) in sums.items()}, n_shards)
    write_map(spark, folder, version + 1, new, rows_each)
    return {p: (before[p], k) for p, k in new.items() if before[p] != k}


def place(docs: Measured, folder: str, version: int | None = None) -> DataFrame:
    """Rows with the key, size, text_crc32, vslot, piece, shard and slot, placed by a version of the map; None is the latest."""
    spark = docs.rows.sparkSession
    slots, rows_each = read_map(spark, folder, versions(spark, folder)[-1] if version is None else version)
    last = _last_pieces(slots, rows_each)
    sums = piece_sums(docs.rows, docs.slots, rows_each, last)
    at: dict[int, int] = {}
    begin = []
    for p, k in sorted(slots.items()):
        begin.append((*p, k, at.get(k, 0)))
        at[k] = at.get(k, 0) + sums.get(p, (0, 0))[1]
    starts = F.broadcast(spark.createDataFrame(begin, "vslot int, piece int, shard int, __start long"))  # slots and pieces
    placed = docs.rows.withColumn("piece", piece(rows_each, last, F.col("vslot"), F.col("nth"))).join(starts, ["vslot", "piece"])
    each = F.coalesce(_of_slot(rows_each, F.col("vslot")), F.lit(0))
    slot = (F.col("__start") + F.col("nth") - F.col("piece") * each).cast("long")
    return placed.select(F.col("key").alias(docs.key_col), "size", "text_crc32", "vslot", "piece", "shard", slot.alias("slot"))
