"""Vector code compression: each quarter of a vector becomes the index of its codebook's nearest entry, found in a GNAT.

The codebook of a part starts as that part of the smallest ids' vectors. A round assigns every part of every vector to the
nearest entry (squared Euclidean distance, ties to the lower index) and replaces each entry by the componentwise
floor(sum/count) of its parts; an entry that nothing was assigned to stays. After the rounds, parts are assigned again.

The nearest entry is searched for in a GNAT (geometric near-neighbour access tree) over the entries: a node has a few
split points, far from each other, and each other entry of the node belongs to the child of its nearest split point. For
each split point and child the node stores the range of distances between them. A query measures its distances to the
split points; a child is left out when, for some split point, every entry in the child's range must be strictly farther
than the best found so far. Ranges and distances are rounded outwards, so rounding never drops an entry that ties; the
entry itself is chosen by exact integer distances and, of equal ones, by index. Queries go through the tree in blocks,
each row into the child of its nearest split point first.

Spark: a round is one scan; a task adds up counts and sums of its rows, 256 entries a part at most, and these are added up
in a shuffle of as many rows a task. The codebooks, 256 vectors, are what the driver holds. Errors of equal labels are
summed before they are joined; labels with very many rows join by broadcast.

Rows: see `vectors` for those that are dropped. Fewer than 256 vectors make a codebook of as many entries. The smallest ids
are ordered with nulls last, rows of one id by their vectors; repeated rows count as often as they are there. A length that
4 doesn't divide is filled up with zeros. An empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motionframe.llm.skew import join_by_share
from motionframe.llm.vectors import LIMIT, SCALE, dimension, is_kept, matrices
from motionframe.session import written

PARTS, ENTRIES, ROUNDS = 4, 256, 4
#: Split points of a node, and entries of a leaf.
DEGREE, LEAF = 8, 12
#: By so much, relatively, distances are rounded outwards; doubles are exact to a ten-thousandth of it.
MARGIN = 1e-12


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of a to those of b, exact."""
    dim = a.shape[1]
    most = max(int(np.abs(a).max(initial=0)), int(np.abs(b).max(initial=0)))
    if 4 * dim * most * most < 1 << 53:  # every term and sum is a double
        x, y = a.astype(np.float64), b.astype(np.float64)
        return ((x * x).sum(1)[:, None] + (y * y).sum(1)[None] - 2 * (x @ y.T)).astype(np.int64)
    out = np.zeros((len(a), len(b)), np.int64)
    for i in range(dim):
        out += (a[:, i, None] - b[None, :, i]) ** 2
    return out


@dataclass
class Node:
    """ids: split points, ascending, or a leaf's entries. low and high: by split point and child."""

    ids: np.ndarray
    children: list[Node | None]
    low: np.ndarray | None = None
    high: np.ndarray | None = None


class Gnat:
    def __init__(self, entries: np.ndarray, degree: int = DEGREE, leaf: int = LEAF):
        self.entries, self.degree, self.leaf = entries, degree, leaf
        self.root = self._node(np.arange(len(entries)), squared(entries, entries))

    def _node(self, ids: np.ndarray, between: np.ndarray) -> Node:
        if len(ids) <= self.leaf:
            return Node(ids, [])
        chosen = [int(ids[0])]
        gap = between[ids, chosen[0]].astype(np.float64)
        gap[0] = -1
        while len(chosen) < self.degree:  # the farthest from those chosen
            at = int(gap.argmax())
            chosen.append(int(ids[at]))
            gap = np.minimum(gap, between[ids, chosen[-1]])
            gap[at] = -1
        splits = np.sort(np.array(chosen))
        rest = np.setdiff1d(ids, splits)
        belongs = between[np.ix_(rest, splits)].argmin(axis=1)
        low = np.full((len(splits), len(splits)), np.inf)
        high = np.full((len(splits), len(splits)), -np.inf)
        children: list[Node | None] = []
        for c in range(len(splits)):
            own = rest[belongs == c]
            if len(own):
                far = np.sqrt(between[np.ix_(splits, own)].astype(np.float64))
                low[:, c], high[:, c] = far.min(axis=1) * (1 - MARGIN), far.max(axis=1) * (1 + MARGIN)
            children.append(self._node(own, between) if len(own) else None)
        return Node(splits, children, low, high)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(index of the nearest entry, its squared distance) for each row of x, and how many distances were measured."""
        index = np.full(len(x), len(self.entries), np.int64)
        best = np.full(len(x), np.iinfo(np.int64).max, np.int64)
        measured = 0

        def visit(node: Node, rows: np.ndarray) -> None:
            nonlocal measured
            far = squared(x[rows], self.entries[node.ids])
            measured += far.size
            near = far.argmin(axis=1)  # the first of equal ones, and ids ascend
            d, i = far[np.arange(len(rows)), near], node.ids[near]
            better = (d < best[rows]) | ((d == best[rows]) & (i < index[rows]))
            best[rows[better]], index[rows[better]] = d[better], i[better]
            if not node.children:
                return
            root = np.sqrt(far.astype(np.float64))
            inner, outer = root * (1 - MARGIN), root * (1 + MARGIN)
            for c, child in enumerate(node.children):
                if child is not None and (own := near == c).any():
                    visit(child, rows[own])
            for c, child in enumerate(node.children):
                if child is None:
                    continue
                reach = np.sqrt(best[rows].astype(np.float64))[:, None] * (1 + MARGIN)
                out = (inner - reach > node.high[:, c]).any(axis=1) | (outer + reach < node.low[:, c]).any(axis=1)
                if (left := (near != c) & ~out).any():
                    visit(child, rows[left])

        if len(x):
            visit(self.root, np.arange(len(x)))
        return index, best, measured


def _parts(x: np.ndarray) -> list[np.ndarray]:
    """The quarters of the rows of x."""
    width = -(-x.shape[1] // PARTS)
    x = np.pad(x, ((0, 0), (0, PARTS * width - x.shape[1])))
    return [np.ascontiguousarray(x[:, p * width : (p + 1) * width]) for p in range(PARTS)]


def _first(rows: DataFrame, id_col: str, vector_col: str, dim: int) -> np.ndarray:
    """The vectors of the smallest ids: ENTRIES rows at most."""
    x = F.transform(vector_col, lambda c: F.greatest(F.least(F.floor(c.cast("double") * SCALE), F.lit(LIMIT)), F.lit(-LIMIT)))
    kept = rows.where(is_kept(F.col(vector_col)) & (F.size(vector_col) == dim)).select(F.col(id_col).alias("id"), x.alias("x"))
    few = kept.orderBy(F.col("id").asc_nulls_last(), "x").limit(ENTRIES).collect()
    return np.array([r["x"] for r in few], np.int64).reshape(len(few), dim)


def _round(rows: DataFrame, vector_col: str, dim: int, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one more round."""
    width = books[0].shape[1]
    made = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), *((f"s{i}", pa.int64()) for i in range(width))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(b) for b in books]
        n = [np.zeros(len(b), np.int64) for b in books]
        sums = [np.zeros(b.shape, np.int64) for b in books]
        for _, x in matrices(batches, dim):
            for p, part in enumerate(_parts(x)):
                index, _, _ = trees[p].nearest(part)
                order = np.argsort(index, kind="stable")
                used, at, many = np.unique(index[order], return_index=True, return_counts=True)
                n[p][used] += many
                sums[p][used] += np.add.reduceat(part[order], at, axis=0)
        for p in range(PARTS):
            used = np.flatnonzero(n[p])
            columns = [np.full(len(used), p), used, n[p][used], *sums[p][used].T]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, made)], schema=made)

    each = rows.select(vector_col).mapInArrow(run, ", ".join(f"{f.name} {'int' if f.type == pa.int32() else 'bigint'}" for f in made))
    total = each.groupBy("part", "entry").agg(*(F.sum(f.name).alias(f.name) for f in made if f.name not in ("part", "entry")))
    books = [b.copy() for b in books]
    for r in total.collect():  # PARTS * ENTRIES at most
        books[r["part"]][r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(width)]
    return books


def fit(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", rounds: int = ROUNDS) -> tuple[int, list[np.ndarray]]:
    """(length of the vectors, codebook of each part); length -1 without any vector."""
    dim = dimension(rows, vector_col)
    if dim is None:
        return -1, []
    books = _parts(_first(rows, id_col, vector_col, dim))
    for _ in range(rounds):
        books = _round(rows, vector_col, dim, books)
    return dim, books


def encode(rows: DataFrame, dim: int, books: list[np.ndarray], keep: list[str], vector_col: str = "embedding") -> DataFrame:
    """The columns `keep`, code (two hex digits a part) and error, the squared distances summed over the parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(b) for b in books]
        for batch, x in matrices(batches, dim):
            index = np.empty((len(x), PARTS), np.uint8)
            error = np.zeros(len(x), np.int64)
            for p, part in enumerate(_parts(x)):
                index[:, p], far, _ = trees[p].nearest(part)
                error += far
            codes = [row.tobytes().hex() for row in index]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(codes), pa.array(error)], names=[*batch.schema.names[1:], "code", "error"])

    source = rows.select(F.col(vector_col).alias("__vector"), *(F.col(f"`{c}`").alias(f"__keep{i}") for i, c in enumerate(keep)))
    kinds = [f"{c} {t}" for c, t in source.dtypes[1:]]
    out = source.mapInArrow(run if dim >= 0 else _none, ", ".join([*kinds, "code string", "error bigint"]))
    return out.select(*(F.col(f"__keep{i}").alias(c) for i, c in enumerate(keep)), "code", "error")


def _none(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _ in batches:
        pass
    return iter(())


def with_label_errors(coded: DataFrame, label_col: str = "label") -> DataFrame:
    """coded and label_error, the error summed over the rows with the same label; rows without one are together."""
    key = F.coalesce(F.concat(F.lit("="), F.col(label_col).cast("string")), F.lit(""))
    coded = written(coded.withColumn("__key", key), "codes")
    sums = written(coded.groupBy("__key").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("__n")), "label_errors")
    n = sums.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0]
    return join_by_share(coded, sums, "__key", n, "__n", "inner").drop("__key", "__n")


def fingerprint(books: list[np.ndarray]) -> str:
    """Hex digest of all components, by part, entry and position."""
    return hashlib.sha256(",".join(str(c) for b in books for c in b.ravel().tolist()).encode()).hexdigest()


def compressed(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """id_col, code, error, label_error and codebooks_sha256 of each vector."""
    dim, books = fit(rows, id_col, vector_col)
    coded = encode(rows.select(F.col(id_col).alias("__id"), F.col(vector_col).alias("__v"), F.col(label_col).alias("__label")), dim, books, ["__id", "__label"], "__v")
    out = with_label_errors(coded, "__label")
    return out.select(F.col("__id").alias(id_col), "code", "error", "label_error", F.lit(fingerprint(books)).alias("codebooks_sha256"))


def sql() -> str:
    """The query's rows in SQL: every entry is compared with every part."""
    steps = []
    for r in range(ROUNDS + 1):
        steps.append(f"""a{r} AS (
  SELECT p.rid, p.part, min(list_sum(list_transform(range(1, len(p.v) + 1), lambda i: (p.v[i] - b.v[i]) * (p.v[i] - b.v[i]))) * {ENTRIES} + b.entry)::BIGINT AS d
  FROM parts p JOIN b{r} b USING (part) GROUP BY p.rid, p.part),""")
        if r < ROUNDS:
            steps.append(f"""m{r} AS (
  SELECT part, entry, list(c ORDER BY i) AS v FROM (
    SELECT part, d % {ENTRIES} AS entry, i, CAST(floor(sum(v[i])::DOUBLE / count(*)) AS BIGINT) AS c
    FROM a{r} JOIN parts USING (rid, part), (SELECT unnest(range(1, 1 + (SELECT max(len(v)) FROM parts))) AS i) GROUP BY ALL) GROUP BY part, entry),
b{r + 1} AS (SELECT part, entry, coalesce(m.v, b.v) AS v FROM b{r} b LEFT JOIN m{r} m USING (part, entry)),""")
    steps = "\n".join(steps)
    return f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) - 1 AS rid, vec_id, label, list_transform(embedding, lambda c: CAST(floor(c::DOUBLE * {SCALE}) AS BIGINT)) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
parts AS MATERIALIZED (SELECT rid, part, x[part * len(x) // {PARTS} + 1 : (part + 1) * len(x) // {PARTS}] AS v FROM kept, (SELECT unnest(range({PARTS})) AS part)),
b0 AS (SELECT part, rid AS entry, v FROM parts WHERE rid < {ENTRIES}),
{steps}
coded AS (
  SELECT rid, string_agg(format('{{:02x}}', d % {ENTRIES}), '' ORDER BY part) AS code, sum(d // {ENTRIES})::BIGINT AS error FROM a{ROUNDS} GROUP BY rid),
digest AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{ROUNDS})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN kept USING (rid), digest
"""
