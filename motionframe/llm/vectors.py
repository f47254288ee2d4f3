"""Vectors of integers out of a column of arrays: what the operators on embeddings have in common.

A vector is kept if it is not null and all its components are there and finite. All kept vectors of one run have the same
length, the commonest among them (the smaller of two that are as common); vectors of other lengths are dropped.
A component c becomes floor(1024 * c), held within `LIMIT`, so that sums of squares are exact in 64 bits; only components
beyond 16,384 reach that bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 1024
LIMIT = 1 << 24
#: Rows that numpy takes at once.
ROWS = 8192


def is_kept(vector: Column) -> Column:
    whole = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return vector.isNotNull() & F.coalesce(whole, F.lit(False))


def dimension(rows: DataFrame, vector_col: str) -> int | None:
    """The length of the vectors kept; None if there are none."""
    vector = F.col(vector_col)
    sizes = rows.where(is_kept(vector)).groupBy(F.size(vector).alias("dim")).count()
    found = sizes.orderBy(F.desc("count"), "dim").first()
    return None if found is None else found["dim"]


def integers(values: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(values.astype(np.float64) * SCALE), -LIMIT, LIMIT).astype(np.int64)


def _kept(batch: pa.RecordBatch, dim: int) -> tuple[pa.RecordBatch, np.ndarray]:
    lengths = pc.fill_null(pc.list_value_length(batch.column(0)), -1).to_numpy()
    batch = batch.filter(pa.array(lengths == dim))
    values = np.asarray(batch.column(0).flatten().to_numpy(zero_copy_only=False), np.float64).reshape(batch.num_rows, dim)
    whole = np.isfinite(values).all(axis=1)  # a null component is a NaN here
    return batch.filter(pa.array(whole)), integers(values[whole])


def matrices(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """The kept rows of batches, whose first column holds the vectors, and these as a matrix of integers; about ROWS at once."""
    held, n = [], 0

    def joined() -> tuple[pa.RecordBatch, np.ndarray]:
        return pa.Table.from_batches([b for b, _ in held]).combine_chunks().to_batches()[0], np.concatenate([x for _, x in held])

    for batch in batches:
        b, x = _kept(batch, dim)
        if b.num_rows:
            held.append((b, x))
            n += b.num_rows
        if n >= ROWS:
            yield joined()
            held, n = [], 0
    if held:
        yield joined()
