"""Arrow batches in, Arrow batches out: the one way in which these operators run Python."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SCALARS = {
    pa.int64(): "bigint",
    pa.int32(): "int",
    pa.float64(): "double",
    pa.float32(): "float",
    pa.bool_(): "boolean",
    pa.string(): "string",
    pa.binary(): "binary",
}

SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
#: Rows that are Python objects at once.
ROWS = 1000


class Recent(dict):
    """What make(key) gave for the keys asked for lately, between size and twice size of them."""

    def __init__(self, make: Callable[[object], object], size: int):
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key):
        value = self.old.pop(key, None)
        if value is None:
            value = self.make(key)
        if len(self) >= self.size:
            self.old = dict(self)
            super().clear()
        self[key] = value
        return value

    def clear(self) -> None:
        self.old = {}
        super().clear()


def by_bytes(batches: Iterator[pa.RecordBatch], column: int, size: int) -> Iterator[pa.RecordBatch]:
    """The batches in slices whose strings in that column have about `size` bytes; a longer one is a slice of its own."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy())
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(at, to - at)
            at = to


def ddl(kind: pa.DataType) -> str:
    if pa.types.is_list(kind):
        return f"array<{ddl(kind.value_type)}>"
    if pa.types.is_struct(kind):
        return f"struct<{','.join(f'{f.name}:{ddl(f.type)}' for f in kind)}>"
    return _SCALARS[kind]


def map_rows(df: DataFrame, keep: list[str], inputs: list[str], fields: list[tuple[str, pa.DataType]], fn: Callable[..., Iterable], setup: Callable[[], object] | None = None) -> DataFrame:
    """Apply fn to the columns `inputs` of df, given as lists; it returns a list or array for each of fields.

    The columns `keep` go through as they are and stand first in the result; where a computed column has the name of one
    of them, the computed one stays. setup runs once in a task, and its result is fn's first argument.
    """
    made = {n for n, _ in fields}
    keep = [c for c in dict.fromkeys(keep) if c not in made]
    sent = [*keep, *(c for c in dict.fromkeys(inputs) if c not in keep)]  # no column is sent twice
    at_input = [sent.index(c) for c in inputs]
    schema = pa.schema(fields)
    n = len(keep)
    q = lambda c: F.col(f"`{c}`")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = () if setup is None else (setup(),)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                out = fn(*first, *(part.columns[i].to_pylist() for i in at_input))
                arrays = [v if isinstance(v, pa.Array) else pa.array(v, type=f.type) for v, f in zip(out, schema)]
                yield pa.RecordBatch.from_arrays([*part.columns[:n], *arrays], names=[*part.schema.names[:n], *schema.names])
        for x in first:
            if hasattr(x, "clear"):  # what it has remembered is not held for other tasks
                x.clear()

    source = df.select(*(q(c).alias(f"__keep{i}") for i, c in enumerate(sent)))
    kinds = [f"`__keep{i}` {source.schema[f'__keep{i}'].dataType.simpleString()}" for i in range(n)]
    out = source.mapInArrow(run, ", ".join([*kinds, *(f"`{c}` {ddl(t)}" for c, t in fields)]))
    return out.select(*(F.col(f"__keep{i}").alias(c) for i, c in enumerate(keep)), *(q(c) for c, _ in fields))


def positional(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """df with its columns named by place, so that none clashes with a computed one, and these names."""
    names = [f"__c{i}" for i in range(len(df.columns))]
    return df.toDF(*names), names


def restored(df: DataFrame, names: list[str], columns: list[str]) -> DataFrame:
    return df.select(*(F.col(n).alias(c) for n, c in zip(names, columns)))
