"""Joins of large tables: on a key that very many rows may share, and without a broadcast that the input does not bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: More keys than this cannot each have more than one in as many rows.
HOT_KEYS = 10_000


def join_sorted(left: DataFrame, right: DataFrame, key: str | list[str], how: str = "inner") -> DataFrame:
    """left joined with right, both shuffled and sorted, never broadcast: for tables that grow with the input.

    Left to itself, Spark broadcasts a table whose size it puts below spark.sql.autoBroadcastJoinThreshold. It goes by the
    bytes of files, and takes an array for one element: what compresses well, and above all what was exploded, is many
    times that size in the driver's memory.
    """
    return left.join(right.hint("merge"), key, how)


def join_by_share(rows: DataFrame, facts: DataFrame, key: str, n_rows: int, count_col: str, how: str = "left") -> DataFrame:
    """rows joined with facts, which has one row a key and, in count_col, how many of the n_rows rows have that key.

    Keys with more than one in HOT_KEYS rows are joined by broadcast: there are at most HOT_KEYS of them, whatever the
    input. The rows of each other key are a bounded share, and are shuffled. how: left or inner.
    """
    hot = F.broadcast(facts.where(F.col(count_col) > max(1000, n_rows // HOT_KEYS)))
    few = join_sorted(rows.join(hot.select(key), key, "left_anti"), facts, key, how)
    return few.unionByName(rows.join(hot, key))
