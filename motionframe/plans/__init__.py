"""Registered queries with the SQL that states the same result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from motionframe.plans import alerting, augmentation, candidates, catalogue, frames, learning, operations, reports, sinks, streams
from motionframe.plans.registry import Query

_PARTS = [catalogue.R, frames.R, reports.R, operations.R, alerting.R, streams.R, sinks.R, augmentation.R, learning.R, candidates.R]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queries()["segment_scores"](spark, sf_dir)


def queries() -> dict[str, Query]:
    return {k: q for r in _PARTS for k, q in r.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {k: q for r in _PARTS for k, q in r.sql.items()}
