"""Catalog-side sources: whole-table scans, bound-parameter SQL, frames as SQL relations."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """Full table scan (lazy; later projections prune the columns read)."""
    return spark.table(name)


def run_query(spark: SparkSession, sql: str, params: list[Any] | dict[str, Any] | None = None) -> DataFrame:
    """Run SQL with bound parameters (``?`` markers for a list, ``:name`` for a dict).

    Values never become part of the SQL text, so quotes in them are harmless.
    """
    return spark.sql(sql, args=params) if params else spark.sql(sql)


def as_relation(df: DataFrame, name: str) -> DataFrame:
    """Expose a frame to SQL under ``name`` (a session-scoped view, no data copied)."""
    df.createOrReplaceTempView(name)
    return df
