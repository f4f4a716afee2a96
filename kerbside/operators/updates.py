"""Keyed changes to a table, as joins and aggregates over whole DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def update_rows(target: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """``target`` with the columns of ``changes`` (unique on ``key``) put in place.

    Rows without a change stay, changes without a row do nothing.
    """
    columns = [c for c in changes.columns if c != key]
    staged = changes.select(key, F.struct(*columns).alias("__new"))
    joined = target.join(staged, key, "left")
    return joined.select(*[
        F.when(F.col("__new").isNotNull(), F.col(f"__new.{c}")).otherwise(F.col(c)).alias(c)
        if c in columns else F.col(c)
        for c in target.columns
    ])


def latest(changes: DataFrame, key: str, order: str) -> DataFrame:
    """The change with the highest ``order`` of each key, columns as they were.

    One primitive aggregate per column: it combines before the shuffle, so a key with very
    many changes costs one row per task. ``order`` must be unique within a key.
    """
    values = [c for c in changes.columns if c not in (key, order)]
    return changes.groupBy(key).agg(
        F.max(order).alias(order), *[F.max_by(c, order).alias(c) for c in values])


def upsert_rows(target: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """``target`` with rows of ``changes`` (unique on ``key``) replaced or added."""
    kept = target.join(changes.select(key), key, "left_anti")
    return kept.unionByName(changes.select(*target.columns))
