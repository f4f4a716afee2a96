"""Taking rows: first, random without and with replacement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions.scalars import key_hash
from kerbside.operators.ordering import zip_with_index

SORTED_ROWS = 100_000   # up to here a sorted limit may pass through one task


def first_rows(df: DataFrame, n: int | None, *keys: str) -> DataFrame:
    """The first ``n`` rows in key order, or all of them."""
    if n is None:
        return df
    if n <= SORTED_ROWS:
        return df.orderBy(*keys).limit(n)
    return zip_with_index(df, *keys, name="__index").where(F.col("__index") <= n).drop("__index")


def sample_rows(df: DataFrame, n: int, key: str, seed: int) -> DataFrame:
    """``n`` random rows without replacement: the lowest by a seeded hash of the key."""
    shuffled = df.withColumn("__order", key_hash(F.col(key), seed, "sample"))
    return first_rows(shuffled, n, "__order", key).drop("__order")


def draw_rows(targets: DataFrame, target_key: str, source: DataFrame, *source_keys: str,
              seed: int) -> DataFrame:
    """For every target one source row, drawn with replacement.

    The draw is a hash of the target's key, so a repeated run draws the same rows.
    """
    numbered = zip_with_index(source, *source_keys, name="__draw", start=0)
    rows = numbered.count()
    if rows == 0:
        raise ValueError("there are no rows to draw from")
    draw = F.pmod(key_hash(F.col(target_key), seed, "draw"), F.lit(rows))
    drawn = targets.select(target_key).withColumn("__draw", draw)
    return drawn.join(numbered, "__draw").drop("__draw")
