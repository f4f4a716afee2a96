"""Joining rows to a table with one row per key when a key may hold very many rows.

The usual run-time splitting of skewed partitions does not apply where one side of the
join has just been aggregated on the key, which is how most of these tables come about.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000   # rows of one key that a single task may get


def join_unique(left: DataFrame, right: DataFrame, keys: list[str], sizes: DataFrame, total: int) -> DataFrame:
    """Inner join of ``left`` with ``right``, which is unique on ``keys``.

    ``sizes`` holds the number of left rows per key as ``rows`` and ``total`` their sum. A
    key with more than ``HOT_ROWS`` of them is dealt out over as many copies of its right
    row. There are fewer such keys than total / HOT_ROWS, so their list can be broadcast.
    """
    if total <= HOT_ROWS:
        return left.join(right, keys)
    hot = sizes.where(F.col("rows") > HOT_ROWS).select(
        *keys, F.ceil(F.col("rows") / HOT_ROWS).alias("__splits"))
    hot = hot.hint("broadcast")
    dealt = F.coalesce(F.pmod(F.monotonically_increasing_id(), F.col("__splits")), F.lit(0))
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("__splits", F.lit(1)) - 1))
    left = left.join(hot, keys, "left").withColumn("__part", dealt).drop("__splits")
    right = right.join(hot, keys, "left").withColumn("__part", copies).drop("__splits")
    return left.join(right, [*keys, "__part"]).drop("__part")
