"""Global order without a single-partition window.

Rows are range-partitioned on a unique key and written once, so the partition a row is in
cannot change between readers; whatever crosses a partition border is then a matter of one
summary row per partition. Row numbers and next values move every row once.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kerbside.session import materialise

_PART = "__part"


def range_parts(df: DataFrame, *keys: str) -> DataFrame:
    """Range-partitioned and materialised, with the partition number as a column.

    The keys together should be unique: equal keys cannot be told apart by a range.
    """
    return materialise(df.repartitionByRange(*keys).withColumn(_PART, F.spark_partition_id()))


def zip_with_index(df: DataFrame, *keys: str, name: str = "index", start: int = 1) -> DataFrame:
    """Consecutive numbers in key order, counted per range partition.

    Rows with equal keys are numbered in any order, and kept apart by a row number, so
    that very many copies of a row still spread over partitions.
    """
    sorted_rows = df.withColumn("__copy", F.monotonically_increasing_id()).repartitionByRange(
        *keys, "__copy").sortWithinPartitions(*keys, "__copy").drop("__copy")
    # such an id is the number of the partition and, in 33 bits, of the row in it
    parts = materialise(sorted_rows.withColumn("__id", F.monotonically_increasing_id()))
    part, local = F.shiftright("__id", 33), F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = parts.groupBy(part.alias(_PART)).agg(F.count("*").alias("__rows"))
    # one row per partition, so the unpartitioned window and the broadcast are bounded
    before = F.coalesce(
        F.sum("__rows").over(Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select(_PART, (before + start).alias("__before"))
    return (
        parts.withColumn(_PART, part).join(F.broadcast(offsets), _PART)
        .select(*df.columns, (F.col("__before") + local).cast("long").alias(name))
    )


def running_total(df: DataFrame, group: str, order: list[str], value: str, name: str) -> DataFrame:
    """Sum of ``value`` over the rows that precede a row in its group, in ``order``.

    A group that fills many partitions is summed per partition first; (group, order) must
    be unique.
    """
    parts = range_parts(df, group, *order)
    sums = parts.groupBy(group, _PART).agg(F.sum(value).alias("__sum"))
    # at most one row per partition and group
    carried = sums.select(group, _PART, F.coalesce(F.sum("__sum").over(
        Window.partitionBy(group).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("__carried"))
    local = F.coalesce(F.sum(value).over(
        Window.partitionBy(group, _PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (
        parts.withColumn("__local", local).join(carried, [group, _PART])
        .select(*df.columns, (F.col("__carried") + F.col("__local")).alias(name))
    )


def next_values(values: DataFrame, column: str) -> DataFrame:
    """Distinct numbers with the next larger one; the largest has none. Nulls are left out.

    Values are cut into as many ranges as there are partitions, by quantiles; a range is kept
    together, so that finding distinct values and their followers needs no other shuffle.
    """
    given = values.select(F.col(column)).where(F.col(column).isNotNull())
    parts = int(given.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = sorted(set(given.approxQuantile(column, [i / parts for i in range(1, parts)], 0.1 / parts))) if parts > 1 else []
    if bounds:
        ranges = Bucketizer(splits=[-math.inf, *bounds, math.inf], inputCol="__number", outputCol="__range")
        ranged = ranges.transform(given.withColumn("__number", F.col(column).cast("double"))).select(
            column, F.col("__range").cast("int").alias(_PART))
    else:
        ranged = given.withColumn(_PART, F.lit(0))
    distinct = materialise(ranged.repartition(_PART).groupBy(_PART, column).agg(F.lit(1).alias("__one")).select(
        _PART, column, F.lead(column).over(Window.partitionBy(_PART).orderBy(column)).alias("__inside")))
    firsts = distinct.groupBy(_PART).agg(F.min(column).alias("__first"))
    # one row per range
    following = firsts.select(_PART, F.lead("__first").over(Window.orderBy(_PART)).alias("__following"))
    return distinct.join(F.broadcast(following), _PART).select(
        column, F.coalesce("__inside", "__following").alias("next"))


def page(df: DataFrame, key: str, number: int, size: int = 10) -> DataFrame:
    """Rows (number-1)*size+1 to number*size in key order."""
    skipped = (number - 1) * size
    if skipped + size <= 10_000:
        return df.orderBy(key).offset(skipped).limit(size)
    # far into the table a sorted prefix would gather in one task; number the rows instead
    indexed = zip_with_index(df, key, name="__index")
    rows = indexed.where(F.col("__index").between(skipped + 1, skipped + size))
    return rows.drop("__index").orderBy(key)


def page_count(df: DataFrame, size: int = 10) -> DataFrame:
    return df.agg(F.ceil(F.count("*") / size).cast("long").alias("pages"))
