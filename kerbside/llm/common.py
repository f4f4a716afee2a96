"""What several operators share: reading tables, whole texts as bytes, sorted runs of rows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# The white space of the word contract; the same six characters as bytes.split() uses.
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(column: str) -> Column:
    """A text as UTF-8 bytes, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")


def small_batches(df: DataFrame) -> DataFrame:
    """Marks that rows carry whole texts: Arrow batches are then bounded by bytes, too."""
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > 2_000:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    return df


PARTS = 4096   # fixed number of parts in which a group, however hot, is summed


def running_sums(items: DataFrame, group: str, weight: str, order: list[str], name: str) -> DataFrame:
    """Adds the sum of ``weight`` over the rows of the group that come before a row.

    Rows come by a hash of ``order`` and then by ``order``. A group is dealt into a fixed number
    of parts; what lies before a part is summed in a table of groups and parts.
    """
    dealt = items.withColumn("__part", F.pmod(F.xxhash64(*order), F.lit(PARTS)))
    totals = dealt.groupBy(group, "__part").agg(F.sum(weight).alias("__sum"))
    before = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(group, "__part", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__carried"))
    inside = Window.partitionBy(group, "__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = F.coalesce(F.sum(weight).over(inside), F.lit(0))
    return (dealt.withColumn("__local", local).join(carried, [group, "__part"])
            .withColumn(name, F.col("__carried") + F.col("__local")).drop("__part", "__local", "__carried"))


def runs(frames: Iterable, key: str) -> Iterator:
    """Frames with all rows of one key each, from frames sorted by key; a run may cross frames."""
    import numpy as np
    import pandas as pd

    held: list = []
    for frame in frames:
        if not len(frame):
            continue
        keys = frame[key].to_numpy()
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        if held and held[-1][key].iloc[-1] != keys[0]:
            yield pd.concat(held) if len(held) > 1 else held[0]
            held = []
        begin = 0
        for cut in cuts:
            held.append(frame.iloc[begin:cut])
            yield pd.concat(held) if len(held) > 1 else held[0]
            held, begin = [], cut
        held.append(frame.iloc[begin:])
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]
