"""Sharding by proportional stratified interleaving, in DataFrame operations only.

The rows of a source are shuffled by a seeded hash and ranked; a row's place is its fractional
rank, (rank + offset) / rows of the source, with one pseudorandom offset for each source. In the
order of places every source runs evenly from the first row to the last, so cutting that order
into runs of equal length gives every shard the mixture of the whole.

No sort of the whole table in one piece: a source is ranked in hashed parts, and places are cut
into equal intervals, which hold nearly equal numbers of rows, as every source is spread evenly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kerbside.llm.common import running_sums
from kerbside.session import broadcast_if, store

SHARDS = 40
SEED = 42
INTERVAL = 10_000    # rows of an interval of places, on average
INTERVALS = 65_536   # intervals at most; they get longer beyond
OVERHEAD = 16        # bytes of a row besides its text


def _row_hash(docs: DataFrame, columns: list[str]) -> Column:
    """A hash of these columns; maps, which have no hash, as JSON."""
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    return F.xxhash64(F.lit(0), *[
        F.to_json(F.struct(F.col(f"`{c}`"))) if "map<" in kinds[c] or kinds[c] == "variant" else F.col(f"`{c}`")
        for c in columns])


def interleaved(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, id_column: str = "doc_id",
                text_column: str = "text", source_column: str = "source", carry: list[str] | None = None) -> DataFrame:
    """(id, size, text_crc32, shard, slot) and the columns ``carry`` of every row.

    Shards differ by one row at most; slots count from 0 in each. In a shard a source has its
    share of the rows, up to a row or so for each source. Null is a source of its own, null
    texts have no bytes, null ids and repeated rows are rows like any other. With fewer rows
    than shards some shards are empty. The same rows and seed give the same shards, however
    they are partitioned. Carried columns named like a result column give way to it. An empty
    table gives an empty one.
    """
    result = [id_column, "size", "text_crc32", "shard", "slot"]
    kept = [c for c in carry or [] if c not in result]
    text = F.coalesce(F.col(text_column).cast("string"), F.lit("")).cast("binary")
    rows = store(docs.select(
        F.struct(F.col(f"`{id_column}`").alias("id"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)]).alias("row"),
        # null is a source apart from the empty name
        F.coalesce(F.concat(F.lit("="), F.col(source_column).cast("string")), F.lit("")).alias("source"),
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text).alias("crc"),
        F.xxhash64(F.lit(seed), F.col(f"`{id_column}`"), F.col(text_column).cast("string")).alias("key"),
        _row_hash(docs, [id_column, text_column, *kept]).alias("tie")))
    sizes = store(rows.groupBy("source").agg(F.count("*").alias("n")))
    sources, total = sizes.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    total_rows = max(total, 1)
    # equal rows are equal in every column, so it does not matter which of them is which
    order = ["key", "tie"]
    ranked = running_sums(rows.withColumn("one", F.lit(1).cast("long")), "source", "one", order, "rank")
    offset = F.pmod(F.xxhash64("source", F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)
    intervals = min(INTERVALS, -(-total_rows // INTERVAL))
    place = (F.col("rank") + offset) / F.col("n")
    placed = ranked.join(broadcast_if(sizes, sources), "source").withColumn("place", place).withColumn(
        "interval", F.least(F.floor(F.col("place") * intervals), F.lit(intervals - 1)).cast("int"))
    placed = store(placed.select("row", "size", "crc", "place", "interval", "source", *order))
    # a row for each interval, INTERVALS at most
    before = Window.orderBy("interval").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("interval").agg(F.count("*").alias("held")).select(
        "interval", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("begin"))
    inside = F.row_number().over(Window.partitionBy("interval").orderBy("place", "source", *order))
    numbered = placed.withColumn("inside", inside).join(F.broadcast(counts), "interval").selectExpr(
        "row", "size", "crc", "begin + inside - 1 AS number")
    cut = numbered.withColumn("shard", F.expr(f"number * {shards} div {total_rows}"))
    first = F.expr(f"(shard * {total_rows} + {shards - 1}) div {shards}")
    return cut.select(
        F.col("row.id").alias(id_column), "size", F.col("crc").cast("long").alias("text_crc32"),
        F.col("shard").cast("int").alias("shard"), (F.col("number") - first).cast("long").alias("slot"),
        *[F.col(f"row.c{i}").alias(c) for i, c in enumerate(kept)])


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED, **columns: str) -> None:
    """Whole rows as Parquet, a folder for each shard; files hold runs of slots in order, so a
    shard of any size takes as many files as tasks wrote it."""
    out = store(interleaved(docs, shards, seed, carry=docs.columns, **columns))
    out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
