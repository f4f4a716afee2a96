"""Mixing sources to target weights, in DataFrame operations only.

Each source is laid out as one line of words, its documents in hashed order, and cut into
blocks of equal length. The output is a row of slots of one block each, dealt into shards. A
shard draws how many of its slots go to each source, a multinomial draw; what a source draws
over its quota goes to the sources that drew too little, so that the totals are the quotas.
The slots of a source are numbered through the shards and mapped to its blocks by a
pseudorandom permutation of block numbers, another one for each pass over the source. What is
taken of a document is counted by joining the blocks it lies in on their number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import WORD, running_sums
from kerbside.operators.ordering import zip_with_index
from kerbside.session import broadcast_if, store

BLOCK = 128       # words of a block
SHARD = 4096      # slots of an output shard
CAP = 3           # a source is used up to so many times
ROUNDS = 16       # of the permutation
STRETCHES = 4096  # pieces, at least, that the tickets of all quotas are cut into to find a source
SEED = 42


def source_targets(sizes: DataFrame, cap: int = CAP) -> DataFrame:
    """(source, source_size) with sid, weight and target.

    Sources by code point, null last, weigh 1, 2, 3 in turn and share the sum of all sizes. A
    target stops at ``cap`` times the source's size; the excess is shared again by weight.
    """
    keyed = sizes.withColumn("__null", F.col("source").isNull())
    numbered = zip_with_index(keyed, "__null", "source", name="sid", start=0).drop("__null")
    weighed = store(numbered.withColumn("weight", F.col("sid") % 3 + 1))
    total, weights = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    if not total:
        return weighed.withColumn("target", F.lit(0.0))
    level = total / weights
    while True:   # a round for each time that the excess makes further sources full
        full = F.col("weight") * F.lit(level) > cap * F.col("source_size")
        held, rest = weighed.agg(
            F.sum(F.when(full, cap * F.col("source_size")).otherwise(0)),
            F.sum(F.when(full, 0).otherwise(F.col("weight")))).first()
        above = (total - held) / rest if rest else level
        if above <= level:
            break
        level = above
    return weighed.withColumn(
        "target", F.least(F.col("weight") * F.lit(float(level)), (cap * F.col("source_size")).cast("double")))


def laid_out(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
             source_column: str = "source") -> tuple[DataFrame, DataFrame]:
    """Documents with size, sid and their place in the line of their source; and the sources."""
    words = F.regexp_count(F.coalesce(F.col(text_column).cast("string"), F.lit("")), F.lit(WORD))
    sized = store(docs.select(
        F.col(id_column).alias("__id"), F.col(source_column).cast("string").alias("source"),
        words.cast("long").alias("size"), F.xxhash64(text_column).alias("__text")))
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = store(source_targets(sizes))
    known = broadcast_if(sources.withColumnRenamed("source", "__source"), sources.count())
    joined = sized.join(known, F.col("source").eqNullSafe(F.col("__source"))).drop("__source", "weight", "source")
    return running_sums(joined, "sid", "size", ["__id", "size", "__text"], "position"), sources


def slots(sources: DataFrame, block: int = BLOCK, shard: int = SHARD, seed: int = SEED) -> DataFrame:
    """(shard, sid, number): the slots of each shard and their number among the source's slots."""
    passes = F.floor(F.col("target") / F.col("source_size"))
    rest = F.round((F.col("target") - passes * F.col("source_size")) / block).cast("long")
    quotas = sources.where("source_size > 0").select(
        "sid", F.ceil(F.col("source_size") / block).alias("blocks"), passes.alias("__passes"), rest.alias("__rest"))
    quotas = quotas.select("sid", "blocks", (
        F.col("__passes") * F.col("blocks") + F.least("__rest", F.col("blocks"))).alias("quota")).where("quota > 0")
    quotas = store(running_sums(quotas.withColumn("__all", F.lit(0)), "__all", "quota", ["sid"], "begin"))
    total = quotas.agg(F.sum("quota")).first()[0] or 0
    spark = sources.sparkSession
    # a ticket for each slot of a quota; a slot draws one with replacement, and finds the source
    # whose quota it lies in among those of its stretch of tickets
    count = quotas.count()
    width = max(1, -(-total // max(STRETCHES, 4 * count)))
    ranges = quotas.select("sid", "begin", "quota", F.explode(F.expr(
        f"sequence(begin div {width}, (begin + quota - 1) div {width})")).alias("stretch"))
    drawn = spark.range(total).select(
        F.expr(f"id div {shard}").alias("shard"), F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(max(total, 1))).alias("ticket"))
    drawn = drawn.withColumn("stretch", F.expr(f"ticket div {width}"))
    found = drawn.join(broadcast_if(ranges, STRETCHES + 6 * count), "stretch").where("ticket >= begin AND ticket < begin + quota")
    counts = store(found.groupBy("shard", "sid").agg(F.count("*").alias("n")))
    numbered = running_sums(counts, "sid", "n", ["shard"], "first").join(quotas.select("sid", "quota"), "sid")
    kept = store(numbered.withColumn("n", F.expr("greatest(0, least(n, quota - first))")).where("n > 0").select(
        "shard", "sid", "first", "n"))
    # what is short of the quotas goes to the slots that were drawn in vain, in order
    have = kept.groupBy("sid").agg(F.sum("n").alias("have"))
    short = quotas.join(have, "sid", "left").selectExpr(
        "0 AS `__all`", "sid", "coalesce(have, 0L) AS have", "quota - coalesce(have, 0L) AS n").where("n > 0")
    filled = kept.groupBy("shard").agg(F.sum("n").alias("filled"))
    shards = spark.range(-(-total // shard)).withColumnRenamed("id", "shard").join(filled, "shard", "left")
    vain = shards.selectExpr("0 AS `__all`", "shard", f"least({shard}L, {total}L - shard * {shard}L)"
                             " - coalesce(filled, 0L) AS n").where("n > 0")
    short = running_sums(short, "__all", "n", ["sid"], "begin").select(
        "sid", "have", F.posexplode(F.expr("sequence(begin, begin + n - 1)")).alias("k", "unit"))
    vain = running_sums(vain, "__all", "n", ["shard"], "begin").select(
        "shard", F.explode(F.expr("sequence(begin, begin + n - 1)")).alias("unit"))
    extra = short.join(vain, "unit").select("shard", "sid", F.expr("have + k").alias("number"))
    return kept.select("shard", "sid", F.explode(F.expr("sequence(first, first + n - 1)")).alias("number")).unionByName(
        extra).join(broadcast_if(quotas.select("sid", "blocks"), quotas.count()), "sid")


def permuted(number: str, size: str, keys: list[str], rounds: int = ROUNDS) -> str:
    """SQL of a pseudorandom permutation of 0 .. size - 1, a swap-or-not network: each round
    pairs x with key - x and swaps the two, or not, by a bit that is the same for both."""
    key = f"xxhash64({', '.join(keys)}, r)"
    partner = f"pmod(pmod({key}, {size}) - x, {size})"
    return (f"aggregate(sequence(0, {rounds - 1}), {number}, (x, r) -> CASE WHEN"
            f" (xxhash64({', '.join(keys)}, r, greatest(x, {partner})) & 1L) = 1L THEN {partner} ELSE x END)")


def mixed_blocks(sources: DataFrame, block: int = BLOCK, shard: int = SHARD, seed: int = SEED) -> DataFrame:
    """(shard, sid, block): the blocks of the mix, a row for each slot."""
    numbered = slots(sources, block, shard, seed).selectExpr(
        "shard", "sid", "blocks", "number div blocks AS pass", "number % blocks AS place")
    return numbered.select("shard", "sid", F.expr(
        permuted("place", "blocks", [f"{seed}", "sid", "pass"])).alias("block"))


def taken(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
          block: int = BLOCK) -> DataFrame:
    """(id, size, source_size, target, taken): how many words the mix takes of each document.

    Null texts have size 0 and nothing is taken of them. Null is a source of its own. Repeated
    rows and ids are documents of their own and count each. Other columns are not read. No
    document is taken more than three times. An empty table gives an empty one.
    """
    placed, sources = laid_out(docs, id_column, text_column, source_column)
    placed = store(placed)
    times = mixed_blocks(sources, block).groupBy("sid", "block").agg(F.count("*").alias("times"))
    row = ["sid", "position", "__id", "size", "source_size", "target"]
    parts = placed.where("size > 0").select(*row, F.explode(F.expr(
        f"sequence(position div {block}, (position + size - 1) div {block})")).alias("block"))
    overlap = F.expr(f"least(position + size, (block + 1) * {block}) - greatest(position, block * {block})")
    counted = parts.join(times, ["sid", "block"], "left").groupBy(*row).agg(
        F.sum(overlap * F.coalesce("times", F.lit(0))).alias("taken"))
    empty = placed.where("size = 0").select(*row, F.lit(0).cast("long").alias("taken"))
    return counted.unionByName(empty).select(
        F.col("__id").alias(id_column), "size", "source_size", "target", "taken")


def resampled(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
              source_column: str = "source") -> DataFrame:
    """``docs`` with each row as often as the mix takes it, to the nearest whole number by a
    hash of the row; rows that are not taken go, rows without words stay. Columns are kept.

    Rows alike in id, source and text are taken alike. The documents meet their counts in a
    join on (id, size), so that texts are read again and not stored.
    """
    counts = taken(docs, id_column, text_column, source_column).groupBy(id_column, "size").agg(
        F.max("taken").alias("__taken")).withColumnsRenamed({id_column: "__id", "size": "__words"})
    words = F.regexp_count(F.coalesce(F.col(text_column).cast("string"), F.lit("")), F.lit(WORD)).cast("long")
    joined = docs.withColumn("__size", words).join(
        counts, F.col(id_column).eqNullSafe(F.col("__id")) & (F.col("__size") == F.col("__words")))
    share = F.col("__taken") / F.greatest(F.col("__size"), F.lit(1))
    chance = F.pmod(F.xxhash64("__id", "__size", F.lit(SEED)), F.lit(1_000_000)) / 1_000_000
    copies = F.when(F.col("__size") == 0, 1).otherwise(F.floor(share + chance)).cast("int")
    often = joined.withColumn("__copies", copies).where("__copies > 0")
    return often.withColumn("__copy", F.explode(F.expr("sequence(1, __copies)"))).select(
        *[F.col(f"`{c}`") for c in docs.columns])
