"""The text pipeline: quality rules, line dedup, near-duplicates, mixing, packing.

Each stage takes all its predecessor kept, is written as Parquet and read again by the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm import mixing, packing, quality, simhash
from kerbside.llm import lines as line_dedup
from kerbside.session import forget, store


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.keep_good(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of lines alike, the first stays; n_chars follows the text."""
    return line_dedup.deduplicated(docs).withColumn("n_chars", F.length("text").cast("long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents alike, one stays: the one whose id names the group."""
    return simhash.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, whole: a document whose words are taken
    n times on average is repeated n times, rounded up or down by its hash."""
    return mixing.resampled(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), carry={"ids_crc32": F.crc32("ids")})


STAGES = [
    ("quality rules", quality_rules), ("line dedup", line_dedup_stage), ("near duplicates", near_duplicates),
    ("mixing sources", mix), ("packing", pack),
]
# Fitted probabilities, signatures and tokenizer ids decide the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents; what a stage wrote is deleted once the next one is written.

    Null ids and texts and repeated rows go through the stages as each of them says; an empty
    table gives an empty one. Columns whose names begin with two underscores are reserved.
    """
    docs, stored = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES[:-1]:
        before, stored = stored, store(stage(spark, docs, sf_dir))
        if before is not None:
            forget(before)
        docs = stored
    return STAGES[-1][1](spark, docs, sf_dir)
