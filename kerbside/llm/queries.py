"""Named queries over the text tables: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm import (
    caps, centroids, html, lines, mixing, oracle, packing, quality, ranking, secrets, sharding, simhash, tokens, warc,
)
from kerbside.llm.common import table


def op1_spherical_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return caps.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html.extracted(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    carry = {"ids_crc32": F.crc32("ids")}
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), carry=carry)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derivatives(warc.responses(table(spark, sf_dir, "pages")))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = tokens.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    return tokens.token_counts(table(spark, sf_dir, "documents"), pieces)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "posterior")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    counts = [F.expr(f"cast(size(filter(found, s -> s.kind = {i})) AS bigint) AS n_{kind}")
              for i, (kind, _, _) in enumerate(secrets.KINDS)]
    return found.select("doc_id", *counts, F.sha2(F.expr(secrets.digest("found", base=True)), 256).alias("base_sha256"),
                        F.expr(secrets.digest("found", base=False)).alias("spans"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.classes(table(spark, sf_dir, "documents")).drop("text_key").withColumnRenamed("pos", "line")


def op11_norm_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_interleaving(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.interleaved(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))


def op13_ns_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.summary(table(spark, sf_dir, "embeddings")).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


QUERIES = {f.__name__: f for f in (
    op1_spherical_caps, op2_html_text, op3_packing, op4_simhash, op5_warc_derivatives, op6_mixing, op7_token_counts, op8_quality,
    op9_secrets, op10_line_dedup, op11_norm_buckets, op12_interleaving, op13_ns_bounds)}
ORACLES: dict[str, str] = oracle.ORACLES
