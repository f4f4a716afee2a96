"""SimHash near-duplicates: 64-bit fingerprints, searched with BK-trees.

Fingerprints within three bits agree on at least one of four blocks of bits. Equal blocks make
a shard; in a shard a BK-tree keeps every fingerprint under its parent by their Hamming
distance, and a search follows the edges within the radius alone. The trees of all shards
together hold every fingerprint, which no driver and no executor should, so trees and
searches of a shard meet by a shuffle and not by a broadcast. Shards that stay large are cut
again by blocks of the bits that are left.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import runs, small_batches, text_bytes
from kerbside.operators.components import connected_components
from kerbside.session import store

RADIUS = 3
SHARD = 2048   # fingerprints above which a shard is cut again
SEED = 42


def simhash(text: bytes, shingle: int = 3) -> int:
    """Fingerprint of a text given as UTF-8: A-Z lowered, words between white space, word
    shingles with repeats; a bit is set if it is set in over half of the hashes."""
    import numpy as np
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*[words[i:] for i in range(shingle)])))
    hasher, seed = xxhash.xxh64_intdigest, SEED
    hashes = np.array([hasher(s, seed) for s in shingles], np.uint64)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    set_bits = 2 * bits.sum(0, dtype=np.int64) > len(hashes)
    return int(np.packbits(set_bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, text_key, fp): the fingerprint of each row's whole text as a 64-bit integer."""
    def hashed(frames: Iterator) -> Iterator:
        for frame in frames:
            frame["fp"] = [simhash(text) for text in frame["text"]]
            yield frame[["key", "text_key", "fp"]]

    kind = docs.schema[id_column].dataType.simpleString()
    given = small_batches(docs).select(F.col(id_column).alias("key"), F.xxhash64(text_column).alias("text_key"),
                                       text_bytes(text_column).alias("text"))
    return given.mapInPandas(hashed, f"key {kind}, text_key long, fp long").withColumnRenamed("key", id_column)


def tree_links(values: list[int], radius: int = RADIUS) -> list[int]:
    """For each of these distinct fingerprints the position of the first one it is linked to,
    directly or by steps. Fingerprints enter a BK-tree one by one and are searched on entry."""
    mask = (1 << 64) - 1
    children: list[dict[int, int]] = [{}]
    root = list(range(len(values)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for new in range(1, len(values)):
        value, stack = values[new], [0]
        while stack:
            node = stack.pop()
            distance = ((value ^ values[node]) & mask).bit_count()
            if distance <= radius:
                a, b = find(node), find(new)
                root[max(a, b)] = min(a, b)
            below = children[node]
            for edge in range(max(1, distance - radius), distance + radius + 1):
                if edge in below:
                    stack.append(below[edge])
        node = 0
        while True:
            distance = ((value ^ values[node]) & mask).bit_count()
            if distance not in children[node]:
                children[node][distance] = new
                break
            node = children[node][distance]
        children.append({})
    return [find(i) for i in range(len(values))]


def _sharded(values: DataFrame, limit: int) -> DataFrame:
    """(shard, fp): values that agree on a block of bits, cut again while over ``limit``."""
    level, width, done = values.selectExpr("fp", "0L AS shard", "fp AS rest"), 64, None
    while True:
        q = width // 4
        mask = (1 << q) - 1
        held = (1 << width) - 1 if width < 64 else -1
        blocks = level.withColumn("block", F.explode(F.array(*[F.lit(i) for i in range(4)])))
        for_block = " ".join(
            f"WHEN {i} THEN named_struct('b', shiftrightunsigned(rest, {i * q}) & {mask}L, 'r', "
            + (f"(shiftrightunsigned(rest, {(i + 1) * q}) | shiftleft(rest, {width - (i + 1) * q})) & {held}L"
               if (i + 1) * q < width else "rest") + ")"
            for i in range(4))
        blocks = blocks.withColumn("x", F.expr(f"CASE block {for_block} END"))
        width -= q
        cut = blocks.select(
            "fp", F.xxhash64("shard", "block", "x.b").alias("shard"),
            F.expr(f"x.r & {(1 << width) - 1}L").alias("rest"))
        large = store(cut.groupBy("shard").count().where(F.col("count") > limit).select("shard"))
        if width < 28 or large.isEmpty():
            return cut.select("shard", "fp") if done is None else done.unionByName(cut.select("shard", "fp"))
        small = cut.join(large, "shard", "left_anti").select("shard", "fp")
        done = small if done is None else done.unionByName(small)
        level = store(cut.join(large, "shard", "left_semi"))


def linked(values: DataFrame, radius: int = RADIUS, limit: int = SHARD) -> DataFrame:
    """(node, component) of the distinct ``fp`` that have a neighbour within ``radius`` (3 at most)."""
    if radius > 3:
        raise ValueError("four blocks find pairs of up to three differing bits")

    def search(frames: Iterator) -> Iterator:
        import pandas as pd

        u, v = [], []
        for run in runs(frames, "shard"):
            if len(run) > 1:
                held = run["fp"].tolist()
                for i, first in enumerate(tree_links(held, radius)):
                    if first != i:
                        u.append(held[i])
                        v.append(held[first])
            if len(u) > 50_000:
                yield pd.DataFrame({"u": u, "v": v}, dtype="int64")
                u, v = [], []
        yield pd.DataFrame({"u": u, "v": v}, dtype="int64")

    shards = _sharded(values, limit).repartition("shard").sortWithinPartitions("shard")
    return connected_components(shards.mapInPandas(search, "u long, v long"))


def _grouped(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(__id, text_key, fp, first): ``first`` is the least id and text of the component, null last."""
    hashed = store(fingerprints(docs, id_column, text_column).withColumnRenamed(id_column, "__id"))
    own = F.struct(F.col("__id").isNull().alias("none"), F.col("__id").alias("id"), F.col("text_key").alias("key"))
    least = store(hashed.groupBy("fp").agg(F.min(own).alias("least")))
    groups = linked(least.select("fp")).withColumnRenamed("node", "fp")
    named = least.join(groups, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    roots = named.groupBy("component").agg(F.min("least").alias("first"))
    by_value = store(named.join(roots, "component").select("fp", "first"))
    return hashed.join(by_value, "fp")


def classes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, fp, component_id): one row per row of ``docs``; a component is named after the
    smallest id that links reach.

    Null and empty texts have fingerprint zero and link like any other. Repeated rows and ids
    give a row each; a component of null ids alone has no name. Other columns are not read. An
    empty table gives an empty one.
    """
    found = _grouped(docs, id_column, text_column)
    return found.select(F.col("__id").alias(id_column), "fp", F.col("first.id").alias("component_id"))


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the one of the least id, and of equal ids of the
    least text key. Of rows that repeat both, one stays."""
    found = _grouped(docs, id_column, text_column)
    kept = found.select(F.col("first.id").alias("__id"), F.col("first.key").alias("__key")).distinct()
    keyed = docs.withColumn("__text_key", F.xxhash64(text_column))
    rows = keyed.join(kept, F.col(id_column).eqNullSafe(F.col("__id")) & (F.col("__text_key") == F.col("__key")))
    return rows.dropDuplicates([id_column, "__text_key"]).drop("__id", "__key", "__text_key")
