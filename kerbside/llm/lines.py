"""Fuzzy line dedup by MinHash, in DataFrame operations only.

A line's signature are the minima, in 24 orders, of the hashes of all its character shingles: a
shingle counts in the three orders of its eighth of the hashes, and an eighth without a shingle
takes the minima of the next one that has any. Three minima of different eighths make a band. The lines of a bucket, which agree on a band, are first compared with
the first of them by the exact Jaccard similarity of all their character shingles, and the links
closed by union-find over the cluster. Where a bucket still holds several components, its lines
are compared across them, in blocks: a block yields the components that it links, not pairs of
lines, so that nothing is left out and nothing grows with the square of a bucket but comparisons.
Of every component the first line of the documents stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.operators.components import connected_components
from kerbside.session import broadcast_if, forget, store

SHINGLE = 10
BANDS, ROWS = 8, 3   # as many bands as eighths
TURNS = (3, 24, 45)  # bits by which a hash is turned left for each of a band's orders
AHEAD = (0, 1, 3)    # eighths ahead of a band's own from which its minima come: two bands share one at most
SIMILARITY = 0.8
BLOCK = 128       # lines of a bucket that one row gathers, on average
BLOCK_SHINGLES = 32_768   # and shingles of theirs
WORDS = 16        # of 64 bits: the bit map of a line's shingles


def _lines(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    given = docs.select(F.col(id_column).alias("__id"), F.col(text_column).cast("string").alias("text"))
    return given.select("__id", F.xxhash64("text").alias("text_key"),
                        F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))


def occurrences(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, text_key, pos, h): each line of each row; blank lines have a null h."""
    h = F.when(F.length(F.trim("line")) > 0, F.xxhash64("line"))
    return _lines(docs, id_column, text_column).select("__id", "text_key", "pos", h.alias("h"))


def signatures(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """(h, m0, m1, ...): the minima of each different line that has a shingle; those of a band are next to each other.

    Lines are shuffled once and signed where they come to lie. Shingles are flattened to rows, hashed once and
    reduced to the minima of their eighth, so that a shingle meets ``ROWS`` minima and not all. An order is that
    of the bits below a fixed one; an eighth's number is the first three bits, and the eighth next to it the one
    of the least exclusive or.
    """
    lines = docs.select(F.explode(F.split(F.col(text_column).cast("string"), "\n", -1)).alias("line")).where(
        F.length("line") >= SHINGLE)
    once = lines.groupBy(F.xxhash64("line").alias("h")).agg(F.first("line").alias("line"))
    cut = once.select("h", F.encode("line", "UTF-32").alias("code"))
    rows = cut.select("h", "code", F.explode(F.expr(_STARTS)).alias("k"))
    hashed = rows.selectExpr("h", f"xxhash64({_SHINGLE}) AS x")
    eighths = hashed.groupBy("h", F.shiftrightunsigned("x", 61).alias("eighth")).agg(*[
        F.min(F.expr(f"shiftleft(x, {t}) | shiftrightunsigned(x, {64 - t})")).alias(f"o{r}") for r, t in enumerate(TURNS)])
    held = eighths.groupBy("h").agg(*[
        F.min(F.expr(f"if(eighth = {i}, o{r}, null)")).alias(f"o{r}_{i}") for i in range(BANDS) for r in range(ROWS)])
    return held.select("h", *[
        F.coalesce(*[F.col(f"o{r}_{(b + AHEAD[r]) % BANDS ^ d}") for d in range(BANDS)]).alias(f"m{b * ROWS + r}")
        for b in range(BANDS) for r in range(ROWS)])


# A character of a line's ``code`` is four bytes, so that a shingle is found without a walk to it.
_STARTS = f"sequence(1, octet_length(code) - {4 * SHINGLE - 1}, 4)"
_SHINGLE = f"substring(code, k, {4 * SHINGLE})"


def buckets(signed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(u, v): each line with the first of its buckets; (h, band, n): lines in buckets of over two."""
    bands = F.array(*[F.xxhash64(F.lit(b), *[f"m{b * ROWS + r}" for r in range(ROWS)]) for b in range(BANDS)])
    banded = store(signed.select("h", bands.alias("bands"))).select("h", F.explode("bands").alias("band"))
    counted = store(banded.groupBy("band").agg(
        F.min("h").alias("low"), F.max("h").alias("high"), F.count("*").alias("n")).where("n > 1"))
    two = counted.where("n = 2").select(F.col("low").alias("u"), F.col("high").alias("v"))
    more = counted.where("n > 2").select("band", "low", "n")
    members = store(banded.join(broadcast_if(more, more.count()), "band"))
    pairs = members.where("h <> low").select(F.col("low").alias("u"), F.col("h").alias("v"))
    return pairs.unionByName(two).distinct(), members.select("h", "band", "n")


def across(members: DataFrame, texts: DataFrame, components: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(u, v): components that similar lines of a bucket link.

    Lines of a bucket with several components are gathered in blocks by a hash, and each two
    blocks compared as arrays, which leaves a tree of links for each group of components they link;
    ``texts`` has the lines of ``members`` and their numbers of
    shingles, which are cut anew for each block, as their hashes are much longer than a line. Two lines that
    meet in several buckets are compared in the one of the lowest band, of which all lines carry those
    below their bucket's (``e``). A bit that one line's map has and the other's has
    not stands for a shingle at least that they do not share: with too many of these, which is the
    rule, the pair needs no exact comparison.
    """
    named = members.drop("n").join(components.withColumnRenamed("node", "h"), "h", "left").withColumn(
        "c", F.coalesce("component", "h")).join(texts.select("h", "n"), "h")
    mixed = store(named.groupBy("band").agg(
        F.min("c").alias("a"), F.max("c").alias("b"), F.greatest(
            F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("parts")).where("a < b").select("band", "parts"))
    open_lines = named.join(broadcast_if(mixed, mixed.count()), "band").select("band", "parts", "h", "c", "n")
    several = texts.join(open_lines.groupBy("h").agg(F.collect_set("band").alias("bands")), "h")
    lower = F.filter("bands", lambda x: x < F.col("band")).alias("e")
    blocks = store(open_lines.join(several.select("h", "line", "bands").join(bit_maps(several), "h"), "h").groupBy(
        "band", "parts", F.pmod(F.xxhash64("h"), "parts").alias("part")).agg(
        F.collect_list(F.struct("c", "n", "w", "line", lower)).alias("rows")))
    one = blocks.where("part < parts - 1").select(
        "band", F.col("rows").alias("others"), F.explode(F.expr("sequence(part + 1, parts - 1)")).alias("part"))
    met = one.join(blocks, ["band", "part"]).select("rows", "others")
    # a generator, so that the shingles of a line are cut once and not for each pair
    def hashed(rows: str) -> str:
        return f"transform({rows}, r -> struct(r.c AS c, r.n AS n, r.w AS w, r.e AS e, {_shingles('r.line')} AS s))"

    met = met.select(F.expr(f"inline(array(struct({hashed('rows')} AS rows, {hashed('others')} AS others, false AS same)))"))
    own = blocks.select(F.expr(f"inline(array(struct({hashed('rows')} AS rows)))")).selectExpr("rows", "rows AS others", "true AS same")
    met = met.unionByName(own)
    # groups of linked components, joined by the lines one after another: a group of m of them
    # leaves m - 1 links, and lines already in one group need no comparison
    found = met.select(F.explode(F.expr(f"""flatten(transform(aggregate(rows, cast(array() AS array<array<bigint>>), (s, a) ->
        transform(array(transform(filter(others, b ->
        (a.c < b.c OR NOT same AND a.c > b.c) AND least(a.n, b.n) >= {similarity}D * greatest(a.n, b.n) - 1e-9D
        AND NOT arrays_overlap(a.e, b.e)
        AND (a.n - aggregate(zip_with(a.w, b.w, (x, y) -> bit_count(x & ~y)), 0, (t, k) -> t + k)) * {1 + similarity}D
            >= {similarity}D * (a.n + b.n) - 1e-9D
        AND NOT exists(s, g -> array_contains(g, a.c) AND array_contains(g, b.c))
        AND size(array_intersect(a.s, b.s)) * {1 + similarity}D >= {similarity}D * (a.n + b.n) - 1e-9D), b -> b.c)), found ->
        CASE WHEN size(found) = 0 THEN s ELSE transform(array(array_append(found, a.c)), l -> concat(
            filter(s, g -> NOT arrays_overlap(g, l)),
            array(array_distinct(concat(l, flatten(filter(s, g -> arrays_overlap(g, l))))))))[0] END)[0]),
        g -> transform(array_remove(g, array_min(g)), c -> struct(array_min(g) AS u, c AS v))))""")).alias("pair"))
    linked_pairs = store(found.select("pair.*").distinct())
    forget(mixed, blocks)
    return linked_pairs


def bit_maps(texts: DataFrame) -> DataFrame:
    """(h, w): for each line the map of its shingles, a bit for each by its hash."""
    rows = texts.select("h", F.encode("line", "UTF-32").alias("code")).select("h", "code", F.explode(F.expr(_STARTS)).alias("k"))
    bits = rows.selectExpr("h", f"xxhash64({_SHINGLE}) AS x").selectExpr(
        "h", f"x & {WORDS - 1} AS word", f"shiftleft(1L, cast(shiftright(x, {WORDS.bit_length()}) & 63 AS int)) AS bit")
    return bits.groupBy("h").agg(F.array(*[
        F.expr(f"bit_or(if(word = {i}, bit, 0L))") for i in range(WORDS)]).alias("w"))


def _shingles(line: str) -> str:
    """SQL for the hashes of a line's shingles; none for a line that is shorter than one."""
    return (f"flatten(transform(array(encode({line}, 'UTF-32')), code -> CASE WHEN octet_length(code) < {4 * SHINGLE}"
            f" THEN array() ELSE transform({_STARTS}, k -> xxhash64({_SHINGLE})) END))")


def line_texts(docs: DataFrame, pairs: DataFrame, text_column: str = "text") -> DataFrame:
    """(h, line, n): the lines of these pairs, read again from the documents, and their different shingles."""
    needed = store(pairs.select(F.col("u").alias("h")).unionByName(pairs.select(F.col("v").alias("h"))).distinct())
    lines = docs.select(F.explode(F.split(F.col(text_column).cast("string"), "\n", -1)).alias("line")).withColumn(
        "h", F.xxhash64("line"))
    found = lines.join(broadcast_if(needed, needed.count()), "h").groupBy("h").agg(F.first("line").alias("line"))
    return found.withColumn("n", F.expr(f"size(array_distinct({_shingles('line')}))"))


def similar(texts: DataFrame, pairs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs whose lines are similar enough; those whose sizes forbid it are not compared."""
    one, other = texts.selectExpr("h AS u", "line AS a", "n AS na"), texts.selectExpr("h AS v", "line AS b", "n AS nb")
    both = F.expr(f"size(array_intersect({_shingles('a')}, {_shingles('b')}))")
    fits = F.least("na", "nb") >= similarity * F.greatest("na", "nb") - 1e-9
    alike = F.when(fits, both * (1 + similarity) >= similarity * (F.col("na") + F.col("nb")) - 1e-9)
    return pairs.select("u", "v").join(one, "u").join(other, "v").where(alike).select("u", "v")


def linked(docs: DataFrame, similarity: float = SIMILARITY, text_column: str = "text") -> DataFrame:
    """(node, component) of the hashes of lines that are similar to another line."""
    signed = store(signatures(docs, text_column=text_column))
    pairs, members = buckets(signed)
    pairs = store(pairs)
    # the lines of the first pairs are all lines that share a bucket
    texts = store(line_texts(docs, pairs, text_column))
    components = connected_components(similar(texts, pairs, similarity))
    more = across(members, texts, components, similarity)
    if not more.isEmpty():
        components = connected_components(components.selectExpr("node AS u", "component AS v").unionByName(more))
    return components


def classes(docs: DataFrame, similarity: float = SIMILARITY, id_column: str = "doc_id",
            text_column: str = "text") -> DataFrame:
    """A row per line: id, text_key, pos, first_id, first_pos, kept.

    first_id and first_pos name the first line, by id and position, of the line's component.
    Lines shorter than a shingle are equal or not similar. Blank lines belong to no component
    and are kept. Null texts have no lines, empty ones a blank one. Rows that repeat both id and
    text are one document, so that their lines share their fate; null ids come first. Other
    columns are not read. An empty table gives an empty one.
    """
    found = store(occurrences(docs, id_column, text_column))
    components = linked(docs, similarity, text_column).withColumnsRenamed({"node": "h", "component": "c"})
    own = F.struct("__id", "pos", "text_key")
    by_line = found.where("h IS NOT NULL").groupBy("h").agg(F.min(own).alias("first"), F.count("*").alias("n"))
    named = store(by_line.join(components, "h", "left").withColumn("c", F.coalesce("c", "h")))
    groups = named.groupBy("c").agg(F.min("first").alias("first"), F.sum("n").alias("n")).where("n > 1")
    repeated = store(named.select("h", "c").join(groups.drop("n"), "c").drop("c"))
    # a line that a third of all documents hold meets one row
    joined = found.join(broadcast_if(repeated, repeated.count()), "h", "left")
    first = F.coalesce("first", own)
    return joined.select(
        F.col("__id").alias(id_column), "text_key", "pos", first["__id"].alias("first_id"),
        first["pos"].alias("first_pos"), first.eqNullSafe(own).alias("kept"))


def deduplicated(docs: DataFrame, similarity: float = SIMILARITY, id_column: str = "doc_id",
                 text_column: str = "text") -> DataFrame:
    """``docs`` with the lines that are kept; columns and rows stay, also rows left without a line."""
    lines = classes(docs, similarity, id_column, text_column)
    flags = lines.groupBy(id_column, "text_key").agg(
        F.array_sort(F.collect_set(F.struct("pos", "kept"))).alias("__flags"), F.min("kept").alias("__all"))
    flags = flags.where("NOT __all").select(F.col(id_column).alias("__id"), F.col("text_key").alias("__key"),
                                            F.col("__flags.kept").alias("__kept"))
    text = F.col(text_column)
    joined = docs.withColumn("__text_key", F.xxhash64(text.cast("string"))).join(
        flags, F.col(id_column).eqNullSafe(F.col("__id")) & (F.col("__text_key") == F.col("__key")), "left")
    rest = F.array_join(F.filter(F.split(text, "\n", -1), lambda x, i: F.col("__kept")[i]), "\n")
    return joined.select(*[
        (F.when(F.col("__kept").isNull(), text).otherwise(rest).alias(c) if c == text_column else F.col(f"`{c}`"))
        for c in docs.columns])
