"""Secret scans in DataFrame operations only.

Three fixed kinds of secrets are found by pattern. A battery of randomness tests adds more:
long tokens are given the smallest encoding alphabet that holds them, and are tested for
uniform use of it (chi-squared), for runs above and below its middle and for serial
correlation. Tokens whose tests reject randomness go, with the false discovery rate of that
controlled separately for each encoding and class of length, over all tokens of the corpus;
what is left looks drawn at random, as keys are.

Places come from cutting the text into what lies before a match and the match; lengths are
summed in a window over the matches of a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kerbside.session import store

# --- fixed values: the kinds as they are listed, their patterns and least lengths ---------
ASSIGN = ("(?:" + "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word) for word in (
    "password", "passwd", "secret", "token", "api_?key")) + ")[\"']?\\x20*[:=]\\x20*[\"']?")
KINDS = (
    ("assign", ASSIGN + "([A-Za-z0-9+/_.=-]+)", 12),
    ("access", "(AKIA[A-Z0-9]+)", 18),
    ("hex", "([0-9a-f]{16,})", 16),
    ("random", "([A-Za-z0-9+/_-]{20,}={0,2})", 20),
)
# Encodings from the smallest alphabet to the largest; a token has the first that holds it.
ENCODINGS = (
    ("hex", "0123456789abcdef"), ("HEX", "0123456789ABCDEF"), ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("lower36", "0123456789abcdefghijklmnopqrstuvwxyz"), ("upper36", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base62", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz+/-"),
)
# ------------------------------------------------------------------------------------------
RATE = 0.05   # false discoveries among the tokens called not random


def _matches(text: Column, pattern: str) -> Column:
    """The matches in order, each with the length of what lies before it, itself and its group."""
    cut = F.lit(f"(?s)(.*?)(?:({pattern})|\\z)")
    before, whole, group = (F.regexp_extract_all(text, cut, F.lit(k)) for k in (1, 2, 3))
    zipped = F.arrays_zip(
        F.transform(before, F.length).alias("before"), F.transform(whole, F.length).alias("whole"),
        group.alias("group"))
    return F.when(text.rlike(pattern), zipped)


def spans(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """(row, kind, start, end, group) of all matches of all kinds, from a column ``row``."""
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    found = docs.select("row", *[_matches(text, pattern).alias(kind) for kind, pattern, _ in KINDS])
    each = F.array(*[F.struct(F.lit(i).alias("kind"), F.col(kind).alias("m")) for i, (kind, _, _) in enumerate(KINDS)])
    by_kind = found.select("row", F.explode(each).alias("k")).where("k.m IS NOT NULL")
    rows = store(by_kind.select("row", F.col("k.kind").alias("kind"), F.posexplode("k.m").alias("pos", "m")).select(
        "row", "kind", "pos", F.col("m.before").alias("before"), F.col("m.whole").alias("whole"),
        F.col("m.group").alias("group")))
    till = Window.partitionBy("row", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    least = F.element_at(F.array(*[F.lit(n) for _, _, n in KINDS]), F.col("kind") + 1)
    return rows.withColumn("end", F.sum(F.col("before") + F.col("whole")).over(till)).withColumn(
        "start", F.col("end") - F.col("whole")).where(
        (F.length("group") >= least)).select("row", "kind", "start", "end", "group")


def _two_sided(z: str) -> str:
    """SQL of the chance of a normal value at least as far from zero (Abramowitz and Stegun 26.2.17)."""
    t = f"(1 / (1 + 0.2316419 * abs({z})))"
    series = f"({t} * (0.319381530 + {t} * (-0.356563782 + {t} * (1.781477937 + {t} * (-1.821255978 + {t} * 1.330274429)))))"
    return f"least(1D, 2 * exp(-least({z} * {z}, 1400D) / 2) / sqrt(2 * pi()) * {series})"


def tested(tokens: DataFrame) -> DataFrame:
    """Adds encoding, length and p, the chance that a random token tests as badly, to ``token``.

    Tokens of letters alone or of digits alone are words and numbers, and have no encoding.
    """
    bare = tokens.withColumn("bare", F.rtrim(F.col("token"), F.lit("=")))
    encoding = F.coalesce(*[F.when(F.col("bare").rlike(f"^[{a.replace('-', '')}{'-' if '-' in a else ''}]+$"),
                                   F.struct(F.lit(name).alias("encoding"), F.lit(a).alias("alphabet")))
                            for name, a in ENCODINGS])
    mixed = F.col("bare").rlike("[0-9]") & F.col("bare").rlike("[A-Za-z]")
    coded = bare.where(mixed).withColumn("e", encoding).select("*", "e.*").drop("e").where("encoding IS NOT NULL")
    placed = coded.withColumn("x", F.expr("transform(split(bare, '(?!^)(?!$)'), c -> instr(alphabet, c) - 1)"))
    sums = placed.selectExpr(
        "*", "size(x) AS n", "length(alphabet) AS k",
        "aggregate(array_distinct(x), 0D, (s, c) -> s + power(size(filter(x, y -> y = c)), 2)) AS squares",
        "aggregate(x, 0D, (s, y) -> s + y) / size(x) AS mean",
        "transform(x, y -> 2 * y > length(alphabet) - 1) AS high")
    parts = sums.selectExpr(
        "*", "size(filter(high, h -> h)) AS n1",
        "1 + size(filter(high, (h, i) -> i > 0 AND h <> high[i - 1])) AS runs",
        "aggregate(x, 0D, (s, y) -> s + power(y - mean, 2)) AS spread",
        "aggregate(sequence(1, size(x) - 1), 0D, (s, i) -> s + (x[i] - mean) * (x[i - 1] - mean)) AS serial")
    scored = parts.selectExpr(
        "*", "2D * n1 * (n - n1) / n + 1 AS m",
        # Wilson and Hilferty; only too uneven a use of the alphabet counts
        "greatest(0D, (power((squares * k / n - n) / (k - 1), 1 / 3D) - (1 - 2 / (9D * (k - 1))))"
        " / sqrt(2 / (9D * (k - 1)))) AS z1",
        "CASE WHEN spread > 0 THEN (serial / spread + 1 / n) * sqrt(n) ELSE 40 END AS z3")
    scored = scored.selectExpr(
        "*", "CASE WHEN n1 = 0 OR n1 = n THEN 40D WHEN (m - 1) * (m - 2) <= 0 THEN 0D"
        " ELSE (runs - m) / sqrt((m - 1) * (m - 2) / (n - 1)) END AS z2")
    p = f"least(1D, 3 * least({', '.join(_two_sided(z) for z in ('z1', 'z2', 'z3'))}))"
    return scored.selectExpr(*tokens.columns, "encoding", "n AS length", f"greatest(1e-300D, {p}) AS p")


def not_random(tests: DataFrame, rate: float = RATE) -> DataFrame:
    """(encoding, size_class, limit): tokens with p up to the limit are called not random.

    Benjamini and Hochberg's step-up rule within each encoding and doubling of length, over a
    histogram of p: the rule is applied at the upper edges of bins, which is on the safe side.
    """
    binned = tests.groupBy("encoding", "size_class", F.floor(-8 * F.log2("p")).alias("bin")).agg(F.count("*").alias("n"))
    kind = ["encoding", "size_class"]   # bounded: encodings by doublings, and some 8,000 bins
    smaller = Window.partitionBy(*kind).orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    ranked = binned.withColumn("i", F.sum("n").over(smaller)).withColumn("all", F.sum("n").over(Window.partitionBy(*kind)))
    edge = F.pow(F.lit(2.0), -F.col("bin") / 8)
    return ranked.where(edge <= F.col("i") * rate / F.col("all")).groupBy(*kind).agg(F.max(edge).alias("limit"))


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rate: float = RATE) -> DataFrame:
    """A row per row of ``docs``: id and ``found``, an array of (start, kind, end) in order.

    Start and end count code points. Null and empty texts have no secrets. Repeated rows and
    ids give a row each. Other columns are not read. An empty table gives an empty one.
    """
    ids = docs.select(F.col(id_column).alias("__id"), F.xxhash64(F.col(text_column)).alias("__key"))
    keyed = docs.select(F.struct(F.col(id_column).alias("__id"), F.xxhash64(F.col(text_column)).alias("__key")).alias(
        "row"), F.col(text_column).alias("__text"))
    # rows that repeat id and text have the same matches: each match once
    found = store(spans(keyed, "__text").distinct())
    random = len(KINDS) - 1
    size_class = F.floor(F.log2("length"))
    tests = store(tested(found.where(F.col("kind") == random).withColumnRenamed("group", "token")).withColumn(
        "size_class", size_class).select("row", "kind", "start", "end", "encoding", "size_class", "p"))
    judged = tests.join(F.broadcast(not_random(tests, rate)), ["encoding", "size_class"], "left")
    kept = judged.where("limit IS NULL OR p > limit").select("row", "kind", "start", "end")
    every = found.where(F.col("kind") < random).select("row", "kind", "start", "end").unionByName(kept)
    by_row = every.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("found"))
    by_row = by_row.select(F.col("row.__id").alias("__i"), F.col("row.__key").alias("__k"), "found")
    joined = ids.join(by_row, ids["__id"].eqNullSafe(by_row["__i"]) & (ids["__key"] == by_row["__k"]), "left")
    return joined.select(F.col("__id").alias(id_column), F.coalesce(
        "found", F.expr("cast(array() AS array<struct<start: bigint, kind: int, end: bigint>>)")).alias("found"))


def digest(found: str, base: bool) -> str:
    """SQL of the text kind:start:end, joined by commas, of the base kinds or of all."""
    names = ", ".join(f"'{kind}'" for kind, _, _ in KINDS)
    chosen = f"filter({found}, s -> s.kind < {len(KINDS) - 1})" if base else found
    return (f"array_join(transform({chosen}, s -> concat_ws(':', element_at(array({names}), s.kind + 1),"
            " cast(s.start AS string), cast(s.end AS string))), ',')")
