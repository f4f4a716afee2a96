"""Near-duplicate vectors by spherical-cap filters.

A filter is a direction; a vector belongs to every filter whose inner product with it exceeds a
threshold. Directions form a random product code: coordinates are mixed by a pseudorandom
rotation and cut into blocks, each block has a small list of random words, and every choice of
one word per block is a direction. A vector is decoded to its directions block by block, cutting
off what cannot reach the threshold any more. Vectors meet in a join on (group, filter) and
their cosines are computed in double precision. A pair that meets in several filters counts in
the first of them.

Equal vectors are one vector with a weight. Filters with many vectors are dealt into pairs of
chunks, so that no task holds more than two chunks at a time, and a task returns one row per
vector, not per pair: how many it is linked to and the root of its local component.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import runs
from kerbside.operators.components import connected_components
from kerbside.session import store

SIMILARITY = 0.93
BLOCKS, WORDS = 2, 400     # directions: WORDS ** BLOCKS
THRESHOLD = 3.8            # in standard deviations of an inner product
LEAST = 32                 # directions a vector gets at least, the best ones
CHUNK = 1024               # vectors of a filter that are compared at once
SEED = 42


class Code:
    """The product code for vectors of one length."""

    def __init__(self, length: int, seed: int = SEED) -> None:
        import numpy as np

        random = np.random.default_rng([seed, length])
        size = max(BLOCKS, 1 << (length - 1).bit_length())
        self.size, self.signs = size, random.choice([-1.0, 1.0], (2, size))
        self.edges = np.linspace(0, size, BLOCKS + 1).astype(int)
        self.words = [random.standard_normal((WORDS, b - a)) for a, b in zip(self.edges, self.edges[1:])]

    def scores(self, unit):
        """Inner products of each unit vector with the words of each block."""
        import numpy as np

        x = np.zeros((len(unit), self.size))
        x[:, :unit.shape[1]] = unit
        if self.size & (self.size - 1) == 0:
            for signs in self.signs:   # two rounds of signs and a Hadamard transform
                x = x * signs
                half = 1
                while half < self.size:
                    x = x.reshape(len(unit), -1, 2, half)
                    x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], 2).reshape(len(unit), -1)
                    half *= 2
                x = x / np.sqrt(self.size)
        return [np.einsum("nd,wd->nw", x[:, a:b], w) for a, b, w in zip(self.edges, self.edges[1:], self.words)]

    def decode(self, unit) -> list:
        """For each unit vector the sorted numbers of its directions."""
        blocks = self.scores(unit)
        return [self._directions([b[i] for b in blocks]) for i in range(len(unit))]

    @staticmethod
    def _directions(scores: list):
        import numpy as np

        threshold = THRESHOLD
        while True:
            top = [float(s.max()) for s in scores]
            held, total = np.zeros(1, np.int64), np.zeros(1)
            for k, s in enumerate(scores):
                rest = sum(top[k + 1:])
                sums = total[:, None] + s
                a, b = np.nonzero(sums >= threshold - rest)
                held, total = held[a] * WORDS + b, sums[a, b]
            if len(held) >= LEAST or threshold < -50:
                if threshold < THRESHOLD:
                    held = held[np.argsort(-total, kind="stable")[:LEAST]]
                return np.sort(held).astype(np.int32)
            threshold -= 0.25   # few directions exceed: take the best


def _unit(vectors):
    import numpy as np

    x = np.stack(vectors).astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)   # against overflow of squares
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def decoded(groups: DataFrame) -> DataFrame:
    """(rep, weight, label, vector, filters) from (rep, weight, label, vector)."""
    def decode(frames: Iterator) -> Iterator:
        codes: dict[int, Code] = {}
        for frame in frames:
            for begin in range(0, len(frame), 1000):
                part = frame.iloc[begin:begin + 1000]
                filters = [None] * len(part)
                lengths = [len(v) for v in part["vector"]]
                for length in set(lengths):
                    at = [i for i, n in enumerate(lengths) if n == length]
                    code = codes.setdefault(length, Code(length))
                    for i, found in zip(at, code.decode(_unit([part["vector"].iloc[i] for i in at]))):
                        filters[i] = found
                yield part.assign(filters=filters)

    return groups.mapInPandas(decode, groups.schema.simpleString()[7:-1] + ", filters array<int>")


def _compared(run, similarity: float):
    """Links of one bucket or pair of chunks: (rep, root, links) per vector with a link."""
    import numpy as np
    import pandas as pd

    unit = _unit(run["vector"].to_list())
    rep, weight, side = (run[c].to_numpy() for c in ("rep", "weight", "side"))
    filters, bucket = run["filters"].to_list(), int(run["filter"].iloc[0])
    width = max(map(len, filters))
    lists = np.full((len(run), width), -1, np.int64)
    for i, own in enumerate(filters):
        lists[i, :len(own)] = own
    first, second = [], []
    across = len(np.unique(side)) > 1
    rows = np.flatnonzero(side == 0) if across else np.arange(len(run))
    columns = np.flatnonzero(side == 1) if across else np.arange(len(run))
    for begin in range(0, len(rows), 256):
        part = rows[begin:begin + 256]
        i, j = np.nonzero(np.einsum("ik,jk->ij", unit[part], unit[columns]) >= similarity)
        i, j = part[i], columns[j]
        kept = slice(None) if across else i < j
        first.append(i[kept])
        second.append(j[kept])
    i, j = np.concatenate(first), np.concatenate(second)
    root = np.arange(len(run))
    while len(i):
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        root = root[root]
        if (root == before).all():
            break
    met = np.unique(np.concatenate([i, j]))
    links = np.zeros(len(run), np.int64)
    for begin in range(0, len(i), 200_000):
        a, b = i[begin:begin + 200_000], j[begin:begin + 200_000]
        for k in range(width):   # a filter before this one that both have: counted there
            if not len(a):
                break
            earlier = lists[a, k]
            new = ~((earlier >= 0) & (earlier < bucket) & (lists[b] == earlier[:, None]).any(1))
            a, b = a[new], b[new]
        np.add.at(links, a, weight[b])
        np.add.at(links, b, weight[a])
    return pd.DataFrame({"u": rep[met], "v": rep[root[met]], "links": links[met]})


def linked(vectors: DataFrame, similarity: float = SIMILARITY, chunk: int = CHUNK) -> DataFrame:
    """(rep, root, links): of decoded vectors, a row per vector and bucket in which it has a link."""
    members = vectors.select("rep", "label", "dimension", F.explode("filters").alias("filter"))
    sizes = members.groupBy("label", "dimension", "filter").agg(F.count("*").alias("n")).where("n > 1")
    met = members.join(sizes, ["label", "dimension", "filter"]).select("rep", "filter", "n")
    met = met.join(vectors, "rep")   # the vectors travel once, to the buckets with company
    parts = F.expr(f"cast(ceil(n / {chunk}) as int)")
    own = F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")
    dealt = met.withColumn("parts", parts).withColumn("own", own).withColumn(
        "other", F.explode(F.expr("sequence(0, parts - 1)")))
    keyed = dealt.select(
        F.xxhash64("label", "dimension", "filter", F.least("own", "other"), F.greatest("own", "other")).alias("key"),
        "label", "dimension", "filter", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        F.when(F.col("own") > F.col("other"), 1).otherwise(0).alias("side"), "rep", "weight", "vector", "filters")

    def compare(frames: Iterator) -> Iterator:
        for run in runs(frames, "key"):
            # buckets that share a key by chance are told apart
            for _, bucket in run.groupby(["label", "dimension", "filter", "low", "high"], sort=False):
                if len(bucket) > 1:
                    found = _compared(bucket.reset_index(drop=True), similarity)
                    if len(found):
                        yield found

    return keyed.repartition("key").sortWithinPartitions("key").mapInPandas(compare, "u long, v long, links long")


def near_duplicates(rows: DataFrame, similarity: float = SIMILARITY, id_column: str = "vec_id",
                    vector_column: str = "embedding", label_column: str = "label") -> DataFrame:
    """(id, n_links, component_id, kept): vectors of equal label linked at ``similarity`` or more.

    Null labels, and vectors that are null, empty, zero or hold null or non-finite components,
    are linked with nothing; vectors of different lengths neither. Repeated rows are linked
    with each other and get a row each; null ids are kept and name a component only if it has
    no other. Other columns are not read. An empty table gives an empty one.
    """
    given = rows.select(
        F.col(id_column).alias("__id"), F.col(label_column).cast("string").alias("label"),
        F.col(vector_column).alias("vector"))
    usable = F.expr(
        "label IS NOT NULL AND vector IS NOT NULL AND forall(vector, x -> x IS NOT NULL AND NOT isnan(x)"
        " AND abs(x) < double('infinity')) AND exists(vector, x -> x <> 0)")
    valid, rest = given.where(usable), given.where(~F.coalesce(usable, F.lit(False)))
    groups = valid.groupBy("label", "vector").agg(F.min("__id").alias("least"), F.count("*").alias("weight"))
    groups = store(groups.withColumn("rep", F.monotonically_increasing_id()))
    vectors = store(decoded(groups.select("rep", "weight", "label", F.size("vector").alias("dimension"), "vector")))
    found = store(linked(vectors, similarity).groupBy("u", "v").agg(F.sum("links").alias("links")))
    components = connected_components(found.select("u", "v")).withColumnRenamed("node", "rep")
    links = found.groupBy(F.col("u").alias("rep")).agg(F.sum("links").alias("links"))
    named = groups.join(components, "rep", "left").join(links, "rep", "left").select(
        "label", "vector", "least", "weight", F.coalesce("component", "rep").alias("component"),
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    roots = named.groupBy("component").agg(F.min("least").alias("component_id"))
    result = named.join(roots, "component").select("label", "vector", "n_links", "component_id")
    # most rows stand alone; a vector with very many copies meets one row
    linked_rows = valid.join(result, ["label", "vector"]).select("__id", "n_links", "component_id")
    alone = rest.select("__id", F.lit(0).cast("long").alias("n_links"), F.col("__id").alias("component_id"))
    return linked_rows.unionByName(alone).select(
        F.col("__id").alias(id_column), "n_links", "component_id",
        F.col("__id").eqNullSafe(F.col("component_id")).alias("kept"))
