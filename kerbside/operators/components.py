"""Connected components by alternating large-star and small-star rounds.

Published as "Connected Components in MapReduce and Beyond" (Kiveris et al., 2014). Each
half round is a minimum per vertex, which combines before the shuffle, and a join back on
the vertex, whose one-row side lets a vertex with very many neighbours be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.operators.skew import join_unique
from kerbside.session import materialise


def _attach_minimum(edges: DataFrame, total: int) -> DataFrame:
    lowest = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("rows"))
    joined = join_unique(edges, lowest.drop("rows"), ["u"], lowest.select("u", "rows"), total)
    return joined.selectExpr("u", "v", "least(u, m) AS m")


def _large_star(edges: DataFrame, total: int) -> DataFrame:
    both = edges.unionAll(edges.selectExpr("v AS u", "u AS v"))
    return _attach_minimum(both, 2 * total).where("v > u").selectExpr("v AS u", "m AS v")


def _small_star(edges: DataFrame, total: int) -> DataFrame:
    down = edges.selectExpr("greatest(u, v) AS u", "least(u, v) AS v")
    linked = _attach_minimum(down, total)
    moved = linked.where("v <> m").selectExpr("v AS u", "m AS v")
    return moved.unionAll(linked.selectExpr("u", "m AS v")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of an edge list (u, v); a component is named
    after its lowest node."""
    def state(df: DataFrame) -> tuple:
        mix = F.xxhash64("u", "v").cast("decimal(38,0)")
        return tuple(df.agg(F.count("*"), F.sum(mix)).first())

    current = materialise(edges.select("u", "v").where("u <> v").distinct())
    before = state(current)
    while before[0]:
        # a large star keeps or lowers the number of edges
        current = materialise(_small_star(_large_star(current, before[0]), before[0]))
        after = state(current)
        if after == before:
            break
        before = after
    roots = current.selectExpr("v AS node", "v AS component").distinct()
    return current.selectExpr("u AS node", "v AS component").unionAll(roots)
