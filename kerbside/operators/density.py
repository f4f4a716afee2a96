"""Density clustering that estimates where the search for a cluster count starts."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions import geo
from kerbside.operators.components import connected_components
from kerbside.operators.nearest import nearest_other
from kerbside.operators.ordering import next_values
from kerbside.operators.skew import join_unique
from kerbside.session import materialise, store

NOISE = -1
SAME_PLACE = 2.0 ** -40   # degrees, about a tenth of a micrometre: as fine as positions are told apart
_TRIED_PAIRS = 256   # point pairs of two cells that are compared outright
_SPLIT = 2           # levels a fuller pair of cells is split by: 4 per axis
_DEEPEST = 24


def distance_steps(points: DataFrame) -> DataFrame:
    """The sorted nearest-other distances, equal ones merged: value, rows, next, gap."""
    distances = materialise(
        nearest_other(points).groupBy("distance").agg(F.count("*").alias("rows")))
    return next_values(distances, "distance").join(distances, "distance").select(
        "distance", "rows", "next", (F.col("next") - F.col("distance")).alias("gap"))


def k_distance_eps(points: DataFrame, at_zero: float | None = None) -> float:
    """The distance below the first gap that exceeds mean + standard deviation of gaps.

    Equal distances contribute gaps of zero, which are counted and not listed. So many points
    may share positions that this distance is zero: ``at_zero`` is returned then, and without
    it that is an error.
    """
    steps = materialise(distance_steps(points))
    total, gaps, listed = steps.agg(F.sum("rows"), F.sum("gap"), F.count("gap")).first()
    if not total or total < 3:
        raise ValueError("at least three points are needed to estimate a radius")
    mean = (gaps or 0.0) / (total - 1)
    squares = steps.agg(F.sum((F.col("gap") - mean) * (F.col("gap") - mean))).first()[0] or 0.0
    spread = math.sqrt((squares + (total - 1 - listed) * mean * mean) / (total - 1))
    eps = steps.where(F.col("gap") > mean + spread).agg(F.min("distance")).first()[0]
    if eps is None:
        raise ValueError("the sorted distances have no step to read a radius from")
    if eps <= 0 and at_zero is None:
        raise ValueError("the estimated radius is zero: too many points share a position")
    return eps if eps > 0 else at_zero


def _sub_cells(places: DataFrame, side: float, depth: int, tag: str) -> DataFrame:
    """Occupied cells at a depth below the base grid, with their base cell's node."""
    scale = 2.0 ** depth / side
    return places.groupBy(
        F.col("node").alias(f"{tag}_node"),
        F.floor(F.col("latitude") * scale).alias(f"{tag}y"),
        F.floor(F.col("longitude") * scale).alias(f"{tag}x"),
    ).agg(F.count("*").alias(f"{tag}_points"))


def _linked_cells(places: DataFrame, pairs: DataFrame, side: float, eps: float) -> DataFrame:
    """Those pairs (a_node, b_node) of cells that have two points within ``eps``.

    Two full cells are never compared point by point: both are split, a pair of parts
    that is surely close settles the whole pair, a pair surely apart is dropped, and only
    the rest is split again.
    """
    places = places.select("node", "latitude", "longitude")
    found, depth = [], 0
    open_pairs = pairs
    while True:
        scale = 2.0 ** depth / side
        small = F.col("a_points") * F.col("b_points") <= _TRIED_PAIRS
        if depth >= _DEEPEST:
            small = F.lit(True)

        def side_of(tag: str) -> DataFrame:
            return places.select(
                F.col("node").alias(f"{tag}_node"),
                F.floor(F.col("latitude") * scale).alias(f"{tag}y"),
                F.floor(F.col("longitude") * scale).alias(f"{tag}x"),
                F.col("latitude").alias(f"{tag}_lat"), F.col("longitude").alias(f"{tag}_lng"))

        tried = (
            open_pairs.where(small)
            .join(side_of("a"), ["a_node", "ay", "ax"]).join(side_of("b"), ["b_node", "by", "bx"])
            .where(geo.planar(F.col("a_lat"), F.col("a_lng"), F.col("b_lat"), F.col("b_lng")) <= eps)
            .select("a_node", "b_node").distinct()
        )
        found.append(materialise(tried))
        fuller = open_pairs.where(~small)
        if depth >= _DEEPEST or fuller.isEmpty():
            break
        fuller = fuller.join(found[-1], ["a_node", "b_node"], "left_anti")
        depth += _SPLIT
        nodes = fuller.select(F.explode(F.array("a_node", "b_node")).alias("node")).distinct()
        places = materialise(places.join(nodes, "node", "left_semi"))
        for tag in ("a", "b"):
            parts = _sub_cells(places, side, depth, tag)
            up = [F.expr(f"shiftright({tag}{axis}, {_SPLIT})").alias(f"up{axis}") for axis in "yx"]
            parts = parts.select("*", *up)
            fuller = fuller.drop(f"{tag}_points").withColumnsRenamed({f"{tag}y": "upy", f"{tag}x": "upx"})
            fuller = fuller.join(parts, [f"{tag}_node", "upy", "upx"]).drop("upy", "upx")
        unit = side / 2.0 ** depth
        dy, dx = F.abs(F.col("ay") - F.col("by")), F.abs(F.col("ax") - F.col("bx"))
        gap_y, gap_x = F.greatest(F.lit(0), dy - 1), F.greatest(F.lit(0), dx - 1)
        fuller = fuller.withColumn("near2", (gap_y * gap_y + gap_x * gap_x) * (unit * unit))
        fuller = fuller.withColumn("far2", ((dy + 1) * (dy + 1) + (dx + 1) * (dx + 1)) * (unit * unit))
        fuller = materialise(fuller.where(F.col("near2") <= eps * eps * (1 + 1e-9)))
        close = materialise(
            fuller.where(F.col("far2") <= eps * eps * (1 - 1e-9)).select("a_node", "b_node").distinct())
        found.append(close)
        open_pairs = materialise(
            fuller.drop("near2", "far2").join(close, ["a_node", "b_node"], "left_anti"))
    linked = found[0]
    for part in found[1:]:
        linked = linked.unionAll(part)
    return linked.distinct()


def _offsets(half: bool) -> list[tuple[int, int]]:
    """Cells that may hold neighbours of a cell's points: all, or half of them without the cell."""
    around = [(y, x) for y in range(-2, 3) for x in range(-2, 3)]
    return [(y, x) for y, x in around if y > 0 or (y == 0 and x > 0)] if half else around


def _near_cells(half: bool) -> Column:
    return F.explode(F.array(*[F.struct(F.lit(y).alias("y"), F.lit(x).alias("x")) for y, x in _offsets(half)]))


def _cell_components(points: DataFrame, eps: float, side: float, id_column: str) -> DataFrame:
    """(cy, cx, node, points, component): occupied cells, their lowest id and point count, and the
    lowest node that linked cells lead to (null for a cell without links)."""
    cy, cx = F.floor(F.col("latitude") / side), F.floor(F.col("longitude") / side)
    cells = materialise(
        points.groupBy(cy.alias("cy"), cx.alias("cx"))
        .agg(F.min(id_column).alias("node"), F.count("*").alias("points")))
    # half of the surrounding cells, as the relation is symmetric
    reached = cells.select(F.col("node").alias("a_node"), F.col("cy").alias("ay"), F.col("cx").alias("ax"),
                           F.col("points").alias("a_points"), _near_cells(half=True).alias("o"))
    reached = reached.withColumn("by", F.expr("ay + o.y")).withColumn("bx", F.expr("ax + o.x")).drop("o")
    others = cells.select(F.col("node").alias("b_node"), F.col("cy").alias("by"), F.col("cx").alias("bx"),
                          F.col("points").alias("b_points"))
    pairs = materialise(reached.join(others, ["by", "bx"]))
    places = points.select("latitude", "longitude").distinct().select("*", cy.alias("cy"), cx.alias("cx"))
    sizes = cells.select("cy", "cx", F.col("points").alias("rows"))
    total = cells.agg(F.coalesce(F.sum("points"), F.lit(0))).first()[0]
    places = materialise(join_unique(places, cells.select("cy", "cx", "node"), ["cy", "cx"], sizes, total))
    links = _linked_cells(places, pairs, side, eps)
    groups = connected_components(links.selectExpr("a_node AS u", "b_node AS v"))
    return cells.join(groups, cells["node"] == groups["node"], "left").select(
        "cy", "cx", cells["node"], "points", "component")


def dbscan(points: DataFrame, eps: float, id_column: str = "student_id", min_samples: int = 2) -> DataFrame:
    """Points with ``label``: density clusters of radius ``eps``, named by their lowest core id.

    A core point has ``min_samples`` points within the radius, itself included. Clusters are the
    core points linked by steps of at most ``eps``; another point within reach of core points
    gets the lowest label among them, any other -1. With two samples every point with a
    neighbour is a core point. Cells are so small that all points of one are neighbours, so
    cells and not points are linked. Ids are unique; points without coordinates get -1.
    """
    if not eps > 0:
        raise ValueError("the radius must be positive")
    side = eps / math.sqrt(2) * (1 - 1e-9)
    cy, cx = F.floor(F.col("latitude") / side), F.floor(F.col("longitude") / side)
    if min_samples != 2:
        return _general(points, eps, side, id_column, min_samples)
    cells = materialise(_cell_components(points, eps, side, id_column))
    labels = cells.select("cy", "cx", F.coalesce(
        "component", F.when(F.col("points") > 1, F.col("node")), F.lit(NOISE)).alias("label"))
    sizes = cells.select("cy", "cx", F.col("points").alias("rows"))
    total = cells.agg(F.coalesce(F.sum("points"), F.lit(0))).first()[0]
    keyed = points.withColumn("cy", cy).withColumn("cx", cx)
    return join_unique(keyed, labels, ["cy", "cx"], sizes, total).drop("cy", "cx")


def _within(few: DataFrame, others: DataFrame, eps: float, values: list[str]) -> DataFrame:
    """Pairs of ``few`` and ``others`` (both with cells) within the radius: id and the values.

    A cell has fewer than ``min_samples`` of the few, so a point of the others meets no more than
    that many from each cell around it.
    """
    asked = few.select("id", F.col("latitude").alias("lat"), F.col("longitude").alias("lng"), "cy", "cx",
                       _near_cells(half=False).alias("o"))
    asked = asked.select("id", "lat", "lng", F.expr("cy + o.y AS cy"), F.expr("cx + o.x AS cx"))
    # asked is 25 times the few rows, by whose size it would be broadcast
    met = asked.join(others.hint("merge"), ["cy", "cx"])
    return met.where(geo.planar(F.col("lat"), F.col("lng"), F.col("latitude"), F.col("longitude")) <= eps).select(
        asked["id"], *values)


def _general(points: DataFrame, eps: float, side: float, id_column: str, min_samples: int) -> DataFrame:
    cell = ["cy", "cx"]
    placed = store(points.where("latitude IS NOT NULL AND longitude IS NOT NULL").select(
        F.col(id_column).alias("id"), "latitude", "longitude",
        F.floor(F.col("latitude") / side).alias("cy"), F.floor(F.col("longitude") / side).alias("cx")))
    # all points of a cell with enough of them are core points; only others are counted
    sizes = store(placed.groupBy(*cell).agg(F.count("*").alias("rows")))
    light = sizes.where(F.col("rows") < min_samples).select(*cell)
    few = store(placed.join(light, cell, "left_semi"))
    counted = _within(few, placed.drop("id"), eps, []).groupBy("id").agg(F.count("*").alias("n"))
    dense = counted.where(F.col("n") >= min_samples).select("id")
    core = store(placed.join(light, cell, "left_anti").unionByName(few.join(dense, "id", "left_semi").select(*placed.columns)))
    parts = _cell_components(core, eps, side, "id").select(*cell, F.coalesce("component", "node").alias("label"))
    total = placed.count()
    labelled = store(join_unique(core, parts, cell, sizes, total))
    border = few.join(core.select("id"), "id", "left_anti")
    reached = _within(border, labelled.drop("id"), eps, ["label"]).groupBy("id").agg(F.min("label").alias("label"))
    labels = labelled.select("id", "label").unionByName(reached).withColumnRenamed("id", id_column)
    return points.join(labels, id_column, "left").select(*points.columns, F.coalesce("label", F.lit(NOISE)).alias("label"))


def cluster_count(labelled: DataFrame) -> DataFrame:
    return labelled.where(F.col("label") != NOISE).agg(F.count_distinct("label").alias("n_clusters"))
