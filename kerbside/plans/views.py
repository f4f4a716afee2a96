"""What the map and its search read: joins and projections over the planning tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions.scalars import same_id
from kerbside.operators.ordering import page, page_count

PIECE_POINTS = 1000   # points per stored piece of a road line


def assignment_view(students: DataFrame, assignments: DataFrame) -> DataFrame:
    """All students with their stop, if they have one."""
    return students.join(assignments, "student_id", "left").select(
        "student_id", "stop_id", "name", "latitude", "longitude")


def bus_view(buses: DataFrame, bus_assignments: DataFrame) -> DataFrame:
    """All buses with the stop they serve, if any."""
    return buses.join(bus_assignments, "bus_id", "left").select(
        "bus_id", "stop_id", "capacity", "latitude", "longitude", "distance", "num_students")


def assigned_positions(assignments: DataFrame, stops: DataFrame) -> DataFrame:
    """Assigned students at the position of their stop."""
    return assignments.join(stops, "stop_id").select("student_id", "latitude", "longitude")


def students_view(students: DataFrame) -> DataFrame:
    return students.select("student_id", "address", "longitude", "latitude", "name")


def stops_view(stops: DataFrame) -> DataFrame:
    return stops.select("stop_id", "road_id", "latitude", "longitude")


def clusters_view(clusters: DataFrame) -> DataFrame:
    return clusters.select("cluster_id", "latitude", "longitude")


def entities(assignment_rows: DataFrame, stops: DataFrame, bus_rows: DataFrame) -> DataFrame:
    """Students, stops and buses as one list with the id each kind is known by."""
    kinds = [("student", "student_id", assignment_rows), ("bus stop", "stop_id", stops),
             ("bus", "bus_id", bus_rows)]
    merged = None
    for kind, key, rows in kinds:
        tagged = rows.select(F.lit(kind).alias("entity_type"), F.col(key).alias("id"), "*")
        merged = tagged if merged is None else merged.unionByName(tagged, allowMissingColumns=True)
    return merged


def lookup(entity_rows: DataFrame, kind: str, text: str) -> DataFrame:
    """The entity of a kind with the id typed in; no row when there is none."""
    return entity_rows.where((F.col("entity_type") == kind) & same_id(F.col("id"), text)).limit(1)


def entity_page(entity_rows: DataFrame, kind: str, number: int, size: int = 10) -> DataFrame:
    return page(entity_rows.where(F.col("entity_type") == kind), "id", number, size)


def entity_page_count(entity_rows: DataFrame, kind: str, size: int = 10) -> DataFrame:
    return page_count(entity_rows.where(F.col("entity_type") == kind), size)


def table_counts(**tables: DataFrame) -> DataFrame:
    counts = None
    for name, df in tables.items():
        row = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        counts = row if counts is None else counts.unionAll(row)
    return counts


def road_lines(road_points: DataFrame, roads: DataFrame | None = None,
               piece_points: int = PIECE_POINTS) -> DataFrame:
    """Roads as lines again, in pieces that together draw the whole road.

    A piece starts at the point the one before ends with, so a road of any length is
    spread over as many rows, and groups, as it needs.
    """
    own = F.expr(f"`order` div {piece_points}").cast("int")
    starts_piece = (F.col("order") > 0) & (F.col("order") % piece_points == 0)
    pieces = F.when(starts_piece, F.array(own - 1, own)).otherwise(F.array(own))
    points = road_points.select("road_id", F.explode(pieces).alias("piece"), "order", "longitude", "latitude")
    lines = points.groupBy("road_id", "piece").agg(
        F.array_sort(F.collect_list(F.struct("order", "longitude", "latitude"))).alias("points"))
    lines = lines.where((F.col("piece") == 0) | (F.size("points") > 1)).select(
        "road_id", "piece", F.size("points").alias("n_points"),
        F.transform("points", lambda p: F.array(p["longitude"], p["latitude"])).alias("coordinates"))
    return lines if roads is None else lines.join(roads, "road_id", "left")


def line_features(lines: DataFrame) -> DataFrame:
    """Road lines (with names) as GeoJSON features, one text value per row."""
    return lines.select(F.to_json(F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.col("road_id").alias("osm_id"), "name").alias("properties"),
        F.struct(F.lit("LineString").alias("type"), "coordinates").alias("geometry"),
    )).alias("value"))
