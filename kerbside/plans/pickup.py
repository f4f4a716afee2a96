"""The two planning jobs: where stops go and who uses them, and which bus serves which."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.operators.centres import with_coverage
from kerbside.operators.density import SAME_PLACE, cluster_count, dbscan, k_distance_eps
from kerbside.operators.matching import match_buses
from kerbside.operators.nearest import nearest
from kerbside.operators.sampling import first_rows
from kerbside.session import materialise
from kerbside.sources.tables import Tables


def site_stops(clusters: DataFrame, road_points: DataFrame) -> DataFrame:
    """A stop per cluster, numbered like it, at the road point nearest to its centre."""
    found = nearest(clusters.select("cluster_id", "latitude", "longitude"), road_points, ["road_id", "order"])
    return found.select(
        F.col("cluster_id").alias("stop_id"), "road_id",
        F.col("right_latitude").alias("latitude"), F.col("right_longitude").alias("longitude"))


def stop_of_cluster(stops: DataFrame, clusters: DataFrame) -> DataFrame:
    """(stop_id, cluster_id): a stop has the number of its cluster."""
    return stops.join(clusters, stops["stop_id"] == clusters["cluster_id"]).select("stop_id", "cluster_id")


def plan_clusters(students: DataFrame, walk_max_distance: float = 1000, coverage_ratio: float = 0.9,
                  max_k: int | None = None, seed: int = 42) -> tuple[int, DataFrame, DataFrame]:
    """The first cluster count, from the density estimate up, that keeps enough students
    within walking distance: (k, students with cluster_id, clusters).

    Where so many students share positions that the estimated radius is zero, the positions
    shared are the clusters of the estimate.
    """
    first = cluster_count(dbscan(students, k_distance_eps(students, at_zero=SAME_PLACE))).first()[0]
    limit = students.count() if max_k is None else max_k
    return with_coverage(students, first, limit, walk_max_distance, coverage_ratio, seed)


def plan_pickup(students: DataFrame, road_points: DataFrame, *, student_count: int | None = None,
                walk_max_distance: float = 1000, coverage_ratio: float = 0.9,
                seed: int = 42) -> dict[str, DataFrame]:
    """student_clusters, bus_stops, cluster_bus_stop_map and assignments.

    Empty when there are no students. A student is assigned to the stop of the own
    cluster, whose number the stop shares.
    """
    rows = first_rows(students, student_count, "student_id").select("student_id", "latitude", "longitude")
    if rows.isEmpty():
        return {}
    rows = materialise(rows)
    _, labelled, clusters = plan_clusters(rows, walk_max_distance, coverage_ratio, seed=seed)
    stops = materialise(site_stops(clusters, road_points))
    pairs = stop_of_cluster(stops, clusters)
    return {
        "student_clusters": clusters,
        "bus_stops": stops,
        "cluster_bus_stop_map": pairs,
        "assignments": labelled.select("student_id", F.col("cluster_id").alias("stop_id")),
    }


def run_pickup(tables: Tables, show: bool = False, **parameters) -> None:
    """Plan stops from the tables and replace the four tables it results in."""
    planned = plan_pickup(tables.read("students"), tables.read("road_points"), **parameters)
    for name, df in planned.items():
        tables.overwrite(name, df)
    if show and planned:
        for name in ("bus_stops", "assignments"):
            tables.read(name).show()


def run_matching(tables: Tables, show: bool = False) -> DataFrame:
    """Match buses to stops and replace the table of bus assignments."""
    matched = match_buses(tables.read("bus_stops"), tables.read("buses"), tables.read("assignments"))
    tables.overwrite("bus_assignments", matched)
    result = tables.read("bus_assignments")
    if show:
        result.show()
    return result
