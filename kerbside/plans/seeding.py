"""Filling the tables: students, roads and buses from files, and moving students about."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions.scalars import bus_seats, person_name, through_float32
from kerbside.operators.ordering import zip_with_index
from kerbside.operators.sampling import draw_rows, first_rows, sample_rows
from kerbside.operators.updates import update_rows
from kerbside.sources import files
from kerbside.sources.tables import Tables

POINT_KEYS = ("osm_id", "longitude", "latitude")


def _stored(points: DataFrame) -> DataFrame:
    """Coordinates as the seeders store them, in single precision."""
    return points.withColumns({c: through_float32(F.col(c)) for c in ("longitude", "latitude")})


def seed_students(points: DataFrame, count: int, seed: int = 42) -> DataFrame:
    """The first ``count`` points as students with numbers from 1 and made-up names."""
    rows = first_rows(_stored(points), count, *POINT_KEYS).withColumnRenamed("name", "address")
    numbered = zip_with_index(rows, *POINT_KEYS, name="student_id")
    return numbered.select("student_id", "address", "longitude", "latitude",
                           person_name(F.col("student_id"), seed).alias("name"))


def seed_buses(points: DataFrame, count: int, seed: int = 42) -> DataFrame:
    """``count`` random points as buses with one of the usual seat counts."""
    keyed = _stored(points).withColumn("__place", F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit(""))
                                                            for c in POINT_KEYS]))
    rows = sample_rows(keyed, count, "__place", seed)
    numbered = zip_with_index(rows, "__place", name="bus_id")
    return numbered.select("bus_id", "latitude", "longitude",
                           bus_seats(F.col("bus_id"), seed).alias("capacity"))


def relocate_students(students: DataFrame, points: DataFrame, count: int | None = None,
                      seed: int = 42) -> DataFrame:
    """The first ``count`` students (None: all) moved to points drawn with replacement."""
    moved = first_rows(students.select("student_id"), count, "student_id")
    places = points.select(F.col("name").alias("address"), "longitude", "latitude")
    drawn = draw_rows(moved, "student_id", places, "longitude", "latitude", "address", seed=seed)
    return update_rows(students, drawn, "student_id")


def bootstrap(spark: SparkSession, tables: Tables, points_path: str, roads_path: str,
              student_count: int = 1000, bus_count: int = 300, seed: int = 42,
              roads_layout: str = "document") -> None:
    """Empty all tables and fill roads, road points, students and buses."""
    tables.create()
    features = files.with_road_ids(files.read_features(spark, roads_path, roads_layout))
    tables.append("roads", files.roads(features))
    tables.append("road_points", files.line_points(features))
    points = files.read_points(spark, points_path)
    tables.append("students", seed_students(points, student_count, seed))
    tables.append("buses", seed_buses(points, bus_count, seed))


def replace_students(spark: SparkSession, tables: Tables, path: str) -> int:
    """Replace all students by an uploaded list and return how many it had.

    A list that repeats a student_id is refused before anything is written.
    """
    students = files.read_students(spark, path)
    twice = students.groupBy("student_id").count().where("count > 1").first()
    if twice:
        raise ValueError(f"student_id {twice['student_id']} is listed {twice['count']} times")
    tables.overwrite("students", students)
    return tables.read("students").count()


def relocate(tables: Tables, points: DataFrame, count: int | None = None, seed: int = 42) -> DataFrame:
    """Relocate students in the table and return them ordered by id."""
    tables.overwrite("students", relocate_students(tables.read("students"), points, count, seed))
    return tables.read("students").select(
        "student_id", "name", "address", "latitude", "longitude").orderBy("student_id")
