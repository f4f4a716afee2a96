"""The fixed table schemas, ids as 64-bit integers throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType,
)


def _schema(*fields: tuple) -> StructType:
    return StructType([StructField(name, kind, nullable) for name, kind, nullable in fields])


_ID, _NUM, _TEXT = LongType(), DoubleType(), StringType()

TABLES: dict[str, StructType] = {
    "students": _schema(("student_id", _ID, True), ("address", _TEXT, True),
                        ("longitude", _NUM, True), ("latitude", _NUM, True),
                        ("name", _TEXT, True)),
    "roads": _schema(("road_id", _ID, True), ("name", _TEXT, True)),
    "road_points": _schema(("road_id", _ID, True), ("longitude", _NUM, True),
                           ("latitude", _NUM, True), ("order", IntegerType(), True)),
    "student_clusters": _schema(("cluster_id", _ID, True), ("latitude", _NUM, True),
                                ("longitude", _NUM, True)),
    "bus_stops": _schema(("stop_id", _ID, True), ("road_id", _ID, True),
                         ("latitude", _NUM, True), ("longitude", _NUM, True)),
    "cluster_bus_stop_map": _schema(("stop_id", _ID, True), ("cluster_id", _ID, True)),
    "assignments": _schema(("student_id", _ID, True), ("stop_id", _ID, True)),
    "buses": _schema(("bus_id", _ID, True), ("latitude", _NUM, True),
                     ("longitude", _NUM, True), ("capacity", IntegerType(), True)),
    "bus_assignments": _schema(("bus_id", _ID, True), ("stop_id", _ID, True),
                               ("distance", _NUM, True), ("num_students", _ID, True)),
    "student_locations": _schema(("student_id", _ID, True), ("latitude", _NUM, True),
                                 ("longitude", _NUM, True), ("timestamp", TimestampType(), True)),
}

# The column that identifies a row; tables without one are logs or link tables. Writing a
# version that repeats a key is refused.
KEYS = {
    "students": "student_id", "roads": "road_id", "student_clusters": "cluster_id",
    "bus_stops": "stop_id", "assignments": "student_id", "buses": "bus_id",
    "bus_assignments": "bus_id",
}

# Tables that streams commit changes to, with the key that a change replaces; changes without
# a key are rows that are added.
LOGGED = {"assignments": "student_id", "student_locations": None}

# What orders the changes of a key: event time, then the offset of the message.
CHANGE_ORDER = _schema(("changed_at", TimestampType(), True), ("changed_offset", _ID, True))


def conform(name: str, df: DataFrame) -> DataFrame:
    """Project and cast a DataFrame to the schema of table ``name``."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in TABLES[name].fields])


def create_tables(spark: SparkSession, database: str = "default") -> None:
    """Drop and create every table, empty, as parquet tables of a catalogue database."""
    for name, schema in TABLES.items():
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE {database}.{name} ({columns}) USING parquet")
