"""Planning tables derived from the generic test tables (see FIXTURES.md).

Coordinates are whole micro-degrees in integer arithmetic, divided once, so that every
engine computes the same doubles. Each table is one select over one or two inputs; the
text is shared with the SQL oracle, which spells integer division differently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ZONE_LAT = "21000000 + ({zone} DIV 5) * 20000"
_ZONE_LNG = "105790000 + ({zone} % 5) * 20000"


def _student_lat(zone: str, key: str) -> str:
    return (f"cast({_ZONE_LAT.format(zone=zone)} + (({key} * 7919) % 1009 - 504) * 10"
            " as double) / cast(1000000 as double)")


def _student_lng(zone: str, key: str) -> str:
    return (f"cast({_ZONE_LNG.format(zone=zone)} + (({key} * 104729) % 1013 - 506) * 10"
            " as double) / cast(1000000 as double)")


STUDENTS = {
    "student_id": "cast(c_custkey as bigint)",
    "zone": "cast(c_nationkey as bigint)",
    "latitude": _student_lat("c_nationkey", "c_custkey"),
    "longitude": _student_lng("c_nationkey", "c_custkey"),
    "name": "c_name",
    "address": "c_mktsegment",
}
BUSES = {
    "bus_id": "cast(s_suppkey as bigint)",
    "latitude": f"cast({_ZONE_LAT.format(zone='s_nationkey')} + ((s_suppkey * 6007) % 1019 - 509) * 10"
                " as double) / cast(1000000 as double)",
    "longitude": f"cast({_ZONE_LNG.format(zone='s_nationkey')} + ((s_suppkey * 5003) % 1021 - 510) * 10"
                 " as double) / cast(1000000 as double)",
    "capacity": "cast(case s_suppkey % 4 when 0 then 16 when 1 then 29 when 2 then 35 else 45 end as int)",
}
_ROAD = "(o_orderkey DIV 20)"
ROAD_POINTS = {
    "road_id": f"cast({_ROAD} as bigint)",
    "order": "cast(o_orderkey % 20 as int)",
    "latitude": f"cast(20990000 + ({_ROAD} * 7919) % 100003 + (o_orderkey % 20) * 150"
                " as double) / cast(1000000 as double)",
    "longitude": f"cast(105780000 + ({_ROAD} * 104729) % 100019"
                 f" + (o_orderkey % 20) * (({_ROAD} % 7 - 3) * 50)"
                 " as double) / cast(1000000 as double)",
}
PART_STOPS = {
    "stop_id": "cast(p_partkey as bigint)",
    "latitude": "cast(20990000 + (p_partkey * 7919) % 100003 as double) / cast(1000000 as double)",
    "longitude": "cast(105780000 + (p_partkey * 104729) % 100019 as double) / cast(1000000 as double)",
}
CHANGES = {
    "event_id": "cast(event_id as bigint)",
    "student_id": "cast(user_id as bigint)",
    "op": "case event_type when 'error' then 'd' when 'signup' then 'c' when 'view' then 'r' else 'u' end",
    "latitude": _student_lat("(user_id % 25)", "event_id"),
    "longitude": _student_lng("(user_id % 25)", "event_id"),
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(text).alias(name) for name, text in columns.items()])


def students(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(_read(spark, sf_dir, "customer"), STUDENTS)


def buses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(_read(spark, sf_dir, "supplier"), BUSES)


def road_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(_read(spark, sf_dir, "orders"), ROAD_POINTS)


def roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    road_id = F.col("road_id")
    return (
        road_points(spark, sf_dir).select("road_id").distinct()
        .withColumn("name", F.when(road_id % 11 != 0, F.concat(F.lit("Road "), road_id)))
    )


def student_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One centre per zone, the mean of its students."""
    return (
        students(spark, sf_dir)
        .groupBy((F.col("zone") + 1).alias("cluster_id"))
        .agg(F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude"))
    )


def assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return students(spark, sf_dir).select("student_id", (F.col("zone") + 1).alias("stop_id"))


def zone_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stops at the zone centres themselves, for queries that need stops but no roads."""
    return student_clusters(spark, sf_dir).withColumnRenamed("cluster_id", "stop_id")


def part_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stops whose number grows with the tables."""
    return _select(_read(spark, sf_dir, "part"), PART_STOPS)


def student_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change events with their parts as columns; deletes carry no coordinates."""
    micros = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00',"
                    " cast(ts as timestamp_ntz))")
    events = _read(spark, sf_dir, "events")
    parts = [F.expr(text).alias(name) for name, text in CHANGES.items()]
    rows = events.select(*parts, F.expr("ts")).withColumn("micros", micros)
    return rows.withColumn("ts_ms", F.expr("micros div 1000")).drop("micros", "ts")


def change_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as JSON envelopes, the way a change topic carries them."""
    after = F.when(
        F.col("op") != "d",
        F.struct("student_id", "latitude", "longitude",
                 F.concat(F.lit("Student "), F.col("student_id")).alias("name"),
                 F.concat(F.lit("Zone "), F.col("student_id") % 25).alias("address")),
    )
    payload = F.struct("op", F.struct("ts_ms").alias("source"), after.alias("after"))
    return student_changes(spark, sf_dir).select(
        F.to_json(F.struct(payload.alias("payload"))).alias("value"),
        F.col("event_id").alias("offset"),
    )


# --- the same tables for the SQL oracle ------------------------------------------------

def _sql(columns: dict[str, str], table: str) -> str:
    items = ", ".join(f'{text.replace(" DIV ", " // ")} AS "{name}"' for name, text in columns.items())
    return f"SELECT {items} FROM {table}"


_SQL = {
    "students": _sql(STUDENTS, "customer"),
    "buses": _sql(BUSES, "supplier"),
    "road_points": _sql(ROAD_POINTS, "orders"),
    "roads": "SELECT DISTINCT road_id, CASE WHEN road_id % 11 <> 0 THEN 'Road ' || road_id END AS name"
             " FROM road_points",
    "student_clusters": "SELECT zone + 1 AS cluster_id, avg(latitude) AS latitude,"
                        " avg(longitude) AS longitude FROM students GROUP BY zone",
    "assignments": "SELECT student_id, zone + 1 AS stop_id FROM students",
    "part_stops": _sql(PART_STOPS, "part"),
    "zone_stops": "SELECT cluster_id AS stop_id, latitude, longitude FROM student_clusters",
    "student_changes": _sql({**CHANGES, "ts_ms": "epoch_us(ts) DIV 1000"}, "events"),
}
_NEEDS = {"roads": ["road_points"], "student_clusters": ["students"], "assignments": ["students"],
          "zone_stops": ["students", "student_clusters"]}


def with_sql(*tables: str, recursive: bool = False) -> str:
    """``WITH`` clause text that defines the named tables and what they build on."""
    order: list[str] = []
    for table in tables:
        for name in [*_NEEDS.get(table, []), table]:
            if name not in order:
                order.append(name)
    head = "WITH RECURSIVE " if recursive else "WITH "
    return head + ", ".join(f"{name} AS ({_SQL[name]})" for name in order)
