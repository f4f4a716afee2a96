"""Readers for point lists, student lists and road maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions.scalars import road_name
from kerbside.operators.ordering import zip_with_index

POINT_COLUMNS = "osm_id string, osm_type string, geom_type string, name string, longitude string, latitude string"
STUDENT_COLUMNS = "student_id string, longitude string, latitude string, name string, address string"
_LINE = "array<array<double>>"
_FEATURE = ("type string, properties struct<osm_id: string, name: string>,"
            " geometry struct<type: string, coordinates: string>")


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """Points of interest from CSV with a header."""
    raw = spark.read.option("header", True).option("escape", '"').schema(POINT_COLUMNS).csv(path)
    return raw.withColumns({c: F.expr(f"try_cast({c} AS double)") for c in ("longitude", "latitude")})


def _required(name: str, kind: str) -> Column:
    value = F.expr(f"try_cast(trim({name}) AS {kind})")
    return F.when(value.isNotNull(), value).otherwise(
        F.raise_error(F.concat(F.lit(f"bad {name}: "), F.coalesce(F.col(name), F.lit("missing")))).cast(kind)
    ).alias(name)


def read_students(spark: SparkSession, path: str) -> DataFrame:
    """An uploaded student list (student_id, longitude, latitude, name, address).

    One bad row fails the whole read, so a replacement either happens entirely or not.
    """
    raw = (spark.read.option("header", True).option("enforceSchema", True).option("mode", "FAILFAST")
           .option("escape", '"').schema(STUDENT_COLUMNS).csv(path))
    return raw.select(
        _required("student_id", "bigint"), F.coalesce("address", F.lit("")).alias("address"),
        _required("longitude", "double"), _required("latitude", "double"),
        F.coalesce("name", F.lit("")).alias("name"))


def read_features(spark: SparkSession, path: str, layout: str = "document") -> DataFrame:
    """Features of a GeoJSON file: position, osm_id, name, kind, coordinates (JSON text).

    ``document`` parses each file as one JSON value, so one file is one task. ``lines``
    expects a feature per line, with or without the surrounding collection, and lets a
    large file be split over many tasks. ``collection`` splits one collection, however it is
    broken into lines, at the type of its features, which has to be their first member and no
    other text of the file.
    """
    if layout == "document":
        whole = spark.read.option("multiLine", True).schema(f"features array<struct<{_FEATURE}>>").json(path)
        features = whole.select(F.col("_metadata.file_path").alias("file"), F.posexplode("features").alias("position", "f"))
        features = features.withColumn("position", F.col("position").cast("long"))
    elif layout == "lines":
        text = spark.read.text(path).select(
            F.regexp_replace(F.trim(F.col("value")), "^\\x1e|,$", "").alias("value"),
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"))
        parsed = text.where(F.col("value").rlike('^\\{.*"Feature"')).select(
            F.from_json("value", f"struct<{_FEATURE}>").alias("f"), "file", "block", "line")
        features = parsed.where("f.type = 'Feature'")
    elif layout == "collection":
        text = spark.read.option("lineSep", '"Feature"').text(path).select(
            F.trim(F.regexp_replace("value", "^\\s+", "")).alias("value"), F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
        # what precedes the first feature begins with a brace; what follows a feature is not read
        rest = text.where(F.substring("value", 1, 1).isin(",", "}"))
        parsed = rest.select(F.from_json(F.concat(F.lit('{"type": "Feature"'), "value"), f"struct<{_FEATURE}>").alias("f"),
                             "file", "block", "line")
        misplaced = F.col("f.properties").isNull() & F.col("f.geometry").isNull()
        features = parsed.withColumn("f", F.when(misplaced, F.raise_error(F.lit(
            "a feature that does not begin with its type"))).otherwise(F.col("f")))
    else:
        raise ValueError(f"unknown layout {layout!r}")
    keep = ["file", "position"] if layout == "document" else ["file", "block", "line"]
    return features.select(*keep, F.col("f.properties.osm_id").alias("osm_id"),
                           F.col("f.properties.name").alias("name"),
                           F.col("f.geometry.type").alias("kind"),
                           F.col("f.geometry.coordinates").alias("coordinates"))


def with_road_ids(features: DataFrame) -> DataFrame:
    """Roads are known by osm_id, or by their position over all files where there are no such ids.

    An id that is no number fails the read; a road without one, among roads that have, has none.
    """
    if not features.where(F.col("osm_id").isNotNull()).isEmpty():
        number = F.expr("try_cast(osm_id AS bigint)")
        bad = F.raise_error(F.concat(F.lit("bad osm_id: "), F.col("osm_id"))).cast("long")
        return features.withColumn("road_id", F.when(F.col("osm_id").isNull() | number.isNotNull(), number).otherwise(bad))
    if "position" in features.columns:
        return zip_with_index(features, "file", "position", name="road_id", start=0)
    return zip_with_index(features, "file", "block", "line", name="road_id", start=0)


def roads(features: DataFrame) -> DataFrame:
    return features.select("road_id", road_name(F.col("name")).alias("name"))


def line_points(features: DataFrame) -> DataFrame:
    """Vertices of lines, numbered from 0 through all parts; other shapes give none."""
    line = F.when(F.col("kind") == "LineString", F.from_json("coordinates", _LINE)).when(
        F.col("kind") == "MultiLineString", F.flatten(F.from_json("coordinates", f"array<{_LINE}>")))
    points = features.select("road_id", F.posexplode(line).alias("order", "xy"))
    return points.select("road_id", F.col("xy")[0].alias("longitude"), F.col("xy")[1].alias("latitude"), "order")
