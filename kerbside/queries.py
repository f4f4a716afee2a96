"""The catalogue of named queries over the derived planning tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside import fixtures as fx
from kerbside.functions import geo
from kerbside.functions.scalars import bus_seats, person_name, road_name, through_float32, whole_metres
from kerbside.operators import boundary, centres, density, matching, ordering, sampling, updates
from kerbside.operators.nearest import nearest, nearest_other
from kerbside.plans import pickup, seeding, views
from kerbside.session import ensure_checkpoint_dir, materialise
from kerbside.sources import files
from kerbside.sources.tables import Tables
from kerbside.streaming import changes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

WALK_M = 600.0        # walking distance of the coverage queries
COVERAGE = 0.9
RADIUS = 0.002        # degrees, radius of the density queries
SAMPLED_RADIUS = 0.0004
SEED = 42


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def metres(c: Column | str) -> Column:
    return F.round(c, 3)


# --- stops and distances ---------------------------------------------------------------

@query
def nearest_road_point(spark, d):
    """Where each cluster's stop goes: the road point nearest to its centre."""
    found = nearest(fx.student_clusters(spark, d), fx.road_points(spark, d), ["road_id", "order"])
    return found.select(F.col("cluster_id").alias("stop_id"), "road_id", "order",
                        F.col("right_latitude").alias("latitude"), F.col("right_longitude").alias("longitude"),
                        metres("distance").alias("distance"))


@query
def nearest_stop_per_student(spark, d):
    found = nearest(fx.students(spark, d), fx.zone_stops(spark, d), ["stop_id"])
    return found.select("student_id", "stop_id", metres("distance").alias("distance"))


@query
def nearest_road_point_per_student(spark, d):
    """Both sides large: every student's nearest road point."""
    found = nearest(fx.students(spark, d), fx.road_points(spark, d), ["road_id", "order"])
    return found.select("student_id", "road_id", "order", metres("distance").alias("distance"))


@query
def walk_distance(spark, d):
    """Every student's distance to the centre of the own cluster."""
    own = fx.student_clusters(spark, d).withColumnsRenamed({"latitude": "lat", "longitude": "lng"})
    rows = fx.students(spark, d).join(own, F.col("zone") + 1 == F.col("cluster_id"))
    return rows.select("student_id", "cluster_id", metres(geo.haversine(
        F.col("latitude"), F.col("longitude"), F.col("lat"), F.col("lng"))).alias("distance"))


@query
def stop_demand(spark, d):
    return matching.stop_demand(fx.assignments(spark, d))


@query
def bus_matching(spark, d):
    matched = matching.match_buses(fx.zone_stops(spark, d), fx.buses(spark, d), fx.assignments(spark, d))
    return matched.select("bus_id", "stop_id", metres("distance").alias("distance"), "num_students")


@query
def depot_matching(spark, d):
    """All buses at one position: one list of stops for all of them."""
    depot = fx.buses(spark, d).withColumns({"latitude": F.lit(21.02), "longitude": F.lit(105.83)})
    matched = matching.match_buses(fx.zone_stops(spark, d), depot, fx.assignments(spark, d))
    return matched.select("bus_id", "stop_id", metres("distance").alias("distance"), "num_students")


@query
def many_stops_matching(spark, d):
    """Students at the nearest of a growing number of stops, and buses matched to these."""
    stops = materialise(fx.part_stops(spark, d))
    assigned = materialise(nearest(fx.students(spark, d), stops, ["stop_id"]).select("student_id", "stop_id"))
    matched = matching.match_buses(stops, fx.buses(spark, d), assigned)
    return matched.select("bus_id", "stop_id", metres("distance").alias("distance"), "num_students")


# --- clustering ------------------------------------------------------------------------

def _zones(spark, d) -> tuple[DataFrame, DataFrame]:
    labelled = fx.students(spark, d).withColumn("cluster_id", F.col("zone") + 1)
    return labelled, fx.student_clusters(spark, d)


@query
def cluster_coverage(spark, d):
    return centres.coverage(*_zones(spark, d), WALK_M).select(
        "cluster_id", "points", F.round("share", 9).alias("share"))


@query
def coverage_valid(spark, d):
    shares = centres.coverage(*_zones(spark, d), WALK_M)
    valid = [centres.coverage_valid(shares, ratio).select(F.lit(ratio).alias("coverage_ratio"), "valid")
             for ratio in (0.5, COVERAGE)]
    return valid[0].unionAll(valid[1])


@query
def nearest_other_student(spark, d):
    return nearest_other(fx.students(spark, d)).select("student_id", F.round("distance", 9).alias("distance"))


@query
def sorted_gaps(spark, d):
    """Differences between neighbours in the sorted latitudes of road points."""
    steps = ordering.next_values(fx.road_points(spark, d), "latitude")
    return steps.select("latitude", F.round(F.col("next") - F.col("latitude"), 9).alias("gap"))


@query
def k_distance_eps(spark, d):
    eps = density.k_distance_eps(fx.students(spark, d))
    return spark.range(1).select(F.round(F.lit(eps), 12).alias("eps"))


@query
def dbscan_labels(spark, d):
    return density.dbscan(fx.students(spark, d), RADIUS).select("student_id", "label")


@query
def dbscan_min_samples(spark, d):
    """Four samples a neighbourhood: core, border and noise points."""
    return density.dbscan(fx.students(spark, d), SAMPLED_RADIUS, min_samples=4).select("student_id", "label")


@query
def dbscan_count(spark, d):
    """Cluster count at the radius the k-distance curve suggests: where the search starts."""
    points = fx.students(spark, d)
    return density.cluster_count(density.dbscan(points, density.k_distance_eps(points)))


@query
def kmeans_lloyd(spark, d):
    """Three rounds of k-means from the first student of every zone; new centres and their points."""
    start = fx.students(spark, d).groupBy((F.col("zone") + 1).alias("cluster_id")).agg(
        F.min_by("latitude", "student_id").alias("latitude"), F.min_by("longitude", "student_id").alias("longitude"))
    labelled, moved = centres.lloyd(fx.students(spark, d), materialise(start), iterations=3)
    sizes = labelled.groupBy("cluster_id").agg(F.count("*").alias("points"))
    return moved.join(sizes, "cluster_id", "left").select(
        "cluster_id", F.round("latitude", 6).alias("latitude"), F.round("longitude", 6).alias("longitude"),
        F.coalesce("points", F.lit(0)).alias("points"))


@query
def plan_clusters_summary(spark, d):
    """The constrained clustering itself: the students it holds, whether every cluster keeps enough of
    its students within reach, and whether clusters are numbered from 1."""
    _, labelled, clusters = pickup.plan_clusters(fx.students(spark, d), 1000, COVERAGE)
    return centres.coverage(labelled, clusters, 1000).agg(
        F.sum("points").alias("students"), (F.min(F.coalesce("share", F.lit(0.0))) >= COVERAGE).alias("covered"),
        ((F.min("cluster_id") == 1) & (F.max("cluster_id") == F.count("*"))).alias("numbered"))


@query
def pickup_plan(spark, d):
    """The whole planning job: students that have a stop, and those whose stop is a road point to which
    none is nearer from the centre of their cluster."""
    roads = fx.road_points(spark, d)
    planned = pickup.plan_pickup(fx.students(spark, d), roads)
    stops = planned["bus_stops"].join(planned["cluster_bus_stop_map"], "stop_id").join(
        planned["student_clusters"].select("cluster_id", F.col("latitude").alias("lat"), F.col("longitude").alias("lng")), "cluster_id")
    reach = geo.haversine(F.col("lat"), F.col("lng"), F.col("latitude"), F.col("longitude"))
    stops = stops.select("stop_id", "road_id", "latitude", "longitude", "lat", "lng", reach.alias("reach"))
    places = roads.select("road_id", "latitude", "longitude").distinct()
    there = stops.join(places, ["road_id", "latitude", "longitude"]).select("stop_id", "lat", "lng", "reach")
    # a second search, by the coverage of stops, has to come to the same distances
    again = nearest(there.select("stop_id", F.col("lat").alias("latitude"), F.col("lng").alias("longitude"), "reach"), places, ["road_id"])
    good = again.where(F.abs(F.col("distance") - F.col("reach")) < 1e-6).select("stop_id", F.lit(1).alias("good"))
    return planned["assignments"].join(good, "stop_id", "left").agg(
        F.count_distinct("student_id").alias("students"), F.count("good").alias("at_nearest_road_point"))


# --- views -----------------------------------------------------------------------------

def _some_assignments(spark, d) -> DataFrame:
    return fx.assignments(spark, d)


def _entities(spark, d) -> DataFrame:
    stops = fx.zone_stops(spark, d)
    assigned = views.assignment_view(fx.students(spark, d), _some_assignments(spark, d))
    by_nearest = nearest(fx.buses(spark, d), stops, ["stop_id"]).select(
        "bus_id", "stop_id", "distance", F.col("capacity").cast("bigint").alias("num_students"))
    served = views.bus_view(fx.buses(spark, d), by_nearest)
    return views.entities(assigned, stops, served)


@query
def student_assignment_view(spark, d):
    return views.assignment_view(fx.students(spark, d), _some_assignments(spark, d))


@query
def bus_assignment_view(spark, d):
    matched = matching.match_buses(fx.zone_stops(spark, d), fx.buses(spark, d), fx.assignments(spark, d))
    return views.bus_view(fx.buses(spark, d), matched).withColumn("distance", metres("distance"))


@query
def ceil_distance(spark, d):
    """The bus list as shown: whole metres, zero for buses without a stop."""
    rows = _entities(spark, d).where("entity_type = 'bus'")
    return rows.select(F.col("id").alias("bus_id"), "stop_id", whole_metres(F.col("distance")).alias("metres"),
                       "capacity", "num_students")


@query
def assigned_stop_positions(spark, d):
    return views.assigned_positions(_some_assignments(spark, d), fx.zone_stops(spark, d)).select(
        "student_id", F.round("latitude", 9).alias("latitude"), F.round("longitude", 9).alias("longitude"))


@query
def students_listing(spark, d):
    return views.students_view(fx.students(spark, d)).orderBy("student_id")


@query
def bus_stops_listing(spark, d):
    return views.stops_view(pickup.site_stops(fx.student_clusters(spark, d), fx.road_points(spark, d)))


@query
def student_clusters_listing(spark, d):
    return views.clusters_view(fx.student_clusters(spark, d)).select(
        "cluster_id", F.round("latitude", 9).alias("latitude"), F.round("longitude", 9).alias("longitude"))


@query
def entity_lookup(spark, d):
    """One of each kind by typed id, and one that does not exist."""
    rows = _entities(spark, d)
    found = None
    for kind, text in (("student", " 20 "), ("bus stop", "7"), ("bus", "9 "), ("bus stop", "x7")):
        hit = views.lookup(rows, kind, text)
        found = hit if found is None else found.unionAll(hit)
    return found.select("entity_type", "id", "student_id", "stop_id", "bus_id", "name", "capacity",
                        F.round("latitude", 9).alias("latitude"), F.round("longitude", 9).alias("longitude"))


@query
def entity_page(spark, d):
    return views.entity_page(_entities(spark, d), "student", 3).select("id", "stop_id", "name", "latitude", "longitude")


@query
def page_counts(spark, d):
    rows = _entities(spark, d)
    counts = None
    for kind in ("student", "bus stop", "bus"):
        row = views.entity_page_count(rows, kind).select(F.lit(kind).alias("entity_type"), "pages")
        counts = row if counts is None else counts.unionAll(row)
    return counts


@query
def table_counts(spark, d):
    return views.table_counts(students=fx.students(spark, d), student_clusters=fx.student_clusters(spark, d),
                              bus_stops=fx.zone_stops(spark, d), buses=fx.buses(spark, d))


@query
def road_lines(spark, d):
    """Roads as lines again, in pieces of eight points, with the name shown for them."""
    named = fx.roads(spark, d).select("road_id", road_name(F.col("name")).alias("name"))
    lines = views.road_lines(fx.road_points(spark, d), named, piece_points=8)
    micro = F.transform("coordinates", lambda p: F.concat_ws(
        ",", F.round(p[0] * 1000000).cast("bigint"), F.round(p[1] * 1000000).cast("bigint")))
    return lines.select("road_id", "piece", "n_points", "name", F.array_join(micro, " ").alias("path"))


def _features(spark, d) -> DataFrame:
    """Road lines as map features, every second road in two parts."""
    lines = views.road_lines(fx.road_points(spark, d))
    half = F.floor(F.size("coordinates") / 2).cast("int")
    parts = F.array(F.slice("coordinates", F.lit(1), half),
                    F.slice("coordinates", half + 1, F.size("coordinates")))
    split = F.col("road_id") % 2 == 1
    return lines.select("road_id", F.when(split, "MultiLineString").otherwise("LineString").alias("kind"),
                        F.when(split, F.to_json(parts)).otherwise(F.to_json("coordinates")).alias("coordinates"))


@query
def road_line_points(spark, d):
    """Map features taken apart into numbered points."""
    return files.line_points(_features(spark, d)).select("road_id", "longitude", "latitude", "order")


@query
def road_names(spark, d):
    return files.roads(fx.roads(spark, d))


@query
def students_in_boundary(spark, d):
    """Students inside the outline of a zone: a ring through its four outermost students."""
    students = fx.students(spark, d)
    corners = [("min", "latitude"), ("max", "longitude"), ("max", "latitude"), ("min", "longitude")]
    at = F.struct("latitude", "longitude")
    outline = students.groupBy("zone").agg(*[
        (F.min_by if side == "min" else F.max_by)(at, F.struct(axis, "student_id")).alias(f"v{i}")
        for i, (side, axis) in enumerate(corners)])
    rings = outline.select("zone", F.posexplode(F.array("v0", "v1", "v2", "v3")).alias("order", "v")).select(
        "zone", "order", "v.latitude", "v.longitude")
    return boundary.inside(students.drop("zone"), rings, "zone", "student_id")


# --- order, samples, seeding -----------------------------------------------------------

@query
def surrogate_keys(spark, d):
    rows = fx.road_points(spark, d).select("road_id", "order")
    return ordering.zip_with_index(rows, "road_id", "order", name="row_id")


@query
def first_students(spark, d):
    return sampling.first_rows(fx.students(spark, d), 100, "student_id").select("student_id", "name")


@query
def float32_coords(spark, d):
    rows = fx.students(spark, d)
    return rows.select("student_id", through_float32(F.col("latitude")).alias("latitude"),
                       through_float32(F.col("longitude")).alias("longitude"))


@query
def sampled_buses(spark, d):
    return sampling.sample_rows(fx.buses(spark, d), 40, "bus_id", SEED).select("bus_id", "capacity")


@query
def seeded_people(spark, d):
    """The name and seats a seeded student or bus of each number would get."""
    rows = fx.students(spark, d).select("student_id")
    return rows.select("student_id", person_name(F.col("student_id"), SEED).alias("name"),
                       bus_seats(F.col("student_id"), SEED).alias("seats"))


def _places(spark, d) -> DataFrame:
    rows = fx.road_points(spark, d)
    return rows.select(F.concat_ws("/", "road_id", "order").alias("name"), "longitude", "latitude")


@query
def relocate_students(spark, d):
    """The first hundred students moved to points drawn with replacement, all returned."""
    return seeding.relocate_students(fx.students(spark, d), _places(spark, d), 100, SEED).select(
        "student_id", "name", "address", "latitude", "longitude")


@query
def relocate_all_students(spark, d):
    return seeding.relocate_students(fx.students(spark, d), _places(spark, d), None, SEED).select(
        "student_id", "address", "latitude", "longitude")


@query
def moved_to_stops(spark, d):
    """Students put at the position of their stop; students without one stay."""
    positions = views.assigned_positions(_some_assignments(spark, d), fx.zone_stops(spark, d))
    return updates.update_rows(fx.students(spark, d), positions, "student_id").select(
        "student_id", F.round("latitude", 9).alias("latitude"), F.round("longitude", 9).alias("longitude"))


# --- files -----------------------------------------------------------------------------

def _folder(spark) -> str:
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/files-{uuid.uuid4().hex}"


def _points_file(spark, d) -> DataFrame:
    """Students as points of interest, written and read again."""
    path = _folder(spark)
    fx.students(spark, d).select(
        F.format_string("n%08d", "student_id").alias("osm_id"), F.lit("node").alias("osm_type"), F.lit("Point").alias("geom_type"),
        F.concat(F.col("name"), F.lit(', "'), F.col("address"), F.lit('"')).alias("name"), "longitude", "latitude",
    ).write.option("header", True).option("escape", '"').csv(path)
    return files.read_points(spark, path)


@query
def points_csv(spark, d):
    return _points_file(spark, d).select("osm_id", "name", "longitude", "latitude")


@query
def seed_students(spark, d):
    """The first thousand points as students, with names made up from their numbers."""
    return seeding.seed_students(_points_file(spark, d), 1000, SEED)


@query
def seed_buses(spark, d):
    """Forty random points as buses."""
    return seeding.seed_buses(_points_file(spark, d), 40, SEED)


@query
def student_upload(spark, d):
    """A list of students in place of those in the table."""
    path = _folder(spark)
    rows = fx.students(spark, d).select("student_id", "longitude", "latitude", "name", "address")
    rows.write.option("header", True).option("escape", '"').csv(f"{path}/list")
    tables = Tables(spark, f"{path}/tables")
    tables.overwrite("students", rows.limit(5))
    seeding.replace_students(spark, tables, f"{path}/list")
    return tables.read("students")


@query
def geojson_roads(spark, d):
    """Roads as map features in files, and their points read back."""
    path = _folder(spark)
    lines = views.road_lines(fx.road_points(spark, d), fx.roads(spark, d))
    views.line_features(lines).write.text(path)
    features = files.with_road_ids(files.read_features(spark, path, "lines"))
    return files.line_points(features).join(files.roads(features), "road_id").select(
        "road_id", "name", "longitude", "latitude", "order")


@query
def cluster_stop_map(spark, d):
    """Which stop belongs to which cluster, by number."""
    clusters = fx.student_clusters(spark, d)
    stops = pickup.site_stops(clusters, fx.road_points(spark, d))
    return pickup.stop_of_cluster(stops, clusters)


# --- changes ---------------------------------------------------------------------------

def _moves(spark, d) -> DataFrame:
    return changes.decode(fx.change_messages(spark, d))


@query
def cdc_location_history(spark, d):
    """Instants as milliseconds, so that no session time zone is in the text."""
    return _moves(spark, d).select("student_id", "latitude", "longitude",
                                   F.unix_millis("timestamp").alias("moved_at"))


@query
def cdc_latest_assignment(spark, d):
    return changes.nearest_stops(_moves(spark, d), fx.zone_stops(spark, d)).select(
        "student_id", "stop_id", metres("distance").alias("distance"))


@query
def upsert_assignments(spark, d):
    """Planned assignments with every moved student's nearest stop put over them."""
    moved = changes.nearest_stops(_moves(spark, d), fx.zone_stops(spark, d)).select("student_id", "stop_id")
    return updates.upsert_rows(fx.assignments(spark, d), materialise(moved), "student_id")


def _streamed(spark, d, streams: int = 1, fold_every: int = 0) -> Tables:
    """Tables after the running stream: messages as files, several micro-batches. With two
    streams the second has a checkpoint of its own and takes the later messages."""
    ensure_checkpoint_dir(spark)
    root = f"{spark.sparkContext.getCheckpointDir()}/stream-{uuid.uuid4().hex}"
    tables = Tables(spark, f"{root}/tables")
    tables.overwrite("bus_stops", fx.zone_stops(spark, d).withColumn("road_id", F.lit(None).cast("bigint")))
    tables.overwrite("assignments", fx.assignments(spark, d))
    messages = materialise(fx.change_messages(spark, d))
    half = messages.agg(F.expr("percentile_approx(offset, 0.5)")).first()[0] or 0
    for number in range(streams):
        part = messages if streams == 1 else messages.where((F.col("offset") <= half) == (number == 0))
        part.repartitionByRange(4, "offset").write.json(f"{root}/messages-{number}")
        source = (spark.readStream.schema("value string, offset bigint").option("maxFilesPerTrigger", 2)
                  .json(f"{root}/messages-{number}"))
        changes.start(source, tables, f"{root}/checkpoint-{number}", fold_every, availableNow=True).awaitTermination()
    return tables


@query
def cdc_stream_assignments(spark, d):
    """The same through the running stream."""
    return _streamed(spark, d).read("assignments")


@query
def stream_history(spark, d):
    """The history table after two streams with a checkpoint each, one batch folded."""
    return _streamed(spark, d, streams=2, fold_every=2).read("student_locations").select(
        "student_id", "latitude", "longitude", F.unix_millis("timestamp").alias("moved_at"))


@query
def matching_after_moves(spark, d):
    """Buses matched to the stops students use after the stream."""
    tables = _streamed(spark, d, streams=2)
    tables.overwrite("buses", fx.buses(spark, d))
    return pickup.run_matching(tables).withColumn("distance", metres("distance"))
