"""SQL that a single-node engine runs on the same tables, one text per query.

Which clusters a fitted model finds is not said in SQL; queries over these return facts that
hold for every right result.
"""

from __future__ import annotations

from kerbside.fixtures import with_sql
from kerbside.functions.scalars import BUS_SEATS, FAMILY_NAMES, GIVEN_NAMES, UNNAMED_ROAD

RADIUS = "CAST(0.002 AS DOUBLE)"


def _hav(lat1: str, lng1: str, lat2: str, lng2: str) -> str:
    half_lat = f"sin((radians({lat2}) - radians({lat1})) / 2)"
    half_lng = f"sin((radians({lng2}) - radians({lng1})) / 2)"
    return (f"(CAST(6371000 AS DOUBLE) * (2 * asin(least(CAST(1 AS DOUBLE), sqrt({half_lat} * {half_lat}"
            f" + cos(radians({lat1})) * cos(radians({lat2})) * ({half_lng} * {half_lng}))))))")


def _planar(a: str, b: str) -> str:
    return (f"sqrt(({a}.latitude - {b}.latitude) * ({a}.latitude - {b}.latitude)"
            f" + ({a}.longitude - {b}.longitude) * ({a}.longitude - {b}.longitude))")


def _hash(key: str, purpose: str) -> str:
    return f"CAST('0x' || substr(md5('42:{purpose}:' || {key}), 1, 15) AS BIGINT)"


def _pick(values: list, key: str, purpose: str) -> str:
    items = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
    return f"([{items}])[{_hash(key, purpose)} % {len(values)} + 1]"


_AB = _hav("a.latitude", "a.longitude", "b.latitude", "b.longitude")


def _nearest(left: str, right: str, left_key: str, right_keys: list[str], extra: str = "") -> str:
    """Common table ``near``: each left row with its nearest right row, by brute force."""
    keys = ", ".join(f'b."{k}"' for k in right_keys)
    names = ", ".join(f'b."{k}" AS "{k}"' for k in right_keys)
    return (f"near AS (SELECT a.{left_key} AS {left_key}, {names}, b.latitude AS latitude,"
            f" b.longitude AS longitude, {_AB} AS distance{extra} FROM {left} a CROSS JOIN {right} b"
            f" QUALIFY row_number() OVER (PARTITION BY a.{left_key} ORDER BY {_AB}, {keys}) = 1)")


_SOME = "some_assignments AS (SELECT * FROM assignments)"

_MATCHING = f"""
demand AS (SELECT stop_id, count(*) AS demand FROM assignments GROUP BY stop_id),
edges AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY distance, stop_id, bus_id) AS rn, * FROM (
    SELECT a.stop_id, b.bus_id, CAST(b.capacity AS BIGINT) AS capacity, {_AB} AS distance
    FROM zone_stops a JOIN demand USING (stop_id) CROSS JOIN buses b)),
walk AS (
  SELECT CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS bus_id, CAST(NULL AS BIGINT) AS stop_id,
    CAST(NULL AS DOUBLE) AS distance, CAST(NULL AS BIGINT) AS num_students,
    (SELECT map(list(stop_id), list(demand)) FROM demand) AS remaining, CAST([] AS BIGINT[]) AS used
  UNION ALL
  SELECT rn, bus_id, stop_id, distance, num_students,
    map_from_entries(list_transform(map_entries(remaining),
      lambda x: {{'k': x.key, 'v': CASE WHEN x.key = stop_id THEN x.value - num_students ELSE x.value END}})),
    list_append(used, bus_id)
  FROM (
    SELECT e.rn, e.bus_id, e.stop_id, e.distance, w.remaining, w.used,
      least(w.remaining[e.stop_id], e.capacity) AS num_students
    FROM walk w JOIN edges e ON e.rn > w.rn AND w.remaining[e.stop_id] > 0
      AND NOT list_contains(w.used, e.bus_id)
    QUALIFY row_number() OVER (ORDER BY e.rn) = 1)),
matched AS (SELECT bus_id, stop_id, distance, num_students FROM walk WHERE rn > 0)"""

_COMPONENTS = """
links AS MATERIALIZED (
  SELECT a.student_id AS u, b.student_id AS v FROM students a JOIN students b
  ON a.student_id <> b.student_id AND {planar} <= {eps}),
reach(node, label) AS (
  SELECT DISTINCT u, u FROM links
  UNION
  SELECT links.v, reach.label FROM reach JOIN links ON links.u = reach.node AND reach.label < links.v),
labels AS (
  SELECT s.student_id, CASE WHEN min(r.label) IS NULL THEN -1 ELSE least(min(r.label), s.student_id) END AS label
  FROM students s LEFT JOIN reach r ON r.node = s.student_id GROUP BY s.student_id)"""

_STEPS = f"""
others AS (
  SELECT a.student_id, min({_planar("a", "b")}) AS distance
  FROM students a JOIN students b ON a.student_id <> b.student_id GROUP BY a.student_id),
gaps AS (SELECT distance, lead(distance) OVER (ORDER BY distance) - distance AS gap FROM others),
radius AS (
  SELECT min(distance) AS eps FROM gaps
  WHERE gap > (SELECT avg(gap) + stddev_pop(gap) FROM gaps))"""

_COVERAGE = f"""
shares AS (
  SELECT b.cluster_id, count(*) AS points, avg(CASE WHEN {_AB} <= 600 THEN 1.0 ELSE 0.0 END) AS share
  FROM students a JOIN student_clusters b ON b.cluster_id = a.zone + 1 GROUP BY b.cluster_id)"""

_ENTITIES = f"""
{_SOME}, {_nearest("buses", "zone_stops", "bus_id", ["stop_id"])},
served AS (
  SELECT b.bus_id, n.stop_id, b.capacity, b.latitude, b.longitude, n.distance,
    CASE WHEN n.bus_id IS NOT NULL THEN CAST(b.capacity AS BIGINT) END AS num_students
  FROM buses b LEFT JOIN near n ON b.bus_id = n.bus_id),
entities AS (
  SELECT 'student' AS entity_type, s.student_id AS id, s.student_id, a.stop_id, CAST(NULL AS BIGINT) AS bus_id,
    s.name, CAST(NULL AS INTEGER) AS capacity, s.latitude, s.longitude, CAST(NULL AS DOUBLE) AS distance,
    CAST(NULL AS BIGINT) AS num_students
  FROM students s LEFT JOIN some_assignments a ON s.student_id = a.student_id
  UNION ALL
  SELECT 'bus stop', stop_id, NULL, stop_id, NULL, NULL, NULL, latitude, longitude, NULL, NULL FROM zone_stops
  UNION ALL
  SELECT 'bus', bus_id, NULL, stop_id, bus_id, NULL, capacity, latitude, longitude, distance, num_students
  FROM served)"""
_WITH_ENTITIES = with_sql("students", "buses", "assignments", "zone_stops") + "," + _ENTITIES

_PLACES = """
places AS (
  SELECT row_number() OVER (ORDER BY longitude, latitude, address) - 1 AS draw, * FROM (
    SELECT road_id || '/' || "order" AS address, longitude, latitude FROM road_points))"""


def _relocated(count: str) -> str:
    return f"""{with_sql("students", "road_points")}, {_PLACES},
moved AS (SELECT student_id FROM students ORDER BY student_id {count}),
drawn AS (
  SELECT m.student_id, p.address, p.longitude, p.latitude
  FROM moved m JOIN places p ON p.draw = {_hash("m.student_id", "draw")} % (SELECT count(*) FROM places)),
relocated AS (
  SELECT s.student_id, s.name, CASE WHEN d.student_id IS NULL THEN s.address ELSE d.address END AS address,
    coalesce(d.latitude, s.latitude) AS latitude, coalesce(d.longitude, s.longitude) AS longitude
  FROM students s LEFT JOIN drawn d ON s.student_id = d.student_id)"""


_LAST = f"""
moves AS (SELECT * FROM student_changes WHERE op <> 'd'),
last_moves AS (
  SELECT * FROM moves QUALIFY row_number() OVER (PARTITION BY student_id ORDER BY ts_ms DESC, event_id DESC) = 1),
{_nearest("last_moves", "zone_stops", "student_id", ["stop_id"])}"""
_WITH_LAST = with_sql("student_changes", "zone_stops", "assignments") + "," + _LAST
_UPSERTED_ROWS = """
SELECT coalesce(n.student_id, a.student_id) AS student_id, coalesce(n.stop_id, a.stop_id) AS stop_id
FROM assignments a FULL OUTER JOIN near n ON a.student_id = n.student_id"""
_UPSERTED = _WITH_LAST + _UPSERTED_ROWS


def _lloyd(rounds: int) -> str:
    parts = ["c0 AS MATERIALIZED (SELECT zone + 1 AS cluster_id, arg_min(latitude, student_id) AS latitude,"
             " arg_min(longitude, student_id) AS longitude FROM students GROUP BY zone)"]
    for i in range(rounds + 1):
        d = _planar("a", "b")
        parts.append(f"l{i} AS MATERIALIZED (SELECT a.student_id, b.cluster_id, a.latitude, a.longitude"
                     f" FROM students a CROSS JOIN c{i} b"
                     f" QUALIFY row_number() OVER (PARTITION BY a.student_id ORDER BY {d}, b.cluster_id) = 1)")
        if i < rounds:
            parts.append(f"c{i + 1} AS MATERIALIZED (SELECT c.cluster_id, coalesce(avg(l.latitude), min(c.latitude)) AS latitude,"
                         f" coalesce(avg(l.longitude), min(c.longitude)) AS longitude"
                         f" FROM c{i} c LEFT JOIN l{i} l ON l.cluster_id = c.cluster_id GROUP BY c.cluster_id)")
    return (with_sql("student_clusters") + ", " + ", ".join(parts) +
            f" SELECT c.cluster_id, round(c.latitude, 6) AS latitude, round(c.longitude, 6) AS longitude,"
            f" (SELECT count(*) FROM l{rounds} l WHERE l.cluster_id = c.cluster_id) AS points FROM c{rounds} c")


_POINTS = """
points AS (
  SELECT *, osm_id || '|' || CAST(longitude AS VARCHAR) || '|' || CAST(latitude AS VARCHAR) AS place FROM (
    SELECT 'n' || lpad(CAST(student_id AS VARCHAR), 8, '0') AS osm_id, name || ', "' || address || '"' AS name,
      CAST(CAST(longitude AS FLOAT) AS DOUBLE) AS longitude, CAST(CAST(latitude AS FLOAT) AS DOUBLE) AS latitude
    FROM students))"""

ORACLES: dict[str, str] = {
    "nearest_road_point": f"""{with_sql("student_clusters", "road_points")},
{_nearest("student_clusters", "road_points", "cluster_id", ["road_id", "order"])}
SELECT cluster_id AS stop_id, road_id, "order", latitude, longitude, round(distance, 3) AS distance FROM near""",
    "nearest_stop_per_student": f"""{with_sql("students", "zone_stops")},
{_nearest("students", "zone_stops", "student_id", ["stop_id"])}
SELECT student_id, stop_id, round(distance, 3) AS distance FROM near""",
    "nearest_road_point_per_student": f"""{with_sql("students", "road_points")},
pairs AS (SELECT a.student_id, b.road_id, b."order", {_AB} AS distance FROM students a CROSS JOIN road_points b),
near AS (SELECT student_id, arg_min(struct_pack(r := road_id, o := "order"),
  struct_pack(d := distance, r := road_id, o := "order")) AS hit, min(distance) AS distance FROM pairs GROUP BY student_id)
SELECT student_id, hit.r AS road_id, hit.o AS "order", round(distance, 3) AS distance FROM near""",
    "walk_distance": f"""{with_sql("students", "student_clusters")}
SELECT a.student_id, b.cluster_id, round({_AB}, 3) AS distance
FROM students a JOIN student_clusters b ON b.cluster_id = a.zone + 1""",
    "stop_demand": f"""{with_sql("students", "assignments")}
SELECT stop_id, count(*) AS num_students FROM assignments GROUP BY stop_id""",
    "bus_matching": f"""{with_sql("buses", "zone_stops", "assignments", recursive=True)}, {_MATCHING}
SELECT bus_id, stop_id, round(distance, 3) AS distance, num_students FROM matched""",
    "depot_matching": f"""{with_sql("buses", "zone_stops", "assignments", recursive=True)},
depot AS (SELECT bus_id, capacity, CAST(21.02 AS DOUBLE) AS latitude, CAST(105.83 AS DOUBLE) AS longitude FROM buses),
{_MATCHING.replace("CROSS JOIN buses b", "CROSS JOIN depot b")}
SELECT bus_id, stop_id, round(distance, 3) AS distance, num_students FROM matched""",
    "many_stops_matching": f"""{with_sql("students", "buses", "part_stops", recursive=True)},
{_nearest("students", "part_stops", "student_id", ["stop_id"])},
{_MATCHING.replace("FROM assignments GROUP", "FROM near GROUP").replace("FROM zone_stops a", "FROM part_stops a")}
SELECT bus_id, stop_id, round(distance, 3) AS distance, num_students FROM matched""",
    "cluster_coverage": f"""{with_sql("student_clusters")}, {_COVERAGE}
SELECT cluster_id, points, round(share, 9) AS share FROM shares""",
    "coverage_valid": f"""{with_sql("student_clusters")}, {_COVERAGE}
SELECT CAST(r AS DOUBLE) AS coverage_ratio, (SELECT bool_and(share >= r) FROM shares) AS valid
FROM (VALUES (CAST(0.5 AS DOUBLE)), (CAST(0.9 AS DOUBLE))) v(r)""",
    "nearest_other_student": f"""{with_sql("students")}, {_STEPS}
SELECT student_id, round(distance, 9) AS distance FROM others""",
    "sorted_gaps": f"""{with_sql("road_points")}, vals AS (SELECT DISTINCT latitude FROM road_points)
SELECT latitude, round(lead(latitude) OVER (ORDER BY latitude) - latitude, 9) AS gap FROM vals""",
    "k_distance_eps": f"""{with_sql("students")}, {_STEPS}
SELECT round(eps, 12) AS eps FROM radius""",
    "dbscan_labels": f"""{with_sql("students", recursive=True)}, {_COMPONENTS.format(planar=_planar("a", "b"), eps=RADIUS)}
SELECT student_id, label FROM labels""",
    "dbscan_min_samples": f"""{with_sql("students", recursive=True)},
pairs AS MATERIALIZED (
  SELECT a.student_id AS u, b.student_id AS v FROM students a JOIN students b ON {_planar("a", "b")} <= CAST(0.0004 AS DOUBLE)),
core AS MATERIALIZED (SELECT u AS id FROM pairs GROUP BY u HAVING count(*) >= 4),
links AS MATERIALIZED (SELECT u, v FROM pairs WHERE u IN (SELECT id FROM core) AND v IN (SELECT id FROM core)),
reach(node, label) AS (
  SELECT id, id FROM core
  UNION
  SELECT links.v, reach.label FROM reach JOIN links ON links.u = reach.node AND reach.label < links.v),
groups AS MATERIALIZED (SELECT node, min(label) AS label FROM reach GROUP BY node),
near AS (SELECT p.u AS id, min(g.label) AS label FROM pairs p JOIN groups g ON g.node = p.v GROUP BY p.u)
SELECT s.student_id, coalesce(g.label, n.label, -1) AS label FROM students s
LEFT JOIN groups g ON g.node = s.student_id LEFT JOIN near n ON n.id = s.student_id""",
    "dbscan_count": f"""{with_sql("students", recursive=True)}, {_STEPS},
{_COMPONENTS.format(planar=_planar("a", "b"), eps="(SELECT eps FROM radius)")}
SELECT count(DISTINCT label) FILTER (WHERE label <> -1) AS n_clusters FROM labels""",
    "kmeans_lloyd": _lloyd(3),
    "plan_clusters_summary": f"""{with_sql("students")}
SELECT count(*) AS students, true AS covered, true AS numbered FROM students""",
    "pickup_plan": f"""{with_sql("students")}
SELECT count(DISTINCT student_id) AS students, count(*) AS at_nearest_road_point FROM students""",
    "student_assignment_view": f"""{with_sql("students", "assignments")}, {_SOME}
SELECT s.student_id, a.stop_id, s.name, s.latitude, s.longitude
FROM students s LEFT JOIN some_assignments a ON s.student_id = a.student_id""",
    "bus_assignment_view": f"""{with_sql("buses", "zone_stops", "assignments", recursive=True)}, {_MATCHING}
SELECT b.bus_id, m.stop_id, b.capacity, b.latitude, b.longitude, round(m.distance, 3) AS distance, m.num_students
FROM buses b LEFT JOIN matched m ON b.bus_id = m.bus_id""",
    "ceil_distance": f"""{_WITH_ENTITIES}
SELECT id AS bus_id, stop_id, CAST(ceil(coalesce(distance, 0)) AS BIGINT) AS metres, capacity, num_students
FROM entities WHERE entity_type = 'bus'""",
    "assigned_stop_positions": f"""{with_sql("assignments", "zone_stops")}, {_SOME}
SELECT a.student_id, round(b.latitude, 9) AS latitude, round(b.longitude, 9) AS longitude
FROM some_assignments a JOIN zone_stops b ON a.stop_id = b.stop_id""",
    "students_listing": f"""{with_sql("students")}
SELECT student_id, address, longitude, latitude, name FROM students ORDER BY student_id""",
    "bus_stops_listing": f"""{with_sql("student_clusters", "road_points")},
{_nearest("student_clusters", "road_points", "cluster_id", ["road_id", "order"])}
SELECT cluster_id AS stop_id, road_id, latitude, longitude FROM near""",
    "student_clusters_listing": f"""{with_sql("student_clusters")}
SELECT cluster_id, round(latitude, 9) AS latitude, round(longitude, 9) AS longitude FROM student_clusters""",
    "entity_lookup": f"""{_WITH_ENTITIES}
SELECT entity_type, id, student_id, stop_id, bus_id, name, capacity, round(latitude, 9) AS latitude,
  round(longitude, 9) AS longitude FROM entities
WHERE (entity_type = 'student' AND id = 20) OR (entity_type = 'bus stop' AND id = 7) OR (entity_type = 'bus' AND id = 9)""",
    "entity_page": f"""{_WITH_ENTITIES}
SELECT id, stop_id, name, latitude, longitude FROM entities WHERE entity_type = 'student'
ORDER BY id LIMIT 10 OFFSET 20""",
    "page_counts": f"""{_WITH_ENTITIES}
SELECT entity_type, CAST(ceil(count(*) / 10) AS BIGINT) AS pages FROM entities GROUP BY entity_type""",
    "table_counts": f"""{with_sql("students", "zone_stops", "buses")}
SELECT 'students' AS table_name, count(*) AS "rows" FROM students
UNION ALL SELECT 'student_clusters', count(*) FROM student_clusters
UNION ALL SELECT 'bus_stops', count(*) FROM zone_stops
UNION ALL SELECT 'buses', count(*) FROM buses""",
    "road_lines": f"""{with_sql("road_points", "roads")},
pieces AS (
  SELECT road_id, CAST("order" // 8 AS INTEGER) AS piece, "order", longitude, latitude FROM road_points
  UNION ALL
  SELECT road_id, CAST("order" // 8 - 1 AS INTEGER), "order", longitude, latitude FROM road_points
  WHERE "order" > 0 AND "order" % 8 = 0),
lines AS (
  SELECT road_id, piece, CAST(count(*) AS INTEGER) AS n_points,
    string_agg(CAST(round(longitude * 1000000) AS BIGINT) || ',' || CAST(round(latitude * 1000000) AS BIGINT), ' '
      ORDER BY "order") AS path
  FROM pieces GROUP BY road_id, piece HAVING piece = 0 OR count(*) > 1)
SELECT l.road_id, l.piece, l.n_points, coalesce(r.name, '{UNNAMED_ROAD}') AS name, l.path
FROM lines l LEFT JOIN roads r ON l.road_id = r.road_id""",
    "road_line_points": f"""{with_sql("road_points")}
SELECT road_id, longitude, latitude, CAST(row_number() OVER (PARTITION BY road_id ORDER BY "order") - 1 AS INTEGER) AS "order"
FROM road_points""",
    "road_names": f"""{with_sql("roads")}
SELECT road_id, coalesce(name, '{UNNAMED_ROAD}') AS name FROM roads""",
    "students_in_boundary": f"""{with_sql("students")},
corners AS (
  SELECT zone, unnest([0, 1, 2, 3]) AS "order", unnest([
    arg_min({{'y': latitude, 'x': longitude}}, {{'a': latitude, 'i': student_id}}),
    arg_max({{'y': latitude, 'x': longitude}}, {{'a': longitude, 'i': student_id}}),
    arg_max({{'y': latitude, 'x': longitude}}, {{'a': latitude, 'i': student_id}}),
    arg_min({{'y': latitude, 'x': longitude}}, {{'a': longitude, 'i': student_id}})]) AS v
  FROM students GROUP BY zone),
edges AS (
  SELECT a.zone, a.v.y AS y1, a.v.x AS x1, b.v.y AS y2, b.v.x AS x2
  FROM corners a JOIN corners b ON a.zone = b.zone AND b."order" = (a."order" + 1) % 4)
SELECT s.student_id, e.zone FROM students s JOIN edges e
ON (e.y1 <= s.latitude) <> (e.y2 <= s.latitude)
  AND s.longitude < (e.x2 - e.x1) * ((s.latitude - e.y1) / (e.y2 - e.y1)) + e.x1
GROUP BY s.student_id, e.zone HAVING count(*) % 2 = 1""",
    "surrogate_keys": f"""{with_sql("road_points")}
SELECT road_id, "order", row_number() OVER (ORDER BY road_id, "order") AS row_id FROM road_points""",
    "first_students": f"""{with_sql("students")}
SELECT student_id, name FROM students ORDER BY student_id LIMIT 100""",
    "float32_coords": f"""{with_sql("students")}
SELECT student_id, CAST(CAST(latitude AS FLOAT) AS DOUBLE) AS latitude,
  CAST(CAST(longitude AS FLOAT) AS DOUBLE) AS longitude FROM students""",
    "sampled_buses": f"""{with_sql("buses")}
SELECT bus_id, capacity FROM buses ORDER BY {_hash("bus_id", "sample")}, bus_id LIMIT 40""",
    "seeded_people": f"""{with_sql("students")}
SELECT student_id, {_pick(GIVEN_NAMES, "student_id", "given")} || ' ' || {_pick(FAMILY_NAMES, "student_id", "family")} AS name,
  {_pick(BUS_SEATS, "student_id", "seats")} AS seats FROM students""",
    "relocate_students": _relocated("LIMIT 100") + """
SELECT student_id, name, address, latitude, longitude FROM relocated""",
    "relocate_all_students": _relocated("") + """
SELECT student_id, address, latitude, longitude FROM relocated""",
    "moved_to_stops": f"""{with_sql("students", "assignments", "zone_stops")}, {_SOME}
SELECT s.student_id, round(coalesce(b.latitude, s.latitude), 9) AS latitude,
  round(coalesce(b.longitude, s.longitude), 9) AS longitude
FROM students s LEFT JOIN some_assignments a ON s.student_id = a.student_id LEFT JOIN zone_stops b ON a.stop_id = b.stop_id""",
    "points_csv": f"""{with_sql("students")}
SELECT 'n' || lpad(CAST(student_id AS VARCHAR), 8, '0') AS osm_id, name || ', "' || address || '"' AS name, longitude, latitude
FROM students""",
    "seed_students": f"""{with_sql("students")}, {_POINTS},
seeded AS (
  SELECT row_number() OVER (ORDER BY osm_id, longitude, latitude) AS student_id, name AS address, longitude, latitude
  FROM points ORDER BY osm_id, longitude, latitude LIMIT 1000)
SELECT *, {_pick(GIVEN_NAMES, "student_id", "given")} || ' ' || {_pick(FAMILY_NAMES, "student_id", "family")} AS name FROM seeded""",
    "seed_buses": f"""{with_sql("students")}, {_POINTS},
drawn AS (SELECT * FROM points ORDER BY {_hash("place", "sample")}, place LIMIT 40),
seeded AS (SELECT row_number() OVER (ORDER BY place) AS bus_id, latitude, longitude FROM drawn)
SELECT *, {_pick(BUS_SEATS, "bus_id", "seats")} AS capacity FROM seeded""",
    "student_upload": f"""{with_sql("students")}
SELECT student_id, address, longitude, latitude, name FROM students""",
    "geojson_roads": f"""{with_sql("road_points", "roads")}
SELECT p.road_id, coalesce(r.name, '{UNNAMED_ROAD}') AS name, p.longitude, p.latitude,
  CAST(row_number() OVER (PARTITION BY p.road_id ORDER BY p."order") - 1 AS INTEGER) AS "order"
FROM road_points p JOIN roads r ON p.road_id = r.road_id""",
    "cluster_stop_map": f"""{with_sql("student_clusters")}
SELECT cluster_id AS stop_id, cluster_id FROM student_clusters""",
    "cdc_location_history": f"""{with_sql("student_changes")}
SELECT student_id, latitude, longitude, ts_ms AS moved_at
FROM student_changes WHERE op <> 'd'""",
    "cdc_latest_assignment": f"""{_WITH_LAST}
SELECT student_id, stop_id, round(distance, 3) AS distance FROM near""",
    "upsert_assignments": _UPSERTED,
    "cdc_stream_assignments": _UPSERTED,
    "stream_history": f"""{with_sql("student_changes")}
SELECT student_id, latitude, longitude, ts_ms AS moved_at
FROM student_changes WHERE op <> 'd'""",
    "matching_after_moves": f"""{with_sql("student_changes", "zone_stops", "assignments", "buses", recursive=True)}, {_LAST},
upserted AS ({_UPSERTED_ROWS}),
{_MATCHING.replace("FROM assignments GROUP", "FROM upserted GROUP")}
SELECT bus_id, stop_id, round(distance, 3) AS distance, num_students FROM matched""",
}
