import json

import pytest
from pyspark.sql import functions as F

from kerbside import schemas
from kerbside.functions.scalars import UNNAMED_ROAD
from kerbside.plans import seeding, views
from kerbside.sources import files, jdbc
from kerbside.sources.tables import RepeatedKey, Tables

POINTS = """osm_id,osm_type,geom_type,name,longitude,latitude
1,node,Point,"School, North",105.81,21.01
2,node,Point,,105.82,21.02
3,way,Polygon,Market,105.83,21.03
4,node,Point,Station,105.84,21.04
"""


def feature(name, kind, coordinates, osm_id=None):
    properties = {"name": name} if osm_id is None else {"osm_id": osm_id, "name": name}
    return {"type": "Feature", "properties": properties, "geometry": {"type": kind, "coordinates": coordinates}}


ROADS = [("First", "LineString", [[105.1, 21.1], [105.2, 21.2, 7.0]]),
         (None, "MultiLineString", [[[1.0, 2.0], [3.0, 4.0]], [[5.0, 6.0]]]),
         ("Square", "Point", [9.0, 9.0])]


def road_files(folder, ids):
    features = [feature(*r, osm_id=i) for r, i in zip(ROADS, ids)]
    whole = folder / "whole.geojson"
    whole.write_text(json.dumps({"type": "FeatureCollection", "name": "roads", "features": features}, indent=1),
                     encoding="utf-8")
    lines = folder / "lines.geojson"
    body = ",\n".join(json.dumps(f, ensure_ascii=False) for f in features)
    lines.write_text('{\n"type": "FeatureCollection",\n"features": [\n' + body + "\n]\n}\n", encoding="utf-8")
    return {"document": str(whole), "lines": str(lines)}


@pytest.mark.parametrize("layout", ["document", "lines"])
@pytest.mark.parametrize("ids", [(70, 71, 72), (None, None, None)])
def test_roads_and_their_points(spark, tmp_path, layout, ids):
    path = road_files(tmp_path, ids)[layout]
    features = files.with_road_ids(files.read_features(spark, path, layout))
    base = ids[0] or 0
    assert {r["road_id"]: r["name"] for r in files.roads(features).collect()} == {
        base: "First", base + 1: UNNAMED_ROAD, base + 2: "Square"}
    points = sorted((r["road_id"] - base, r["order"], r["longitude"], r["latitude"])
                    for r in files.line_points(features).collect())
    assert points == [(0, 0, 105.1, 21.1), (0, 1, 105.2, 21.2),
                      (1, 0, 1.0, 2.0), (1, 1, 3.0, 4.0), (1, 2, 5.0, 6.0)]


def test_road_ids_are_numbers_and_differ_over_files(spark, tmp_path):
    named = road_files(tmp_path, ("way/12", 71, 72))["document"]
    with pytest.raises(Exception, match="bad osm_id"):
        files.with_road_ids(files.read_features(spark, named)).collect()
    for folder in ("roads/a", "roads/b"):
        (tmp_path / folder).mkdir(parents=True)
        source = road_files(tmp_path / folder, (None, None, None))
        (tmp_path / folder / "lines.geojson").unlink()
    both = files.read_features(spark, [source["document"], str(tmp_path / "roads/a/whole.geojson")])
    assert sorted(r["road_id"] for r in files.with_road_ids(both).collect()) == [0, 1, 2, 3, 4, 5]


def test_unknown_layout(spark):
    with pytest.raises(ValueError):
        files.read_features(spark, "x", "other")


def test_points_keep_their_precision_until_they_are_seeded(spark, tmp_path):
    (tmp_path / "points.csv").write_text(POINTS)
    points = files.read_points(spark, str(tmp_path / "points.csv"))
    rows = {r["osm_id"]: r for r in points.collect()}
    assert rows["1"]["name"] == "School, North" and rows["2"]["name"] is None
    assert rows["1"]["longitude"] == 105.81
    assert seeding.seed_students(points, 1).first()["longitude"] == 105.80999755859375


def test_student_upload_replaces_all_or_nothing(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "tables"))
    tables.create()
    good, bad = tmp_path / "good.csv", tmp_path / "bad.csv"
    good.write_text('student_id,longitude,latitude,name,address\n5,105.5,21.5,"Lan, Vu",\n6, 105.6,21.6,Minh,Home\n')
    bad.write_text("student_id,longitude,latitude,name,address\n7,105.5,21.5,A,B\n8,east,21.6,C,D\n")
    assert seeding.replace_students(spark, tables, str(good)) == 2
    before = sorted(map(tuple, tables.read("students").collect()))
    assert before == [(5, "", 105.5, 21.5, "Lan, Vu"), (6, "Home", 105.6, 21.6, "Minh")]
    with pytest.raises(Exception, match="bad longitude"):
        seeding.replace_students(spark, tables, str(bad))
    bad.write_text("student_id,longitude,latitude,name,address\n,105.5,21.5,A,B\n")
    with pytest.raises(Exception, match="bad student_id"):
        seeding.replace_students(spark, tables, str(bad))
    bad.write_text("student_id,longitude,latitude,name,address\n7,105.5,21.5,A,B\n7,105.6,21.6,C,D\n")
    with pytest.raises(ValueError, match="listed 2 times"):
        seeding.replace_students(spark, tables, str(bad))
    assert sorted(map(tuple, tables.read("students").collect())) == before


def test_bootstrap_fills_the_tables(spark, tmp_path):
    (tmp_path / "points.csv").write_text(POINTS)
    roads = road_files(tmp_path, (70, 71, 72))["document"]
    tables = Tables(spark, str(tmp_path / "tables"))
    tables.append("assignments", spark.createDataFrame([(1, 1)], "student_id long, stop_id long"))
    seeding.bootstrap(spark, tables, str(tmp_path / "points.csv"), roads, 3, 2)
    assert tables.read("assignments").count() == 0
    students = {r["student_id"]: r for r in tables.read("students").collect()}
    assert sorted(students) == [1, 2, 3] and students[1]["address"] == "School, North"
    assert all(len(r["name"].split(" ")) == 2 for r in students.values())
    buses = tables.read("buses").collect()
    assert sorted(r["bus_id"] for r in buses) == [1, 2] and {r["capacity"] for r in buses} <= {16, 29, 35, 45}
    assert tables.read("roads").count() == 3 and tables.read("road_points").count() == 5
    counts = views.table_counts(students=tables.read("students"), stops=tables.read("bus_stops"))
    assert {r["table_name"]: r["rows"] for r in counts.collect()} == {"students": 3, "stops": 0}


def test_relocation_moves_the_first_students_only(spark, tmp_path):
    (tmp_path / "points.csv").write_text(POINTS)
    tables = Tables(spark, str(tmp_path / "tables"))
    tables.overwrite("students", spark.createDataFrame(
        [(i, "old", 0.0, 0.0, f"n{i}") for i in range(1, 7)], schemas.TABLES["students"]))
    points = files.read_points(spark, str(tmp_path / "points.csv"))
    rows = seeding.relocate(tables, points, 4).collect()
    assert [r["student_id"] for r in rows] == [1, 2, 3, 4, 5, 6]
    assert [r["latitude"] > 0 for r in rows] == [True] * 4 + [False] * 2
    assert all(r["latitude"] > 0 for r in seeding.relocate(tables, points, None).collect())


@pytest.mark.parametrize("indent", [None, 2])
def test_a_large_collection_is_split_over_tasks(spark, tmp_path, indent):
    features = [{"type": "Feature", "properties": {"osm_id": str(i), "name": None if i % 9 == 0 else f"Road, {i} }} \n Feature"},
                 "geometry": {"type": "LineString", "coordinates": [[105 + i / 1000, 21.0], [105.5, 21 + i / 1000]]}} for i in range(500)]
    features.append({"type": "Feature", "properties": {"osm_id": "900"}, "geometry": {
        "type": "MultiLineString", "coordinates": [[[1.0, 2.0], [3.0, 4.0]], [[5.0, 6.0]]]}})
    path = tmp_path / "roads.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "name": "roads", "features": features}, indent=indent))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        read = files.read_features(spark, str(path), "collection")
        assert read.rdd.getNumPartitions() > 3
        got = files.with_road_ids(read)
        whole = files.with_road_ids(files.read_features(spark, str(path)))
        columns = ["road_id", "name", "kind"]
        assert sorted(map(str, got.select(*columns).collect())) == sorted(map(str, whole.select(*columns).collect()))
        points = [sorted(map(tuple, files.line_points(f).collect())) for f in (got, whole)]
        assert points[0] == points[1] and len(points[0]) == 1003
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_collection_with_the_type_last_is_refused(spark, tmp_path):
    path = tmp_path / "odd.geojson"
    feature = {"properties": {"osm_id": "1"}, "geometry": {"type": "Point", "coordinates": [1, 2]}, "type": "Feature"}
    path.write_text(json.dumps({"type": "FeatureCollection", "features": [feature, feature]}))
    with pytest.raises(Exception, match="begin with its type"):
        files.read_features(spark, str(path), "collection").collect()


def test_tables_are_replaced_while_read_and_appended(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    pairs = spark.createDataFrame([(1, 10), (2, 20)], "student_id long, stop_id long")
    assert tables.read("assignments").count() == 0 and tables.version("assignments") == -1
    tables.append("assignments", pairs)
    tables.overwrite("assignments", tables.read("assignments").where("student_id = 2"))
    tables.append("assignments", pairs.where("student_id = 1"))
    assert sorted(map(tuple, tables.read("assignments").collect())) == [(1, 10), (2, 20)]
    assert tables.version("assignments") == 1
    tables.prune("assignments", keep=1)
    assert tables.read("assignments").count() == 2 and not (tmp_path / "assignments" / "v=0").exists()


def test_repeated_and_missing_keys_are_refused(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    def pairs(*rows):
        return spark.createDataFrame(rows, "student_id long, stop_id long")
    for bad in (pairs((1, 1), (1, 2)), pairs((None, 1))):
        for write in (tables.overwrite, tables.append):
            with pytest.raises(RepeatedKey):
                write("assignments", bad)
    tables.append("assignments", pairs((1, 1)))
    with pytest.raises(RepeatedKey):
        tables.append("assignments", pairs((1, 5)))
    assert [tuple(r) for r in tables.read("assignments").collect()] == [(1, 1)]
    # tables without a key take rows as they come
    places = spark.createDataFrame([(1, 0.0, 0.0, 1)] * 2, "road_id long, longitude double, latitude double, `order` int")
    tables.append("road_points", places)
    assert tables.read("road_points").count() == 2


def moves(spark, *rows):
    return spark.createDataFrame(rows, "student_id long, stop_id long, second long, changed_offset long").withColumn(
        "changed_at", F.timestamp_seconds("second"))


def state(tables):
    return dict(map(tuple, tables.read("assignments").collect()))


def test_changes_win_by_event_time_whatever_stream_and_batch(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    tables.overwrite("assignments", spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "student_id long, stop_id long"))
    assert tables.commit("assignments", "a", 5, moves(spark, (1, 11, 100, 1), (4, 40, 100, 2)))
    assert tables.commit("assignments", "b", 0, moves(spark, (1, 12, 200, 1), (2, 21, 50, 9), (2, 22, 50, 10)))
    assert tables.commit("assignments", "c", 0, moves(spark, (1, 13, 150, 99)))
    assert state(tables) == {1: 12, 2: 22, 3: 30, 4: 40}
    assert not tables.commit("assignments", "b", 0, moves(spark, (1, 99, 999, 9)))   # the batch runs again
    assert state(tables) == {1: 12, 2: 22, 3: 30, 4: 40}


def test_folding_keeps_event_times_and_later_batches(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    tables.overwrite("assignments", spark.createDataFrame([(1, 10), (2, 20)], "student_id long, stop_id long"))
    tables.commit("assignments", "a", 0, moves(spark, (1, 11, 200, 1)))
    tables.fold("assignments")
    assert tables.version("assignments") == 1 and state(tables) == {1: 11, 2: 20}
    tables.commit("assignments", "b", 0, moves(spark, (1, 12, 100, 1), (2, 21, 100, 2)))   # older than what was folded
    tables.commit("assignments", "a", 1, moves(spark, (3, 31, None, 7)))
    assert state(tables) == {1: 11, 2: 21, 3: 31}
    tables.fold("assignments")
    tables.prune("assignments", keep=1)
    assert not list((tmp_path / "assignments.log").glob("*/batch=*"))
    assert not tables.commit("assignments", "a", 0, moves(spark, (1, 99, 999, 1)))   # run again after its log went
    assert state(tables) == {1: 11, 2: 21, 3: 31}
    tables.overwrite("assignments", spark.createDataFrame([(1, 5)], "student_id long, stop_id long"))
    assert state(tables) == {1: 5}
    tables.commit("assignments", "b", 1, moves(spark, (1, 6, 1, 1)))   # any move after the plan counts
    assert state(tables) == {1: 6}


def test_an_unfinished_batch_is_not_read(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    tables.create()
    row = spark.createDataFrame([(1, 2.0, 3.0, None)], schemas.TABLES["student_locations"])
    tables.commit("student_locations", "a", 0, row)
    (tmp_path / "student_locations.log" / "stream=a" / "batch=0" / "_SUCCESS").unlink()
    assert tables.read("student_locations").count() == 0
    assert tables.commit("student_locations", "a", 0, row) and tables.read("student_locations").count() == 1
    tables.commit("student_locations", "b", 0, row)
    tables.fold("student_locations")
    tables.commit("student_locations", "b", 1, row)
    assert tables.read("student_locations").count() == 3


def test_catalogue_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS planning")
    schemas.create_tables(spark, "planning")
    for name, schema in schemas.TABLES.items():
        assert spark.table(f"planning.{name}").columns == schema.fieldNames()
        assert spark.table(f"planning.{name}").count() == 0
    spark.sql("DROP DATABASE planning CASCADE")


def test_jdbc_options():
    one = jdbc.read_options("jdbc:x", "SELECT * FROM road_points", {"user": "u"})
    assert one["dbtable"] == "(SELECT * FROM road_points) AS q" and one["user"] == "u" and "numPartitions" not in one
    split = jdbc.read_options("jdbc:x", "q", split_on="road_id", bounds=(1, 9), splits=4)
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == (
        "road_id", "1", "9", "4")
    with pytest.raises(ValueError):
        jdbc.read_options("jdbc:x", "q", split_on="road_id")


def test_long_roads_come_in_pieces_that_meet(spark):
    points = spark.createDataFrame([(1, float(i), 0.0, i) for i in range(9)] + [(2, 5.0, 5.0, 0)],
                                   schemas.TABLES["road_points"])
    rows = {(r["road_id"], r["piece"]): [p[0] for p in r["coordinates"]]
            for r in views.road_lines(points, piece_points=4).collect()}
    assert rows == {(1, 0): [0, 1, 2, 3, 4], (1, 1): [4, 5, 6, 7, 8], (2, 0): [5.0]}
    names = spark.createDataFrame([(1, "A"), (2, "B")], "road_id long, name string")
    text = [json.loads(r["value"]) for r in views.line_features(views.road_lines(points, names)).collect()]
    assert sorted(f["properties"]["name"] for f in text) == ["A", "B"]
    assert all(f["geometry"]["type"] == "LineString" for f in text)
