import json
import random

import plain

from kerbside.sources.tables import Tables
from kerbside.streaming import changes

STOPS = [(1, 21.00, 105.80), (2, 21.10, 105.80), (3, 21.00, 105.90)]


def message(student, lat, lng, ms, op="u"):
    after = None if student is None else {"student_id": student, "latitude": lat, "longitude": lng,
                                          "name": "n", "address": None}
    return json.dumps({"payload": {"op": op, "source": {"ts_ms": ms}, "after": after}})


def put(folder, number, rows):
    folder.mkdir(exist_ok=True)
    (folder / f"{number}.json").write_text("\n".join(json.dumps({"value": v, "offset": o}) for v, o in rows))


def prepared(spark, root, stops=STOPS):
    tables = Tables(spark, str(root / "tables"))
    tables.create()
    tables.overwrite("bus_stops", spark.createDataFrame(
        [(s, None, a, b) for s, a, b in stops], "stop_id long, road_id long, latitude double, longitude double"))
    tables.overwrite("assignments", spark.createDataFrame(
        [(7, 3), (8, 3)], "student_id long, stop_id long"))
    return tables


def run(spark, root, tables, **options):
    source = (spark.readStream.schema("value string, offset bigint").option("maxFilesPerTrigger", 1)
              .json(str(root / "in")))
    changes.start(source, tables, str(root / "checkpoint"), availableNow=True, **options).awaitTermination()


def assigned(tables):
    return {r["student_id"]: r["stop_id"] for r in changes.current_assignments(tables).collect()}


def test_moves_become_history_and_assignments(spark, tmp_path):
    tables = prepared(spark, tmp_path)
    first = [(message(7, 21.01, 105.81, 1_000), 1), (message(7, 21.09, 105.80, 2_500), 2),
             (message(9, 21.0, 105.89, 3_000, "c"), 3), (message(None, 0, 0, 4_000, "d"), 4),
             ("not json", 5), ('{"payload": null}', 6), (None, 7)]
    put(tmp_path / "in", 0, first)
    run(spark, tmp_path, tables)
    assert assigned(tables) == {7: 2, 8: 3, 9: 3}
    put(tmp_path / "in", 1, [(message(9, 21.0, 105.8, 9_000), 8)])
    run(spark, tmp_path, tables)     # goes on from the checkpoint
    assert assigned(tables) == {7: 2, 8: 3, 9: 1}
    history = changes.location_history(tables).selectExpr("student_id", "unix_millis(timestamp) AS ms").collect()
    assert sorted(map(tuple, history)) == [(7, 1_000), (7, 2_500), (9, 3_000), (9, 9_000)]


def test_a_second_checkpoint_adds_to_the_first(spark, tmp_path):
    tables = prepared(spark, tmp_path)
    put(tmp_path / "in", 0, [(message(7, 21.0, 105.8, 5), 1), (message(7, 21.1, 105.8, 6), 2), (message(8, 21.1, 105.8, 900), 3)])
    run(spark, tmp_path, tables)
    put(tmp_path / "next", 0, [(message(7, 21.0, 105.9, 9), 1), (message(8, 21.0, 105.8, 100), 2)])
    source = spark.readStream.schema("value string, offset bigint").json(str(tmp_path / "next"))
    changes.start(source, tables, str(tmp_path / "other"), availableNow=True).awaitTermination()
    history = tables.read("student_locations").selectExpr("student_id", "unix_millis(timestamp) AS ms").collect()
    assert sorted(map(tuple, history)) == [(7, 5), (7, 6), (7, 9), (8, 100), (8, 900)]
    assert assigned(tables) == {7: 3, 8: 2}     # the move of student 8 that came later is the older one


def test_matching_sees_moves_that_are_not_folded(spark, tmp_path):
    from kerbside.plans import pickup
    tables = prepared(spark, tmp_path)
    tables.overwrite("buses", spark.createDataFrame(
        [(1, 21.0, 105.8, 10), (2, 21.1, 105.8, 10)], "bus_id long, latitude double, longitude double, capacity int"))
    assert [tuple(r)[:2] for r in pickup.run_matching(tables).collect()] == [(1, 3)]
    batch = spark.createDataFrame([(message(7, 21.1, 105.8, 1), 1), (message(8, 21.1, 105.8, 1), 2)], "value string, offset long")
    changes.apply_batch(tables, batch, 0)
    assert [tuple(r)[:2] for r in pickup.run_matching(tables).collect()] == [(2, 2)]


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    tables = prepared(spark, tmp_path)
    rows = [(message(i % 5, 21.0 + i / 100, 105.8, i), i) for i in range(20)]
    batch = spark.createDataFrame(rows, "value string, offset long")
    changes.apply_batch(tables, batch, 0)
    before = assigned(tables), changes.location_history(tables).count()
    changes.apply_batch(tables, batch, 0)
    assert (assigned(tables), changes.location_history(tables).count()) == before
    last = {i % 5: (i % 5, 21.0 + i / 100, 105.8) for i in range(20)}
    want = {s: stop for s, (_, stop) in plain.nearest(last.values(), STOPS).items()}
    assert {s: before[0][s] for s in want} == want and before[1] == 20


def test_stops_are_indexed_once_a_version(spark, tmp_path):
    """Batches after the first take as many jobs each, until the stops change."""
    rng = random.Random(8)
    stops = [(i, 21 + rng.random() / 10, 105.8 + rng.random() / 10) for i in range(1000)]
    tables = prepared(spark, tmp_path, stops=stops)
    search, jobs = changes.StopSearch(tables), []
    spots = {}
    for number in range(4):
        if number == 3:
            tables.overwrite("bus_stops", spark.createDataFrame(
                [(s, None, a, b) for s, a, b in stops[:40]], "stop_id long, road_id long, latitude double, longitude double"))
        moved = [(100 * number + 100 + i, 21.02 + rng.random() / 20, 105.82 + rng.random() / 20) for i in range(30)]
        rows = [(message(*m, 1), n) for n, m in enumerate(moved)]
        spark.sparkContext.setJobGroup(f"batch-{number}", "")
        changes.apply_batch(tables, spark.createDataFrame(rows, "value string, offset long"), number, search=search)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"batch-{number}")))
        spots.update(plain.nearest(moved, stops if number < 3 else stops[:40]))
    spark.sparkContext.setJobGroup("other", "")
    assert {s: stop for s, stop in assigned(tables).items() if s >= 100} == {s: hit[1] for s, hit in spots.items()}
    assert jobs[1] == jobs[2] < min(jobs[0], jobs[3])


def test_moves_out_of_the_region_are_found(spark, tmp_path):
    rng = random.Random(2)
    stops = [(i, 21 + rng.random() / 10, 105.8 + rng.random() / 10) for i in range(100)]
    search = changes.StopSearch(prepared(spark, tmp_path, stops=stops))
    for moved in ([(1, 21.05, 105.85)], [(2, -33.0, -70.0), (3, 21.01, 105.81)], [(4, 50.0, 179.0)]):
        rows = [(message(*m, 1), n) for n, m in enumerate(moved)]
        moves = changes.decode(spark.createDataFrame(rows, "value string, offset long"))
        got = {r["student_id"]: r["stop_id"] for r in search(moves).collect()}
        assert got == {i: hit[1] for i, hit in plain.nearest(moved, stops).items()}


def test_without_stops_only_the_history_grows(spark, tmp_path):
    tables = prepared(spark, tmp_path, stops=[])
    changes.apply_batch(tables, spark.createDataFrame([(message(7, 21.0, 105.8, 5), 1)], "value string, offset long"), 0)
    assert assigned(tables) == {7: 3, 8: 3} and changes.location_history(tables).count() == 1


def test_folding_and_planning_anew(spark, tmp_path):
    tables = prepared(spark, tmp_path)
    def batch(student, lat, offset):
        return spark.createDataFrame([(message(student, lat, 105.8, offset), offset)], "value string, offset long")
    changes.apply_batch(tables, batch(7, 21.1, 1), 0, fold_every=2)
    changes.apply_batch(tables, batch(7, 21.0, 2), 1, fold_every=2)
    assert assigned(tables) == {7: 1, 8: 3} and tables.version("assignments") == 2
    changes.apply_batch(tables, batch(8, 21.1, 3), 2)
    assert assigned(tables) == {7: 1, 8: 2} and tables.read("student_locations").count() == 3
    tables.overwrite("assignments", spark.createDataFrame([(8, 1)], "student_id long, stop_id long"))
    assert assigned(tables) == {8: 1}     # moves from before the new plan do not undo it
