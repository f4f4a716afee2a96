import random

import plain
import pytest

from kerbside.operators import nearest as N

POINT = "latitude double, longitude double"


@pytest.fixture(params=["grid", "around", "few"])
def ways(request, monkeypatch):
    """The ways of searching, each by the grid whatever the sizes."""
    monkeypatch.setattr(N, "ROOT_POINTS", 0)
    monkeypatch.setattr(N, "NEIGHBOURS", 0 if request.param == "grid" else 128)
    monkeypatch.setattr(N, "FEW_ROWS", 10_000 if request.param == "few" else -1)


def found(df, left="a", right="b"):
    return {r[left]: (r["distance"], r[right]) for r in df.collect()}


def same(got, want, tolerance):
    assert got.keys() == want.keys()
    for key, (distance, other) in want.items():
        assert got[key][0] == pytest.approx(distance, rel=1e-9, abs=tolerance), key
        assert got[key][1] == other, key


def clumped(rng, n, start=0, clump=1e-3):
    """A third in a clump, a third on one spot, the rest across a town and far off."""
    rows = []
    for i in range(n):
        kind = i % 3
        if kind == 0:
            lat, lng = 21.01 + rng.random() * clump, 105.81 + rng.random() * clump
        elif kind == 1:
            lat, lng = 21.03, 105.84
        else:
            lat, lng = 21 + rng.random() * 0.1, 105.8 + rng.random() * 0.1
            if i % 30 == 2:
                lat, lng = lat + 5, lng - 7
        rows.append((start + i, lat, lng))
    return rows


@pytest.mark.parametrize("metric, clump", [("haversine", 1e-3), ("planar", 1e-5)])
def test_clumped_points_against_brute_force(spark, ways, metric, clump):
    rng = random.Random(7)
    left, right = clumped(rng, 300, 0, clump), clumped(rng, 400, 1000, clump)
    right += [(5000, 21.5, 105.5)]
    got = N.nearest(spark.createDataFrame(left, f"a long, {POINT}"),
                    spark.createDataFrame(right, f"b long, {POINT}"), ["b"], metric=metric)
    same(found(got), plain.nearest(left, right, getattr(plain, metric)), 1e-6)


def test_far_from_a_dense_cluster(spark, ways):
    rng = random.Random(3)
    left = [(i, 10 + rng.random(), 90 + rng.random()) for i in range(40)]
    right = [(i, 21 + rng.random() * 0.01, 105 + rng.random() * 0.01) for i in range(500)]
    got = N.nearest(spark.createDataFrame(left, f"a long, {POINT}"),
                    spark.createDataFrame(right, f"b long, {POINT}"), ["b"])
    same(found(got), plain.nearest(left, right), 1e-6)


def test_date_line_and_poles(spark, ways):
    left = [(1, 0.0, 179.999), (2, 89.99, 10.0), (3, -89.99, -100.0)]
    right = [(10, 0.0, -179.999), (11, 0.0, 179.0), (12, 89.99, -170.0), (13, 89.0, 10.0), (14, -89.99, 80.0)]
    got = N.nearest(spark.createDataFrame(left, f"a long, {POINT}"),
                    spark.createDataFrame(right, f"b long, {POINT}"), ["b"])
    same(found(got), plain.nearest(left, right), 1e-6)


@pytest.mark.parametrize("root, few", [(0, -1), (32, -1), (0, 100), (32, 100)])
def test_ties_go_to_the_lowest_ids(spark, monkeypatch, root, few):
    monkeypatch.setattr(N, "ROOT_POINTS", root)
    monkeypatch.setattr(N, "FEW_ROWS", few)
    left = spark.createDataFrame([(1, 0.0, 0.0)], f"a long, {POINT}")
    right = spark.createDataFrame(
        [(7, 2, 0.0, 1.0), (7, 1, 0.0, -1.0), (9, 0, 1.0, 0.0), (8, 0, 0.0, 1.0)], f"b long, c long, {POINT}")
    row = N.nearest(left, right, ["b", "c"]).first()
    assert (row["b"], row["c"]) == (7, 1)


@pytest.mark.parametrize("root, few", [(0, -1), (32, -1), (0, 100), (32, 100)])
def test_missing_coordinates_and_empty_sides(spark, monkeypatch, root, few):
    monkeypatch.setattr(N, "ROOT_POINTS", root)
    monkeypatch.setattr(N, "FEW_ROWS", few)
    left = spark.createDataFrame([(1, 0.0, 0.0), (2, None, 1.0)], f"a long, {POINT}")
    right = spark.createDataFrame([(5, 1.0, 1.0), (6, None, None)], f"b long, {POINT}")
    assert found(N.nearest(left, right, ["b"])).keys() == {1}
    assert N.nearest(left, right.where("b > 9"), ["b"]).count() == 0
    assert N.nearest(left.where("a > 9"), right, ["b"]).count() == 0


@pytest.mark.parametrize("around", [0, 128])
def test_same_result_when_nothing_may_be_broadcast(spark, grid, monkeypatch, around):
    from kerbside import session
    monkeypatch.setattr(N, "broadcast_if", lambda df, rows: session.broadcast_if(df, rows, limit=-1))
    monkeypatch.setattr(N, "CANDIDATES", -1)
    monkeypatch.setattr(N, "FEW_ROWS", -1)
    monkeypatch.setattr(N, "NEIGHBOURS", around)
    rng = random.Random(11)
    left, right = clumped(rng, 100), clumped(rng, 100, 1000)
    got = N.nearest(spark.createDataFrame(left, f"a long, {POINT}"),
                    spark.createDataFrame(right, f"b long, {POINT}"), ["b"])
    same(found(got), plain.nearest(left, right), 1e-6)


@pytest.mark.parametrize("metric", ["haversine", "planar"])
def test_a_crowd_and_an_outlier(spark, grid, monkeypatch, metric):
    """Cells get fine where points are, whatever the extent."""
    monkeypatch.setattr(N, "FEW_ROWS", -1)
    monkeypatch.setattr(N, "NEIGHBOURS", 0)
    rng = random.Random(9)
    right = [(i, 21 + rng.random() * 1e-5, 105.8 + rng.random() * 1e-5) for i in range(3000)] + [(9000, -40.0, -70.0)]
    left = [(i, 21 + rng.random() * 1e-5, 105.8 + rng.random() * 1e-5) for i in range(300)]
    left += [(1000, 21.5, 105.8), (1001, -39.0, -70.0), (1002, 21.00001, 105.81)]
    held = []
    run = N.Descent.run

    def watched(self, first):
        done = run(self, first)
        held.extend(pairs.agg({"points": "max"}).first()[0] or 0 for _, pairs, _ in done)
        return done

    monkeypatch.setattr(N.Descent, "run", watched)
    got = N.nearest(spark.createDataFrame(left, f"a long, {POINT}"), spark.createDataFrame(right, f"b long, {POINT}"), ["b"], metric=metric)
    same(found(got), plain.nearest(left, right, getattr(plain, metric)), 1e-6)
    assert held and max(held) <= N.LEAF


def test_points_that_only_their_last_bits_tell_apart(spark, grid, monkeypatch):
    monkeypatch.setattr(N, "FEW_ROWS", -1)
    step = 2.0 ** -44
    right = [(i, 21 + i * step, 105.8) for i in range(60)] + [(100, 30.0, 100.0)]
    left = [(1, 21 + 20.2 * step, 105.8), (2, 29.0, 100.0)]
    got = N.nearest(spark.createDataFrame(left, f"a long, {POINT}"), spark.createDataFrame(right, f"b long, {POINT}"), ["b"], metric="planar")
    assert {k: v[1] for k, v in found(got).items()} == {1: 20, 2: 100}


def test_several_neighbours_in_order(spark, grid):
    rng = random.Random(12)
    left = [(i, 21 + rng.random() * 0.1, 105 + rng.random() * 0.1, i % 40) for i in range(60)]
    right = [(i, 21 + rng.random() * 0.1, 105 + rng.random() * 0.1) for i in range(150)] + [(500, 21.05, 105.05)] * 3
    index = N.build_index(spark.createDataFrame(right, f"b long, {POINT}"), ["b"], searched_by=None, merge_copies=False)
    got = N.search(spark.createDataFrame(left, f"a long, {POINT}, k int"), index, wanted="k").collect()
    want = {a: sorted((plain.haversine(lat, lng, y, x), b) for b, y, x in right)[:k] for a, lat, lng, k in left if k}
    assert {r["a"]: [f["b"] for f in r["found"]] for r in got} == {a: [b for _, b in hits] for a, hits in want.items()}


@pytest.mark.parametrize("root, few, around", [(0, -1, 0), (32, 1000, 128), (0, 1000, 128), (0, 1000, 4), (0, -1, 128)])
@pytest.mark.parametrize("metric", ["planar", "haversine"])
def test_nearest_other(spark, monkeypatch, root, few, around, metric):
    monkeypatch.setattr(N, "ROOT_POINTS", root)
    monkeypatch.setattr(N, "FEW_ROWS", few)
    monkeypatch.setattr(N, "NEIGHBOURS", around)
    points = clumped(random.Random(5), 240) + [(900, 50.0, 50.0)]
    got = N.nearest_other(spark.createDataFrame(points, f"a long, {POINT}"), metric)
    got = {r["a"]: r["distance"] for r in got.collect()}
    want = plain.nearest_other(points, getattr(plain, metric))
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], rel=1e-9 if metric == "haversine" else 1e-12, abs=1e-8 if metric == "haversine" else 1e-15)
               for k in want)


def test_few_rows_move_nothing_of_the_right_side(spark, monkeypatch):
    monkeypatch.setattr(N, "ROOT_POINTS", 0)
    points = spark.range(5000).selectExpr("id AS b", "21 + (id * 7919 % 1009) / 1e4 AS latitude", "105 + (id * 104729 % 1013) / 1e4 AS longitude")
    got = N.nearest(points.where("b < 20").withColumnRenamed("b", "a"), points, ["b"])
    assert all(r["a"] == r["b"] for r in got.collect())
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Range (0, 5000" in plan
    exchanged = [line for line in got._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange hashpartitioning" in line]
    assert all("__row" in line for line in exchanged)


def test_nearest_other_of_one_point_and_none(spark):
    one = spark.createDataFrame([(1, 1.0, 2.0), (2, None, 2.0)], f"a long, {POINT}")
    assert N.nearest_other(one).count() == 0 and N.nearest_other(one.where("a > 2")).count() == 0
    copies = spark.createDataFrame([(1, 1.0, 2.0), (2, 1.0, 2.0)], f"a long, {POINT}")
    assert {r["distance"] for r in N.nearest_other(copies).collect()} == {0.0}


def test_cells_around_many_left_cells_are_not_broadcast(spark, grid, monkeypatch):
    """27 cells for each left cell are far more than the shuffle of the left cells holds, and
    stored cells take far fewer bytes in files than in a broadcast."""
    written = []
    store = N.store

    def planned(df):
        stored = store(df)
        written.append(df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0])
        return stored

    monkeypatch.setattr(N, "store", planned)
    monkeypatch.setattr(N, "FEW_ROWS", 10)
    rng = random.Random(21)
    left = [(i, 21 + rng.random() / 10, 105 + rng.random() / 10) for i in range(600)]
    right = [(i, 21 + rng.random() / 10, 105 + rng.random() / 10) for i in range(600)]
    found = N.nearest(spark.createDataFrame(left, "id long, latitude double, longitude double"),
                      spark.createDataFrame(right, "place long, latitude double, longitude double"), ["place"])
    got = {r["id"]: r["place"] for r in found.collect()}
    assert got == {i: j for i, (_, j) in plain.nearest(left, right).items()}
    around = [p for p in written if "Generate explode(array(struct(" in p and "Aggregate" in p]
    assert around and not any("BroadcastHashJoin" in p for p in around)
