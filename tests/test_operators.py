import math
import random

import plain
import pytest
from pyspark.sql import functions as F

from kerbside.operators import boundary, centres, density, matching, ordering, sampling, skew, updates
from kerbside.operators import nearest as N
from kerbside.operators.components import connected_components

POINT = "latitude double, longitude double"


# --- order -----------------------------------------------------------------------------

def test_zip_with_index_counts_in_key_order(spark):
    rows = [(f"k{i:05d}", i) for i in random.Random(1).sample(range(5000), 5000)]
    df = spark.createDataFrame(rows, "k string, v long").repartition(7)
    got = ordering.zip_with_index(df, "k", name="n").collect()
    assert all(r["n"] == r["v"] + 1 for r in got) and len(got) == 5000


def test_zip_with_index_spreads_copies(spark):
    df = spark.createDataFrame([("same",)] * 2000 + [("z",)], "k string").repartition(4)
    parts = ordering.zip_with_index(df, "k", name="n")
    assert sorted(r["n"] for r in parts.collect()) == list(range(1, 2002))
    assert parts.where("k = 'z'").first()["n"] == 2001


def test_running_total_of_a_group_that_fills_many_partitions(spark):
    rng = random.Random(2)
    rows = [("hot" if i % 3 else f"g{i % 50}", i, rng.randint(1, 9)) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, o long, v long").repartition(8)
    got = {r["o"]: r["before"] for r in ordering.running_total(df, "g", ["o"], "v", "before").collect()}
    sums = {}
    for g, o, v in rows:
        assert got[o] == sums.get(g, 0)
        sums[g] = sums.get(g, 0) + v


def test_next_values_across_partitions(spark):
    values = sorted({random.Random(i).randint(0, 10**6) / 7 for i in range(2000)})
    df = spark.createDataFrame([(v,) for v in values + values[:500]], "x double").repartition(6)
    got = {r["x"]: r["next"] for r in ordering.next_values(df, "x").collect()}
    assert got == dict(zip(values, values[1:] + [None]))


def test_pages_near_and_far(spark):
    df = spark.range(25_000).withColumnRenamed("id", "k").repartition(5)
    assert [r["k"] for r in ordering.page(df, "k", 3).collect()] == list(range(20, 30))
    assert [r["k"] for r in ordering.page(df, "k", 2400).collect()] == list(range(23_990, 24_000))
    assert [r["k"] for r in ordering.page(df, "k", 2501).collect()] == []
    assert ordering.page_count(df.limit(21)).first()["pages"] == 3
    assert ordering.page_count(df.limit(0)).first()["pages"] == 0


def exchanges_of_rows(spark, df):
    """Shuffles in all jobs that led to ``df``, as the SQL plans of its written parts show them."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_numbers_and_followers_need_no_second_shuffle(spark, monkeypatch):
    plans = []
    real = ordering.materialise
    monkeypatch.setattr(ordering, "materialise", lambda df: (plans.append(
        df._jdf.queryExecution().executedPlan().toString()), real(df))[1])
    df = spark.range(1000).selectExpr("id AS k", "id % 7 AS v")
    for result in (ordering.zip_with_index(df, "k", name="n"), ordering.next_values(df, "k")):
        assert exchanges_of_rows(spark, result.select("k")) <= 1    # of the one row per partition
    assert len(plans) == 2 and all(p.count("Exchange ") == 1 for p in plans)


def test_next_values_of_few_equal_and_no_values(spark):
    def steps(rows):
        return {r["x"]: r["next"] for r in ordering.next_values(spark.createDataFrame(rows, "x double"), "x").collect()}
    assert steps([]) == {} and steps([(None,)]) == {} and steps([(2.0,)] * 50) == {2.0: None}
    assert steps([(2.0,), (1.0,), (None,)] * 9) == {1.0: 2.0, 2.0: None}


# --- boundaries ------------------------------------------------------------------------

def plain_inside(ring, y, x):
    odd = False
    for (y1, x1), (y2, x2) in zip(ring, ring[1:] + ring[:1]):
        if (y1 <= y) != (y2 <= y) and x < (x2 - x1) * ((y - y1) / (y2 - y1)) + x1:
            odd = not odd
    return odd


def test_points_inside_rings(spark):
    rng = random.Random(3)
    star = [(21 + r * math.sin(a / 5 * math.pi), 105 + r * math.cos(a / 5 * math.pi)) for a, r in zip(range(10), [1, .4] * 5)]
    rings = {"star": star, "box": [(20.5, 104.5), (20.5, 105.0), (21.0, 105.0), (21.0, 104.5)], "line": [(21.0, 105.0), (22.0, 105.0)],
             "dot": [(21.0, 105.0)], "flat": [(21.0, 104.0), (21.0, 106.0), (21.0, 105.0)]}
    points = [(i, 20 + rng.random() * 2, 104 + rng.random() * 2) for i in range(400)]
    points += [(1000 + i, y, x) for i, (y, x) in enumerate([*star, *rings["box"], (20.5, 104.7), (21.0, 104.7), (20.7, 104.5), (20.7, 105.0)])]
    got = boundary.inside(
        spark.createDataFrame([*points, (5000, None, 105.0)], f"id long, {POINT}"),
        spark.createDataFrame([(k, i, *v) for k, ring in rings.items() for i, v in enumerate(ring)], f"name string, order int, {POINT}"),
        "name", "id")
    want = {(i, k) for i, y, x in points for k, ring in rings.items() if plain_inside(ring, y, x)}
    assert set(map(tuple, got.collect())) == want and {(1000, "star"), (1010, "box")} & want
    none = spark.createDataFrame([], f"name string, order int, {POINT}")
    assert boundary.inside(spark.createDataFrame(points, f"id long, {POINT}"), none, "name", "id").count() == 0


# --- samples and updates ---------------------------------------------------------------

def test_sampling_is_repeatable_and_without_replacement(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    one = sorted(r["k"] for r in sampling.sample_rows(df.repartition(3), 100, "k", 1).collect())
    two = sorted(r["k"] for r in sampling.sample_rows(df.repartition(5), 100, "k", 1).collect())
    other = sorted(r["k"] for r in sampling.sample_rows(df, 100, "k", 2).collect())
    assert one == two and one != other and len(set(one)) == 100
    assert sampling.sample_rows(df, 5000, "k", 1).count() == 1000


def test_long_prefix_gives_the_same_rows(spark, monkeypatch):
    df = spark.range(300).withColumnRenamed("id", "k").repartition(4)
    monkeypatch.setattr(sampling, "SORTED_ROWS", 10)
    assert sorted(r["k"] for r in sampling.first_rows(df, 120, "k").collect()) == list(range(120))


def test_draws_repeat_source_rows_and_need_some(spark):
    targets, source = spark.range(50).withColumnRenamed("id", "t"), spark.createDataFrame([("x",), ("y",)], "s string")
    drawn = sampling.draw_rows(targets, "t", source, "s", seed=3).collect()
    assert len(drawn) == 50 and {r["s"] for r in drawn} == {"x", "y"}
    with pytest.raises(ValueError):
        sampling.draw_rows(targets, "t", source.limit(0), "s", seed=3)


def test_updates_upserts_and_latest(spark):
    target = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k long, s string, x double")
    changes = spark.createDataFrame([(2, None), (9, 9.0)], "k long, x double")
    assert sorted(map(tuple, updates.update_rows(target, changes, "k").collect())) == [(1, "a", 1.0), (2, "b", None)]
    added = spark.createDataFrame([(2, "B", 0.0), (3, "c", 3.0)], "k long, s string, x double")
    assert sorted(map(tuple, updates.upsert_rows(target, added, "k").collect())) == [
        (1, "a", 1.0), (2, "B", 0.0), (3, "c", 3.0)]
    log = spark.createDataFrame([(1, 10, "old"), (1, 30, "new"), (1, 20, "mid"), (2, 5, "x")], "k long, o long, s string")
    assert {r["k"]: r["s"] for r in updates.latest(log, "k", "o").collect()} == {1: "new", 2: "x"}


# --- components and density ------------------------------------------------------------

def test_components_of_chains_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, 500 + i) for i in range(1, 80)]
    edges += [(900, 901), (901, 902), (902, 900), (7, 7), (160, 100)]
    got = {r["node"]: r["component"] for r in connected_components(
        spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {got[i] for i in range(100, 161)} == {100}
    assert {got[i] for i in range(500, 580)} == {500} and {got[i] for i in (900, 901, 902)} == {900}
    assert 7 not in got
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def labels(df):
    return {r["student_id"]: r["label"] for r in df.collect()}


def test_dbscan_on_scattered_and_copied_points(spark):
    rng = random.Random(4)
    points = [(i, 21 + rng.random() * 0.02, 105 + rng.random() * 0.02) for i in range(250)]
    points += [(1000 + i, 22.0, 106.0) for i in range(60)] + [(2000, 30.0, 30.0)]
    df = spark.createDataFrame(points, f"student_id long, {POINT}")
    for eps in (0.0005, 0.0012):
        got = labels(density.dbscan(df, eps))
        assert got == plain.components(points, eps)
    assert density.cluster_count(density.dbscan(df, 0.0012)).first()[0] == len(set(got.values()) - {-1})


@pytest.mark.parametrize("samples", [1, 3, 4, 12])
def test_dbscan_of_any_number_of_samples(spark, samples):
    rng = random.Random(14)
    points = [(i, 21 + rng.random() * 0.02, 105 + rng.random() * 0.02) for i in range(220)]
    points += [(1000 + i, 21.01 + rng.random() * 0.001, 105.01 + rng.random() * 0.001) for i in range(60)]
    points += [(1500 + i, 22.0, 106.0) for i in range(5)] + [(2000, 30.0, 30.0), (2001, 22.0005, 106.0)]
    df = spark.createDataFrame(points + [(3000, None, 1.0)], f"student_id long, {POINT}")
    assert labels(density.dbscan(df, 0.0012, min_samples=samples)) == {**plain.dbscan(points, 0.0012, samples), 3000: -1}


@pytest.mark.parametrize("gap", [0.99, 1.01])
def test_dbscan_splits_full_cells(spark, gap):
    """Two crowds that face each other at a little less, or more, than the radius."""
    rng, eps = random.Random(6), 0.01
    points = [(i, 10 + rng.random() * 0.004, 20 - rng.random() * 0.004) for i in range(150)]
    points += [(1000 + i, 10 + rng.random() * 0.004, 20 + eps * gap + rng.random() * 0.004) for i in range(150)]
    points += [(500, 10.002, 20.0), (1500, 10.002, 20 + eps * gap)]
    got = labels(density.dbscan(spark.createDataFrame(points, f"student_id long, {POINT}"), eps))
    assert got == plain.components(points, eps)
    assert len(set(got.values())) == (1 if gap < 1 else 2)


def test_eps_needs_points_a_step_and_distinct_positions(spark):
    def eps(points):
        return density.k_distance_eps(spark.createDataFrame(
            [(i, *p) for i, p in enumerate(points)], f"student_id long, {POINT}"))
    assert eps([(0.0, 0.0), (0.0, 1.0), (5.0, 0.0), (5.0, 1.0), (9.0, 9.0)]) == pytest.approx(1.0)
    with pytest.raises(ValueError):     # one gap size only
        eps([(0.0, 0.0), (0.0, 1.0), (5.0, 0.0), (5.0, 1.0)])
    with pytest.raises(ValueError):     # the step is right after zero
        eps([(0.0, 0.0)] * 6 + [(9.0, 9.0)])
    with pytest.raises(ValueError):
        eps([(0.0, 0.0)])
    with pytest.raises(ValueError):
        density.dbscan(spark.createDataFrame([(1, 0.0, 0.0)], f"student_id long, {POINT}"), 0.0)


def test_hot_keys_are_dealt_out(spark, monkeypatch):
    """With a tiny limit every joined key is split, and nothing changes."""
    monkeypatch.setattr(skew, "HOT_ROWS", 3)
    left = spark.createDataFrame([(1 if i % 3 else i, i) for i in range(60)], "k long, v long")
    right = spark.createDataFrame([(i, f"r{i}") for i in range(60)], "k long, s string")
    sizes = left.groupBy("k").agg(F.count("*").alias("rows"))
    joined = skew.join_unique(left, right, ["k"], sizes, 60)
    assert sorted(map(tuple, joined.collect())) == sorted((k, v, f"r{k}") for k, v in map(tuple, left.collect()))

    rng = random.Random(13)
    points = [(i, 21 + rng.random() * 0.01, 105 + rng.random() * 0.01) for i in range(120)]
    points += [(1000 + i, 21.005, 105.005) for i in range(60)]
    df = spark.createDataFrame(points, f"student_id long, {POINT}")
    assert labels(density.dbscan(df, 0.0008)) == plain.components(points, 0.0008)
    monkeypatch.setattr(N, "ROOT_POINTS", 0)
    monkeypatch.setattr(N, "CANDIDATES", -1)
    right = [(i, a, b) for i, a, b in points[:50]]
    got = N.nearest(df, spark.createDataFrame(right, f"b long, {POINT}"), ["b"])
    want = plain.nearest(points, right)
    assert {r["student_id"]: r["b"] for r in got.collect()} == {k: b for k, (_, b) in want.items()}


# --- clusters --------------------------------------------------------------------------

def test_coverage_counts_empty_clusters_as_invalid(spark):
    labelled = spark.createDataFrame([(1, 0.0, 0.0, 1), (2, 0.0, 0.02, 1)], f"student_id long, {POINT}, cluster_id long")
    both = spark.createDataFrame([(1, 0.0, 0.0), (2, 5.0, 5.0)], f"cluster_id long, {POINT}")
    shares = centres.coverage(labelled, both, 1000)
    assert {r["cluster_id"]: (r["points"], r["share"]) for r in shares.collect()} == {1: (2, 0.5), 2: (0, None)}
    assert centres.coverage_valid(shares, 0.0).first()["valid"] is False
    own = centres.coverage(labelled, both.where("cluster_id = 1"), 1000)
    assert centres.coverage_valid(own, 0.5).first()["valid"] is True
    assert centres.coverage_valid(own, 0.51).first()["valid"] is False


def test_fewest_clusters_is_a_lower_bound(spark):
    towns = [(10 * t + i, 21 + 0.2 * t, 105 + 0.2 * t) for t in range(12) for i in range(5)]
    points = spark.createDataFrame(towns, f"student_id long, {POINT}")
    least = centres.fewest_clusters(points, 1000, 1.0)
    assert 1 < least <= 12
    assert centres.fewest_clusters(points, 1000, 0.5) <= least
    assert centres.fewest_clusters(points.limit(0), 1000, 0.9) == 1


def test_first_valid_count_is_found_from_below(spark, monkeypatch):
    rng = random.Random(9)
    points = [(10 * t + i, 21 + 0.05 * t + rng.random() * 1e-3, 105 + rng.random() * 1e-3)
              for t in range(4) for i in range(10)]
    df = spark.createDataFrame(points, f"student_id long, {POINT}")
    k, labelled, found = centres.with_coverage(df, 1, 40, 1000, 0.9)
    assert k == found.count() >= 4 and labelled.count() == 40
    shares = centres.coverage(labelled, found, 1000)
    assert centres.coverage_valid(shares, 0.9).first()["valid"]
    monkeypatch.setattr(centres, "fewest_clusters", lambda *a: 1)    # no count passed over
    assert centres.with_coverage(df, 1, 40, 1000, 0.9)[0] == k
    with pytest.raises(RuntimeError):
        centres.with_coverage(df, 1, 2, 1000, 0.9)


def test_fit_numbers_its_clusters_and_repeats(spark):
    rng = random.Random(8)
    df = spark.createDataFrame([(i, rng.random(), rng.random()) for i in range(60)], f"student_id long, {POINT}")
    labelled, found = centres.fit(centres.with_features(df), 5)
    assert found.count() == 5 and labelled.count() == 60
    assert sorted(r["cluster_id"] for r in found.collect()) == [1, 2, 3, 4, 5]
    again = centres.fit(centres.with_features(df), 5)[0]
    columns = ("student_id", "cluster_id")
    assert sorted(map(tuple, labelled.select(*columns).collect())) == sorted(map(tuple, again.select(*columns).collect()))
    with pytest.raises(ValueError):
        centres.fit(centres.with_features(df.limit(3)), 5)


def test_many_centres_are_fitted_by_joins(spark, monkeypatch):
    monkeypatch.setattr(centres, "MANY_CENTRES", 10)
    monkeypatch.setattr(centres, "KMeans", None)   # holds all centres on the driver and in each task
    rng = random.Random(12)
    rows = [(i, rng.randrange(40) / 40, rng.randrange(40) / 40) for i in range(300)]
    df = spark.createDataFrame(rows, f"student_id long, {POINT}")
    labelled, found = centres.fit(centres.with_features(df), 60)
    at = {r["cluster_id"]: (r["latitude"], r["longitude"]) for r in found.collect()}
    got = {r["student_id"]: r["cluster_id"] for r in labelled.collect()}
    assert sorted(at) == list(range(1, 61)) and set(got.values()) == set(at) and len(got) == 300
    for i, lat, lng in rows:
        assert plain.planar(lat, lng, *at[got[i]]) <= min(plain.planar(lat, lng, *c) for c in at.values()) + 1e-12
    again = centres.fit(centres.with_features(df), 60)[0]
    assert {r["student_id"]: r["cluster_id"] for r in again.collect()} == got
    with pytest.raises(ValueError):
        centres.fit(centres.with_features(df.limit(11)), 12)


def test_centres_without_points_move_to_far_positions(spark):
    own = f"cluster_id long, {POINT}"
    labelled = spark.createDataFrame([(1, 0.0, 0.0, 0.0), (1, 0.0, 3.0, 3.0), (1, 0.0, 2.0, 2.0), (1, 0.0, 3.0, 3.0)], f"{own}, distance double")
    found = centres._filled(spark.createDataFrame([(1, 0.0, 0.0), (2, 9.0, 9.0), (3, 8.0, 8.0)], own), labelled,
                            spark.createDataFrame([(2,), (3,)], "cluster_id long"))
    assert sorted(map(tuple, found.collect())) == [(1, 0.0, 0.0), (2, 0.0, 3.0), (3, 0.0, 2.0)]


# --- matching --------------------------------------------------------------------------

def check_matching(spark, stops, buses, demand):
    students = [(i, stop) for i, stop in enumerate(s for s, n in demand.items() for _ in range(n))]
    got = matching.match_buses(
        spark.createDataFrame(stops, f"stop_id long, {POINT}"),
        spark.createDataFrame(buses, f"bus_id long, {POINT}, capacity int"),
        spark.createDataFrame(students, "student_id long, stop_id long"))
    got = {r["bus_id"]: (r["stop_id"], r["num_students"]) for r in got.collect()}
    assert got == plain.greedy(stops, buses, {s: n for s, n in demand.items() if s in {x[0] for x in stops}})


@pytest.mark.parametrize("root", [0, 32])
def test_matching_equals_greedy(spark, monkeypatch, root):
    monkeypatch.setattr(N, "ROOT_POINTS", root)
    rng = random.Random(12)
    stops = [(i, 21 + rng.random() * 0.1, 105 + rng.random() * 0.1) for i in range(30)]
    buses = [(i, 21 + rng.random() * 0.1, 105 + rng.random() * 0.1, rng.choice([16, 29, 35, 45])) for i in range(120)]
    demand = {s: rng.randint(0, 60) for s, _, _ in stops}
    demand[3] = 900            # a third of all, so that it needs many buses
    demand[99] = 5             # a stop that is not in the table
    check_matching(spark, stops, buses, demand)


def test_matching_with_too_few_buses_and_one_depot(spark, grid):
    stops = [(i, 21 + i * 0.001, 105.0) for i in range(12)] + [(50, 21.003, 105.0), (51, 21.003, 105.0)]
    buses = [(i, 21.5, 105.5, 20) for i in range(15)] + [(100, 21.003, 105.0, 0), (101, 21.003, 105.0, 5)]
    check_matching(spark, stops, buses, {s: 45 for s, _, _ in stops})


def test_matching_of_shared_positions(spark):
    """Stops and buses in heaps, with ids in and out of order, whole numbers of buses and not."""
    rng = random.Random(31)
    spots = [(21 + rng.random() * 0.1, 105 + rng.random() * 0.1) for _ in range(5)]
    stops = [(i, *spots[i // 4 % 5 if i < 20 else rng.randrange(5)]) for i in range(28)]
    garages = [spots[0], spots[3], (21.05, 105.05), (21.01, 105.09)]
    buses = [(i, *rng.choice(garages), rng.choice([0, 16, 29, 35, 45])) for i in range(60)]
    buses += [(100 + i, 21 + rng.random() * 0.1, 105 + rng.random() * 0.1, 16) for i in range(20)]
    check_matching(spark, stops, buses, {s: rng.choice([1, 16, 40, 90]) for s, _, _ in stops})


def test_matching_of_a_depot_in_several_turns(spark, monkeypatch):
    monkeypatch.setattr(matching, "CHAIN", 4)
    stops = [(i, 21.0 + i / 100, 105.0) for i in range(6)]
    buses = [(i, 21.0, 105.0, 16) for i in range(14)] + [(20, 21.05, 105.0, 45)]
    check_matching(spark, stops, buses, {0: 20, 1: 16, 2: 40, 3: 1, 4: 50, 5: 17})


def test_matching_of_equally_far_stops(spark):
    """Edges of equal distance go by stop id, whatever stops share a position."""
    stops = [(1, 0.0, 1.0), (2, 0.0, -1.0), (3, 0.0, 1.0), (4, 0.0, -1.0), (5, 0.0, -1.0), (6, 0.0, 1.0)]
    buses = [(i, 0.0, 0.0, 10) for i in range(9)]
    check_matching(spark, stops, buses, {1: 10, 2: 15, 3: 10, 4: 10, 5: 12, 6: 30})


def jobs_of(spark, name, action):
    spark.sparkContext.setJobGroup(name, name)
    try:
        action()
    finally:
        spark.sparkContext.setJobGroup("other", "other")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


@pytest.mark.parametrize("one", ["stops", "buses"])
def test_matching_takes_as_many_jobs_for_8_stops_as_for_64(spark, monkeypatch, one):
    """All stops at one position, then all buses at one; each search in the same way."""
    monkeypatch.setattr(N, "ROOT_POINTS", 1000)
    jobs = {}
    for n in (8, 64):
        spot, line = (21.0, 105.0), [(21 + i / 1000, 105.1 + i / 997) for i in range(3 * n)]
        stops = [(i, *(spot if one == "stops" else line[i])) for i in range(n)]
        buses = [(i, *(spot if one == "buses" else line[i]), 16 if i % 2 else 45) for i in range(3 * n)]
        jobs[n] = jobs_of(spark, f"{one}-{n}", lambda: check_matching(spark, stops, buses, {s: 30 + s % 40 for s, _, _ in stops}))
    assert 0 < jobs[64] <= jobs[8] + 5


def test_matching_nothing(spark):
    check_matching(spark, [(1, 0.0, 0.0)], [(1, 0.0, 0.0, 10)], {9: 3})
    got = matching.match_buses(spark.createDataFrame([], f"stop_id long, {POINT}"),
                               spark.createDataFrame([], f"bus_id long, {POINT}, capacity int"),
                               spark.createDataFrame([], "student_id long, stop_id long"))
    assert got.count() == 0 and got.columns == ["bus_id", "stop_id", "distance", "num_students"]


def test_stop_demand(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, 6)], "student_id long, stop_id long")
    assert {r["stop_id"]: r["num_students"] for r in matching.stop_demand(df).collect()} == {5: 2, 6: 1}


def test_lloyd_keeps_a_centre_without_points(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.0, 1.0)], f"student_id long, {POINT}")
    start = spark.createDataFrame([(1, 0.0, 0.5), (2, 40.0, 40.0)], f"cluster_id long, {POINT}")
    labelled, moved = centres.lloyd(points, start, 2)
    assert {r["cluster_id"] for r in labelled.collect()} == {1}
    assert sorted(map(tuple, moved.select("cluster_id", F.round("longitude", 6)).collect())) == [(1, 0.5), (2, 40.0)]
