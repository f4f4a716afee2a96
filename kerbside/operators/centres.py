"""k-means over coordinates and the walking-distance check of its clusters."""

from __future__ import annotations

import math

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kerbside.functions import geo
from kerbside.operators.nearest import build_index, nearest, search
from kerbside.operators.ordering import zip_with_index
from kerbside.session import broadcast_if, forget, materialise, store

MANY_CENTRES = 5000     # counts above it are fitted by joins: no task holds all centres
MAX_ITER = 300          # fixed value: iterations of one fit
GRIDS = (1, 2, 4, 8)    # cells per disc width of the grids that bound the cluster count
TOLERANCE = 1e-4        # fixed value: movement of centres that ends a fit, by the variance


def with_features(points: DataFrame) -> DataFrame:
    assembler = VectorAssembler(inputCols=["latitude", "longitude"], outputCol="features")
    return assembler.transform(points)


def lloyd(points: DataFrame, centres: DataFrame, iterations: int = MAX_ITER,
          tolerance: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """Explicit k-means from given ``centres`` (cluster_id, latitude, longitude).

    Assignment is an exact nearest join, so neither the centres nor the points gather
    anywhere; a centre that loses its points stays. Returns points with cluster_id (their
    centre in the last assignment) and the centres.
    """
    points = store(points)
    for _ in range(iterations):
        labelled = assign(points, centres)
        means = labelled.groupBy("cluster_id").agg(F.avg("latitude").alias("lat"),
                                                   F.avg("longitude").alias("lng"))
        moved = materialise(centres.join(means, "cluster_id", "left").select(
            "cluster_id", F.coalesce("lat", "latitude").alias("latitude"),
            F.coalesce("lng", "longitude").alias("longitude"),
            geo.planar(F.coalesce("lat", "latitude"), F.coalesce("lng", "longitude"),
                       F.col("latitude"), F.col("longitude")).alias("shift")))
        centres = moved.drop("shift")
        if tolerance and moved.agg(F.max("shift")).first()[0] <= tolerance:
            break
    return assign(points, centres), centres


def assign(points: DataFrame, centres: DataFrame) -> DataFrame:
    """Stored points with the cluster_id of the nearest centre in degrees, lowest id on ties."""
    index = build_index(centres, ["cluster_id"], searched_by=[points], metric="planar")
    return search(points, index, stored=True).select(*points.columns, "cluster_id")


def scaled_tolerance(points: DataFrame) -> float:
    """The distance whose square is ``TOLERANCE`` of the mean variance of the coordinates."""
    spread = points.agg(F.var_pop("latitude") + F.var_pop("longitude")).first()[0] or 0.0
    return math.sqrt(TOLERANCE * spread / 2)


def fit(features: DataFrame, k: int, seed: int = 42, tolerance: float | None = None) -> tuple[DataFrame, DataFrame]:
    """k-means of points that carry a ``features`` vector: (points with cluster_id from
    1 to k, centres). Needs k different positions at least.

    Rounds end when centres move less than ``TOLERANCE`` of the spread of the coordinates.
    More than ``MANY_CENTRES`` are fitted by joins.
    """
    if k == 1:   # the mean of all points, which the model declines to fit
        centre = features.agg(F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude"))
        one = F.lit(1).cast("long").alias("cluster_id")
        return features.select("*", one), materialise(centre.select(one, "latitude", "longitude"))
    if tolerance is None:
        tolerance = scaled_tolerance(features)
    if k > MANY_CENTRES:
        labelled, centres = _fit_many(features.drop("features"), k, seed, tolerance)
        return with_features(labelled), centres
    model = KMeans(k=k, seed=seed, maxIter=MAX_ITER, tol=tolerance, featuresCol="features",
                   predictionCol="__label").fit(features)
    if len(model.clusterCenters()) < k:
        raise ValueError(f"fewer than {k} different positions")
    rows = [(i + 1, float(c[0]), float(c[1])) for i, c in enumerate(model.clusterCenters())]
    centres = features.sparkSession.createDataFrame(
        rows, "cluster_id long, latitude double, longitude double")
    labelled = model.transform(features).withColumn("cluster_id", (F.col("__label") + 1).cast("long"))
    return labelled.drop("__label"), centres


def _first_centres(points: DataFrame, k: int, seed: int) -> DataFrame:
    """k different positions (cluster_id from 1 to k, latitude, longitude) to start from.

    Half of them are random rows, the others are drawn by the squared distance to these, which
    is a round of k-means|| that draws without replacement.
    """
    position = ["latitude", "longitude"]
    places = store(points.groupBy(*position).agg(F.count("*").alias("copies")))
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *position), 11) + 0.5) / 2.0 ** 53
    # the lowest of exponential times with rates as the weights are a weighted draw
    drawn = F.log(-F.log(u))
    half = k // 2
    some = zip_with_index(places.select(*position, (drawn - F.log("copies")).alias("__drawn")),
                          "__drawn", *position, name="cluster_id").where(F.col("cluster_id") <= half)
    some = materialise(some.select("cluster_id", *position))
    far = nearest(places, some, ["cluster_id"], metric="planar").where("distance > 0").select(
        *position, (drawn - F.log("copies") - 2 * F.log("distance")).alias("__drawn"))
    others = zip_with_index(far, "__drawn", *position, name="cluster_id", start=half + 1).where(F.col("cluster_id") <= k)
    first = materialise(some.unionByName(others.select("cluster_id", *position)))
    forget(places)
    if first.count() < k:
        raise ValueError(f"fewer than {k} different positions")
    return first


def _filled(centres: DataFrame, labelled: DataFrame, empty: DataFrame) -> DataFrame:
    """Centres without points put on the positions that lie farthest from their own centre, one each."""
    position = ["latitude", "longitude"]
    places = labelled.where("distance > 0").groupBy(*position).agg(F.max("distance").alias("distance"))
    far = zip_with_index(places.withColumn("__near", -F.col("distance")), "__near", *position, name="__n")
    put = zip_with_index(empty, "cluster_id", name="__n").select("cluster_id", "__n").join(
        far.select("__n", F.col("latitude").alias("lat"), F.col("longitude").alias("lng")), "__n").drop("__n")
    return centres.join(put, "cluster_id", "left").select(
        "cluster_id", F.coalesce("lat", "latitude").alias("latitude"), F.coalesce("lng", "longitude").alias("longitude"))


def _fit_many(points: DataFrame, k: int, seed: int, tolerance: float) -> tuple[DataFrame, DataFrame]:
    """Like :func:`fit` for many centres, which neither the driver nor a task holds together:
    assignments are nearest joins. Centres that lose their points are moved to far ones."""
    columns = points.columns
    points = store(points)
    centres, settled, labelled = _first_centres(points, k, seed), False, None
    for done in range(MAX_ITER + 1):
        if labelled is not None:
            forget(labelled)
        labelled = store(nearest(points, centres, ["cluster_id"], metric="planar").select(*columns, "cluster_id", "distance"))
        means = labelled.groupBy("cluster_id").agg(F.avg("latitude").alias("lat"), F.avg("longitude").alias("lng"))
        moved = materialise(centres.join(means, "cluster_id", "left").select(
            "cluster_id", F.coalesce("lat", "latitude").alias("latitude"), F.coalesce("lng", "longitude").alias("longitude"),
            geo.planar(F.col("lat"), F.col("lng"), F.col("latitude"), F.col("longitude")).alias("shift")))
        farthest, held = moved.agg(F.max("shift"), F.count("shift")).first()
        if (settled and held == k) or done == MAX_ITER:
            break
        # once settled, only centres without points still move
        settled = settled or farthest <= tolerance
        centres = moved.drop("shift")
        if held < k:
            centres = materialise(_filled(centres, labelled, moved.where("shift IS NULL").select("cluster_id")))
    return labelled.drop("distance"), centres


def coverage(labelled: DataFrame, centres: DataFrame, max_distance: float) -> DataFrame:
    """Per centre: its points and the share of them within ``max_distance`` metres.

    Centres without points are listed with zero points and no share.
    """
    own = centres.select("cluster_id", F.col("latitude").alias("__lat"), F.col("longitude").alias("__lng"))
    near = geo.haversine(F.col("latitude"), F.col("longitude"), F.col("__lat"), F.col("__lng")) <= max_distance
    shares = labelled.join(broadcast_if(own, centres.count()), "cluster_id").groupBy("cluster_id").agg(
        F.count("*").alias("points"), F.avg(near.cast("double")).alias("share"))
    return centres.select("cluster_id").join(shares, "cluster_id", "left").select(
        "cluster_id", F.coalesce("points", F.lit(0)).alias("points"), "share")


def coverage_valid(shares: DataFrame, coverage_ratio: float) -> DataFrame:
    """One row: does every cluster have points, enough of them within reach?"""
    good = F.coalesce(F.col("share"), F.lit(0.0)) >= coverage_ratio
    return shares.agg(F.coalesce(F.bool_and((F.col("points") > 0) & good), F.lit(False)).alias("valid"))


def fewest_clusters(points: DataFrame, max_distance: float, coverage_ratio: float) -> int:
    """A number of clusters below which the coverage constraint cannot hold.

    Valid clusters keep a ``coverage_ratio`` of all points in discs around their centres. A
    disc as wide as n cells of a grid meets at most (n + 1)^2 of them, so the fullest
    (n + 1)^2 k cells bound what k clusters can reach. Coarse grids say most about scattered
    points, fine ones about dense areas; the best bound counts.
    """
    farthest, total = points.agg(F.max(F.abs(F.col("latitude"))), F.count("latitude")).first()
    if not total:
        return 1
    reach = math.degrees(max_distance / geo.EARTH_RADIUS_M)
    if farthest + reach > 85 or reach <= 0:
        return 1     # near the poles a disc spans too many meridians for this grid
    height = 2.02 * reach
    width = height / math.cos(math.radians(farthest + reach))
    n = F.col("n")
    grids = points.select("latitude", "longitude", F.explode(F.array(*[F.lit(i) for i in GRIDS])).alias("n"))
    sizes = grids.groupBy("n", F.floor(F.col("latitude") * n / height), F.floor(F.col("longitude") * n / width)).agg(
        F.count("*").alias("size"))
    # distinct sizes of disjoint cells number at most the root of twice the points
    steps = sizes.groupBy("n", "size").agg(F.count("*").alias("cells"))
    fuller = Window.partitionBy("n").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    steps = steps.select("n", "size", "cells",
                         F.coalesce(F.sum(F.col("size") * F.col("cells")).over(fuller), F.lit(0)).alias("held"),
                         F.coalesce(F.sum("cells").over(fuller), F.lit(0)).alias("used"))
    wanted = coverage_ratio * total * (1 - 1e-9)
    needed = F.col("used") + F.least("cells", F.ceil((wanted - F.col("held")) / F.col("size")))
    bounds = steps.where(F.col("held") < wanted).groupBy("n").agg(F.max(needed).alias("needed"))
    return max(1, bounds.agg(F.max(F.ceil(F.col("needed") / ((n + 1) * (n + 1))))).first()[0] or 1)


def with_coverage(points: DataFrame, first_k: int, max_k: int, max_distance: float,
                  coverage_ratio: float, seed: int = 42) -> tuple[int, DataFrame, DataFrame]:
    """The first k from ``first_k`` up whose k-means clusters all meet the constraint.

    Counts that no clustering could satisfy are passed over without a fit, which leaves
    the first valid one the same. Returns k, points with cluster_id, centres.
    """
    features = with_features(points).persist()
    try:
        tolerance = scaled_tolerance(features)
        for k in range(max(first_k, 1, fewest_clusters(points, max_distance, coverage_ratio)), max_k + 1):
            labelled, centres = fit(features, k, seed, tolerance)
            if coverage_valid(coverage(labelled, centres, max_distance), coverage_ratio).first()[0]:
                return k, materialise(labelled.drop("features")), centres
    finally:
        features.unpersist()
    raise RuntimeError(f"no number of clusters up to {max_k} meets the coverage constraint")
