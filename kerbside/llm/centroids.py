"""k-means over integer vectors with ns-bounds, exact in every round.

A vector keeps, for each centroid, its distance when it was last computed and the round of that.
The positions of all centroids in all rounds are kept too, k vectors a round, so a stored
distance is loosened by the norm of the centroid's total displacement since then, which is at
most, and mostly less than, the sum of its drifts round by round. Where the loosened distance to
the own centroid stays below all others, the vector stays without a computation; else its own
distance is computed, and then those of the centroids that may still be as near. Distances that
decide are integers, so ties go to the smaller number as if all had been computed.

The state of the vectors is a table in the checkpoint folder, one for each round; a round reads
the last one, and the last but one is deleted. Centroids move by sums of the vectors that changed
their cluster, which are added up in the tasks and by the cluster.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.session import broadcast_if, forget, store

CLUSTERS, ROUNDS = 8, 10
LENGTH, SCALE = 64, 1024
SEED = 3
LARGEST = 1 << 27    # of a component; squared distances of 64 such components fit 64 bits
SLACK = 1e-6         # relative error allowed for in stored distances, which are single floats

_STATE = "x array<int>, previous int, cluster int, far array<float>, at array<int>, distance long, scans long"


def integers(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
             length: int = LENGTH, scale: int = SCALE) -> DataFrame:
    """(id, x): the vectors with exactly ``length`` components, none null or non-finite, as
    integers floor(scale * x) of doubles."""
    v = F.col(f"`{vector_column}`").cast("array<double>")
    whole = (F.size(v) == length) & F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    limit = F.lit(float(LARGEST))
    scaled = F.transform(v, lambda x: F.when(F.abs(x) * scale < limit, F.floor(x * scale)).otherwise(
        F.raise_error(F.lit(f"a component of a vector exceeds {LARGEST // scale}"))).cast("int"))
    return vectors.where(whole).select(F.col(f"`{id_column}`").alias("__id"), scaled.alias("x"))


def first_centroids(whole: DataFrame, k: int = CLUSTERS, seed: int = SEED) -> list[list[int]]:
    """The k vectors of smallest SHA-256 of ``seed:id``, null ids last; k rows reach the driver."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("__id").cast("string")), 256)
    rows = whole.select(order.alias("h"), "x").orderBy(F.asc_nulls_last("h"), "x").limit(k)
    return [list(r["x"]) for r in rows.collect()]


def _squares(x, c):
    """Exact squared distances of integer rows, in 64 bits."""
    d = x.astype("int64") - c
    return (d * d).sum(1)


def _reassigned(x, cluster, far, at, history, now: int):
    """New cluster, distances, their rounds and the number of distances computed."""
    import numpy as np

    current = history[now]
    n, k = len(x), len(current)
    rows = np.arange(n)
    if not len(cluster):   # nothing is known yet: all distances
        exact = np.stack([_squares(x, c) for c in current], 1)
        return (exact.argmin(1), np.sqrt(exact).astype("f4"), np.full((n, k), now), np.full(n, k))
    # displacement of every centroid since every round: the norm of the total way
    gone = np.sqrt(((history[:now + 1] - current) ** 2).sum(2).astype("f8"))
    slip = gone[at, np.arange(k)] * (1 + SLACK)
    lower = far.astype("f8") * (1 - SLACK) - slip
    upper = far[rows, cluster].astype("f8") * (1 + SLACK) + slip[rows, cluster]
    lower[rows, cluster] = np.inf
    scans = np.zeros(n, "int64")
    failed = np.flatnonzero(lower.min(1) <= upper)
    if not len(failed):
        return cluster, far, at, scans
    own = cluster[failed]
    best = _squares(x[failed], current[own])
    far[failed, own], at[failed, own] = np.sqrt(best), now
    scans[failed] += 1
    near = lower[failed] <= (np.sqrt(best) * (1 + SLACK))[:, None]
    chosen = own.copy()
    for j in range(k):
        open_rows = np.flatnonzero(near[:, j])
        if not len(open_rows):
            continue
        at_rows = failed[open_rows]
        d = _squares(x[at_rows], current[j])
        far[at_rows, j], at[at_rows, j] = np.sqrt(d), now
        scans[at_rows] += 1
        better = (d < best[open_rows]) | ((d == best[open_rows]) & (j < chosen[open_rows]))
        best[open_rows[better]], chosen[open_rows[better]] = d[better], j
    cluster = cluster.copy()
    cluster[failed] = chosen
    return cluster, far, at, scans


def _matrix(column, width: int):
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _round(state: DataFrame, history, now: int, last: bool) -> DataFrame:
    """The state after assigning every vector to the centroids of round ``now``."""
    k, width = len(history[now]), len(history[now][0])

    def assigned(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def lists(values, kind):
            ends = np.arange(0, values.size + 1, values.shape[1], dtype="i4")
            return pa.ListArray.from_arrays(ends, pa.array(values.reshape(-1), kind))

        past = np.array(history, "int64")
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch["x"], width)
            known = "cluster" in batch.schema.names
            cluster = batch["cluster"].to_numpy() if known else np.zeros(0, "i4")
            far = _matrix(batch["far"], k).copy() if known else None
            at = _matrix(batch["at"], k).copy() if known else None
            before = cluster
            cluster, far, at, scans = _reassigned(x, cluster, far, at, past, now)
            if known:
                scans = scans + batch["scans"].to_numpy()
            distance = pa.array(_squares(x, past[now][cluster]), pa.int64()) if last else pa.nulls(len(x), pa.int64())
            yield pa.RecordBatch.from_arrays([
                batch["__id"], batch["x"],
                pa.array(before, pa.int32()) if known else pa.nulls(len(x), pa.int32()), pa.array(cluster, pa.int32()),
                lists(far.astype("f4"), pa.float32()), lists(at.astype("i4"), pa.int32()), distance,
                pa.array(scans, pa.int64())],
                ["__id", "x", "previous", "cluster", "far", "at", "distance", "scans"])

    kind = state.schema["__id"].dataType.simpleString()
    columns = [c for c in ("__id", "x", "cluster", "far", "at", "scans") if c in state.columns]
    return state.select(*columns).mapInArrow(assigned, f"__id {kind}, {_STATE}")


def _changes(state: DataFrame, k: int, width: int) -> list[tuple[int, int, list[int]]]:
    """What the vectors that moved add to each cluster: (cluster, vectors, sums)."""
    def summed(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        sums, counts = np.zeros((k, width), "int64"), np.zeros(k, "int64")
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch["x"], width).astype("int64")
            new = batch["cluster"].to_numpy()
            old = batch["previous"].fill_null(-1).to_numpy()
            for j in range(k):
                sums[j] += x[new == j].sum(0) - x[old == j].sum(0)
                counts[j] += (new == j).sum() - (old == j).sum()
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(k), pa.int32()), pa.array(counts), pa.array(sums.tolist(), pa.list_(pa.int64()))],
            ["cluster", "n", "sums"])

    moved = state.where("NOT previous <=> cluster").select("x", "previous", "cluster")
    parts = moved.mapInArrow(summed, "cluster int, n long, sums array<bigint>")
    added = parts.select("cluster", F.posexplode(F.concat(F.array("n"), "sums")).alias("pos", "value")).groupBy(
        "cluster", "pos").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    # one row of width + 1 sums for each cluster
    rows = added.groupBy("cluster").agg(F.sort_array(F.collect_list(F.struct("pos", "value"))).alias("sums")).collect()
    return [(r["cluster"], int(r["sums"][0]["value"]), [int(s["value"]) for s in r["sums"][1:]]) for r in rows]


def clusters(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, length: int = LENGTH,
             scale: int = SCALE, id_column: str = "vec_id", vector_column: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """(id, cluster, distance, scans) of every vector kept, and (cluster, centroid, n, inertia).

    Kept are vectors of ``length`` components, none null or non-finite; other rows are left
    out. ``distance`` is the squared distance to the own centroid, ``scans`` counts the distances
    that were computed for the vector. Repeated rows and ids are vectors of their own; null ids
    come last among the first centroids. With fewer vectors than ``k`` there are as many
    clusters as vectors; of equal first centroids the smaller number gets all, the others stay
    where they are with no vectors. Components beyond ``LARGEST`` / scale raise an error, as
    distances would not fit. An empty table gives empty ones. Other columns are not read.
    """
    spark = vectors.sparkSession
    whole = store(integers(vectors, id_column, vector_column, length, scale))
    start = first_centroids(whole, k, seed)
    found = "cluster int, centroid array<bigint>, n long, inertia long"
    if not start:
        none = whole.selectExpr("__id", "0 AS cluster", "0L AS distance", "0L AS scans")
        return none.withColumnRenamed("__id", id_column), spark.createDataFrame([], found)
    k, history = len(start), [start]
    sums, counts = [[0] * length for _ in range(k)], [0] * k
    state = whole
    for now in range(rounds + 1):
        before, state = state, store(_round(state, history, now, last=now == rounds))
        forget(before)
        if now == rounds:
            break
        for cluster, n, added in _changes(state, k, length):
            counts[cluster] += n
            sums[cluster] = [a + b for a, b in zip(sums[cluster], added)]
        history.append([[s // counts[j] for s in sums[j]] if counts[j] else history[-1][j] for j in range(k)])
    per_cluster = {r["cluster"]: r for r in state.groupBy("cluster").agg(
        F.count("*").alias("n"), F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()}
    centroids = [(j, c, per_cluster[j]["n"] if j in per_cluster else 0,
                  int(per_cluster[j]["inertia"]) if j in per_cluster else 0) for j, c in enumerate(history[-1])]
    return (state.select(F.col("__id").alias(id_column), "cluster", "distance", "scans"),
            spark.createDataFrame(centroids, found))


def summary(vectors: DataFrame, **parameters) -> DataFrame:
    """``clusters`` with each vector's cluster inertia, the whole inertia and the SHA-256 of its
    centroid's components, written as decimal integers between commas."""
    labelled, centroids = clusters(vectors, **parameters)
    total = centroids.agg(F.coalesce(F.sum("inertia"), F.lit(0)).cast("long")).first()[0]
    named = centroids.select("cluster", F.col("inertia").alias("cluster_inertia"), F.lit(total).alias("inertia"),
                             F.sha2(F.concat_ws(",", F.col("centroid").cast("array<string>")), 256).alias("centroid_sha256"))
    return labelled.join(broadcast_if(named, parameters.get("k", CLUSTERS)), "cluster")
