"""Which points lie inside which boundary, by ray casting.

A boundary is a ring of vertices. Its edges are listed in the bands of latitude they cross, so a
point meets the edges of its own band alone; a ray from the point to the east crosses the
boundary an odd number of times if the point is inside. A vertex belongs to the edge above it,
so a ray through it counts once, or twice or not at all where the ring only touches the ray.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kerbside.session import broadcast_if, store

BANDS = 1024   # of latitude, over all boundaries


def edges_of(rings: DataFrame, key: str) -> DataFrame:
    """Edges (key, y1, x1, y2, x2) of rings given as vertices (key, order, latitude, longitude);
    the last vertex is joined to the first."""
    around = Window.partitionBy(key).orderBy("order")
    first = Window.partitionBy(key).orderBy("order").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def following(column: str):
        return F.coalesce(F.lead(column).over(around), F.first(column).over(first))

    return rings.select(key, F.col("latitude").alias("y1"), F.col("longitude").alias("x1"),
                        following("latitude").alias("y2"), following("longitude").alias("x2"))


def inside(points: DataFrame, rings: DataFrame, key: str, id_column: str) -> DataFrame:
    """(id, key): the boundaries that each point lies in, none for points outside of all.

    Points on a lower or left edge count as inside, on an upper or right one as outside. Points
    without coordinates lie nowhere; rings of fewer than three vertices hold nothing.
    """
    edges = store(edges_of(rings, key).where("y1 <> y2"))
    low, high, rows = edges.agg(F.min(F.least("y1", "y2")), F.max(F.greatest("y1", "y2")), F.count("*")).first()
    if not rows:
        return points.select(id_column).join(rings.select(key), F.lit(False))
    height = (high - low) / BANDS

    def band(y: str):
        return F.least(F.floor((F.col(y) - low) / height), F.lit(BANDS - 1))

    banded = edges.withColumn("down", band("y1")).withColumn("up", band("y2")).withColumn(
        "band", F.explode(F.sequence(F.least("down", "up"), F.greatest("down", "up")))).drop("down", "up")
    asked = points.where(F.col("latitude").between(low, high)).select(
        id_column, "latitude", "longitude", band("latitude").alias("band"))
    met = asked.join(broadcast_if(banded, rows * BANDS), "band")
    crosses = met.where(
        ((F.col("y1") <= F.col("latitude")) != (F.col("y2") <= F.col("latitude")))
        & (F.col("longitude") < (F.col("x2") - F.col("x1")) * ((F.col("latitude") - F.col("y1")) / (F.col("y2") - F.col("y1"))) + F.col("x1")))
    return crosses.groupBy(id_column, key).agg(F.count("*").alias("n")).where("n % 2 = 1").select(id_column, key)
