"""Greedy nearest-first matching of buses to stops under capacity, in parallel rounds.

The wanted result is that of taking all (stop, bus) edges in order of distance, stop id,
bus id: an edge is used when its bus is free and its stop still has unserved students. It
is the one stable matching for that order, so it can be reached by proposals instead of
a sorted list of all edges:

* every free bus proposes to its nearest stop that would still have it;
* a stop keeps, in edge order, the proposals that come before its demand is met, and
  turns away the rest; the last one kept becomes its limit, beyond which it takes no bus.

A stop's kept list only ever gets nearer, so what it turned away it never wants back, and
a rejected bus can go straight to the nearest stop within whose limit it lies.

What shares a position moves together. Stops at one position with nothing between their ids
are one place: the proposals it gets fill its stops one after another in a single round. Free
buses at one position are one depot: it takes the list of its nearest places and fills them in
order with its buses within a round, since buses behind those that fill a place would be
turned away there. Only places with new proposals are ranked again. A stop with a very large
demand fills in one round, over as many partitions as its buses need.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kerbside.functions import geo
from kerbside.operators.nearest import build_index, search
from kerbside.operators.ordering import running_total, zip_with_index
from kerbside.session import store

CHAIN = 4096   # buses and places that a depot goes through in one round
_BUS = ["bus_id", "latitude", "longitude", "capacity"]


def stop_demand(assignments: DataFrame) -> DataFrame:
    """Students per stop."""
    return assignments.groupBy("stop_id").agg(F.count("*").alias("num_students"))


def places_of(stops: DataFrame) -> DataFrame:
    """Stops (stop_id, latitude, longitude, demand) by position: place (the lowest stop),
    position, stops in order, and the demand of all of them.

    Stops of another position may lie as far from a bus, and edges of equal distance go by stop
    id; so a place holds only stops whose ids follow each other among all stops.
    """
    numbered = zip_with_index(stops, "stop_id", name="__n")
    together = Window.partitionBy("latitude", "longitude").orderBy("__n")
    runs = numbered.withColumn("__run", F.col("__n") - F.row_number().over(together))
    return runs.groupBy("latitude", "longitude", "__run").agg(
        F.min("stop_id").alias("place"), F.sum("demand").alias("total"),
        F.array_sort(F.collect_list(F.struct("stop_id", "demand"))).alias("stops")).drop("__run")


def _filled(buses: str, rooms: str) -> Column:
    """Which buses fill which room: (room, first, behind), positions from 0.

    Buses go in order into a room until it is full (its last bus may hold more than is left), then
    into the next one. ``buses`` is an array of structs with capacity, ``rooms`` one of positive
    numbers.
    """
    return F.expr(f"""transform(array(aggregate(
        transform({buses}, (b, j) -> struct(b.capacity AS c, j AS j)),
        struct(0 AS i, element_at({rooms}, 1) AS open, array(0) AS starts, size({buses}) AS behind),
        (s, b) -> CASE
            WHEN s.open > 0 THEN struct(s.i AS i, s.open - b.c AS open, s.starts AS starts, s.behind AS behind)
            WHEN s.i + 1 < size({rooms}) THEN struct(
                s.i + 1 AS i, get({rooms}, s.i + 1) - b.c AS open, concat(s.starts, array(b.j)) AS starts, s.behind AS behind)
            ELSE struct(s.i AS i, s.open AS open, s.starts AS starts, least(s.behind, b.j) AS behind) END)),
        s -> transform(s.starts, (first, i) -> struct(
            i AS room, first AS first, coalesce(get(s.starts, i + 1), s.behind) AS behind)))[0]""")


def _ranked(pool: DataFrame, places: DataFrame, largest: int) -> DataFrame:
    """Proposals (bus, place, distance) with the stop they get, or null, the students they
    serve, and whether they meet what was left of the place's demand."""
    ranked = running_total(pool, "place", ["distance", "bus_id"], "capacity", "before").join(
        places.select("place", "stops", "total"), "place")
    single = F.size("stops") == 1
    taken = single & (F.col("before") < F.col("total"))
    ones = ranked.where(single).select(
        *_BUS, "place", "distance", F.when(taken, F.col("stops")[0]["stop_id"]).alias("stop_id"),
        F.when(taken, F.least("capacity", F.col("total") - F.col("before"))).alias("num_students"),
        (taken & (F.col("before") + F.col("capacity") >= F.col("total"))).alias("closes"))
    # the last bus of each stop may bring up to the largest capacity too much
    several = ranked.where(~single).withColumn(
        "possible", F.col("before") < F.col("total") + F.size("stops") * largest)
    bus = F.struct("distance", *_BUS)
    lists = several.where("possible").groupBy("place").agg(
        F.array_sort(F.collect_list(bus)).alias("buses"), F.first("stops").alias("stops"))
    rooms = lists.withColumn("part", F.explode(_filled("buses", "transform(stops, x -> x.demand)"))).select(
        "place", F.expr("stops[part.room]").alias("stop"), (F.col("part.room") + 1 == F.size("stops")).alias("last"),
        F.expr("slice(buses, part.first + 1, part.behind - part.first)").alias("buses"))
    rooms = rooms.withColumn("held", F.expr("aggregate(buses, 0L, (s, b) -> s + b.capacity)"))
    kept = rooms.select("place", "stop", "last", "held", F.size("buses").alias("n"), F.posexplode("buses").alias("j", "bus"))
    ends = (F.col("j") + 1 == F.col("n")) & (F.col("held") >= F.col("stop.demand"))
    kept = kept.select(
        *[F.col(f"bus.{c}") for c in _BUS], "place", "bus.distance", F.col("stop.stop_id").alias("stop_id"),
        (F.col("bus.capacity") - F.when(ends, F.col("held") - F.col("stop.demand")).otherwise(0)).alias("num_students"),
        (ends & F.col("last")).alias("closes"))
    away = several.join(kept.select("bus_id"), "bus_id", "left_anti").select(
        *_BUS, "place", "distance", F.lit(None).cast("bigint").alias("stop_id"),
        F.lit(None).cast("bigint").alias("num_students"), F.lit(False).alias("closes"))
    return ones.unionByName(kept).unionByName(away)


def _depot_proposals(depots: DataFrame, found: DataFrame, places: DataFrame, kept: DataFrame) -> DataFrame:
    """(bus, place, distance) of depots that go through their lists of places.

    A place that keeps no bus from farther away has the room that is left; one that does may
    have all of its room, which is the most the depot can get.
    """
    listed = found.select("depot", F.inline("found")).select("depot", "distance", "place")
    served = kept.groupBy("stop_id").agg(F.sum("num_students").alias("served"))
    farthest = kept.groupBy("place").agg(F.max("distance").alias("farthest"))
    stops = places.select("place", F.inline("stops")).join(served, "stop_id", "left").withColumn(
        "left", F.col("demand") - F.coalesce("served", F.lit(0)))
    rooms = listed.join(stops, "place").join(farthest, "place", "left").withColumn(
        "room", F.when(F.col("farthest") >= F.col("distance"), F.col("demand")).otherwise(F.col("left")))
    rooms = rooms.where("room > 0").groupBy("depot").agg(
        F.array_sort(F.collect_list(F.struct("distance", "stop_id", "place", "room"))).alias("rooms"))
    parts = depots.join(rooms, "depot").select(
        "latitude", "longitude", "buses", "rooms", F.explode(_filled("buses", "transform(rooms, x -> x.room)")).alias("part"))
    return parts.select(
        F.inline(F.expr("slice(buses, part.first + 1, part.behind - part.first)")), "latitude", "longitude",
        F.expr("rooms[part.room].place AS place"), F.expr("rooms[part.room].distance AS distance")).select(
        *_BUS, "place", "distance")


def match_buses(stops: DataFrame, buses: DataFrame, assignments: DataFrame) -> DataFrame:
    """(bus_id, stop_id, distance, num_students), one row per bus that is used.

    A stop may get several buses; demand that is left when buses run out stays unserved.
    """
    demand = stop_demand(assignments).withColumnRenamed("num_students", "demand")
    places = store(places_of(stops.select("stop_id", "latitude", "longitude").join(demand, "stop_id")))
    fleet = store(buses.where("latitude IS NOT NULL AND longitude IS NOT NULL").select(
        "bus_id", "latitude", "longitude", F.col("capacity").cast("long").alias("capacity")))
    largest = fleet.agg(F.max("capacity")).first()[0] or 0
    # places of one position differ in what they still accept, so they are not merged
    index = build_index(places.select("latitude", "longitude", "place"), ["place"],
                        searched_by=[fleet], merge_copies=False, stored=True)

    def accepts(place, distance):
        return (distance < place["limit"]) | (
            (distance == place["limit"]) & (F.col("bus_id") < place["limit_bus"]))

    def proposals(free: DataFrame, kept: DataFrame, limits: DataFrame) -> DataFrame:
        position = ["latitude", "longitude"]
        sizes = store(free.groupBy(*position).agg(F.count("*").alias("n")).where("n > 1"))
        if sizes.isEmpty():
            found = search(free, index, reach=limits, accepts=accepts, stored=True)
            return store(found.select(*_BUS, "place", "distance"))
        alone = free.join(sizes, position, "left_anti").select(*_BUS)
        one = search(alone, index, reach=limits, accepts=accepts).select(*_BUS, "place", "distance")
        nth = F.row_number().over(Window.partitionBy(*position).orderBy("bus_id"))
        first = free.join(sizes, position).withColumn("nth", nth).where(F.col("nth") <= CHAIN)
        depots = store(first.groupBy(*position).agg(
            F.min("bus_id").alias("depot"), F.array_sort(F.collect_list(F.struct("bus_id", "capacity"))).alias("buses")))
        asked = depots.select("depot", F.col("depot").alias("bus_id"), *position, F.size("buses").alias("k"))
        found = store(search(asked, index, reach=limits, accepts=accepts, wanted="k").select("depot", "found"))
        return store(one.unionByName(_depot_proposals(depots, found, places, kept)))

    kept = store(fleet.where(F.lit(False)).select(
        *_BUS, F.lit(0).cast("bigint").alias("place"), F.lit(0.0).alias("distance"),
        F.lit(0).cast("bigint").alias("stop_id"), F.lit(0).cast("bigint").alias("num_students"), F.lit(False).alias("closes")))
    free = fleet
    while True:
        # the bus that meets the demand is the last one kept: its edge is the limit
        met = kept.where("closes").select("place", F.col("distance").alias("limit"), F.col("bus_id").alias("limit_bus"))
        # a little wider than the limit itself, which is tested exactly in the end
        straight = geo.chord(F.col("limit")) * (1 + 1e-9) + 1e-12
        limits = store(places.select("place").join(met, "place", "left").select(
            "place", F.coalesce(straight * straight, F.lit(math.inf)).alias("reach2"),
            F.coalesce("limit", F.lit(math.inf)).alias("limit"),
            F.coalesce("limit_bus", F.lit(0).cast("long")).alias("limit_bus")))
        new = proposals(free, kept, limits)
        if new.isEmpty():
            break
        changed = new.select("place").distinct()
        pool = kept.join(changed, "place", "left_semi").select(*_BUS, "place", "distance").unionByName(new)
        ranked = store(_ranked(pool, places, largest))
        kept = store(kept.join(changed, "place", "left_anti").unionByName(ranked.where("stop_id IS NOT NULL")))
        # what was turned away goes on, as do buses of a depot that had no turn yet; others that
        # no place would have now are not wanted later either
        waiting = free.join(new.select("bus_id"), "bus_id", "left_anti").join(
            new.select("latitude", "longitude").distinct(), ["latitude", "longitude"], "left_semi")
        free = store(ranked.where("stop_id IS NULL").select(*_BUS).unionByName(waiting.select(*_BUS)))
        if free.isEmpty():
            break
    return kept.select("bus_id", "stop_id", "distance", "num_students")
