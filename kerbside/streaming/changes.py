"""Student moves as a stream: location history and the stop each student now uses.

Every micro-batch commits the moves to the history and the new stop of each moved student to
the assignments, both as batches of the stream's own log (see ``sources/tables.py``), so that a
batch that runs again changes nothing and a stream with a new checkpoint adds to what others
left. Readers of the two tables, the matching job among them, see committed moves at once; a
new plan is a new version of the assignments, and moves from before it do not undo it.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kerbside.functions.scalars import utc_from_millis
from kerbside.operators.nearest import Finder, nearest
from kerbside.session import materialise
from kerbside.sources.tables import Tables

TOPIC = "pgserver.public.students"   # fixed value: the change topic of the student table
GROUP = "pipeline-uc02-group"        # fixed value: the consumer group that reads it

ENVELOPE = """payload struct<
    op: string, source: struct<ts_ms: bigint>,
    after: struct<student_id: bigint, latitude: double, longitude: double, name: string, address: string>>"""


def topic_messages(spark: SparkSession, servers: str, topic: str = TOPIC, group: str = GROUP) -> DataFrame:
    """The change topic from its newest message on; restarts go on from the checkpoint."""
    raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
           .option("subscribe", topic).option("kafka.group.id", group)
           .option("startingOffsets", "latest").load())
    return raw.select(F.col("value").cast("string").alias("value"), "offset")


def decode(messages: DataFrame) -> DataFrame:
    """Moves out of change envelopes (``value``, ``offset``): one row per event that
    leaves a student behind. Deletes, tombstones and unreadable text give none."""
    payload = F.from_json("value", ENVELOPE)["payload"]
    rows = messages.select(payload.alias("payload"), "offset").where("payload.after IS NOT NULL")
    return rows.select(
        "payload.after.student_id", "payload.after.latitude", "payload.after.longitude",
        utc_from_millis(F.col("payload.source.ts_ms")).alias("timestamp"), "offset")


def last_moves(moves: DataFrame) -> DataFrame:
    """The last move of each student, by event time and then offset.

    Offsets grow within a topic partition, and all changes of a student are in one.
    """
    order = F.struct("timestamp", "offset", "latitude", "longitude")
    last = moves.groupBy("student_id").agg(F.max(order).alias("last"))
    return last.select("student_id", "last.*")


def nearest_stops(moves: DataFrame, stops: DataFrame) -> DataFrame:
    """(student_id, stop_id, distance, timestamp, offset) of the last move of each student."""
    return nearest(last_moves(moves), stops, ["stop_id"]).select(
        "student_id", "stop_id", "distance", "timestamp", "offset")


class StopSearch:
    """Nearest stops of moves, batch after batch: stops are read and indexed anew only when
    their table has a new version, or moves lead out of the indexed region."""

    def __init__(self, tables: Tables) -> None:
        self.tables = tables
        self.version: int | None = None
        self.finder: Finder | None = None

    def __call__(self, moves: DataFrame) -> DataFrame:
        version = self.tables.version("bus_stops")
        if version != self.version:
            self.finder, self.version = Finder(self.tables.read("bus_stops"), ["stop_id"]), version
        return self.finder.nearest(last_moves(moves)).select(
            "student_id", "stop_id", "distance", "timestamp", "offset")


def apply_batch(tables: Tables, messages: DataFrame, batch_id: int, stream: str = "0", fold_every: int = 0,
                search: StopSearch | None = None) -> None:
    """One micro-batch of the stream named.

    With ``fold_every`` the changes are folded into the tables every so many batches.
    """
    moves = materialise(decode(messages))
    tables.commit("student_locations", stream, batch_id, moves)
    # without stops this writes no rows and no student changes stop
    assigned = (search or StopSearch(tables))(moves)
    tables.commit("assignments", stream, batch_id, assigned.withColumnsRenamed(
        {"timestamp": "changed_at", "offset": "changed_offset"}))
    if fold_every and (batch_id + 1) % fold_every == 0:
        for name in ("student_locations", "assignments"):
            tables.fold(name)


def start(messages: DataFrame, tables: Tables, checkpoint: str, fold_every: int = 0,
          **trigger) -> StreamingQuery:
    """Run the pipeline on a streaming DataFrame of ``value`` and ``offset``.

    The stream's name in the logs is the id of the query, which its checkpoint keeps.
    """
    named = threading.Event()
    name: list[str] = []
    search = StopSearch(tables)

    def batch(df: DataFrame, batch_id: int) -> None:
        named.wait()
        apply_batch(tables, df, batch_id, name[0], fold_every, search)

    query = (messages.writeStream.foreachBatch(batch)
             .option("checkpointLocation", checkpoint).trigger(**trigger).start())
    name.append(query.id)
    named.set()
    return query


def location_history(tables: Tables) -> DataFrame:
    return tables.read("student_locations")


def current_assignments(tables: Tables) -> DataFrame:
    """The planned assignments with every later move applied, the last one winning."""
    return tables.read("assignments")
