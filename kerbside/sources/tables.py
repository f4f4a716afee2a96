"""Planning tables as parquet folders, with a log of the changes that streams commit to them.

A table is ``<root>/<name>/v=<n>``. Overwriting writes the next version and readers take
the newest one that is complete, so a job can replace a table it reads from.

A stream commits a batch of changes as ``<root>/<name>.log/stream=<id>/batch=<n>``, once: a
batch that runs again after a failure is already there, and a stream with another checkpoint
has another id, so its batch numbers, which begin again, replace nothing. Each version has
marks, the last batch of every stream that it accounts for; reading lays the later batches
over the version, the newest change of a key by event time and offset winning, whatever stream
and batch it came by. Folding writes the result as the next version, changes keeping their
event time, so that a late and older one does not undo them.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kerbside.schemas import CHANGE_ORDER, KEYS, LOGGED, TABLES, conform
from kerbside.session import broadcast_if


class RepeatedKey(ValueError):
    """A table that is keyed by a column would hold a value twice, or none."""


class Tables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # --- versions -----------------------------------------------------------------------

    def _glob(self, pattern: str) -> list[str]:
        """Folders that hold a complete result, by the pattern of their marker file."""
        jvm = self.spark._jvm
        fs = jvm.org.apache.hadoop.fs.Path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())
        done = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{self.root}/{pattern}/_SUCCESS"))
        return [s.getPath().getParent().toString() for s in done or []]

    def _delete(self, path: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def _versions(self, name: str) -> list[int]:
        return sorted(int(path.rsplit("=", 1)[1]) for path in self._glob(f"{name}/v=*"))

    def _path(self, name: str, version: int) -> str:
        return f"{self.root}/{name}/v={version}"

    def version(self, name: str) -> int:
        """Number of the current version; -1 before the first."""
        return (self._versions(name) or [-1])[-1]

    def _base(self, name: str, version: int) -> DataFrame:
        schema = _stored(name)
        if version < 0:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self._path(name, version))

    def read(self, name: str) -> DataFrame:
        """The current state of a table, as it is now: its version and later changes."""
        version = self.version(name)
        rows = self._base(name, version)
        if name in LOGGED:
            rows = self._laid_over(name, rows, self._open(name, version))
        return rows.select(*TABLES[name].fieldNames())

    def create(self) -> None:
        """Every table, empty."""
        for name, schema in TABLES.items():
            self.overwrite(name, self.spark.createDataFrame([], schema))

    def append(self, name: str, df: DataFrame) -> None:
        """Add rows to the current version; keys must be new."""
        version = max(self.version(name), 0)
        rows = _with_order(name, df)
        key = KEYS.get(name)
        if key:
            there = self.read(name).select(key) if self.version(name) >= 0 else None
            _refuse_repeated(name, rows.select(key) if there is None else rows.select(key).unionAll(there))
        rows.write.mode("append").parquet(self._path(name, version))

    def overwrite(self, name: str, df: DataFrame) -> None:
        """The next version: ``df`` in place of what was read before, changes so far included."""
        marks = self._marks_of(self._committed(name)) if name in LOGGED else {}
        self._write_version(name, _with_order(name, df), marks)

    def _write_version(self, name: str, rows: DataFrame, marks: dict[str, int]) -> None:
        if name in KEYS:
            _refuse_repeated(name, rows.select(KEYS[name]))
        version = self.version(name) + 1
        if name in LOGGED:
            self._write_marks(name, version, marks)   # a version is complete only after its marks
        rows.write.mode("overwrite").parquet(self._path(name, version))

    def prune(self, name: str, keep: int = 2) -> None:
        """Delete all but the newest ``keep`` versions, and batches that the oldest of these holds."""
        versions = self._versions(name)
        for version in versions[:-keep]:
            self._delete(self._path(name, version))
        if name in LOGGED and versions:
            marks = self._read_marks(name, versions[-keep:][0])
            for stream, batch, path in self._committed(name):
                if batch <= marks.get(stream, -1):
                    self._delete(path)

    # --- changes ------------------------------------------------------------------------

    def commit(self, name: str, stream: str, batch: int, df: DataFrame) -> bool:
        """Add one batch of a stream to the log; False when it has been there before."""
        path = f"{self.root}/{name}.log/stream={stream}/batch={batch}"
        marked = self._read_marks(name, self.version(name)).get(stream, -1)
        if batch <= marked or self._glob(f"{name}.log/stream={stream}/batch={batch}"):
            return False
        df.select(*[F.col(f.name).cast(f.dataType) for f in _stored(name).fields]).write.mode("overwrite").parquet(path)
        return True

    def fold(self, name: str) -> None:
        """Write the current state as the next version, which accounts for all batches so far.

        Batches that are committed meanwhile stay in the log. It costs the table, so it is for
        now and then; one job at a time may write versions of a table.
        """
        version = self.version(name)
        opened = self._open(name, version)
        marks = self._read_marks(name, version)
        for stream, batch, _ in opened:
            marks[stream] = max(batch, marks.get(stream, -1))
        self._write_version(name, self._laid_over(name, self._base(name, version), opened), marks)

    def _committed(self, name: str) -> list[tuple[str, int, str]]:
        """(stream, batch, folder) of the batches that are complete and not yet deleted."""
        found = []
        for path in self._glob(f"{name}.log/stream=*/batch=*"):
            stream, batch = path.rsplit("/", 2)[1:]
            found.append((stream.removeprefix("stream="), int(batch.removeprefix("batch=")), path))
        return found

    @staticmethod
    def _marks_of(batches: list[tuple[str, int, str]]) -> dict[str, int]:
        marks: dict[str, int] = {}
        for stream, batch, _ in batches:
            marks[stream] = max(batch, marks.get(stream, -1))
        return marks

    def _open(self, name: str, version: int) -> list[tuple[str, int, str]]:
        """Batches that the version does not account for. A stream commits its batches in order,
        so the last one says all."""
        marks = self._read_marks(name, version)
        return [b for b in self._committed(name) if b[1] > marks.get(b[0], -1)]

    def _marks_path(self, name: str, version: int) -> str:
        return f"{self.root}/{name}.marks/{version}.json"

    def _write_marks(self, name: str, version: int, marks: dict[str, int]) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self._marks_path(name, version))
        out = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(path, True)
        try:
            out.write(bytearray(json.dumps(marks).encode()))
        finally:
            out.close()

    def _read_marks(self, name: str, version: int) -> dict[str, int]:
        if version < 0:
            return {}
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self._marks_path(name, version))
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return {}
        return json.loads(self.spark.read.text(self._marks_path(name, version)).first()[0])

    def _laid_over(self, name: str, base: DataFrame, batches: list[tuple[str, int, str]]) -> DataFrame:
        if not batches:
            return base
        schema = _stored(name)
        rows = self.spark.read.schema(schema).parquet(*[path for _, _, path in batches])
        key = LOGGED[name]
        if key is None:
            return base.unionByName(rows)
        order = F.struct(*CHANGE_ORDER.fieldNames(), *[c for c in TABLES[name].fieldNames() if c != key])
        moved = rows.groupBy(key).agg(F.max(order).alias("new"))
        size = moved.count()
        moved = broadcast_if(moved, size)
        # rows of the version that are newer than the change stay; few rows have an event time
        newer = base.where(f"{CHANGE_ORDER.fieldNames()[0]} IS NOT NULL").join(moved, key).where(order > F.col("new"))
        winners = moved.join(broadcast_if(newer.select(key), size), key, "left_anti")
        kept = base.join(broadcast_if(winners.select(key), size), key, "left_anti")
        return kept.unionByName(winners.select(key, "new.*"))


def _stored(name: str) -> StructType:
    """The columns of the files: keyed changes, and what they are folded into, have an order."""
    schema = StructType(list(TABLES[name].fields))
    return StructType(schema.fields + CHANGE_ORDER.fields) if LOGGED.get(name) else schema


def _with_order(name: str, df: DataFrame) -> DataFrame:
    """Planned rows: older than every change."""
    rows = conform(name, df)
    if not LOGGED.get(name):
        return rows
    return rows.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in CHANGE_ORDER.fields])


def _refuse_repeated(name: str, keys: DataFrame) -> None:
    key = keys.columns[0]
    bad = keys.groupBy(key).count().where(f"count > 1 OR {key} IS NULL").first()
    if bad:
        raise RepeatedKey(f"{name}: {key} {bad[key]} is listed {bad['count']} times")
