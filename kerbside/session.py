"""Session settings and the one way this package cuts lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Rows below which a table of narrow rows (a few numbers each) may be hinted as
# broadcast. The callers compare it with a row count they have measured.
BROADCAST_ROWS = 200_000


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Settings every job here assumes; cluster sizing stays with the submitter."""
    return (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared folder; make one only for local runs without it."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        sc.setCheckpointDir(shared)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="kerbside-checkpoint-"))
    else:
        raise RuntimeError(
            "spark.checkpoint.dir is not set: iterative jobs need a folder that every "
            "executor can reach"
        )


def materialise(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the checkpoint folder and return it without lineage.

    Reliable storage, so a lost executor costs a read and not a recomputation, and
    the result cannot change between two readers of it.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store(df: DataFrame) -> DataFrame:
    """Like :func:`materialise`, as a parquet table in the checkpoint folder.

    Compressed and read by column, which suits large intermediates; the order of rows within
    the table is not kept. The folder stays until :func:`forget` or the owner of the
    checkpoint folder deletes it.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


def forget(*tables: DataFrame) -> None:
    """Delete tables that :func:`store` returned, once nothing reads them any more."""
    for table in tables:
        jvm = table.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def broadcast_if(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast when the measured row count allows it, else leave it to AQE."""
    return df.hint("broadcast") if rows <= limit else df


def broadcast_or_merge(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Like :func:`broadcast_if` with ``rows`` as a bound, but never broadcasts a larger table.

    AQE judges by bytes in files and shuffles, of which stored cells and row numbers take few:
    as a broadcast they are many times as large.
    """
    return df.hint("broadcast" if rows <= limit else "merge")


def spread(df: DataFrame, rows: int | None = None, limit: int = 2_000_000) -> DataFrame:
    """Deal rows out to all cores where each row stands for much work.

    Sizes in bytes, by which scans and AQE choose partitions, say little there. A table
    of more than ``limit`` rows is left as it is: it comes in enough splits.
    """
    if rows is not None and rows > limit:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)
