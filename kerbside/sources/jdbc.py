"""Relational tables over JDBC, for deployments that keep them in a database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_options(url: str, query: str, properties: dict[str, str] | None = None, *,
                 split_on: str | None = None, bounds: tuple[int, int] | None = None,
                 splits: int = 1, fetch_rows: int = 10_000) -> dict[str, str]:
    """Options of a query scan; with ``split_on`` and ``bounds`` it is read in parallel.

    The query is passed as a derived table, which is what lets Spark push filters and
    column choices into it and partition it.
    """
    options = {"url": url, "dbtable": f"({query}) AS q", "fetchsize": str(fetch_rows), **(properties or {})}
    if split_on:
        if bounds is None:
            raise ValueError("a split read needs the lowest and highest value of its column")
        options |= {"partitionColumn": split_on, "lowerBound": str(bounds[0]),
                    "upperBound": str(bounds[1]), "numPartitions": str(splits)}
    return options


def read_query(spark: SparkSession, url: str, query: str, properties: dict[str, str] | None = None,
               **split) -> DataFrame:
    return spark.read.format("jdbc").options(**read_options(url, query, properties, **split)).load()


def write_table(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
                mode: str = "append", batch_rows: int = 10_000) -> None:
    """Append or overwrite; overwriting empties the table and so keeps its keys."""
    (df.write.format("jdbc").mode(mode)
     .options(url=url, dbtable=table, truncate="true", batchsize=str(batch_rows), **(properties or {}))
     .save())
