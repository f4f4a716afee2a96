"""Compare named queries with their SQL, as ``python tests/check_oracles.py DIR [name ...]``."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings"
          " pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def canonical(columns: list[str], rows: list) -> tuple[list[str], list]:
    """Columns by name, rows as sorted text."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr(tuple(row[i] for i in order)) for row in rows)


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    df = fn(spark, sf_dir)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    want = canonical([c[0] for c in result.description], result.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} and {want[0]}"
    if got[1] != want[1]:
        only_got = [r for r in got[1] if r not in set(want[1])][:3]
        only_want = [r for r in want[1] if r not in set(got[1])][:3]
        return f"{len(got[1])} and {len(want[1])} rows; only here {only_got}; only there {only_want}"
    return None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry
    from kerbside.session import configure

    sf, names = sys.argv[1], sys.argv[2:]
    session = (configure(SparkSession.builder.master("local[8]")).config("spark.sql.shuffle.partitions", "8")
               .config("spark.driver.memory", "16g").config("spark.ui.enabled", "false").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    connection = duck(sf)
    oracles = entry.oracle_sql()
    for query, fn in entry.queries().items():
        if names and query not in names:
            continue
        begun = time.time()
        try:
            if query in oracles:
                outcome = compare(session, connection, query, fn, oracles[query], sf) or "equal"
            else:
                outcome = f"{fn(session, sf).count()} rows, no SQL"
        except Exception as error:   # report and go on with the next query
            outcome = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{query}: {outcome} ({time.time() - begun:.1f} s)", flush=True)
