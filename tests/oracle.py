"""Compare registered queries with their SQL oracles: ``python tests/oracle.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def _rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, connection, name: str, case, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    query, sql = case
    frame = query(spark, sf_dir)
    got = _rows([tuple(r) for r in frame.collect()], frame.columns)
    if sql is None:
        return None if got else "no rows"
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}"
    for column, kind in frame.dtypes:
        if KINDS.get(kind) != kinds[column]:
            return f"type of {column}: {kind} != {kinds[column]}"
    want = _rows(result.fetchall(), columns)
    if got != want:
        gone = [r for r in want if r not in set(got)][:3]
        extra = [r for r in got if r not in set(want)][:3]
        return f"{len(got)} rows, {len(want)} wanted; missing {str(gone)[:600]}; extra {str(extra)[:600]}"
    return None


def main() -> None:
    from __spark_entry__ import CASES as ALL
    from tarn.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(ALL)
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, connection, name, ALL[name], sf_dir)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{time.time() - start:6.2f}s {name:28s} {'ok' if problem is None else 'DIFF ' + problem}", flush=True)
    print(f"{len(names) - bad} of {len(names)} equal")
    spark.stop()


if __name__ == "__main__":
    main()
