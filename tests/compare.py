"""Run registered queries in Spark and their SQL in DuckDB and compare the rows.

    python tests/compare.py <data folder> [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def duckdb_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    return names, cursor.fetchall()


# Spark's simple type names as DuckDB calls them.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def type_difference(df, sf_dir: str, sql: str) -> str | None:
    _, described = duckdb_rows(sf_dir, f"DESCRIBE {sql}")
    theirs = {row[0]: row[1] for row in described}
    ours = {name: TYPES.get(dtype, dtype) for name, dtype in df.dtypes}
    unequal = {n: (ours.get(n), t) for n, t in theirs.items() if ours.get(n) != t}
    return f"types {unequal}" if unequal else None


def normal(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return value + 0.0
    return value


def sorted_rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def difference(spark, sf_dir: str, query, sql: str) -> str | None:
    """None when both results are equal, else what differs first."""
    df = query(spark, sf_dir)
    ours = sorted_rows(df.columns, df.collect())
    names, rows = duckdb_rows(sf_dir, sql)
    theirs = sorted_rows(names, rows)
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows vs {len(theirs)}"
    unequal = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if unequal:
        return f"{len(unequal)} rows differ, first {unequal[0][0]} vs {unequal[0][1]}"
    return type_difference(df, sf_dir, sql)


def main() -> None:
    import __spark_entry__ as entry
    from tidegrid.session import build_session

    spark = build_session(
        "compare",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in wanted or queries:
        if name not in oracles:
            continue
        start = time.time()
        try:
            found = difference(spark, sf_dir, queries[name], oracles[name])
        except Exception as error:  # noqa: BLE001
            found = f"error {str(error)[:500]}"
        bad += found is not None
        print(f"{name:28s} {time.time() - start:6.2f}s {found or 'equal'}", flush=True)
    print(f"{bad} differ")


if __name__ == "__main__":
    main()
