"""Compare a Spark result with a DuckDB result as multisets of rows."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if value != value else repr(value + 0.0)
    return value


def differences(df, relation) -> list[str]:
    """Human-readable mismatches; empty when both hold the same rows."""
    spark_cols, duck_cols = sorted(df.columns), sorted(relation.columns)
    if spark_cols != duck_cols:
        return [f"columns differ: {spark_cols} / {duck_cols}"]
    ours = Counter(tuple(_cell(row[c]) for c in spark_cols) for row in df.collect())
    index = [relation.columns.index(c) for c in spark_cols]
    theirs = Counter(tuple(_cell(row[i]) for i in index) for row in relation.fetchall())
    if ours == theirs:
        return []
    only_ours, only_theirs = list((ours - theirs).elements()), list((theirs - ours).elements())
    return [
        f"{ours.total()} rows / {theirs.total()} rows, {len(only_ours)} only in Spark, {len(only_theirs)} only in DuckDB",
        f"columns: {spark_cols}",
        *[f"spark  {row}" for row in sorted(only_ours, key=str)[:3]],
        *[f"duckdb {row}" for row in sorted(only_theirs, key=str)[:3]],
    ]
