"""Declarative data checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_counts(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """(table_name, column_name, violations), all columns counted in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    cells = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("violations")) for c in columns])
    ).alias("_check")
    return counts.select(F.lit(table).alias("table_name"), cells).select("table_name", "_check.*")


def check_not_null(tables: Mapping[str, DataFrame], rules: Mapping[str, Sequence[str]]) -> DataFrame:
    """Violation counts for every (table, column) rule."""
    parts = [null_counts(tables[name], name, columns) for name, columns in rules.items()]
    return reduce(DataFrame.unionByName, parts)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of a documented grain that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def require_clean(report: DataFrame) -> None:
    """Raise when any check of ``report`` (one row per rule) has violations."""
    failed = report.filter("violations > 0").collect()
    if failed:
        listed = ", ".join(f"{r.table_name}.{r.column_name}: {r.violations}" for r in failed)
        raise ValueError(f"data checks failed: {listed}")
