"""Long-to-wide with an explicit list of targets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def conditional_pivot(
    df: DataFrame,
    keys: Sequence[str | Column],
    category: str,
    value: str,
    targets: Mapping[str, str],
    extra: Sequence[Column] = (),
) -> DataFrame:
    """``max(value)`` per key for each category in ``targets`` (category -> output column).

    One hash aggregation with map-side combine; no pass to discover categories.
    """
    cells = [F.expr(f"max(if(`{category}` = '{cat}', `{value}`, null)) as `{out}`") for cat, out in targets.items()]
    return df.groupBy(*keys).agg(*extra, *cells)
