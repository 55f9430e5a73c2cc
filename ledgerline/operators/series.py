"""Calendar resampling and period-over-period changes of panel series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.scalars import month_start, pct_change


def resample_last(df: DataFrame, key: str, time: str, columns: Sequence[str]) -> DataFrame:
    """Each column's last non-null value per (key, calendar month), on a gap-free month grid.

    Output: key, ``time`` as first of month, columns. Months without rows between the first and
    the last are present with nulls. Fixed-width columns keep the reduction a hash aggregation;
    what is shuffled is one row per (task, key, month), and what is windowed one per (key, month).
    """
    lasts = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(time))).alias(c) for c in columns]
    monthly = df.groupBy(F.col(key), month_start(time).alias("_month")).agg(*lasts)

    # Each month fills the gap up to the next one; an added month holds nulls.
    spaced = monthly.withColumn("_next", F.lead("_month").over(Window.partitionBy(key).orderBy("_month")))
    span_end = F.coalesce(F.add_months("_next", -1), F.col("_month"))
    grid = F.explode(F.sequence(F.col("_month"), span_end, F.expr("interval 1 month"))).alias(time)
    return spaced.select(key, "_month", *columns, grid).select(
        key, time, *[F.when(F.col(time) == F.col("_month"), F.col(c)).alias(c) for c in columns]
    )


def with_changes(
    df: DataFrame,
    key: str,
    order: Sequence[str | Column],
    percent: Mapping[str, str] | None = None,
    difference: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add percent changes and differences to the previous row of the key (source -> output).

    Meant for frames already reduced to one row per (key, period).
    """
    w = Window.partitionBy(key).orderBy(*order)
    added = {out: pct_change(src, F.lag(src).over(w)) for src, out in (percent or {}).items()}
    added |= {out: F.col(src) - F.lag(src).over(w) for src, out in (difference or {}).items()}
    return df.withColumns(added)
