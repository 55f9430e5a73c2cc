"""Top-1 per group: newest version, first/last value, arg-max."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One whole row per key: the first under ``order``.

    ``row_number() = 1`` plans a map-side group limit, so each task ships at most one row per
    key whatever the size of the group; a hot key never gathers its copies.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def first_and_last(
    df: DataFrame, keys: Sequence[str], time: str, first: Mapping[str, str], last: Mapping[str, str]
) -> DataFrame:
    """Earliest and latest value per key in one partially aggregated pass.

    ``first``/``last`` map an output name to the column read at the earliest/latest ``time``.
    Fixed-width columns stay in hash aggregation. Unique (key, time) is assumed.
    """
    picks = [F.min_by(src, time).alias(out) for out, src in first.items()]
    picks += [F.max_by(src, time).alias(out) for out, src in last.items()]
    return df.groupBy(*keys).agg(*picks)


def peak_by(df: DataFrame, keys: Sequence[str], value: str, time: str) -> DataFrame:
    """Largest ``value`` per key and its earliest ``time``: columns peak, peak_time."""
    # The second field counts down with time, so the struct maximum resolves ties to the earliest.
    origin = F.lit("1970-01-01").cast("date")
    top = F.max(F.struct(F.col(value).alias("v"), F.datediff(origin, F.col(time)).alias("back")))
    return (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys)
        .agg(top.alias("_top"))
        .select(*keys, F.col("_top.v").alias("peak"), F.date_sub(origin, F.col("_top.back")).alias("peak_time"))
    )


def index_to_first(df: DataFrame, key: str, time: str, value: str, out: str, base: float = 100.0) -> DataFrame:
    """``value`` relative to the key's first row, times ``base``; a null first value gives nulls.

    The first values are aggregated and joined back instead of carried through a window, so no
    task sorts the whole history of one key; a hot key is split by the adaptive join.
    """
    # min_by keeps a null value of the earliest row, as required.
    firsts = df.groupBy(key).agg(F.min_by(value, time).alias("_first"))
    return (
        df.join(firsts, key, "left")
        .withColumn(out, F.try_divide(F.col(value), F.col("_first")) * base)
        .drop("_first")
    )
