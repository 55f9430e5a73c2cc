"""Backward as-of joins on calendar dates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

MONTH = "interval 1 month"


def _check_date(df: DataFrame, column: str) -> None:
    if not isinstance(df.schema[column].dataType, DateType):
        raise TypeError(f"as-of column {column!r} must be a date; cast it first")


def _newest_per_time(right: DataFrame, keys: Sequence[str], time: str, tiebreak: Sequence[str]) -> DataFrame:
    """One row per (keys, time): the greatest by ``tiebreak``, reduced before the shuffle."""
    rank = F.row_number().over(
        Window.partitionBy(*keys, time).orderBy(*[F.col(c).desc_nulls_last() for c in tiebreak])
    )
    return right.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    left_time: str,
    right_time: str,
    payload: Mapping[str, str],
    by: Sequence[str] = (),
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Left join each row to the latest ``right`` row with ``right_time <= left_time``.

    ``payload`` maps right columns to output names. With ``by`` the match is within equal keys,
    without it one series serves all rows. Equal times match; null times or keys match nothing,
    and such left rows survive with nulls. Several right rows at one time: the greatest by
    ``tiebreak`` (by the payload when not given) counts.

    The right side becomes validity intervals [from, to) laid out on a calendar grid, so the
    left side needs only an equi-join: no sort of a key's whole history, no state carried
    across rows, and rows of one hot key spread over its months. ``right`` should be cheap to
    read twice (its last date is looked up first).
    """
    _check_date(left, left_time)
    _check_date(right, right_time)
    taken = sorted(set(payload.values()) & set(left.columns))
    if taken:
        raise ValueError(f"payload names already on the left side: {', '.join(taken)}; map them to other names")
    tiebreak = tiebreak or list(payload)
    keyed = (
        right.filter(F.col(right_time).isNotNull())
        .select(
            *[F.col(k).alias(f"_k{i}") for i, k in enumerate(by)],
            F.col(right_time).alias("_from"),
            *[F.col(c).alias(f"_t{i}") for i, c in enumerate(tiebreak)],
            F.struct(*[F.col(src).alias(out) for src, out in payload.items()]).alias("_hit"),
        )
    )
    keys = [f"_k{i}" for i in range(len(by))]
    versions = _newest_per_time(keyed, keys, "_from", [f"_t{i}" for i in range(len(tiebreak))])
    last_seen = right.agg(F.max(right_time)).scalar()
    join = _join_by_month if by else _join_by_day
    joined = join(left, versions, left_time, list(by), keys, last_seen)
    return joined.select(*left.columns, *[F.col(f"_hit.{out}").alias(out) for out in payload.values()])


def _join_by_month(
    left: DataFrame, versions: DataFrame, left_time: str, by: list[str], keys: list[str], last_seen: Column
) -> DataFrame:
    # Versions hold one row per (key, date): a window over one key is bounded by the calendar.
    succession = Window.partitionBy(*keys).orderBy("_from")
    intervals = versions.withColumn("_to", F.lead("_from").over(succession))
    # Every interval is listed under each month it touches; the open last one up to the last
    # month the right side knows, to which later left rows are folded.
    until = F.coalesce(F.date_sub("_to", 1), last_seen)
    months = F.sequence(F.trunc("_from", "MM"), F.trunc(until, "MM"), F.expr(MONTH))
    listed = intervals.select(*keys, "_from", "_to", "_hit", F.explode(months).alias("_slot"))
    slotted = left.withColumn("_month", F.least(F.trunc(left_time, "MM"), F.trunc(last_seen, "MM")))

    when = F.col(left_time)
    match = (F.col("_month") == F.col("_slot")) & (when >= F.col("_from"))
    match &= F.col("_to").isNull() | (when < F.col("_to"))
    for key, name in zip(keys, by):
        match &= F.col(name) == F.col(key)
    return slotted.join(listed, match, "left")


def _join_by_day(
    left: DataFrame, versions: DataFrame, left_time: str, by: list[str], keys: list[str], last_seen: Column
) -> DataFrame:
    # One row per calendar day at most (36,525 a century): the unpartitioned window is bounded by
    # the date type, not by the data. Whether the days are broadcast is left to their measured size.
    intervals = versions.withColumn("_to", F.lead("_from").over(Window.orderBy("_from")))
    days = F.sequence(F.col("_from"), F.coalesce(F.date_sub("_to", 1), F.col("_from")))
    listed = intervals.select("_hit", F.explode(days).alias("_day"))
    # least() skips nulls, and a null time must match nothing.
    folded = F.when(F.col(left_time).isNotNull(), F.least(F.col(left_time), last_seen))
    slotted = left.withColumn("_slot", folded)
    return slotted.join(listed, F.col("_slot") == F.col("_day"), "left")
