"""Staging: raw tables to typed, deduplicated frames. All lazy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.scalars import days_between
from ledgerline.operators.latest import latest_by

FORMS = ("10-Q", "10-K")  # fixed value: the forms that report periodic statements


def same_day() -> list:
    """Among versions of one period filed on one day, the first in this order counts."""
    return ["form", F.desc("fy"), "fp", "tag", F.desc("val")]


def reported_facts(raw: DataFrame) -> DataFrame:
    """The facts of periodic statements; a null and an empty start denote the same instant."""
    return raw.filter(F.col("form").isin(*FORMS)).withColumn("start", F.expr("nullif(start, '')"))


def typed_facts(facts: DataFrame) -> DataFrame:
    """Dates as dates, and the length of the period."""
    return facts.selectExpr(
        "ticker",
        "concept",
        "tag",
        "form",
        "fy",
        "fp",
        "cast(start as date) as period_start",
        "cast(end as date) as period_end",
        "cast(filed as date) as filed",
        "val",
    ).withColumn("period_length_days", days_between("period_start", "period_end"))


def stage_facts(raw: DataFrame) -> DataFrame:
    """Latest filed version of every (ticker, concept, period).

    Versions filed on one day are settled by form, fy (newest), fp, tag, then the larger value, so
    reruns agree. A later filter on the period or the concept passes below the dedupe, since those are its keys.
    """
    return typed_facts(latest_by(reported_facts(raw), ["ticker", "concept", "start", "end"], [F.desc("filed"), *same_day()]))


def stage_prices(raw: DataFrame) -> DataFrame:
    return raw.filter("close is not null").selectExpr(
        "ticker", "cast(date as date) as price_date", "close as close_price", "volume"
    )


def stage_series(raw: DataFrame) -> DataFrame:
    return raw.filter("value is not null").selectExpr("series_id", "cast(date as date) as obs_date", "value")


def stage_snapshot(raw: DataFrame) -> DataFrame:
    return raw.withColumnRenamed("ev_to_ebitda", "ev_to_ebitda_asof_today")
