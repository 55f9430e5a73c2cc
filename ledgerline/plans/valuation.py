"""Daily valuation per ticker, using only what was public on the day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.dims import POLICY_RATE
from ledgerline.functions.scalars import either_zero, safe_ratio
from ledgerline.operators.asof import asof_join


def with_policy_rate(df: DataFrame, series: DataFrame, time: str, series_id: str = POLICY_RATE) -> DataFrame:
    """Latest observation of one macro series on or before ``time``."""
    rate = series.filter(F.col("series_id") == series_id)
    return asof_join(df, rate, time, "obs_date", {"value": "fed_funds_rate"})


def with_public_financials(df: DataFrame, quarters: DataFrame, time: str) -> DataFrame:
    """Latest quarter with a trailing total that was filed on or before ``time``.

    Quarters without the total are dropped before matching, so an older complete quarter wins
    over a newer incomplete one. Of several quarters filed on one day the latest counts.
    """
    return asof_join(
        df,
        quarters.filter(F.col("ebitda_ttm").isNotNull()),
        time,
        "filed_date",
        {
            "period_end": "latest_filed_period_end",
            "ebitda_ttm": "ebitda_ttm",
            "total_debt": "reported_total_debt",
            "cash_and_equivalents": "cash_and_equivalents",
        },
        by=["ticker"],
        tiebreak=["period_end", "ebitda_ttm", "total_debt", "cash_and_equivalents"],
    )


def market_caps(prices: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Today's share count on each day's close; what readers of market cap alone need."""
    shares = snapshot.select("ticker", "shares_outstanding")
    return prices.join(shares, "ticker").select(
        "ticker",
        "price_date",
        "close_price",
        (F.col("close_price") * F.col("shares_outstanding")).alias("market_cap_approx"),
    )


def valuation_daily(prices: DataFrame, snapshot: DataFrame, quarters: DataFrame, series: DataFrame) -> DataFrame:
    """Market cap, enterprise value and EV/EBITDA for every priced day.

    Market cap is today's share count on the day's close; tickers without a snapshot drop out.
    Debt and cash unknown on the day count as 0, so EV falls back to market cap.

    The rate is attached first and the statements last: readers that only need rates then lose
    the statement join in planning. The snapshot join carries no hint: the planner broadcasts
    it when its measured size allows and otherwise shuffles, splitting hot tickers.
    """
    rated = with_policy_rate(market_caps(prices, snapshot), series, "price_date")
    return valued(with_public_financials(rated, quarters, "price_date"))


def valued(known: DataFrame) -> DataFrame:
    """Enterprise value and its multiple on rows that know their market cap, statements and rate."""
    value = F.col("market_cap_approx") + either_zero("reported_total_debt") - either_zero("cash_and_equivalents")
    return known.select(
        "ticker",
        "price_date",
        "close_price",
        "market_cap_approx",
        "latest_filed_period_end",
        "ebitda_ttm",
        "reported_total_debt",
        "cash_and_equivalents",
        value.alias("enterprise_value_approx"),
        safe_ratio(value, "ebitda_ttm").alias("ev_to_ebitda_approx"),
        "fed_funds_rate",
    )
