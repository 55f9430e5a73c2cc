"""How valuation and leverage move with the policy rate: differenced panels and their fits.

Changes, not levels, are regressed; two trending levels would correlate whatever their relation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.asof import asof_join
from ledgerline.operators.regression import ols, ols_long
from ledgerline.operators.series import resample_last, with_changes

VALUATION_RESPONSES = {"market_cap": "market_cap_pct_change", "ev_ebitda": "ev_ebitda_pct_change"}
LEVERAGE_RESPONSES = {"debt_to_equity": "de_change", "current_ratio": "cr_change"}


def monthly_changes(valuation: DataFrame) -> DataFrame:
    """Month-over-month changes per ticker, for months whose rate change is known.

    ``price_date`` is the first of the month. Nothing is padded over empty months.
    """
    monthly = resample_last(
        valuation.filter(F.col("fed_funds_rate").isNotNull()),
        "ticker",
        "price_date",
        ["market_cap_approx", "ev_to_ebitda_approx", "fed_funds_rate"],
    )
    changed = with_changes(
        monthly,
        "ticker",
        ["price_date"],
        percent={"market_cap_approx": "market_cap_pct_change", "ev_to_ebitda_approx": "ev_ebitda_pct_change"},
        difference={"fed_funds_rate": "rate_change_pp"},
    )
    return changed.dropna(subset=["rate_change_pp"]).select(
        "price_date",
        "market_cap_approx",
        "ev_to_ebitda_approx",
        "fed_funds_rate",
        "ticker",
        "market_cap_pct_change",
        "ev_ebitda_pct_change",
        "rate_change_pp",
    )


def rate_series(valuation: DataFrame) -> DataFrame:
    """Distinct (price_date, fed_funds_rate), nulls dropped."""
    return valuation.select("price_date", "fed_funds_rate").dropna().distinct()


def quarterly_leverage_changes(quarters: DataFrame, valuation: DataFrame) -> DataFrame:
    """Quarter-over-quarter changes of leverage and of the rate in force at quarter end.

    ``price_date`` is the priced day the rate was taken from, on or before the quarter end.
    ``valuation`` is read twice for two columns: give it the mart, or better its stored ``rate_series``.
    """
    ratios = quarters.select("ticker", "period_end", "debt_to_equity", "current_ratio")
    rated = asof_join(
        ratios,
        rate_series(valuation),
        "period_end",
        "price_date",
        {"price_date": "price_date", "fed_funds_rate": "fed_funds_rate"},
    )
    changed = with_changes(
        rated,
        "ticker",
        ["period_end", "debt_to_equity", "current_ratio"],
        difference={
            "debt_to_equity": "de_change",
            "current_ratio": "cr_change",
            "fed_funds_rate": "rate_change_pp",
        },
    )
    return changed.dropna(subset=["rate_change_pp"]).select(
        "period_end",
        "debt_to_equity",
        "current_ratio",
        "price_date",
        "fed_funds_rate",
        "ticker",
        "de_change",
        "cr_change",
        "rate_change_pp",
    )


def _per_ticker(changes: DataFrame, responses: dict[str, str], count_as: str) -> DataFrame:
    """Fits per ticker; the shown sample size is that of the first response."""
    first = next(iter(responses))
    stats = [f"{name}_{stat}" for name in responses for stat in ("beta", "r2", "pvalue")]
    fits = ols(changes, "rate_change_pp", responses, by=["ticker"])
    return fits.select("ticker", F.col(f"{first}_n").alias(count_as), *stats)


def _pooled(changes: DataFrame, responses: dict[str, str]) -> DataFrame:
    """One fit per response over all tickers, with the number of tickers; no rows when empty."""
    companies = F.countDistinct("ticker").alias("n_companies")
    fits = ols(changes, "rate_change_pp", responses, extra=[companies]).filter("n_companies > 0")
    return ols_long(fits, list(responses), ["n_companies"])


def valuation_regression(changes: DataFrame, by_ticker: bool) -> DataFrame:
    """Fits of ``monthly_changes`` on the rate change."""
    if by_ticker:
        return _per_ticker(changes, VALUATION_RESPONSES, "months")
    return _pooled(changes, VALUATION_RESPONSES)


def leverage_regression(changes: DataFrame, by_ticker: bool) -> DataFrame:
    """Fits of ``quarterly_leverage_changes`` on the rate change."""
    if by_ticker:
        return _per_ticker(changes, LEVERAGE_RESPONSES, "quarters")
    return _pooled(changes, LEVERAGE_RESPONSES)
