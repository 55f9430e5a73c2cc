"""Trend and regression summary: tables first, then the same facts as text lines."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.scalars import fixed_text, pct_change
from ledgerline.operators.latest import first_and_last, peak_by
from ledgerline.plans.rate_sensitivity import (
    leverage_regression,
    monthly_changes,
    quarterly_leverage_changes,
    rate_series,
    valuation_regression,
)


def rate_trend(valuation: DataFrame) -> DataFrame:
    """One row: low, peak, first and last date, value on the last date; none when nothing is known."""
    # Over distinct days: the reduction is the same, and a lazy valuation loses its statement join.
    return (
        rate_series(valuation)
        .agg(
            F.min("fed_funds_rate").alias("low"),
            F.max("fed_funds_rate").alias("peak"),
            F.min("price_date").alias("first_date"),
            F.max("price_date").alias("last_date"),
            F.max_by("fed_funds_rate", "price_date").alias("latest"),
        )
        .filter("low is not null")
    )


def market_cap_trend(valuation: DataFrame) -> DataFrame:
    """Per ticker: first and last priced date and the percent change of market cap between."""
    ends = first_and_last(
        valuation.filter(F.col("market_cap_approx").isNotNull()),
        ["ticker"],
        "price_date",
        first={"first_date": "price_date", "_first": "market_cap_approx"},
        last={"last_date": "price_date", "_last": "market_cap_approx"},
    )
    return ends.select("ticker", "first_date", "last_date", pct_change("_last", "_first").alias("pct_change"))


def leverage_trend(quarters: DataFrame) -> DataFrame:
    """Per ticker: debt/equity first, at its peak (earliest) and last; current ratio first and last.

    Only quarters with a debt/equity count, also for the current ratio.
    """
    known = quarters.filter(F.col("debt_to_equity").isNotNull())
    ends = first_and_last(
        known,
        ["ticker"],
        "period_end",
        first={
            "first_period": "period_end",
            "first_debt_to_equity": "debt_to_equity",
            "first_current_ratio": "current_ratio",
        },
        last={
            "last_period": "period_end",
            "last_debt_to_equity": "debt_to_equity",
            "last_current_ratio": "current_ratio",
        },
    )
    peaks = peak_by(known, ["ticker"], "debt_to_equity", "period_end")
    return ends.join(
        peaks.select("ticker", F.col("peak").alias("peak_debt_to_equity"), F.col("peak_time").alias("peak_period")),
        "ticker",
    )


#: Tickers that one text cell may list.
DISPLAY_LIMIT = 1000

# Section numbers fix the order of the lines.
_NOTHING, _RATE, _CAPS, _LEVERAGE_BREAK, _LEVERAGE_HEAD, _LEVERAGE = range(6)
_FIT_BREAK, _MARKET_FIT, _MULTIPLE_FIT, _DEBT_FIT, _LIQUIDITY_FIT = range(6, 11)
_NOTE, _CAP_BETAS, _DEBT_BETAS = range(11, 14)

# The wording of the report. Each %s takes the next value of the line's row.
NO_DATA = "(no valuation/Fed rate data available)"
LEVERAGE_HEADING = "Leverage/liquidity trend across the FULL history, including the hiking cycle itself:"
NOTE = (
    "Note: these fits compare changes, since two levels that trend go together whatever their relation. "
    "Each company adds few observations, so take R^2 and p as hints; no fit here shows a cause."
)
CAP_BETAS_HEADING = "Per-company beta (market cap %-change per 1pp rate change): "
DEBT_BETAS_HEADING = "Per-company beta (debt-to-equity change per 1pp rate change): "
WORDING = {
    _NOTHING: NO_DATA,
    _RATE: "Fed funds rate: %s%% (low) to %s%% (peak) over %s to %s; most recent value %s%%.",
    _CAPS: "%s: approx. market cap changed %s%% from %s to %s.",
    _LEVERAGE_BREAK: "",
    _LEVERAGE_HEAD: LEVERAGE_HEADING,
    _LEVERAGE: (
        "%s: debt/equity was %s as of %s, peaked at %s (%s), now %s (%s). "
        "Current ratio: %s -> %s over the same window."
    ),
    _FIT_BREAK: "",
    _MARKET_FIT: (
        "Regression (month-over-month changes, pooled across all %s companies, n=%s company-months): "
        "a 1 percentage point change in the Fed funds rate is associated with a %s percentage point change "
        "in market cap that same month (R^2=%s, p=%s)."
    ),
    _MULTIPLE_FIT: "Same regression against EV/EBITDA: %s pp change in EV/EBITDA per 1pp rate change (R^2=%s, p=%s).",
    _DEBT_FIT: (
        "Regression (quarter-over-quarter changes, pooled, n=%s company-quarters): a 1 percentage point change "
        "in the Fed funds rate is associated with a %s change in debt-to-equity that quarter (R^2=%s, p=%s)."
    ),
    _LIQUIDITY_FIT: "Same regression against the current ratio: %s change per 1pp rate change (R^2=%s, p=%s).",
    _NOTE: NOTE,
    _CAP_BETAS: "%s=%s",
    _DEBT_BETAS: "%s=%s",
}
MOST_VALUES = 9

#: A value of a line: a text column, or a number's column with its digits and whether it is signed.
Value = str | tuple[str, int] | tuple[str, int, bool]


def _value(given: Value) -> Column:
    """A value as (text, number, digits, signed), with a text or a number."""
    name, digits, signed = (given, None, False) if isinstance(given, str) else (*given, False)[:3]
    text, number = F.col(name).cast("string"), F.lit(None).cast("double")
    if digits is not None:
        text, number = F.lit(None).cast("string"), F.col(name).cast("double")
    return F.struct(text.alias("t"), number.alias("v"), F.lit(digits or 0).alias("d"), F.lit(signed).alias("s"))


def _lines(df: DataFrame, section: int, values: list[Value], key: Column | None = None) -> DataFrame:
    return df.select(
        F.lit(section).alias("section"),
        (F.lit("") if key is None else key).alias("ticker"),
        F.array(*map(_value, values)).alias("values"),
    )


def _written(lines: DataFrame) -> DataFrame:
    """The rows' values put into their sections' wording; a value that is unknown reads "nan", so no line is lost.

    Numbers are written by one expression, whatever the number of sections.
    """
    written = f"transform(values, g -> coalesce(g.t, {fixed_text('g.v', 'g.d', 'g.s')}, 'nan'))"
    wording = F.create_map(*[F.lit(x) for pair in WORDING.items() for x in pair])
    texts = lines.select("section", "ticker", F.expr(written).alias("_texts"), wording[F.col("section")].alias("_wording"))
    given = ", ".join(f"coalesce(get(_texts, {k}), '')" for k in range(MOST_VALUES))
    return texts.select("section", "ticker", F.expr(f"format_string(_wording, {given})").alias("line"))


def _when_rows(df: DataFrame, present: bool, sections: list[int]) -> DataFrame:
    """Lines without values that appear only when ``df`` has rows (or only when it has none)."""
    counted = df.limit(1).agg(F.count(F.lit(1)).alias("n")).filter("n > 0" if present else "n = 0")
    none = F.array().cast("array<struct<t:string,v:double,d:int,s:boolean>>")
    each = F.explode(F.array(*map(F.lit, sections))).alias("section")
    return counted.select(each).select("section", F.lit("").alias("ticker"), none.alias("values"))


def trend_lines(
    quarters: DataFrame, valuation: DataFrame, panels: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """The report as rows (section, ticker, line); sorting by the first two gives the text order.

    Per-company slopes are one row each, so no cell grows with the number of companies.
    Lines whose slope is unknown are absent. Without any valuation the one no-data line is all.

    ``panels`` are the tables of ``warehouse.build_panels`` for the same marts; the daily mart is
    then scanned once, for the market caps. Without them every panel is derived where it is read.
    """
    known = valuation.select("ticker").limit(1).agg(F.count(F.lit(1))).scalar() > 0
    quarters = quarters.filter(known)
    if panels is None:
        rates, caps = valuation, monthly_changes(valuation)
        debts = quarterly_leverage_changes(quarters, valuation)
    else:
        rates, caps = panels["rate_days"], panels["monthly_changes"]
        debts = panels["quarterly_leverage_changes"]
    market = valuation_regression(caps, by_ticker=False)
    leverage = leverage_regression(debts, by_ticker=False)
    per_cap = valuation_regression(caps, by_ticker=True).filter(F.col("market_cap_beta").isNotNull())
    per_debt = leverage_regression(debts, by_ticker=True).filter(F.col("debt_to_equity_beta").isNotNull())

    def fit(fits: DataFrame, response: str) -> DataFrame:
        return fits.filter((F.col("response") == response) & F.col("beta").isNotNull())

    tail: list[Value] = [("r_squared", 3), ("p_value", 3)]
    rate: list[Value] = [("low", 2), ("peak", 2), "first_date", "last_date", ("latest", 2)]
    lever: list[Value] = [
        "ticker", ("first_debt_to_equity", 2), "first_period", ("peak_debt_to_equity", 2), "peak_period",
        ("last_debt_to_equity", 2), "last_period", ("first_current_ratio", 2), ("last_current_ratio", 2),
    ]
    ticker = F.col("ticker")
    parts = [
        _when_rows(valuation.select("ticker"), False, [_NOTHING]),
        _lines(rate_trend(rates), _RATE, rate),
        _lines(market_cap_trend(valuation), _CAPS, ["ticker", ("pct_change", 0, True), "first_date", "last_date"], ticker),
        _when_rows(quarters.select("ticker"), True, [_LEVERAGE_BREAK, _LEVERAGE_HEAD]),
        _lines(leverage_trend(quarters), _LEVERAGE, lever, ticker),
        _when_rows(market.select("response"), True, [_FIT_BREAK]),
        _lines(fit(market, "market_cap"), _MARKET_FIT, ["n_companies", "n", ("beta", 2, True), *tail]),
        _lines(fit(market, "ev_ebitda"), _MULTIPLE_FIT, [("beta", 2, True), *tail]),
        _lines(fit(leverage, "debt_to_equity"), _DEBT_FIT, ["n", ("beta", 3, True), *tail]),
        _lines(fit(leverage, "current_ratio"), _LIQUIDITY_FIT, [("beta", 3, True), *tail]),
        _when_rows(market.select("response").unionByName(leverage.select("response")), True, [_NOTE]),
        _lines(per_cap, _CAP_BETAS, ["ticker", ("market_cap_beta", 2, True)], ticker),
        _lines(per_debt, _DEBT_BETAS, ["ticker", ("debt_to_equity_beta", 3, True)], ticker),
    ]
    return _written(reduce(DataFrame.unionByName, parts))


def trend_text(quarters: DataFrame, valuation: DataFrame, tickers: Iterable[str]) -> DataFrame:
    """The report for a short display list as one text cell, per-company slopes comma-joined.

    The pooled fits and the rate's days are those of the listed tickers, so no stored panel of all
    tickers can serve. The cell grows with the caller's list, never with the data.
    """
    chosen = list(tickers)
    if len(chosen) > DISPLAY_LIMIT:
        raise ValueError(f"a text for {len(chosen)} tickers; list at most {DISPLAY_LIMIT} or use trend_lines")
    lines = trend_lines(
        quarters.filter(F.col("ticker").isin(chosen)), valuation.filter(F.col("ticker").isin(chosen))
    )
    heads = {_CAP_BETAS: CAP_BETAS_HEADING, _DEBT_BETAS: DEBT_BETAS_HEADING}
    betas = lines.filter(F.col("section").isin(*heads))
    heading = F.when(F.col("section") == _CAP_BETAS, CAP_BETAS_HEADING).otherwise(DEBT_BETAS_HEADING)
    joined = betas.groupBy("section").agg(F.array_join(F.array_sort(F.collect_list("line")), ", ").alias("line"))
    whole = lines.filter(~F.col("section").isin(*heads)).unionByName(
        joined.select("section", F.lit("").alias("ticker"), F.concat(heading, "line").alias("line"))
    )
    ordered = F.array_sort(F.collect_list(F.struct("section", "ticker", "line")))
    return whole.agg(F.array_join(F.transform(ordered, lambda row: row["line"]), "\n").alias("text"))
