"""Frames behind the display: snapshot table, chart series, grounding table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.dims import ticker_positions
from ledgerline.operators.latest import index_to_first
from ledgerline.operators.regression import with_trend_line

_SNAPSHOT_BALANCE = ["period_end", "current_ratio", "debt_to_equity", "liabilities_to_assets"]
_SNAPSHOT_INCOME = ["revenue", "ebitda_ttm"]

# Shown headings and the columns given to the question-answering context.
SNAPSHOT_LABELS = {
    "period_end": "As of",
    "current_ratio": "Current Ratio",
    "debt_to_equity": "Debt / Equity",
    "liabilities_to_assets": "Liabilities / Assets",
    "revenue": "Revenue (qtr)",
    "ebitda_ttm": "EBITDA (TTM)",
}
GROUNDING_COLUMNS = [
    "ticker",
    "period_end",
    "revenue",
    "net_income",
    "ebitda",
    "ebitda_ttm",
    "current_ratio",
    "debt_to_equity",
    "liabilities_to_assets",
    "total_assets",
    "total_debt",
    "stockholders_equity",
]


def select_tickers(df: DataFrame, tickers: Iterable[str] | None) -> DataFrame:
    """Rows of the chosen tickers; None keeps all."""
    return df if tickers is None else df.filter(F.col("ticker").isin(list(tickers)))


def latest_quarters(quarters: DataFrame) -> DataFrame:
    """Per ticker the latest balance row, with revenue and TTM from the latest row having revenue.

    Both are one pass: two orderings of the same aggregation instead of two frames joined.
    """
    newest, newest_income = F.col("period_end"), F.when(F.col("revenue").isNotNull(), F.col("period_end"))
    return quarters.groupBy("ticker").agg(
        *[F.max_by(c, newest).alias(c) for c in _SNAPSHOT_BALANCE],
        *[F.max_by(c, newest_income).alias(c) for c in _SNAPSHOT_INCOME],
    )


def latest_snapshot(quarters: DataFrame, order: DataFrame | Iterable[str]) -> DataFrame:
    """One row per listed ticker, in list order (column position), nulls for one without data.

    ``order`` is a (ticker, position) frame or a plain display list.
    """
    if not isinstance(order, DataFrame):
        order = ticker_positions(quarters.sparkSession, order)
    return order.join(latest_quarters(quarters), "ticker", "left").select(
        "position", "ticker", *_SNAPSHOT_BALANCE, *_SNAPSHOT_INCOME
    )


def display_snapshot(snapshot: DataFrame) -> DataFrame:
    """The snapshot sorted by its list position, under the shown headings."""
    return snapshot.orderBy("position").select(
        F.col("ticker").alias("Ticker"), *[F.col(c).alias(label) for c, label in SNAPSHOT_LABELS.items()]
    )


def ratio_lines(quarters: DataFrame, ratio: str) -> DataFrame:
    """(period_end, ticker, ratio) points of one leverage or liquidity line per ticker."""
    return quarters.select("period_end", "ticker", ratio)


def indexed_market_cap(valuation: DataFrame) -> DataFrame:
    """Market cap with each ticker's first observation at 100.

    Reads ticker, date and market cap only: give it ``valuation.market_caps`` or the stored mart,
    not a lazy valuation, whose as-of joins it would run twice.
    """
    indexed = index_to_first(
        valuation.select("price_date", "ticker", "market_cap_approx"),
        "ticker",
        "price_date",
        "market_cap_approx",
        "market_cap_indexed",
    )
    return indexed.select("price_date", "ticker", "market_cap_indexed")


def multiple_lines(valuation: DataFrame) -> DataFrame:
    return valuation.select("price_date", "ticker", "ev_to_ebitda_approx").dropna(subset=["ev_to_ebitda_approx"])


def scatter_with_trend(changes: DataFrame, response: str) -> DataFrame:
    """Points of a response against the rate change with one overall fitted line."""
    return with_trend_line(changes.select("ticker", "rate_change_pp", response), "rate_change_pp", response)


def grounding_table(quarters: DataFrame) -> DataFrame:
    """The columns given to the question-answering context, as far as present."""
    return quarters.select(*[c for c in GROUNDING_COLUMNS if c in quarters.columns])


def write_grounding_csv(quarters: DataFrame, path: str) -> None:
    """CSV files, globally ordered by (ticker, period_end)."""
    grounding_table(quarters).orderBy("ticker", "period_end").write.mode("overwrite").csv(path, header=True)
