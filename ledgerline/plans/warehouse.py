"""Building the marts: staging stays lazy, marts are written tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ledgerline.operators.quality import check_not_null
from ledgerline.plans import rate_sensitivity, staging, statements, valuation
from ledgerline.plans import visibility as known_by_day
from ledgerline.sources.publication import publish, read_current

# Fixed values: (table -> columns that must not be null).
NOT_NULL_RULES = {
    "fct_balance_sheet_quarterly": ["ticker", "period_end", "total_assets"],
    "fct_income_statement_quarterly": ["ticker", "period_end"],
    "fct_financials_quarterly": ["ticker", "period_end", "current_ratio", "debt_to_equity"],
    "fct_valuation_daily": ["ticker", "price_date"],
}
# Documented grain and sort order of each mart.
MART_KEYS = {
    "fct_balance_sheet_quarterly": ["ticker", "period_end"],
    "fct_income_statement_quarterly": ["ticker", "period_end"],
    "fct_financials_quarterly": ["ticker", "period_end"],
    "fct_valuation_daily": ["ticker", "price_date"],
}
# Sort order of the small panels that summaries read many times.
PANEL_KEYS = {
    "rate_days": ["price_date"],
    "monthly_changes": ["ticker", "price_date"],
    "quarterly_leverage_changes": ["ticker", "period_end"],
}


STAGES = {
    "raw_edgar_facts": ("stg_edgar_facts", staging.stage_facts),
    "raw_yfinance_prices": ("stg_yfinance_prices", staging.stage_prices),
    "raw_fred_series": ("stg_fred_series", staging.stage_series),
    "raw_yfinance_valuation_snapshot": ("stg_yfinance_valuation_snapshot", staging.stage_snapshot),
}


def stage_all(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The staging frame of every raw table given."""
    return {STAGES[name][0]: STAGES[name][1](frame) for name, frame in raw.items()}


def quarterly_marts(staged: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Balance sheet, income statement and their combination, all lazy."""
    balance = statements.balance_sheet(staged["stg_edgar_facts"])
    income = statements.income_statement(staged["stg_edgar_facts"])
    return {
        "fct_balance_sheet_quarterly": balance,
        "fct_income_statement_quarterly": income,
        "fct_financials_quarterly": statements.financials(balance, income),
    }


def valuation_mart(staged: Mapping[str, DataFrame], quarters: DataFrame) -> DataFrame:
    return valuation.valuation_daily(
        staged["stg_yfinance_prices"],
        staged["stg_yfinance_valuation_snapshot"],
        quarters,
        staged["stg_fred_series"],
    )


def valuation_mart_as_known(staged: Mapping[str, DataFrame], raw_facts: DataFrame, contiguous: bool = False) -> DataFrame:
    return known_by_day.valuation_as_known(
        staged["stg_yfinance_prices"],
        staged["stg_yfinance_valuation_snapshot"],
        known_by_day.fact_versions(raw_facts),
        staged["stg_fred_series"],
        contiguous,
        known_by_day.filing_days(staging.reported_facts(raw_facts)),
    )


def register_views(frames: Mapping[str, DataFrame]) -> None:
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


def write_mart(
    df: DataFrame, path: str, keys: list[str], not_null: Sequence[str] = (), name: str = "", placed_by: DataFrame | None = None
) -> DataFrame:
    """Replace a mart by ``df``, range-partitioned and sorted by its keys; return the table read back.

    Ranges follow the rows, so a ticker holding much of the data spans several files, and file
    statistics prune by ticker and date. Every row is computed once, counted and checked on the way. It is
    written once too where ``placed_by``, a table with about the same keys, is there to find the ranges in.
    """
    publish(df, path, not_null=not_null, sort_by=keys, name=name, placed_by=placed_by)
    return read_current(df.sparkSession, path, df.schema)


def build_warehouse(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    out_dir: str,
    gate: Mapping[str, Sequence[str]] = MART_KEYS,
    visibility: str = "last_filed",
    contiguous: bool = False,
) -> dict[str, DataFrame]:
    """Raw tables to marts on disk, each mart computed once from the ones before it.

    A mart with a null in one of its ``gate`` columns ends the build with an error: it isn't published,
    the table of before stays, and no mart that reads it is built. The default asks for the keys of
    every mart; ``gate=NOT_NULL_RULES`` asks for all published rules, also for ratios, which companies without
    liabilities or equity on file do not have.

    ``visibility="first_filed"`` values each day by what the filings had said by then
    (``plans.visibility``) instead of by each fact's last filing; the quarterly marts stay as they
    are. ``contiguous`` asks trailing totals for four quarters in a row.
    """
    if visibility not in ("last_filed", "first_filed"):
        raise ValueError(f"visibility is last_filed or first_filed, not {visibility}")
    staged = stage_all(raw)
    register_views(staged)
    marts: dict[str, DataFrame] = {}

    def emit(name: str, frame: DataFrame, placed_by: DataFrame | None = None) -> DataFrame:
        marts[name] = write_mart(frame, f"{out_dir.rstrip('/')}/{name}", MART_KEYS[name], gate.get(name, ()), name, placed_by)
        marts[name].createOrReplaceTempView(name)
        return marts[name]

    balance = emit("fct_balance_sheet_quarterly", statements.balance_sheet(staged["stg_edgar_facts"]))
    income = emit("fct_income_statement_quarterly", statements.income_statement(staged["stg_edgar_facts"], contiguous=contiguous))
    quarters = emit("fct_financials_quarterly", statements.financials(balance, income), balance.select("ticker", "period_end"))
    days = staged["stg_yfinance_prices"].select("ticker", "price_date")
    if visibility == "first_filed":
        emit("fct_valuation_daily", valuation_mart_as_known(staged, raw["raw_edgar_facts"], contiguous), days)
    else:
        emit("fct_valuation_daily", valuation_mart(staged, quarters), days)
    return marts


def build_panels(marts: Mapping[str, DataFrame], out_dir: str) -> dict[str, DataFrame]:
    """The differenced panels and the rate's days as tables, each from one scan of the daily mart."""
    daily, root = marts["fct_valuation_daily"], out_dir.rstrip("/")

    def emit(name: str, frame: DataFrame) -> DataFrame:
        return write_mart(frame, f"{root}/{name}", PANEL_KEYS[name])

    rates = emit("rate_days", rate_sensitivity.rate_series(daily))
    changes = rate_sensitivity.quarterly_leverage_changes(marts["fct_financials_quarterly"], rates)
    return {
        "rate_days": rates,
        "monthly_changes": emit("monthly_changes", rate_sensitivity.monthly_changes(daily)),
        "quarterly_leverage_changes": emit("quarterly_leverage_changes", changes),
    }


def not_null_report(marts: Mapping[str, DataFrame]) -> DataFrame:
    return check_not_null(marts, NOT_NULL_RULES)
