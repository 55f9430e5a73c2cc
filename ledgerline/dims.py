"""Small fixed dimensions: company universe, tag aliases, series."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---- fixed values -------------------------------------------------------------------

START_DATE = "2021-01-01"

# display order: (ticker, name, registry number)
COMPANIES = [
    ("MSFT", "Microsoft Corporation", "0000789019"),
    ("AAPL", "Apple Inc.", "0000320193"),
    ("GOOGL", "Alphabet Inc.", "0001652044"),
    ("AMZN", "Amazon.com, Inc.", "0001018724"),
    ("META", "Meta Platforms, Inc.", "0001326801"),
]

SERIES = ["FEDFUNDS", "DGS10"]
POLICY_RATE = "FEDFUNDS"

# concept -> tags that may carry it, best first
TAG_ALIASES = {
    "assets": ["Assets"],
    "assets_current": ["AssetsCurrent"],
    "liabilities": ["Liabilities"],
    "liabilities_current": ["LiabilitiesCurrent"],
    "stockholders_equity": [
        "StockholdersEquity",
        "StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest",
    ],
    "long_term_debt": ["LongTermDebtNoncurrent", "LongTermDebt"],
    "short_term_debt": ["LongTermDebtCurrent", "ShortTermBorrowings", "DebtCurrent"],
    "cash_and_equivalents": [
        "CashAndCashEquivalentsAtCarryingValue",
        "CashCashEquivalentsRestrictedCashAndRestrictedCashEquivalents",
    ],
    "operating_income": ["OperatingIncomeLoss"],
    "net_income": ["NetIncomeLoss"],
    "revenues": ["Revenues", "RevenueFromContractWithCustomerExcludingAssessedTax"],
    "depreciation_amortization": [
        "DepreciationDepletionAndAmortization",
        "DepreciationAmortizationAndAccretionNet",
        "DepreciationAndAmortization",
        "DepreciationAmortizationAndImpairment",
        "Depreciation",
    ],
}

# ---- frames -------------------------------------------------------------------------


def company_dim(spark: SparkSession, companies: Iterable[tuple[str, str, str]] = COMPANIES) -> DataFrame:
    """position, ticker, name and the registry number padded to ten digits."""
    rows = [(pos, *company) for pos, company in enumerate(companies)]
    return padded_ids(spark.createDataFrame(rows, "position int, ticker string, name string, number string"))


def padded_ids(listed: DataFrame) -> DataFrame:
    """A company list (position, ticker, name, number) with the ten-digit identifier ``cik``."""
    return listed.select("position", "ticker", "name", F.lpad(F.col("number").cast("string"), 10, "0").alias("cik"))


def company_names(companies: Iterable[tuple[str, str, str]] = COMPANIES) -> dict[str, str]:
    return {ticker: name for ticker, name, _ in companies}


def ticker_positions(spark: SparkSession, tickers: Iterable[str]) -> DataFrame:
    """An ordered display list as a frame: (ticker, position)."""
    return spark.createDataFrame(
        [(ticker, pos) for pos, ticker in enumerate(tickers)], "ticker string, position int"
    )


def alias_dim(spark: SparkSession, aliases: Mapping[str, list[str]] = TAG_ALIASES) -> DataFrame:
    """(concept, tag, priority); priority 0 is the preferred tag."""
    rows = [(concept, tag, i) for concept, tags in aliases.items() for i, tag in enumerate(tags)]
    return spark.createDataFrame(rows, "concept string, tag string, priority int")
