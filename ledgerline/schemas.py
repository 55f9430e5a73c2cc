"""Declared schemas of the raw inputs. Raw reads never infer."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


_S, _I, _L, _D = StringType(), IntegerType(), LongType(), DoubleType()

RAW_FACTS = _struct(
    ticker=_S, concept=_S, tag=_S, form=_S, fy=_I, fp=_S, start=_S, end=_S, filed=_S, val=_L,
)
RAW_PRICES = _struct(date=TimestampNTZType(), close=_D, volume=_L, ticker=_S)
RAW_SNAPSHOT = _struct(
    ticker=_S,
    market_cap=_L,
    enterprise_value=_L,
    trailing_pe=_D,
    forward_pe=_D,
    ev_to_ebitda=_D,
    shares_outstanding=_L,
    total_debt=_L,
    total_cash=_L,
)
RAW_SERIES = _struct(date=_S, value=_D, series_id=_S)

RAW_TABLES = {
    "raw_edgar_facts": RAW_FACTS,
    "raw_yfinance_prices": RAW_PRICES,
    "raw_yfinance_valuation_snapshot": RAW_SNAPSHOT,
    "raw_fred_series": RAW_SERIES,
}

# Landed payload documents.
# Numbers are read as decimals, since whole ones also come with a fraction of zero.
_N = DecimalType(38, 6)
FACT_ENTRY = _struct(
    start=_S, end=_S, val=_N, accn=_S, fy=_N, fp=_S, form=_S, filed=_S, frame=_S,
)
CONCEPT_PAYLOAD = _struct(units=_struct(USD=ArrayType(FACT_ENTRY)))
SERIES_PAYLOAD = _struct(observations=ArrayType(_struct(date=_S, value=_S)))
SNAPSHOT_PAYLOAD = _struct(
    marketCap=_N,
    enterpriseValue=_N,
    trailingPE=_D,
    forwardPE=_D,
    enterpriseToEbitda=_D,
    sharesOutstanding=_N,
    totalDebt=_N,
    totalCash=_N,
)

# Marts, needed where an absent table must still give a typed empty frame.
FINANCIALS = _struct(
    ticker=_S,
    period_end=DateType(),
    filed_date=DateType(),
    total_assets=_L,
    current_assets=_L,
    total_liabilities=_L,
    current_liabilities=_L,
    stockholders_equity=_L,
    total_debt=_L,
    cash_and_equivalents=_L,
    current_ratio=_D,
    debt_to_equity=_D,
    liabilities_to_assets=_D,
    revenue=_L,
    operating_income=_L,
    net_income=_L,
    ebitda=_L,
    ebitda_ttm=_L,
)
VALUATION = _struct(
    ticker=_S,
    price_date=DateType(),
    close_price=_D,
    market_cap_approx=_D,
    latest_filed_period_end=DateType(),
    ebitda_ttm=_L,
    reported_total_debt=_L,
    cash_and_equivalents=_L,
    enterprise_value_approx=_D,
    ev_to_ebitda_approx=_D,
    fed_funds_rate=_D,
)
