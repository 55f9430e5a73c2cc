from datetime import date

from ledgerline.plans.valuation import valuation_daily
from ledgerline.schemas import FINANCIALS

D = date.fromisoformat


def quarters(spark, rows):
    blank = {name: None for name in FINANCIALS.fieldNames()}
    return spark.createDataFrame([tuple({**blank, **r}.values()) for r in rows], FINANCIALS)


def test_valuation_uses_only_public_complete_quarters(spark, rows):
    prices = spark.createDataFrame(
        [("A", D("2022-04-30"), 10.0), ("A", D("2022-05-01"), 10.0), ("A", D("2022-09-01"), 10.0), ("B", D("2022-09-01"), 3.0), ("C", D("2022-09-01"), 1.0)],
        "ticker string, price_date date, close_price double",
    )
    snapshot = spark.createDataFrame([("A", 100), ("B", None)], "ticker string, shares_outstanding bigint")
    fin = quarters(
        spark,
        [
            dict(ticker="A", period_end=D("2022-03-31"), filed_date=D("2022-05-01"), ebitda_ttm=50, total_debt=30, cash_and_equivalents=10),
            # newer but without a trailing total: must not hide the older one
            dict(ticker="A", period_end=D("2022-06-30"), filed_date=D("2022-08-01"), ebitda_ttm=None, total_debt=99),
        ],
    )
    rate = spark.createDataFrame(
        [("FEDFUNDS", D("2022-05-01"), 0.75), ("DGS10", D("2022-08-01"), 9.0)], "series_id string, obs_date date, value double"
    )
    out = valuation_daily(prices, snapshot, fin, rate)
    assert rows(
        out, "ticker", "price_date", "market_cap_approx", "latest_filed_period_end", "enterprise_value_approx", "ev_to_ebitda_approx", "fed_funds_rate"
    ) == [
        ("A", D("2022-04-30"), 1000.0, None, 1000.0, None, None),
        ("A", D("2022-05-01"), 1000.0, D("2022-03-31"), 1020.0, 20.4, 0.75),
        ("A", D("2022-09-01"), 1000.0, D("2022-03-31"), 1020.0, 20.4, 0.75),
        ("B", D("2022-09-01"), None, None, None, None, 0.75),
    ]


def test_same_day_filings_show_the_latest_period(spark, rows):
    prices = spark.createDataFrame([("A", D("2022-09-01"), 1.0)], "ticker string, price_date date, close_price double")
    snapshot = spark.createDataFrame([("A", 1)], "ticker string, shares_outstanding bigint")
    fin = quarters(
        spark,
        [
            dict(ticker="A", period_end=D("2022-03-31"), filed_date=D("2022-08-01"), ebitda_ttm=1),
            dict(ticker="A", period_end=D("2022-06-30"), filed_date=D("2022-08-01"), ebitda_ttm=2),
        ],
    )
    rate = spark.createDataFrame([], "series_id string, obs_date date, value double")
    out = valuation_daily(prices, snapshot, fin, rate)
    assert rows(out, "latest_filed_period_end", "ebitda_ttm", "fed_funds_rate") == [(D("2022-06-30"), 2, None)]


def test_readers_of_the_rate_skip_the_statement_join(spark):
    prices = spark.createDataFrame([("A", D("2022-09-01"), 1.0)], "ticker string, price_date date, close_price double")
    snapshot = spark.createDataFrame([("A", 1)], "ticker string, shares_outstanding bigint")
    rate = spark.createDataFrame([("FEDFUNDS", D("2022-05-01"), 0.75)], "series_id string, obs_date date, value double")
    out = valuation_daily(prices, snapshot, quarters(spark, []), rate)
    plan = out.select("price_date", "fed_funds_rate").distinct()._jdf.queryExecution().optimizedPlan().toString()
    assert "ebitda_ttm" not in plan
