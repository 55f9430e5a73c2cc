from datetime import date, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerline.plans import rate_sensitivity as rs
from ledgerline.plans import serving, summary
from ledgerline.schemas import FINANCIALS, VALUATION
from tests.test_regression import series_p

TICKERS = ["MSFT", "AAPL", "META"]


@pytest.fixture(scope="module")
def panels(spark):
    """Two small marts and the same data in pandas."""
    val, fin = [], []
    for i, ticker in enumerate(TICKERS):
        for d in range(0, 1100, 2):
            day = date(2021, 1, 4) + timedelta(days=d)
            if i == 1 and day.month == 7:
                continue  # a month without prices
            cap = 1000.0 + 37 * ((d * (i + 3)) % 101)
            rate = None if day < date(2021, 2, 1) else 0.25 * ((day.month * 7 + day.year) % 9)
            ev = None if d % 9 == 0 else round(cap / (50 + i), 2)
            val.append((ticker, day, 1.0, cap, None, 5, None, None, cap, ev, rate))
        for q in range(12):
            end = date(2021 + q // 4, 3 * (q % 4) + 3, 28)
            row = dict.fromkeys(FINANCIALS.fieldNames())
            row |= dict(ticker=ticker, period_end=end, revenue=None if q == 11 else 100 + q, ebitda_ttm=7 * q)
            row |= dict(debt_to_equity=0.5 + 0.01 * ((q * (i + 2)) % 7), current_ratio=None if q == 5 else 1.0 + 0.1 * (q % 5))
            fin.append(tuple(row.values()))
    sval = spark.createDataFrame(val, VALUATION)
    sfin = spark.createDataFrame(fin, FINANCIALS)
    pval = pd.DataFrame(val, columns=VALUATION.fieldNames())
    pfin = pd.DataFrame(fin, columns=FINANCIALS.fieldNames())
    for frame, col in ((pval, "price_date"), (pfin, "period_end")):
        frame[col] = pd.to_datetime(frame[col])
    return sfin, sval, pfin, pval


def test_monthly_changes_by_hand(spark):
    days = [
        ("A", "2021-01-29", 100.0, 10.0, 1.0), ("A", "2021-01-30", None, None, None),  # the month's last known rate
        ("A", "2021-02-10", 90.0, 9.0, 1.0), ("A", "2021-02-26", 150.0, None, 1.5),
        ("A", "2021-04-30", 75.0, 6.0, 1.25),  # no March
        ("B", "2021-02-26", 0.0, 2.0, 1.5), ("B", "2021-03-31", 5.0, 3.0, 1.5),
    ]
    rows = [(t, date.fromisoformat(d), None, cap, None, None, None, None, None, ev, rate) for t, d, cap, ev, rate in days]
    got = {(r.ticker, str(r.price_date)): r[5:] for r in rs.monthly_changes(spark.createDataFrame(rows, VALUATION)).collect()}
    # April has no month before it to compare with; of a month's multiples the last known one counts.
    assert got == {
        ("A", "2021-02-01"): (pytest.approx(50.0), pytest.approx(-10.0), 0.5),
        ("B", "2021-03-01"): (None, pytest.approx(50.0), 0.0),
    }


def test_quarterly_changes_by_hand(spark):
    def quarter(end, debt, current):
        row = dict.fromkeys(FINANCIALS.fieldNames())
        row |= dict(ticker="A", period_end=date.fromisoformat(end), debt_to_equity=debt, current_ratio=current)
        return tuple(row.values())

    quarters = [quarter("2020-12-31", 1.0, 2.0), quarter("2021-03-31", 1.5, None), quarter("2021-06-30", 1.25, 3.0), quarter("2021-09-30", 2.0, 3.5)]
    days = [("2021-03-30", 0.25), ("2021-04-01", 9.0), ("2021-06-30", 1.0), ("2021-07-01", None)]
    rated = [("Z", date.fromisoformat(d), None, None, None, None, None, None, None, None, rate) for d, rate in days]
    out = rs.quarterly_leverage_changes(spark.createDataFrame(quarters, FINANCIALS), spark.createDataFrame(rated, VALUATION))
    got = {str(r.period_end): (str(r.price_date), r.de_change, r.cr_change, r.rate_change_pp) for r in out.collect()}
    assert got == {"2021-06-30": ("2021-06-30", -0.25, None, 0.75), "2021-09-30": ("2021-06-30", 0.75, 0.5, 0.0)}


def test_regression_tables(panels):
    _, sval, _, _ = panels
    changes = rs.monthly_changes(sval)
    pdf = changes.toPandas()
    for r in rs.valuation_regression(changes, by_ticker=True).collect():
        pairs = pdf[pdf.ticker == r.ticker][["rate_change_pp", "market_cap_pct_change"]].dropna()
        corr = pairs.corr().iloc[0, 1]
        assert r.months == len(pairs)
        assert r.market_cap_r2 == pytest.approx(corr**2)
        assert r.market_cap_pvalue == pytest.approx(series_p(len(pairs), corr**2), abs=1e-8)
        assert r.market_cap_beta == pytest.approx(corr * pairs.iloc[:, 1].std() / pairs.iloc[:, 0].std())
    pooled = {r.response: r for r in rs.valuation_regression(changes, by_ticker=False).collect()}
    assert set(pooled) == {"market_cap", "ev_ebitda"}
    assert pooled["market_cap"].n_companies == 3
    assert pooled["market_cap"].n == pdf[["rate_change_pp", "market_cap_pct_change"]].dropna().shape[0]


def test_empty_inputs_give_empty_results(panels):
    sfin, sval, _, _ = panels
    no_val, no_fin = sval.filter("false"), sfin.filter("false")
    assert rs.monthly_changes(no_val).count() == 0
    assert rs.valuation_regression(rs.monthly_changes(no_val), by_ticker=False).count() == 0
    assert rs.valuation_regression(rs.monthly_changes(no_val), by_ticker=True).count() == 0
    assert rs.quarterly_leverage_changes(no_fin, sval).count() == 0
    assert rs.quarterly_leverage_changes(sfin, no_val).count() == 0
    assert summary.rate_trend(no_val).count() == 0
    for quarters in (no_fin, sfin):
        assert [r.line for r in summary.trend_lines(quarters, no_val).collect()] == [summary.NO_DATA]


def test_unknown_values_leave_no_null_line(panels):
    sfin, sval, _, _ = panels
    flat = summary.trend_lines(sfin.withColumn("debt_to_equity", F.lit(1.5)), sval.withColumn("market_cap_approx", F.lit(0.0)))
    lines = [r.line for r in flat.collect()]
    assert None not in lines and "MSFT: approx. market cap changed nan% from 2021-01-04 to 2024-01-07." in [x[:79] for x in lines]


def test_market_cap_readers_need_no_asof_join(spark):
    from ledgerline.plans import valuation

    prices = spark.createDataFrame([("A", date(2021, 1, 4), 2.0, 1)], "ticker string, price_date date, close_price double, volume bigint")
    snapshot = spark.createDataFrame([("A", 3)], "ticker string, shares_outstanding bigint")
    caps = valuation.market_caps(prices, snapshot)
    for frame in (serving.indexed_market_cap(caps), summary.market_cap_trend(caps)):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert "_slot" not in plan and plan.count("Join") <= 3


def test_report_text(panels):
    sfin, sval, pfin, pval = panels
    lines = summary.trend_text(sfin, sval, ["MSFT", "AAPL", "META"]).first().text.split("\n")
    rates = pval.fed_funds_rate.dropna()
    assert lines[0].startswith(f"Fed funds rate: {rates.min():.2f}% (low) to {rates.max():.2f}% (peak) over 2021-02-01 to")
    assert [line.split(":")[0] for line in lines[1:4]] == ["AAPL", "META", "MSFT"]
    assert lines[4:6] == ["", summary.LEVERAGE_HEADING]
    first = pfin[pfin.ticker == "AAPL"].debt_to_equity
    assert lines[6].startswith(f"AAPL: debt/equity was {first.iloc[0]:.2f} as of 2021-03-28, peaked at {first.max():.2f}")
    assert lines[9] == "" and lines[10].startswith("Regression (month-over-month changes, pooled across all 3 companies")
    assert lines[14] == summary.NOTE
    assert lines[15].startswith(summary.CAP_BETAS_HEADING + "AAPL=") and lines[15].count("=") == 3
    assert lines[16].startswith(summary.DEBT_BETAS_HEADING + "AAPL=") and len(lines) == 17


def test_selection_pools_over_the_selection(panels):
    _, sval, _, _ = panels
    chosen = serving.select_tickers(sval, ["MSFT", "META", "NONE"])
    pooled = rs.valuation_regression(rs.monthly_changes(chosen), by_ticker=False).first()
    assert pooled.n_companies == 2
    assert serving.select_tickers(sval, None) is sval


def test_latest_snapshot_follows_the_display_list(panels, rows):
    sfin, _, _, _ = panels
    snap = serving.latest_snapshot(sfin, ["META", "GONE", "AAPL"])
    assert rows(snap, "position", "ticker", "period_end", "revenue", "ebitda_ttm") == [
        (0, "META", date(2023, 12, 28), 110, 70),
        (1, "GONE", None, None, None),
        (2, "AAPL", date(2023, 12, 28), 110, 70),
    ]
    shown = serving.display_snapshot(snap)
    assert shown.columns == ["Ticker", *serving.SNAPSHOT_LABELS.values()]
    assert [r.Ticker for r in shown.collect()] == ["META", "GONE", "AAPL"]


def test_chart_frames(panels, rows, tmp_path):
    sfin, sval, _, pval = panels
    indexed = serving.indexed_market_cap(sval).filter("ticker = 'MSFT'").orderBy("price_date").collect()
    caps = pval[pval.ticker == "MSFT"].market_cap_approx
    assert [r.market_cap_indexed for r in indexed] == pytest.approx(list(caps / caps.iloc[0] * 100))
    assert serving.multiple_lines(sval).count() == pval.ev_to_ebitda_approx.notna().sum()
    assert rs.rate_series(sval).count() == len(pval[["price_date", "fed_funds_rate"]].dropna().drop_duplicates())
    assert serving.ratio_lines(sfin, "current_ratio").columns == ["period_end", "ticker", "current_ratio"]
    serving.write_grounding_csv(sfin, str(tmp_path / "grounding"))
    back = sval.sparkSession.read.option("header", True).csv(str(tmp_path / "grounding"))
    assert back.columns == serving.GROUNDING_COLUMNS and back.count() == sfin.count()
    assert serving.grounding_table(sfin.drop("ebitda")).columns == [c for c in serving.GROUNDING_COLUMNS if c != "ebitda"]
