"""What was known on a day, by hand-worked filings; and trailing totals over the calendar."""

import re
from datetime import date

import pytest

from ledgerline import schemas
from ledgerline.plans import statements, staging, valuation, visibility, warehouse

QUARTERS = [("2020-01-01", "2020-03-31"), ("2020-04-01", "2020-06-30"), ("2020-07-01", "2020-09-30"), ("2020-10-01", "2020-12-31")]


def fact(concept, start, end, filed, val, form="10-Q", ticker="A"):
    return (ticker, concept, "t", form, 2020, "FY", start, end, filed, val)


def year(filed=("2020-05-01", "2020-08-01", "2020-11-01", "2021-02-15"), amounts=(10, 20, 30, 100), ticker="A"):
    """Three quarters and an annual amount, with total assets at every end."""
    out = []
    for k, ((start, end), day) in enumerate(zip(QUARTERS, filed, strict=True)):
        out.append(fact("assets", None, end, day, 1000 + k, ticker=ticker))
        if k < 3:
            out.append(fact("operating_income", start, end, day, amounts[k], ticker=ticker))
    out.append(fact("operating_income", "2020-01-01", "2020-12-31", filed[3], amounts[3], "10-K", ticker))
    return out


def raw(spark, rows):
    return spark.createDataFrame(rows, schemas.RAW_FACTS)


def test_versions_follow_each_other(spark, rows):
    got = visibility.fact_versions(
        raw(
            spark,
            [
                fact("assets", None, "2020-03-31", "2020-05-01", 1),
                fact("assets", "", "2020-03-31", "2021-05-01", 2),
                fact("assets", None, "2020-03-31", "2021-05-01", 3, form="10-K"),
                fact("assets", None, "2020-03-31", "2022-05-01", 9, form="8-K"),
                fact("assets", None, "2020-03-31", None, 9),
            ],
        )
    )
    # Of the two of 2021-05-01 the form decides, as in the default.
    assert rows(got, "val", "known_from", "known_to") == [(1, date(2020, 5, 1), date(2021, 5, 1)), (3, date(2021, 5, 1), None)]


def test_a_restatement_shows_from_its_own_filing_on(spark, rows):
    restated = [fact("operating_income", *QUARTERS[1], "2021-08-01", 25), fact("assets", None, QUARTERS[1][1], "2021-08-01", 1001)]
    versions = visibility.fact_versions(raw(spark, year() + restated))
    known = visibility.financials_as_known(versions).filter("period_end >= '2020-06-30'")
    expected = [
        # No annual period is known before the year's report, so its quarters have no fiscal year and no income row yet.
        (date(2020, 12, 31), 35, 100, date(2021, 8, 1), None),
        (date(2020, 12, 31), 40, 100, date(2021, 2, 15), date(2021, 8, 1)),
        (date(2020, 6, 30), 20, None, date(2021, 2, 15), date(2021, 8, 1)),
        (date(2020, 6, 30), 25, None, date(2021, 8, 1), None),
        (date(2020, 6, 30), None, None, date(2020, 8, 1), date(2021, 2, 15)),
        (date(2020, 9, 30), 30, None, date(2021, 2, 15), None),
        (date(2020, 9, 30), None, None, date(2020, 11, 1), date(2021, 2, 15)),
    ]
    got = rows(known, "period_end", "operating_income", "ebitda_ttm", "known_from", "known_to")
    assert got == sorted(expected, key=lambda r: tuple(map(str, r)))


def daily(spark, facts, days, **options):
    prices = spark.createDataFrame([("A", date.fromisoformat(d), 2.0, 1) for d in days], "ticker string, price_date date, close_price double, volume long")
    shot = spark.createDataFrame([("A", 100)], "ticker string, shares_outstanding long")
    series = spark.createDataFrame([("FEDFUNDS", date(2019, 1, 1), 0.5)], "series_id string, obs_date date, value double")
    return visibility.valuation_as_known(prices, shot, visibility.fact_versions(facts), series, **options)


def test_valuation_by_what_was_known(spark, rows):
    late = [fact("operating_income", *QUARTERS[2], "2022-03-01", 35), fact("operating_income", "2020-01-01", "2020-12-31", "2022-03-01", 120, "10-K")]
    days = ["2020-06-01", "2021-02-14", "2021-02-15", "2022-02-28", "2022-03-01", "2023-01-01"]
    got = daily(spark, raw(spark, year() + late), days)
    assert rows(got, "price_date", "latest_filed_period_end", "ebitda_ttm", "market_cap_approx", "ev_to_ebitda_approx") == [
        (date(2020, 6, 1), None, None, 200.0, None),
        (date(2021, 2, 14), None, None, 200.0, None),
        (date(2021, 2, 15), date(2020, 12, 31), 100, 200.0, 2.0),
        (date(2022, 2, 28), date(2020, 12, 31), 100, 200.0, 2.0),
        (date(2022, 3, 1), date(2020, 12, 31), 120, 200.0, 1.67),
        (date(2023, 1, 1), date(2020, 12, 31), 120, 200.0, 1.67),
    ]


def test_default_hides_what_the_option_shows(spark, rows):
    """A comparative filed a year later hides the quarter until then by default."""
    repeated = [fact("operating_income", "2020-01-01", "2020-12-31", "2022-02-15", 100, "10-K")]
    facts = raw(spark, year() + repeated)
    staged = staging.stage_facts(facts)
    quarters = statements.financials(statements.balance_sheet(staged), statements.income_statement(staged))
    prices = spark.createDataFrame([("A", date(2021, 6, 1))], "ticker string, price_date date")
    assert rows(valuation.with_public_financials(prices, quarters, "price_date"), "ebitda_ttm") == [(None,)]
    assert rows(daily(spark, facts, ["2021-06-01"]), "ebitda_ttm") == [(100,)]


def test_a_state_without_any_total_says_so(spark, rows):
    # The restated year end belongs to no quarter any more: four quarters lie in the year, none is derived.
    fourth = [fact("operating_income", *QUARTERS[3], "2021-06-01", None)]
    got = daily(spark, raw(spark, year() + fourth), ["2021-05-31", "2021-06-01"])
    assert rows(got, "price_date", "ebitda_ttm") == [(date(2021, 5, 31), 100), (date(2021, 6, 1), None)]


def test_empty_facts(spark):
    assert visibility.financials_as_known(visibility.fact_versions(raw(spark, []))).count() == 0
    assert daily(spark, raw(spark, []), ["2021-01-01"]).first()["ebitda_ttm"] is None


def test_trailing_totals_over_the_calendar(spark, rows):
    """Two years; the second lacks its second quarter, so its fourth isn't derived either."""
    second = [(s.replace("2020", "2021"), e.replace("2020", "2021")) for s, e in QUARTERS]
    facts = year() + [fact("operating_income", *second[k], "2022-02-15", 50 + k) for k in (0, 2)]
    facts += [fact("operating_income", "2021-01-01", "2021-12-31", "2022-02-15", 400, "10-K")]
    staged = staging.stage_facts(raw(spark, facts))
    by_rows = rows(statements.income_statement(staged), "period_end", "ebitda_ttm", "trailing_quarters_available")
    assert by_rows[4:] == [(date(2021, 3, 31), 140, 4), (date(2021, 9, 30), 172, 4)]
    by_days = rows(statements.income_statement(staged, contiguous=True), "period_end", "ebitda_ttm", "trailing_quarters_available")
    assert by_days[:5] == by_rows[:5] and by_days[5] == (date(2021, 9, 30), 52 + 50 + 40, 3)


def test_warehouse_options(spark, tmp_path):
    with pytest.raises(ValueError, match="visibility is"):
        warehouse.build_warehouse(spark, {}, str(tmp_path), visibility="never")


def test_each_state_reads_as_the_default_on_what_was_filed(spark, rows):
    """Runs put back into states are, day by day, the default's statements of the filings up to the day."""
    late = [fact("operating_income", *QUARTERS[0], "2021-08-01", 12), fact("assets", None, QUARTERS[0][1], "2021-09-01", 7)]
    late.append(fact("operating_income", *QUARTERS[0], "2021-10-01", 10))  # back to the first version
    again = [fact("assets", None, QUARTERS[1][1], "2020-12-01", None, ticker="B"), fact("assets", None, QUARTERS[1][1], "2021-01-01", 5, ticker="B")]
    nobody = [fact("assets", None, QUARTERS[1][1], "2020-12-01", 1, ticker=None)]
    facts = raw(spark, year() + late + year(ticker="B") + again + nobody)
    known = visibility.financials_as_known(visibility.fact_versions(facts))
    read = [c for c in known.columns if not c.startswith("known_")]
    for day in ("2020-05-01", "2020-12-01", "2021-01-01", "2021-02-15", "2021-08-01", "2021-09-01", "2021-10-01"):
        staged = staging.stage_facts(facts.filter(f"filed <= '{day}' and ticker is not null"))
        expected = statements.financials(statements.balance_sheet(staged), statements.income_statement(staged))
        then = known.filter(f"known_from <= '{day}' and (known_to is null or known_to > '{day}')")
        assert rows(then, *read) == rows(expected, *read), day


def test_rows_of_states_are_not_shuffled(spark):
    """Only versions and runs travel: by period, by company, by company and quarter."""
    versions = visibility.fact_versions(raw(spark, year()))
    plan = visibility.financials_as_known(versions)._jdf.queryExecution().executedPlan().toString()
    dealt = {tuple(re.findall(r"(\w+)#", keys)) for keys in re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)}
    assert dealt <= {("ticker", "concept", "start", "end", "filed"), ("ticker",), ("ticker", "period_end")}


def test_facts_are_listed_under_their_own_periods_changes_only(spark, rows):
    """Rows grow with the versions; a quarter that is never filed again is one row, however many states follow it."""
    ends = [f"{y}-{q}" for y in range(2001, 2011) for q in ("03-31", "06-30", "09-30", "12-31")]
    facts = [fact("assets", None, end, f"{end[:8]}28", k) for k, end in enumerate(ends)]
    facts += [fact("assets", None, ends[0], "2012-01-01", 99), fact("long_term_debt", None, ends[0], "2013-01-01", 7)]
    known = visibility.facts_as_known(visibility.fact_versions(raw(spark, facts)))
    assert known.count() == len(facts) and known.first()["_states"] == len(facts)
    balance = visibility._balance_in_runs(known)
    first = [(1, 40, 0, 0), (41, 41, 99, 0), (42, 42, 99, 7)]
    assert rows(balance, "_first", "_last", "total_assets", "total_debt") == sorted(
        first + [(k, 42, k - 1, 0) for k in range(2, 41)], key=lambda r: tuple(map(str, r))
    )


def test_filing_days_of_raw_facts_are_those_of_their_versions(spark, rows):
    again = [fact("assets", "", "2020-03-31", "2021-05-01", 2), fact("assets", None, "2020-03-31", "2022-05-01", 9, form="8-K")]
    nobody = [fact("assets", None, "2020-06-30", "2020-12-01", 1, ticker=None), fact("assets", None, "2020-06-30", None, 1)]
    facts = raw(spark, year() + year() + again + nobody)
    days = visibility.filing_days(staging.reported_facts(facts))
    assert rows(days) == rows(visibility.filing_days(visibility.fact_versions(facts)))
    assert [d.isoformat() for _, d in rows(days)] == ["2020-05-01", "2020-08-01", "2020-11-01", "2021-02-15", "2021-05-01"]
    priced = ["2020-04-01", "2020-06-01", "2021-02-15", "2021-06-01"]
    assert rows(daily(spark, facts, priced, filed_on=days)) == rows(daily(spark, facts, priced))
