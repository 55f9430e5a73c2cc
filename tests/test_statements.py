from datetime import date

import pytest

from ledgerline.plans import staging, statements
from ledgerline.schemas import RAW_FACTS

D = date.fromisoformat


def fact(concept, start, end, val, filed=None, form="10-Q", tag="T", ticker="A", fy=None, fp=None):
    return (ticker, concept, tag, form, fy, fp, start, end, filed or end, val)


def staged(spark, facts):
    return staging.stage_facts(spark.createDataFrame(facts, RAW_FACTS))


def quarter(year, q, **values):
    ends = {1: "03-31", 2: "06-30", 3: "09-30", 4: "12-31"}
    starts = {1: "01-01", 2: "04-01", 3: "07-01", 4: "10-01"}
    return [fact(c, f"{year}-{starts[q]}", f"{year}-{ends[q]}", v) for c, v in values.items()]


def annual(year, **values):
    return [fact(c, f"{year}-01-01", f"{year}-12-31", v, filed=f"{year + 1}-02-01", form="10-K") for c, v in values.items()]


def test_dedupe_keeps_latest_version(spark, rows):
    facts = [
        fact("assets", None, "2022-03-31", 1, filed="2022-05-01"),
        fact("assets", "", "2022-03-31", 2, filed="2023-05-01"),  # empty start is the same instant
        fact("assets", None, "2022-03-31", 9, filed="2024-05-01", form="8-K"),
        fact("revenues", "2022-01-01", "2022-03-31", 5, filed="2022-05-01", form="10-Q"),
        fact("revenues", "2022-01-01", "2022-03-31", 6, filed="2022-05-01", form="10-K"),  # same day: form decides
    ]
    out = staged(spark, facts)
    assert rows(out, "concept", "period_start", "val", "period_length_days") == [
        ("assets", None, 2, None),
        ("revenues", D("2022-01-01"), 6, 89),
    ]
    again = staging.stage_facts(
        out.selectExpr(
            "ticker", "concept", "tag", "form", "fy", "fp", "cast(period_start as string) start",
            "cast(period_end as string) end", "cast(filed as string) filed", "val",
        )
    )
    assert rows(again) == rows(out)


def test_dedupe_filter_reaches_below_the_window(spark):
    plan = staged(spark, [fact("assets", None, "2022-03-31", 1)]).filter("period_start is null")
    below = plan._jdf.queryExecution().optimizedPlan().toString().split("Window [")[-1]
    assert "isnull(" in below


def test_balance_sheet_identity_and_debt(spark, rows):
    facts = [
        fact("assets", None, "2022-03-31", 100),
        fact("stockholders_equity", None, "2022-03-31", 30),
        fact("long_term_debt", None, "2022-03-31", 7, filed="2022-06-01"),
        fact("assets", None, "2022-06-30", 100),
        fact("liabilities", None, "2022-06-30", 60),
        fact("stockholders_equity", None, "2022-06-30", 30),
        fact("liabilities", None, "2022-09-30", 60),  # no assets: dropped
    ]
    out = statements.balance_sheet(staged(spark, facts))
    assert rows(out, "period_end", "filed_date", "total_liabilities", "total_debt") == [
        (D("2022-03-31"), D("2022-06-01"), 70, 7),
        (D("2022-06-30"), D("2022-06-30"), 60, 0),
    ]


def test_fourth_quarter_is_the_residual(spark, rows):
    facts = []
    for q, v in ((1, 10), (2, 20), (3, 30)):
        facts += quarter(2022, q, revenues=v, operating_income=v, net_income=v, depreciation_amortization=1)
    facts += annual(2022, revenues=100, operating_income=70, net_income=65)  # no annual D&A
    facts += quarter(2023, 1, operating_income=5)  # open year: not bucketed
    out = statements.income_statement(staged(spark, facts))
    got = rows(out, "fiscal_quarter", "period_start", "period_end", "revenue", "depreciation_amortization", "ebitda", "ebitda_ttm", "trailing_quarters_available")
    assert got == [
        ("Q1", D("2022-01-01"), D("2022-03-31"), 10, 1, 11, 11, 1),
        ("Q2", D("2022-04-01"), D("2022-06-30"), 20, 1, 21, 32, 2),
        ("Q3", D("2022-07-01"), D("2022-09-30"), 30, 1, 31, 63, 3),
        ("Q4", D("2022-09-30"), D("2022-12-31"), 40, None, 10, 73, 4),
    ]
    derived = statements.derived_fourth_quarters(staged(spark, facts))
    assert rows(derived, "filed_date", "net_income") == [(D("2023-02-01"), 5)]
    # the four quarters add up to the year
    total = out.selectExpr("sum(revenue) r", "sum(operating_income) o", "sum(net_income) n").first()
    assert (total.r, total.o, total.n) == (100, 70, 65)


@pytest.mark.parametrize("reported, expected", [([2, 3], 2), ([1, 2, 3], 4), ([1, 2, 3, 4], 4)])
def test_only_three_quarters_derive_a_fourth(spark, reported, expected):
    facts = annual(2022, operating_income=100)
    for q in reported:
        facts += quarter(2022, q, operating_income=q)
    out = statements.income_statement(staged(spark, facts))
    assert out.count() == expected


def test_first_bucket_is_unbounded(spark, rows):
    facts = annual(2023, operating_income=100)
    for year in (2022, 2023):
        for q in (1, 2, 3):
            facts += quarter(year, q, operating_income=1)
    buckets = statements.fiscal_year_buckets(staged(spark, facts))
    assert rows(buckets, "fiscal_year_end", "prior_fiscal_year_end", "quarters", "revenue_total", "operating_income_total") == [
        (D("2023-12-31"), None, 6, None, 6)
    ]


def test_extra_annual_period_opens_a_bucket(spark, rows):
    facts = annual(2022, operating_income=100)
    facts += [fact("operating_income", "2021-07-01", "2022-06-30", 90, form="10-Q")]  # trailing year mid-year
    for q in (1, 2, 3):
        facts += quarter(2022, q, operating_income=q)
    buckets = statements.fiscal_year_buckets(staged(spark, facts))
    assert rows(buckets, "fiscal_year_end", "prior_fiscal_year_end", "quarters") == [
        (D("2022-06-30"), None, 2),
        (D("2022-12-31"), D("2022-06-30"), 1),
    ]


def test_quarter_without_operating_income_is_dropped_before_the_trailing_count(spark, rows):
    facts = annual(2022, operating_income=100, revenues=100)
    facts += quarter(2022, 1, operating_income=1) + quarter(2022, 2, revenues=1) + quarter(2022, 3, operating_income=3)
    out = statements.income_statement(staged(spark, facts))
    assert rows(out, "fiscal_quarter", "operating_income", "trailing_quarters_available") == [
        ("Q1", 1, 1), ("Q2", 3, 2), ("Q3", 96, 3),
    ]


def test_financials_keep_unmatched_balance_rows_and_gate_ttm(spark, rows):
    facts = annual(2022, operating_income=10)
    for q in (1, 2, 3):
        facts += quarter(2022, q, operating_income=1)
    for end in ("2022-03-31", "2022-12-31", "2023-03-31"):
        facts += [
            fact("assets", None, end, 10, filed="2022-01-01"),
            fact("stockholders_equity", None, end, 4, filed="2022-01-01"),
            fact("liabilities_current", None, end, 0, filed="2022-01-01"),
            fact("assets_current", None, end, 5, filed="2022-01-01"),
            fact("long_term_debt", None, end, 3, filed="2022-01-01"),
        ]
    base = staged(spark, facts)
    out = statements.financials(statements.balance_sheet(base), statements.income_statement(base))
    assert rows(out, "period_end", "filed_date", "current_ratio", "debt_to_equity", "liabilities_to_assets", "operating_income", "ebitda_ttm") == [
        (D("2022-03-31"), D("2022-03-31"), None, 0.75, 0.6, 1, None),
        (D("2022-12-31"), D("2023-02-01"), None, 0.75, 0.6, 7, 10),
        (D("2023-03-31"), D("2022-01-01"), None, 0.75, 0.6, None, None),
    ]


def test_duration_bounds_are_parameters(spark):
    facts = annual(2022, operating_income=10) + [fact("operating_income", "2022-01-01", "2022-04-15", 1)]  # 104 days
    base = staged(spark, facts)
    assert statements.fiscal_year_buckets(base).count() == 0
    assert statements.fiscal_year_buckets(base, quarter_days=(80, 110)).first().quarters == 1


def test_income_statement_shuffles_three_times_and_joins_nothing(spark):
    facts = quarter(2022, 1, operating_income=1) + annual(2022, operating_income=10)
    raw = spark.createDataFrame(facts, RAW_FACTS).repartition(4)
    plan = statements.income_statement(staging.stage_facts(raw))._jdf.queryExecution().executedPlan().toString()
    # dedupe on the fact key, pivot on the period, then one exchange on ticker for all windows
    assert plan.count("Exchange hashpartitioning(") == 3 and "Join" not in plan
