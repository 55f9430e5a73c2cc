"""Quarterly statements from staged facts: balance sheet, income statement, both combined."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.scalars import QUARTER_DAYS, YEAR_DAYS, duration_class, safe_ratio
from ledgerline.operators.pivot import conditional_pivot

# Concept -> statement column.
INSTANT_ITEMS = {
    "assets": "total_assets",
    "assets_current": "current_assets",
    "liabilities": "reported_liabilities",
    "liabilities_current": "current_liabilities",
    "stockholders_equity": "stockholders_equity",
    "long_term_debt": "long_term_debt",
    "short_term_debt": "short_term_debt",
    "cash_and_equivalents": "cash_and_equivalents",
}
DURATION_ITEMS = {
    "revenues": "revenue",
    "operating_income": "operating_income",
    "net_income": "net_income",
    "depreciation_amortization": "depreciation_amortization",
}
FLOWS = list(DURATION_ITEMS.values())
SPAN = ("span", "period_start", "period_end")  # which row of the income statement's facts

TRAILING_QUARTERS = 4
TRAILING_DAYS = 290  # fixed value: the ends of four quarters in a row lie within these

Days = tuple[int, int]  # inclusive bounds of a duration class

# Whose statements: one company's, or with more columns one company's in each state. Facts that are already
# partitioned by some of these columns are not exchanged again for the balance sheet and the income statement.
COMPANY = ("ticker",)


def balance_sheet(facts: DataFrame, by: Sequence[str] = COMPANY) -> DataFrame:
    """One row per (ticker, period_end) with total assets known.

    Liabilities not reported are assets minus equity; total debt is long plus short term, either
    taken as 0 when absent.
    """
    return balance_of(instant_rows(facts.filter("period_start is null"), by), by)


def instant_rows(facts: DataFrame, by: Sequence[str] = COMPANY, extra: Sequence[Column] = ()) -> DataFrame:
    """One row per period end with its balances, and what else ``extra`` aggregates."""
    filed = F.max("filed").alias("filed_date")
    return conditional_pivot(facts, [*by, "period_end"], "concept", "val", INSTANT_ITEMS, extra=[filed, *extra])


def balance_of(wide: DataFrame, by: Sequence[str] = COMPANY) -> DataFrame:
    """``balance_sheet`` of instant rows."""
    return wide.filter("total_assets is not null").selectExpr(
        *by,
        "period_end",
        "filed_date",
        "total_assets",
        "current_assets",
        "coalesce(reported_liabilities, total_assets - stockholders_equity) as total_liabilities",
        "current_liabilities",
        "stockholders_equity",
        "coalesce(long_term_debt, 0) + coalesce(short_term_debt, 0) as total_debt",
        "cash_and_equivalents",
    )


def reporting_periods(
    facts: DataFrame, quarter_days: Days = QUARTER_DAYS, year_days: Days = YEAR_DAYS, by: Sequence[str] = COMPANY
) -> DataFrame:
    """Quarter and year rows of the income statement, each labelled with its fiscal year end.

    Columns: ticker, span ('quarter' or 'year'), period_start (quarters only), period_end,
    filed_date, the four flows, fiscal_year_end. A quarter belongs to the first annual period
    ending on or after it; quarters past the last annual end have no label. Both kinds are
    pivoted in one aggregation, and the label is one ordered window per ticker over rows already
    reduced to reporting periods, so no range join is needed.
    """
    return labelled_periods(period_rows(reported_spans(facts, quarter_days, year_days, by), by), by)


def reported_spans(
    facts: DataFrame, quarter_days: Days = QUARTER_DAYS, year_days: Days = YEAR_DAYS, by: Sequence[str] = COMPANY
) -> DataFrame:
    """The facts of quarters and years with the columns of ``SPAN``; a year's start is null."""
    spans = facts.select(
        *by,
        "concept",
        "val",
        "filed",
        "period_end",
        duration_class("period_length_days", quarter_days, year_days).alias("span"),
        F.col("period_start").alias("_start"),
    )
    return spans.filter("span is not null").withColumn("period_start", F.expr("if(span = 'quarter', _start, null)"))


def period_rows(spans: DataFrame, by: Sequence[str] = COMPANY, extra: Sequence[Column] = ()) -> DataFrame:
    """One row per reported span with its flows, and what else ``extra`` aggregates."""
    filed = F.max("filed").alias("filed_date")
    return conditional_pivot(spans, [*by, *SPAN], "concept", "val", DURATION_ITEMS, extra=[filed, *extra])


def labelled_periods(periods: DataFrame, by: Sequence[str] = COMPANY) -> DataFrame:
    # Walking back in time, the last annual end seen is the bucket; years precede quarters on a tie.
    backwards = Window.partitionBy(*by).orderBy(F.desc("period_end"), F.desc("span"))
    year_end = F.expr("if(span = 'year', period_end, null)")
    return periods.withColumn("fiscal_year_end", F.last(year_end, ignorenulls=True).over(backwards))


def fiscal_year_buckets(facts: DataFrame, quarter_days: Days = QUARTER_DAYS, year_days: Days = YEAR_DAYS) -> DataFrame:
    """Totals of the quarters found in each fiscal year that has any.

    Columns: ticker, fiscal_year_end, prior_fiscal_year_end, quarters, last_quarter_end and the
    sums of the flows (null where no quarter reports the flow).
    """
    periods = reporting_periods(facts, quarter_days, year_days).filter("fiscal_year_end is not null")
    totals = periods.groupBy("ticker", "fiscal_year_end").agg(
        F.expr("count_if(span = 'quarter') as quarters"),
        F.expr("max(if(span = 'quarter', period_end, null)) as last_quarter_end"),
        *[F.expr(f"sum(if(span = 'quarter', {c}, null)) as {c}_total") for c in FLOWS],
    )
    # Every annual end is a bucket here, so the preceding one is a plain lag.
    prior = F.lag("fiscal_year_end").over(Window.partitionBy("ticker").orderBy("fiscal_year_end"))
    return (
        totals.withColumn("prior_fiscal_year_end", prior)
        .filter("quarters > 0")
        .select(
            "ticker",
            "fiscal_year_end",
            "prior_fiscal_year_end",
            "quarters",
            "last_quarter_end",
            *[f"{c}_total" for c in FLOWS],
        )
    )


def fiscal_quarters(
    facts: DataFrame, quarter_days: Days = QUARTER_DAYS, year_days: Days = YEAR_DAYS, by: Sequence[str] = COMPANY
) -> DataFrame:
    """Reported quarters inside a fiscal year plus the derived fourth ones.

    A fiscal year with exactly three reported quarters turns its annual row into the missing
    quarter: annual amount minus the three, null where either is null; it starts where the third
    quarter ends and is known from the annual filing. The totals are windows over the same ticker
    partitioning as the labels, so annual and quarterly rows are never joined.
    Columns: ticker, fiscal_year_end, derived, period_start, period_end, filed_date, flows.
    """
    return quarters_of(reporting_periods(facts, quarter_days, year_days, by), by)


def quarters_of(periods: DataFrame, by: Sequence[str] = COMPANY) -> DataFrame:
    """``fiscal_quarters`` of labelled periods."""
    bucket = f"over (partition by {', '.join(by)}, fiscal_year_end)"
    totalled = periods.filter("fiscal_year_end is not null").selectExpr(
        "*",
        "span = 'year' as derived",
        f"count_if(span = 'quarter') {bucket} as _quarters",
        f"max(if(span = 'quarter', period_end, null)) {bucket} as _third_end",
        *[f"sum(if(span = 'quarter', {c}, null)) {bucket} as _sum_{c}" for c in FLOWS],
    )
    return totalled.filter(f"not derived or _quarters = {TRAILING_QUARTERS - 1}").selectExpr(
        *by,
        "fiscal_year_end",
        "derived",
        "if(derived, _third_end, period_start) as period_start",
        "period_end",
        "filed_date",
        *[f"if(derived, {c} - _sum_{c}, {c}) as {c}" for c in FLOWS],
    )


def derived_fourth_quarters(facts: DataFrame, quarter_days: Days = QUARTER_DAYS, year_days: Days = YEAR_DAYS) -> DataFrame:
    return fiscal_quarters(facts, quarter_days, year_days).filter("derived").drop("derived")


def income_statement(
    facts: DataFrame,
    quarter_days: Days = QUARTER_DAYS,
    year_days: Days = YEAR_DAYS,
    contiguous: bool = False,
    by: Sequence[str] = COMPANY,
) -> DataFrame:
    """Fiscal quarters with operating income, EBITDA and its trailing four-row total.

    The trailing window counts rows, not calendar quarters: after a missing quarter four rows span
    more than a year. Equal period ends are ordered by period start. With ``contiguous`` the window is
    the calendar's instead: the quarters that ended in the ``TRAILING_DAYS`` days up to the row's end, so that
    fewer than four are available after a gap and ``financials`` shows no total. Both rows of
    two with one period end are in each other's window then.
    """
    return statement_of(fiscal_quarters(facts, quarter_days, year_days, by), contiguous, by)


def statement_of(quarters: DataFrame, contiguous: bool = False, by: Sequence[str] = COMPANY) -> DataFrame:
    """``income_statement`` of fiscal quarters."""
    company = ", ".join(by)
    if contiguous:
        day = "datediff(period_end, date'1970-01-01')"
        trailing = f"over (partition by {company} order by {day} range between {TRAILING_DAYS} preceding and current row)"
    else:
        trailing = (
            f"over (partition by {company} order by period_end, period_start"
            f" rows between {TRAILING_QUARTERS - 1} preceding and current row)"
        )
    return (
        quarters.filter("operating_income is not null")
        .withColumn("ebitda", F.expr("operating_income + coalesce(depreciation_amortization, 0)"))
        .selectExpr(
            *by,
            "fiscal_year_end",
            f"concat('Q', row_number() over (partition by {company}, fiscal_year_end"
            " order by period_end, period_start)) as fiscal_quarter",
            "period_start",
            "period_end",
            "filed_date",
            *FLOWS,
            "ebitda",
            f"sum(ebitda) {trailing} as ebitda_ttm",
            f"count(*) {trailing} as trailing_quarters_available",
        )
    )


def financials(balance: DataFrame, income: DataFrame, by: Sequence[str] = COMPANY) -> DataFrame:
    """Balance sheet rows with ratios and, where it exists, the quarter's income row.

    The trailing total is shown only when four rows went into it; the row is known from the
    later of the two filings.
    """
    return combined(balance.join(shown_flows(income, by), [*by, "period_end"], "left"), by)


def shown_flows(income: DataFrame, by: Sequence[str] = COMPANY) -> DataFrame:
    """What the combined statement takes from the income statement."""
    return income.selectExpr(
        *by,
        "period_end",
        "filed_date as _income_filed",
        "revenue",
        "operating_income",
        "net_income",
        "ebitda",
        f"if(trailing_quarters_available = {TRAILING_QUARTERS}, ebitda_ttm, null) as ebitda_ttm",
    )


def combined(joined: DataFrame, by: Sequence[str] = COMPANY) -> DataFrame:
    """The combined statement from balance sheet rows that hold their ``shown_flows``."""
    return joined.select(
        *by,
        "period_end",
        F.greatest("filed_date", "_income_filed").alias("filed_date"),
        "total_assets",
        "current_assets",
        "total_liabilities",
        "current_liabilities",
        "stockholders_equity",
        "total_debt",
        "cash_and_equivalents",
        safe_ratio("current_assets", "current_liabilities").alias("current_ratio"),
        safe_ratio("total_debt", "stockholders_equity").alias("debt_to_equity"),
        safe_ratio("total_liabilities", "total_assets").alias("liabilities_to_assets"),
        "revenue",
        "operating_income",
        "net_income",
        "ebitda",
        "ebitda_ttm",
    )
