"""Every registered query: (spark, sf_dir) -> DataFrame over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fixtures import adapter
from ledgerline.dims import POLICY_RATE, TAG_ALIASES, alias_dim, padded_ids
from ledgerline.operators.aliases import floor_date, missing_concepts, resolve_aliases
from ledgerline.operators.asof import asof_join
from ledgerline.operators.latest import latest_by
from ledgerline.operators.pivot import conditional_pivot
from ledgerline.operators.series import resample_last
from ledgerline.plans import rate_sensitivity as rs
from ledgerline.plans import serving, staging, statements, summary, valuation, visibility, warehouse
from ledgerline.schemas import FINANCIALS, RAW_FACTS
from ledgerline.sources import landing, payloads

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# Both engines sum floating point in their own order; fits agree to far more digits than these.
FIT_DIGITS = 6


def register(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def rounded(df: DataFrame, digits: int = FIT_DIGITS, skip: tuple[str, ...] = ()) -> DataFrame:
    return df.select(
        *[
            F.round(name, digits).alias(name) if kind == "double" and name not in skip else F.col(name)
            for name, kind in df.dtypes
        ]
    )


# ---- shared frames --------------------------------------------------------------------


FACTS = "raw_edgar_facts"
PRICES = "raw_yfinance_prices"
SNAPSHOT = "raw_yfinance_valuation_snapshot"
SERIES = "raw_fred_series"


def _staged(spark: SparkSession, sf_dir: str, *tables: str) -> dict[str, DataFrame]:
    return warehouse.stage_all(adapter.raw_tables(spark, sf_dir, tables))


def _market_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = _staged(spark, sf_dir, PRICES, SNAPSHOT)
    return valuation.market_caps(staged["stg_yfinance_prices"], staged["stg_yfinance_valuation_snapshot"])


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(spark, sf_dir, FACTS)["stg_edgar_facts"]


def _stored(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A mart or panel as its readers find it: a written table."""
    return adapter.marts(spark, sf_dir)[name]


def _quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "fct_financials_quarterly")


def _valuation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "fct_valuation_daily")


def display_list(spark: SparkSession, sf_dir: str) -> list[str]:
    """The companies a reader of the report picked: the first five of the company list."""
    first = adapter.companies(spark, sf_dir).filter("position > 0").orderBy("position").limit(5)
    return [r.ticker for r in first.collect()]


# ---- sources --------------------------------------------------------------------------


@register
def flatten_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = payloads.flatten_company_concept(adapter.concept_documents(spark, sf_dir), "payload")
    return payloads.raw_facts(flat, start="1996-01-01")


@register
def flatten_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.flatten_series(adapter.series_documents(spark, sf_dir), "payload")


@register
def shape_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    shaped = payloads.shape_prices(adapter.price_download(spark, sf_dir))
    return shaped.withColumn("date", F.col("date").cast("date"))


@register
def shape_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.shape_snapshot(adapter.snapshot_documents(spark, sf_dir), "payload")


@register
def union_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = adapter.fact_entries(spark, sf_dir)
    instants = entries.filter(F.col("start").isNull()).drop("start")
    flows = entries.filter(F.col("start").isNotNull())
    return payloads.union_tolerant([instants, flows], RAW_FACTS.fieldNames())


@register
def alias_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = floor_date(adapter.fact_entries(spark, sf_dir), "end", "1996-01-01")
    return resolve_aliases(entries, alias_dim(spark))


@register
def missing_concepts_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    companies = adapter.companies(spark, sf_dir)
    return missing_concepts(adapter.raw_tables(spark, sf_dir, [FACTS])[FACTS], companies, TAG_ALIASES)


@register
def company_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return padded_ids(adapter.companies(spark, sf_dir))


@register
def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.row_counts(adapter.raw_tables(spark, sf_dir))


@register
def loaded_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = adapter.loaded_database(spark, sf_dir)
    return landing.row_counts({name: spark.table(f"{database}.{name}") for name in landing.RAW_FILES})


@register
def warehouse_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = adapter.marts(spark, sf_dir)
    return landing.row_counts({name: built[name] for name in warehouse.MART_KEYS})


@register
def sorted_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quarterly mart by name and in order, next to one that was never built."""
    _quarters(spark, sf_dir).createOrReplaceTempView("sorted_mart_source")
    order = ["ticker", "period_end"]
    present = landing.read_mart(spark, "sorted_mart_source", FINANCIALS, order)
    absent = landing.read_mart(spark, "no_such_mart", FINANCIALS, order)
    placed = present.unionByName(absent).select("ticker", "period_end", "revenue", F.monotonically_increasing_id().alias("at"))
    before = F.lag("at").over(Window.partitionBy("ticker").orderBy("period_end"))
    return placed.withColumn("in_order", F.coalesce(F.col("at") > before, F.lit(True))).drop("at")


@register
def read_concept_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = payloads.read_company_concepts(spark, adapter.concept_files(spark, sf_dir))
    return payloads.raw_facts(flat, start="1996-01-01")


@register
def read_series_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.read_series(spark, adapter.series_files(spark, sf_dir))


@register
def read_price_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    shaped = payloads.read_prices(spark, adapter.price_files(spark, sf_dir))
    return shaped.withColumn("date", F.col("date").cast("date"))


@register
def read_snapshot_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads.read_snapshot(spark, adapter.snapshot_files(spark, sf_dir))


# ---- staging --------------------------------------------------------------------------


@register
def stage_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _facts(spark, sf_dir)


@register
def stage_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(spark, sf_dir, PRICES)["stg_yfinance_prices"]


@register
def stage_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(spark, sf_dir, SERIES)["stg_fred_series"]


@register
def stage_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(spark, sf_dir, SNAPSHOT)["stg_yfinance_valuation_snapshot"]


# ---- marts ----------------------------------------------------------------------------


@register
def balance_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statements.balance_sheet(_facts(spark, sf_dir))


@register
def fiscal_year_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statements.fiscal_year_buckets(_facts(spark, sf_dir))


@register
def q4_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statements.derived_fourth_quarters(_facts(spark, sf_dir))


@register
def income_statement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statements.income_statement(_facts(spark, sf_dir))


@register
def financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.quarterly_marts(_staged(spark, sf_dir, FACTS))["fct_financials_quarterly"]


@register
def asof_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = _staged(spark, sf_dir, PRICES)["stg_yfinance_prices"].select("ticker", "price_date", "close_price")
    return asof_join(
        prices,
        _quarters(spark, sf_dir),
        "price_date",
        "filed_date",
        {"filed_date": "filed_date", "period_end": "period_end", "total_assets": "total_assets"},
        by=["ticker"],
        tiebreak=["period_end"],
    )


@register
def asof_keyless(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = _staged(spark, sf_dir, PRICES, SERIES)
    prices = staged["stg_yfinance_prices"].select("ticker", "price_date")
    rate = staged["stg_fred_series"].filter(F.col("series_id") == POLICY_RATE)
    return asof_join(prices, rate, "price_date", "obs_date", {"obs_date": "obs_date", "value": "value"})


@register
def valuation_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily mart from staged inputs and the stored quarterly mart."""
    return warehouse.valuation_mart(_staged(spark, sf_dir, PRICES, SNAPSHOT, SERIES), _quarters(spark, sf_dir))


@register
def income_statement_contiguous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trailing totals over the calendar; every third company lacks the second quarter of each fourth year."""
    number, end = F.substring("ticker", 2, 18).cast("long"), F.col("period_end")
    lacking = (number % 3 == 1) & (F.year(end) % 4 == 3) & (F.month(end) == 6)
    return statements.income_statement(_facts(spark, sf_dir).filter(~lacking), contiguous=True)


@register
def fact_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visibility.fact_versions(adapter.raw_tables(spark, sf_dir, [FACTS])[FACTS])


@register
def financials_first_filed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visibility.financials_as_known(fact_versions(spark, sf_dir))


@register
def valuation_first_filed(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = _staged(spark, sf_dir, PRICES, SNAPSHOT, SERIES)
    return warehouse.valuation_mart_as_known(staged, adapter.raw_tables(spark, sf_dir, [FACTS])[FACTS])


@register
def not_null_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warehouse.not_null_report(adapter.marts(spark, sf_dir))


# ---- rate sensitivity -----------------------------------------------------------------


@register
def monthly_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = _valuation(spark, sf_dir).filter(F.col("fed_funds_rate").isNotNull())
    return resample_last(
        rated, "ticker", "price_date", ["market_cap_approx", "ev_to_ebitda_approx", "fed_funds_rate"]
    )


@register
def monthly_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rs.monthly_changes(_valuation(spark, sf_dir))


@register
def quarterly_leverage_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rs.quarterly_leverage_changes(_quarters(spark, sf_dir), _stored(spark, sf_dir, "rate_days"))


@register
def ols_valuation_by_ticker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rs.valuation_regression(_stored(spark, sf_dir, "monthly_changes"), by_ticker=True))


@register
def ols_valuation_pooled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rs.valuation_regression(_stored(spark, sf_dir, "monthly_changes"), by_ticker=False))


@register
def ols_valuation_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = serving.select_tickers(_valuation(spark, sf_dir), display_list(spark, sf_dir))
    return rounded(rs.valuation_regression(rs.monthly_changes(chosen), by_ticker=False))


@register
def ols_leverage_by_ticker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rs.leverage_regression(_stored(spark, sf_dir, "quarterly_leverage_changes"), by_ticker=True))


@register
def ols_leverage_pooled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rs.leverage_regression(_stored(spark, sf_dir, "quarterly_leverage_changes"), by_ticker=False))


@register
def trendline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(serving.scatter_with_trend(_stored(spark, sf_dir, "monthly_changes"), "market_cap_pct_change"))


@register
def trendline_leverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(serving.scatter_with_trend(_stored(spark, sf_dir, "quarterly_leverage_changes"), "de_change"))


# ---- summaries and display frames -----------------------------------------------------


@register
def trend_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.rate_trend(_valuation(spark, sf_dir))


@register
def trend_market_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.market_cap_trend(_market_caps(spark, sf_dir))


@register
def trend_leverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.leverage_trend(_quarters(spark, sf_dir))


@register
def trend_summary_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.trend_lines(_quarters(spark, sf_dir), _valuation(spark, sf_dir), adapter.marts(spark, sf_dir))


@register
def report_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.trend_text(_quarters(spark, sf_dir), _valuation(spark, sf_dir), display_list(spark, sf_dir))


@register
def report_without_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report for a company that is listed but has neither prices nor filings: every guard for empty input at once."""
    return summary.trend_text(_quarters(spark, sf_dir), _valuation(spark, sf_dir), [adapter.EXTRA_TICKER])


@register
def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = adapter.companies(spark, sf_dir).select("ticker", "position")
    return serving.latest_snapshot(_quarters(spark, sf_dir), order)


@register
def ratio_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leverage and the liquidity line of every ticker, named by their ratio."""
    lines = [serving.ratio_lines(_quarters(spark, sf_dir), ratio) for ratio in ("debt_to_equity", "current_ratio")]
    named = [df.select("period_end", "ticker", F.lit(df.columns[2]).alias("ratio"), F.col(df.columns[2]).alias("value")) for df in lines]
    return named[0].unionByName(named[1])


@register
def indexed_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.indexed_market_cap(_market_caps(spark, sf_dir))


@register
def rate_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rs.rate_series(_valuation(spark, sf_dir))


@register
def multiple_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.multiple_lines(_valuation(spark, sf_dir))


@register
def grounding_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.grounding_table(_quarters(spark, sf_dir))


@register
def grounding_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = serving.grounding_table(_quarters(spark, sf_dir)).schema
    return spark.read.schema(columns).csv(adapter.grounding_files(spark, sf_dir), header=True)


# ---- the general operators on the plain tables ----------------------------------------


@register
def latest_event_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    newest = latest_by(events, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()])
    return newest.select("user_id", "event_id", "event_type", "value", "props")


@register
def status_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    by_status = {"O": "max_open", "F": "max_filled", "P": "max_pending"}
    return conditional_pivot(
        orders, ["o_custkey"], "o_orderstatus", "o_totalprice", by_status, extra=[F.count(F.lit(1)).alias("n_orders")]
    )
