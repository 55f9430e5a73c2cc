"""Every registered query against its DuckDB equivalent on the smallest test tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_point
from fixtures import oracle
from fixtures.adapter import companies, marts, raw_tables
from fixtures.compare import differences, duck
from fixtures.queries import REGISTRY, _staged
from ledgerline.operators.quality import duplicate_keys, require_clean
from ledgerline.plans import statements, warehouse

QUERIES = REGISTRY
ORACLE = oracle.all_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= entry_point.queries().keys() and ORACLE.keys() <= entry_point.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    assert differences(QUERIES[name](spark, sf_dir), con.sql(ORACLE[name])) == []


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


def test_documented_grains(spark, sf_dir):
    built = marts(spark, sf_dir)
    quarters, valuation = built["fct_financials_quarterly"], built["fct_valuation_daily"]
    staged = _staged(spark, sf_dir, "raw_edgar_facts")
    income = statements.income_statement(staged["stg_edgar_facts"])
    for frame, keys in [
        (staged["stg_edgar_facts"], ["ticker", "concept", "period_start", "period_end"]),
        (income, ["ticker", "fiscal_year_end", "fiscal_quarter"]),
        (quarters, ["ticker", "period_end"]),
        (valuation, ["ticker", "price_date"]),
    ]:
        assert duplicate_keys(frame, keys).count() == 0


def test_derived_years_add_up(spark, sf_dir):
    facts = _staged(spark, sf_dir, "raw_edgar_facts")["stg_edgar_facts"]
    four = statements.income_statement(facts).groupBy("ticker", "fiscal_year_end").agg({"revenue": "sum", "*": "count"})
    annual = facts.filter("concept = 'revenues' and period_length_days between 350 and 380")
    joined = four.filter("`count(1)` = 4").join(
        annual.selectExpr("ticker", "period_end as fiscal_year_end", "val"), ["ticker", "fiscal_year_end"]
    )
    assert joined.count() > 0 and joined.filter("`sum(revenue)` <> val").count() == 0


def test_warehouse_build_is_sorted_and_clean(spark, sf_dir, tmp_path):
    marts = warehouse.build_warehouse(spark, raw_tables(spark, sf_dir), str(tmp_path))
    assert spark.table("fct_valuation_daily").count() == marts["fct_valuation_daily"].count()
    report = warehouse.not_null_report(marts)
    assert report.count() == 11
    require_clean(report.filter("column_name not in ('current_ratio', 'debt_to_equity')"))
    assert companies(spark, sf_dir).count() == 11


def test_building_queries_writes_nothing(spark, sf_dir):
    root = Path(spark.conf.get("spark.checkpoint.dir"))
    for build in REGISTRY.values():
        build(spark, sf_dir)
    before = {p for p in root.rglob("*") if p.is_dir()}
    for build in REGISTRY.values():
        build(spark, sf_dir)
    assert {p for p in root.rglob("*") if p.is_dir()} == before


def test_report_reads_the_daily_mart_once(spark, sf_dir):
    plan = REGISTRY["trend_summary_text"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    scans = [line.split("FileScan parquet ")[1].split("]")[0] for line in plan.splitlines() if "FileScan" in line]
    # Of the tables read only the daily mart and the monthly panel hold a market cap; the panel's isn't used.
    assert sum("market_cap_approx#" in columns for columns in scans) == 1
    assert not any("ev_to_ebitda_approx#" in columns for columns in scans)
