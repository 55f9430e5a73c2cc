"""One key holds a third or more of the rows: results stay whole, hot groups are reduced or split."""

from datetime import date, timedelta

from ledgerline import dims
from ledgerline.operators.aliases import resolve_aliases
from ledgerline.operators.asof import asof_join
from ledgerline.plans import staging, statements


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_copies_of_one_fact_are_dropped_before_the_shuffle(spark):
    copies = spark.range(0, 60_000, numPartitions=8).selectExpr(
        "if(id % 3 < 2, 'HOT', concat('T', id % 10)) as ticker", "'assets' as concept", "'Assets' as tag",
        "'10-Q' as form", "2022 as fy", "'Q1' as fp", "cast(null as string) as start", "'2022-03-31' as end",
        "cast(date_add(date'2022-05-01', cast(id % 50 as int)) as string) as filed", "id as val",
    )
    out = staging.stage_facts(copies)
    found = {r.ticker: (r.filed, r.val) for r in out.collect()}
    assert len(found) == 11 and found["HOT"] == (date(2022, 5, 1) + timedelta(days=49), 59_949)
    # tasks hand on one row per ticker, not their share of the copies
    assert plan_of(out).split("== Initial Plan ==")[0].count("WindowGroupLimit") == 2
    assert statements.balance_sheet(out).filter("ticker = 'HOT'").first().total_assets == 59_949


def test_hot_ticker_as_of_join_splits_and_is_complete(spark):
    # Half of all prices belong to one ticker and month.
    n = 200_000
    prices = spark.range(0, n, numPartitions=8).selectExpr(
        "if(id % 2 = 0, 'HOT', concat('T', id % 997)) as ticker",
        "date_add(date'2020-01-01', cast(if(id % 2 = 0, id % 20, id % 900) as int)) as price_date",
        "sha2(cast(id as string), 512) as padding",
    )
    quarters = spark.range(0, 4000).selectExpr(
        "if(id % 3 = 0, 'HOT', concat('T', id % 997)) as ticker",
        "date_add(date'2019-12-20', cast(id % 400 as int)) as filed_date",
        "id as v",
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = asof_join(prices, quarters, "price_date", "filed_date", {"v": "v"}, by=["ticker"], tiebreak=["v"])
        hits = joined.groupBy("ticker", "price_date", "v").agg({"padding": "max", "*": "count"})
        found = hits.collect()
        assert "skew=true" in plan_of(hits)
        assert sum(r["count(1)"] for r in found) == n
        hot = [r for r in found if r.ticker == "HOT"]
        assert len(hot) == 10 and sum(r["count(1)"] for r in hot) == n // 2
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_alias_choice_needs_no_window_over_a_company(spark):
    facts = spark.range(0, 30_000, numPartitions=8).selectExpr(
        "if(id % 3 = 0, 'HOT', concat('T', id % 50)) as ticker", "'revenues' as concept",
        "if(id % 2 = 0, 'Revenues', 'RevenueFromContractWithCustomerExcludingAssessedTax') as tag", "id as val",
    )
    chosen = resolve_aliases(facts, dims.alias_dim(spark))
    plan = plan_of(chosen)
    assert "Window" not in plan and "partial_min" in plan
    # every T ticker has one parity only; HOT has both and keeps the preferred tag
    assert chosen.count() == 30_000 - 5_000
