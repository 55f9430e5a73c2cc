import random
from datetime import date, timedelta

import pytest

from ledgerline.operators.asof import asof_join

LEFT = "k string, t date, id int"
RIGHT = "k string, rt date, v int, extra string"


def brute(left, right, keyed=True):
    """Reference semantics by scanning every pair."""
    out = []
    for k, t, i in left:
        hits = [
            (rt, v, e) for rk, rt, v, e in right
            if rt is not None and t is not None and rt <= t and (not keyed or (rk is not None and rk == k))
        ]
        best = max(hits, key=lambda h: (h[0], h[1])) if hits else (None, None, None)
        out.append((k, t, i, best[0], best[1], best[2]))
    return sorted(out, key=str)


def run(spark, left, right, keyed=True):
    joined = asof_join(
        spark.createDataFrame(left, LEFT),
        spark.createDataFrame(right, RIGHT),
        "t",
        "rt",
        {"rt": "hit_t", "v": "hit_v", "extra": "hit_e"},
        by=["k"] if keyed else [],
        tiebreak=["v"],
    )
    assert joined.columns == ["k", "t", "id", "hit_t", "hit_v", "hit_e"]
    return sorted((tuple(r) for r in joined.collect()), key=str)


@pytest.mark.parametrize("keyed", [True, False])
@pytest.mark.parametrize("seed", range(4))
def test_random_against_brute_force(spark, keyed, seed):
    rnd = random.Random(seed)
    day0 = date(2019, 11, 3)
    span = rnd.choice([40, 400, 2000])

    def when():
        return None if rnd.random() < 0.05 else day0 + timedelta(days=rnd.randrange(span))

    def key():
        return None if rnd.random() < 0.05 else rnd.choice("abc")

    left = [(key(), when(), i) for i in range(150)]
    # one (key, time, tiebreak) is unique so that the winner is determined
    right = [(key(), when(), i, None if rnd.random() < 0.2 else f"e{i}") for i in range(60)]
    assert run(spark, left, right, keyed) == brute(left, right, keyed)


def test_equal_time_matches_and_tie_takes_greatest(spark):
    d = date(2020, 5, 31)
    right = [("a", d, 1, "x"), ("a", d, 2, None)]
    # the winner's null must not fall through to the older row
    assert run(spark, [("a", d, 0)], right) == [("a", d, 0, d, 2, None)]


def test_before_first_and_far_after_last(spark):
    right = [("a", date(2020, 5, 31), 1, "x"), ("b", date(2021, 1, 1), 2, "y")]
    left = [("a", date(2020, 5, 30), 0), ("a", date(2099, 1, 1), 1), ("b", date(1999, 1, 1), 2)]
    assert run(spark, left, right) == brute(left, right)
    assert run(spark, left, right, keyed=False) == brute(left, right, keyed=False)


def test_empty_sides(spark):
    left = [("a", date(2020, 5, 30), 0)]
    assert run(spark, left, []) == [("a", date(2020, 5, 30), 0, None, None, None)]
    assert run(spark, left, [], keyed=False) == [("a", date(2020, 5, 30), 0, None, None, None)]
    assert run(spark, [], [("a", date(2020, 5, 31), 1, "x")]) == []


def test_never_looks_ahead_and_plans_no_product(spark):
    prices = spark.range(20_000).selectExpr(
        "if(id % 3 = 0, 'hot', concat('k', id % 50)) as k", "date_add(date'2000-01-01', cast(id % 3000 as int)) as t", "cast(id as int) as id"
    )
    facts = spark.range(2_000).selectExpr(
        "if(id % 3 = 0, 'hot', concat('k', id % 50)) as k", "date_add(date'2000-01-01', cast(id * 7 % 3000 as int)) as rt", "cast(id as int) as v", "'e' as extra"
    )
    joined = asof_join(prices, facts, "t", "rt", {"rt": "hit_t", "v": "hit_v"}, by=["k"], tiebreak=["v"])
    assert joined.count() == 20_000
    assert joined.filter("hit_t > t").count() == 0
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_rejects_timestamps(spark):
    df = spark.sql("select 'a' k, timestamp'2020-01-01 00:00:00' t")
    with pytest.raises(TypeError):
        asof_join(df, df, "t", "t", {"k": "x"}, by=["k"])
