from datetime import date

from pyspark.sql import functions as F

from ledgerline.operators.latest import first_and_last, index_to_first, latest_by, peak_by
from ledgerline.operators.pivot import conditional_pivot


def test_latest_by_is_map_side_limited(spark, rows):
    df = spark.range(0, 10_000, numPartitions=8).selectExpr("id % 3 as k", "id as v")
    newest = latest_by(df, ["k"], [F.desc("v")])
    assert rows(newest) == [(0, 9999), (1, 9997), (2, 9998)]
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_first_and_last_keep_nulls_of_the_edge_rows(spark, rows):
    df = spark.createDataFrame(
        [("a", date(2020, 1, 1), None), ("a", date(2020, 1, 2), 2.0), ("a", date(2020, 1, 3), 3.0)],
        "k string, t date, v double",
    )
    out = first_and_last(df, ["k"], "t", {"f": "v"}, {"l": "v", "lt": "t"})
    assert rows(out) == [("a", None, 3.0, date(2020, 1, 3))]


def test_peak_takes_earliest_on_ties(spark, rows):
    df = spark.createDataFrame(
        [("a", date(1969, 5, 1), 1.0), ("a", date(2020, 1, 2), 7.0), ("a", date(2021, 1, 2), 7.0), ("b", date(2020, 1, 1), None)],
        "k string, t date, v double",
    )
    assert rows(peak_by(df, ["k"], "v", "t")) == [("a", 7.0, date(2020, 1, 2))]


def test_index_to_first(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, 4.0), ("a", 2, 6.0), ("a", 3, None), ("b", 1, None), ("b", 2, 5.0), ("c", 1, 0.0), ("c", 2, 1.0)],
        "k string, t int, v double",
    )
    out = index_to_first(df, "k", "t", "v", "i")
    assert rows(out, "k", "t", "i") == [
        ("a", 1, 100.0), ("a", 2, 150.0), ("a", 3, None), ("b", 1, None), ("b", 2, None), ("c", 1, None), ("c", 2, None),
    ]


def test_conditional_pivot(spark, rows):
    df = spark.createDataFrame([("k", "x", 1), ("k", "x", 3), ("k", "z", 9), ("m", "y", 2)], "key string, c string, v int")
    out = conditional_pivot(df, ["key"], "c", "v", {"x": "vx", "y": "vy"}, extra=[F.count(F.lit(1)).alias("n")])
    assert out.columns == ["key", "n", "vx", "vy"]
    assert rows(out) == [("k", 3, 3, None), ("m", 1, None, 2)]
