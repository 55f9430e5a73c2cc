from datetime import date

import pandas as pd

from ledgerline.operators.series import resample_last, with_changes


def test_resample_fills_gaps_and_takes_last_non_null(spark, rows):
    df = spark.createDataFrame(
        [
            ("a", date(2020, 1, 5), 1.0, 10.0),
            ("a", date(2020, 1, 31), 2.0, None),  # last day of the month is null in one column only
            ("a", date(2020, 4, 1), 3.0, 30.0),
            ("b", date(2020, 2, 29), None, 5.0),  # single month
        ],
        "k string, t date, x double, y double",
    )
    assert rows(resample_last(df, "k", "t", ["x", "y"])) == [
        ("a", date(2020, 1, 1), 2.0, 10.0),
        ("a", date(2020, 2, 1), None, None),
        ("a", date(2020, 3, 1), None, None),
        ("a", date(2020, 4, 1), 3.0, 30.0),
        ("b", date(2020, 2, 1), None, 5.0),
    ]


def test_resample_agrees_with_pandas(spark):
    days = pd.date_range("2015-01-01", periods=900, freq="3D")
    pdf = pd.DataFrame({"t": days, "x": [float(i) if i % 7 else None for i in range(900)]})
    pdf = pdf[~pdf.t.dt.month.isin([4, 5])]
    expected = pdf.set_index("t").resample("MS").last()
    source = spark.createDataFrame([(r.t.date(), None if r.x != r.x else r.x) for r in pdf.itertuples()], "t date, x double")
    got = resample_last(source.selectExpr("'a' as k", "t", "x"), "k", "t", ["x"]).orderBy("t").collect()
    assert [r.t for r in got] == [d.date() for d in expected.index]
    assert [r.x for r in got] == [None if v != v else v for v in expected.x]


def test_changes(spark, rows):
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 2, 3.0), ("a", 3, None), ("a", 4, 0.0), ("a", 5, 1.0), ("b", 1, 1.0)], "k string, t int, x double")
    out = with_changes(df, "k", ["t"], percent={"x": "p"}, difference={"x": "d"})
    assert rows(out, "k", "t", "p", "d") == [
        ("a", 1, None, None), ("a", 2, 50.0, 1.0), ("a", 3, None, None), ("a", 4, None, None), ("a", 5, None, 1.0), ("b", 1, None, None),
    ]
