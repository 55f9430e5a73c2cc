import pytest

from ledgerline.functions import scalars as S


def one(spark, sql, expr):
    return spark.sql(f"SELECT {sql}").select(expr).first()[0]


@pytest.mark.parametrize(
    "a, b, expected",
    [
        (1.005, 1.0, 1.0),  # decimal rounding of the text would give 1.01
        (2.675, 1.0, 2.68),  # 2.675 * 100 is exactly 267.5
        (1.0, 3.0, 0.33),
        (-1.0, 3.0, -0.33),
        (5.0, -2.0, -2.5),
        (1.0, 0.0, None),
        (1.0, None, None),
        (None, 2.0, None),
    ],
)
def test_safe_ratio(spark, a, b, expected):
    df = spark.createDataFrame([(a, b)], "a double, b double")
    assert df.select(S.safe_ratio("a", "b")).first()[0] == expected


@pytest.mark.parametrize(
    "days, label",
    [(79, None), (80, "quarter"), (100, "quarter"), (101, None), (349, None), (350, "year"), (380, "year"), (381, None), (None, None)],
)
def test_duration_class(spark, days, label):
    df = spark.createDataFrame([(days,)], "days int")
    assert df.select(S.duration_class("days")).first()[0] == label


def test_days_between(spark):
    assert one(spark, "date'2023-01-01' a, date'2023-03-31' b", S.days_between("a", "b")) == 89
    assert one(spark, "cast(null as date) a, date'2023-03-31' b", S.days_between("a", "b")) is None


@pytest.mark.parametrize("text, value", [("1.5", 1.5), (".", None), ("NaN", None), ("", None), (None, None)])
def test_tolerant_double(spark, text, value):
    assert spark.createDataFrame([(text,)], "t string").select(S.tolerant_double("t")).first()[0] == value


def test_pct_change_of_zero_base_is_null(spark):
    assert one(spark, "1d a, 0d b", S.pct_change("a", "b")) is None
    assert one(spark, "3d a, 2d b", S.pct_change("a", "b")) == 50.0


def test_text_formats(spark):
    assert one(spark, "1.234d a", S.signed_fixed("a", 2, signed=True)) == "+1.23"
    assert one(spark, "-0.5d a", S.signed_fixed("a", 3)) == "-0.500"
    assert one(spark, "cast(null as double) a", S.signed_fixed("a", 2)) is None
    assert one(spark, "date'2023-01-05' a", S.iso_date("a")) == "2023-01-05"


def test_fixed_text_rounds_the_binary_value_half_to_even(spark):
    import random

    rng = random.Random(4)
    values = [0.0, -0.0, 0.5, 1.5, 2.5, 12.5, 13.5, 0.125, 0.375, 2.675, 1.005, -0.001, -0.125, 0.0625, 0.1875, 999.9995, 0.9995, 0.99951, 9.5, 99.5]
    values += [1e-320, 5e-324, 1e15 + 0.5, 2.0**52 + 1, 4.4e12 + 0.125, 1e18, 123456789.0625, 1e17 / 3, float("nan"), float("inf"), float("-inf")]
    values += [k / 16 for k in range(-200, 200)] + [rng.uniform(-1000, 1000) for _ in range(2000)] + [round(rng.uniform(-9, 9), 4) for _ in range(2000)]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)] + [(-1, None)], "k int, v double")
    kinds = [(d, s) for d in range(4) for s in (False, True)]
    got = df.select("k", *[S.signed_fixed("v", d, s).alias(f"f{d}{s}") for d, s in kinds]).orderBy("k").collect()
    assert all(got[0][f"f{d}{s}"] is None for d, s in kinds)
    for d, s in kinds:
        expected = [format(v, f"{'+' if s else ''}.{d}f") for v in values]
        assert [r[f"f{d}{s}"] for r in got[1:]] == expected
