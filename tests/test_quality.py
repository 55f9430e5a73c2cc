import pytest

from fixtures import adapter
from ledgerline.operators.quality import check_not_null, duplicate_keys, require_clean
from ledgerline.plans import warehouse


def test_null_checks(spark, rows):
    a = spark.sql("select 1 x, cast(null as int) y union all select null, 2")
    report = check_not_null({"a": a, "b": a.filter("x is not null")}, {"a": ["x", "y"], "b": ["x"]})
    assert rows(report) == [("a", "x", 1), ("a", "y", 1), ("b", "x", 0)]
    with pytest.raises(ValueError, match="a.x: 1"):
        require_clean(report)
    require_clean(report.filter("table_name = 'b'"))


def test_duplicate_keys(spark, rows):
    df = spark.sql("select 1 k, 1 t union all select 1, 1 union all select 1, 2")
    assert rows(duplicate_keys(df, ["k", "t"])) == [(1, 1, 2)]


def test_a_violation_stops_the_build(spark, sf_dir, tmp_path):
    raw = adapter.raw_tables(spark, sf_dir)
    with pytest.raises(ValueError, match="fct_financials_quarterly.current_ratio"):
        warehouse.build_warehouse(spark, raw, str(tmp_path), gate={"fct_financials_quarterly": ["current_ratio"]})
