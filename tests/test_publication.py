"""Published tables: all or nothing, checked in the write, sorted from one computation."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from fixtures import adapter
from ledgerline.plans import warehouse
from ledgerline.sources import landing, publication
from ledgerline.sources.publication import CheckFailed, publish, read_current


def frame(spark, n, hot=0.4):
    """``n`` rows of a few tickers, one of which holds much of them."""
    key = F.when(F.rand(3) < hot, "HOT").otherwise(F.concat(F.lit("S"), (F.col("id") % 97).cast("string")))
    return spark.range(n).select(key.alias("ticker"), F.date_add(F.lit(date(2001, 1, 1)), (F.col("id") * 7919 % 5000).cast("int")).alias("day"), "id")


def test_every_row_is_computed_once(spark, tmp_path):
    passed = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            passed.add(len(batch))
            yield batch

    df = frame(spark, 20_000).mapInPandas(counted, "ticker string, day date, id long")
    got = warehouse.write_mart(df, str(tmp_path / "mart"), ["ticker", "day"], ["ticker", "day"])
    assert got.count() == 20_000 and passed.value == 20_000


def test_sorted_ranges(spark, tmp_path):
    path = str(tmp_path / "mart")
    publish(frame(spark, 30_000), path, sort_by=["ticker", "day"], rows_per_file=1500)
    got = read_current(spark, path).withColumn("file", F.input_file_name())
    files = got.groupBy("file").agg(F.count("*").alias("n"), F.min(F.struct("ticker", "day")).alias("low"), F.max(F.struct("ticker", "day")).alias("high")).orderBy("low").collect()
    assert 15 <= len(files) <= 20 and max(f["n"] for f in files) < 2 * 1500
    assert all(tuple(a["high"]) <= tuple(b["low"]) for a, b in zip(files, files[1:], strict=False))
    hot = [f for f in files if f["low"]["ticker"] == "HOT" == f["high"]["ticker"]]
    assert len(hot) >= 5
    rows = [(r["ticker"], r["day"]) for r in spark.read.parquet(files[0]["file"]).collect()]
    assert rows == sorted(rows)
    assert read_current(spark, path).agg(F.sum("id")).first()[0] == 30_000 * 29_999 // 2


@pytest.mark.parametrize("rows_per_file", [1500, 1_000_000])
def test_ranges_known_from_another_table(spark, tmp_path, monkeypatch, rows_per_file):
    """Rows are written once, in ranges of a table with other rows too and without some of these."""
    monkeypatch.setattr(publication, "remove", lambda *_: pytest.fail("the rows were written twice"))
    path, df = str(tmp_path / "mart"), frame(spark, 30_000)
    like = df.filter("ticker <> 'S5'").union(df.limit(500)).select("ticker", "day")
    assert publish(df, path, ["ticker"], ["ticker", "day"], rows_per_file=rows_per_file, placed_by=like) == 30_000
    got = read_current(spark, path).withColumn("file", F.input_file_name())
    files = got.groupBy("file").agg(F.count("*").alias("n"), F.min(F.struct("ticker", "day")).alias("low"), F.max(F.struct("ticker", "day")).alias("high")).orderBy("low").collect()
    assert len(files) == 1 if rows_per_file > 30_000 else 15 <= len(files) <= 21 and max(f["n"] for f in files) < 2 * 1500
    assert all(tuple(a["high"]) <= tuple(b["low"]) for a, b in zip(files, files[1:], strict=False))
    rows = [(r["ticker"], r["day"]) for r in spark.read.parquet(files[0]["file"]).collect()]
    assert rows == sorted(rows) and got.agg(F.sum("id")).first()[0] == 30_000 * 29_999 // 2
    nulls = df.withColumn("ticker", F.when(F.col("id") != 7, F.col("ticker")))
    with pytest.raises(CheckFailed, match="ticker: 1"):
        publish(nulls, path, ["ticker"], ["ticker", "day"], rows_per_file=rows_per_file, placed_by=like)
    assert read_current(spark, path).count() == 30_000
    assert publish(df.limit(3), path, [], ["ticker", "day"], placed_by=like.limit(0)) == 3


def test_large_marts_are_written_once(spark, sf_dir, tmp_path, monkeypatch):
    seen = {}
    monkeypatch.setattr(warehouse, "publish", lambda df, path, **rules: seen.update({path.split("/")[-1]: rules["placed_by"]}) or publish(df, path, **rules))
    warehouse.build_warehouse(spark, adapter.raw_tables(spark, sf_dir), str(tmp_path))
    assert {n for n, like in seen.items() if like is not None} == {"fct_financials_quarterly", "fct_valuation_daily"}


def test_more_files_than_quantiles(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(publication, "QUANTILES", 4)
    path = str(tmp_path / "mart")
    publish(frame(spark, 3000), path, sort_by=["ticker", "day"], rows_per_file=200)
    got = read_current(spark, path)
    assert got.count() == got.select("id").distinct().count() == 3000
    assert 12 <= got.select(F.input_file_name()).distinct().count() <= 16


def test_order_code_never_falls(spark):
    texts = [None, "", "A", "A B", "AB", "ABCDE", "ABCDEF", "B", "Zé", "é", "日本", "\U0001f600"]
    days = [None, date(1500, 1, 1), date(1970, 1, 1), date(2024, 2, 29), date(9999, 12, 31)]
    df = spark.createDataFrame([(t, d) for t in texts for d in days], "t string, d date")
    found = df.select("t", "d", publication.order_code(df, ["t", "d"]).alias("c")).orderBy("t", "d").collect()
    # Of texts that agree in their first five bytes only the dates count; null and "" are one text.
    codes = [r["c"] for r in found if r["t"] not in ("ABCDEF", None)]
    assert codes == sorted(codes) and all(0 <= r["c"] < 1 << 62 for r in found)
    one = df.select("d", publication.order_code(df, ["d"]).alias("c")).orderBy("d").collect()
    assert [r["c"] for r in one] == sorted(r["c"] for r in one)
    with pytest.raises(TypeError, match="no order code"):
        publication.order_code(df, ["d", "t"])


@pytest.mark.parametrize("bounds", [[5], [1, 2, 3], [0, 0, 7, 7, 9], list(range(0, 100, 3))])
def test_places_by_halving(spark, bounds):
    found = spark.range(-3, 120).select("id", publication._place(F.col("id"), bounds).alias("p")).collect()
    assert all(r["p"] == sum(b < r["id"] for b in bounds) for r in found)


def test_a_failing_gate_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "mart")
    good = spark.createDataFrame([("A", date(2020, 1, 1), 1.0)], "ticker string, day date, ratio double")
    bad = spark.createDataFrame([("B", None, 2.0), ("B", date(2020, 1, 2), None), (None, None, None)], good.schema)
    warehouse.write_mart(good, path, ["ticker", "day"], ["ticker", "day"], "m")
    with pytest.raises(CheckFailed, match="m.ticker: 1, m.day: 2$"):
        warehouse.write_mart(bad, path, ["ticker", "day"], ["ticker", "day"], "m")
    assert [r["ticker"] for r in read_current(spark, path).collect()] == ["A"]
    assert publication.versions(spark, path) == [(1, 1)]
    # Without rules for these columns the next version takes the failed one's place.
    warehouse.write_mart(bad, path, ["ticker", "day"])
    assert read_current(spark, path).count() == 3 and publication.versions(spark, path) == [(1, 1), (2, 3)]


def test_a_killed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "raw")
    assert landing.write_raw(spark.range(3).toDF("x"), path) == 3
    held = read_current(spark, path)
    with pytest.raises(Exception, match="stop here"):
        landing.write_raw(spark.range(100).select(F.when(F.col("id") < 60, F.col("id")).otherwise(F.raise_error(F.lit("stop here")).cast("long")).alias("x")), path)
    assert read_current(spark, path).count() == 3
    assert landing.write_raw(spark.range(5).toDF("x"), path) == 5
    # A reader that began before the change goes on with what it had.
    assert held.count() == 3 and read_current(spark, path).count() == 5
    assert publication.expire(spark, path, keep=1) == [1]
    assert read_current(spark, path).count() == 5
    assert landing.write_raw(spark.range(0).toDF("x"), path) == 0 and read_current(spark, path).count() == 0


def test_empty_sorted_table_and_plain_folder(spark, tmp_path):
    path = str(tmp_path / "mart")
    got = warehouse.write_mart(frame(spark, 0), path, ["ticker", "day"], ["ticker"])
    assert got.count() == 0 and got.columns == ["ticker", "day", "id"]
    plain = str(tmp_path / "plain")
    spark.range(4).write.parquet(plain)
    assert read_current(spark, plain).count() == 4 and publication.current_location(spark, plain) == plain


def test_catalog_table_follows(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS swap_test LOCATION '{tmp_path / 'db'}'")
    at = str(tmp_path / "db" / "t")
    try:
        assert publication.publish_table(spark.range(3).toDF("x"), "swap_test.t", at) == 3
        with pytest.raises(CheckFailed):
            publication.publish_table(spark.sql("select cast(null as bigint) as x"), "swap_test.t", at, not_null=["x"])
        assert spark.table("swap_test.t").count() == 3
        assert publication.publish_table(spark.range(7).toDF("x"), "swap_test.t", at) == 7
        assert spark.table("swap_test.t").count() == 7
        publication.publish_table(spark.range(2).selectExpr("id as x", "'a' as y"), "swap_test.t", at)
        assert spark.table("swap_test.t").columns == ["x", "y"] and spark.table("swap_test.t").count() == 2
    finally:
        spark.sql("DROP DATABASE swap_test CASCADE")
