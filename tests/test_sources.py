import json
from datetime import date, datetime

import pytest

from ledgerline import dims, schemas
from ledgerline.operators.aliases import missing_concepts, resolve_aliases
from ledgerline.sources import landing, payloads
from ledgerline.sources.documents import Accounts, SourceError
from ledgerline.sources.publication import read_current


def put(root, *parts, text):
    path = root.joinpath(*parts)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def entry(end, val, form="10-Q", start=None, filed="2022-05-01"):
    out = {"end": end, "val": val, "accn": "x", "fy": 2022, "fp": "Q1", "form": form, "filed": filed, "frame": "CY"}
    return out | ({"start": start} if start else {})


def test_concept_documents(spark, rows, tmp_path):
    def doc(ticker, tag, units):
        put(tmp_path, f"ticker={ticker}", f"tag={tag}", "doc.json", text=json.dumps({"cik": 1, "units": units}, indent=1))

    doc("MSFT", "Assets", {"USD": [entry("2020-12-31", 1), entry("2021-01-01", 2), entry("2022-03-31", 3)]})
    # the preferred tag has only old rows, so the second one serves, all its rows and no others
    doc("MSFT", "Revenues", {"USD": [entry("2019-12-31", 4, start="2019-10-01")]})
    doc("MSFT", "RevenueFromContractWithCustomerExcludingAssessedTax", {"USD": [entry("2022-03-31", 5, start="2022-01-01")]})
    doc("AAPL", "Revenues", {"USD": [entry("2022-03-31", 6, start="2022-01-01")]})
    doc("AAPL", "RevenueFromContractWithCustomerExcludingAssessedTax", {"USD": [entry("2022-06-30", 7, start="2022-04-01")]})
    doc("AAPL", "Assets", {"USD": []})
    doc("AAPL", "NetIncomeLoss", {"EUR": [entry("2022-03-31", 8)]})
    doc("AAPL", "NotATagWeUse", {"USD": [entry("2022-03-31", 9)]})

    facts = payloads.raw_facts(payloads.read_company_concepts(spark, str(tmp_path)))
    assert facts.columns == schemas.RAW_FACTS.fieldNames()
    assert rows(facts, "ticker", "concept", "end", "start", "val") == [
        ("AAPL", "revenues", "2022-03-31", "2022-01-01", 6),
        ("MSFT", "assets", "2021-01-01", None, 2),
        ("MSFT", "assets", "2022-03-31", None, 3),
        ("MSFT", "revenues", "2022-03-31", "2022-01-01", 5),
    ]
    companies = dims.company_dim(spark).filter("ticker in ('MSFT', 'AAPL')")
    gaps = rows(missing_concepts(facts, companies, dims.TAG_ALIASES))
    assert len(gaps) == 2 * len(dims.TAG_ALIASES) - 3
    assert ("AAPL", "assets") in gaps and ("AAPL", "revenues") not in gaps


def test_alias_choice_does_not_mix_tags(spark, rows):
    tags = dims.TAG_ALIASES["short_term_debt"]
    facts = spark.createDataFrame(
        [("A", "short_term_debt", tags[2], 1), ("A", "short_term_debt", tags[1], 2), ("A", "short_term_debt", tags[1], 3), ("B", "short_term_debt", tags[2], 4)],
        "ticker string, concept string, tag string, val int",
    )
    assert rows(resolve_aliases(facts, dims.alias_dim(spark)), "ticker", "val") == [("A", 2), ("A", 3), ("B", 4)]


def test_series_documents(spark, rows, tmp_path):
    observed = [{"date": "2021-01-01", "value": "0.09"}, {"date": "2021-02-01", "value": "."}, {"date": "2021-03-01", "value": "NaN"}]
    put(tmp_path, "series_id=FEDFUNDS", "a.json", text=json.dumps({"observations": observed}))
    put(tmp_path, "series_id=DGS10", "a.json", text=json.dumps({"observations": [{"date": "2021-01-04", "value": "0.93"}]}))
    assert rows(payloads.read_series(spark, str(tmp_path))) == [
        ("2021-01-01", 0.09, "FEDFUNDS"),
        ("2021-01-04", 0.93, "DGS10"),
        ("2021-02-01", None, "FEDFUNDS"),
        ("2021-03-01", None, "FEDFUNDS"),
    ]


def test_price_files(spark, rows, tmp_path):
    put(tmp_path, "ticker=MSFT", "p.csv", text="Date,Open,Close,Volume\n2021-01-04,1,217.5,100\n2021-01-05,1,,200\n")
    got = payloads.read_prices(spark, str(tmp_path))
    assert got.columns == ["date", "close", "volume", "ticker"]
    assert rows(got) == [(datetime(2021, 1, 4), 217.5, 100, "MSFT"), (datetime(2021, 1, 5), None, 200, "MSFT")]
    compound = spark.createDataFrame(
        [(date(2021, 1, 4), 5.0, float("nan"), 7, "MSFT")],
        "`('Date', '')` date, `('High', 'MSFT')` double, `('Close', 'MSFT')` double, `('Volume', 'MSFT')` bigint, ticker string",
    )
    assert rows(payloads.shape_prices(compound)) == [(datetime(2021, 1, 4), None, 7, "MSFT")]


def test_each_price_file_by_its_own_header(spark, rows, tmp_path):
    put(tmp_path, "ticker=0700", "p.csv", text="Date,Open,Close,Volume\n2021-01-04,1,217.5,100\n")
    put(tmp_path, "ticker=0005", "p.csv", text="Date,\"('Close', '0005')\",\"('Open', '0005')\",Volume\n2021-01-04,20.5,2.0,\n")
    assert rows(payloads.read_prices(spark, str(tmp_path)), "close", "volume", "ticker") == [(20.5, None, "0005"), (217.5, 100, "0700")]
    put(tmp_path, "ticker=X", "p.csv", text="Date,Open\n2021-01-04,1\n")
    with pytest.raises(SourceError, match="without the columns date, close, volume: .*ticker=X/p.csv"):
        payloads.read_prices(spark, str(tmp_path))


def test_price_files_are_read_natively(spark, rows, tmp_path):
    """Odd names, many layouts, a file of several splits; no Python and no whole file in the plan."""
    put(tmp_path, "ticker=A B'C", "p.csv", text="Volume,Date,Close\n7,2021-01-04,1.5\n\n,2021-01-05,NaN\n")
    put(tmp_path, "ticker=007", "p.csv", text="Date,\"('Close', 'x,y')\",\"('Volume', '')\"\n2021-01-04,2.5,9\n")
    days = "".join(f"20{y:02d}-{m:02d}-{d:02d},{y}.25,1,{m}\n" for y in range(60) for m in range(1, 13) for d in range(1, 29))
    put(tmp_path, "ticker=LONG", "p.csv", text="Date,Close,High,Volume\n" + days)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        got = payloads.read_prices(spark, str(tmp_path))
        assert got.rdd.getNumPartitions() > 5
        assert got.filter("ticker = 'LONG'").count() == 60 * 12 * 28
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    assert rows(got.filter("ticker != 'LONG'"), "close", "volume", "ticker") == [(1.5, 7, "A B'C"), (2.5, 9, "007"), (None, None, "A B'C")]


@pytest.mark.parametrize(
    ("text", "trouble"),
    [
        ("", "empty documents: .*ticker=X/p.csv"),
        ("\n2021-01-04,1,2\n", "without the columns"),
        ("Date,Close,Volume\n2021-01-04,1\n", "MALFORMED|Malformed"),
        ("Date,Close,Volume\n2021-01-04,1,2,3\n", "MALFORMED|Malformed"),
        ("Date,Close,Volume\n2021-01-04,one,2\n", "CAST_INVALID_INPUT"),
        ("2021-01-04,1,2\nDate,Close,Volume\n2021-01-05,1,2\n", "CAST_INVALID_INPUT"),
        ("Date,Close,Volume\n2021-01-04,1,2\nDate,Close,Volume\n", "two headers: .*ticker=X/p.csv"),
    ],
)
def test_broken_price_files_end_the_read(spark, tmp_path, text, trouble):
    put(tmp_path, "ticker=GOOD", "p.csv", text="Date,Close,Volume\n2021-01-04,1,2\n")
    put(tmp_path, "ticker=X", "p.csv", text=text)
    with pytest.raises(Exception, match=trouble):
        payloads.read_prices(spark, str(tmp_path)).collect()


GOOD = '{"observations": [{"date": "2021-01-01", "value": "1"}]}'
BROKEN = {
    "blank": " \n\t ",
    "truncated": GOOD[:-1],
    "doubled": GOOD + GOOD,
    "listed": GOOD + "," + GOOD,
    "trailing": GOOD + " xx",
    "closed": GOOD + "]",
    "smuggled": GOOD + '], "members": [' + GOOD,
    "null": "null",
    "number": "5",
    "list": f"[{GOOD}]",
    "kind": '{"observations": 7}',
}


@pytest.mark.parametrize("kind", BROKEN)
def test_broken_documents_end_the_read_by_name(spark, tmp_path, kind):
    put(tmp_path, "series_id=A", "good.json", text=f" \n{GOOD}\n")
    put(tmp_path, "series_id=B", "bad.json", text=BROKEN[kind])
    read = payloads.read_series(spark, str(tmp_path))
    for action in (read.collect, read.count, read.select("series_id").count):
        with pytest.raises(Exception, match=r"malformed document \(.*series_id=B/bad.json"):
            action()


def test_files_without_content_end_the_read_by_name(spark, tmp_path):
    put(tmp_path, "ticker=A", "good.json", text="{}")
    put(tmp_path, "ticker=B C", "bad.json", text="")
    with pytest.raises(SourceError, match="empty documents: .*ticker=B C/bad.json"):
        payloads.read_snapshot(spark, str(tmp_path))


@pytest.mark.parametrize("payload", [None, "", " ", "{", "{}{}", "{} x"])
def test_broken_payloads_end_the_job(spark, payload):
    documents = spark.createDataFrame([("A", "{}"), ("B", payload)], "ticker string, payload string")
    with pytest.raises(Exception, match=r"malformed document \(.*: B"):
        payloads.shape_snapshot(documents, "payload").count()


def test_accounts_settle_after_the_write(spark, tmp_path):
    for k in range(5):
        put(tmp_path, "in", f"series_id=S{k}", "a.json", text=GOOD)
    accounts = Accounts()
    read = payloads.read_series(spark, str(tmp_path / "in"), accounts)
    assert landing.write_raw(read, str(tmp_path / "out"), accounts=accounts) == 5
    assert accounts.settle() == 5
    # A file that is gone by the time of the write is missed.
    late = Accounts()
    read = payloads.read_series(spark, str(tmp_path / "in"), late).filter("series_id <> 'S9'")
    late._open[0][0].append("file:/never/landed.json")
    with pytest.raises(SourceError, match="6 files were listed and 5 documents parsed"):
        landing.write_raw(read, str(tmp_path / "out"), accounts=late)
    assert read_current(spark, str(tmp_path / "out")).count() == 5


def test_documents_are_read_whole_or_not_at_all(spark, rows):
    def concept(payload):
        documents = spark.createDataFrame([("A", "T", payload)], "ticker string, tag string, payload string")
        return payloads.flatten_company_concept(documents, "payload")

    two = '{"units": {"USD": [{"end": "2021-03-31", "val": 2.0, "fy": 2022.0}, {"end": "2021-06-30", "val": 7433000000}]}}'
    assert rows(concept(two), "end", "val", "fy") == [("2021-03-31", 2, 2022), ("2021-06-30", 7433000000, None)]
    with pytest.raises(Exception, match="val must be whole: 2.5"):
        concept('{"units": {"USD": [{"val": 2.5}]}}').collect()
    with pytest.raises(Exception, match="malformed document .*: A, T"):
        concept('{"units": {"USD": [{"val": 2').collect()
    shot = spark.createDataFrame([("A", '{"sharesOutstanding": 7433000000.0}')], "ticker string, payload string")
    assert rows(payloads.shape_snapshot(shot, "payload"), "shares_outstanding") == [(7433000000,)]


def test_snapshot_documents(spark, rows, tmp_path):
    put(tmp_path, "ticker=MSFT", "i.json", text=json.dumps({"marketCap": 5, "trailingPE": 3.5, "sharesOutstanding": 7, "x": "y"}))
    put(tmp_path, "ticker=META", "i.json", text="{}")
    got = payloads.read_snapshot(spark, str(tmp_path))
    assert got.columns == schemas.RAW_SNAPSHOT.fieldNames()
    assert rows(got, "ticker", "market_cap", "trailing_pe", "shares_outstanding", "total_cash") == [
        ("META", None, None, None, None),
        ("MSFT", 5, 3.5, 7, None),
    ]


def test_union_tolerant(spark, rows):
    a, b = spark.sql("select 1 x, 2 y"), spark.sql("select 3 y, 4 z")
    assert rows(payloads.union_tolerant([a, b], ["z", "y", "absent"])) == [(4, 3), (None, 2)]


def test_dimensions(spark):
    dim = dims.company_dim(spark).orderBy("position").collect()
    assert [r.ticker for r in dim] == ["MSFT", "AAPL", "GOOGL", "AMZN", "META"]
    assert dim[0].cik == "0000789019" and all(len(r.cik) == 10 for r in dim)
    assert dims.company_names()["AMZN"] == "Amazon.com, Inc."
    assert dims.alias_dim(spark).select("tag").distinct().count() == 22


def test_write_load_and_read_back(spark, tmp_path):
    raw = spark.createDataFrame([("2021-01-01", 1.0, "FEDFUNDS")] * 3, schemas.RAW_SERIES)
    assert landing.write_raw(raw, str(tmp_path / "fred_series.parquet")) == 3
    assert landing.write_raw(raw.limit(2), str(tmp_path / "fred_series.parquet")) == 2  # replaced
    found = landing.read_raw(spark, str(tmp_path))
    assert list(found) == ["raw_fred_series"]  # files not landed are skipped
    spark.sql(f"CREATE DATABASE IF NOT EXISTS raw_test LOCATION '{tmp_path / 'db'}'")
    assert landing.load_raw(spark, str(tmp_path), "raw_test") == {"raw_fred_series": 2}
    assert landing.load_raw(spark, str(tmp_path), "raw_test") == {"raw_fred_series": 2}
    assert spark.table("raw_test.raw_fred_series").count() == 2
    spark.sql("DROP DATABASE raw_test CASCADE")


def test_absent_mart_is_a_typed_empty_frame(spark):
    empty = landing.read_mart(spark, "no_such_mart", schemas.VALUATION, ["ticker"])
    assert empty.schema == schemas.VALUATION and empty.count() == 0
    spark.sql("select 2 as t union all select 1").createOrReplaceTempView("some_mart")
    assert [r.t for r in landing.read_mart(spark, "some_mart", schemas.VALUATION, ["t"]).collect()] == [1, 2]


def test_malformed_date_raises(spark):
    from ledgerline.plans.staging import stage_series

    bad = spark.createDataFrame([("not a date", 1.0, "FEDFUNDS")], schemas.RAW_SERIES)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        stage_series(bad).collect()
