import json

import pytest

from fixtures import adapter
from ledgerline.sources import landing, payloads
from ledgerline.sources.bundles import land_documents
from ledgerline.sources.documents import Accounts, SourceError
from ledgerline.sources.publication import current_location, versions


def concept(end, val):
    return json.dumps({"units": {"USD": [{"end": end, "val": val, "fy": 2022.0, "fp": "Q1", "form": "10-Q", "filed": "2022-05-01"}]}}, indent=1)


def bundle(spark, path, documents, keys):
    frame = spark.createDataFrame(documents, ", ".join(f"{k} string" for k in [*keys, "value"]))
    return land_documents(frame, str(path), keys)


def test_bundles_read_like_files(spark, rows, tmp_path):
    documents = [(f"A {k}'", tag, concept("2022-03-31", k)) for k in range(40) for tag in ("Assets", "Revenues")]
    for ticker, tag, text in documents:
        at = tmp_path / "files" / f"ticker={ticker}" / f"tag={tag}"
        at.mkdir(parents=True)
        (at / "d.json").write_text(text)
    assert bundle(spark, tmp_path / "bundles", documents, ["ticker", "tag"]) == 80
    # Fewer files than documents: what a read costs follows the bytes, not the documents.
    assert len(list((tmp_path / "bundles").rglob("*.parquet"))) < 40
    one, other = (payloads.read_company_concepts(spark, str(tmp_path / k)) for k in ("files", "bundles"))
    assert one.schema == other.schema
    assert rows(one) == rows(other) and other.count() == 80


@pytest.mark.parametrize("text", ["", " \n", "{", "{}{}", "{} x", "null"])
def test_broken_bundled_documents_end_the_read_by_name(spark, tmp_path, text):
    bundle(spark, tmp_path / "b", [("A", "{}"), ("B", text)], ["ticker"])
    read = payloads.read_snapshot(spark, str(tmp_path / "b"))
    for action in (read.collect, read.count):
        with pytest.raises(Exception, match=r"malformed document \(.*: B"):
            action()


def test_a_lost_bundle_ends_the_read(spark, tmp_path):
    frame = spark.createDataFrame([(f"T{k}", "{}") for k in range(8)], "ticker string, value string").repartition(4)
    land_documents(frame, str(tmp_path / "b"), ["ticker"])
    accounts = Accounts()
    read = payloads.read_snapshot(spark, str(tmp_path / "b"), accounts)
    assert landing.write_raw(read, str(tmp_path / "out"), accounts=accounts) == 8
    assert accounts.settle() == 8
    part = next((tmp_path / "b").glob(f"{current_location(spark, str(tmp_path / 'b')).rsplit('/', 1)[1]}/*.parquet"))
    part.write_bytes(b"")
    part.unlink()
    with pytest.raises(SourceError, match="8 documents were published and [0-7] found"):
        payloads.read_snapshot(spark, str(tmp_path / "b"))


def test_registered_documents_are_bundled(spark, sf_dir):
    """No more files than tasks that wrote them, however many companies there are."""
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet").count()
    folder = adapter.snapshot_files(spark, sf_dir)
    assert versions(spark, folder)[-1][1] == suppliers
    assert len(spark.read.parquet(current_location(spark, folder)).inputFiles()) < suppliers


def test_bundled_prices_by_their_own_headers(spark, rows, tmp_path):
    texts = {
        "0700": "Date,Open,Close,Volume\n2021-01-04,1,217.5,100\r\n2021-01-05,1,,200\n",
        "0005": "Volume,Date,\"('Close', 'a,b')\",\"('High', '0005')\"\n7,2021-01-04,1.5,2\n\n,2021-01-05,NaN,\"3\"\n",
        "HEAD": "Date,Close,Volume",
    }
    for ticker, text in texts.items():
        (tmp_path / "files" / f"ticker={ticker}").mkdir(parents=True)
        (tmp_path / "files" / f"ticker={ticker}" / "p.csv").write_bytes(text.encode())
    bundle(spark, tmp_path / "b", list(texts.items()), ["ticker"])
    one, other = (payloads.read_prices(spark, str(tmp_path / k)) for k in ("files", "b"))
    assert one.schema == other.schema
    assert rows(one) == rows(other) and other.count() == 4
    plan = other._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


@pytest.mark.parametrize(
    ("text", "trouble"),
    [
        ("", "without the columns date, close, volume: X"),
        (None, "without the columns"),
        ("\n2021-01-04,1,2\n", "without the columns"),
        ("Date,Open\n2021-01-04,1\n", "without the columns"),
        ("Date,Close,Volume\n2021-01-04,1\n", "MALFORMED|Malformed"),
        ("Date,Close,Volume\n2021-01-04,1,2,3\n", "MALFORMED|Malformed"),
        ("Date,Close,Volume\n2021-01-04,one,2\n", "CAST_INVALID_INPUT"),
        ("2021-01-04,1,2\nDate,Close,Volume\n2021-01-05,1,2\n", "without the columns"),
        ("Date,Close,Volume\n2021-01-04,1,2\nDate,Close,Volume\n", "two headers: X"),
    ],
)
def test_broken_bundled_prices_end_the_read(spark, tmp_path, text, trouble):
    bundle(spark, tmp_path / "b", [("GOOD", "Date,Close,Volume\n2021-01-04,1,2\n"), ("X", text)], ["ticker"])
    with pytest.raises(Exception, match=trouble):
        payloads.read_prices(spark, str(tmp_path / "b")).collect()


def snapshots_of(spark, texts):
    documents = spark.createDataFrame([(f"T{k}", text) for k, text in enumerate(texts)], "ticker string, payload string")
    return payloads.shape_snapshot(documents, "payload")


@pytest.mark.parametrize("added", ['],"members":[{}', '], "x" : [1', "],'x':[1", '] ,\n\t"x":[', '],"x":1,"y":[{}'])
def test_names_smuggled_into_the_seal_end_the_read(spark, added):
    with pytest.raises(Exception, match=r"malformed document \(.*: T1"):
        snapshots_of(spark, ["{}", "{}" + added, "{}"]).collect()


def test_names_are_counted_only_where_a_list_is_followed_by_one(spark, rows):
    """Lists followed by names inside the document are no trouble; names are counted behind a test of the text."""
    got = snapshots_of(spark, ['{"a":[1,2], "marketCap":5}', "{\"a\":[1],'b':[2]}", '{"marketCap":7}'])
    assert rows(got, "ticker", "market_cap") == [("T0", 5), ("T1", None), ("T2", 7)]
    assert "CASE WHEN RLIKE" in got._jdf.queryExecution().optimizedPlan().toString()
