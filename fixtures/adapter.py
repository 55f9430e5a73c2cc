"""The four raw tables, derived in Spark from lineitem, orders and supplier (FIXTURES.md §3).

A supplier plays the company, the quarter of its ship dates the reporting period; money is
integer cents. ``fixtures.oracle`` states the same rules for DuckDB.
"""

from __future__ import annotations

import hashlib
import threading
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.dims import TAG_ALIASES, alias_dim
from ledgerline.operators.aliases import resolve_aliases
from ledgerline.plans import serving, warehouse
from ledgerline.schemas import RAW_FACTS
from ledgerline.session import shared_dir
from ledgerline.sources.bundles import land_documents
from ledgerline.sources.landing import RAW_FILES, load_raw, read_raw, write_raw
from ledgerline.sources.publication import current_location, read_current

EXTRA_TICKER = "S-NONE"  # R9: in the company list, without data


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quarter_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per (supplier k, quarter): amounts, fiscal year figures and running balances."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    flag = F.col("l_returnflag")
    quarters = (
        _table(spark, sf_dir, "lineitem")
        .select(
            F.col("l_suppkey").alias("k"),
            F.trunc(F.col("l_shipdate").cast("date"), "quarter").alias("qs"),
            cents.alias("rev"),
            F.when(flag != "R", cents).otherwise(0).alias("opi"),
            F.when(flag == "N", cents).otherwise(0).alias("net"),
            (F.round("l_quantity").cast("bigint") * 1000).alias("da"),
        )
        .groupBy("k", "qs")
        .agg(*[F.sum(c).alias(c) for c in ("rev", "opi", "net", "da")])
    )
    fiscal = F.when(F.col("k") % 2 == 1, F.add_months("qs", 3)).otherwise(F.col("qs"))
    dated = quarters.withColumn("qe", F.date_sub(F.add_months("qs", 3), 1)).withColumn("fy", F.year(fiscal))
    year = Window.partitionBy("k", "fy")
    running = Window.partitionBy("k").orderBy("qs").rowsBetween(Window.unboundedPreceding, 0)
    return (
        dated.withColumns({f"run_{c}": F.sum(c).over(running) for c in ("rev", "opi")})
        .withColumns({f"fy_{c}": F.sum(c).over(year) for c in ("rev", "opi", "net", "da")})
        .withColumn("complete", F.count(F.lit(1)).over(year) == 4)
        .withColumn("fy_start", F.min("qs").over(year))
        .withColumn("fy_last", F.max("qe").over(year))
    )


def raw_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reported facts with restatements, annual totals, foreign forms and alternative tags."""
    k, qe = F.col("k"), F.col("qe")
    march, june = F.month("qe") == 3, F.month("qe") == 6
    with_da = k != 11
    null_date = F.lit(None).cast("date")

    def item(concept: str, val: Column, keep: Column, year: Column | None = None) -> Column:
        tags = TAG_ALIASES[concept]
        return F.when(
            keep,
            F.struct(
                F.lit(concept).alias("concept"),
                F.lit(tags[0]).alias("tag"),
                # R8: some companies report revenue under a second tag as well
                F.when((k % 6 == 0) & F.lit(concept == "revenues"), F.lit(tags[-1])).alias("second_tag"),
                val.cast("bigint").alias("val"),
                (F.lit(None) if year is None else year).cast("bigint").alias("year_val"),
                F.lit(year is not None).alias("flow"),
            ),
        )

    always = F.lit(True)
    small_liabilities = F.when((k % 17 == 0) & june, 0).otherwise(F.col("opi"))
    items = F.array(
        item("revenues", F.col("rev"), always, F.col("fy_rev")),
        item("operating_income", F.col("opi"), always, F.col("fy_opi")),
        item("net_income", F.col("net"), always, F.col("fy_net")),
        item("depreciation_amortization", F.col("da"), with_da, F.col("fy_da")),
        # R5 and R6: balances, some of them missing
        item("assets", F.col("run_rev") + F.col("run_opi"), ~((k % 13 == 0) & march)),
        item("assets_current", F.col("rev"), always),
        item("liabilities", F.col("run_rev"), k % 5 != 0),
        item("liabilities_current", small_liabilities, always),
        item("stockholders_equity", F.col("run_opi"), always),
        item("long_term_debt", F.col("net"), k % 7 != 0),
        item("short_term_debt", F.col("da"), always),
        item("cash_and_equivalents", F.floor(F.col("net") / 2), always),
    )
    itemised = quarter_base(spark, sf_dir).withColumn("i", F.explode(items)).filter("i is not null")

    flow, val = F.col("i.flow"), F.col("i.val")
    closing = F.col("complete") & (qe == F.col("fy_last"))
    lag_days = (k % 5 + 35).cast("int")
    # R7: some March quarters are filed together with June's
    filed = F.date_add("qe", F.when((k % 9 == 0) & march, lag_days + 91).otherwise(lag_days))
    bump = F.when((k % 3 == 0) & (F.col("i.concept") == "revenues"), 1).otherwise(0)

    def version(keep: Column, form: str, start: Column, filed_on: Column, amount: Column) -> Column:
        return F.when(
            keep,
            F.struct(
                F.lit(form).alias("form"),
                start.alias("start"),
                filed_on.alias("filed"),
                amount.cast("bigint").alias("val"),
            ),
        )

    versions = F.array(
        # R1 for flows, R5 for balances
        version(~flow | ~closing, "10-Q", F.when(flow, F.col("qs")).otherwise(null_date), filed, val),
        # R2
        version(
            flow & ~closing & (k % 2 == 0),
            "10-Q",
            F.col("qs"),
            F.date_add("qe", (k % 5 + 400).cast("int")),
            val + bump,
        ),
        # R3
        version(
            flow & closing & ~((k % 10 == 9) & (F.col("fy") >= 2001)),
            "10-K",
            F.col("fy_start"),
            F.date_add("qe", 60),
            F.col("i.year_val"),
        ),
        # R4
        version(flow & ~closing & (k % 4 == 0), "8-K", F.col("qs"), F.date_add("qe", 500), F.lit(0)),
    )
    filings = itemised.withColumn("v", F.explode(versions)).filter("v is not null")
    second = (F.col("v.form") != "8-K") & F.col("i.second_tag").isNotNull()
    tagged = F.array(
        F.struct(F.col("i.tag").alias("tag"), F.lit(0).alias("plus")),
        F.when(second, F.struct(F.col("i.second_tag").alias("tag"), F.lit(7).alias("plus"))),
    )
    return (
        filings.withColumn("t", F.explode(tagged))
        .filter("t is not null")
        .select(
            F.concat(F.lit("S"), k.cast("string")).alias("ticker"),
            "i.concept",
            "t.tag",
            "v.form",
            F.col("fy").cast("int").alias("fy"),
            F.concat(F.lit("Q"), F.quarter("qe")).alias("fp"),
            F.col("v.start").cast("string").alias("start"),
            qe.cast("string").alias("end"),
            F.col("v.filed").cast("string").alias("filed"),
            (F.col("v.val") + F.col("t.plus")).alias("val"),
        )
    )


def raw_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _table(spark, sf_dir, "lineitem")
        .select(
            F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("ticker"),
            F.col("l_shipdate").cast("date").alias("date"),
            "l_extendedprice",
            F.round("l_quantity").cast("bigint").alias("q"),
        )
        .groupBy("ticker", "date")
        .agg(F.max("l_extendedprice").alias("close"), F.sum("q").alias("volume"))
        .select(F.col("date").cast("timestamp_ntz").alias("date"), "close", "volume", "ticker")
    )


def raw_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    missing_long, missing_double = F.lit(None).cast("bigint"), F.lit(None).cast("double")
    return (
        _table(spark, sf_dir, "supplier")
        .filter(key % 19 != 18)
        .select(
            F.concat(F.lit("S"), key.cast("string")).alias("ticker"),
            missing_long.alias("market_cap"),
            missing_long.alias("enterprise_value"),
            missing_double.alias("trailing_pe"),
            missing_double.alias("forward_pe"),
            missing_double.alias("ev_to_ebitda"),
            (key * 1000 + 1_000_000).alias("shares_outstanding"),
            missing_long.alias("total_debt"),
            missing_long.alias("total_cash"),
        )
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(date, value text, series_id) before numeric parsing, with one unparsable value."""
    monthly = (
        _table(spark, sf_dir, "orders")
        .groupBy(F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("month"))
        .agg(((F.count(F.lit(1)) % 24) * 0.25).cast("double").alias("value"))
    )
    policy = monthly.select(
        F.explode(
            F.array(
                F.struct(F.col("month").alias("d"), F.col("value").cast("string").alias("v"), F.lit("FEDFUNDS").alias("s")),
                F.struct(F.col("month").alias("d"), F.col("value").cast("string").alias("v"), F.lit("DGS10").alias("s")),
                # every January is also published once without a number, on the 15th
                F.when(
                    F.month("month") == 1,
                    F.struct(F.date_add("month", 14).alias("d"), F.lit(".").alias("v"), F.lit("FEDFUNDS").alias("s")),
                ),
            )
        ).alias("o")
    ).filter("o is not null")
    return policy.select(F.col("o.d").cast("string").alias("date"), F.col("o.v").alias("value"), F.col("o.s").alias("series_id"))


def raw_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(spark, sf_dir).select(
        "date", F.col("value").try_cast("double").alias("value"), "series_id"
    )


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier plus one company that reports nothing: position, ticker, name, number."""
    listed = _table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("int").alias("position"),
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("ticker"),
        F.col("s_name").alias("name"),
        F.col("s_suppkey").cast("string").alias("number"),
    )
    silent = spark.createDataFrame(
        [(-1, EXTRA_TICKER, "No filings", "0")], "position int, ticker string, name string, number string"
    )
    return listed.unionByName(silent)


# ---- the raw tables as landed files ---------------------------------------------------


_LANDED: set[str] = set()  # directories whose landing completed
_LANDING = threading.Lock()  # queries may be built from several threads


def _raw_dir(spark: SparkSession, sf_dir: str) -> str:
    tag = hashlib.md5(sf_dir.encode()).hexdigest()
    return f"{shared_dir(spark).rstrip('/')}/ledgerline-raw-{spark.sparkContext.applicationId}/{tag}"


def _entries_path(spark: SparkSession, sf_dir: str) -> str:
    return f"{_raw_dir(spark, sf_dir)}/fact_entries.parquet"


def land(spark: SparkSession, sf_dir: str) -> dict[str, int]:
    """Extract and land: write the unresolved entries and the four raw tables, return row counts."""
    entries = _entries_path(spark, sf_dir)
    counts = {"fact_entries": write_raw(raw_facts(spark, sf_dir), entries)}
    tables = {
        "raw_edgar_facts": resolve_aliases(read_current(spark, entries, RAW_FACTS), alias_dim(spark)),
        "raw_yfinance_prices": raw_prices(spark, sf_dir),
        "raw_yfinance_valuation_snapshot": raw_snapshot(spark, sf_dir),
        "raw_fred_series": raw_series(spark, sf_dir),
    }
    for name, frame in tables.items():
        counts[name] = write_raw(frame, f"{_raw_dir(spark, sf_dir)}/{RAW_FILES[name]}")
    return counts


def raw_tables(spark: SparkSession, sf_dir: str, tables: Iterable[str] = tuple(RAW_FILES)) -> dict[str, DataFrame]:
    """Landed raw tables, one tag per concept; all are landed on first use in a session."""
    path = _raw_dir(spark, sf_dir)
    with _LANDING:
        found = read_raw(spark, path, tables) if path in _LANDED else {}
        if any(name not in found for name in tables):
            land(spark, sf_dir)
            _LANDED.add(path)
            found = read_raw(spark, path, tables)
    return found


def fact_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed entries before alias resolution."""
    raw_tables(spark, sf_dir, ["raw_edgar_facts"])
    return read_current(spark, _entries_path(spark, sf_dir), RAW_FACTS)


# ---- the marts, and what else is written from the raw tables ---------------------------


_WRITTEN: dict[str, object] = {}  # folder -> what its one writing in this session returned
_WRITING = threading.RLock()


def _once(spark: SparkSession, sf_dir: str, label: str, write: Callable):
    """The result of ``write(folder)``, done on first use in a session."""
    path = f"{_raw_dir(spark, sf_dir)}/{label}"
    with _WRITING:
        if path not in _WRITTEN:
            _WRITTEN[path] = write(path)
        return _WRITTEN[path]


def build_marts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Compute and write the four marts and the panels over them; return the tables."""
    path = f"{_raw_dir(spark, sf_dir)}/marts"
    built = warehouse.build_warehouse(spark, raw_tables(spark, sf_dir), path)
    built |= warehouse.build_panels(built, path)
    _WRITTEN[path] = built
    return built


def marts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The stored marts and panels; built on first use in a session."""
    return _once(spark, sf_dir, "marts", lambda _: build_marts(spark, sf_dir))


def stored_relations(spark: SparkSession, sf_dir: str, query: str) -> dict[str, str]:
    """For ``oracle.sql``: the tables that a query reads in Spark, as reads of the same files."""
    marts(spark, sf_dir)
    root = _raw_dir(spark, sf_dir)
    read = {
        "fact_entries": "fact_entries.parquet",
        "raw_facts": RAW_FILES["raw_edgar_facts"],
        "raw_prices": RAW_FILES["raw_yfinance_prices"],
        "raw_snapshot": RAW_FILES["raw_yfinance_valuation_snapshot"],
        "raw_series": RAW_FILES["raw_fred_series"],
    }
    computing = {"stage_facts", "balance_sheet", "income_statement", "financials"}
    if query not in computing:
        read["quarters"] = "marts/fct_financials_quarterly"
    if query not in computing | {"valuation_daily"}:
        read["valuation"], read["rate_day"] = "marts/fct_valuation_daily", "marts/rate_days"
    if query not in computing | {"valuation_daily", "monthly_changes", "quarterly_leverage_changes"}:
        read["month_change"], read["quarter_change"] = "marts/monthly_changes", "marts/quarterly_leverage_changes"
    texts = {rel: f"SELECT * FROM read_parquet('{current_location(spark, f'{root}/{path}')}/*.parquet')" for rel, path in read.items()}
    texts["raw_prices"] = texts["raw_prices"].replace("*", '* REPLACE (CAST("date" AS DATE) AS "date")', 1)
    return texts


def loaded_database(spark: SparkSession, sf_dir: str) -> str:
    """A database with one table per landed raw file."""
    raw_tables(spark, sf_dir)
    name = f"raw_{hashlib.md5(_raw_dir(spark, sf_dir).encode()).hexdigest()}"

    def load(path: str) -> str:
        load_raw(spark, _raw_dir(spark, sf_dir), name, path)
        return name

    return _once(spark, sf_dir, "database", load)


def grounding_files(spark: SparkSession, sf_dir: str) -> str:
    """The folder of the grounding table's CSV files."""

    def write(path: str) -> str:
        serving.write_grounding_csv(marts(spark, sf_dir)["fct_financials_quarterly"], path)
        return path

    return _once(spark, sf_dir, "grounding", write)


# ---- the same inputs as landed documents ----------------------------------------------


def concept_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ticker, tag, payload): one JSON document per entry; foreign forms sit under another unit."""
    entry = F.struct("start", "end", "val", "fy", "fp", "form", "filed")
    usd = F.when(F.col("form") != "8-K", F.array(entry))
    other = F.when(F.col("form") == "8-K", F.array(entry))
    units = F.struct(F.struct(usd.alias("USD"), other.alias("shares")).alias("units"))
    return fact_entries(spark, sf_dir).select("ticker", "tag", F.to_json(units).alias("payload"))


def series_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(series_id, payload): one JSON document per observation."""
    document = F.struct(F.array(F.struct("date", "value")).alias("observations"))
    return observations(spark, sf_dir).select("series_id", F.to_json(document).alias("payload"))


def snapshot_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ticker, payload): flat JSON with some keys missing."""
    key = F.col("s_suppkey")
    document = F.struct(
        (key * 1000 + 1_000_000).alias("sharesOutstanding"),
        F.when(key % 3 == 0, F.round(F.col("s_acctbal") * 100).cast("bigint")).alias("marketCap"),
        F.when(key % 4 == 0, (key % 50) * 0.5).alias("trailingPE"),
        F.lit("x").alias("sector"),
    )
    return _table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("S"), key.cast("string")).alias("ticker"), F.to_json(document).alias("payload")
    )


def price_download(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily prices under the provider's compound headers, with columns to ignore."""
    prices = raw_tables(spark, sf_dir, ["raw_yfinance_prices"])["raw_yfinance_prices"]
    return prices.select(
        F.col("date").alias("Date"),
        F.col("close").alias("('Close', 'ALL')"),
        (F.col("close") + 1).alias("('High', 'ALL')"),
        F.col("volume").alias("('Volume', 'ALL')"),
        "ticker",
    )


# ---- documents written to files, one for each company, tag or series --------------------


def _bundles(spark: SparkSession, sf_dir: str, label: str, documents: Callable[[], DataFrame], keys: list[str]) -> str:
    """Bundles with one document for each row of ``documents()`` (keys, value); their number is the companies'."""

    def write(path: str) -> str:
        land_documents(documents(), path, keys)
        return path

    return _once(spark, sf_dir, f"documents/{label}", write)


def _document_files(spark: SparkSession, sf_dir: str, label: str, documents: Callable[[], DataFrame], keys: list[str]) -> str:
    """One text file per row of ``documents()`` (keys, value) under key=value folders."""

    def write(path: str) -> str:
        documents().write.mode("overwrite").partitionBy(*keys).text(path)
        return path

    return _once(spark, sf_dir, f"documents/{label}", write)


def concept_files(spark: SparkSession, sf_dir: str) -> str:
    """All entries of a (ticker, tag) in one document, whole numbers written with a fraction of zero.

    The entries of a document are bounded by the quarters on file.
    """

    def documents() -> DataFrame:
        whole = [F.col(c).cast("decimal(20,1)").alias(c) for c in ("val", "fy")]
        entry = F.struct("start", "end", *whole, "fp", "form", "filed")
        usd, other = (F.collect_list(F.when(test, entry)) for test in (F.col("form") != "8-K", F.col("form") == "8-K"))
        units = F.struct(F.struct(usd.alias("USD"), other.alias("shares")).alias("units"))
        return fact_entries(spark, sf_dir).groupBy("ticker", "tag").agg(F.to_json(units).alias("value"))

    return _bundles(spark, sf_dir, "concepts", documents, ["ticker", "tag"])


def series_files(spark: SparkSession, sf_dir: str) -> str:
    """All observations of a series in one document, bounded by its months."""

    def documents() -> DataFrame:
        whole = F.struct(F.collect_list(F.struct("date", "value")).alias("observations"))
        return observations(spark, sf_dir).groupBy("series_id").agg(F.to_json(whole).alias("value"))

    return _document_files(spark, sf_dir, "series", documents, ["series_id"])


def snapshot_files(spark: SparkSession, sf_dir: str) -> str:
    return _bundles(
        spark, sf_dir, "snapshot", lambda: snapshot_documents(spark, sf_dir).withColumnRenamed("payload", "value"), ["ticker"]
    )


def price_files(spark: SparkSession, sf_dir: str) -> str:
    """One CSV text per ticker, tickers as zero-led digits; the columns' order and headers differ by ticker.

    The lines of a text are bounded by the calendar.
    """

    def documents() -> DataFrame:
        prices = raw_tables(spark, sf_dir, ["raw_yfinance_prices"])["raw_yfinance_prices"]
        number = F.substring("ticker", 2, 18).cast("long")
        day, close, volume = F.date_format("date", "yyyy-MM-dd"), F.col("close").cast("string"), F.col("volume").cast("string")
        high = (F.col("close") + 1).cast("string")
        plain = number % 2 == 1
        line = F.when(plain, F.concat_ws(",", day, close, high, volume)).otherwise(F.concat_ws(",", day, volume, high, close))
        compound = "Date,\"('Volume', 'X')\",\"('High', 'X')\",\"('Close', 'X')\""
        header = F.when(F.first(plain), "Date,Close,High,Volume").otherwise(compound)
        return prices.groupBy(F.lpad(number.cast("string"), 6, "0").alias("ticker")).agg(
            F.concat_ws("\n", header, F.array_join(F.collect_list(line), "\n")).alias("value")
        )

    return _bundles(spark, sf_dir, "prices", documents, ["ticker"])
