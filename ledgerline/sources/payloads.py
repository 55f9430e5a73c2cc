"""Landed JSON and CSV documents to tabular frames.

Documents are read by directory, one task per group of files. The layout names the entity in
the path (``ticker=MSFT/tag=Assets/...``), which Spark turns into columns and prunes on. Where documents
are many, they are landed in bundles (``bundles``) with the same names as columns; readers take either.

Nothing is dropped in silence: a document that isn't one whole value of its schema, a file without
content, or a number that must be whole and isn't, ends the read with an error that names the trouble.
"""

from __future__ import annotations

import csv
import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerline import schemas
from ledgerline.dims import START_DATE, alias_dim
from ledgerline.functions.scalars import nan_to_null, tolerant_double
from ledgerline.operators.aliases import floor_date, resolve_aliases
from ledgerline.sources.bundles import VALUE, bundled_documents, is_bundled
from ledgerline.sources.documents import Accounts, SourceError, parse, plain, read_documents, require_content

FACT_COLUMNS = schemas.RAW_FACTS.fieldNames()
PRICE_COLUMNS = ["date", "close", "volume"]


def _parsed(documents: DataFrame, payload: str, schema, keys: list[str]) -> DataFrame:
    return parse(documents, payload, schema, F.concat_ws(", ", *keys))


def _read(spark: SparkSession, path: str, keys: list[str], schema: StructType, accounts: Accounts | None) -> DataFrame:
    """One parsed document (``_doc``) for each file or bundled row below ``path``."""
    if not is_bundled(spark, path):
        return read_documents(spark, path, keys, schema, accounts)
    documents, published = bundled_documents(spark, path, keys)
    parsed = _parsed(documents, VALUE, schema, keys)
    return accounts.watch_bundles(parsed, path, published) if accounts else parsed


def _whole(column: str, kind: str = "bigint") -> Column:
    """A decimal as a whole number; an error for one with a fraction."""
    value = F.col(column)
    broken = F.raise_error(F.concat(F.lit(f"{column.rpartition('.')[2]} must be whole: "), value.cast("string")))
    return F.when(value.isNull() | (value == F.floor(value)), value.cast(kind)).otherwise(broken.cast(kind))


def flatten_company_concept(documents: DataFrame, payload: str | None = None) -> DataFrame:
    """One row per entry of ``units.USD``; other units and absent arrays give no rows.

    ``documents`` holds ticker, tag and either a text column ``payload`` or a parsed ``_doc``.
    """
    parsed = _parsed(documents, payload, schemas.CONCEPT_PAYLOAD, ["ticker", "tag"]) if payload else documents
    entries = parsed.select("ticker", "tag", F.explode("_doc.units.USD").alias("_fact")).select("ticker", "tag", "_fact.*")
    return entries.withColumns({"val": _whole("val"), "fy": _whole("fy", "int")})


def read_company_concepts(spark: SparkSession, path: str, accounts: Accounts | None = None) -> DataFrame:
    """Every ``ticker=*/tag=*`` concept document below ``path``, a file or bundled, flattened."""
    return flatten_company_concept(_read(spark, path, ["ticker", "tag"], schemas.CONCEPT_PAYLOAD, accounts))


def raw_facts(flattened: DataFrame, start: str = START_DATE, aliases: DataFrame | None = None) -> DataFrame:
    """Flattened entries to the raw fact table: date floor, alias choice, known columns."""
    aliases = alias_dim(flattened.sparkSession) if aliases is None else aliases
    return keep_known(resolve_aliases(floor_date(flattened, "end", start), aliases))


def keep_known(facts: DataFrame) -> DataFrame:
    """The fact columns that are present, in their fixed order."""
    return facts.select(*[c for c in FACT_COLUMNS if c in facts.columns])


def union_tolerant(frames: list[DataFrame], columns: list[str] | None = None) -> DataFrame:
    """Stack frames whose columns differ; a column absent from one frame is null there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out if columns is None else out.select(*[c for c in columns if c in out.columns])


def flatten_series(documents: DataFrame, payload: str | None = None) -> DataFrame:
    """(date, value, series_id) per observation; text that is no number becomes null."""
    parsed = _parsed(documents, payload, schemas.SERIES_PAYLOAD, ["series_id"]) if payload else documents
    return parsed.select("series_id", F.explode("_doc.observations").alias("_obs")).select(
        F.col("_obs.date").alias("date"), tolerant_double("_obs.value").alias("value"), "series_id"
    )


def read_series(spark: SparkSession, path: str, accounts: Accounts | None = None) -> DataFrame:
    """Every ``series_id=*`` document below ``path``, a file or bundled, in one read."""
    return flatten_series(_read(spark, path, ["series_id"], schemas.SERIES_PAYLOAD, accounts))


def shape_prices(raw: DataFrame) -> DataFrame:
    """(date, close, volume, ticker) from a price download.

    Headers may be plain (``Close``) or compound (``('Close', 'MSFT')``); only the first level
    counts. Other columns are dropped.
    """
    first_level = {re.sub(r"^\W*(\w+).*$", r"\1", c).lower(): c for c in raw.columns}

    def column(name: str):
        return F.col(f"`{first_level[name]}`")

    return raw.select(
        column("date").cast("timestamp_ntz").alias("date"),
        nan_to_null(column("close").cast("double")).alias("close"),
        column("volume").cast("bigint").alias("volume"),
        column("ticker").cast("string").alias("ticker"),
    )


def first_levels(header: str) -> list[str]:
    """The first-level names of a CSV header line, in lower case: ``Close`` and ``('Close', 'MSFT')`` both give close."""
    return [re.sub(r"^\W*(\w+).*$", r"\1", c).lower() for c in next(csv.reader([header]), [])]


def price_layouts(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """{first-level names of a header: files that begin with it}, from one pass over the lines.

    Only a header names all the wanted columns, so the pass brings back one line for each file. A
    file without such a line ends the read, an empty file too.
    """
    listed = require_content(spark, path)
    lines = spark.read.format("text").schema("value string").load(path)
    named = [F.col("value").rlike(rf"(?i)(^|\W){name}(\W|$)") for name in PRICE_COLUMNS]
    headers = lines.where(reduce(Column.__and__, named)).select("value", F.col("_metadata.file_path").alias("file"))
    layouts: dict[tuple[str, ...], list[str]] = {}
    missing = set(listed)
    for row in headers.toLocalIterator():
        file, names = unquote(row["file"]), tuple(first_levels(row["value"]))
        if set(PRICE_COLUMNS) <= set(names):
            if plain(file) not in missing:
                raise SourceError(f"prices with two headers: {file}")
            missing.remove(plain(file))
            layouts.setdefault(names, []).append(file)
    if missing:
        raise SourceError(f"prices without the columns {', '.join(PRICE_COLUMNS)}: {', '.join(sorted(missing))}")
    return layouts


def _first_levels(header: Column) -> Column:
    """``first_levels`` of a column of header lines."""
    cells = F.split(header, r',(?=(?:[^"]*"[^"]*")*[^"]*$)', -1)
    return F.transform(cells, lambda c: F.lower(F.regexp_replace(c, r"(?U)^\W*(\w+).*$", "$1")))


def bundled_prices(documents: DataFrame) -> DataFrame:
    """(date, close, volume, ticker) as text from whole CSV texts, each read by its own header line.

    A first pass finds the different orders of columns; the second parses every line by the order of
    its text. What ends the read of a file ends it here, naming the ticker.
    """
    text = F.coalesce("value", F.lit(""))
    # Lines of blanks and control characters count as no lines, as in a file.
    header = F.regexp_extract(text, r"^[\x00-\x20]*([^\r\n]*)", 1)
    lines = F.filter(F.split(text, r"\r\n|\r|\n", -1), lambda x: x.rlike(r"[^\x00-\x20]"))
    headed = documents.select("ticker", lines.alias("_lines"), _first_levels(header).alias("_names"))
    wanted = F.array(*map(F.lit, PRICE_COLUMNS))
    orders = sorted(tuple(r["_names"]) for r in headed.select("_names").distinct().toLocalIterator() if set(PRICE_COLUMNS) <= set(r["_names"]))

    said = F.concat(F.lit(f"prices without the columns {', '.join(PRICE_COLUMNS)}: "), F.coalesce("ticker", F.lit("?")))
    known = F.size(F.array_except(wanted, "_names")) == 0
    checked = headed.filter(F.when(known, True).otherwise(F.raise_error(said).cast("boolean")))
    each = checked.select("ticker", "_names", F.explode(F.slice("_lines", 2, F.greatest(F.size("_lines") - 1, F.lit(0)))).alias("_line"))
    # Few lines name a column, and only those are taken apart.
    named = reduce(Column.__and__, [F.contains(F.lower("_line"), F.lit(c)) for c in PRICE_COLUMNS])
    again = named & (F.size(F.array_except(wanted, _first_levels(F.col("_line")))) == 0)
    said = F.concat(F.lit("prices with two headers: "), F.coalesce("ticker", F.lit("?")))
    each = each.filter(F.when(again, F.raise_error(said).cast("boolean")).otherwise(True))

    def cells(names: tuple[str, ...]) -> Column:
        kind = StructType([StructField(name if names.index(name) == k and name in PRICE_COLUMNS else f"_cell{k}", StringType()) for k, name in enumerate(names)])
        read = F.from_csv("_line", F.lit(kind.simpleString()), {"mode": "FAILFAST"})
        return F.struct(*[read[c].alias(c) for c in PRICE_COLUMNS])

    if not orders:
        return each.select(*[F.lit(None).cast("string").alias(c) for c in PRICE_COLUMNS], "ticker")
    parsed = reduce(lambda chain, n: chain.when(F.col("_names") == F.array(*map(F.lit, n)), cells(n)), orders, F)
    return each.select(parsed.alias("_cells"), "ticker").select("_cells.*", "ticker")


def read_prices(spark: SparkSession, path: str) -> DataFrame:
    """``ticker=*`` CSV downloads, a file each or bundled, each read by its own header line; tickers stay text.

    Two passes, both native: the header lines first, then one CSV scan for each layout, which
    parses the wanted columns only and splits long files. A line with too few or too many cells
    ends the read, and so does a header that isn't a file's first line.
    """
    if is_bundled(spark, path):
        return shape_prices(bundled_prices(bundled_documents(spark, path, ["ticker"])[0]))
    scans = []
    for names, files in price_layouts(spark, path).items():
        wanted = {names.index(c): c for c in PRICE_COLUMNS}
        schema = StructType([StructField(wanted.get(k, f"_cell{k}"), StringType()) for k in range(len(names))])
        reader = spark.read.schema(schema.add("ticker", StringType())).options(header=True, mode="FAILFAST", basePath=path)
        # Malformed lines are only seen if all cells are parsed.
        reader = reader.option("columnPruning", False)
        scans.append(reader.csv(files).select(*PRICE_COLUMNS, "ticker"))
    if not scans:
        return spark.createDataFrame([], schemas.RAW_PRICES)
    return shape_prices(reduce(DataFrame.unionByName, scans))


def shape_snapshot(documents: DataFrame, payload: str | None = None) -> DataFrame:
    """One row per ticker document; keys missing from it are null."""
    parsed = _parsed(documents, payload, schemas.SNAPSHOT_PAYLOAD, ["ticker"]) if payload else documents
    return parsed.select(
        "ticker",
        _whole("_doc.marketCap").alias("market_cap"),
        _whole("_doc.enterpriseValue").alias("enterprise_value"),
        F.col("_doc.trailingPE").alias("trailing_pe"),
        F.col("_doc.forwardPE").alias("forward_pe"),
        F.col("_doc.enterpriseToEbitda").alias("ev_to_ebitda"),
        _whole("_doc.sharesOutstanding").alias("shares_outstanding"),
        _whole("_doc.totalDebt").alias("total_debt"),
        _whole("_doc.totalCash").alias("total_cash"),
    )


def read_snapshot(spark: SparkSession, path: str, accounts: Accounts | None = None) -> DataFrame:
    """Every ``ticker=*`` snapshot document below ``path``, a file or bundled."""
    return shape_snapshot(_read(spark, path, ["ticker"], schemas.SNAPSHOT_PAYLOAD, accounts))
