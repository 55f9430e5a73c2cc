"""Raw parquet sink and loader, and reading marts back."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.schemas import RAW_TABLES
from ledgerline.sources.documents import Accounts
from ledgerline.sources.publication import publish, publish_table, read_current

# Raw table -> landed file.
RAW_FILES = {
    "raw_edgar_facts": "edgar_facts.parquet",
    "raw_yfinance_prices": "yfinance_prices.parquet",
    "raw_yfinance_valuation_snapshot": "yfinance_valuation_snapshot.parquet",
    "raw_fred_series": "fred_series.parquet",
}


def write_raw(df: DataFrame, path: str, accounts: Accounts | None = None) -> int:
    """Replace a landed table, all at once; the row count is observed during the write.

    ``accounts`` of the documents that ``df`` reads are settled before the new rows are shown.
    """
    return publish(df, path, accounts=accounts)


def read_raw(spark: SparkSession, raw_dir: str, tables: Iterable[str] = tuple(RAW_FILES)) -> dict[str, DataFrame]:
    """The landed raw tables under their declared schemas; a file not landed yet is skipped."""
    found = {}
    for table in tables:
        path = f"{raw_dir.rstrip('/')}/{RAW_FILES[table]}"
        try:
            found[table] = read_current(spark, path, RAW_TABLES[table])
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
    return found


def load_raw(spark: SparkSession, raw_dir: str, database: str = "raw", location: str | None = None) -> dict[str, int]:
    """Create or replace one table per landed file; returns rows per loaded table.

    ``location`` is the shared folder of a new database; the warehouse folder when not given. A
    table shows its old rows until all the new ones are there.
    """
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{at}")
    root = spark.catalog.getDatabase(database).locationUri.rstrip("/")
    return {
        table: publish_table(frame, f"{database}.{table}", f"{root}/{table}") for table, frame in read_raw(spark, raw_dir).items()
    }


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows) per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def read_mart(spark: SparkSession, name: str, schema: StructType, order: list[str] | None = None) -> DataFrame:
    """A mart by table or view name, optionally sorted; a typed empty frame when absent."""
    if not spark.catalog.tableExists(name):
        return spark.createDataFrame([], schema)
    table = spark.table(name)
    return table.orderBy(*order) if order else table
