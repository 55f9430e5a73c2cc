"""Tables whose new state appears all at once, checked while it is written.

A published table is a folder with one subfolder for each version and a log, ``_published``, in which
each finished version has an empty file named by its number and rows. A writer fills the next version's
folder, checks it by what an observation saw during that very write, and only then adds the version's file
to the log. Readers follow the log's last file. A job that is killed or fails its checks leaves a
folder that the log doesn't name; the version of before stays what readers get, and the next writer
overwrites the folder. One writer at a time is assumed.

A folder without a log is read as it is, so plain Parquet landed by others stays readable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType, StringType, StructType

from ledgerline.sources.documents import Accounts

LOG = "_published"
#: Quantiles taken of the sort keys while a table is written, and rows of one file of a sorted table.
QUANTILES = 256
ROWS_PER_FILE = 2_000_000
_DAYS = 1 << 17  # dates as numbers of days, from 1790 on, below this


class CheckFailed(ValueError):
    """What was written breaks its rules; it was not published."""


def versions(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """(version, rows) of every finished version, oldest first; empty where nothing was published."""
    at = f"{path.rstrip('/')}/{LOG}"
    place, files = _files(spark, at)
    if not files.exists(place):
        return []
    names = [str(f.getPath().getName()) for f in files.listStatus(place)]
    return sorted((int(v), int(n)) for v, n in (name.split("-") for name in names if name[0].isdigit()))


def _folder(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/v{version:08d}"


def current_location(spark: SparkSession, path: str) -> str:
    """The folder that holds the table's present state."""
    found = versions(spark, path)
    return _folder(path, found[-1][0]) if found else path


def read_current(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The table's present state; reading goes on from the same version whatever is published meanwhile."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(current_location(spark, path))


def publish(
    df: DataFrame,
    path: str,
    not_null: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    accounts: Accounts | None = None,
    name: str = "",
    rows_per_file: int = ROWS_PER_FILE,
    placed_by: DataFrame | None = None,
) -> int:
    """Write ``df`` as the table's next version and publish it; the number of rows.

    A null in one of the ``not_null`` columns, or ``accounts`` that don't settle, raise an error and
    publish nothing. With ``sort_by`` the rows are written twice but computed once, see ``sorted_by``. With
    ``placed_by``, a table that is cheap to read and has the same sort keys but for a few, they are written once: the
    ranges and their number come from it. It only places rows; those whose keys it lacks are written like others.
    """
    spark = df.sparkSession
    done = versions(spark, path)
    version = done[-1][0] + 1 if done else 1
    target = _folder(path, version)
    seen = Observation()
    watched: dict[str, Column] = {"rows": F.count(F.lit(1))}
    watched |= {f"null_{k}": F.count_if(F.col(c).isNull()) for k, c in enumerate(not_null)}
    twice = bool(sort_by) and placed_by is None
    first = f"{target}-unsorted" if twice else target
    if twice:
        watched["bounds"] = _bounds(df, sort_by)
    counted = df.observe(seen, *[c.alias(n) for n, c in watched.items()])
    if sort_by and not twice:
        at = placed_by.agg(F.count(F.lit(1)).alias("rows"), _bounds(placed_by, sort_by).alias("bounds")).first()
        files = max(-(-at["rows"] // rows_per_file), 1)
        # One file is one task's sort, not one task's computation.
        counted = sorted_by(counted.repartition(1) if files == 1 else counted, sort_by, files, at["bounds"] or [])
    counted.write.mode("overwrite").parquet(first)
    found = seen.get
    nulls = {c: found[f"null_{k}"] for k, c in enumerate(not_null)}
    if any(nulls.values()):
        listed = ", ".join(f"{name or path}.{c}: {n}" for c, n in nulls.items() if n)
        raise CheckFailed(f"data checks failed: {listed}")
    if accounts:
        accounts.settle()
    if twice:
        stored = spark.read.schema(df.schema).parquet(first)
        files = max(-(-found["rows"] // rows_per_file), 1)
        sorted_by(stored, sort_by, files, found["bounds"] or []).write.mode("overwrite").parquet(target)
        remove(spark, first)
    place, files = _files(spark, f"{path.rstrip('/')}/{LOG}/{version:08d}-{found['rows']}")
    files.create(place, True).close()
    return found["rows"]


def _bounds(df: DataFrame, keys: Sequence[str]) -> Column:
    return F.approx_percentile(order_code(df, keys), [k / QUANTILES for k in range(1, QUANTILES)], 20 * QUANTILES)


def order_code(df: DataFrame, keys: Sequence[str]) -> Column:
    """A whole number that never falls where the keys rise: the first bytes of a text, then a date.

    For one date or whole number, or a text followed by a date; null comes first.
    """
    kinds = [df.schema[k].dataType for k in keys]

    def days(column: str) -> Column:
        return F.coalesce(F.datediff(F.col(column), F.lit("1790-01-01").cast("date")).cast("long"), F.lit(-(1 << 40)))

    if len(kinds) == 1 and isinstance(kinds[0], DateType):
        return days(keys[0])
    if len(kinds) == 1 and isinstance(kinds[0], IntegralType):
        return F.coalesce(F.col(keys[0]).cast("long"), F.lit(-(1 << 63)))
    if len(kinds) == 2 and isinstance(kinds[0], StringType) and isinstance(kinds[1], DateType):
        start = F.hex(F.substring(F.encode(F.coalesce(F.col(keys[0]), F.lit("")), "UTF-8"), 1, 5))
        number = F.conv(F.rpad(start, 10, "0"), 16, 10).cast("long")
        return number * _DAYS + F.least(F.greatest(days(keys[1]), F.lit(0)), F.lit(_DAYS - 1))
    raise TypeError(f"no order code for {', '.join(f'{k} {t.simpleString()}' for k, t in zip(keys, kinds, strict=True))}")


def sorted_by(df: DataFrame, keys: Sequence[str], files: int, bounds: Sequence[int]) -> DataFrame:
    """``df`` dealt to ``files`` ranges of its keys, each sorted.

    ``bounds`` are quantiles of the order code over all rows, from a mergeable sketch that was taken
    while ``df`` was written; so nothing is sampled and ``df`` is read once. A text that holds much of the rows
    spans several files by its dates. More files than quantiles split a range by the rows' hashes.
    """
    if files > 1:
        ranges = min(files, len(bounds) + 1)
        chosen = [bounds[round(k * (len(bounds) + 1) / ranges) - 1] for k in range(1, ranges)]
        place = _place(order_code(df, keys), chosen)
        each = -(-files // ranges)
        if each > 1:
            place = place * each + F.pmod(F.xxhash64(*df.columns), F.lit(each)).cast("int")
        dealt = df.repartitionById(ranges * each, place)
    else:
        dealt = df.coalesce(1)
    return dealt.sortWithinPartitions(*keys)


def _place(code: Column, bounds: Sequence[int]) -> Column:
    """How many of the rising ``bounds`` lie below ``code``, by halving."""
    steps = len(bounds).bit_length()
    padded = F.array(*[F.lit(b).cast("long") for b in [*bounds, *[(1 << 63) - 1] * ((1 << steps) - 1 - len(bounds))]])

    def step(low: Column, half: Column) -> Column:
        return F.when(F.get(padded, low + half - 1) < code, low + half).otherwise(low)

    return F.aggregate(F.array(*[F.lit(1 << k) for k in range(steps - 1, -1, -1)]), F.lit(0), step)


def _files(spark: SparkSession, path: str) -> tuple:
    """(the path, the file system it lies in) as the cluster's Hadoop client sees them."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that no reader uses."""
    place, files = _files(spark, path)
    files.delete(place, True)


def expire(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Delete the folders of all versions but the last ``keep``; call it when no reader uses them any more."""
    old = [version for version, _ in versions(spark, path)[:-keep]]
    for version in old:
        remove(spark, _folder(path, version))
    return old


def swap_table(spark: SparkSession, table: str, df_schema: StructType, location: str) -> None:
    """Point a catalog table at a published folder; a table that isn't there, or has other columns, is declared anew."""
    if spark.catalog.tableExists(table):
        if [(f.name, f.dataType) for f in spark.table(table).schema] == [(f.name, f.dataType) for f in df_schema]:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
            spark.catalog.refreshTable(table)
            return
        spark.sql(f"DROP TABLE {table}")
    spark.catalog.createTable(table, path=location, source="parquet", schema=df_schema)


def publish_table(df: DataFrame, table: str, location: str, **rules) -> int:
    """``publish`` below ``location``, then the catalog's table follows; the number of rows."""
    rows = publish(df, location, name=table, **rules)
    swap_table(df.sparkSession, table, df.schema, current_location(df.sparkSession, location))
    return rows
