"""What the operators share: table access, cutting lineage, rows with a score, bounded samples."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ledgerline.session import shared_dir

#: Rows of one Arrow batch. Texts vary from nothing to megabytes; a batch must fit a worker.
BATCH_ROWS = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Python stages of this session get batches of at most ``BATCH_ROWS`` rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def release() -> None:
    """Hand freed memory back to the system, at the end of a task that used much of it.

    A worker lives on through later stages, and several of them share an executor with its heap; the
    C library would keep what was freed for the worker's next task. Does nothing where it has no such call.
    """
    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared checkpoint folder.

    Every executor can read the copy, and Spark removes it once nothing refers to it (where
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set).
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def text_udf(function: Callable[[pd.Series], pd.DataFrame], schema: str) -> Callable[[str], Column]:
    """A column function that sees only the texts; other columns stay in the JVM."""

    def over(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield function(texts)

    over.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return pandas_udf(over, schema)


def rows_where(docs: DataFrame, verdict: Column, keep: Callable[[Column], Column]) -> DataFrame:
    """The rows of ``docs`` whose verdict struct passes; columns of any name stay as they are."""
    paired = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), verdict.alias("verdict"))
    return paired.where(keep(F.col("verdict"))).select("row.*")


def first_by_hash(ids: DataFrame, n: int, seed: int) -> DataFrame:
    """``n`` doc_ids by the order of a hash: a sample of fixed size that is the same on every run."""
    return ids.select("doc_id").where("doc_id is not null").orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(n)


def quality_labels(labels: DataFrame) -> DataFrame:
    """One row (doc_id, quality 0/1) for each labelled document; contradicting labels count as 0."""
    return labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))


def crc32_of_id(column: str = "doc_id") -> Column:
    """crc32 of the id as text; null ids count as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))
