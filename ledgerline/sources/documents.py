"""Reading landed documents so that every file is accounted for.

A JSON document counts as parsed when its text is one value that fits its schema, with nothing but
white space around it. Anything else ends the read with an error that names the file: no text,
blanks only, a document cut short, two documents in one file, text after the first value. ``null``
and a value of another kind than the schema's end it as well. Files without a byte, which Spark's
readers pass over, are found by comparing the listing with the files that have content.

``Accounts`` goes one step further for jobs that write: documents are counted by an observation while they
are read, and ``settle`` compares the count with the listing after the write.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

FILE = "_file"


class SourceError(ValueError):
    """A landed file is not what a reader can account for."""


def plain(uri: str) -> str:
    """A file's address as one text, however Spark spells it."""
    return re.sub(r"^file:/+", "file:/", unquote(uri))


def listed_files(spark: SparkSession, path: str) -> list[str]:
    """The files below ``path`` as Spark lists them, empty ones included."""
    return sorted(map(plain, spark.read.format("text").load(path).inputFiles()))


def require_content(spark: SparkSession, path: str) -> list[str]:
    """The files listed below ``path``; an error that names those without a byte. Reads no content."""
    listed = listed_files(spark, path)
    filled = spark.read.format("binaryFile").load(path).select("path")
    if filled.count() != len(listed):
        present = {plain(r["path"]) for r in filled.toLocalIterator()}
        raise SourceError(f"empty documents: {', '.join(f for f in listed if f not in present)}")
    return listed


class Accounts:
    """Files listed at the time of reading, and documents parsed by the action that followed."""

    def __init__(self) -> None:
        self._open: list[tuple[list[str], Observation]] = []
        self._bundled: list[tuple[str, int, Observation]] = []

    def watch(self, documents: DataFrame, listed: list[str]) -> DataFrame:
        seen = Observation()
        self._open.append((listed, seen))
        return documents.observe(seen, F.count(F.lit(1)).alias("documents"))

    def watch_bundles(self, documents: DataFrame, path: str, published: int) -> DataFrame:
        """The same for documents in bundles, of which a log names the number."""
        seen = Observation()
        self._bundled.append((path, published, seen))
        return documents.observe(seen, F.count(F.lit(1)).alias("documents"))

    def settle(self) -> int:
        """Documents parsed by the last action; an error if the listing had more or fewer."""
        total = 0
        for listed, seen in self._open:
            parsed = seen.get["documents"]
            if parsed != len(listed):
                raise SourceError(f"{len(listed)} files were listed and {parsed} documents parsed, from {listed[0] if listed else 'no file'} on")
            total += parsed
        for path, published, seen in self._bundled:
            parsed = seen.get["documents"]
            if parsed != published:
                raise SourceError(f"{published} documents were published and {parsed} parsed: {path}")
            total += parsed
        return total


def read_documents(spark: SparkSession, path: str, keys: Sequence[str], schema: StructType, accounts: Accounts | None = None) -> DataFrame:
    """One parsed document (``_doc``) per file under key=value directories, keys as string columns."""
    listed = require_content(spark, path)
    columns = ", ".join(f"{name} string" for name in ["value", *keys])
    text = spark.read.schema(columns).option("wholetext", "true").format("text").load(path)
    named = text.select("value", *keys, F.col("_metadata.file_path").alias(FILE))
    parsed = parse(named, "value", schema, F.col(FILE)).drop(FILE)
    return accounts.watch(parsed, listed) if accounts else parsed


def parse(documents: DataFrame, payload: str, schema: StructType, name: Column) -> DataFrame:
    """``documents`` with the text column ``payload`` replaced by ``_doc``; ``name`` tells them apart in errors.

    The text is parsed as the one member of a list that is closed by a seal no document can hold, its own hash.
    """
    text = F.col(payload)
    seal = F.xxhash64(text).cast("string")
    sealed = F.concat(F.lit('{"members":['), text, F.lit('],"seal":"'), seal, F.lit('"}'))
    kind = StructType().add("members", ArrayType(schema)).add("seal", StringType()).add("broken", StringType())
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"}
    read = documents.withColumn("_read", F.from_json(sealed, kind, options))
    # To add a member of its own a text must close the list, and a comma and a name must follow; only
    # then are the names counted, which takes another walk over the text.
    alone = F.when(text.rlike(r"""\]\s*,\s*["']"""), F.size(F.json_object_keys(sealed)) == 2).otherwise(True)
    whole = (
        F.col("_read.broken").isNull()
        & (F.col("_read.seal") == seal)
        & alone
        & (F.size("_read.members") == 1)
        & F.get("_read.members", F.lit(0)).isNotNull()
    )
    said = F.when(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " ")) == "", "empty").otherwise("not one whole document")
    trouble = F.concat(F.lit("malformed document ("), said, F.lit("): "), F.coalesce(name, F.lit("?")))
    # A filter is never pruned, whatever columns a reader asks for.
    checked = read.filter(F.when(F.coalesce(whole, F.lit(False)), True).otherwise(F.raise_error(trouble).cast("boolean")))
    return checked.withColumn("_doc", F.get("_read.members", F.lit(0))).drop(payload, "_read")
