"""Landed documents in bundles: a published table with one row for each document.

A file for each document costs a listing, an opening and two renames each, most of them on the driver; beyond some
ten thousand documents that is all a read does. A bundle holds many: the keys as text columns, and the document's
own text, byte for byte, as ``value``. The table's log names the number of documents, and every read compares
it with the files' footers, so that a lost part is found as a lost file would be.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructType

from ledgerline.sources.documents import SourceError
from ledgerline.sources.publication import publish, read_current, versions

VALUE = "value"


def land_documents(documents: DataFrame, path: str, keys: Sequence[str]) -> int:
    """Replace the bundles below ``path`` by ``documents`` (keys, value); the number of documents.

    A key may repeat or be null; a text that is no document ends the read, as in a file.
    """
    return publish(documents.select(*keys, VALUE), path)


def is_bundled(spark: SparkSession, path: str) -> bool:
    return bool(versions(spark, path))


def bundled_documents(spark: SparkSession, path: str, keys: Sequence[str]) -> tuple[DataFrame, int]:
    """The documents (keys, value) below ``path`` and their published number; an error if any is gone."""
    schema = StructType()
    for name in [*keys, VALUE]:
        schema = schema.add(name, StringType())
    documents, published = read_current(spark, path, schema), versions(spark, path)[-1][1]
    found = documents.count()
    if found != published:
        raise SourceError(f"{published} documents were published and {found} found: {path}")
    return documents, published
