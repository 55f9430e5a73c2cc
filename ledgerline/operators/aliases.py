"""Choosing one tag per concept, and reporting concepts without data."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def floor_date(df: DataFrame, column: str, start: str) -> DataFrame:
    """Keep rows on or after an ISO date; compared as text, so the filter reaches the scan."""
    return df.filter(F.col(column) >= F.lit(start))


def resolve_aliases(facts: DataFrame, aliases: DataFrame) -> DataFrame:
    """Keep, per (ticker, concept), all rows of the best tag that has any row.

    ``aliases`` is the fixed (concept, tag, priority) list, a few dozen rows, hence broadcast.
    Facts that already name a concept must match on it; otherwise the tag assigns it. The best
    priority per (ticker, concept) is a partial aggregation of a few rows per company, joined
    back: the facts are scanned twice but never sorted or gathered by company.
    """
    columns = facts.columns if "concept" in facts.columns else ["ticker", "concept", "tag"] + [
        c for c in facts.columns if c not in ("ticker", "tag")
    ]
    on = [c for c in ("concept", "tag") if c in facts.columns]
    tagged = facts.join(F.broadcast(aliases), on)
    best = tagged.groupBy("ticker", "concept").agg(F.min("priority").alias("priority"))
    return tagged.join(best, ["ticker", "concept", "priority"], "left_semi").select(*columns)


def missing_concepts(facts: DataFrame, companies: DataFrame, concepts: Iterable[str]) -> DataFrame:
    """(ticker, concept) pairs of the company list that have no fact at all."""
    expected = companies.select("ticker", F.explode(F.array(*map(F.lit, concepts))).alias("concept"))
    present = facts.select("ticker", "concept").distinct()
    return expected.join(present, ["ticker", "concept"], "left_anti")
