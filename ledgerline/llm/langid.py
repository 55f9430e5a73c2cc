"""Language of web pages by Bayesian fusion of evidence.

For each language the log odds of four kinds of evidence are added up:

* the text's likelihood under byte-trigram counts of documents of known language, cut to that of at
  most ``text_weight`` trigrams, as neighbouring trigrams are not independent;
* the language declared in the markup;
* the address' suffix (its last label) and the language code in its path: as for the declared language,
  how often such a value goes with a language is counted over all pages, smoothed;
* a prior of the host. Counts of a host's pages by language are smoothed by those of its domain,
  and these by those of all pages.

All counts over pages are grouped aggregations over all pages, taking each page's most likely
language by its text; a page's own count is left out of its priors. The trigram table has a fixed
number of entries a language and is the only thing sent to all tasks; hosts, domains and suffixes
are joined, so their number doesn't matter.

Defined results: a page without text (null, or no visible characters) has no text evidence and is
not counted; a null or odd address has the empty host, domain and suffix; a missing declaration is
a value of its own. Repeated rows each get their row and count each. Without documents of known
language, language and confidence are null. Equal odds go to the first language in order. An empty
table gives an empty result. Of pages only ``page_id``, ``url`` and ``html`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.frames import cut, small_batches, text_udf
from ledgerline.llm.words import chunks

BUCKETS = 1 << 16
LEVELS = ("host", "domain")
SIGNS = ("declared", "code", "suffix")


def trigrams(data: bytes) -> np.ndarray:
    """Bucket of each run of three bytes of a text, lower-cased (A-Z), white space as one space."""
    b = np.frombuffer(b" " + b" ".join(data.lower().split()) + b" ", dtype=np.uint8).astype(np.uint64)
    if len(b) < 5:
        return np.zeros(0, dtype=np.int64)
    joined = (b[:-2] << np.uint64(16)) | (b[1:-1] << np.uint64(8)) | b[2:]
    return ((joined * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.int64)


def fit_languages(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """(languages, log probabilities by language and bucket) from all documents (lang, text)."""
    small_batches(docs.sparkSession)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                own = total.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                own += np.bincount(trigrams(text.encode()), minlength=BUCKETS)
        for lang, n in total.items():
            found = np.flatnonzero(n)
            yield pd.DataFrame({"lang": lang, "bucket": found, "n": n[found]})

    known = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    known = known.where("lang is not null and text is not null")
    counts = known.mapInPandas(counted, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(counts["lang"].unique().tolist())
    table = np.full((len(languages), BUCKETS), 0.5)
    table[counts["lang"].map({name: k for k, name in enumerate(languages)}).astype(int), counts["bucket"].astype(int)] += counts["n"]
    return languages, np.log(table / table.sum(axis=1, keepdims=True)) if languages else table


def _text_evidence(table: np.ndarray, text_weight: int) -> Column:
    """Log likelihood of the text under each language, centred; null without visible characters."""

    def scored(texts: pd.Series) -> pd.DataFrame:
        out = []
        for _, group in chunks(texts.tolist()):
            for data in group:
                at = trigrams(data)
                if not len(at):
                    out.append(None)
                    continue
                total = table[:, at].sum(axis=1) * min(1.0, text_weight / len(at))
                out.append((total - total.max()).tolist())
        return pd.DataFrame({"by_language": out, "n_trigrams": [0 if o is None else 1 for o in out]})

    return text_udf(scored, "by_language array<double>, n_trigrams int")("shown")


def addresses(pages: DataFrame) -> DataFrame:
    """(page_id, shown, declared, code, host, domain, suffix) from (page_id, url, html)."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    bare = F.regexp_replace(html, r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>", " ")
    shown = F.regexp_replace(F.regexp_replace(bare, r"(?s)<[^>]*>", " "), r"&#?\w{1,8};", " ")
    url = F.lower(F.coalesce(F.col("url").cast("string"), F.lit("")))
    host = F.regexp_extract(url, r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    labels = F.split(host, r"\.")
    return pages.select(
        "page_id",
        shown.alias("shown"),
        F.lower(F.regexp_extract(html, r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?\s*([a-z]{2,3})""", 1)).alias("declared"),
        F.regexp_extract(url, r"^[a-z][a-z0-9+.-]*://[^/?#]*/([a-z]{2})(?:[/?#-]|$)", 1).alias("code"),
        host.alias("host"),
        F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".").alias("domain"),
        F.element_at(labels, -1).alias("suffix"),
    )


def _voted(pages: DataFrame, key: str, languages: int) -> DataFrame:
    """Pages by value of ``key`` and language of the text, as one array a value."""
    votes = [F.count_if(F.col("vote") == k).cast("double") for k in range(languages)]
    return pages.where("vote is not null").groupBy(key).agg(F.array(*votes).alias(f"n_{key}"))


def identify(pages: DataFrame, docs: DataFrame, text_weight: int = 60, smoothing: float = 4.0) -> DataFrame:
    """(page_id, lang, confidence, text_lang, declared, code, host) for every row of ``pages``."""
    small_batches(pages.sparkSession)
    languages, table = fit_languages(docs)
    read = addresses(pages)
    names = F.array(*[F.lit(name) for name in languages]) if languages else F.array().cast("array<string>")
    if not languages:
        nothing = F.lit(None).cast("string")
        return read.select(
            "page_id", nothing.alias("lang"), F.lit(None).cast("double").alias("confidence"),
            nothing.alias("text_lang"), "declared", "code", "host",
        )
    n = len(languages)
    seen = read.withColumn("text", _text_evidence(table, text_weight)).drop("shown")
    seen = seen.withColumn("vote", F.when(F.col("text.by_language").isNotNull(), F.array_position("text.by_language", F.lit(0.0)).cast("int") - 1))
    seen = cut(seen)

    total = seen.agg(*[F.coalesce(F.count_if(F.col("vote") == k), F.lit(0)).alias(str(k)) for k in range(n)]).first()
    overall = np.array(list(total), dtype=float) + 1
    overall = F.array(*[F.lit(float(x)) for x in overall / overall.sum()])
    fused = seen
    for key in (*LEVELS, *SIGNS):
        fused = fused.join(_voted(seen, key, n), key, "left")

    def own(k: Column) -> Column:
        return F.when(F.col("vote") == k, 1.0).otherwise(0.0)

    def counts(key: str) -> Column:
        """The other pages' votes at this value."""
        none = F.array(*[F.lit(0.0)] * n)
        return F.transform(F.coalesce(f"n_{key}", none), lambda x, k: F.greatest(x - own(k), F.lit(0.0)))

    def smoothed(key: str, behind: Column) -> Column:
        given = counts(key)
        size = F.aggregate(given, F.lit(0.0), lambda a, b: a + b)
        return F.transform(F.arrays_zip(given.alias("a"), behind.alias("b")), lambda z: (z["a"] + z["b"] * smoothing) / (size + smoothing))

    fused = fused.withColumn("prior", overall)
    for key in reversed(LEVELS):
        fused = fused.withColumn("prior", smoothed(key, F.col("prior")))
    for key in SIGNS:
        # Odds of a language given the value over its overall odds: the value's likelihood but for a constant.
        fused = fused.withColumn(
            f"says_{key}", F.transform(F.arrays_zip(smoothed(key, overall).alias("a"), overall.alias("b")), lambda z: F.log(z["a"] / z["b"]))
        )
    even = F.array(*[F.lit(0.0)] * n)
    parts = F.arrays_zip(
        F.transform("prior", lambda p: F.log(p)).alias("p"), F.coalesce("text.by_language", even).alias("t"),
        *[F.col(f"says_{key}").alias(key) for key in SIGNS],
    )
    fused = fused.withColumn("odds", F.transform(parts, lambda z: z["p"] + z["t"] + sum((z[key] for key in SIGNS), F.lit(0.0))))
    fused = fused.withColumn("best", F.array_max("odds"))
    share = F.aggregate("odds", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("best")))
    return fused.select(
        "page_id",
        F.element_at(names, F.array_position("odds", F.col("best")).cast("int")).alias("lang"),
        (1 / share).alias("confidence"),
        F.when(F.col("vote").isNotNull(), F.element_at(names, F.col("vote") + 1)).alias("text_lang"),
        "declared", "code", "host",
    )
