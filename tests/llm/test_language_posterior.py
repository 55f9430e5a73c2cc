"""Language of pages against the same posterior worked out by plain loops, and against what pages declare."""

import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import langid, queries


def visible(html):
    bare = re.sub(r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>", " ", html or "")
    return re.sub(r"&#?\w{1,8};", " ", re.sub(r"(?s)<[^>]*>", " ", bare))


def address(url):
    host = re.match(r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", (url or "").lower())
    host = host[1] if host else ""
    code = re.match(r"^[a-z][a-z0-9+.-]*://[^/?#]*/([a-z]{2})(?:[/?#-]|$)", (url or "").lower())
    return host, ".".join(host.split(".")[-2:]), host.split(".")[-1], code[1] if code else ""


def posterior(pages, docs, weight=60, smoothing=4.0):
    """(lang, confidence, text_lang) of each (id, url, html)."""
    counts = defaultdict(Counter)
    for lang, text in docs:
        if lang is not None and text is not None:
            counts[lang].update(langid.trigrams(text.encode()).tolist())
    names = sorted(counts)
    size = {x: sum(counts[x].values()) + 0.5 * langid.BUCKETS for x in names}
    read = []
    for _, url, html in pages:
        at = langid.trigrams(visible(html).encode()).tolist()
        said = re.search(r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?\s*([a-z]{2,3})""", html or "")
        text = None
        if at:
            text = [sum(math.log((counts[x][b] + 0.5) / size[x]) for b in at) * min(1.0, weight / len(at)) for x in names]
            text = [v - max(text) for v in text]
        host, domain, suffix, code = address(url)
        read.append({"text": text, "host": host, "domain": domain, "suffix": suffix, "code": code, "declared": said[1].lower() if said else ""})
    votes = {key: defaultdict(Counter) for key in ("host", "domain", "suffix", "code", "declared")}
    overall = Counter({k: 1.0 for k in range(len(names))})
    for r in read:
        r["vote"] = r["text"].index(0.0) if r["text"] else None
        if r["vote"] is not None:
            overall[r["vote"]] += 1
            for key, table in votes.items():
                table[r[key]][r["vote"]] += 1
    total = sum(overall.values())
    base = [overall[k] / total for k in range(len(names))]
    out = []
    for r in read:

        def smoothed(key, behind, r=r):
            own = [max(votes[key][r[key]][k] - (r["vote"] == k), 0) for k in range(len(names))]
            return [(a + smoothing * b) / (sum(own) + smoothing) for a, b in zip(own, behind, strict=True)]

        odds = [math.log(p) for p in smoothed("host", smoothed("domain", base))]
        for key in ("declared", "code", "suffix"):
            odds = [o + math.log(a / b) for o, a, b in zip(odds, smoothed(key, base), base, strict=True)]
        odds = [o + t for o, t in zip(odds, r["text"] or [0.0] * len(names), strict=True)]
        best = max(odds)
        out.append((names[odds.index(best)], 1 / sum(math.exp(o - best) for o in odds), None if r["vote"] is None else names[r["vote"]]))
    return out


def test_query_against_plain_loops(spark, sf_dir):
    pages = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()]
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text").collect()]
    got = {r["page_id"]: r for r in queries.op2_language_id(spark, sf_dir).collect()}
    assert len(got) == len(pages)
    for page, (lang, confidence, text_lang) in zip(pages, posterior(pages, docs), strict=True):
        r = got[page[0]]
        assert (r["lang"], r["text_lang"]) == (lang, text_lang) and r["confidence"] == pytest.approx(confidence, rel=1e-9)


def test_suffix_speaks_for_itself(spark):
    """Pages without words, declaration or known host: the suffix decides."""
    docs = spark.createDataFrame([("de", "das haus und der garten des herrn"), ("en", "the house and the garden of the king")], "lang string, text string")
    rows = [(k, f"http://h{k}.a{k}.de/", "<p>der garten und das haus</p>") for k in range(12)]
    rows += [(100 + k, f"http://h{k}.b{k}.uk/", "<p>the king of the house</p>") for k in range(30)]
    rows += [(200, "http://new.other.de/", "<p></p>"), (201, "http://new.other.uk/", None), (202, "http://new.other.xx/", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: (r["lang"], r["confidence"]) for r in langid.identify(pages, docs).collect()}
    assert got[200][0] == "de" and got[201][0] == "en" and got[202][0] == "en"
    known = [(r["lang"], r["text"]) for r in docs.collect()]
    for (i, _, _), (lang, confidence, _) in zip(rows, posterior(rows, known), strict=True):
        assert got[i] == (lang, pytest.approx(confidence, rel=1e-9))


def test_agrees_with_what_pages_declare(spark, sf_dir):
    """The declared language and the address' code are hidden; what is left finds the declared one."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    shown = pages.withColumn("html", F.regexp_replace("html", "(?i)<html[^>]*>", "<html>"))
    shown = shown.withColumn("url", F.regexp_replace("url", "^([a-z]+://[^/]*)/.*", "$1/"))
    blind = langid.identify(shown, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    said = langid.addresses(pages).select("page_id", F.col("declared").alias("said")).where("said in ('de', 'en', 'es', 'fr')")
    both = blind.join(said, "page_id")
    right = both.where("lang = said").count() / both.count()
    assert right > 0.8
