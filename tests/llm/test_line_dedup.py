"""Line dedup: the filters, odd rows, insertions and deletions, and both ways of cleaning."""

import hashlib
from collections import defaultdict
from dataclasses import replace

import numpy as np
import pytest

from fixtures.compare import differences, duck
from ledgerline.llm import queries
from ledgerline.llm.line_dedup import Cuckoo, Filters, LineStore

SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SCHEMA = "doc_id long, text string, keys string, hi int, n_lines int, `a.b` int"


def brute(rows, known, min_docs, min_chars=1):
    """(doc_id, text, n_lines, n_dropped) for each row, by the lines of the documents in ``known``."""

    def key(line):
        return line.strip(SPACE).translate(LOWER)

    holders = defaultdict(set)
    for i, text in known:
        for line in (text or "").split("\n"):
            if i is not None and len(key(line)) >= max(min_chars, 1):
                holders[key(line)].add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [line for line in lines if len(holders[key(line)]) < min_docs]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "k", 1, 2, 3) for i, t in rows], SCHEMA)


def cleaned(store, docs):
    return sorted((tuple(r) for r in store.clean(docs).select("doc_id", "text", "n_lines", "n_dropped").collect()), key=str)


ODD = [
    (1, "Shared line\nown one\n\n  shared LINE \t"),
    (2, "shared line\r\nÄ shared\nown two"),
    (3, "\x0bSHARED LINE\x0c\nä shared\n"),
    (4, None),
    (5, ""),
    (6, " \t \n\n"),
    (7, "twice in one\ntwice in one\ntwice in one"),
    (8, "repeated id\nx"),
    (8, "repeated id\ny"),
    (8, "repeated id\ny"),
    (None, "shared line\nno id\nrepeated id"),
    (9, "Ä shared\nx y\nx "),
    (10, "long line " * 40_000 + "\nshared line\nx"),
]


def state(store):
    """What a store knows, whatever it went through."""
    counts = sorted(tuple(r) for r in store.counts.where("n > 0").select("hi", "lo", "n").collect())
    lo = np.array([r[1] for r in counts], dtype=np.int64)
    hi = np.array([r[0] for r in counts], dtype=np.int64)
    rows = {r["shard"]: bytes(r["filter"]) for r in store.filters.collect()}
    return counts, Filters(rows, store.shards).claims(hi, lo).tolist()


@pytest.mark.parametrize("min_chars", [1, 2])
def test_odd_rows(spark, min_chars):
    docs = frame(spark, ODD)
    store = LineStore(spark, min_docs=2, min_chars=min_chars, shards=3).insert(docs)
    assert cleaned(store, docs) == brute(ODD, ODD, 2, min_chars)
    assert cleaned(store, docs.limit(0)) == []
    nothing = LineStore(spark, min_docs=2).insert(docs.limit(0))
    assert cleaned(nothing, docs) == brute(ODD, [], 2)
    assert cleaned(LineStore(spark, min_docs=2), docs) == brute(ODD, [], 2)


def test_waves_give_the_same(spark):
    docs = frame(spark, ODD)
    store = LineStore(spark, min_docs=2, shards=5, broadcast_bytes=40).insert(docs)
    assert store.filters.count() > 1
    assert cleaned(store, docs) == brute(ODD, ODD, 2)


def test_insertions_and_deletions_are_reversible(spark):
    rows = [(i, "\n".join(f"line {k}" for k in range(i % 7, i % 7 + 5)) + f"\nown {i}") for i in range(60)]
    first, second = rows[:40], rows[25:]
    store = LineStore(spark, min_docs=6, shards=4)
    one = store.insert(frame(spark, first))
    both = one.insert(frame(spark, second))
    # Documents 25 to 39 come twice and count once.
    assert state(both)[0] == state(store.insert(frame(spark, rows)))[0]
    assert cleaned(both, frame(spark, rows)) == brute(rows, rows, 6)
    back = both.delete(frame(spark, rows[40:])).delete(frame(spark, [(999, "unknown"), (None, "x"), (41, "gone already")]))
    assert state(back) == state(one)
    assert cleaned(back, frame(spark, rows)) == brute(rows, first, 6)
    few = back.delete(frame(spark, first[3:]))
    assert cleaned(few, frame(spark, rows)) == brute(rows, first[:3], 6) and not any(state(few)[1])
    again = few.insert(frame(spark, first[3:]))
    assert state(again) == state(one)
    # The stores of before are still readable.
    assert cleaned(both, frame(spark, rows)) == brute(rows, rows, 6)


def test_what_a_filter_claims_wrongly_is_kept(spark):
    docs = frame(spark, ODD)
    store = LineStore(spark, min_docs=2, shards=3).insert(docs)
    claims_all = LineStore(spark, min_docs=1, shards=3).insert(docs).filters
    assert cleaned(replace(store, filters=claims_all), docs) == brute(ODD, ODD, 2)
    assert cleaned(replace(store, filters=claims_all, broadcast_bytes=40), docs) == brute(ODD, ODD, 2)


def test_cuckoo_filter():
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(-(1 << 63), 1 << 63, 50_000, dtype=np.int64))
    others = rng.integers(-(1 << 63), 1 << 63, 50_000, dtype=np.int64)
    filter_ = Cuckoo.with_room(len(keys))
    assert filter_.insert(keys) and filter_.claims(keys).all()
    assert filter_.claims(others).sum() <= 1
    filter_.delete(keys[:1000])
    assert filter_.claims(keys[1000:]).all() and filter_.claims(keys[:1000]).sum() <= 1
    assert np.count_nonzero(filter_.slots) == len(keys) - 1000
    assert not Cuckoo(np.zeros(8, dtype=np.uint32)).insert(keys[:9])
    full = Cuckoo(np.zeros(4 << 8, dtype=np.uint32))
    assert full.insert(keys[:950]) and full.claims(keys[:950]).all()


def test_query_against_sql(spark, sf_dir):
    out = queries.op11_line_dedup(spark, sf_dir)
    assert differences(out, duck(sf_dir).sql(queries.ORACLE["op11_line_dedup"])) == []
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    expected = {i: (n, d, hashlib.sha256(t.encode()).hexdigest()) for i, t, n, d in brute(rows, rows, 10)}
    assert {r["doc_id"]: tuple(r)[1:] for r in out.collect()} == expected
