"""Reversible line dedup: sharded cuckoo filters over exact tables of how many documents hold a line.

A ``LineStore`` holds three kinds of written tables:

* the ledger, (doc_id, keys): the distinct line keys of every inserted document, 16 bytes each;
* the counts, (hi, lo, n, before): for each key the documents of the ledger that hold it, and how
  many did before the last change;
* the filters, one row for each shard of the keys: a cuckoo filter of the keys that ``min_docs``
  documents or more hold.

Inserting documents adds to the ledger and the counts; keys whose count reaches ``min_docs`` enter
their shard's filter. Deleting documents takes their keys from the ledger, lowers the counts, and
keys that fall below ``min_docs`` leave the filter: a cuckoo filter, unlike a Bloom filter, can
forget. A filter that runs full is built anew from the counts at twice the room. So a store that
had documents inserted and deleted equals one that never saw them, and texts cleaned by it get
their lines back.

Cleaning asks the filters first. What they claim wrongly (a 32-bit fingerprint in eight slots:
about 2 keys in a billion) is found by joining the claimed keys with the counts, so the result is exact.
Filters up to ``broadcast_bytes`` in all go to every task and texts are never moved. Beyond that,
the texts' keys are stored and asked in waves of shards, each wave within the bound, and only
claimed keys are joined.

Defined results: a line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z as a-z; a
key shorter than ``min_chars`` code points is never counted nor dropped. Null text is the empty
text, which is one empty line. Rows with one doc_id are one document, which holds the lines of all
of them; a document counts once for a key however often it holds it. Rows without a doc_id are
cleaned but not counted. Inserting a doc_id that is in the ledger changes nothing (delete it
first), nor does deleting one that is not. Rows that occur twice are cleaned twice. An empty table
gives an empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.frames import small_batches, stored, text_udf
from ledgerline.llm.words import SPACE_BYTES, mix

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
SLOTS = 4
#: Turns of moving fingerprints about before a filter counts as full.
TURNS = 400
#: Share of slots a new filter fills at most.
LOAD = 0.8
KEY = "hi long, lo long"


def line_keys(data: bytes, min_chars: int) -> list[bytes]:
    """The 16-byte key of each line; empty where the line is too short to have one."""
    out = []
    for line in data.translate(LOWER).split(b"\n"):
        key = line.strip(SPACE_BYTES)
        whole = len(key) >= min_chars and (min_chars <= 1 or len(key.decode()) >= min_chars)
        out.append(xxhash.xxh3_128_digest(key) if key and whole else b"")
    return out


def halves(joined: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hi, lo) of keys laid end to end."""
    both = np.frombuffer(joined, dtype=np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def shard_of(hi: np.ndarray, shards: int) -> np.ndarray:
    return (hi % shards).astype(np.int32)


def _shard(shards: int) -> Column:
    return F.pmod("hi", F.lit(shards)).cast("int")


class Cuckoo:
    """A multiset of 32-bit fingerprints in buckets of ``SLOTS``; each has two buckets it may lie in."""

    def __init__(self, slots: np.ndarray) -> None:
        self.slots = slots.reshape(-1, SLOTS)
        self.mask = np.uint64(len(self.slots) - 1)

    @classmethod
    def with_room(cls, keys: int) -> Cuckoo:
        need = max(int(keys / (LOAD * SLOTS)), 1)
        return cls(np.zeros(SLOTS << need.bit_length(), dtype=np.uint32))

    def _hop(self, prints: np.ndarray) -> np.ndarray:
        return (mix(prints.astype(np.uint64)) & self.mask).astype(np.int64)

    def _place(self, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprints and first buckets of keys, from the two halves of ``lo``."""
        bits = lo.astype(np.uint64)
        return np.maximum(bits.astype(np.uint32), 1), ((bits >> np.uint64(32)) & self.mask).astype(np.int64)

    def claims(self, lo: np.ndarray) -> np.ndarray:
        prints, at = self._place(lo)
        own = prints[:, None]
        return (self.slots[at] == own).any(axis=1) | (self.slots[at ^ self._hop(prints)] == own).any(axis=1)

    def insert(self, lo: np.ndarray) -> bool:
        """Add keys, all at once turn by turn; False if there is no room, and the filter is spoilt."""
        prints, at = self._place(lo)
        for turn in range(TURNS):
            if not len(prints):
                return True
            order = np.argsort(at, kind="stable")
            prints, at = prints[order], at[order]
            leads = np.append(True, at[1:] != at[:-1])
            first = np.flatnonzero(leads)
            rank = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
            free = self.slots[at] == 0
            slot = free & (np.cumsum(free, axis=1) == (rank + 1)[:, None])
            fits = slot.any(axis=1)
            self.slots[at[fits], slot[fits].argmax(axis=1)] = prints[fits]
            # Once both buckets were tried, the first that waits at a full one takes another's slot there.
            takes = leads & ~fits if turn else np.zeros(len(at), dtype=bool)
            victim = (mix(at[takes].astype(np.uint64) + np.uint64(turn << 32)) % np.uint64(SLOTS)).astype(np.int64)
            out = self.slots[at[takes], victim].copy()
            self.slots[at[takes], victim] = prints[takes]
            prints[takes] = out
            prints, at = prints[~fits], at[~fits]
            at = at ^ self._hop(prints)
        return not len(prints)

    def delete(self, lo: np.ndarray) -> None:
        """Take out keys that were inserted."""
        prints, at = self._place(lo)
        others = at ^ self._hop(prints)
        for p, one, two in zip(prints.tolist(), at.tolist(), others.tolist(), strict=True):
            for bucket in (one, two):
                found = np.flatnonzero(self.slots[bucket] == p)
                if len(found):
                    self.slots[bucket, found[0]] = 0
                    break


class Filters:
    """Some shards' filters, as a task asks them."""

    def __init__(self, rows: dict[int, bytes], shards: int) -> None:
        self.shards = shards
        self.of = {shard: Cuckoo(np.frombuffer(data, dtype=np.uint32)) for shard, data in rows.items()}

    def claims(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hi), dtype=bool)
        shard = shard_of(hi, self.shards)
        for one in np.unique(shard).tolist():
            if one in self.of:
                own = shard == one
                out[own] = self.of[one].claims(lo[own])
        return out


def _filter_row(shard: int, cuckoo: Cuckoo, full: bool) -> pd.DataFrame:
    return pd.DataFrame({"shard": [shard], "filter": [cuckoo.slots.tobytes()], "spoilt": [full]})


FILTER = "shard int, filter binary, spoilt boolean"


def _built(part: pd.DataFrame) -> pd.DataFrame:
    """A new filter over all frequent keys of a shard."""
    lo, room = part["lo"].to_numpy(), len(part)
    cuckoo = Cuckoo.with_room(room)
    while not cuckoo.insert(lo):
        room *= 2
        cuckoo = Cuckoo.with_room(room)
    return _filter_row(int(part["shard"].iloc[0]), cuckoo, False)


def _changed(old: pd.DataFrame, changes: pd.DataFrame) -> pd.DataFrame:
    """A shard's filter after keys left and entered."""
    shard = int((old if len(old) else changes)["shard"].iloc[0])
    fits = len(old) > 0
    cuckoo = Cuckoo(np.frombuffer(old["filter"].iloc[0], dtype=np.uint32).copy()) if fits else Cuckoo.with_room(0)
    if fits and len(changes):
        cuckoo.delete(changes.loc[~changes["enters"], "lo"].to_numpy())
        fits = cuckoo.insert(changes.loc[changes["enters"], "lo"].to_numpy())
    return _filter_row(shard, cuckoo, not fits)


def _ledger_rows(min_chars: int):
    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t.encode() if t else b"" for t in batch["text"]]
            keys = [b"".join(dict.fromkeys(line_keys(t, min_chars))) for t in texts]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "keys": keys})

    return over


def _entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(doc_id, hi, lo) for each key of ledger rows."""
    for batch in batches:
        hi, lo = halves(b"".join(batch["keys"]))
        ids = np.repeat(batch["doc_id"].to_numpy(), batch["keys"].str.len().to_numpy(dtype=np.int64) // 16)
        yield pd.DataFrame({"doc_id": ids, "hi": hi, "lo": lo})


def _without(lines: list[bytes], keys: list[bytes], frequent) -> tuple[int, int, str]:
    kept = [line for line, key in zip(lines, keys, strict=True) if not (key and key in frequent)]
    return len(lines), len(lines) - len(kept), b"\n".join(kept).decode()


CLEANED = "n_lines long, n_dropped long, text string"


def _rows(df: DataFrame) -> DataFrame:
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


@dataclass(frozen=True)
class LineStore:
    """What is known of the lines of the inserted documents; every change gives a new store and leaves the old one readable."""

    spark: SparkSession
    min_docs: int = 10
    min_chars: int = 1
    shards: int = 64
    broadcast_bytes: int = 64 << 20
    ledger: DataFrame | None = None
    counts: DataFrame | None = None
    filters: DataFrame | None = None

    def insert(self, docs: DataFrame) -> LineStore:
        """The store with the documents whose doc_id it doesn't know yet."""
        small_batches(self.spark)
        texts = _rows(docs).where("doc_id is not null")
        if self.ledger is not None:
            texts = texts.join(self.ledger.select("doc_id").distinct(), "doc_id", "left_anti")
        new = stored(texts.mapInPandas(_ledger_rows(self.min_chars), "doc_id long, keys binary"), "line-ledger")
        repeated = new.groupBy("doc_id").count().where("count > 1").select("doc_id")
        if not repeated.isEmpty():
            # The rows of one document share no key: its keys are told apart, one row each.
            several = new.join(repeated, "doc_id", "left_semi").mapInPandas(_entries, f"doc_id long, {KEY}").distinct()
            packed = several.select("doc_id", _packed("hi", "lo").alias("keys"))
            new = stored(new.join(repeated, "doc_id", "left_anti").unionByName(packed), "line-ledger")
        ledger = new if self.ledger is None else self.ledger.unionByName(new)
        return self._after(new, 1, ledger)

    def delete(self, ids: DataFrame) -> LineStore:
        """The store without the documents whose doc_id is in ``ids``."""
        if self.ledger is None:
            return self
        small_batches(self.spark)
        gone = ids.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
        ledger = stored(self.ledger.join(gone, "doc_id", "left_anti"), "line-ledger")
        return self._after(self.ledger.join(gone, "doc_id", "left_semi"), -1, ledger)

    def _after(self, rows: DataFrame, sign: int, ledger: DataFrame) -> LineStore:
        change = rows.mapInPandas(_entries, f"doc_id long, {KEY}").select("hi", "lo", F.lit(0).cast("long").alias("before"), F.lit(sign).cast("long").alias("more"))
        if self.counts is not None:
            known = self.counts.where("n > 0").select("hi", "lo", F.col("n").alias("before"), F.lit(0).cast("long").alias("more"))
            change = known.unionByName(change)
        summed = change.groupBy("hi", "lo").agg(F.sum("before").alias("before"), F.sum("more").alias("more"))
        counts = stored(summed.select("hi", "lo", (F.col("before") + F.col("more")).alias("n"), "before"), "line-counts")
        return replace(self, ledger=ledger, counts=counts, filters=self._filters(counts))

    def _frequent(self, counts: DataFrame) -> DataFrame:
        return counts.where(F.col("n") >= self.min_docs).select("hi", "lo")

    def _filters(self, counts: DataFrame) -> DataFrame:
        shard = _shard(self.shards).alias("shard")
        frequent = self._frequent(counts).select(shard, "lo")
        if self.filters is None:
            return stored(frequent.groupBy("shard").applyInPandas(_built, FILTER), "line-filters")
        was, now = F.col("before") >= self.min_docs, F.col("n") >= self.min_docs
        changes = counts.where(was != now).select(shard, "lo", now.alias("enters"))
        moved = self.filters.groupBy("shard").cogroup(changes.groupBy("shard")).applyInPandas(_changed, FILTER)
        moved = stored(moved, "line-filters")
        again = frequent.join(moved.where("spoilt").select("shard"), "shard", "left_semi")
        return stored(moved.where("not spoilt").unionByName(again.groupBy("shard").applyInPandas(_built, FILTER)), "line-filters")

    # ---- cleaning

    def clean(self, docs: DataFrame) -> DataFrame:
        """(doc_id, text, n_lines, n_dropped): every row of ``docs`` without its frequent lines; n_lines counts before dropping."""
        small_batches(self.spark)
        rows = _rows(docs)
        sizes = [] if self.filters is None else self.filters.select("shard", F.length("filter").alias("bytes")).collect()
        if sum(r["bytes"] for r in sizes) <= self.broadcast_bytes:
            held = {} if self.filters is None else {r["shard"]: bytes(r["filter"]) for r in self.filters.select("shard", "filter").collect()}
            return self._clean_in_place(rows, held)
        return self._clean_by_waves(rows, {r["shard"]: r["bytes"] for r in sizes})

    def _wrong(self, claimed: DataFrame) -> DataFrame:
        """The claimed keys that too few documents hold."""
        return claimed.select("hi", "lo").distinct().join(self._frequent(self.counts), ["hi", "lo"], "left_anti")

    def _clean_in_place(self, rows: DataFrame, held: dict[int, bytes]) -> DataFrame:
        shared = self.spark.sparkContext.broadcast(held)
        shards, min_chars = self.shards, self.min_chars

        def claimed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            filters = Filters(shared.value, shards)
            for batch in batches:
                keys = b"".join({k for t in batch["text"] if t for k in line_keys(t.encode(), min_chars)})
                hi, lo = halves(keys)
                own = filters.claims(hi, lo)
                yield pd.DataFrame({"hi": hi[own], "lo": lo[own]})

        wrong: set[bytes] = set()
        if held:
            # As many rows as the filters claim wrongly, about two in a billion distinct lines.
            found = self._wrong(rows.select("text").mapInPandas(claimed, KEY)).select(_packed("hi", "lo").alias("key"))
            wrong = {bytes(r["key"]) for r in found.toLocalIterator()}

        def cleaned(texts: pd.Series) -> pd.DataFrame:
            filters = Filters(shared.value, shards)
            lines = [t.encode() if t else b"" for t in texts]
            keys = [line_keys(t, min_chars) for t in lines]
            named = [k for k in dict.fromkeys(k for own in keys for k in own) if k]
            claims = filters.claims(*halves(b"".join(named)))
            frequent = {k for k, c in zip(named, claims, strict=True) if c and k not in wrong}
            out = [_without(t.split(b"\n"), own, frequent) for t, own in zip(lines, keys, strict=True)]
            return pd.DataFrame(out, columns=["n_lines", "n_dropped", "text"])

        return _flat(rows.select("doc_id", text_udf(cleaned, CLEANED)("text").alias("c")))

    def _clean_by_waves(self, rows: DataFrame, sizes: dict[int, int]) -> DataFrame:
        numbered = stored(rows.withColumn("row", F.monotonically_increasing_id()), "line-rows")
        keyed = numbered.select(F.col("row").alias("doc_id"), "text").mapInPandas(_ledger_rows(self.min_chars), "doc_id long, keys binary")
        waves: list[list[int]] = [[]]
        for shard, size in sorted(sizes.items()):
            if waves[-1] and sum(sizes[s] for s in waves[-1]) + size > self.broadcast_bytes:
                waves.append([])
            waves[-1].append(shard)
        wave_of = F.create_map(*[F.lit(x) for k, wave in enumerate(waves) for s in wave for x in (s, k)])
        entries = keyed.mapInPandas(_entries, f"doc_id long, {KEY}").withColumn("wave", wave_of[_shard(self.shards)])
        entries = stored(entries.where("wave is not null"), "line-entries")
        parts = [entries.where(F.col("wave") == k).mapInPandas(self._asking(wave), f"doc_id long, {KEY}") for k, wave in enumerate(waves)]
        claimed = reduce(DataFrame.unionByName, parts)
        confirmed = claimed.join(self._frequent(self.counts), ["hi", "lo"], "left_semi")
        # As many keys as the row has lines.
        found = confirmed.groupBy(F.col("doc_id").alias("row")).agg(F.collect_list(_packed("hi", "lo")).alias("keys"))
        joined = numbered.join(found, "row", "left")
        min_chars = self.min_chars

        def cleaned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                out = []
                for text, frequent in zip(batch["text"], batch["keys"], strict=True):
                    data = text.encode() if text else b""
                    known = set() if frequent is None else {bytes(k) for k in frequent}
                    out.append(_without(data.split(b"\n"), line_keys(data, min_chars), known))
                done = pd.DataFrame(out, columns=["n_lines", "n_dropped", "text"])
                done.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy(dtype=object, na_value=None))
                yield done

        return joined.select("doc_id", "text", "keys").mapInPandas(cleaned, f"doc_id long, {CLEANED}").select("doc_id", "text", "n_lines", "n_dropped")

    def _asking(self, wave: list[int]) -> Callable:
        rows = self.filters.where(F.col("shard").isin(wave)).collect()
        shared = self.spark.sparkContext.broadcast({r["shard"]: bytes(r["filter"]) for r in rows})
        shards = self.shards

        def asked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            filters = Filters(shared.value, shards)
            for batch in batches:
                yield batch.loc[filters.claims(batch["hi"].to_numpy(), batch["lo"].to_numpy()), ["doc_id", "hi", "lo"]]

        return asked


def _packed(hi: str, lo: str) -> Column:
    """The 16 bytes of a key, as ``halves`` reads them."""

    def little(name: str) -> Column:
        return F.unhex(F.concat(*[F.substr(F.lpad(F.hex(name), 16, "0"), F.lit(15 - 2 * k), F.lit(2)) for k in range(8)]))

    return F.concat(little(hi), little(lo))


def _flat(df: DataFrame) -> DataFrame:
    return df.select("doc_id", F.col("c.text").alias("text"), F.col("c.n_lines").alias("n_lines"), F.col("c.n_dropped").alias("n_dropped"))
