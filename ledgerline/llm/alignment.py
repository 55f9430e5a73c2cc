"""Alignment of two tokenizers' tokens over the bytes of the same texts.

Both sides read the space followed by the text: side A a byte-level BPE file, side B a
SentencePiece model, which puts the space there itself. With the byte range of every token, pandas
``merge_asof``, keyed by document, finds for each token's start the token of the other side that covers it; the
union of both directions are the overlapping pairs. Pairs whose ranges end together are links, and
cut the two sequences into groups.

``align_documents`` gives these as lists. ``digest_documents`` counts how often each pair of ids is
linked in the whole corpus and gives sizes, a checksum and, for each text, what its links' counts
come to. Texts are encoded and aligned once: their distinct linked pairs are stored, counted by a grouping, and
the counts go to every task, the most frequent first, up to ``broadcast_pairs``. Pairs beyond these
(none of them frequent, so no hot key is among them) are joined.

A long text is cut at single spaces between visible ASCII characters, where both sides begin a token whatever
surrounds it; so memory is bounded by the parts, not by the texts.

Defined results: null and empty texts, and those whose tokens' joined bytes on either side are not the space and
the text (a mark U+2581 in it reads as a space), have no tokens: sizes 0, empty lists and an empty
checksum. Special strings in a text are plain text. Repeated rows and null doc_ids keep their rows
and count as often as they occur. An empty table gives an empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.frames import small_batches, stored
from ledgerline.llm.subwords import REMEMBERED, Encoder, unit_starts

MARK = "▁"
#: Bytes of text that are aligned at once, and after which a long text is cut.
PART_BYTES = 1 << 19
#: Pairs whose counts go to every task, of 17 bytes each.
BROADCAST_PAIRS = 3_000_000
_CUT = re.compile(rb"[!-~] (?=[!-~])")
_SPACE = ord(" ")


# ---- the two sides


class Side(Encoder):
    """Ids of units, remembered; ``exact`` tells whether a unit's tokens spell it."""

    def forget(self) -> None:
        super().forget()
        self.exact = np.zeros(1 << 16, dtype=bool)

    def spell(self, spelled: list[bytes]) -> None:
        """Set what the ids stand for."""
        self.spelled = spelled
        self.widths = np.array([len(s) for s in spelled], dtype=np.int64)

    def _add(self, units: list[str]) -> np.ndarray:
        numbers = super()._add(units)
        while self.units > len(self.exact):
            self.exact = np.concatenate([self.exact, np.zeros_like(self.exact)])
        for number, unit in zip(numbers.tolist(), units, strict=True):
            at = int(self.at[number])
            own = self.ids[at : at + int(self.length[number])].tolist()
            self.exact[number] = b"".join([self.spelled[i] for i in own]) == unit.encode()
        return numbers

    def starts(self, data: np.ndarray, begins: np.ndarray) -> np.ndarray:
        return unit_starts(data, begins)

    def read(self, data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, where each part's ids begin and the last end, whether each part is spelled) of parts that end with a zero byte."""
        if self.units > REMEMBERED:
            self.forget()
        starts = self.starts(data, begins)
        numbers = self.numbers(data, starts)
        lengths = self.length[numbers].astype(np.int64)
        breaks = np.searchsorted(starts, begins[1:] - 1)
        lengths[breaks] = 0
        ends = np.cumsum(lengths)
        source = np.repeat(self.at[numbers] - (ends - lengths), lengths) + np.arange(int(ends[-1]))
        first = np.append((ends - lengths)[np.searchsorted(starts, begins[:-1])], ends[-1])
        wrong = ~self.exact[numbers]
        wrong[breaks] = False
        return self.ids[source].astype(np.int64), first, np.add.reduceat(wrong, np.searchsorted(starts, begins[:-1])) == 0


def byte_characters() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable Latin-1 for itself, the others from U+0100 on in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class ByteSide(Side):
    """A byte-level BPE file of the ``tokenizers`` library."""

    def __init__(self, path: str) -> None:
        super().__init__(path)
        self.tokenizer.encode_special_tokens = True
        self.special = []
        to_byte = byte_characters()
        size = self.tokenizer.get_vocab_size()
        entries = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        self.spell([bytes(to_byte[c] for c in e) if all(c in to_byte for c in e) else e.encode() for e in entries])


class PieceSide(Side):
    """A SentencePiece model; a unit is a run of spaces with what follows up to the next space."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.special = []
        self.model = SentencePieceProcessor(model_file=path)
        self.tokenizer = self  # asked for the ids of units
        self.forget()
        spelled = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            nothing = self.model.is_control(i) or self.model.is_unknown(i)
            spelled.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else b"" if nothing else piece.replace(MARK, " ").encode())
        self.spell(spelled)

    def encode_batch_fast(self, units: list[str], add_special_tokens: bool) -> list[_Ids]:
        # The library adds the space that each unit begins with, but not to nothing; the break between parts has none.
        alone = [self.model.piece_to_id(MARK)]
        found = self.model.encode([u[1:] for u in units], num_threads=1)
        return [_Ids(alone if u == " " else ids) for u, ids in zip(units, found, strict=True)]

    def starts(self, data: np.ndarray, begins: np.ndarray) -> np.ndarray:
        start = data == _SPACE
        start[1:] &= data[:-1] != _SPACE
        start[begins[:-1]] = True
        start[begins[1:] - 1] = True
        return np.flatnonzero(start)


@dataclass
class _Ids:
    ids: list[int]


@cache
def sides(a: str, b: str) -> tuple[ByteSide, PieceSide]:
    """One pair of encoders for each worker process."""
    return ByteSide(a), PieceSide(b)


# ---- aligning


def covering(left: pd.DataFrame, right: pd.DataFrame) -> np.ndarray:
    """For each row of ``left`` the token of ``right``, of the same document, that covers its start."""
    return pd.merge_asof(left, right, on="start", by="document")["token"].to_numpy()


@dataclass
class Aligned:
    """The tokens of some documents' parts; part k has A's tokens from ``a_first[k]`` to ``a_first[k + 1]``, B's likewise.

    ``over_a`` and ``over_b`` are the tokens of overlapping pairs, ``link_a`` and ``link_b`` of those
    that end together, one for each group, in order.
    """

    a: np.ndarray
    b: np.ndarray
    a_first: np.ndarray
    b_first: np.ndarray
    over_a: np.ndarray
    over_b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray


def align(parts: list[bytes], one: ByteSide, two: PieceSide) -> tuple[Aligned, np.ndarray]:
    """(the alignment of parts that begin with a space, whether each part is spelled by both sides); others have no tokens."""
    data = np.frombuffer(b"".join([p + b"\0" for p in parts]), dtype=np.uint8)
    begins = np.cumsum([0, *[len(p) + 1 for p in parts]])
    a, a_first, a_good = one.read(data, begins)
    b, b_first, b_good = two.read(data, begins)
    good = a_good & b_good
    if not good.all():
        a, a_first = _only(a, a_first, good)
        b, b_first = _only(b, b_first, good)
    a_end, b_end = np.cumsum(one.widths[a]), np.cumsum(two.widths[b])
    a_start, b_start = a_end - one.widths[a], b_end - two.widths[b]
    left = pd.DataFrame({"start": a_start, "document": np.repeat(np.arange(len(parts)), np.diff(a_first))})
    right = pd.DataFrame({"start": b_start, "document": np.repeat(np.arange(len(parts)), np.diff(b_first))})
    if not len(a):
        none = np.zeros(0, dtype=np.int64)
        return Aligned(a, b, a_first, b_first, none, none, none, none), good
    of_a = covering(left, right.assign(token=np.arange(len(b))))
    of_b = covering(right, left.assign(token=np.arange(len(a))))
    # A pair that starts together is found from both sides.
    again = a_start[of_b] == b_start
    over_a = np.concatenate([np.arange(len(a)), of_b[~again]])
    over_b = np.concatenate([of_a, np.flatnonzero(~again)])
    together = a_end[over_a] == b_end[over_b]
    link_a, link_b = np.sort(over_a[together]), np.sort(over_b[together])
    return Aligned(a, b, a_first, b_first, over_a, over_b, link_a, link_b), good


def _only(ids: np.ndarray, first: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.diff(first)
    return ids[np.repeat(good, sizes)], np.concatenate(([0], np.cumsum(sizes * good)))


def parts_of(text: str | None) -> Iterator[bytes]:
    """The space and the text in parts whose tokens don't depend on each other; nothing for no text."""
    if not text:
        return
    data = b" " + text.encode()
    at = 0
    while len(data) - at > PART_BYTES:
        cut = _CUT.search(data, at + PART_BYTES)
        if cut is None:
            break
        yield data[at : cut.start() + 1]
        at = cut.start() + 1
    yield data[at:]


def aligned_texts(texts: list[str | None], one: ByteSide, two: PieceSide) -> Iterator[tuple[list[int], Aligned, np.ndarray]]:
    """(text of each part, alignment, parts that are spelled) for runs of parts of about ``PART_BYTES``; parts in the texts' order."""
    owner, parts, size = [], [], 0
    for i, text in enumerate(texts):
        for part in parts_of(text):
            if parts and size + len(part) > PART_BYTES:
                yield owner, *align(parts, one, two)
                owner, parts, size = [], [], 0
            owner.append(i)
            parts.append(part)
            size += len(part)
    if parts:
        yield owner, *align(parts, one, two)


PAIR = "array<struct<a:int,b:int>>"
ALIGNED = f"doc_id long, a_ids array<int>, b_ids array<int>, overlaps {PAIR}, links {PAIR}"


def align_documents(docs: DataFrame, a: str, b: str) -> DataFrame:
    """A row of ``ALIGNED`` for each row of ``docs``: ids of both sides, overlapping pairs of token places, and those that end together.

    The k-th group ends with the tokens of the k-th link.
    """
    small_batches(docs.sparkSession)

    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        one, two = sides(a, b)
        for batch in batches:
            rows = [_Lists() for _ in range(len(batch))]
            for owner, found, good in aligned_texts(batch["text"].tolist(), one, two):
                over_order = np.lexsort((found.over_b, found.over_a))
                pairs = found.over_a[over_order], found.over_b[over_order]
                for k, i in enumerate(owner):
                    rows[i].add(found, pairs, k, bool(good[k]))
            done = [r if r.good else _Lists() for r in rows]
            out = {n: [getattr(r, n) for r in done] for n in ("a_ids", "b_ids", "overlaps", "links")}
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), **out})

    return _rows(docs).mapInPandas(over, ALIGNED)


@dataclass
class _Lists:
    a_ids: list = field(default_factory=list)
    b_ids: list = field(default_factory=list)
    overlaps: list = field(default_factory=list)
    links: list = field(default_factory=list)
    good: bool = True

    def add(self, found: Aligned, pairs: tuple[np.ndarray, np.ndarray], k: int, good: bool) -> None:
        self.good &= good
        i, j, p, q = found.a_first[k], found.a_first[k + 1], found.b_first[k], found.b_first[k + 1]
        for own, (left, right) in ((self.overlaps, pairs), (self.links, (found.link_a, found.link_b))):
            here = slice(*np.searchsorted(left, (i, j)))
            a_at, b_at = left[here] - i + len(self.a_ids), right[here] - p + len(self.b_ids)
            own += [{"a": x, "b": y} for x, y in zip(a_at.tolist(), b_at.tolist(), strict=True)]
        self.a_ids += found.a[i:j].tolist()
        self.b_ids += found.b[p:q].tolist()


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


# ---- digests


def decimals(size: int) -> np.ndarray:
    """The decimal digits of numbers below ``size`` as rows of bytes, zero bytes in front and room for one more behind."""
    width = len(str(max(size - 1, 0)))
    left = np.arange(size)
    out = np.zeros((size, width + 1), dtype=np.uint8)
    for k in range(width - 1, -1, -1):
        shown = (left > 0) | (k == width - 1)
        out[shown, k] = left[shown] % 10 + ord("0")
        left = left // 10
    return out


def written(found: Aligned, digits_a: np.ndarray, digits_b: np.ndarray) -> tuple[bytes, np.ndarray]:
    """(``a1,a2|b1;a3|b2,b3;`` over all parts, where each part's begins and the last ends)."""
    a, b, link_a, link_b = found.a, found.b, found.link_a, found.link_b
    own, other = np.arange(len(a)), np.arange(len(b))
    group_a, group_b = np.searchsorted(link_a, own), np.searchsorted(link_b, other)
    width = max(digits_a.shape[1], digits_b.shape[1])
    out = np.zeros((len(a) + len(b), width), dtype=np.uint8)
    # A's tokens of a group stand after B's of the groups before, B's after A's of the same group.
    place_a = own + np.concatenate(([0], link_b + 1))[group_a]
    place_b = other + (link_a + 1)[group_b]
    out[place_a, width - digits_a.shape[1] :] = digits_a[a]
    out[place_b, width - digits_b.shape[1] :] = digits_b[b]
    out[:, -1] = ord(",")
    out[place_a[link_a], -1] = ord("|")
    out[place_b[link_b], -1] = ord(";")
    shown = out != 0
    ends = np.concatenate(([0], np.cumsum(shown.sum(axis=1))))
    return out[shown].tobytes(), ends[found.a_first + found.b_first]


DIGESTED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"


@dataclass
class _Digest:
    sha = None
    good: bool = True
    n_a: int = 0
    n_b: int = 0
    n_links: int = 0
    pairs: list = field(default_factory=list)
    times: list = field(default_factory=list)

    def add(self, text: bytes, sizes: tuple[int, int, int], pairs: np.ndarray, times: np.ndarray) -> None:
        if self.sha is None:
            self.sha = hashlib.sha256()
        else:
            self.sha.update(b";")
        self.sha.update(memoryview(text)[:-1])
        self.n_a, self.n_b, self.n_links = (x + y for x, y in zip((self.n_a, self.n_b, self.n_links), sizes, strict=True))
        self.pairs.append(pairs)
        self.times.append(times)

    def row(self) -> tuple:
        if not self.good or self.sha is None:
            return 0, 0, 0, 0, "", b"", b""
        pairs, times = self.pairs[0], self.times[0]
        if len(self.pairs) > 1:
            pairs, at = np.unique(np.concatenate(self.pairs), return_inverse=True)
            times = np.bincount(at, weights=np.concatenate(self.times)).astype(np.int64)
        # Stored as differences, which are small and compress well.
        return self.n_a, self.n_b, self.n_links, self.n_links, self.sha.hexdigest(), np.diff(pairs, prepend=0).astype("<i8").tobytes(), times.astype("<u4").tobytes()


def _digests(a: str, b: str):
    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        one, two = sides(a, b)
        digits_a, digits_b = decimals(len(one.widths)), decimals(len(two.widths))
        kinds = len(one.widths) * len(two.widths)
        for batch in batches:
            rows = [_Digest() for _ in range(len(batch))]
            for owner, found, good in aligned_texts(batch["text"].tolist(), one, two):
                text, at = written(found, digits_a, digits_b)
                in_part = np.searchsorted(found.a_first, found.link_a, side="right") - 1
                keys, times = np.unique(in_part * kinds + found.a[found.link_a] * len(two.widths) + found.b[found.link_b], return_counts=True)
                first = np.searchsorted(keys, np.arange(len(owner) + 1) * kinds)
                links = np.searchsorted(found.link_a, found.a_first)
                for k, i in enumerate(owner):
                    if not good[k]:
                        rows[i].good = False
                        continue
                    own = slice(first[k], first[k + 1])
                    sizes = int(found.a_first[k + 1] - found.a_first[k]), int(found.b_first[k + 1] - found.b_first[k]), int(links[k + 1] - links[k])
                    rows[i].add(text[at[k] : at[k + 1]], sizes, keys[own] - k * kinds, times[own])
            names = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
            out = pd.DataFrame([r.row() for r in rows], columns=names)
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64"))
            yield out

    return over


def _read_pairs(pairs: pd.Series, times: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pairs, times, rows) of some rows' stored pairs."""
    each = [np.cumsum(np.frombuffer(p, dtype="<i8")) for p in pairs]
    sizes = [len(p) for p in each]
    flat = np.concatenate(each) if each else np.zeros(0, dtype=np.int64)
    return flat, np.frombuffer(b"".join(times), dtype="<u4").astype(np.int64), np.repeat(np.arange(len(sizes)), sizes)


def _pair_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        pairs, times, _ = _read_pairs(batch["pairs"], batch["times"])
        own, at = np.unique(pairs, return_inverse=True)
        yield pd.DataFrame({"pair": own, "n": np.bincount(at, weights=times, minlength=len(own)).astype(np.int64)})


def pair_counts(digested: DataFrame, b_size: int) -> DataFrame:
    """(pair, n, best): how often each pair of ids is linked, and whether no pair with the same B id is more often."""
    found = digested.select("pairs", "times").where(F.length("pairs") > 0).mapInPandas(_pair_counts, "pair long, n long")
    counted = found.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("b", F.col("pair") % b_size)
    counted = stored(counted, "alignment-counts")
    most = counted.groupBy("b").agg(F.max("n").alias("most"))
    return counted.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def digest_documents(docs: DataFrame, a: str, b: str, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for each row of ``docs``."""
    spark = docs.sparkSession
    small_batches(spark)
    digested = stored(_rows(docs).mapInPandas(_digests(a, b), DIGESTED).withColumn("row", F.monotonically_increasing_id()), "alignment")
    b_size = len(sides(a, b)[1].widths)
    counts = stored(pair_counts(digested, b_size), "alignment-pairs")
    frequent = counts
    total = counts.count()
    if total > broadcast_pairs:
        frequent = stored(counts.orderBy(F.desc("n"), "pair").limit(broadcast_pairs), "alignment-frequent")
    known = frequent.orderBy("pair").toPandas()
    shared = spark.sparkContext.broadcast((known["pair"].to_numpy(), known["n"].to_numpy(), known["best"].to_numpy()))

    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n, best = shared.value
        for batch in batches:
            pairs, times, row = _read_pairs(batch["pairs"], batch["times"])
            at = np.minimum(np.searchsorted(held, pairs), max(len(held) - 1, 0))
            hit = held[at] == pairs if len(held) else np.zeros(len(pairs), dtype=bool)
            often, place = times[hit], at[hit]
            edges = np.searchsorted(row[hit], np.arange(len(batch) + 1))
            out = batch.drop(columns=["pairs", "times"])
            for name, each in (("count_sum", often * n[place]), ("n_best", often * best[place])):
                out[name] = np.diff(np.concatenate(([0], np.cumsum(each)))[edges])
            left = np.split(np.flatnonzero(~hit), np.searchsorted(row[~hit], np.arange(1, len(batch))))
            out["left"] = [[{"pair": p, "times": t} for p, t in zip(pairs[i].tolist(), times[i].tolist(), strict=True)] for i in left]
            yield out

    sizes = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
    rows = digested.select(*[c.split()[0] for c in sizes.split(", ")], "pairs", "times")
    rows = rows.mapInPandas(over, f"{sizes}, count_sum long, n_best long, left array<struct<pair:long,times:long>>")
    result = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    if total <= broadcast_pairs:
        return rows.select(*result)
    rows = stored(rows, "alignment-rows")
    rare = counts.join(frequent.select("pair"), "pair", "left_anti")
    rest = rows.select("row", F.explode("left").alias("p")).select("row", "p.pair", "p.times").join(rare, "pair")
    more = rest.groupBy("row").agg(
        F.sum(F.col("times") * F.col("n")).alias("more"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("better")
    )
    joined = rows.join(more, "row", "left")
    joined = joined.withColumn("count_sum", F.col("count_sum") + F.coalesce("more", F.lit(0)))
    return joined.withColumn("n_best", F.col("n_best") + F.coalesce("better", F.lit(0))).select(*result)
