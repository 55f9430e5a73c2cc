"""Packing token sequences: dominance reduction after Martello and Toth, then best fit.

Texts become pieces of at most ``capacity`` ids. How well pieces pack depends only on how many
there are of each length, a table of at most ``capacity`` rows whatever the corpus. That instance
is first reduced: a set of at most three lengths that provably does at least as well as every
other set with its longest piece is fixed for as many copies as there are, which makes the
instance smaller and may make further sets dominant. The rest is packed by best fit, longest first,
a length and a class of equally full sequences at a time.

The outcome is a list of segments: the pieces number i to j of one length lie in sequences s to
s + j - i at one offset. Its size depends on ``capacity``, not on the corpus, so it is broadcast;
pieces are numbered within their length by ranks within hash buckets plus the counts of earlier
buckets, so that no length is gathered into one task.

Defined results: a null or empty text is one piece with the closing id alone. Repeated rows and
rows with a null doc_id are packed like others. An empty table gives an empty result. Only
``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.frames import cut, release, small_batches
from ledgerline.llm.subwords import encoded, encoder

CAPACITY = 2048
CLOSING_ID = 0

# ---- pieces ---------------------------------------------------------------------------


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: whole sequences at the end, the rest in front."""
    rest = n % capacity
    starts = ([0] if rest else []) + list(range(rest, n, capacity))
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], n], strict=True)]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every text; ids are little-endian bytes."""
    small_batches(docs.sparkSession)
    schema = "doc_id long, piece int, start long, length int, ids_crc32 long" + ", ids binary" * with_ids

    def cut_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        closing = CLOSING_ID.to_bytes(4, "little")
        for batch in batches:
            out = []
            names = [None if pd.isna(x) else int(x) for x in batch["doc_id"]]
            for name, ids in zip(names, encoded(batch["text"].tolist(), tokenizer), strict=True):
                data = ids.astype("<u4").tobytes() + closing
                for k, (start, length) in enumerate(cuts(len(ids) + 1, capacity)):
                    part = data[4 * start : 4 * (start + length)]
                    out.append((name, k, start, length, zlib.crc32(part), *[part] * with_ids))
            frame = pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])
            yield frame.astype({"doc_id": "Int64"})
        # Workers live on through later stages; what they remember need not.
        encoder(tokenizer).forget()
        release()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(cut_up, schema)


# ---- the instance ---------------------------------------------------------------------


class Instance:
    """How many pieces of each length are left, and the segments placed so far."""

    def __init__(self, counts: dict[int, int], capacity: int) -> None:
        self.capacity = capacity
        self.left = {w: n for w, n in counts.items() if n > 0}
        self.lengths = sorted(self.left)
        self.taken = dict.fromkeys(self.lengths, 0)
        self.sequences = 0
        self.segments: list[tuple[int, int, int, int, int]] = []  # length, first piece, end, sequence, offset

    def place(self, length: int, n: int, sequence: int, offset: int) -> None:
        at = self.taken[length]
        self.segments.append((length, at, at + n, sequence, offset))
        self.taken[length] = at + n
        self.left[length] -= n
        if not self.left[length]:
            del self.left[length]
            self.lengths.remove(length)

    def fix(self, lengths: tuple[int, ...]) -> None:
        """Close as many sequences with exactly these lengths as there are pieces for."""
        n = min(self.left[w] // lengths.count(w) for w in lengths)
        offset = 0
        for w in lengths:
            self.place(w, n, self.sequences, offset)
            offset += w
        self.sequences += n

    def largest(self, room: int, *used: int) -> int | None:
        """The greatest length within ``room`` of which a piece is left besides those used."""
        for k in range(bisect_right(self.lengths, room) - 1, -1, -1):
            w = self.lengths[k]
            if self.left[w] > used.count(w):
                return w
        return None

    def smallest(self, n: int, *used: int) -> list[int]:
        """The n least lengths of pieces besides those used."""
        out: list[int] = []
        for w in self.lengths:
            out += [w] * min(self.left[w] - used.count(w), n - len(out))
            if len(out) == n:
                break
        return out

    def dominant(self, longest: int) -> tuple[int, ...] | None:
        """A set with a piece of length ``longest`` that dominates every other feasible set with it.

        A set dominates another if the other's further pieces can be dealt into groups that each
        fit in place of one of its own further pieces.
        """
        room = self.capacity - longest
        best = self.largest(room, longest)
        if best is None:
            return (longest,)
        if best == room:
            return (longest, best)  # whatever else fits beside it fits in place of this one piece
        few = self.smallest(3, longest)
        if len(few) < 2 or few[0] + few[1] > room:
            return (longest, best)  # one more piece at most
        if len(few) == 3 and sum(few) <= room:
            return None  # sets of four or more pieces compete
        pairs = [(a, b) for a in self.lengths if (b := self.largest(min(room - a, a), longest, a))]
        pairs = [(a, b) for a, b in pairs if self.left[a] > (a == longest)]
        if max(a + b for a, b in pairs) <= best:
            return (longest, best)  # two pieces fit in place of this one
        second = self.largest(room - best, longest, best)
        if second and max(b for _, b in pairs) <= second:
            return (longest, best, second)  # piece by piece at least as long as any other pair
        return None

    def reduce(self) -> None:
        """Fix dominant sets until no length leads one."""
        changed = True
        while changed:
            changed = False
            for w in reversed(list(self.lengths)):
                while w in self.left and (found := self.dominant(w)):
                    self.fix(found)
                    changed = True

    def best_fit(self) -> None:
        """Pack what is left, longest first, each piece where the least room remains."""
        rooms: dict[int, list[tuple[int, int]]] = {}  # room left: (first sequence, number of sequences)
        order: list[int] = []

        def add(room: int, sequence: int, n: int) -> None:
            if room and n:
                if room not in rooms:
                    rooms[room] = []
                    order.insert(bisect_left(order, room), room)
                rooms[room].append((sequence, n))

        for w in reversed(list(self.lengths)):
            n = self.left[w]
            while n:
                k = bisect_left(order, w)
                if k < len(order):
                    room = order[k]
                    sequence, some = rooms[room].pop()
                    if not rooms[room]:
                        del rooms[room], order[k]
                else:
                    room, sequence = self.capacity, self.sequences
                    some = -(-n // (room // w))
                    self.sequences += some
                each = room // w
                full = min(some, n // each)
                for p in range(each if full else 0):
                    self.place(w, full, sequence, self.capacity - room + p * w)
                add(room - each * w, sequence, full)
                n -= full * each
                if full < some:
                    for p in range(n):
                        self.place(w, 1, sequence + full, self.capacity - room + p * w)
                    add(room - n * w, sequence + full, 1)
                    add(room, sequence + full + 1, some - full - 1)
                    n = 0


def solve(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """(segments, number of sequences) for so many pieces of each length up to ``capacity``."""
    instance = Instance(counts, capacity)
    instance.reduce()
    instance.best_fit()
    return instance.segments, instance.sequences


# ---- tables ---------------------------------------------------------------------------


def place(cut_up: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut_up`` with sequence_id and offset; its rows are read more than once."""
    spark = cut_up.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut_up.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    counted = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    segments, _ = solve(counts, capacity)

    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = counted.select("length", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    own = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = dealt.withColumn("rank", F.row_number().over(own) - 1).join(before, ["length", "bucket"])
    ranked = ranked.withColumn("number", F.col("rank") + F.col("before"))

    schema = "of_length int, first long, end long, sequence long, at long"
    there = F.broadcast(spark.createDataFrame(segments, schema))
    inside = (F.col("length") == F.col("of_length")) & (F.col("number") >= F.col("first")) & (F.col("number") < F.col("end"))
    placed = ranked.join(there, inside)
    return placed.select(
        *cut_up.columns,
        (F.col("sequence") + F.col("number") - F.col("first")).alias("sequence_id"),
        F.col("at").alias("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """A row for each piece of every text of ``docs`` with its place in a sequence."""
    placed = place(cut(pieces(docs, tokenizer, capacity)), capacity)
    return placed.withColumn("length", F.col("length").cast("long"))
