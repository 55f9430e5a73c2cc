"""Near-duplicate documents: minima of universal hashes, banding, verification, components.

1. A text becomes the set of its runs of ``SHINGLE`` words, as 64-bit hashes. Texts with the same
   set are one class, found by grouping on a digest of the set; one member stands for the class.
2. Each class gets ``bands * rows`` minima, each under another multiply-shift hash. Classes that
   agree on all minima of a band meet in a bucket; the buckets' links join classes to groups.
3. Within a group, pairs of classes are compared block against block: pairs whose minima agree too
   rarely are passed over, the others are compared on their full sets. Only links that connect
   something new within the block leave the task, so a group of copies makes about as many rows as
   it has members, not pairs. A group larger than a block is dealt out as pairs of blocks.
4. Large-star and small-star turn the links into components.

With the default 32 bands of 7 rows, two sets at the least similarity of 0.85 fail to meet with
probability 4e-6, and the chance that verification passes over a true link is below 1e-7
(agreement of 224 minima at least 0.7, five standard deviations below 0.85).

Defined results: a null or wordless text has an empty set and is linked with nothing; a text of
fewer than ``SHINGLE`` words has its whole sequence as its one shingle. A doc_id that occurs on
several rows gives one row: the least component and then the least set size among its texts. A
null doc_id takes no part and gives no row; ``keep_first`` lets such rows pass and compares rows. An empty table
gives an empty result. Only ``doc_id`` (an integer) and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.components import components
from ledgerline.llm.frames import cut, small_batches
from ledgerline.llm.words import chunks, mix, windows, words_of

SHINGLE = 5
BLOCK = 256
#: 64-bit numbers of a set that are hashed at once.
PART = 2048


def shingles(texts: list[str | None]) -> list[np.ndarray]:
    """The sorted set of each text's shingle hashes."""
    out: list[np.ndarray] = []
    for _, group in chunks(texts):
        words = words_of(group, fold_case=True)
        out += [np.unique(windows(words.of(i), SHINGLE)) for i in range(len(group))]
    return out


def digest(members: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    with np.errstate(over="ignore"):
        low = mix(members ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
        high = mix(members + np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64)
    return int(low.astype(np.int64)), int(high.astype(np.int64))


def _hash_family(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(86_028_121)
    factors = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return factors[:, None], rng.integers(0, 1 << 63, n, dtype=np.uint64)[:, None]


def minima(members: np.ndarray, family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The least value of each hash function over the set."""
    factors, shifts = family
    least = np.full(len(factors), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(members), PART):
        hashed = factors * members[at : at + PART]
        hashed += shifts
        np.minimum(least, hashed.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def _describe(bands: int, rows: int):
    """doc_id, text -> doc_id, set size, digest, and a hash of the minima of each band."""
    family = _hash_family(bands * rows)

    def described(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = shingles(batch["text"].tolist())
            names = [digest(s) for s in sets]
            keys = []
            for s in sets:
                least = minima(s, family).reshape(bands, rows).astype(np.uint64)
                total = np.zeros(bands, dtype=np.uint64)
                for k in range(rows):
                    total = mix(total ^ least[:, k])
                keys.append(total.astype(np.int64) if len(s) else np.zeros(0, dtype=np.int64))
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "n_shingles": [len(s) for s in sets],
                    "low": [n[0] for n in names],
                    "high": [n[1] for n in names],
                    "bands": keys,
                }
            )

    return described


def _agreeing(left: np.ndarray, one: np.ndarray, least: float) -> np.ndarray:
    return np.flatnonzero((left == one).mean(axis=1) >= least)


def linked_pairs(ids: np.ndarray, sets: list[np.ndarray], block: np.ndarray, least: int, family) -> list[tuple[int, int]]:
    """Links that connect the members of one or two blocks as all pairs of similar sets would.

    Full sets are compared where the minima agree on at least ``least`` percent less fifteen points,
    and where the two aren't connected yet. With two blocks, pairs lie across them.
    """
    sizes = np.array([len(s) for s in sets])
    _, local = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    marks = np.array([minima(s, family) for s in sets])
    root = np.arange(len(ids))
    inside = np.zeros(local.max() + 1, dtype=np.int64)
    across = block.min() != block.max()
    out = []
    for i in range(len(ids)):
        others = np.arange(i + 1, len(ids))
        others = others[root[others] != root[i]]
        if across:
            others = others[block[others] != block[i]]
        if not len(others):
            continue
        others = others[_agreeing(marks[others], marks[i], least / 100 - 0.15)]
        if not len(others):
            continue
        own = local[starts[i] : ends[i]]
        inside[own] = 1
        for j in others:
            if root[i] == root[j]:
                continue
            common = int(inside[local[starts[j] : ends[j]]].sum())
            if 100 * common >= least * (sizes[i] + sizes[j] - common):
                out.append((int(ids[i]), int(ids[j])))
                root[root == root[j]] = root[i]
        inside[own] = 0
    return out


def _verify(bands: int, rows: int, least: int):
    family = _hash_family(bands * rows)

    def verified(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("doc_id")
        sets = [np.frombuffer(s, dtype="<u8") for s in part["members"]]
        found = linked_pairs(part["doc_id"].to_numpy(), sets, part["block"].to_numpy(), least, family)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return verified


def _member_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame(
            {"doc_id": batch["doc_id"], "members": [s.astype("<u8").tobytes() for s in shingles(batch["text"].tolist())]}
        )


def near_duplicates(docs: DataFrame, least: int = 85, bands: int = 32, rows: int = 7) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each doc_id; sets are linked from ``least`` percent."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.where("doc_id is not null")
    described = cut(texts.mapInPandas(_describe(bands, rows), "doc_id long, n_shingles long, low long, high long, bands array<long>"))

    named = ["low", "high", "n_shingles"]
    full = described.where("n_shingles > 0")
    classes = cut(full.groupBy(*named).agg(F.min("doc_id").alias("rep"), F.any_value("bands").alias("bands")))

    keyed = classes.select("rep", F.posexplode("bands").alias("band", "key"))
    least_of = keyed.groupBy("band", "key").agg(F.min("rep").alias("b"), F.max("rep").alias("top")).where("top > b").drop("top")
    groups = cut(components(keyed.join(least_of, ["band", "key"]).where("rep <> b").select(F.col("rep").alias("a"), "b")))

    sized = groups.groupBy("component").agg(F.count("*").alias("members"))
    n_blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    placed = groups.join(sized, "component").select("node", "component", n_blocks.alias("n_blocks"))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("node"), "n_blocks").cast("int"))
    facing = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))
    dealt = placed.select("node", "component", "block", facing.alias("other"))
    dealt = dealt.select(
        F.col("node").alias("doc_id"), "component", "block",
        F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"),
    )

    # A representative with several texts is compared by each of them.
    wanted = texts.join(groups.select(F.col("node").alias("doc_id")), "doc_id", "left_semi")
    members = wanted.mapInPandas(_member_sets, "doc_id long, members binary").where(F.length("members") > 0)
    pairs = members.join(dealt, "doc_id").groupBy("component", "one", "two")
    links = pairs.applyInPandas(_verify(bands, rows, least), "a long, b long")
    found = components(links)

    own = full.select("doc_id", *named).join(classes.select(*named, "rep"), named)
    placed_rows = own.join(found, own["rep"] == found["node"], "left")
    linked = placed_rows.select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
    alone = described.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    result = linked.unionByName(alone).groupBy("doc_id").agg(F.min(F.struct("component_id", "n_shingles")).alias("r"))
    return result.select(
        "doc_id", F.col("r.n_shingles").alias("n_shingles"), F.col("r.component_id").alias("component_id"),
        (F.col("doc_id") == F.col("r.component_id")).alias("kept"),
    )


def keep_first(docs: DataFrame, **parameters) -> DataFrame:
    """One row of ``docs`` for each component, with all columns; rows without a doc_id pass.

    Rows are told apart by doc_id and text, so unlike texts under one doc_id both stay; of a component
    the row with the least doc_id stays, and one of a doc_id's wordless rows.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    named = F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")).alias("key")
    rows = docs.select(row, *named)
    texts = docs.where("doc_id is not null").select(named[1].alias("doc_id"), "text")
    found = near_duplicates(texts, **parameters).select(F.col("doc_id").alias("key"), "n_shingles", "component_id")
    placed = rows.where("id is not null").select("id", "key").join(found, "key")
    alone = F.col("n_shingles") == 0
    least = placed.groupBy(alone.alias("alone"), F.when(alone, F.col("id")).otherwise(F.col("component_id")).alias("of"))
    kept = least.agg(F.min(F.struct("id", "key")).alias("k")).select("k.key")
    once = rows.where("id is not null").join(kept, "key", "left_semi").dropDuplicates(["key"])
    return once.select("row.*").unionByName(rows.where("id is null").select("row.*"))
