"""Exact top-k search by inner product with a pivot-distance index.

Components become whole numbers, so scores are exact. Inner products become distances by one more
component that brings every vector to the length of the longest: the larger the inner product, the
nearer such a vector lies to the query, whose own further component is 0. Each vector is keyed by
its nearest pivot and its distance from it; the keys are sorted and cut into shelves of at most
``SHELF`` vectors of one pivot, each a row of sorted annuli of ``ANNULUS`` vectors.

A query first expands the annuli of the shelf nearest to its own key, which gives it a k-th score
to beat. It then goes to every other shelf that the triangle inequality doesn't rule out: a vector
at distance r from a pivot is at least ``|d - r|`` from a query at distance d. Within a shelf,
annuli are taken in the order of that bound, and the search ends where the bound falls below the
k-th score found so far. Rounding is allowed for on the side of looking, so the result is exact.

Pivots are centres of a sample of ``sample`` vectors in hash order; they affect speed alone, and
every vector is indexed. Queries go to shelves in parts of ``QUERY_PART``, so a task holds one
shelf and one part, whatever the number of either.

Defined results: vectors that are null or hold a null or non-finite component take no part, nor do
rows without an id. Shorter vectors count as if filled up with zeros. If an id occurs on several
rows, its least vector counts. A query never finds its own id. Equal scores rank by smaller id.
Fewer candidates than k give fewer rows; an empty table gives an empty result. Only ``vec_id`` and
``embedding`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.frames import cut

SCALE = 1024
SHELF, ANNULUS = 4096, 256
QUERY_PART = 4096
#: Relative allowance for rounding in distances.
SLACK = 1e-6


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): floor(SCALE * x) of each component, one row for each id."""
    x = F.col("embedding")
    finite = F.forall(x, lambda a: a.isNotNull() & ~F.isnan(a) & (F.abs(a) < float("inf")))
    rows = vectors.where(x.isNotNull() & finite & F.col("vec_id").isNotNull())
    v = F.transform(x, lambda a: F.floor(a.cast("double") * SCALE).cast("long"))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))


def matrix(rows, width: int) -> np.ndarray:
    """Vectors as rows, filled up with zeros."""
    out = np.zeros((len(rows), width), dtype=np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers; in floating point only where that is exact."""
    largest = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * max(left.shape[1], 1)
    if largest < 2.0**53:
        return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)
    if largest < 2.0**63:
        return left @ right.T
    exact = left.astype(object) @ right.astype(object).T
    return np.clip(exact, -(2**63), 2**63 - 1).astype(np.int64)


def choose_pivots(x: np.ndarray, n: int, rounds: int = 8) -> np.ndarray:
    """Centres far from each other, moved to the means of what is nearest."""
    if not len(x):
        return x
    centres = [x[0]]
    far = ((x - x[0]) ** 2).sum(axis=1)
    while len(centres) < n and far.max() > 0:
        centres.append(x[int(far.argmax())])
        far = np.minimum(far, ((x - centres[-1]) ** 2).sum(axis=1))
    pivots = np.array(centres)
    for _ in range(rounds):
        of = distances(x, pivots).argmin(axis=1)
        for p in np.unique(of):
            pivots[p] = x[of == p].mean(axis=0)
    return pivots


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x**2).sum(axis=1)[:, None] + (pivots**2).sum(axis=1) - 2 * x @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def lifted(v: np.ndarray, square: float) -> np.ndarray:
    """Vectors with the component that brings them to the common squared length."""
    v = v.astype(np.float64)
    return np.column_stack([v, np.sqrt(np.maximum(square - (v**2).sum(axis=1), 0))])


def _shelve(pivots: np.ndarray, width: int, square: float):
    """Keys of the vectors, and from sorted keys the shelves."""

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            v = matrix(batch["v"], width)
            d = distances(lifted(v, square), pivots)
            of = d.argmin(axis=1)
            yield pd.DataFrame(
                {"vec_id": batch["vec_id"], "pivot": of, "distance": d[np.arange(len(v)), of], "v": [a.tobytes() for a in v]}
            )

    def shelved(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def shelf(part: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame(
                {
                    "pivot": [int(part["pivot"].iloc[0])], "low": [part["distance"].iloc[0]], "high": [part["distance"].iloc[-1]],
                    "ids": [part["vec_id"].to_numpy(dtype="<i8").tobytes()],
                    "away": [part["distance"].to_numpy(dtype="<f8").tobytes()], "vectors": [b"".join(part["v"])],
                }
            )

        held: pd.DataFrame | None = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            while len(held):
                same = int((held["pivot"] == held["pivot"].iloc[0]).to_numpy().argmin()) or len(held)
                if same < SHELF and same == len(held):
                    break
                yield shelf(held.iloc[: min(same, SHELF)])
                held = held.iloc[min(same, SHELF) :].reset_index(drop=True)
        if held is not None and len(held):
            yield shelf(held)

    return keyed, shelved


class Best:
    """The k best (score, id) found so far, by score and then smaller id."""

    def __init__(self, k: int, floor: int | None) -> None:
        self.k, self.floor = k, floor
        self.scores, self.ids = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def least(self) -> float:
        """The score that a vector must reach to matter."""
        own = self.scores[-1] if len(self.scores) == self.k else None
        return max((float(x) for x in (own, self.floor) if x is not None), default=-np.inf)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        matters = scores >= self.least()
        scores, ids = np.append(self.scores, scores[matters]), np.append(self.ids, ids[matters])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]


def _search(k: int, width: int, square: float):
    """For one shelf and some queries, the best of the shelf for each query."""

    def searched(shelf: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(shelf) and len(asking):
            row = shelf.iloc[0]
            ids, away = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["away"], "<f8")
            vectors = np.frombuffer(row["vectors"], "<i8").reshape(-1, width)
            edges = np.arange(0, len(ids), ANNULUS)
            low, high = away[edges], away[np.minimum(edges + ANNULUS, len(ids)) - 1]
            for name, data, d, floor in zip(asking["query_id"], asking["q"], asking["d"], asking["floor"], strict=True):
                q = np.frombuffer(data, "<i8")
                size = float((q.astype(float) ** 2).sum()) + square
                bound = best_possible(d, low, high, size)
                best = Best(k, None if pd.isna(floor) else int(floor))
                for annulus in np.argsort(-bound, kind="stable"):
                    if bound[annulus] < best.least():
                        break
                    part = slice(edges[annulus], edges[annulus] + ANNULUS)
                    other = ids[part] != name
                    best.add(products(vectors[part][other], q[None, :])[:, 0], ids[part][other])
                out += [(name, i, s) for i, s in zip(best.ids.tolist(), best.scores.tolist(), strict=True)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"], dtype="int64")

    return searched


def best_possible(d, low, high, size: float):
    """No vector between ``low`` and ``high`` from a pivot has a higher score for a query at ``d``.

    ``size`` is the squared length of the query plus the common squared length of the vectors.
    """
    away = np.maximum(np.maximum(d - high, low - d), 0)
    return (size - away**2) / 2 + SLACK * size + 1


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, pivots: int = 64, sample: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best for each row of ``vectors`` that is a query."""
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score long"
    whole = cut(whole_vectors(vectors))
    length = F.aggregate("v", F.lit(0.0), lambda s, a: s + a.cast("double") * a.cast("double"))
    width, square = whole.agg(F.max(F.size("v")), F.max(length)).first()
    if width is None:
        return spark.createDataFrame([], schema)
    width, square = max(width, 1), float(square)
    drawn = whole.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).toPandas()
    centres = choose_pivots(lifted(matrix(drawn["v"], width), square), pivots)

    keyed, shelved = _shelve(centres, width, square)
    key = ["pivot", "distance", "vec_id"]
    sorted_keys = whole.mapInPandas(keyed, "vec_id long, pivot int, distance double, v binary")
    sorted_keys = sorted_keys.repartitionByRange(*key).sortWithinPartitions(*key)
    shelves = sorted_keys.mapInPandas(shelved, "pivot int, low double, high double, ids binary, away binary, vectors binary")
    shelves = cut(shelves.withColumn("shelf", F.monotonically_increasing_id()))

    def asked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            v = matrix(batch["v"], width)
            d = distances(np.column_stack([v.astype(float), np.zeros(len(v))]), centres)
            yield pd.DataFrame(
                {
                    "query_id": batch["vec_id"], "q": [a.tobytes() for a in v],
                    "size": (v.astype(float) ** 2).sum(axis=1) + square, "away": d.tolist(),
                }
            )

    queries = whole.where(is_query).mapInPandas(asked, "query_id long, q binary, size double, away array<double>")
    parts = max(1, -(-whole.where(is_query).count() // QUERY_PART))
    queries = cut(queries.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(parts)).cast("int")))
    places = queries.select("query_id", "size", F.posexplode("away").alias("pivot", "d"))
    ranges = shelves.select("shelf", "pivot", "low", "high")
    away = F.greatest(F.col("d") - F.col("high"), F.col("low") - F.col("d"), F.lit(0.0))
    bound = (F.col("size") - away * away) / 2 + SLACK * F.col("size") + 1
    facing = places.join(ranges, "pivot").select("query_id", "shelf", "d", bound.alias("bound"), away.alias("gap"))

    def found(pairs: DataFrame) -> DataFrame:
        asking = pairs.join(queries.select("query_id", "q", "part"), "query_id")
        needed = asking.select("shelf", "part").distinct().join(shelves.select("shelf", "ids", "away", "vectors"), "shelf")
        needed = needed.toDF("of_shelf", "of_part", "ids", "away", "vectors")
        both = needed.groupBy("of_shelf", "of_part").cogroup(asking.groupBy("shelf", "part"))
        return both.applyInPandas(_search(k, width, square), "query_id long, vec_id long, score long")

    nearest = Window.partitionBy("query_id").orderBy("gap", "d", "shelf")
    home = facing.withColumn("n", F.row_number().over(nearest)).where("n = 1")
    first = cut(found(home.select("query_id", "shelf", "d", F.lit(None).cast("long").alias("floor"))))
    floors = first.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("floor"))
    ahead = facing.join(floors, "query_id", "left").where("floor is null or bound >= floor")
    ahead = ahead.join(home.select("query_id", "shelf"), ["query_id", "shelf"], "left_anti")
    every = first.unionByName(found(ahead.select("query_id", "shelf", "d", "floor")))
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranks = every.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    return ranks.select("query_id", "rank", "vec_id", "score")
