"""Scoring of whole texts by a causal self-attention model on subword ids, trained in numpy.

Texts are lower-cased (A-Z) and read as words, then one end. A word becomes the ids of a byte-level
BPE file; a symbol is an id and whether it ends its word, so a sequence of symbols spells exactly
one text and word probabilities add up to at most one.

The model. Self-attention over the symbols before a position gives weights for a few topics; the
next symbol has the topics' probabilities after the symbol before it, mixed by these weights. A
word's probability is the product over its symbols, interpolated with its smoothed frequency. The
attention looks at windows of ``CONTEXT + STRIDE`` symbols that overlap by ``CONTEXT``, many at once
under one causal mask, and scores the last ``STRIDE`` of each, so every token is scored once.

What is learned comes from all training documents: word counts, symbol counts, topics (k-means over
documents' symbol shares, all documents in every round) and counts of symbol pairs by topic. The
attention's small matrices are trained by gradient steps on all windows of all training documents, chunk
by chunk, and averaged, for ``rounds`` rounds.

How it runs. Texts are coded once into chunks of about ``CHUNK_TEXT`` bytes: a dictionary of the
chunk's words and the texts as numbers in it. Every later pass reads chunks. Word counts are summed
over the corpus by word and sent back to the chunks that hold the word; the vocabulary is never
in one place. Tables whose size does not depend on the corpus (symbols, topics, pairs of the
``FREQUENT`` commonest symbols) are sent to all tasks.

Defined results: a null or empty text is its end alone. Repeated rows are scored and learned from
like others; a null doc_id counts as the empty text for the split. Without training documents
every token has the smoothing's probability in the base, and the model knows no symbol. An empty
table gives an empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import zstandard
from numpy.lib.stride_tricks import sliding_window_view
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.frames import crc32_of_id, cut, small_batches
from ledgerline.llm.subwords import encoder
from ledgerline.llm.words import _IS_SPACE, chunks, words_of

SMOOTHING = 0.1
CHUNK_TEXT = 6 << 20
FREQUENT = 512
TOPICS = 8
TOPIC_ROUNDS = 4
SEED_DOCUMENTS = 256
CONTEXT, STRIDE = 32, 32
WIDTH = 16
BATCH = 128
ATTENTION_SHARE = 0.75

#: Reduced alphabet: 0 the end, 1 to FREQUENT - 1 symbols, FREQUENT all rarer ones, then the begin; no symbol.
END, RARE, BEGIN, NOTHING = 0, FREQUENT, FREQUENT + 1, FREQUENT + 2


# ---- chunks ---------------------------------------------------------------------------

CHUNK = (
    "chunk long, doc_ids array<long>, held array<boolean>, ends binary, codes binary, "
    "hashes binary, trained binary, pieces binary, piece_sizes binary"
)


def _packed(a: np.ndarray, kind: str) -> bytes:
    """Byte by byte: higher bytes of small numbers are runs of zeros, those of sorted ones nearly so."""
    whole = np.ascontiguousarray(a, dtype=kind)
    planes = whole.view(np.uint8).reshape(-1, whole.itemsize).T
    return zstandard.ZstdCompressor(3).compress(np.ascontiguousarray(planes).tobytes())


def _unpacked(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(kind)[:, 0]


def _packed_symbols(symbols: np.ndarray) -> bytes:
    """Number by number, since runs of symbols recur."""
    return zstandard.ZstdCompressor(3).compress(np.ascontiguousarray(symbols, dtype="<i4").tobytes())


def _unpacked_symbols(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype="<i4")


_SPACE = np.array([ord(" ")], dtype=np.uint8)


def _spelled(words: list, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Some of the words of several groups, each after a space and before ``BREAK``; their begins."""
    offsets = np.cumsum([0, *[len(w.data) + 1 for w in words]])
    begin = np.concatenate([w.starts + o for w, o in zip(words, offsets, strict=False)])[at]
    data = np.concatenate([x for w in words for x in (w.data, _SPACE)])
    space = np.flatnonzero(_IS_SPACE[data])
    length = space[np.searchsorted(space, begin)] - begin
    ends = np.cumsum(length + 2)
    out = np.zeros(int(ends[-1]), dtype=np.uint8)
    first = ends - length - 2
    out[first] = ord(" ")
    step = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    letters = data[np.repeat(begin, length) + step]
    letters = np.where((letters >= ord("A")) & (letters <= ord("Z")), letters + 32, letters)
    out[np.repeat(first + 1, length) + step] = letters
    return out, np.append(first, len(out))


def code_texts(texts: list[str | None], path: str) -> tuple[np.ndarray, ...]:
    """(ends of the texts, codes, hashes of the dictionary, its symbols, their ends) of some texts.

    The commonest words have the smallest codes.
    """
    words = [words_of(group, fold_case=True) for _, group in chunks(texts)]
    sizes = np.cumsum([0, *[len(w.hashes) for w in words]])
    ends = [w.first[1:] + n for w, n in zip(words, sizes, strict=False)]
    joined = np.concatenate([np.zeros(0, dtype=np.uint64), *[w.hashes for w in words]])
    if not len(joined):
        nothing = np.zeros(0, dtype=np.int64)
        return np.concatenate([nothing, *ends]), nothing, joined, nothing, nothing
    # Any occurrence of a word spells it, so the order need not be stable.
    order = joined.argsort()
    ordered = joined[order]
    new = np.append(True, ordered[1:] != ordered[:-1])
    dictionary, at = ordered[new], order[new]
    codes = np.empty(len(joined), dtype=np.int64)
    codes[order] = np.cumsum(new) - 1
    order = np.argsort(-np.bincount(codes), kind="stable")
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    dictionary, at, codes = dictionary[order], at[order], place[codes]
    data, begins = _spelled(words, at)
    one, whole = encoder(path), data.tobytes()
    if any(s in whole for s in one.special):
        ids, first = one.encode([whole[i : j - 1] for i, j in zip(begins[:-1], begins[1:], strict=True)])
    else:
        ids, first = one.encode_data(data, begins)
    symbols = ids.astype(np.int64) * 2
    symbols[first[1:] - 1] += 1
    return np.concatenate(ends), codes, dictionary, symbols, first[1:]


def _code_chunks(path: str):
    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, made = TaskContext.get().partitionId(), 0

        def chunk(rows: list[tuple]) -> pd.DataFrame:
            texts, held = [r[1] for r in rows], np.array([r[2] for r in rows])
            ends, codes, dictionary, symbols, piece_ends = code_texts(texts, path)
            learned = np.repeat(~held, np.diff(ends, prepend=0))
            counts = np.bincount(codes[learned], minlength=len(dictionary))
            return pd.DataFrame(
                {
                    "chunk": [(task << 32) + made],
                    "doc_ids": [[r[0] for r in rows]],
                    "held": [held.tolist()],
                    "ends": [_packed(ends, "<i8")],
                    "codes": [_packed(codes, "<i4")],
                    "hashes": [_packed(dictionary, "<u8")],
                    "trained": [_packed(counts, "<i4")],
                    "pieces": [_packed_symbols(symbols)],
                    "piece_sizes": [_packed(np.diff(piece_ends, prepend=0), "<i4")],
                }
            )

        rows, size = [], 0
        for batch in batches:
            for name, text, held in zip(batch["doc_id"], batch["text"], batch["held"], strict=True):
                rows.append((None if pd.isna(name) else int(name), text, bool(held)))
                size += len(text or "")
                if size >= CHUNK_TEXT:
                    yield chunk(rows)
                    rows, size, made = [], 0, made + 1
        if rows:
            yield chunk(rows)

    return coded


@dataclass
class Coded:
    """A chunk, unpacked."""

    held: np.ndarray
    ends: np.ndarray
    codes: np.ndarray
    pieces: np.ndarray
    piece_ends: np.ndarray

    @staticmethod
    def of(row) -> Coded:
        return Coded(
            np.array(row["held"], dtype=bool), _unpacked(row["ends"], "<i8"), _unpacked(row["codes"], "<i4"),
            _unpacked_symbols(row["pieces"]), np.cumsum(_unpacked(row["piece_sizes"], "<i4"), dtype=np.int64),
        )

    def symbols(
        self, documents: np.ndarray, pieces: np.ndarray | None = None, begin: int = -1, end: int = -2
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols of some documents in a row; each document's start; word ends.

        ``pieces`` may stand for the dictionary's symbols. The begin and the end of a document are
        put in as words of one symbol, before its words and after them.
        """
        pieces = self.pieces if pieces is None else pieces
        piece_ends = np.append(self.piece_ends, len(pieces) + np.arange(1, 3)).astype(np.int32)
        sizes = np.diff(piece_ends, prepend=0).astype(np.int32)
        starts = np.concatenate(([0], self.ends[:-1])) if len(self.ends) else self.ends
        n_words = (self.ends - starts)[documents]
        last = np.cumsum(n_words + 2) - 1
        inner = np.ones(int((n_words + 2).sum()), dtype=bool)
        inner[last] = inner[last - n_words - 1] = False
        codes = np.full(len(inner), len(sizes) - 1, dtype=np.int32)
        codes[last - n_words - 1] -= 1
        which = np.repeat(starts[documents] - np.cumsum(n_words) + n_words, n_words) + np.arange(n_words.sum())
        codes[inner] = self.codes[which]
        lengths = sizes[codes]
        upto = np.cumsum(lengths, dtype=np.int32)
        source = np.repeat(piece_ends[codes] - upto, lengths)
        source += np.arange(len(source), dtype=np.int32)
        out = np.append(pieces, np.array([begin, end], dtype=pieces.dtype)).take(source)
        return out, np.concatenate(([0], upto[last])).astype(np.int64), upto[inner].astype(np.int64) - 1


#: What a chunk's documents are read from.
TEXTS = ("chunk", "held", "ends", "codes", "pieces", "piece_sizes")


def _each_chunk(chunked: DataFrame, function, schema: str, columns: tuple[str, ...] = TEXTS) -> DataFrame:
    """Rows that ``function`` makes of each chunk; a chunk is one row, of which it gets some columns."""

    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, row in batch.iterrows():
                yield function(row)

    return chunked.select(*columns).mapInPandas(over, schema)


# ---- counts ---------------------------------------------------------------------------


@dataclass
class Alphabet:
    """Which symbols have a number of their own, and the probability of each other symbol."""

    number: np.ndarray
    rare: np.ndarray

    @staticmethod
    def of(counts: pd.DataFrame, size: int) -> Alphabet:
        total = np.zeros(2 * size)
        total[counts["symbol"].to_numpy()] = counts["n"]
        common = np.lexsort((np.arange(2 * size), -total))[: FREQUENT - 1]
        common = common[total[common] > 0]
        number = np.full(2 * size, RARE, dtype=np.int16)
        number[common] = np.arange(1, len(common) + 1)
        rest = total + SMOOTHING
        rest[common] = 0
        return Alphabet(number, np.log10(np.maximum(rest, 1e-300) / rest.sum()).astype(np.float32))

    def reduced(self, symbols: np.ndarray) -> np.ndarray:
        out = self.number[np.maximum(symbols, 0)].astype(np.int32)
        out[symbols == -1] = BEGIN
        out[symbols == -2] = END
        return out


def _symbol_counts(row) -> pd.DataFrame:
    """Counts over the chunk's training documents: those of its words, for each symbol of the word."""
    times = np.repeat(_unpacked(row["trained"], "<i4"), _unpacked(row["piece_sizes"], "<i4"))
    n = np.bincount(_unpacked_symbols(row["pieces"]), weights=times).astype(np.int64)
    found = np.flatnonzero(n)
    return pd.DataFrame({"symbol": found, "n": n[found]})


def _counted(reduced: np.ndarray, first: np.ndarray) -> np.ndarray:
    """How often each symbol is in each document."""
    n = len(first) - 1
    document = np.repeat(np.arange(n), np.diff(first))
    counts = np.bincount(document * (BEGIN + 1) + reduced, minlength=n * (BEGIN + 1)).reshape(n, BEGIN + 1)
    return counts[:, : RARE + 1]


def _shares_of(counts: np.ndarray) -> np.ndarray:
    counts = counts.astype(np.float32)
    return np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1))


def shares(reduced: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Square roots of the shares of each symbol in each document."""
    return _shares_of(_counted(reduced, first))


def _documents(row, alphabet: Alphabet, keep: np.ndarray | None = None):
    one = Coded.of(row)
    chosen = np.flatnonzero(~one.held) if keep is None else keep
    reduced, first, _ = one.symbols(chosen, alphabet.number[one.pieces], BEGIN, END)
    return reduced, first


def _seeds(chunked: DataFrame, alphabet: Alphabet) -> np.ndarray:
    """Starting centres: shares of documents far from each other, among the first by hash order.

    The order is settled on the hashes alone, so that no more than the chosen documents' shares
    are gathered, however many chunks there are.
    """
    each = chunked.select(F.explode(F.arrays_zip("doc_ids", "held")).alias("d")).select("d.*").where(~F.col("held"))
    first_ones = each.select(crc32_of_id("doc_ids").alias("order")).orderBy("order").limit(SEED_DOCUMENTS)
    last = first_ones.agg(F.max("order")).first()[0]
    if last is None:
        return np.zeros((TOPICS, RARE + 1), dtype=np.float32)

    def some(row) -> pd.DataFrame:
        names = np.array([zlib.crc32(("" if i is None else str(i)).encode()) for i in row["doc_ids"]])
        chosen = np.flatnonzero(~np.array(row["held"], dtype=bool) & (names <= last))
        picked = chosen[np.argsort(names[chosen], kind="stable")[:SEED_DOCUMENTS]]
        reduced, first = _documents(row, alphabet, picked)
        return pd.DataFrame(
            {"order": names[picked], "share": pd.Series([s.tolist() for s in shares(reduced, first)], dtype=object)}
        )

    rows = _each_chunk(chunked, some, "order long, share array<float>", ("doc_ids", *TEXTS)).orderBy("order", "share").limit(SEED_DOCUMENTS).toPandas()
    x = np.array(rows["share"].tolist(), dtype=np.float32)
    centres = [x.mean(axis=0)]
    for _ in range(TOPICS):
        distance = np.min([((x - c) ** 2).sum(axis=1) for c in centres], axis=0)
        centres.append(x[int(distance.argmax())])
    return np.array(centres[1:])


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1) - 2 * x @ centres.T).argmin(axis=1)


def _counts_by_document(chunked: DataFrame, alphabet: Alphabet) -> DataFrame:
    """Each chunk's counts by training document and symbol, computed once for all rounds."""

    def counted(row) -> pd.DataFrame:
        return pd.DataFrame({"counts": [_packed(_counted(*_documents(row, alphabet)).ravel(), "<i4")]})

    return cut(_each_chunk(chunked, counted, "counts binary"))


def _moved(counted: DataFrame, centres: np.ndarray) -> np.ndarray:
    """The centres' means over all training documents."""

    def sums(row) -> pd.DataFrame:
        x = _shares_of(_unpacked(row["counts"], "<i4").reshape(-1, RARE + 1))
        of = nearest(x, centres)
        member = (of[:, None] == np.arange(TOPICS)).astype(np.float32)
        return pd.DataFrame(
            {"topic": np.arange(TOPICS), "n": member.sum(axis=0), "total": [t.tolist() for t in (member.T @ x).astype(float)]}
        )

    rows = _each_chunk(counted, sums, "topic int, n double, total array<double>", ("counts",))
    spread = rows.select("topic", "n", F.posexplode("total").alias("at", "part"))
    total = spread.groupBy("topic", "at").agg(F.sum("n").alias("n"), F.sum("part").alias("part")).toPandas()
    out = centres.copy()
    some = total[total["n"] > 0]
    out[some["topic"], some["at"]] = some["part"] / some["n"]
    return out


def _pair_counts(chunked: DataFrame, alphabet: Alphabet, centres: np.ndarray) -> np.ndarray:
    """Counts (topic, symbol before, symbol) over all training documents."""
    shape = (TOPICS, BEGIN + 1, RARE + 1)

    def pairs(row) -> pd.DataFrame:
        reduced, first = _documents(row, alphabet)
        topic = np.repeat(nearest(shares(reduced, first), centres), np.diff(first))
        inner = reduced[1:] != BEGIN
        key = np.ravel_multi_index((topic[1:][inner], reduced[:-1][inner], reduced[1:][inner]), shape)
        n = np.bincount(key, minlength=0)
        found = np.flatnonzero(n)
        return pd.DataFrame({"pair": found, "n": n[found]})

    total = _each_chunk(chunked, pairs, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(shape, dtype=np.float64)
    out.reshape(-1)[total["pair"].to_numpy()] = total["n"]
    return out


def topic_probabilities(counts: np.ndarray, backing: float = 20.0) -> np.ndarray:
    """(symbol before, symbol, topic): shares backed by all topics' pairs and by single symbols."""
    single = counts.sum(axis=(0, 1)) + SMOOTHING
    single /= single.sum()
    pair = counts.sum(axis=0) + backing * single
    pair /= pair.sum(axis=1, keepdims=True)
    each = counts + backing * pair
    each /= each.sum(axis=2, keepdims=True)
    return np.ascontiguousarray(each.transpose(1, 2, 0), dtype=np.float32)


# ---- attention ------------------------------------------------------------------------


@dataclass
class Attention:
    """``symbols`` describes each symbol by its topics, its last part is 1; the matrices are trained."""

    symbols: np.ndarray
    query: np.ndarray
    key: np.ndarray
    value: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    near: np.ndarray

    TRAINED = ("query", "key", "value", "out", "bias", "near")

    @staticmethod
    def begin(counts: np.ndarray, seed: int) -> Attention:
        """Every earlier symbol counts alike and speaks for the topics it is common in."""
        rng = np.random.default_rng(seed)
        of_topic = counts.sum(axis=1) + 1.0
        prior = of_topic.sum(axis=1)
        speaks = np.log(of_topic / prior[:, None])
        speaks -= speaks.mean(axis=0)
        told = np.zeros((BEGIN + 1, TOPICS + 3))
        told[: RARE + 1, :TOPICS] = speaks.T
        told[RARE, TOPICS] = told[BEGIN, TOPICS + 1] = 1
        told[:, TOPICS + 2] = 1
        value = np.zeros((TOPICS + 3, WIDTH))
        value[:TOPICS, :TOPICS] = np.eye(TOPICS)
        out = np.zeros((WIDTH, TOPICS))
        out[:TOPICS] = 4 * np.eye(TOPICS)
        parts = (
            told, rng.normal(0, 0.1, (TOPICS + 3, WIDTH)), rng.normal(0, 0.1, (TOPICS + 3, WIDTH)), value, out,
            np.log(prior / prior.sum()), np.zeros(CONTEXT + STRIDE),
        )
        return Attention(*[p.astype(np.float32) for p in parts])

    def parameters(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.TRAINED])

    def with_parameters(self, flat: np.ndarray) -> Attention:
        at, parts, flat = 0, {}, np.asarray(flat, dtype=np.float32)
        for n in self.TRAINED:
            old = getattr(self, n)
            parts[n] = flat[at : at + old.size].reshape(old.shape)
            at += old.size
        return replace(self, **parts)


@dataclass
class Windows:
    """Positions of many windows over documents that lie one after another."""

    start: np.ndarray  # first scored position
    first: np.ndarray  # first position of the document
    end: np.ndarray

    @staticmethod
    def over(first: np.ndarray) -> Windows:
        """Each position but a document's begin is scored in one window."""
        scored = np.diff(first) - 1
        n = -(-scored // STRIDE)
        document = np.repeat(np.arange(len(n)), n)
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return Windows(first[:-1][document] + 1 + k * STRIDE, first[:-1][document], first[1:][document])

    def pick(self, which) -> Windows:
        return Windows(self.start[which], self.first[which], self.end[which])


_STEP = np.arange(STRIDE)
_SPAN = np.arange(CONTEXT + STRIDE)
#: How far before the scored position (second axis) a seen position (first axis) lies; it must lie before it.
_DISTANCE = _STEP[None, :] - _SPAN[:, None] + CONTEXT
_FURTHER = np.where(_DISTANCE > 0, _DISTANCE - 1, CONTEXT + STRIDE)


def _by_start(reduced: np.ndarray) -> np.ndarray:
    """A view of the symbols around each possible start of a window."""
    out = np.full(len(reduced) + CONTEXT + STRIDE, END, dtype=np.int16)
    out[CONTEXT : CONTEXT + len(reduced)] = reduced
    return sliding_window_view(out, CONTEXT + STRIDE)


def _seen(by_start: np.ndarray, w: Windows) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of each window, ``NOTHING`` before the document; which of its last ``STRIDE`` are scored."""
    seen = by_start[w.start].astype(np.intp)
    np.putmask(seen, _SPAN < (w.first - w.start + CONTEXT)[:, None], NOTHING)
    return seen, _STEP < (w.end - w.start)[:, None]


def _told(model: Attention) -> tuple[np.ndarray, np.ndarray]:
    """A row for each symbol, and a column; those of ``NOTHING`` are zero, so it has no part in any sum."""
    rows = np.concatenate([model.symbols, np.zeros_like(model.symbols[:1])])
    return rows, np.ascontiguousarray(rows.T)


@dataclass
class Look:
    """What a model sees in some windows; places are their scored positions, one after another.

    Scores depend on symbols alone, by one matrix of what symbols tell, and so do values. So weights
    are applied to what the seen symbols tell (its last part is 1 and sums up the weights), and only
    the result, a few numbers for each place, is taken through the model's matrices.
    """

    before: np.ndarray  # (told, place)
    around: np.ndarray  # (window, seen, told)
    weights: np.ndarray  # (window, seen, scored), not yet divided by their sums
    total: np.ndarray
    mixed: np.ndarray  # (told, place), divided by the sums
    gate: np.ndarray  # (topic, place)
    said: np.ndarray  # (topic, place)


def _weighted(around: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """(told, place): what the seen symbols tell, added up by weights (window, seen, scored)."""
    out = np.empty((around.shape[2], len(around), STRIDE), dtype=weights.dtype)
    np.matmul(around.transpose(0, 2, 1), weights, out=out.transpose(1, 0, 2))
    return out.reshape(around.shape[2], -1)


def _scale(model: Attention):
    return model.query.dtype.type(1 / np.sqrt(WIDTH))


def _room(windows: int, kind: np.dtype) -> np.ndarray:
    """Memory for the weights of some windows, used again and again."""
    return np.empty((windows, CONTEXT + STRIDE, STRIDE), dtype=kind)


def _look(model: Attention, told: tuple[np.ndarray, np.ndarray], topics: np.ndarray, seen: np.ndarray, room: np.ndarray) -> Look:
    """``topics`` has a row for each pair of symbols; the weights are put into ``room``."""
    symbol, following = seen[:, CONTEXT - 1 : -1].ravel(), np.minimum(seen[:, CONTEXT:], RARE).ravel()
    before, around = told[1].take(symbol, axis=1), told[0].take(seen, axis=0)
    answers = model.key @ model.query.T * _scale(model)
    asked = (answers @ before).reshape(-1, len(seen), STRIDE).transpose(1, 0, 2)
    weights = np.matmul(around, asked, out=room[: len(seen)])
    weights += np.append(model.near, model.near.dtype.type(-np.inf)).take(_FURTHER)
    if weights.max() > 60:
        np.minimum(weights, 60, out=weights)
    np.exp(weights, out=weights)
    mixed = _weighted(around, weights)
    total = mixed[-1] + mixed.dtype.type(1e-30)
    mixed *= 1 / total
    gate = (model.value @ model.out).T @ mixed
    gate += model.bias[:, None]
    gate -= gate.max(axis=0)
    np.exp(gate, out=gate)
    gate *= 1 / gate.sum(axis=0)
    said = gate * topics.take(symbol * (RARE + 1) + following, axis=0).T
    return Look(before, around, weights, total, mixed, gate, said)


def symbol_scores(model: Attention, topics: np.ndarray, reduced: np.ndarray, first: np.ndarray) -> np.ndarray:
    """log10 of each position's probability given its document before it; 0 at the begins."""
    out = np.zeros(len(reduced), dtype=np.float32)
    windows, by_start, told = Windows.over(first), _by_start(reduced), _told(model)
    pairs, room = topics.reshape(-1, topics.shape[2]), _room(BATCH, model.query.dtype)
    for k in range(0, len(windows.start), BATCH):
        w = windows.pick(slice(k, k + BATCH))
        seen, scored = _seen(by_start, w)
        p = _look(model, told, pairs, seen, room).said.sum(axis=0).reshape(scored.shape)
        out[(w.start[:, None] + _STEP)[scored]] = np.log10(p[scored])
    return out


def _slopes(model: Attention, at: Look, p: np.ndarray, scored: np.ndarray, room: np.ndarray) -> dict[str, np.ndarray]:
    """The gradient of the mean log likelihood of the scored places, whose probabilities are ``p``."""
    share = scored.ravel() * p.dtype.type(1 / max(int(scored.sum()), 1))
    up = at.said * (share / p)
    up -= at.gate * share
    by_topic = at.mixed @ up.T
    # A weight's slope is what its seen symbol tells times these, a row for each part of it.
    down = model.value @ model.out @ up
    down[-1] -= np.einsum("tp,tp->p", down, at.mixed)
    down *= 1 / at.total
    d_raw = np.matmul(at.around, down.reshape(len(down), -1, STRIDE).transpose(1, 0, 2), out=room[: len(at.around)])
    d_raw *= at.weights
    by_pair = at.before @ _weighted(at.around, d_raw).T * _scale(model)
    by_place = np.ones(len(d_raw), dtype=d_raw.dtype) @ d_raw.reshape(len(d_raw), -1)
    near = np.bincount(_FURTHER.ravel(), weights=by_place)
    return {
        "query": by_pair @ model.key,
        "key": by_pair.T @ model.query,
        "value": by_topic @ model.out.T,
        "out": model.value.T @ by_topic,
        "bias": up.sum(axis=1),
        "near": near[: CONTEXT + STRIDE],
    }


def gradient(model: Attention, topics: np.ndarray, reduced: np.ndarray, w: Windows) -> tuple[float, dict[str, np.ndarray]]:
    """Mean log likelihood of the scored positions and its gradient."""
    seen, scored = _seen(_by_start(reduced), w)
    rooms = [_room(len(seen), model.query.dtype) for _ in range(2)]
    at = _look(model, _told(model), topics.reshape(-1, topics.shape[2]), seen, rooms[0])
    p = at.said.sum(axis=0)
    return float(np.log(p[scored.ravel()]).mean()) if scored.any() else 0.0, _slopes(model, at, p, scored, rooms[1])


def train(model: Attention, topics: np.ndarray, reduced: np.ndarray, first: np.ndarray, seed: int, rate: float = 0.02):
    """One pass of Adam over all windows in an order drawn from ``seed``; the model and the windows used."""
    windows = Windows.over(first)
    n = len(windows.start)
    windows = windows.pick(np.random.default_rng(seed).permutation(n))
    by_start, told, pairs = _by_start(reduced), _told(model), topics.reshape(-1, topics.shape[2])
    flat = model.parameters().astype(np.float64)
    moment, spread = np.zeros_like(flat), np.zeros_like(flat)
    size = 64
    rooms = [_room(size, model.query.dtype) for _ in range(2)]
    for t, k in enumerate(range(0, n, size), start=1):
        seen, scored = _seen(by_start, windows.pick(slice(k, k + size)))
        now = model.with_parameters(flat)
        at = _look(now, told, pairs, seen, rooms[0])
        slopes = _slopes(now, at, at.said.sum(axis=0), scored, rooms[1])
        g = np.concatenate([slopes[n].ravel() for n in Attention.TRAINED])
        moment += 0.1 * (g - moment)
        spread += 0.01 * (g * g - spread)
        flat += rate / (1 + 0.02 * t) * (moment / (1 - 0.9**t)) / (np.sqrt(spread / (1 - 0.99**t)) + 1e-8)
    return flat, n


# ---- tables ---------------------------------------------------------------------------


def held_out() -> Column:
    return crc32_of_id() % 10 == 0


def _trained(chunked: DataFrame, model: Attention, alphabet: Alphabet, topics, rounds: int) -> Attention:
    """Rounds of training on each chunk from the same start, averaged by the windows used."""
    for turn in range(rounds):

        def taught(row, start=model, seed=turn * 7919) -> pd.DataFrame:
            reduced, first = _documents(row, alphabet)
            flat, n = train(start, topics, reduced, first, seed + int(row["chunk"]) % 7919)
            return pd.DataFrame({"n": [float(n)], "flat": [flat.tolist()]})

        rows = _each_chunk(chunked, taught, "n double, flat array<double>").where("n > 0")
        spread = rows.select("n", F.posexplode("flat").alias("at", "x"))
        mean = spread.groupBy("at").agg((F.sum(F.col("n") * F.col("x")) / F.sum("n")).alias("x")).toPandas()
        if not mean.empty:
            model = model.with_parameters(mean.sort_values("at")["x"].to_numpy())
    return model


def _dictionary(row) -> pd.DataFrame:
    hashes = _unpacked(row["hashes"], "<u8").astype(np.int64)
    return pd.DataFrame(
        {"word": hashes, "chunk": row["chunk"], "code": np.arange(len(hashes), dtype=np.int32), "n": _unpacked(row["trained"], "<i4")}
    )


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_documents(docs: DataFrame, tokenizer: str, rounds: int = 2, seed: int = 5) -> DataFrame:
    """A row of ``SCORES`` for every row of ``docs``; see the module's text."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out().alias("held"))
    chunked = cut(rows.mapInPandas(_code_chunks(tokenizer), CHUNK))

    words = _each_chunk(chunked, _dictionary, "word long, chunk long, code int, n int", ("chunk", "hashes", "trained"))
    totals = words.where("n > 0").groupBy("word").agg(F.sum("n").alias("n")).agg(F.sum("n"), F.count("*")).first()
    n_ends = chunked.select(F.sum(F.size(F.filter("held", lambda h: ~h)))).first()[0] or 0
    n_tokens, n_types = int(totals[0] or 0) + n_ends, totals[1] + (n_ends > 0)

    size = encoder(tokenizer).tokenizer.get_vocab_size()
    by_symbol = _each_chunk(chunked, _symbol_counts, "symbol int, n long", ("trained", "pieces", "piece_sizes")).groupBy("symbol").agg(F.sum("n").alias("n"))
    alphabet = Alphabet.of(by_symbol.toPandas(), size)
    centres = _seeds(chunked, alphabet)
    counted = _counts_by_document(chunked, alphabet)
    for _ in range(TOPIC_ROUNDS):
        centres = _moved(counted, centres)
    counts = _pair_counts(chunked, alphabet, centres)
    topics = topic_probabilities(counts)
    model = _trained(chunked, Attention.begin(counts, seed), alphabet, topics, rounds)
    sent = spark.sparkContext.broadcast((model, topics, alphabet))

    # A chunk knows its own counts; only words that are learned elsewhere too come back to it.
    known = words.withColumn("c", F.sum("n").over(Window.partitionBy("word"))).where("c <> n").select("chunk", "code", "c")
    denominator = n_tokens + SMOOTHING * (n_types + 1)

    def scored(part: pd.DataFrame, seen: pd.DataFrame) -> pd.DataFrame:
        if part.empty:
            return pd.DataFrame(columns=[c.split()[0] for c in SCORES.split(", ")])
        row = part.iloc[0]
        one = Coded.of(row)
        model, topics, alphabet = sent.value
        count = _unpacked(row["trained"], "<i4").astype(float)
        count[seen["code"].to_numpy()] = seen["c"]
        base = np.log10((count + SMOOTHING) / denominator)
        base_end = np.log10((n_ends + SMOOTHING) / denominator)
        n_words = np.diff(one.ends, prepend=0)
        document = np.repeat(np.arange(len(n_words)), n_words)

        symbols, first, word_ends = one.symbols(np.arange(len(n_words)))
        reduced = alphabet.reduced(symbols)
        each = symbol_scores(model, topics, reduced, first).astype(np.float64)
        rare = reduced == RARE
        each[rare] += alphabet.rare[symbols[rare]]
        run = np.concatenate(([0.0], np.cumsum(each)))
        sizes = np.diff(one.piece_ends, prepend=0)[one.codes]
        by_attention = run[word_ends + 1] - run[word_ends + 1 - sizes]
        both = np.logaddexp(
            np.log(ATTENTION_SHARE) + by_attention * np.log(10), np.log(1 - ATTENTION_SHARE) + base[one.codes] * np.log(10)
        ) / np.log(10)
        end = np.log10(ATTENTION_SHARE * 10.0 ** each[first[1:] - 1] + (1 - ATTENTION_SHARE) * 10.0**base_end)
        add = lambda x: np.bincount(document, weights=x, minlength=len(n_words))
        return pd.DataFrame(
            {
                "doc_id": pd.array(row["doc_ids"], dtype="Int64"),
                "held_out": one.held,
                "n_tokens": n_words + 1,
                "n_known": add(count[one.codes] > 0).astype(np.int64) + (n_ends > 0),
                "train_tokens": n_tokens,
                "base_score": add(base[one.codes]) + base_end,
                "score": add(both) + end,
            }
        )

    payload = chunked.select("chunk", "doc_ids", "held", "ends", "codes", "trained", "pieces", "piece_sizes")
    return payload.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInPandas(scored, SCORES)
