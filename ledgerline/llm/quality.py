"""Quality of whole texts from a linear-chain conditional random field over their lines.

Every line gets features of its own bytes and words and those of the lines around it. The chain
has two states, good and bad; forward-backward gives each line's marginal, and the marginals,
weighted by the lines' lengths, give the document's quality, which a logistic curve turns into a
score between 0 and 1.

Only documents are labelled, so lines are taught in rounds: first every line has its document's
label; then lines of bad documents that the field finds good are taken as good, but for the worst
line of each. The field is fitted with numpy on at most ``fit_documents`` labelled documents of at
most ``fit_lines`` lines each, in hash order; both are fixed numbers, and only the features of
these lines reach the driver. Scoring is one pass over all
texts without a shuffle.

Defined results: a null text counts as empty; an empty text has one empty line, which is scored
like any other. Repeated rows and rows with a null doc_id are scored like others (null ids are not
learned from). Without labels of both kinds every score is 0.5. An empty table gives an empty
result. Only ``doc_id``, ``text`` and the labels' ``doc_id`` and ``quality`` are read; a score
depends on the text alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.frames import crc32_of_id, first_by_hash, quality_labels, rows_where, small_batches, text_udf
from ledgerline.llm.words import chunks, span_hashes, words_of

SCORE = "score double, predicted int, n_lines long, bad_lines long"

# ---- features -------------------------------------------------------------------------

KINDS = {
    "lower": bytes(range(97, 123)),
    "upper": bytes(range(65, 91)),
    "digit": bytes(range(48, 58)),
    "space": b" \t\x0b\x0c\r",
    "symbol": b"#*$%&<>~^=+_\\",
    "bar": b"|",
    "mark": b"!?",
    "stop": b".",
    "comma": b",;:",
    "other": b"\"'()-/@[]`{}",
    "part": bytes(range(128, 192)),
    "lead": bytes(range(192, 256)),
}
_KIND = np.full(256, len(KINDS), dtype=np.int64)
for _k, _bytes in enumerate(KINDS.values()):
    _KIND[list(_bytes)] = _k
N_KINDS = len(KINDS) + 1


def line_features(group: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features by line, bytes of each line, first line of each text); a text has at least one line."""
    joined = np.frombuffer(b"\n".join(group) + b"\n", dtype=np.uint8)
    ends = np.flatnonzero(joined == 10)
    starts = np.concatenate(([0], ends[:-1] + 1))
    lengths = ends - starts
    n_lines = len(starts)
    bounds = np.zeros(len(group) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in group], out=bounds[1:])
    first = np.searchsorted(starts, bounds)

    line_of = np.repeat(np.arange(n_lines), lengths + 1)
    kinds = np.bincount(line_of * N_KINDS + _KIND[joined], minlength=n_lines * N_KINDS).reshape(n_lines, N_KINDS)
    n = dict(zip(KINDS, kinds.T.astype(float), strict=False))

    pieces = words_of([joined.tobytes()], fold_case=False).hashes
    inside = _KIND[joined] != _KIND[32]
    inside[ends] = False
    word_at = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
    word_line = line_of[word_at]
    words = np.bincount(word_line, minlength=n_lines).astype(float)
    same = np.zeros(len(pieces), dtype=bool)
    same[1:] = (pieces[1:] == pieces[:-1]) & (word_line[1:] == word_line[:-1])
    repeats = np.bincount(word_line, weights=same, minlength=n_lines)

    text_of = np.repeat(np.arange(len(group)), np.diff(first))
    content = span_hashes(joined, starts) ^ (text_of.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    order = np.argsort(content, kind="stable")
    again = np.zeros(n_lines, dtype=bool)
    again[order[1:]] = content[order[1:]] == content[order[:-1]]
    again &= words > 0

    letters = np.maximum(n["lower"] + n["upper"] + n["lead"], 1)
    size = np.maximum(lengths - n["space"], 1)
    per_word = np.maximum(words, 1)
    shares = [
        n["symbol"] / per_word,
        n["bar"] / per_word,
        n["mark"] / per_word,
        n["upper"] / letters,
        n["digit"] / size,
        n["stop"] / per_word,
        n["comma"] / per_word,
        n["other"] / per_word,
        repeats / per_word,
    ]
    own = [np.minimum(s, 1.0) for s in shares]
    own += [(s > limit).astype(float) for s, limit in zip(shares, (0.1, 0.1, 0.1, 0.4, 0.3, 0.6, 0.6, 0.3, 0.2), strict=True)]
    own += [
        again.astype(float),
        (words == 0).astype(float),
        np.minimum(np.log1p(words) / 5, 2.0),
        np.minimum(size / per_word / 10, 3.0),
    ]
    return np.column_stack(own), np.maximum(lengths, 1).astype(float), first


def with_neighbours(own: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Each line's features, those of the line before and after in its text, and ends of the text."""
    n = len(own)
    starts, ends = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    starts[first[:-1]] = True
    ends[first[1:] - 1] = True
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:] = own[:-1]
    before[starts] = 0
    after[:-1] = own[1:]
    after[ends] = 0
    return np.column_stack([own, before, after, starts, ends, np.ones(n)])


# ---- the field ------------------------------------------------------------------------


@dataclass
class Chains:
    """Positions of the lines of several texts, so that all texts take a step together."""

    steps: list[np.ndarray]  # lines of the texts that have a line k, longest text first

    @staticmethod
    def of(first: np.ndarray) -> Chains:
        lengths = np.diff(first)
        order = np.argsort(-lengths, kind="stable")
        longest = lengths[order]
        counts = np.searchsorted(-longest, -np.arange(longest[0] if len(longest) else 0), side="left")
        return Chains([first[:-1][order[:c]] + k for k, c in enumerate(counts)])


def _joined(a: np.ndarray) -> np.ndarray:
    """log of the sum over the last axis but one."""
    top = a.max(axis=-2)
    return top + np.log(np.exp(a - top[..., None, :]).sum(axis=-2))


@dataclass
class Field:
    """Weights of "good" against "bad" and the scores of a step between states."""

    weights: np.ndarray
    steps: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def passes(self, emit: np.ndarray, chains: Chains) -> tuple[np.ndarray, np.ndarray]:
        """Forward and backward log scores of each line and state."""
        forward, backward = emit.copy(), np.zeros_like(emit)
        for k in range(1, len(chains.steps)):
            here = chains.steps[k]
            came = forward[chains.steps[k - 1][: len(here)]]
            forward[here] += _joined(came[:, :, None] + self.steps)
        for k in range(len(chains.steps) - 1, 0, -1):
            here = chains.steps[k]
            ahead = (emit + backward)[here] if len(here) < 64 else emit[here] + backward[here]
            backward[chains.steps[k - 1][: len(here)]] = _joined((self.steps + ahead[:, None, :]).transpose(0, 2, 1))
        return forward, backward

    def marginals(self, x: np.ndarray, chains: Chains) -> np.ndarray:
        """Probability of "good" for each line."""
        emit = np.column_stack([np.zeros(len(x)), x @ self.weights])
        forward, backward = self.passes(emit, chains)
        both = forward + backward
        return 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -500, 500)))

    def gradient(self, x, good, weight, chains, pull: float) -> tuple[float, np.ndarray, np.ndarray]:
        """Weighted log likelihood of the lines' labels, less the pull to 0, and its gradient."""
        emit = np.column_stack([np.zeros(len(x)), x @ self.weights])
        forward, backward = self.passes(emit, chains)
        both = forward + backward
        total = np.logaddexp(both[:, 0], both[:, 1])
        p = np.exp(both[:, 1] - total)
        d_weights = x.T @ ((good - p) * weight) - pull * self.weights
        d_steps = -pull * self.steps
        value = float((weight * np.where(good > 0, emit[:, 1], 0)).sum())
        starts = chains.steps[0] if chains.steps else np.zeros(0, dtype=int)
        value -= float((weight[starts] * total[starts]).sum())
        for k in range(1, len(chains.steps)):
            here = chains.steps[k]
            came = chains.steps[k - 1][: len(here)]
            pair = forward[came][:, :, None] + self.steps + (emit[here] + backward[here])[:, None, :]
            pair = np.exp(pair - total[here][:, None, None])
            seen = np.zeros_like(pair)
            seen[np.arange(len(here)), good[came].astype(int), good[here].astype(int)] = 1
            d_steps = d_steps + ((seen - pair) * weight[here][:, None, None]).sum(axis=0)
            value += float((weight[here] * self.steps[good[came].astype(int), good[here].astype(int)]).sum())
        value -= pull / 2 * float((self.weights**2).sum() + (self.steps**2).sum())
        return value, d_weights, d_steps

    def documents(self, x, size, first, chains) -> np.ndarray:
        """Length-weighted mean of the marginals of each text's lines."""
        p = self.marginals(x, chains)
        return np.add.reduceat(p * size, first[:-1]) / np.add.reduceat(size, first[:-1])

    def score(self, quality: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * quality + self.offset, -50, 50)))


def _ascend(field: Field, x, good, weight, chains, pull: float, rounds: int) -> None:
    """Adam on the whole sample; the objective is concave for fixed labels."""
    parts = [field.weights, field.steps]
    moment = [np.zeros_like(a) for a in parts]
    spread = [np.zeros_like(a) for a in parts]
    scale = weight.sum()
    for t in range(1, rounds + 1):
        _, *slopes = field.gradient(x, good, weight, chains, pull)
        for a, m, s, g in zip(parts, moment, spread, slopes, strict=True):
            g = g / scale
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            a += 0.15 / (1 + t / rounds) * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-8)


def _calibrate(field: Field, quality: np.ndarray, label: np.ndarray) -> None:
    """Logistic curve by Newton's method, with a small pull that keeps separable data finite."""
    z = np.column_stack([quality, np.ones(len(quality))])
    b = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -50, 50)))
        slope = z.T @ (label - p) - 1e-2 * b
        curve = (z * (p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(2)
        b = b + np.linalg.solve(curve, slope)
    field.slope, field.offset = float(b[0]), float(b[1])


def fit_field(parts: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray, pull: float = 1.0, rounds: int = 80, lessons: int = 2) -> Field:
    """Field and curve from the (features, lengths) of the lines of labelled texts."""
    if not len(label) or label.all() or not label.any():
        width = line_features([b""])[0].shape[1] * 3 + 3
        return Field(np.zeros(width), np.zeros((2, 2)), 0.0, 0.0)
    first = np.cumsum([0, *[len(own) for own, _ in parts]])
    x = with_neighbours(np.concatenate([own for own, _ in parts]), first)
    size = np.concatenate([s for _, s in parts])
    chains = Chains.of(first)
    lines = np.diff(first)
    of_document = np.repeat(label.astype(float), lines)
    # Both labels weigh the same, and a long document as much as a short one of its label.
    weight = np.repeat(1 / lines, lines) * np.where(of_document > 0, 0.5 / label.mean(), 0.5 / (1 - label.mean()))
    weight *= len(weight) / weight.sum()
    field = Field(np.zeros(x.shape[1]), np.zeros((2, 2)))
    good = of_document.copy()
    for lesson in range(lessons):
        if lesson:
            p = field.marginals(x, chains)
            worst = np.repeat(np.minimum.reduceat(p, first[:-1]), lines)
            good = np.where((of_document == 0) & (p > 0.5) & (p > worst), 1.0, of_document)
        _ascend(field, x, good, weight, chains, pull, rounds)
    _calibrate(field, field.documents(x, size, first, chains), label.astype(float))
    return field


# ---- tables ---------------------------------------------------------------------------


def held_out() -> Column:
    """True for the documents whose labels are never learned."""
    return crc32_of_id() % 3 == 1


def _line_udf():
    """The features of a text's lines as float32 bytes, so that texts needn't leave the executors."""

    def featured(texts: pd.Series) -> pd.DataFrame:
        out = []
        for _, group in chunks(texts.tolist()):
            own, size, first = line_features(group)
            own, size = own.astype("<f4"), size.astype("<f4")
            out += [(own[i:j].tobytes(), size[i:j].tobytes()) for i, j in zip(first[:-1], first[1:], strict=True)]
        return pd.DataFrame(out, columns=["own", "size"])

    return text_udf(featured, "own binary, size binary")


def fit_quality(docs: DataFrame, labels: DataFrame, fit_documents: int = 2048, fit_lines: int = 300, seed: int = 11) -> Field:
    """Fit on at most ``fit_documents`` labelled rows outside the held-out third, in hash order."""
    small_batches(docs.sparkSession)
    named = quality_labels(labels).where(~held_out())
    lines = F.length(F.regexp_replace(F.coalesce("text", F.lit("")), "[^\n]", "")) + 1
    here = docs.select("doc_id", "text").where(lines <= fit_lines)
    ids = first_by_hash(named.join(docs.select("doc_id").distinct(), "doc_id", "left_semi"), fit_documents, seed)
    chosen = here.join(F.broadcast(ids.join(named, "doc_id")), "doc_id")
    rows = chosen.select("doc_id", "quality", _line_udf()("text").alias("f")).select("doc_id", "quality", "f.*").toPandas()
    rows = rows.sort_values(["doc_id", "own"]).drop_duplicates("doc_id")
    width = line_features([b""])[0].shape[1]
    parts = [
        (np.frombuffer(own, "<f4").reshape(-1, width).astype(float), np.frombuffer(size, "<f4").astype(float))
        for own, size in zip(rows["own"], rows["size"], strict=True)
    ]
    return fit_field(parts, rows["quality"].to_numpy())


def grade(field: Field) -> Column:
    """A struct with score, predicted and the lines found bad, for the column ``text``."""
    columns = ["score", "predicted", "n_lines", "bad_lines"]

    def graded(texts: pd.Series) -> pd.DataFrame:
        out = []
        for _, group in chunks(texts.tolist()):
            own, size, first = line_features(group)
            p = field.marginals(with_neighbours(own, first), Chains.of(first))
            score = field.score(np.add.reduceat(p * size, first[:-1]) / np.add.reduceat(size, first[:-1]))
            bad = np.add.reduceat(p < 0.5, first[:-1], dtype=np.int64)
            out.append(pd.DataFrame(dict(zip(columns, (score, (score >= 0.5).astype(np.int32), np.diff(first), bad), strict=True))))
        return pd.concat(out, ignore_index=True) if out else pd.DataFrame(columns=columns)

    return text_udf(graded, SCORE)("text")


def score_documents(docs: DataFrame, labels: DataFrame, **parameters) -> DataFrame:
    """doc_id, held_out, score, predicted, n_lines, bad_lines for every row of ``docs``."""
    field = fit_quality(docs, labels, **parameters)
    return docs.select("doc_id", held_out().alias("held_out"), grade(field).alias("g")).select("doc_id", "held_out", "g.*")


def keep_good(docs: DataFrame, labels: DataFrame, **parameters) -> DataFrame:
    """The rows of ``docs`` predicted good, with all their columns."""
    return rows_where(docs, grade(fit_quality(docs, labels, **parameters)), lambda v: v["predicted"] == 1)
