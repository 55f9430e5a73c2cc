"""Token counts of texts that are edited, without encoding whole texts again.

A text has a segment tree over its units (runs of pre-tokens between places that no pre-token
reaches across). Leaves hold a unit's characters and tokens, inner nodes their sums, so the leaf of
a character is found from the root. An edit touches the leaves it overlaps, widened to boundaries
whose surroundings the edit leaves as they were: a boundary depends on the character before it and
the two after it. Only this region is cut and encoded anew, and only the sums above its leaves are
updated; the first leaf takes the new units, the others are left empty.

An edit is (start, removed, inserted): at character ``start`` of the text as it is by then, so
many characters go and a string comes in. Edits apply in order.

Defined results: null texts and null insertions count as empty, a null list as no edits; starts and
lengths beyond the text are cut to it, negative ones count as 0. A text in which one of the
tokenizer's special strings occurs, before or after edits, is encoded whole. Repeated rows and null
doc_ids keep their rows. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.frames import small_batches
from ledgerline.llm.subwords import CHUNK_BYTES, REMEMBERED, Encoder, encoder, unit_starts
from ledgerline.llm.words import chunks

EDITS = "array<struct<start:long,removed:long,inserted:string>>"


def units_of(group: list[bytes], one: Encoder) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(characters and tokens of the units of some texts, in two arrays; where each text's units begin)."""
    if one.units > REMEMBERED:
        one.forget()
    data = np.frombuffer(b"".join([t + b"\0" for t in group]), dtype=np.uint8)
    begins = np.cumsum([0, *[len(t) + 1 for t in group]])
    starts = unit_starts(data, begins)
    numbers = one.numbers(data, starts)
    tokens = one.length[numbers].astype(np.int64)
    chars = np.add.reduceat((data & 0xC0) != 0x80, starts, dtype=np.int64)
    return chars, tokens, np.searchsorted(starts, begins)


class Tree:
    """Sums of characters and tokens over the units of a text; level 0 holds the leaves."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray) -> None:
        leaves = np.zeros((2, 1 << max(len(chars) - 1, 0).bit_length()), dtype=np.int64)
        leaves[0, : len(chars)], leaves[1, : len(chars)] = chars, tokens
        self.levels = [leaves]
        while self.levels[-1].shape[1] > 1:
            below = self.levels[-1]
            self.levels.append(below[:, ::2] + below[:, 1::2])

    def chars(self) -> int:
        return int(self.levels[-1][0, 0])

    def tokens(self) -> int:
        return int(self.levels[-1][1, 0])

    def find(self, at: int) -> tuple[int, int]:
        """(leaf that holds character ``at``, characters before the leaf)."""
        node, before = 0, 0
        for level in reversed(self.levels[:-1]):
            node *= 2
            left = int(level[0, node])
            if at - before >= left:
                before += left
                node += 1
        return node, before

    def put(self, first: int, last: int, chars: int, tokens: int) -> None:
        """All units of the leaves ``first`` to ``last`` in the first of them; only the sums above change."""
        leaves = self.levels[0]
        leaves[:, first : last + 1] = 0
        leaves[0, first], leaves[1, first] = chars, tokens
        for below, above in zip(self.levels, self.levels[1:], strict=False):
            first, last = first // 2, last // 2
            above[:, first : last + 1] = below[:, 2 * first : 2 * last + 2 : 2] + below[:, 2 * first + 1 : 2 * last + 2 : 2]


class Edited:
    """A text under edits, with its tree."""

    def __init__(self, text: str, tree: Tree) -> None:
        self.text, self.tree, self.encoded_chars = text, tree, 0
        self.leaves = (0, 0)

    def edit(self, start: int, removed: int, inserted: str) -> str:
        """Apply an edit; the region whose tokens must be counted anew, before ``recount``."""
        total = len(self.text)
        start = min(max(start, 0), total)
        end = min(start + max(removed, 0), total)
        first, begin, last, stop = 0, 0, 0, 0
        if total:
            first, begin = self.tree.find(max(start - 2, 0))
            last, last_begin = self.tree.find(min(end + 1, total - 1))
            stop = last_begin + int(self.tree.levels[0][0, last])
        region = self.text[begin:start] + inserted + self.text[end:stop]
        self.text = self.text[:start] + inserted + self.text[end:]
        self.leaves = (first, last)
        self.encoded_chars += len(region)
        return region

    def recount(self, chars: int, tokens: int) -> None:
        self.tree.put(*self.leaves, chars, tokens)


def count_group(texts: list[str], edits: list[list], one: Encoder) -> list[tuple[int, int, int, int]]:
    """(tokens before, tokens after, characters after, characters encoded for the edits) of some texts.

    The texts' first encoding, and then that of the regions touched by every text's first edit, by
    every second one and so on, are calls over many texts.
    """
    special = [s.decode() for s in one.special]

    def whole(text: str) -> int:
        return len(one.encode([text.encode()])[0])

    edited: list[Edited] = []
    for start, group in chunks(texts, CHUNK_BYTES):
        chars, tokens, at = units_of(group, one)
        for i in range(len(group)):
            own = slice(at[i], at[i + 1] - 1)
            edited.append(Edited(texts[start + i], Tree(chars[own], tokens[own])))
    marked = [any(s in t for s in special) for t in texts]
    before = [whole(t) if m else e.tree.tokens() for t, m, e in zip(texts, marked, edited, strict=True)]
    for k in range(max(map(len, edits), default=0)):
        turn = [(one_text, some[k]) for one_text, some in zip(edited, edits, strict=True) if k < len(some)]
        regions = [t.edit(int(e["start"] or 0), int(e["removed"] or 0), e["inserted"] or "") for t, e in turn]
        for start, group in chunks(regions, CHUNK_BYTES):
            _, tokens, at = units_of(group, one)
            run = np.concatenate(([0], np.cumsum(tokens)))
            for i, n in enumerate((run[at[1:] - 1] - run[at[:-1]]).tolist(), start=start):
                turn[i][0].recount(len(regions[i]), n)
    out = []
    for was_marked, n, e in zip(marked, before, edited, strict=True):
        if was_marked or any(s in e.text for s in special):
            out.append((n, whole(e.text), len(e.text), len(e.text) if e.encoded_chars else 0))
        else:
            out.append((n, e.tree.tokens(), len(e.text), e.encoded_chars))
    return out


def count_edited(text: str | None, edits, one: Encoder) -> tuple[int, int, int, int]:
    """``count_group`` for one text; null text and edits as empty."""
    return count_group([text or ""], [[] if edits is None else list(edits)], one)[0]


COUNTS = "doc_id long, n_edits int, tokens_before long, tokens_after long, chars_after long, encoded_chars long"


def count_documents(docs: DataFrame, tokenizer: str) -> DataFrame:
    """A row of ``COUNTS`` for every row of ``docs`` (doc_id, text, edits)."""
    small_batches(docs.sparkSession)

    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        one = encoder(tokenizer)
        for batch in batches:
            edits = [[] if e is None else list(e) for e in batch["edits"]]
            rows = count_group([t or "" for t in batch["text"]], edits, one)
            out = pd.DataFrame(rows, columns=["tokens_before", "tokens_after", "chars_after", "encoded_chars"], dtype="int64")
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64"))
            out.insert(1, "n_edits", [len(e) for e in edits])
            yield out

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("edits").cast(EDITS).alias("edits"))
    return rows.mapInPandas(over, COUNTS)


def drawn_edits(docs: DataFrame, n: int = 3, longest: int = 80) -> DataFrame:
    """``docs`` with ``n`` edits each, drawn by a hash: a passage of the text replaces another one."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    size = F.length(text)

    def draw(k: int, what: str, below) -> Column:
        return F.pmod(F.xxhash64(F.lit(what), F.lit(k), "doc_id"), F.greatest(below, F.lit(1)).cast("long"))

    edits = [
        F.struct(
            draw(k, "start", size).alias("start"),
            draw(k, "removed", F.lit(longest)).alias("removed"),
            F.substr(text, (draw(k, "from", size) + 1).cast("int"), draw(k, "length", F.lit(longest)).cast("int")).alias("inserted"),
        )
        for k in range(n)
    ]
    return docs.select("doc_id", "text", F.array(*edits).alias("edits"))
