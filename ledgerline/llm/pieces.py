"""Encoding and decoding with a SentencePiece model by a shared-prefix Viterbi pass.

Spaces become marks, one mark is put in front, and a text falls into marked words, across which no
piece reaches. The distinct words of some texts are sorted and walked as a trie depth first: the
forward state of each prefix is kept on a stack, and the next word starts from the longest prefix
it shares with the one before, so each trie node is solved once.

The model files at hand hold merge ranks (BPE): the library's segmentation is not the path with
the best sum of scores. It is, however, the one path all of whose neighbouring pieces would stay
apart if they were encoded alone, and every prefix has one such path. The forward state of a prefix
is therefore its last piece on that path, in place of a score and a back pointer, and a
step is allowed where the pair of pieces stays apart. Words with a run of marks, whose pieces share one
rank, are merged directly, with a heap of possible unions and whole blocks of marks at once, so the work
grows with a run's length and not with its square. The ids equal the library's own.

Defined results: null counts as empty; an empty text has no ids. Characters without a piece become
their UTF-8 bytes. A mark character in the text itself decodes as a space, as in the library.
Repeated rows and null doc_ids keep their rows. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import cache
from heapq import heapify, heappop, heappush
from os.path import commonprefix

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.frames import small_batches

MARK = "▁"
#: Longest word whose neighbours are all looked at for every merge.
SHORT = 24
#: Words whose ids a worker remembers before it forgets all.
REMEMBERED = 400_000
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class Pieces:
    """The pieces of a model file, and the ids of words."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.bytes = [0] * 256
        self.piece = [model.id_to_piece(i) for i in range(n)]
        self.id: dict[str, int] = {}
        self.raw: dict[int, bytes] = {}
        for i, piece in enumerate(self.piece):
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.raw[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.id[piece] = i
        self.score = {piece: model.get_score(i) for piece, i in self.id.items()}
        self.text = [
            self.raw.get(i, b"" if model.is_control(i) else p.replace(MARK, " ").encode()) for i, p in enumerate(self.piece)
        ]
        # A long run of marks falls into blocks of the longest piece of marks, if the model merges them so.
        self.block = max((len(p) for p in self.id if not p.strip(MARK)), default=0)
        in_blocks = all(
            self._merged_by_heap(MARK * n) == [MARK * self.block] * (n // self.block - 4) + self._merged_by_heap(MARK * (n % self.block + 4 * self.block))
            for n in range(8 * self.block, 10 * self.block)
        )
        self.block = self.block if in_blocks else 0
        # Pieces that stand alone, by their characters from last to first; "" holds a node's piece.
        self.endings: dict = {}
        for piece in self.id:
            if self.merged(piece) == [piece]:
                node = self.endings
                for c in reversed(piece):
                    node = node.setdefault(c, {})
                node[""] = piece
        self.apart: dict[tuple[str, str], bool] = {}
        self.known: dict[str, bytes] = {}

    # ---- merging directly

    def merged(self, word: str) -> list[str]:
        """Merge the neighbours with the best-ranked union, the leftmost first, until none is a piece."""
        if len(word) > SHORT:
            run = len(word) - len(word.lstrip(MARK))
            blocks = (run - 4 * self.block) // self.block if self.block and run >= 8 * self.block else 0
            return [MARK * self.block] * blocks + self._merged_by_heap(word[blocks * self.block :])
        parts = list(word)
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                score = self.score.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _merged_by_heap(self, word: str) -> list[str]:
        """The same for long words: possible unions wait in a heap, those that are no longer neighbours are passed over."""
        parts: list[str] = list(word)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        score = self.score
        unions = [(-score[u], k, u) for k in range(len(parts) - 1) if (u := parts[k] + parts[k + 1]) in score]
        heapify(unions)
        while unions:
            _, k, union = heappop(unions)
            j = after[k]
            # A part that went into another is empty; one that grew spells another union.
            if not parts[k] or j == len(parts) or parts[k] + parts[j] != union:
                continue
            parts[k], parts[j] = union, ""
            after[k] = j = after[j]
            if j < len(parts):
                before[j] = k
                if (u := union + parts[j]) in score:
                    heappush(unions, (-score[u], k, u))
            i = before[k]
            if i >= 0 and (u := parts[i] + union) in score:
                heappush(unions, (-score[u], i, u))
        return [p for p in parts if p]

    def stays_apart(self, left: str, right: str) -> bool:
        found = self.apart.get((left, right))
        if found is None:
            found = self.apart[left, right] = self.merged(left + right) == [left, right]
        return found

    # ---- the trie walk

    def step(self, word: str, n: int, last: list[str]) -> str:
        """The last piece of the first n characters, given those of shorter prefixes."""
        node, found = self.endings, []
        for k in range(n - 1, -1, -1):
            node = node.get(word[k])
            if node is None:
                break
            if "" in node:
                found.append((k, node[""]))
        for k, piece in reversed(found):
            if k == 0:
                return piece
            before = last[k]
            allowed = self.apart.get((before, piece))
            if allowed or (allowed is None and self.stays_apart(before, piece)):
                return piece
        return word[n - 1]

    def walk(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """Ids of sorted distinct words; the stack holds the states of the current word's prefixes."""
        stack, before = [""], ""
        for word in words:
            shared = len(commonprefix((before, word)))
            del stack[shared + 1 :]
            for n in range(shared + 1, len(word) + 1):
                stack.append(self.step(word, n, stack))
            yield word, self.ids_of(self.path(word, stack))
            before = word

    @staticmethod
    def path(word: str, last: list[str]) -> list[str]:
        parts, n = [], len(word)
        while n:
            parts.append(last[n])
            n -= len(last[n])
        return parts[::-1]

    def ids_of(self, parts: list[str]) -> bytes:
        out: list[int] = []
        for part in parts:
            i = self.id.get(part)
            out += [i] if i is not None else [self.bytes[b] for b in part.encode()]
        return array("i", out).tobytes()

    # ---- texts

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        words = [_WORD.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        if len(self.known) > REMEMBERED:
            self.known = {}
        if len(self.apart) > REMEMBERED:
            self.apart = {}
        new = {w for own in words for w in own} - self.known.keys()
        runs = {w for w in new if w.startswith(MARK * 2)}
        self.known.update((w, self.ids_of(self.merged(w))) for w in runs)
        self.known.update(self.walk(sorted(new - runs)))
        known = self.known
        return [np.frombuffer(b"".join([known[w] for w in own]), dtype=np.int32) for own in words]

    def decode(self, ids: np.ndarray) -> str:
        """The text that ``encode`` turned into these ids."""
        data = b"".join(map(self.text.__getitem__, ids.tolist()))
        return data[1:].decode(errors="replace") if data.startswith(b" ") else data.decode(errors="replace")


@cache
def pieces(path: str) -> Pieces:
    return Pieces(path)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) for every row of ``docs``."""
    small_batches(docs.sparkSession)

    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "ids": pieces(path).encode(batch["text"].tolist())})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(over, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) for every row of (doc_id, ids)."""
    small_batches(encoded.sparkSession)

    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "text": [pieces(path).decode(i) for i in batch["ids"]]})

    return encoded.select("doc_id", "ids").mapInPandas(over, "doc_id long, text string")


DIGEST = "doc_id long, n_pieces long, ids_crc32 long, decoded_chars long, round_trip boolean"


def digest_documents(docs: DataFrame, path: str) -> DataFrame:
    """Encodes and decodes every row of ``docs``; what came out as sizes, a checksum and a comparison."""
    small_batches(docs.sparkSession)

    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            ids = pieces(path).encode(texts)
            back = [pieces(path).decode(i) for i in ids]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].astype("Int64"),
                    "n_pieces": [len(i) for i in ids],
                    "ids_crc32": [zlib.crc32(i.astype("<u4").tobytes()) for i in ids],
                    "decoded_chars": [len(b) for b in back],
                    "round_trip": [b == (t or "") for b, t in zip(back, texts, strict=True)],
                }
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(over, DIGEST)
