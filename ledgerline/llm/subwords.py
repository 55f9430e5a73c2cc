"""Subword ids of whole texts from a byte-level BPE file of the ``tokenizers`` library.

The file's pre-tokens never reach across certain places: before a single space between visible
characters, around a single line feed between visible characters, and between a letter and an
ASCII punctuation mark. Texts are cut at these places into units, equal units are encoded once,
and a text's ids are its units' ids joined. Only ASCII and Latin-1 letters are used to find the
places, other characters just make longer units; a text that holds one of the file's special
strings is encoded as it is.
"""

from __future__ import annotations

import os
from functools import cache

import numpy as np

from ledgerline.llm.words import chunks, span_hashes

#: Slots for remembered units, and the number of remembered units after which all are forgotten.
SLOTS = 1 << 21
REMEMBERED = 1_500_000
#: New units that are encoded as one text, where they may lie side by side.
JOINED = 64
CHUNK_BYTES = 1 << 20
BREAK = 0  # a byte between texts

_LETTER = np.zeros(256, dtype=bool)
_LETTER[ord("A") : ord("Z") + 1] = _LETTER[ord("a") : ord("z") + 1] = True
_VISIBLE = np.zeros(256, dtype=bool)
_VISIBLE[0x21:0x7F] = True
_MARK = _VISIBLE & ~_LETTER
_MARK[ord("0") : ord("9") + 1] = False
_LATIN = 0xC3  # first byte of U+00C0 to U+00FF, all letters but the signs for times and division


def unit_starts(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where units begin, for texts that end with ``BREAK``; each text and each break begins one."""
    ends_visible, ends_letter = _VISIBLE[data], _LETTER[data]
    second = np.zeros(len(data), dtype=bool)
    second[1:] = data[:-1] == _LATIN
    ends_visible |= second
    ends_letter |= second & (data != 0x97) & (data != 0xB7)
    begins_visible = _VISIBLE[data] | (data == _LATIN)
    between = np.zeros(len(data), dtype=bool)
    between[1:-1] = ends_visible[:-2] & begins_visible[2:]
    feed = between & (data == ord("\n"))
    start = between & (data == ord(" "))
    start |= feed
    start[1:] |= feed[:-1]
    start[1:] |= _MARK[data[1:]] & ends_letter[:-1]
    start[begins[:-1]] = True
    start[begins[1:] - 1] = True
    return np.flatnonzero(start)


class Encoder:
    """Encodes texts, remembering units; memory is bounded whatever the texts hold."""

    #: How many bytes each id stands for, where units can be told apart by that.
    piece_bytes: np.ndarray | None = None

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        # A piece of a byte-level file has a character for each byte.
        self.piece_bytes = np.zeros(self.tokenizer.get_vocab_size(), dtype=np.int64)
        for piece, number in self.tokenizer.get_vocab().items():
            self.piece_bytes[number] = len(piece)
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(SLOTS, dtype=np.uint64)
        self.unit_of = np.zeros(SLOTS, dtype=np.int32)
        self.ids = np.zeros(1 << 16, dtype=np.uint32)
        self.at = np.zeros(1 << 16, dtype=np.int64)
        self.length = np.zeros(1 << 16, dtype=np.int32)
        self.units = self.used = 0

    def _apart(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, how many each has)."""
        found = [np.array(e.ids, dtype=np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate([np.zeros(0, dtype=np.uint32), *found]), np.array([len(f) for f in found], dtype=np.int64)

    def _encoded(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all units, how many each has).

        Units that begin with a space before a visible character and end with a visible one are cut
        from each other where they lie side by side, so many are encoded as one text: a text of its
        own costs a unit more than its ids do.
        """
        if self.piece_bytes is None or any(b" " in s for s in self.special):
            return self._apart(units)
        alone = [not (len(u) > 1 and u[0] == " " and " " < u[1] < "\x7f" and " " < u[-1] < "\x7f") for u in units]
        order, n = np.argsort(alone, kind="stable"), len(units) - sum(alone)
        placed = [units[k] for k in order.tolist()]
        flat, _ = self._apart(["".join(placed[j : min(j + JOINED, n)]) for j in range(0, n, JOINED)] + placed[n:])
        ends = np.searchsorted(np.cumsum(self.piece_bytes[flat]), np.cumsum([len(u.encode()) for u in placed])) + 1
        first, counts = np.zeros_like(ends), np.zeros_like(ends)
        counts[order] = np.diff(ends, prepend=0)
        first[order] = ends - counts[order]
        return flat[np.repeat(first - np.cumsum(counts) + counts, counts) + np.arange(len(flat))], counts

    def _add(self, units: list[str]) -> np.ndarray:
        """Numbers of newly encoded units."""
        flat, lengths = self._encoded(units)
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.units + len(lengths) > len(self.at):
            self.at = np.concatenate([self.at, np.zeros_like(self.at)])
            self.length = np.concatenate([self.length, np.zeros_like(self.length)])
        numbers = np.arange(self.units, self.units + len(lengths))
        self.ids[self.used : self.used + len(flat)] = flat
        self.at[numbers] = self.used + np.cumsum(lengths) - lengths
        self.length[numbers] = lengths
        self.used += len(flat)
        self.units += len(lengths)
        return numbers

    def numbers(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The number of each unit of ``data``; valid until the next call."""
        hashes = span_hashes(data, starts)
        slots = (hashes >> np.uint64(64 - 21)).astype(np.int64)
        numbers = self.unit_of[slots].astype(np.int64)
        missed = np.flatnonzero(self.keys[slots] != hashes)
        if len(missed):
            new, first, back = np.unique(hashes[missed], return_index=True, return_inverse=True)
            ends = np.append(starts[1:], len(data))
            raw = data.tobytes()
            where = missed[first]
            added = self._add([raw[i:j].decode() for i, j in zip(starts[where].tolist(), ends[where].tolist(), strict=True)])
            numbers[missed] = added[back]
            slot = (new >> np.uint64(64 - 21)).astype(np.int64)
            self.keys[slot], self.unit_of[slot] = new, added
        return numbers

    def encode(self, group: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text's ids begin and the last end)."""
        joined = b"\0".join(group)
        if not any(s in joined for s in self.special):
            return self._encode_plain(group)
        plain = [not any(s in t for s in self.special) for t in group]
        ids, first = self._encode_plain([t if p else b"" for t, p in zip(group, plain, strict=True)])
        parts = [ids[i:j] for i, j in zip(first[:-1], first[1:], strict=True)]
        for k, p in enumerate(plain):
            if not p:
                parts[k] = np.array(self.tokenizer.encode(group[k].decode(), add_special_tokens=False).ids, dtype=np.uint32)
        return np.concatenate(parts), np.cumsum([0, *[len(p) for p in parts]])

    def _encode_plain(self, group: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        data = np.frombuffer(b"".join([t + b"\0" for t in group]), dtype=np.uint8)
        return self.encode_data(data, np.cumsum([0, *[len(t) + 1 for t in group]]))

    def encode_data(self, data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts without special strings that lie in one array, each ended by ``BREAK``."""
        if self.units > REMEMBERED:
            self.forget()
        starts = unit_starts(data, begins)
        numbers = self.numbers(data, starts)
        lengths = self.length[numbers].astype(np.int64)
        lengths[np.searchsorted(starts, begins[1:] - 1)] = 0
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        source = np.repeat(self.at[numbers] - (ends - lengths), lengths) + np.arange(total)
        first = np.append(ends - lengths, total)[np.append(np.searchsorted(starts, begins[:-1]), len(starts))]
        return self.ids[source], first


@cache
def encoder(path: str) -> Encoder:
    """One encoder for each worker process and file."""
    return Encoder(path)


def encoded(texts: list[str | None], path: str):
    """The ids of each text in turn; null as empty."""
    one = encoder(path)
    for _, group in chunks(texts, CHUNK_BYTES):
        ids, first = one.encode(group)
        for i, j in zip(first[:-1], first[1:], strict=True):
            yield ids[i:j]
