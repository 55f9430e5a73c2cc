"""Long words and runs of spaces are merged in time that grows with their length."""

import random
import time

import public_tokenizers
import pytest
import sentencepiece

from ledgerline.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    return pieces.pieces(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_runs_of_spaces_equal_the_library(both):
    one, library = both
    assert one.block > 1
    for n in [*range(1, 330), 999, 5000]:
        for tail in ("", "a", "the x", "1", "\n"):
            text = " " * n + tail
            assert one.encode([text])[0].tolist() == library.encode(text)


def test_long_words_equal_the_library(both):
    one, library = both
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choices(["  ", "   ", " ", "a", "the", "ing", "x", "\n", "é", "12"], k=rng.randint(20, 150)))
        assert one.encode([text])[0].tolist() == library.encode(text)
        word = "▁▁" + text.replace(" ", "▁")
        assert one._merged_by_heap(word) == one._merged_by_heap(word) and "".join(one.merged(word)) == word


def test_heap_and_plain_merging_agree(both, monkeypatch):
    one, _ = both
    rng = random.Random(8)
    for _ in range(300):
        word = "".join(rng.choices("▁▁▁abtheing", k=rng.randint(2, 60)))
        quick = one._merged_by_heap(word)
        with monkeypatch.context() as patch:
            patch.setattr(pieces, "SHORT", 1000)
            assert one.merged(word) == quick


def test_a_megabyte_of_spaces(both):
    one, library = both
    text = " " * 1_000_000 + "x"
    start = time.process_time()
    ids = one.encode([text])[0].tolist()
    assert time.process_time() - start < 1
    assert ids == library.encode(text)
