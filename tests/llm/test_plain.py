"""Operators without Spark: against other libraries, brute force and round trips."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ledgerline.llm import chat, edit_counts, lm, near_dups, packing, pieces, quality, rules, subwords, top_k
from ledgerline.llm.words import words_of, windows

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALPHABET = [*"aB1eth \n\t.,'!é×ß日 ́😀|%#\\:/<>\x00\x1c　", "  ", "'s", "'ll", " \n", "<|endoftext|>", "</turn>", "### ", "the ", "ing"]


def texts(n: int, longest: int = 40, seed: int = 1) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, longest))) for _ in range(n)]


def test_words_are_those_of_the_pattern():
    some = ["", " ", "Ab ab\tAB\x0bc\x0cd\re", "x", " a ", *texts(300)]
    words = words_of([t.encode() for t in some], fold_case=False)
    seen: dict[int, str] = {}
    for i, t in enumerate(some):
        expected = WORD.findall(t)
        assert len(words.of(i)) == len(expected)
        for h, w in zip(words.of(i).tolist(), expected, strict=True):
            assert seen.setdefault(h, w) == w
    assert len(set(seen.values())) == len(seen)
    folded = words_of(["Ab É".encode(), "aB é".encode()], fold_case=True)
    assert folded.of(0)[0] == folded.of(1)[0] and folded.of(0)[1] != folded.of(1)[1]


def test_windows_depend_on_order_and_take_short_sequences_whole():
    words = words_of([b"a b c d e f"], fold_case=True).of(0)
    assert len(windows(words, 5)) == 2 and len(windows(words[:3], 5)) == 1 and len(windows(words[:0], 5)) == 0
    assert windows(words[:2], 2)[0] != windows(words[:2][::-1], 2)[0]


def test_subword_ids_equal_the_library():
    some = ["", "don't, 's ,'s", "é, ü. × ÷! a×b", "a\n\nb\nc \nd\n e", "x<|endoftext|> b", *texts(1500)]
    whole = Tokenizer.from_file(BYTE_BPE)
    assert [i.tolist() for i in subwords.encoded(some, BYTE_BPE)] == [whole.encode(t, add_special_tokens=False).ids for t in some]


def test_piece_ids_equal_the_library_and_decode():
    rng = random.Random(5)
    some = ["", *texts(1500), *["".join(rng.choice("abcdeghilnorstu") for _ in range(rng.randint(1, 20))) for _ in range(1500)]]
    model = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    got = pieces.pieces(PIECE_BPE).encode(some)
    assert [i.tolist() for i in got] == model.encode(some, num_threads=1)
    assert [pieces.pieces(PIECE_BPE).decode(i) for i in got] == some


def test_edited_counts_equal_a_full_count():
    rng = random.Random(9)
    one, whole = subwords.encoder(BYTE_BPE), Tokenizer.from_file(BYTE_BPE)
    pool = texts(300, 60, seed=4)
    for text in pool:
        edits, after = [], text
        for _ in range(rng.randint(0, 5)):
            e = {"start": rng.randint(-1, len(after) + 3), "removed": rng.randint(-1, 30), "inserted": rng.choice([None, *pool[:20]])}
            edits.append(e)
            start = min(max(e["start"], 0), len(after))
            after = after[:start] + (e["inserted"] or "") + after[min(start + max(e["removed"], 0), len(after)) :]
        got = edit_counts.count_edited(text, edits, one)
        expected = [len(whole.encode(t, add_special_tokens=False).ids) for t in (text, after)]
        assert list(got[:3]) == [*expected, len(after)]
    assert edit_counts.count_edited(None, None, one) == (0, 0, 0, 0)


def test_an_edit_encodes_little():
    text = "One two three, four five. " * 2000
    before, after, chars, encoded = edit_counts.count_edited(text, [{"start": 30_000, "removed": 4, "inserted": "x y"}], subwords.encoder(BYTE_BPE))
    assert chars == len(text) - 1 and encoded < 60


@pytest.mark.parametrize("n, expected", [(1, [(0, 1)]), (8, [(0, 8)]), (9, [(0, 1), (1, 8)]), (20, [(0, 4), (4, 8), (12, 8)])])
def test_only_the_first_piece_is_short(n, expected):
    assert packing.cuts(n, 8) == expected


def fewest(items: list[int], capacity: int) -> int:
    best = len(items)

    def place(i: int, free: list[int]) -> None:
        nonlocal best
        if len(free) >= best:
            return
        if i == len(items):
            best = len(free)
            return
        for k in {f: k for k, f in enumerate(free) if f >= items[i]}.values():
            place(i + 1, [*free[:k], free[k] - items[i], *free[k + 1 :]])
        place(i + 1, [*free, capacity - items[i]])

    place(0, [])
    return best


def test_reduction_keeps_an_optimum_and_packing_is_valid():
    rng = random.Random(3)
    for _ in range(300):
        capacity = rng.randint(5, 30)
        items = sorted((rng.randint(1, capacity) for _ in range(rng.randint(0, 8))), reverse=True)
        instance = packing.Instance(dict(Counter(items)), capacity)
        instance.reduce()
        rest = sorted((w for w, n in instance.left.items() for _ in range(n)), reverse=True)
        optimum = fewest(items, capacity)
        assert instance.sequences + fewest(rest, capacity) == optimum
        segments, sequences = packing.solve(dict(Counter(items)), capacity)
        assert sequences <= optimum + 1
        filled: dict[int, list] = {}
        for w, first, end, sequence, at in segments:
            for k in range(end - first):
                filled.setdefault(sequence + k, []).append((at, w))
        assert Counter(w for own in filled.values() for _, w in own) == Counter(items)
        for own in filled.values():
            ends = 0
            for at, w in sorted(own):
                assert at == ends
                ends += w
            assert ends <= capacity
        assert sorted(filled) == list(range(sequences))


def test_chat_text_reads_back():
    rng = random.Random(2)
    some = texts(400, 25, seed=8)
    for _ in range(300):
        turns = [(rng.choice(["user", "assistant", "", "a: b", *some[:9]]), rng.choice(some)) for _ in range(rng.randint(0, 5))]
        formatted, spans = chat.render(turns)
        assert chat.parse(formatted) == turns
        assert [chat.unescape(formatted[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]
        assert formatted.count(chat.CLOSE) == len(turns)


@pytest.mark.parametrize(
    "record, layout, turns",
    [
        ('{"prompt": "p", "response": "r"}', "prompt", [("user", "p"), ("assistant", "r")]),
        ('{"response": "r", "id": 3, "system": null, "prompt": "p"}', "prompt", [("user", "p"), ("assistant", "r")]),
        ('{"instruction": "i", "input": "x", "output": "o"}', "instruction", [("user", "i\n\nx"), ("assistant", "o")]),
        ('{"instruction": "i", "output": "o"}', "instruction", [("user", "i"), ("assistant", "o")]),
        ('{"conversations": [{"from": "human", "value": "h"}, {"value": 1, "from": "gpt"}]}', "shares", [("user", "h"), ("assistant", "1")]),
        ('{"messages": [{"role": "tool", "content": null}]}', "messages", [("tool", "")]),
        ('{"messages": []}', "messages", []),
        ('{"data": {"question": "q", "answer": {"text": "a"}}}', "nested", [("user", "q"), ("assistant", "a")]),
        ('{"prompt": "p", "chosen": "c", "rejected": "x"}', "preference", [("user", "p"), ("assistant", "c")]),
        ('{"question": "q"}', "unknown", None),
        ('{"messages": [{"role": "user", "content": "a"}, {"role": "user"}, 3]}', "unknown", None),
        ("[1]", "broken", None),
        ("{", "broken", None),
        (None, "broken", None),
    ],
)
def test_layouts(record, layout, turns):
    assert chat.canonical(record, chat.by_fingerprint(chat.LAYOUTS)) == (layout, turns)


def test_field_gradient_and_marginals():
    rng = np.random.default_rng(0)
    first = np.array([0, 3, 4, 9])
    x = rng.normal(size=(9, 4))
    good = (rng.random(9) > 0.5).astype(float)
    weight = np.repeat([0.5, 2.0, 1.0], np.diff(first))
    chains = quality.Chains.of(first)
    field = quality.Field(rng.normal(size=4), rng.normal(size=(2, 2)))
    _, weights, steps = field.gradient(x, good, weight, chains, 0.5)

    def value(w, s):
        return quality.Field(w, s).gradient(x, good, weight, chains, 0.5)[0]

    for k in range(4):
        e = np.eye(4)[k] * 1e-5
        assert weights[k] == pytest.approx((value(field.weights + e, field.steps) - value(field.weights - e, field.steps)) / 2e-5, abs=1e-5)
    e = np.array([[0, 1e-5], [0, 0]])
    assert steps[0, 1] == pytest.approx((value(field.weights, field.steps + e) - value(field.weights, field.steps - e)) / 2e-5, abs=1e-5)
    # Marginals by listing all labellings of the last text.
    own = x[4:]
    total = np.zeros(5)
    mass = 0.0
    for code in range(32):
        labels = [(code >> k) & 1 for k in range(5)]
        p = np.exp(sum(own[k] @ field.weights * labels[k] for k in range(5)) + sum(field.steps[a, b] for a, b in zip(labels, labels[1:], strict=False)))
        mass += p
        total += p * np.array(labels)
    assert field.marginals(x, chains)[4:] == pytest.approx(total / mass)


def test_repeated_words_by_brute_force():
    rng = random.Random(7)
    for _ in range(200):
        words = [rng.choice("ab") for _ in range(rng.randint(0, 40))]
        runs = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
        marked = {k + j for k, r in enumerate(runs) if runs.count(r) > 1 for j in range(8)}
        text = " ".join(words)
        assert rules.repeated_words(words_of([text.encode()], fold_case=False).of(0)) == len(marked)


def test_statistics_of_a_text():
    text = "A# b\n\nx y\n x y\nx y \nx y\n é%|"
    row = dict(zip(rules.COUNT_NAMES, rules.statistics([text, None, ""])[0], strict=True))
    assert (row["n_words"], row["n_symbols"], row["n_dup_lines"], row["word_chars"]) == (11, 3, 1, 14)
    assert not rules.statistics([None, ""]).any()


def test_forest_finds_the_odd_rows():
    rng = np.random.default_rng(1)
    x = np.vstack([np.zeros((300, 3)), rng.random((10, 3)) + 1])
    forest = rules.IsolationForest.grow(x, 50, 3, good=np.arange(310) < 300)
    forest.settle(x[:300], 0.0)
    assert (forest.scores(x[300:]) > forest.threshold).all() and (forest.scores(x[:300]) <= forest.threshold).all()
    unsettled = rules.IsolationForest.grow(x, 5, 3)
    unsettled.settle(x[:0], 0.0)
    assert unsettled.threshold == np.inf and unsettled.scores(x).max() <= 1
    assert (rules.IsolationForest.grow(x[:0], 5, 3).scores(x) <= 1).all() and len(rules.IsolationForest.empty(0).scores(x)) == len(x)


def test_links_within_and_across_blocks_connect_as_all_pairs_do():
    rng = np.random.default_rng(4)
    family = near_dups._hash_family(64)
    for case in range(20):
        base = rng.integers(0, 1 << 60, 120, dtype=np.uint64)
        sets = []
        for _ in range(14):
            own = base.copy()
            own[rng.integers(0, 120, rng.integers(0, 25))] = rng.integers(0, 1 << 60, 1)[0]
            sets.append(np.unique(own))
        ids, block = np.arange(14) * 3, np.arange(14) % (1 + case % 2)
        similar = {
            (i, j)
            for i in range(14)
            for j in range(i)
            if (block[i] != block[j] or case % 2 == 0) and 100 * len(np.intersect1d(sets[i], sets[j])) >= 85 * len(np.union1d(sets[i], sets[j]))
        }
        links = {(b // 3, a // 3) for a, b in near_dups.linked_pairs(ids, sets, block, 85, family)}
        assert links <= similar

        def parts(edges):
            root = list(range(14))
            for _ in range(14):
                for a, b in edges:
                    root[a] = root[b] = min(root[a], root[b])
            return root

        assert parts(links) == parts(similar)


def test_products_are_exact_at_every_size():
    for scale in (1, 2**20, 2**29):
        left, right = np.array([[3 * scale, -5 * scale]]), np.array([[7 * scale, scale], [scale, 2]])
        exact = [[sum(int(a) * int(b) for a, b in zip(x, y, strict=True)) for y in right.tolist()] for x in left.tolist()]
        assert top_k.products(left, right).tolist() == exact


def test_attention_scores_each_symbol_once_and_is_causal():
    rng = np.random.default_rng(0)
    counts = rng.integers(0, 5, (lm.TOPICS, lm.BEGIN + 1, lm.RARE + 1)).astype(float)
    topics = lm.topic_probabilities(counts)
    model = lm.Attention.begin(counts, 1)
    first = np.array([0, 40, 42, 200])
    reduced = rng.integers(0, lm.RARE + 1, 200)
    reduced[first[:-1]] = lm.BEGIN
    scores = lm.symbol_scores(model, topics, reduced, first)
    assert (scores[first[:-1]] == 0).all() and (np.delete(scores, first[:-1]) < 0).all()
    other = reduced.copy()
    other[150] = (other[150] + 1) % lm.RARE
    changed = np.flatnonzero(scores != lm.symbol_scores(model, topics, other, first))
    assert changed.min() >= 150 and changed.max() < 200
    # The probabilities of all symbols at a place add up to one.
    total = 0.0
    for symbol in range(lm.RARE + 1):
        other = reduced.copy()
        other[199] = symbol
        total += 10.0 ** lm.symbol_scores(model, topics, other, first)[199]
    assert total == pytest.approx(1, abs=1e-3)


def test_attention_gradient():
    rng = np.random.default_rng(0)
    counts = rng.integers(0, 5, (lm.TOPICS, lm.BEGIN + 1, lm.RARE + 1)).astype(float)
    topics = lm.topic_probabilities(counts).astype(float)
    model = lm.Attention.begin(counts, 1)
    flat = model.parameters().astype(float) + rng.normal(0, 0.2, len(model.parameters()))
    first = np.array([0, 40, 90])
    reduced = rng.integers(0, lm.RARE + 1, 90)
    reduced[first[:-1]] = lm.BEGIN

    def at(flat):
        exact = model.with_parameters(flat)
        parts, k = {}, 0
        for n in lm.Attention.TRAINED:
            size = getattr(model, n).size
            parts[n] = flat[k : k + size].reshape(getattr(model, n).shape)
            k += size
        return lm.gradient(lm.replace(exact, symbols=model.symbols.astype(float), **parts), topics, reduced, lm.Windows.over(first))

    slopes = np.concatenate([at(flat)[1][n].ravel() for n in lm.Attention.TRAINED])
    for k in rng.integers(0, len(flat), 25):
        e = np.zeros(len(flat))
        e[k] = 1e-4
        assert slopes[k] == pytest.approx((at(flat + e)[0] - at(flat - e)[0]) / 2e-4, abs=2e-6)


def test_coded_texts_spell_the_texts():
    some = ["Ab é, X ab", None, "", *texts(60)]
    ends, codes, dictionary, symbols, piece_ends = lm.code_texts(some, BYTE_BPE)
    one = lm.Coded(np.zeros(len(some), bool), ends, codes, symbols, piece_ends)
    found, first, word_ends = one.symbols(np.arange(len(some)))
    assert len(word_ends) == len(codes)
    whole = Tokenizer.from_file(BYTE_BPE)
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for i, text in enumerate(some):
        expected = [-1]
        for w in WORD.findall((text or "").translate(low)):
            ids = whole.encode(" " + w, add_special_tokens=False).ids
            expected += [*[2 * x for x in ids[:-1]], 2 * ids[-1] + 1]
        assert found[first[i] : first[i + 1]].tolist() == [*expected, -2]
    assert (found[word_ends] % 2 == 1).all()


def test_crc_of_pieces():
    ids = next(subwords.encoded(["some text"], BYTE_BPE)).astype("<u4").tobytes()
    assert zlib.crc32(ids + bytes(4)) != zlib.crc32(ids)
