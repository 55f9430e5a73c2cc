"""What is learned comes from all rows: no bound on labelled documents, no window passed over."""

import inspect
import random

import numpy as np
import pytest

from ledgerline.llm import lm, rules


def prose(seed, n=40):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("aehinorst", k=rng.randint(2, 8))) for _ in range(n))


def test_every_good_label_weighs(spark):
    """Repeated rows of a labelled id count as one good document, the one with the least counts."""
    texts = [(i, prose(i)) for i in range(9000)]
    docs = spark.createDataFrame([*texts, (0, prose(0) + " more"), (None, prose(1))], "doc_id long, text string").repartition(8)
    marks = [(i, int(i % 3 > 0), 0) for i in range(9000)]
    labels = spark.createDataFrame([*marks, (1, 0, 0), (2, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    judged = rules.judged_texts(docs)
    # 6000 of 9000 are good; id 1 has contradicting labels.
    assert rules.good_cells(judged, labels).agg({"good": "sum"}).first()[0] == 5999
    many = spark.createDataFrame([(i, 1, 0) for i in range(9000)], "doc_id long, quality int, toxic int")
    assert rules.good_cells(judged, many).agg({"good": "sum"}).first()[0] == 9000
    assert "label_rows" not in inspect.signature(rules.fit_forest).parameters


@pytest.mark.parametrize("share", [0.0, 0.002, 0.1, 0.5, 1.0])
@pytest.mark.parametrize("ranges", [2, 7, 1024])
def test_threshold_from_counts_is_that_of_sorted_rows(spark, share, ranges):
    rng = np.random.default_rng(3)
    scores = np.concatenate([rng.random(200), np.nextafter(0.5, 1) * np.ones(3), [0.5, 0.5, 1e-300, 0.0]])
    times = rng.integers(1, 6, len(scores))
    held = spark.createDataFrame(list(zip(scores.tolist(), times.tolist(), strict=True)), "score double, good long")
    rows = np.sort(np.repeat(scores, times))
    expected = rows[max(len(rows) - 1 - int(share * len(rows)), 0)]  # with a share of 1 the least of all
    assert rules.score_above(held, share, ranges) == expected


def test_training_uses_every_window():
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 5, (lm.TOPICS, lm.BEGIN + 1, lm.RARE + 1)).astype(float)
    first = np.array([0, 5, 140, 900])
    reduced = rng.integers(0, lm.RARE + 1, 900)
    reduced[first[:-1]] = lm.BEGIN
    model, topics = lm.Attention.begin(counts, 1), lm.topic_probabilities(counts)
    flat, n = lm.train(model, topics, reduced, first, 3)
    assert n == len(lm.Windows.over(first).start) == 1 + 5 + 24
    # A change in any window shows in what is learned.
    for at in (3, 100, 130, 450, 899):
        other = reduced.copy()
        other[at] = (other[at] + 1) % lm.RARE
        assert not np.array_equal(flat, lm.train(model, topics, other, first, 3)[0])
