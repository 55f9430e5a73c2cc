"""What an operator must not leave out: cases that fixed limits, samples and defaults would miss."""

import math
import random
import re
from collections import Counter

import numpy as np

import corpus_pipeline
from ledgerline.llm import near_dups, rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def kept_by_all_pairs(rows, least):
    """The least id of each component of texts whose 5-word shingles agree on ``least`` percent."""
    sets, holders, common = {}, {}, Counter()
    for i, text in sorted(rows):
        w = WORD.findall((text or "").translate(LOWER))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(len(w) - 4, min(len(w), 1)))}
        for x in sets[i]:
            common.update((j, i) for j in holders.setdefault(x, []))
            holders[x].append(i)
    name = {i: i for i in sets}
    for (a, b), n in common.items():
        if 100 * n >= least * (len(sets[a]) + len(sets[b]) - n):
            one, two = sorted((name[a], name[b]))
            name = {i: one if c == two else c for i, c in name.items()}
    return {i for i, c in name.items() if i == c}


def test_pipeline_drops_near_copies_from_80_percent(spark, sf_dir):
    words = [f"v{k}" for k in range(104)]
    # 100 shingles; a changed word within touches 5 of them.
    near = [w if k not in (20, 60) else "changed" for k, w in enumerate(words)]
    far = [w if k not in (10, 30, 60, 80) else "other" for k, w in enumerate(words)]
    rows = [(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(far))]
    kept = corpus_pipeline.minhash_near_dups(spark, spark.createDataFrame(rows, "doc_id long, text string"), sf_dir)
    # 90 shingles of 110 in common with the first text, and 80 of 120.
    assert {r["doc_id"] for r in kept.collect()} == {1, 3}


def test_pipeline_stage_against_all_pairs_at_80_percent(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    expected = kept_by_all_pairs([tuple(r) for r in docs.select("doc_id", "text").collect()], 80)
    assert {r["doc_id"] for r in corpus_pipeline.minhash_near_dups(spark, docs, sf_dir).collect()} == expected


def prose(seed, words=120):
    rng = random.Random(seed)
    return " ".join(rng.choice("aeiou") * rng.randint(0, 1) + "".join(rng.choices("bcdefgilmnoprstu", k=rng.randint(2, 8))) for _ in range(words))


def judged_with(spark, odd, n_good=300):
    """doc_id -> kept, of plain texts that are all labelled good and odd unlabelled ones from 10000."""
    rows = [(i, prose(i)) for i in range(n_good)] + [(10_000 + k, t) for k, t in enumerate(odd)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(n_good)], "doc_id long, quality int, toxic int")
    return {r["doc_id"]: r["kept"] for r in rules.judge_documents(docs, labels).select("doc_id", "kept").collect()}


def test_rules_reject_where_all_labels_are_good(spark):
    kept = judged_with(spark, [" ".join(w + "##" for w in prose(900 + k).split()) for k in range(5)])
    assert not any(kept[10_000 + k] for k in range(5))
    assert sum(kept[i] for i in range(300)) >= 297


def test_rules_reject_a_kind_that_one_document_of_many_has(spark):
    # More documents than any sample of 4096 is likely to hold the odd one of.
    plain = [(i, prose(i, 30)) for i in range(12_000)]
    odd = [(20_000, " ".join(w + "#?!" for w in prose(7).split()))]
    docs = spark.createDataFrame(plain + odd, "doc_id long, text string").repartition(8)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 12_000, 30)], "doc_id long, quality int, toxic int")
    out = rules.judge_documents(docs, labels).where("doc_id >= 20000 or not kept").collect()
    assert [r["kept"] for r in out if r["doc_id"] == 20_000] == [False]
    assert len(out) < 120


def test_the_forest_is_the_same_however_it_is_summed(spark, monkeypatch):
    """On the driver or on the executors, in any order and with cells counted in parts: one width, one forest."""
    docs = spark.createDataFrame([(i, prose(i) + " 7?" * (i % 40)) for i in range(150)], "doc_id long, text string")
    counts = rules.statistics([r["text"] for r in docs.collect()])
    own = rules.cells(rules.ratios(counts[~rules.base_failed(counts)]))
    held = rules.all_cells(docs, own[:50])
    assert held.agg({"n": "sum", "good": "sum"}).first().asDict() == {"sum(n)": len(own), "sum(good)": 50}
    assert {tuple(r["cell"]) for r in held.collect()} == {tuple(c) for c in own.tolist()}
    here = rules.forest_of(held, 20, 3)
    monkeypatch.setattr(rules, "LOCAL_CELLS", 0)
    monkeypatch.setattr(rules, "PART", 7)
    for table in (held, held.orderBy("cell").repartition(5)):
        there = rules.forest_of(table, 20, 3)
        assert (here.feature == there.feature).all() and (here.value == there.value).all() and (here.path == there.path).all()
    assert (here.feature >= 0).sum() > 100


def test_rules_keep_an_unlabelled_majority(spark):
    """Most documents are of a harmless kind that no label names; a few odd ones of a third kind still go."""

    def other(seed):
        rng = random.Random(seed)
        words = ["".join(rng.choices("bcdefgilmnoprstu", k=rng.randint(6, 12))) for _ in range(120)]
        return " ".join(w.capitalize() if rng.random() < 0.2 else w for w in words)

    odd = [other(5000 + k) for k in range(700)] + [" ".join(w + "##" for w in prose(900 + k).split()) for k in range(5)]
    kept = judged_with(spark, odd)
    assert sum(kept[i] for i in range(300)) >= 297
    assert sum(kept[10_000 + k] for k in range(700)) >= 600
    assert not any(kept[10_700 + k] for k in range(5))


def test_rules_query_by_brute_force(spark, sf_dir):
    """The registered query's counts and verdicts against plain loops over words, lines, cells and trees."""
    from ledgerline.llm import queries

    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    marks = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    out = {r["doc_id"]: r for r in queries.op10_quality_rules(spark, sf_dir).collect()}
    assert out.keys() == texts.keys()
    passed, cell = [], {}
    for i, text in texts.items():
        words = WORD.findall(text)
        runs = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
        inside = {k + j for k in range(len(words) - 7) if runs[tuple(words[k : k + 8])] > 1 for j in range(8)}
        lines = [line for line in text.split("\n") if WORD.search(line)]
        expected = (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside),
        )
        r = out[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == expected
        assert r["base_failed"] == (len(words) < 20 or 100 * len(inside) > 30 * len(words))
        if not r["base_failed"]:
            passed.append(i)
            cell[i] = tuple(rules.cells(rules.ratios(np.array([[r[c] for c in rules.COUNT_NAMES]])))[0].tolist())
    good = [i for i in passed if marks.get(i) == 1]

    def paths(tree, rows, node=0, level=0):
        """Path lengths by plain recursion over documents."""
        held, as_documents = sum(i in good_ones for i in rows), 256 * 0.05 * len(rows) / len(passed)
        mass = as_documents + 256 * 0.95 * held / len(good)
        columns = list(zip(*(cell[i] for i in rows), strict=True))
        usable = [f for f, c in enumerate(columns) if max(c) > min(c)]
        if level == 12 or not usable or (not held and as_documents <= 1):
            return dict.fromkeys(rows, level + float(rules._usual_path(np.array(mass))))
        rng = np.random.default_rng([7, tree, node])
        f = rng.choice(usable)
        at = np.float32(rng.uniform(min(columns[f]), max(columns[f])))
        left, right = [i for i in rows if cell[i][f] <= at], [i for i in rows if cell[i][f] > at]
        return paths(tree, left, 2 * node + 1, level + 1) | paths(tree, right, 2 * node + 2, level + 1)

    good_ones = set(good)
    total = Counter()
    for tree in range(100):
        total.update(paths(tree, passed))
    usual = 2 * (math.log(255) + 0.5772156649015329) - 2 * 255 / 256
    score = {i: 2 ** (-total[i] / 100 / usual) for i in passed}
    threshold = sorted(score[i] for i in good)[len(good) - 1 - int(0.002 * len(good))]
    for i in passed:
        assert abs(out[i]["anomaly"] - score[i]) < 1e-6
        assert out[i]["kept"] == (score[i] <= threshold) or abs(score[i] - threshold) < 1e-6
    assert not any(out[i]["kept"] for i in texts if i not in cell)


def test_rules_see_below_the_usual_limits_and_both_sides(spark):
    several = " ".join(w + ("#" if k % 13 == 0 else "!" if k % 7 == 0 else str(k % 10) * 5 if k % 4 == 0 else "") for k, w in enumerate(prose(5).split()))
    tiny = " ".join(w[:1] for w in prose(6).split())
    kept = judged_with(spark, [several, tiny])
    assert not kept[10_000] and not kept[10_001]
    assert sum(kept[i] for i in range(300)) >= 297


def test_unlike_texts_under_one_id_both_stay(spark):
    one, two, three = prose(1), prose(2), prose(3)
    rows = [(1, one), (2, one), (2, two), (2, two), (3, two + " end"), (4, three), (4, three + " end"), (5, ""), (5, " "), (None, one)]
    kept = near_dups.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    out = sorted((r["doc_id"] or -1, r["text"].strip()[:20]) for r in kept)
    assert out == [(-1, one[:20]), (1, one[:20]), (2, two[:20]), (4, three[:20]), (5, "")]
