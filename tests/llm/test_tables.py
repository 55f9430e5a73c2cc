"""Operators on tables: odd rows, empty tables, and brute force over the registered queries."""

import hashlib
import re
import zlib
from collections import defaultdict

import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from fixtures.compare import differences, duck
from ledgerline.llm import chat, components, edit_counts, langid, lm, near_dups, packing, pieces, quality, queries, rules, top_k

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, row string, verdict int, `a.b` int, id long, words int"
LONG = " ".join(f"w{k % 977}x{k % 31}" for k in range(60_000))
PLAIN = "One plain sentence follows another here, and no two of them are the same at all, as far as anybody can tell today.\n"
ODD = [
    (1, PLAIN * 2, "en"),
    (2, None, "en"),
    (3, "", None),
    (4, LONG, "en"),
    (5, PLAIN * 2, "de"),
    (5, PLAIN * 2, "de"),
    (6, "   \n\t ", "fr"),
    (None, "words of a row without an id", "en"),
    (7, "one two", "en"),
    (8, "two one", "en"),
    (9, "one  TWO", "en"),
    (10, "Ünï <|endoftext|> 日本語 \x00 ###", "en"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, lang, "s", 0, 0.0, "r", 1, 2, 99, 3) for i, t, lang in ODD], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (4, 0, 0), (7, 1, 0), (7, 0, 0), (None, 1, 0), (8, None, 0), (9, 3, 0), (77, 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def text_of(i):
    return {i: t for i, t, _ in ODD}[i] or ""


def test_quality_of_odd_rows(spark, docs, none, labels):
    out = quality.score_documents(docs, labels).toPandas()
    assert len(out) == len(ODD) and out["score"].between(0, 1).all()
    assert (out["predicted"] == (out["score"] >= 0.5)).all()
    assert out[out["doc_id"] == 5]["score"].nunique() == 1
    held = {r.doc_id: r.held_out for r in out[out["doc_id"].notna()].itertuples()}
    assert held == {i: zlib.crc32(str(int(i)).encode()) % 3 == 1 for i in held}
    assert (quality.score_documents(docs, labels.limit(0)).toPandas()["score"] == 0.5).all()
    assert quality.score_documents(none, labels).count() == 0
    assert quality.keep_good(docs, labels.limit(0)).columns == docs.columns


def test_rules_of_odd_rows(docs, none, labels):
    out = rules.judge_documents(docs, labels).toPandas()
    assert len(out) == len(ODD)
    for r in out[out["doc_id"].notna()].itertuples():
        assert r.n_words == len(WORD.findall(text_of(int(r.doc_id))))
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
    assert not out[out["base_failed"]]["kept"].any()
    assert rules.judge_documents(none, labels).count() == 0
    kept = rules.keep_documents(docs, labels)
    assert kept.columns == docs.columns and kept.schema["a.b"].dataType == docs.schema["a.b"].dataType
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} <= {1, 4, 5}


def brute_components(rows, least=85):
    sets = {}
    for i, text in rows:
        w = WORD.findall((text or "").translate(LOWER))
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    common = defaultdict(int)
    for own in holders.values():
        for a in range(len(own)):
            for b in range(a):
                common[min(own[a], own[b]), max(own[a], own[b])] += 1
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), n in common.items():
        if 100 * n >= least * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def test_near_duplicates_of_odd_rows(docs, none):
    out = {r["doc_id"]: tuple(r)[1:] for r in near_dups.near_duplicates(docs).collect()}
    assert out == brute_components([(i, t) for i, t, _ in ODD if i is not None])
    assert out[9][1] == 7 and out[2] == (0, 2, True)
    assert near_dups.near_duplicates(none).count() == 0
    once = near_dups.keep_first(docs)
    assert once.columns == docs.columns
    assert sorted(r["doc_id"] or -1 for r in once.select("doc_id").collect()) == [-1, 1, 2, 3, 4, 6, 7, 8, 10]


def test_large_groups_go_block_by_block(spark, monkeypatch):
    monkeypatch.setattr(near_dups, "BLOCK", 8)
    words = [f"v{k}" for k in range(80)]
    rows = []
    for i in range(60):
        own = list(words)
        for j in range(i % 4):
            own[(i * 7 + j * 31) % 80] = f"z{i}_{j}"
        rows.append((i, " ".join(own)))
    out = {r["doc_id"]: tuple(r)[1:] for r in near_dups.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == brute_components(rows)


def test_components_of_paths_and_stars(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (3, 2), (3, 2)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 140)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def valid_packing(placed, texts, capacity=2048):
    whole = Tokenizer.from_file(BYTE_BPE)
    ids = {i: [*whole.encode(t or "", add_special_tokens=False).ids, 0] for i, t in texts}
    for i, own in placed.groupby("doc_id"):
        own = own.sort_values("piece")
        n, at = len(ids[i]), 0
        assert own["piece"].tolist() == list(range(len(own)))
        for k, r in enumerate(own.itertuples()):
            assert r.start == at and (r.length == capacity or k == 0)
            part = b"".join(x.to_bytes(4, "little") for x in ids[i][r.start : r.start + r.length])
            assert r.ids_crc32 == zlib.crc32(part)
            at += r.length
        assert at == n and (len(own) == 1) == (n <= capacity)
    for _, own in placed.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own["offset"].tolist() == [0, *own["length"].cumsum().tolist()[:-1]] and own["length"].sum() <= capacity
    return -(-int(placed["length"].sum()) // capacity), placed["sequence_id"].nunique()


def test_packing_of_odd_rows(docs, none):
    placed = packing.pack_documents(docs, BYTE_BPE).toPandas()
    assert placed["doc_id"].isna().sum() == 1 and (placed["doc_id"] == 5).sum() == 2
    known = placed[placed["doc_id"].notna() & ~((placed["doc_id"] == 5) & placed.duplicated("doc_id"))]
    for i, own in known.groupby("doc_id"):
        assert own["length"].sum() == len(Tokenizer.from_file(BYTE_BPE).encode(text_of(i), add_special_tokens=False).ids) + 1
    assert packing.pack_documents(none, BYTE_BPE).count() == 0


def test_packing_query_is_valid_and_tight(spark, sf_dir):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    least, used = valid_packing(queries.op7_best_fit_packing(spark, sf_dir).toPandas(), texts)
    assert used <= least + 1


def test_near_duplicate_query_against_all_pairs(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    out = {r["doc_id"]: tuple(r)[1:] for r in queries.op9_minhash_near_dups(spark, sf_dir).collect()}
    assert out == brute_components([tuple(r) for r in rows])


def test_quality_queries_on_held_out_labels(spark, sf_dir):
    known = spark.read.parquet(f"{sf_dir}/labels.parquet").toPandas()
    graded = queries.op1_quality_classifier(spark, sf_dir).toPandas().merge(known, on="doc_id")
    held = graded[graded["held_out"]]
    assert (held["predicted"] == held["quality"]).mean() > 0.9
    judged = queries.op10_quality_rules(spark, sf_dir).toPandas().merge(known, on="doc_id")
    passed = judged[~judged["base_failed"]]
    assert passed[passed["quality"] == 1]["kept"].mean() > 0.98
    assert judged[judged["quality"] == 0]["kept"].mean() < 0.2


def test_chat_query_and_top_k_query_against_sql(spark, sf_dir):
    for name in ("op3_chat_format", "op6_pivot_top_k"):
        assert differences(queries.REGISTRY[name](spark, sf_dir), duck(sf_dir).sql(queries.ORACLE[name])) == []


def test_chat_of_odd_rows(spark):
    rows = [(1, 0, "user", None), (1, 0, "user", None), (1, None, None, "first"), (None, 1, "assistant", "\\### a: </turn>\n"), (3, 1, "human", "gpt: #")]
    turns = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, record string")
    records = chat.as_records(turns.drop("record"))
    out = {r["conv_id"]: r["d"] for r in chat.format_records(records).select("conv_id", chat.read_back("chat").alias("d")).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert out[1]["turns_sha256"] == sha("\nfirst\nuser\n\nuser\n\n") and out[1]["loss_chars"] == 0
    assert out[None]["loss_sha256"] == sha("\\### a: </turn>\n") and out[3]["turns_sha256"] == sha("human\ngpt: #\n")
    bad = spark.createDataFrame([(None, 1), ("{", 2), ('{"x": 1}', 3)], "record string, chat int").drop("chat")
    assert [r["chat"]["formatted"] for r in chat.format_records(bad).collect()] == [None] * 3
    assert chat.as_records(turns.limit(0)).count() == 0


def test_top_k_of_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0]), (3, None), (4, [None, 1.0]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]),
        (7, []), (100, [-1.5, 0.25]), (100, [-1.5, 0.25]), (None, [9.0, 9.0]), (8, [1e6, -1e6]),
    ]
    vectors = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, score int")
    whole = {i: [int(x * 1024 // 1) for x in v] for i, v in rows if i is not None and v is not None and not any(x is None or x != x or abs(x) == float("inf") for x in v)}
    got = [tuple(r) for r in top_k.top_k(vectors, F.col("vec_id") % 100 == 0, k=4).collect()]
    expected = []
    for q in (0, 100):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], v, strict=False)), i) for i, v in whole.items() if i != q)
        expected += [(q, n, i, -s) for n, (s, i) in enumerate(scores[:4], start=1)]
    assert sorted(got) == sorted(expected)
    assert top_k.top_k(vectors.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_language_model_of_odd_rows(docs, none):
    out = lm.score_documents(docs, BYTE_BPE, rounds=1).toPandas()
    assert len(out) == len(ODD) and (out["score"] < 0).all() and out["train_tokens"].nunique() == 1
    for r in out[out["doc_id"].notna()].itertuples():
        assert r.n_tokens == len(WORD.findall(text_of(int(r.doc_id)))) + 1
    assert out[out["doc_id"] == 5]["score"].nunique() == 1
    assert lm.score_documents(none, BYTE_BPE, rounds=1).count() == 0


def test_language_model_query_beats_the_base(spark, sf_dir):
    out = queries.op4_lm_scoring(spark, sf_dir).toPandas()
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").toPandas()
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in rows["doc_id"]}
    counts = defaultdict(int)
    words = {i: [*WORD.findall((t or "").translate(LOWER)), None] for i, t in zip(rows["doc_id"], rows["text"], strict=True)}
    for i, own in words.items():
        for w in own if not held[i] else []:
            counts[w] += 1
    total = sum(counts.values())
    import math

    for r in out.itertuples():
        own = words[r.doc_id]
        base = sum(math.log10((counts.get(w, 0) + 0.1) / (total + 0.1 * (len(counts) + 1))) for w in own)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.train_tokens == total and r.held_out == held[r.doc_id]
        assert r.n_known == sum(counts.get(w, 0) > 0 for w in own) and r.n_tokens == len(own)
    held_rows = out[out["held_out"]]
    assert held_rows["score"].sum() > held_rows["base_score"].sum()


def test_pieces_and_edits_of_odd_rows(docs, none):
    out = pieces.digest_documents(docs, PIECE_BPE).toPandas()
    assert len(out) == len(ODD) and out["round_trip"].all()
    back = pieces.decode_documents(pieces.encode_documents(docs, PIECE_BPE), PIECE_BPE).toPandas()
    assert {r.text for r in back.itertuples()} == {t or "" for _, t, _ in ODD}
    assert pieces.digest_documents(none, PIECE_BPE).count() == 0
    counted = edit_counts.count_documents(edit_counts.drawn_edits(docs), BYTE_BPE).toPandas()
    assert len(counted) == len(ODD)
    whole = Tokenizer.from_file(BYTE_BPE)
    for r in counted[counted["doc_id"].notna()].itertuples():
        assert r.tokens_before == len(whole.encode(text_of(int(r.doc_id)), add_special_tokens=False).ids)
    unedited = docs.withColumn("edits", F.lit(None).cast(edit_counts.EDITS))
    assert (edit_counts.count_documents(unedited, BYTE_BPE).toPandas()["n_edits"] == 0).all()
    assert edit_counts.count_documents(edit_counts.drawn_edits(none), BYTE_BPE).count() == 0


def test_language_of_odd_pages(spark, docs):
    known = spark.createDataFrame(
        [("en", "the house and the garden of the king"), ("de", "das haus und der garten des herrn"), (None, "x"), ("de", None)], "lang string, text string"
    )
    page = '<html lang="{}"><body><script>der die das</script><p>{}</p></body></html>'
    rows = [
        (1, "http://a.example.de/de/1", page.format("de", "das haus und der garten")),
        (2, "http://b.example.com/en/", page.format("de", "the house and the king of the garden")),
        (3, None, None),
        (4, "no address", "<p></p>"),
        (5, "http://a.example.de/x", page.format("", "")),
        (5, "http://a.example.de/x", page.format("", "")),
        (None, "http://a.example.de/y", "der garten und das haus &amp;"),
    ]
    pages = spark.createDataFrame([(*r, "zz", 1) for r in rows], "page_id long, url string, html string, lang string, vote int")
    out = langid.identify(pages, known).toPandas()
    assert len(out) == len(rows)
    lang = {r.page_id: r.lang for r in out.itertuples()}
    assert (lang[1], lang[2], lang[5]) == ("de", "en", "de") and out["confidence"].between(0, 1).all()
    assert out[out["page_id"].isna()]["lang"].tolist() == ["de"]
    assert langid.identify(pages.limit(0), known).count() == 0
    assert langid.identify(pages, known.limit(0)).toPandas()["lang"].isna().all()


def test_pipeline_against_its_stages_by_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    known = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = docs.toPandas()
    graded = quality.score_documents(docs, known).toPandas()
    left = rows[rows["doc_id"].isin(graded[graded["predicted"] == 1]["doc_id"])]
    judged = rules.judge_documents(spark.createDataFrame(left, docs.schema), known).toPandas()
    left = left[left["doc_id"].isin(judged[judged["kept"]]["doc_id"])]
    groups = brute_components(zip(left["doc_id"], left["text"], strict=True), 80)
    left = left[left["doc_id"].map(lambda i: groups[i][2])]
    placed = corpus_pipeline.run(spark, sf_dir).toPandas()
    assert set(placed["doc_id"]) == set(left["doc_id"])
    least, used = valid_packing(placed, zip(left["doc_id"], left["text"], strict=True))
    assert used <= least + 1
    assert isinstance(placed, pd.DataFrame) and [n for n, _ in corpus_pipeline.STAGES][-1] == "best_fit_packing"
