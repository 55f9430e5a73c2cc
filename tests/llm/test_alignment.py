"""Alignment of tokenizers: ids against the libraries, pairs and groups by brute force, counts over the corpus."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ledgerline.llm import alignment, queries

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, pairs string, row int, n int"
TEXT = "The quick brown fox, they said, jumped over 12,345 lazy dogs — naïve façade; déjà vu!\n"
ODD = [
    (1, TEXT),
    (2, None),
    (3, ""),
    (4, " "),
    (5, "  two  spaces \t tabs\n\nand ends "),
    (6, "a mark ▁ in the text"),
    (7, "<|endoftext|> </s> <s> <unk> <0x41> are plain"),
    (8, "日本語 ünï ﬁ é́ \x00 \U0001f600"),
    (9, TEXT),
    (9, TEXT),
    (None, "no id here"),
    (10, " ".join(f"w{k % 977}x{k % 31}," for k in range(150_000))),
    (11, "a" * 3_000),
]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def spelled(libraries, text):
    """The ids and byte ranges of both sides, or nothing."""
    a, b = libraries
    if not text:
        return [], [], [], []
    to_byte = alignment.byte_characters()
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(to_byte[c] for c in a.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if b"".join(bytes_a) != b"".join(bytes_b) or b"".join(bytes_a) != (" " + text).encode():
        return [], [], [], []
    ranges = []
    for own in (bytes_a, bytes_b):
        at, out = 0, []
        for part in own:
            out.append((at, at + len(part)))
            at += len(part)
        ranges.append(out)
    return ids_a, ids_b, *ranges


def overlaps(left, right):
    out, j = [], 0
    for i, (start, end) in enumerate(left):
        while right[j][1] <= start:
            j += 1
        k = j
        while k < len(right) and right[k][0] < end:
            out.append((i, k))
            k += 1
    return out


def brute(libraries, rows):
    """Per row: ids, overlaps, links, and the digest the query gives."""
    seen, found = Counter(), []
    for _, text in rows:
        ids_a, ids_b, left, right = spelled(libraries, text)
        over = overlaps(left, right)
        links = [(i, k) for i, k in over if left[i][1] == right[k][1]]
        seen.update((ids_a[i], ids_b[k]) for i, k in links)
        found.append((ids_a, ids_b, over, links))
    highest = Counter()
    for (_, b), n in seen.items():
        highest[b] = max(highest[b], n)
    out = []
    for (doc_id, _), (ids_a, ids_b, over, links) in zip(rows, found, strict=True):
        groups, at = [], (0, 0)
        for i, k in links:
            groups.append(",".join(map(str, ids_a[at[0] : i + 1])) + "|" + ",".join(map(str, ids_b[at[1] : k + 1])))
            at = i + 1, k + 1
        named = [(ids_a[i], ids_b[k]) for i, k in links]
        digest = (
            doc_id, len(ids_a), len(ids_b), len(groups), len(links), sum(seen[p] == highest[p[1]] for p in named),
            sum(seen[p] for p in named), hashlib.sha256(";".join(groups).encode()).hexdigest() if ids_a else "",
        )
        out.append((digest, ids_a, ids_b, over, links))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "p", 1, 2) for i, t in rows], SCHEMA).repartition(4)


def collected(df):
    columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_digests_of_odd_rows(spark, libraries):
    expected = sorted((x[0] for x in brute(libraries, ODD)), key=str)
    assert sum(e[1] == 0 for e in expected) == 3
    assert collected(alignment.digest_documents(frame(spark, ODD), A, B)) == expected
    # Counts beyond what goes to every task are joined.
    assert collected(alignment.digest_documents(frame(spark, ODD), A, B, broadcast_pairs=10)) == expected
    assert collected(alignment.digest_documents(frame(spark, ODD).limit(0), A, B)) == []
    assert collected(alignment.digest_documents(frame(spark, [(1, None), (2, "▁")]), A, B)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_lists_of_odd_rows(spark, libraries):
    rows = ODD[:9]
    got = {r["doc_id"]: r for r in alignment.align_documents(frame(spark, rows), A, B).collect()}
    for (i, _), (_, ids_a, ids_b, over, links) in zip(rows, brute(libraries, rows), strict=True):
        assert (got[i]["a_ids"], got[i]["b_ids"]) == (ids_a, ids_b)
        assert [tuple(p) for p in got[i]["overlaps"]] == over and [tuple(p) for p in got[i]["links"]] == links
    assert alignment.align_documents(frame(spark, rows).limit(0), A, B).count() == 0


def test_random_texts_and_short_parts(libraries, monkeypatch):
    """Units, cuts and special cases: everything equals the libraries' own encoding of whole texts."""
    rng = random.Random(11)
    bits = ["the", "Of", " ", "  ", "\n", "\t", "12", "é", "ß", "日", "<s>", "'s", "-", "_", "▁", "\x00", "　", "x" * 9, "naïve", ". "]
    texts = ["".join(rng.choices(bits, k=rng.randint(1, 60))) for _ in range(700)]
    one, two = alignment.sides(A, B)
    for size in (1 << 19, 40):
        monkeypatch.setattr(alignment, "PART_BYTES", size)
        got = [([], [], []) for _ in texts]
        bad = set()
        for owner, found, good in alignment.aligned_texts(texts, one, two):
            for k, i in enumerate(owner):
                a, b, links = got[i]
                own = slice(found.a_first[k], found.a_first[k + 1]), slice(found.b_first[k], found.b_first[k + 1])
                inside = (found.link_a >= own[0].start) & (found.link_a < own[0].stop)
                pairs = found.link_a[inside] - own[0].start + len(a), found.link_b[inside] - own[1].start + len(b)
                links += zip(*(p.tolist() for p in pairs), strict=True)
                a += found.a[own[0]].tolist()
                b += found.b[own[1]].tolist()
                if not good[k]:
                    bad.add(i)
        for i, text in enumerate(texts):
            ids_a, ids_b, left, right = spelled(libraries, text)
            assert (i in bad) == (not ids_a)
            if ids_a:
                links = [(x, y) for x, y in overlaps(left, right) if left[x][1] == right[y][1]]
                assert got[i] == (ids_a, ids_b, links)


def test_query_against_brute_force(spark, sf_dir, libraries):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    expected = sorted((x[0] for x in brute(libraries, rows)), key=str)
    assert collected(queries.op12_cross_tokenizer_alignment(spark, sf_dir)) == expected
