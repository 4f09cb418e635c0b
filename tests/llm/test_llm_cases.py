"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing extra columns."""

import numpy as np
import pytest

from orderlens.llm import ann, bpe, licenses, minhash, mixing, pii, quality, token_count, topk, warc

LONG = "alpha beta, gamma 42. " * 40_000
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, label string, set_id string, bucket int, rate int, _q_score int, spans string"
PLAIN = "One two three four five six seven. Mail a@b.org. Licensed under CC BY-NC 4.0.\nThen more follows here."


def odd_rows():
    texts = [(1, PLAIN), (2, PLAIN), (2, PLAIN), (3, None), (4, ""), (5, " \n\t"), (None, PLAIN), (6, LONG), (7, LONG), (8, "one two"), (9, "ONE two"), (10, "x" * 300_000)]
    return [(i, t, None, None if i == 3 else f"s{(i or 0) % 3}", None, None, "x", "y", 1, 2, 3, None) for i, t in texts]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 1, 0), (None, 1, 0), (6, None, 0), (8, 0, 1), (10, 0, 0)], "doc_id bigint, quality int, toxic int")


def test_near_duplicates(odd, none):
    found = minhash.near_duplicates(odd).collect()
    component = {r.doc_id: r.component_id for r in found}
    assert len(found) == 12
    assert component == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, None: None, 6: 6, 7: 6, 8: 8, 9: 8, 10: 10}
    assert {r.doc_id: r.n_shingles for r in found if r.doc_id in (3, 4, 5, 8)} == {3: 0, 4: 0, 5: 0, 8: 1}
    assert minhash.near_duplicates(none).count() == 0
    left = minhash.drop_near_duplicates(odd)
    assert left.columns == odd.columns
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted([1, 3, 4, 5, 6, 8, 10, None], key=str)
    assert minhash.drop_near_duplicates(none).count() == 0


@pytest.mark.parametrize("block", [3, 512])
def test_chains_of_links_are_followed(spark, block):
    """Each text is linked to the next one only; blocks are smaller than the group."""
    words = [f"w{i}" for i in range(400)]
    texts = [(100 - i, " ".join(words[6 * i : 6 * i + 100])) for i in range(40)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    assert {r.component_id for r in minhash.near_duplicates(docs, block=block).collect()} == {61}


def test_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 1200).astype(np.uint64)
    a, b = (minhash.signatures([np.unique(x)])[0] for x in (pool[:1000], pool[200:]))
    assert abs((a == b).mean() - 800 / 1200) < 0.12
    assert np.isinf(minhash.signatures([np.empty(0, np.uint64)])).all()


def test_quality(spark, odd, none, labels):
    found = quality.classify(odd, labels).collect()
    assert len(found) == 12 and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.doc_id in (1, 2, None)}) == 1
    assert {r.score for r in quality.classify(odd, labels.limit(0)).collect()} == {0.5}
    assert quality.classify(none, labels).count() == 0
    assert quality.keep_good(odd, labels).columns == odd.columns


def test_tokens(odd, none):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(bpe.tokenizer_path(bpe.TOKENIZER))
    expected = sorted((str(r[0]), len(tok.encode(r[1] or "", add_special_tokens=False).ids)) for r in odd_rows())
    assert sorted((str(r.doc_id), r.n_tokens) for r in bpe.round_trip_digests(odd).collect()) == expected
    assert sorted((str(r.doc_id), r.n_tokens) for r in token_count.count_tokens(odd, chunk=4096, overlap=64).collect()) == expected
    assert bpe.round_trip_digests(none).count() == token_count.count_tokens(none).count() == 0


def test_encode_then_decode_with_special_strings(spark):
    texts = ["", "a<|endoftext|>b", "it's   x　y\r\n\n z", "日本語 emoji 👩‍👩‍👧 é́", "<|endoftext", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    back = bpe.decode(bpe.encode(docs))
    assert {r.doc_id: r.text for r in back.collect()} == {i: t or "" for i, t in enumerate(texts)}


def test_warc(spark):
    pages = spark.createDataFrame(
        [(1, "u", "same", 1), (5, None, "same", 1), (None, "u", "same", 1), (2, "a\r\nb", None, 1), (3, "u", "", 1), (4, "u", "x" * 400_000, 1), (7, "u", "t", 1), (7, "u", "t", 1)],
        "page_id bigint, url string, html string, file int",
    )
    found = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in warc.round_trip(pages).collect()), key=str)
    assert found == sorted(
        [(1, "revisit", 5, 4), (5, "response", None, 4), (None, "revisit", 5, 4), (2, "revisit", 3, 0), (3, "response", None, 0), (4, "response", None, 400_000)]
        + [(7, "response", None, 1)] * 2,
        key=str,
    )
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_warc_files_are_the_same_twice_and_roll(spark, tmp_path):
    pages = spark.range(300).selectExpr("id AS page_id", "'u' AS url", "repeat(sha2(string(id), 512), 9) AS html")
    runs = []
    for n in (1, 3):
        manifest = warc.write_archives(pages.repartition(n), str(tmp_path / str(n)), shard_bytes=170_000, roll=20_000)
        runs.append(sorted((r["name"], r.records, r.sha256) for r in manifest.collect()))
    assert runs[0] == runs[1] and len(runs[0]) > 6
    assert not (tmp_path / "1" / "_temporary").exists()
    read = warc.read_archives(spark, str(tmp_path / "1"))
    assert sorted((r.page_id, r.payload) for r in read.collect()) == sorted((r.page_id, r.html) for r in pages.collect())


def test_pii(odd, none):
    found = pii.pii_counts(odd).collect()
    assert len(found) == 12
    assert {r.doc_id for r in found if r.n_email == 1} == {1, 2, None}
    assert all(r.spans == "" for r in found if r.doc_id in (3, 4, 5))
    assert pii.pii_counts(none).count() == 0
    masked = pii.mask_pii(odd)
    assert masked.columns == odd.columns and masked.where("text LIKE '%<email>%'").count() == 4


def test_mixing(odd, none):
    found = mixing.taken_words(odd).collect()
    assert len(found) == 12 and all(0 <= r.taken <= 3 * r.size for r in found)
    assert {(r.source, r.size, r.target) for r in found if r.doc_id == 3} == {(None, 0, 0.0)}
    assert mixing.taken_words(none).count() == mixing.mix(none).count() == 0
    assert mixing.mix(odd).columns == odd.columns


def test_licenses(spark, odd, none):
    found = licenses.license_report(odd).collect()
    assert len(found) == 12 and {r.doc_id for r in found if r.licenses == "CC-BY-NC-4.0"} == {1, 2, None}
    assert licenses.license_report(none).count() == 0
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy\n# of this software. The above copyright notice and this\npermission notice shall be included in all copies. "
    bsd = "Redistribution and use in source and binary forms, with or without modification, are permitted:\n1. Redistributions of source code must retain the above copyright notice.\n2. Redistributions in binary form must reproduce the above copyright notice.\n"
    end = "3. Neither the name of X nor Y may be used to endorse or promote products.\n"
    texts = [mit, bsd, bsd + end, mit + bsd + "Released under the MIT License.", "SPDX-License-Identifier: GPL-2.0-or-later", "It is LICENSED under the GNU General Public License, version 3.", "Released under MIT.", "a permit of my own, under no license"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    assert [r.licenses for r in sorted(licenses.license_report(docs).collect())] == [
        "MIT", "BSD-2-Clause", "BSD-3-Clause", "MIT,BSD-2-Clause", "GPL-2.0-or-later", "GPL-3.0", "MIT", "",
    ]


def vectors(spark):
    rows = [(i, [float(i % 7), 1.0 + i // 50], i) for i in range(0, 120)]
    rows += [(300, [0.0, 0.0], 0), (301, None, 0), (302, [None, 1.0], 0), (303, [float("nan"), 1.0], 0), (304, [float("inf"), 1.0], 0), (305, [], 0), (None, [1.0, 1.0], 0), (400, [1e9, -3.5], 0)]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, block int")


def test_top_k_with_ties(spark):
    df = vectors(spark)
    v = {r.vec_id: np.floor(256 * np.array(r.embedding)) for r in df.collect() if r.vec_id is not None and (r.vec_id < 301 or r.vec_id == 400)}
    expected = set()
    for q in (i for i in v if i % 50 == 0):
        best = sorted((-int(sum(int(a) * int(b) for a, b in zip(v[q], v[i]))), i) for i in v if i != q)[:5]
        expected |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(best)}
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in topk.search(df).collect()} == expected
    assert topk.search(df.limit(0)).count() == 0
    assert {r.vec_id for r in topk.search(df.where("vec_id IN (0, 3)")).collect()} == {3}


def test_forest_with_ties_and_few_rows(spark):
    df = vectors(spark)
    found = [r for r in ann.search(df, effort=64).collect() if r.query_id == 0]
    v = {r.vec_id: np.array(r.embedding) for r in df.collect() if r.vec_id is not None and (r.vec_id < 300 or r.vec_id == 400)}
    expected = sorted((float(np.sqrt(((v[0] - v[i]) ** 2).sum())), i) for i in v if i)[:10]
    assert [(r.score, r.vec_id) for r in sorted(found, key=lambda r: r["rank"])] == expected
    assert ann.search(df.limit(0)).count() == 0
    assert {r.vec_id for r in ann.search(df.where("vec_id IN (0, 3)")).collect()} == {3}
