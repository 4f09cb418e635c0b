"""The registered training-data queries against DuckDB, the libraries, or brute force on the small tables."""

import base64
import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from oracle_compare import compare, duck
from orderlens.llm import bpe, mixing, pii, token_count
from orderlens.llm.common import table
from orderlens.llm.registry import ORACLES, QUERIES

MIDDLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return {r.doc_id: r.text or "" for r in table(spark, sf_dir, "documents").collect()}


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(bpe.tokenizer_path(bpe.TOKENIZER))
    tok.no_truncation()
    tok.no_padding()
    return tok


def rows(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def brute_components(sets):
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {i: root(i) for i in ids}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, name):
    r = compare(QUERIES[name](spark, sf_dir), duck(sf_dir), ORACLES[name])
    assert r["match"], r


def test_near_duplicates_match_brute_force(spark, texts, sf_dir):
    sets = {i: shingle_set(t) for i, t in texts.items()}
    expected = brute_components(sets)
    found = rows(QUERIES["op1_minhash_dedup"](spark, sf_dir))
    assert {i: r.component_id for i, r in found.items()} == expected
    assert {i: r.n_shingles for i, r in found.items()} == {i: len(s) for i, s in sets.items()}
    assert all(r.kept == (i == r.component_id) for i, r in found.items())
    assert len(set(expected.values())) < len(expected)


def test_quality_on_held_out_labels(spark):
    found = rows(QUERIES["op2_quality"](spark, MIDDLE))
    marks = [(r.doc_id, r.quality) for r in table(spark, MIDDLE, "labels").collect()]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in found.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found.values())
    held = [(found[i].predicted, q) for i, q in marks if found[i].held_out]
    assert len(held) > 50 and sum(p == q for p, q in held) / len(held) >= 0.95


def test_bpe_matches_library(spark, texts, library, sf_dir):
    found = rows(QUERIES["op3_bpe_round_trip"](spark, sf_dir))
    for (i, t), e in zip(texts.items(), library.encode_batch(list(texts.values()), add_special_tokens=False)):
        assert found[i].n_tokens == len(e.ids)
        assert found[i].ids_sha256 == hashlib.sha256(np.array(e.ids, "<u4").tobytes()).hexdigest()
        decoded = library.decode(e.ids, skip_special_tokens=False)
        assert found[i].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_token_counts_match_library(spark, texts, library, sf_dir):
    expected = {i: len(e) for i, e in zip(texts, library.encode_batch(list(texts.values()), add_special_tokens=False))}
    found = rows(QUERIES["op4_token_counts"](spark, sf_dir))
    assert {i: r.n_tokens for i, r in found.items()} == expected
    assert all(r.n_bytes == len(texts[i].encode()) and r.over_limit == (r.n_tokens > 1024) for i, r in found.items())
    # small chunks: nearly every document is spliced
    small = rows(token_count.count_tokens(table(spark, sf_dir, "documents"), chunk=256, overlap=24))
    assert {i: r.n_tokens for i, r in small.items()} == expected


def test_warc_digests(spark, sf_dir):
    pages = rows(table(spark, sf_dir, "pages"), "page_id")
    for i, r in rows(QUERIES["op5_warc"](spark, sf_dir), "page_id").items():
        payload = (pages[i].html or "").encode()
        assert (r.payload_bytes, r.payload_digest) == (len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode())


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    def holds(kind, m):
        digits = re.sub("[^0-9]", "", m)
        if kind == "ip":
            return all(int(p) <= 255 for p in m.split("."))
        if kind == "card":
            doubled = "".join(str(int(d) * (1 + i % 2)) if int(d) * (1 + i % 2) < 10 else str(int(d) * 2 - 9) for i, d in enumerate(digits[::-1]))
            return 16 <= len(digits) <= 19 and sum(map(int, doubled)) % 10 == 0
        return kind == "email" or 8 <= len(digits) <= 15

    return [(k, m.start(), m.end()) for k, p in BASE.items() for m in re.finditer(p, text) if holds(k, m[0])]


def test_pii_base_matches_patterns(spark, texts, sf_dir):
    found = rows(QUERIES["op6_pii"](spark, sf_dir))
    for i, t in texts.items():
        spans = base_spans(t)
        n = Counter(k for k, _, _ in spans)
        r = found[i]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(n[k] for k in BASE)
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
        assert set(pii.joined(spans).split(",")) <= {*r.spans.split(","), ""}


def test_pii_on_random_text():
    rng = np.random.default_rng(5)
    letters = list("ab.@%+-019 ()\n25é") + ["+4", "1.2", "a@b.c", "4111 1111 1111 1111", "://a:b@", "IBAN GB82 WEST 1234 5698 7654 32"]
    for _ in range(3000):
        t = "".join(rng.choice(letters, rng.integers(1, 40)))
        assert [s for s in pii.find(t) if s[0] in pii.BASE_KINDS] == base_spans(t), t


def brute_targets(sizes, weights, most=3):
    """Shares by weight; what is above its cap stops there, the excess is shared again."""
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in sizes if s not in capped]
        left, weight = total - sum(capped.values()), sum(weights[s] for s in free)
        share = {s: left * weights[s] / weight for s in free} if weight else {}
        above = [s for s in free if share[s] > most * sizes[s]]
        if not above:
            return capped | share
        capped |= {s: most * sizes[s] for s in above}


@pytest.mark.parametrize("seed", range(4))
def test_mixing_targets_match_resharing(spark, seed):
    rng = np.random.default_rng(seed)
    sizes = {f"s{i:02}": int(rng.integers(0, 40) if i % 2 else rng.integers(400, 4000)) for i in range(9)}
    df = spark.createDataFrame(list(sizes.items()), "source string, size bigint")
    weights = {s: i % 3 + 1 for i, s in enumerate(sorted(sizes))}
    found = {r.source: r for r in mixing.source_rates(df).collect()}
    for s, target in brute_targets(sizes, weights).items():
        assert found[s].weight == weights[s] and found[s].target == pytest.approx(target)
        assert 0 <= found[s].rate <= 3


def test_mixing_takes_about_the_target(spark):
    taken, target, size = Counter(), {}, {}
    for r in mixing.taken_words(table(spark, MIDDLE, "documents")).collect():
        taken[r.source] += r.taken
        target[r.source], size[r.source] = r.target, r.source_size
        assert 0 <= r.taken <= 3 * r.size
    assert sum(target.values()) == pytest.approx(sum(size.values()))
    assert sum(taken.values()) == pytest.approx(sum(target.values()), rel=0.1)
    again = {r.doc_id: r.taken for r in QUERIES["op7_mixing"](spark, MIDDLE).collect()}
    assert sum(again.values()) == sum(taken.values())


def test_forest_recall_and_scores(spark):
    embeddings = {r.vec_id: np.array(r.embedding, float) for r in table(spark, MIDDLE, "embeddings").collect()}
    ids = np.array(sorted(embeddings))
    matrix = np.array([embeddings[i] for i in ids])
    found: dict[int, list] = {}
    for r in sorted(QUERIES["op10_prefix_forest"](spark, MIDDLE).collect(), key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(found) == {int(i) for i in ids if i % 100 == 0}
    hits = 0
    for q, near in found.items():
        distance = np.sqrt(((matrix - embeddings[q]) ** 2).sum(axis=1))
        order = [int(i) for i in ids[np.lexsort((ids, distance))] if i != q][:10]
        hits += len(set(order) & {v for _, v, _ in near})
        assert [k for k, _, _ in near] == list(range(1, 11))
        assert all(s == pytest.approx(distance[np.searchsorted(ids, v)], rel=1e-12) for _, v, s in near)
    assert hits / (10 * len(found)) >= 0.9


def test_pipeline_matches_its_operators(spark, sf_dir, library):
    """Stage by stage: each on the last one's rows, held against brute force."""
    import corpus_pipeline
    from orderlens.llm.common import stored

    names = table(spark, sf_dir, "documents").columns
    docs, kept = table(spark, sf_dir, "documents"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = stored(stage(spark, docs, sf_dir), f"test-{name}")
        assert docs.columns == names
        kept[name] = [(r.doc_id, r.text) for r in docs.collect()]
        after = Counter(i for i, _ in kept[name])
        assert after
        if name == "near-dedup":
            components = brute_components({i: shingle_set(t or "") for i, t in before.items()})
            assert set(after) == {i for i, c in components.items() if i == c}
        if name == "pii":
            assert dict(kept[name]) == {i: pii.masked(t, pii.find(t)) if t else t for i, t in before.items()}
        if name == "mixing":
            assert set(after) <= set(before) and max(after.values()) <= 3
    result = corpus_pipeline.run(spark, sf_dir).collect()
    final = kept["mixing"]
    assert Counter(r.doc_id for r in result) == Counter(i for i, _ in final)
    counts = {i: len(library.encode(t or "", add_special_tokens=False).ids) for i, t in final}
    assert all(r.n_tokens == counts[r.doc_id] for r in result)
