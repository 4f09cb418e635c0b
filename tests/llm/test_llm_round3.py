"""Spelling variants, pivot range join and source divergence against brute force, and on odd rows; what is stored goes."""

import gc
import time
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

from orderlens.llm import divergence, pivot_join, spelling
from orderlens.llm.registry import QUERIES
from orderlens.session import shared_dir

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, word string, n int, wid int, cell int, term string, p int, rank int"


def docs(spark, rows):
    """(doc_id, text, lang, source), with more columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, 0, "w", 1, 2, 3, "t", 4, 5) for r in rows], DOCS).repartition(3)


# ---- spelling variants ----

def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_spelling(counts, ratio=10):
    """word -> (form, root, n, n_near, form_n)"""
    form = {}
    found = {}
    for w, n in counts.items():
        around = [(-m, x) for x, m in counts.items() if near(w, x)]
        best = min(around, default=(0, None))
        form[w] = best[1] if around and -best[0] >= ratio * n else None
        found[w] = [n, len(around), -best[0] if form[w] else None]

    def root(w):
        return w if form[w] is None else root(form[w])

    return {w: (form[w], root(w), *found[w]) for w in counts}


def spelled(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@pytest.mark.parametrize("block", [3, 2048])
def test_spelling_matches_brute_force(spark, block):
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abcß"), rng.integers(7, 10))) for _ in range(300)]
    texts = [(i, " ".join(rng.choice(words, 60, p=np.arange(1, 301) / 45150)), "x", "y") for i in range(100)]
    texts += [(1000, "Straße " * 3 + "colouring " * 300 + "coluring " * 20 + "colring " * 2, "x", "y")]
    counts = Counter(w for _, t, *_ in texts for w in t.lower().split() if len(w) >= 7)
    expected = brute_spelling({w: n for w, n in counts.items() if n >= 2})
    found = spelled(spelling.spelling_variants(docs(spark, texts), drop=None, block=block))
    assert found == expected
    assert found["colring"][:2] == ("coluring", "colouring")


def test_spelling_on_odd_rows(spark):
    long = "abcdefgh " * 50_000 + "x" * 100_000 + " " + "x" * 100_000
    rows = [(1, None, None, None), (2, "", "", ""), (3, long, "", ""), (3, long, "", ""), (None, "ÉCOLIÈRE écolière ÉCOLIèRE 日本語日本語日本語", "", ""), (4, "seventy-seven ABCDEFG abcdefg", "", "")]
    found = spelled(spelling.spelling_variants(docs(spark, rows), drop=None))
    # only A-Z is lower-cased
    assert set(found) == {"abcdefgh", "x" * 100_000, "abcdefg"}
    assert found["abcdefg"] == ("abcdefgh", "abcdefgh", 2, 1, 100_000) and found["x" * 100_000][2:] == (4, 0, None)
    assert spelling.spelling_variants(docs(spark, rows).limit(0)).count() == 0


def test_runs_lose_a_letter_by_their_hash(spark):
    words = [f"{a}{b}cdefghé" for a in "abcdefghijklmnopqrstuvwxyz" for b in "xyz"]
    expected = Counter()
    for doc_id in ("7", ""):
        for w in words:
            h = zlib.crc32(f"{doc_id}:{w}".encode())
            expected[w[: h % len(w)] + w[h % len(w) + 1 :] if h % 31 == 0 else w] += 1
    rows = [(7, " ".join(words), "", ""), (None, " ".join(words).upper().replace("É", "é"), "", "")]
    found = {r.word: r.n for r in spelling.vocabulary(docs(spark, rows), least=1).collect()}
    assert found == expected and any(len(w) == 8 for w in found)


def test_no_two_steps_between_cells_are_equal():
    steps = spelling._steps()
    both = np.concatenate([steps, np.zeros(len(steps) - 1, np.uint64) - steps[1:]])
    assert len(np.unique(both)) == len(both)


# ---- pivot range join ----

def linked(vectors, cosine=0.95):
    """id -> (links, component) by a matrix of all pairs; ``vectors`` (id, vector) of one length."""
    ids = [i for i, _ in vectors]
    u = np.array([v for _, v in vectors], float)
    u /= np.linalg.norm(u, axis=1)[:, None]
    hits = u @ u.T >= cosine
    np.fill_diagonal(hits, False)
    label = list(range(len(ids)))
    for a, b in zip(*np.nonzero(hits)):
        low, high = sorted((label[a], label[b]))
        label = [low if x == high else x for x in label]
    least = {x: min(i for i, y in zip(ids, label) if y == x) for x in label}
    return sorted((i, int(n), least[x]) for i, n, x in zip(ids, hits.sum(axis=1), label))


def found_links(df, **kw):
    return sorted((r.vec_id, r.n_links, r.component_id) for r in pivot_join.near_duplicate_vectors(df, **kw).collect())


@pytest.mark.parametrize("kw", [{}, {"cell": 20, "block": 8, "sample": 64}, {"cell": 1000, "block": 16, "sample": 2}])
def test_vectors_match_brute_force(spark, kw):
    rng = np.random.default_rng(2)
    vectors = [(i, rng.standard_normal(6).tolist()) for i in range(150)]
    crowd = rng.standard_normal(6)
    # a third of the rows in one crowd, a chain, and copies
    vectors += [(200 + i, (crowd + 0.15 * rng.standard_normal(6)).tolist()) for i in range(80)]
    vectors += [(400 - i, [float(np.cos(0.3 * i)), float(np.sin(0.3 * i)), 0.0, 0.0, 0.0, 0.0]) for i in range(12)]
    vectors += [(500 + i, vectors[3][1]) for i in range(5)] + [(600, [5 * x for x in vectors[3][1]])]
    df = spark.createDataFrame([(i, v, 0, 0, 0) for i, v in vectors], "vec_id bigint, embedding array<double>, cid int, cell int, n int").repartition(4)
    assert found_links(df, **kw) == linked(vectors)


def test_vectors_on_odd_rows(spark):
    e = [1.0, 0.0]
    rows = [(1, e), (2, [1e200, 0.0]), (3, [1e-200, 1e-203]), (4, [0.0, 0.0]), (5, None), (6, []), (7, [None, 1.0]), (8, [float("nan"), 1.0]), (9, [float("inf"), 0.0]), (None, e), (10, [1.0, 0.0, 0.0]), (11, e), (11, e), (12, [0.0, 1.0]), (13, [1.0] * 5000)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = pivot_join.near_duplicate_vectors(df).collect()
    links = {(r.vec_id, r.n_links, r.component_id) for r in found}
    assert len(found) == len(rows) and all(r.kept == (r.vec_id == r.component_id) for r in found)
    assert {x for x in links if x[1]} == {(i, 4, 1) for i in (1, 2, 3, 11)}
    assert {x[0] for x in links if x[0] == x[2]} == {None, 1, 4, 5, 6, 7, 8, 9, 10, 12, 13}
    assert pivot_join.near_duplicate_vectors(df.limit(0)).count() == 0


def test_cosine_at_the_threshold_is_exact():
    assert pivot_join.cosine_of(np.array([3.0, 4.0]), np.array([3.0, 4.0])) == 1.0
    assert pivot_join.cosine_of(np.array([1e300, 0.0]), np.array([1e-300, 0.0])) == 1.0


def test_pivots_keep_their_distance():
    rng = np.random.default_rng(3)
    points = pivot_join.unit(np.concatenate([rng.standard_normal((500, 8)), [1, 2, 3, 4, 5, 6, 7, 8] + 0.3 * rng.standard_normal((300, 8))]))
    reach = (2 - 2 * 0.95) ** 0.5
    pivots = pivot_join.choose_pivots(points, 40, reach)
    apart = np.linalg.norm(pivots[:, None] - pivots[None], axis=2)[np.triu_indices(len(pivots), 1)]
    assert len(pivots) == 40 and apart.min() >= 2 * reach - 1e-9
    # the first is the centre of the crowd
    assert ((points @ pivots[0])[500:] >= 1 - reach**2 / 8).mean() > 0.3


# ---- source divergence ----

def brute_divergence(rows, min_docs=10, top=10):
    f = lambda p, q: (p - q) ** 2 // (p + q)
    count, seen, groups = Counter(), defaultdict(set), set()
    for i, (_, text, lang, source) in enumerate(rows):
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        word = ""
        for c in (text or "") + " ":
            if c.isascii() and not c.isalpha():
                if word:
                    count[lang, source, word] += 1
                    seen[lang, word].add(i)
                word = ""
            else:
                word += c.lower() if c.isascii() else c
    out = set()
    for lang, source in groups:
        kept = [w for x, w in seen if x == lang and len(seen[x, w]) >= min_docs]
        sources = [s for x, s in groups if x == lang]
        n = {s: sum(count[lang, s, w] for w in kept) for s in sources}
        prob = lambda c, total: 1 + 10**9 * (c + 2) // (total + 2 * len(kept))
        mine = {w: prob(count[lang, source, w], n[source]) for w in kept}
        pairs = [(-sum(f(mine[w], prob(count[lang, s, w], n[s])) for w in kept), s.encode(), s) for s in sources if s != source]
        every = {w: prob(sum(count[lang, s, w] for s in sources), sum(n.values())) for w in kept}
        likely = [(-f(mine[w], every[w]), w.encode(), w) for w in kept if count[lang, source, w] and mine[w] > every[w]]
        for part, items in (("pair", sorted(pairs)), ("term", sorted(likely)[:top])):
            out |= {(lang, source, part, item, -v, k + 1) for k, (v, _, item) in enumerate(items)}
    return out


def diverged(df):
    return {(r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in df.collect()}


def test_divergence_matches_brute_force_over_several_tiles(spark):
    rng = np.random.default_rng(4)
    words = [f"{a}{b}é" for a in "abcdefghijklmnopqrst" for b in "abcdefghijklmnopq"]
    rows = []
    for s in range(20):
        own = rng.choice(words, 60)
        rows += [(i, "-".join(rng.choice(own if s else words, 40)), "en", f"s{s}") for i in range(20)]
    rows += [(1, "one two", "de", f"t{s}") for s in range(3)] + [(1, "lone " * 3, "fr", None)] * 12
    expected = brute_divergence(rows)
    assert len(expected) > 500
    assert diverged(divergence.source_divergence(docs(spark, rows), tile=8, strip=128)) == expected


def test_divergence_on_odd_rows(spark):
    long = "Alpha beta 42, " * 30_000
    rows = [(1, None, None, None), (2, "", "en", ""), (None, long, "en", "a"), (3, long, "en", "b"), (3, "ÀB àb \x00 alpha", "en", "b"), (4, "あい", "ja", "z")] + [(5, "alpha Beta", "en", "a")] * 12
    assert diverged(divergence.source_divergence(docs(spark, rows))) == brute_divergence(rows)
    assert divergence.source_divergence(docs(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("width", [1, 64, 100, divergence.STRIP])
def test_quadtrees_give_the_plain_sums(width):
    rng = np.random.default_rng(width)
    tiles = [np.where(rng.random((divergence.TILE, divergence.STRIP)) < share, rng.integers(1, 10**9, (divergence.TILE, divergence.STRIP)), 0) for share in (0.001, 0.1)]
    tiles[0][4:13] = 0
    for t in tiles:
        t[:, width:] = 0
        t[:, 70:90] = 0
    zeros = [rng.integers(1, 1000, divergence.TILE) for _ in tiles]
    full = [np.where(t > 0, t, z[:, None])[:, :width] for t, z in zip(tiles, zeros)]
    expected = np.array([[divergence.divergence(x, y).sum() for y in full[1]] for x in full[0]])
    assert (divergence.tile_sums(*tiles, *zeros, width) == expected).all()


# ---- what is stored ----

@pytest.mark.parametrize("name", ["op1_minhash_dedup", "op12_pivot_join"])
def test_nothing_stays_of_a_result_that_is_released(spark, sf_dir, name):
    root = Path(shared_dir(spark).removeprefix("file:"))
    files = lambda: {p for p in root.rglob("part-*")}
    before = files()
    result = QUERIES[name](spark, sf_dir)
    assert not [p for p in files() - before if "/llm/" in str(p)]
    assert result.count() > 0
    del result
    for _ in range(20):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)
        if not files() - before:
            break
    assert not files() - before
