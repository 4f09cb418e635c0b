"""Scores, draws and archives recomputed in plain Python, and the pipeline on odd rows."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

from orderlens.llm import minhash, mixing, quality, warc
from orderlens.llm.common import table
from orderlens.llm.registry import ORACLES, QUERIES

MIDDLE = "/root/testdata/sf0.01"
PAGES = "page_id bigint, url string, html string"


# ---- quality: the score from the rules, in plain Python ----

def plain_statistics(text):
    n = len(text)
    words = len(re.findall(r"[^\x20\x09-\x0D]+", text))
    share = lambda count: count / n if n else 0.0
    unlike = lambda parts: len(set(parts)) / len(parts) if n else 0.0
    symbols = regex.findall(r"""[^\p{L}\p{M}\p{N} \t\n\x0b\f\r.,;:?'"()\-]""", text)
    return {
        "log_words": math.log1p(words),
        "word_length": n / words if words else 0.0,
        "upper": share(len(regex.findall(r"\p{Lu}", text))),
        "digits": share(len(re.findall("[0-9]", text))),
        "stops": share(len(re.findall("[.,;:?]", text))),
        "symbols": share(len(symbols)),
        "distinct_words": unlike(re.split("[ \n]", text)),
        "distinct_lines": unlike(text.split("\n")),
    }


def test_scores_follow_the_rules(spark):
    docs = table(spark, MIDDLE, "documents")
    model = quality.fit(docs.select("doc_id", "text"), table(spark, MIDDLE, "labels"))
    assert len(model.weights) >= 3
    found = {r.doc_id: r.score for r in quality.score(docs, model).select("doc_id", "score").collect()}
    for r in docs.collect():
        values = plain_statistics(r.text or "")
        total = model.intercept
        for rule, weight in model.weights:
            if all((a is None or values[k] > a) and (b is None or values[k] <= b) for k, a, b in rule.bounds):
                total += weight
        assert found[r.doc_id] == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-9), r.doc_id


def test_rejecting_computes_each_statistic_once(spark):
    docs, labels = table(spark, MIDDLE, "documents"), table(spark, MIDDLE, "labels")
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    model = quality.fit(docs.select("doc_id", "text"), labels)
    once = plan(quality.score(docs, model)).count("array_distinct")
    assert once and plan(quality.keep_good(docs, labels)).count("array_distinct") == once


# ---- mixing: each source near its target, whatever the ids ----

@pytest.mark.parametrize("ids", ["unique", "null", "one"])
def test_each_source_comes_near_its_target(spark, ids):
    rng = np.random.default_rng(7)
    rows = [(i, " ".join(["w"] * int(rng.integers(20, 60))) + f" {i}", f"s{i % 3}") for i in range(3000)]
    if ids != "unique":
        rows = [(None if ids == "null" else 5, t, s) if i % 3 == 1 and i < 2990 else (i, t, s) for i, t, s in rows]
    found = mixing.taken_words(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    taken, target = Counter(), {}
    for r in found:
        taken[r.source] += r.taken
        target[r.source] = r.target
    # a rate of a half over 1,000 documents: a standard deviation of 3 %
    assert all(taken[s] == pytest.approx(t, rel=0.1) for s, t in target.items()), (taken, target)


def test_the_mix_takes_what_is_said_of_repeated_rows(spark):
    """Rows of equal id and text, some with other columns, in ranges of places."""
    rows = [(1, "a b c", "x", n) for n in [1] * 5000 + [2] * 700] + [(None, "a b c", "x", 1)] * 300 + [(i, "d e", "y", 1) for i in range(2000)] + [(9, None, "y", 1)] * 4
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang int")
    said = defaultdict(int)
    for r in mixing.taken_words(docs).collect():
        said[r.doc_id, r.source] += r.taken
    mixed = Counter((r.doc_id, r.text, r.source, r.lang) for r in mixing.mix(docs).collect())
    words = defaultdict(int)
    for (i, t, s, _), n in mixed.items():
        words[i, s] += n * len((t or "").split())
    assert {k: v for k, v in said.items() if v} == {k: v for k, v in words.items() if v}
    assert mixed == Counter((r.doc_id, r.text, r.source, r.lang) for r in mixing.mix(docs.repartition(7)).collect())
    # 5,700 rows of one id and text draw apart
    rate = mixing.source_rates(mixing.document_sizes(docs)).where("source = 'x'").first().rate
    assert (mixed[1, "a b c", "x", 1] + mixed[1, "a b c", "x", 2]) / 5700 == pytest.approx(rate, rel=0.05)


# ---- WARC ----

def by_sql(pages):
    con = duckdb.connect()
    con.register("pages", pages.toPandas())
    return Counter(con.execute(f"SELECT page_id, payload_bytes, payload_digest, record_type, refers_to FROM ({ORACLES['op5_warc']})").fetchall())


def clean(rows):
    return Counter(tuple(None if x != x else int(x) if isinstance(x, float) else x for x in r) for r in rows.elements())


def test_archives_of_null_sparse_and_repeated_ids_match_sql(spark):
    rows = [(None, "u", "alone"), (None, "u", "alone"), (None, "u", "five"), (5, "u", "five"), (5, "u", "five"), (5, "v", "five"), (2**62, "u", "far"), (-(2**62), "u", "far"), (-1, "u", ""), (0, "u", None)]
    rows += [(10**9 * i, f"http://h/{i}", f"page {i % 50}") for i in range(1, 200)]
    pages = spark.createDataFrame(rows, PAGES).repartition(5)
    found = Counter(tuple(r) for r in warc.round_trip(pages).collect())
    assert clean(found) == clean(by_sql(pages))


def test_records_have_ids_of_their_own_and_refer_to_responses(spark, tmp_path):
    rows = [(i % 7 if i % 5 else None, f"u{i % 3}", f"t{i % 4}") for i in range(400)]
    warc.write_archives(spark.createDataFrame(rows, PAGES), str(tmp_path), shard_bytes=20_000, roll=2_000)
    read = warc.read_archives(spark, str(tmp_path)).collect()
    assert len(read) == 400 and len({r.record_id for r in read}) == 400
    responses, referred = {r.record_id for r in read if r.record_type == "response"}, set()
    for path in (tmp_path / "archives").iterdir():
        for record in warc.members(path.read_bytes()):
            referred.add(warc.parse(record)[0].get("WARC-Refers-To"))
    assert referred - {None} and referred - {None} <= responses


def test_a_hot_id_is_written_by_many_tasks(spark, tmp_path):
    """A third of the pages without an id, a third under one id: shards stay bounded; sparse ids share archives."""
    rows = [(None, "u", f"{i} " + "x" * 500) for i in range(600)] + [(7, "u", f"{i} " + "y" * 500) for i in range(300)]
    rows += [(8, "u", "z" * 500)] * 300 + [(10**12 * i, "u", f"{i} " + "w" * 500) for i in range(1, 600)]
    pages = spark.createDataFrame(rows, PAGES)
    runs = []
    for n in (1, 6):
        manifest = warc.write_archives(pages.repartition(n), str(tmp_path / str(n)), shard_bytes=100_000, roll=1 << 20)
        runs.append(sorted((r["name"], r.records, r.sha256, r.first_key) for r in manifest.collect()))
    assert runs[0] == runs[1]
    records = [r[1] for r in runs[0]]
    assert sum(records) == len(rows) and 12 <= len(records) <= 30
    # a range of equal records goes together
    assert max(records) <= 100_000 // 512 + warc.RANGE


def test_the_writer_keeps_three_tables(spark, tmp_path, monkeypatch):
    """Each stored table is a file or more for every shuffle partition, and memory for the task that writes it."""
    kept, stored = [], warc.stored
    monkeypatch.setattr(warc, "stored", lambda df, what: kept.append(what) or stored(df, what))
    rows = [(1, "u", "a"), (1, "u", "a"), (2, "v", "a"), (None, "w", "a"), (3, "u", None)] + [(i, "u", f"p{i}") for i in range(4, 20)]
    warc.write_archives(spark.createDataFrame(rows, PAGES), str(tmp_path))
    assert kept == ["warc-ranges", "warc-ranged", "warc-staged"]
    read = Counter((r.page_id, r.record_type, r.refers_to, r.payload) for r in warc.read_archives(spark, str(tmp_path)).collect())
    plain = [(3, "response", None, ""), *[(i, "response", None, f"p{i}") for i in range(4, 20)]]
    assert read == Counter([(1, "revisit", 2, None)] * 2 + [(2, "response", None, "a"), (None, "revisit", 2, None)] + plain)


def test_long_payloads_are_passed_on_few_at_a_time(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", f"{i} " + "x" * 500_000) for i in range(40)], PAGES)
    manifest = warc.write_archives(pages, str(tmp_path)).select("name", "bytes", "sha256").toArrow()
    batches = list(warc._read(iter(manifest.to_batches()), str(tmp_path)))
    assert sum(b.num_rows for b in batches) == 40
    assert max(sum(b.column("payload_bytes").to_pylist()) for b in batches) <= warc._PASSED_BYTES + 500_100
    # and so are rows that become Python objects
    whole = batches[0].slice(0, 1).to_pylist() * 1000
    few = list(warc._sliced(iter([pa.RecordBatch.from_pylist(whole)])))
    assert sum(b.num_rows for b in few) == 1000 and max(b.num_rows for b in few) <= 64


def test_only_the_manifests_files_are_read(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", f"p{i}") for i in range(50)], PAGES)
    manifest = warc.write_archives(pages, str(tmp_path))
    (tmp_path / "archives" / "shard-99999-00000.warc.gz").write_bytes(warc.info_record("x") + warc.page_record(1, "u", b"stray"))
    assert warc.read_archives(spark, str(tmp_path)).count() == 50
    name = manifest.first()["name"]
    whole = (tmp_path / "archives" / name).read_bytes()
    (tmp_path / "archives" / name).write_bytes(whole[:-1] + b"x")
    with pytest.raises(Exception, match="isn't what the manifest says"):
        warc.read_archives(spark, str(tmp_path)).count()


def test_unknown_schemes_are_named():
    with pytest.raises(ValueError, match="a path or one of file:, s3:, gs:, hdfs:"):
        warc._filesystem("ftp2://host/folder")


# ---- near-dedup ----

def test_every_pair_of_a_bucket_can_be_verified(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    of = lambda **kw: {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, **kw).collect()}
    assert of(matches=0, block=64, set_block=16) == of()


# ---- pipeline ----

def write(spark, folder, docs):
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(i, i % 2, 0) for i in range(40)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def test_pipeline_on_odd_rows(spark, tmp_path):
    """Nulls, empty and very long texts, repeated rows, and columns that the stages use themselves."""
    import corpus_pipeline

    plain = "Some words that make a sentence number {}, and {} more words that follow it here. "
    rows = [(i, plain.format(i, i * i) * (3 if i % 2 else 1), "en", f"s{i % 2}") for i in range(40)]
    rows += [rows[3]] * 5 + [(None, rows[5][1], "en", None), (None, None, None, None), (60, "", "en", "s1"), (61, "word " * 100_000, "en", "s1"), (62, None, "en", "s0")]
    docs = spark.createDataFrame([(*r, 0, 1.0, 2, "t") for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, rate int, set_id string")
    write(spark, tmp_path, docs)
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in found} <= {r[0] for r in rows}
    # a repeated row passes near-dedup once
    assert Counter(r.doc_id for r in found)[3] <= 3
    empty = hashlib.sha256(b"").hexdigest()
    assert all((r.n_tokens == 0) == (r.decoded_sha256 == empty) for r in found)


def test_pipeline_on_empty_tables(spark, tmp_path):
    import corpus_pipeline

    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    write(spark, tmp_path, docs)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_nothing_stays_of_a_run(spark, sf_dir):
    from pathlib import Path

    import corpus_pipeline
    from orderlens.session import shared_dir

    folder = Path(shared_dir(spark).removeprefix("file:")) / "llm"
    before = set(folder.rglob("part-*"))
    assert corpus_pipeline.run(spark, sf_dir).where(F.col("n_tokens") >= 0).count()
    assert not set(folder.rglob("part-*")) - before
    QUERIES["op5_warc"](spark, sf_dir).count()
    assert not set(folder.rglob("*.parquet")) - before and not list(folder.rglob("*.warc.gz"))


# ---- searches ----

def test_blocks_grow_before_there_are_many():
    from orderlens.llm.blocks import block_count

    assert [block_count(n) for n in (0, 1, 4096, 4097, 64 * 4096, 64 * 4096 + 1, 64 * 65_536, 10**9)] == [1, 1, 1, 2, 64, 64, 64, -(-(10**9) // 65_536)]


def test_a_cutoff_from_some_blocks_keeps_the_top_exact(spark):
    from orderlens.llm import topk

    rng = np.random.default_rng(9)
    vectors = rng.standard_normal((3000, 8))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id bigint, vec array<double>")
    scaled = np.floor(256 * vectors).astype(np.int64)
    found = topk.top_k(rows, rows.where("id % 100 = 0"), 5, block=100).collect()
    expected = set()
    for q in range(0, 3000, 100):
        order = sorted((-int(s), i) for i, s in enumerate(scaled @ scaled[q]) if i != q)[:5]
        expected |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(order)}
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in found} == expected
