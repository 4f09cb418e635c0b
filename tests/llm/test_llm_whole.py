"""Cases where an operator once did less than the whole job."""

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet
import pytest

from oracle_compare import compare
from orderlens.llm import ann, blocks, licenses, minhash, pii, topk
from orderlens.llm.common import table
from orderlens.llm.registry import ORACLES, QUERIES

MIDDLE = "/root/testdata/sf0.01"

# the license notices of the given documents, copied from them and not from the operator's tables
NOTICES = {
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    "All rights reserved.": "Proprietary",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "Released under the MIT License.": "MIT",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
}


def test_every_notice_of_the_documents_is_reported(spark):
    texts = {r.doc_id: r.text or "" for r in table(spark, MIDDLE, "documents").collect()}
    found = {r.doc_id: r for r in QUERIES["op9_licenses"](spark, MIDDLE).collect()}
    expected = {i: {name for notice, name in NOTICES.items() if notice in t} for i, t in texts.items()}
    assert set.union(*expected.values()) == set(NOTICES.values())
    assert {i: set(filter(None, r.licenses.split(","))) for i, r in found.items()} == expected


def test_all_rights_reserved(spark):
    grant = "Redistribution and use in source and binary forms, with or without modification, are permitted:\n1. Redistributions of source code must retain the above copyright notice.\n2. Redistributions in binary form must reproduce the above copyright notice.\n"
    cases = {
        "Some prose.\nALL RIGHTS\n  RESERVED": "Proprietary",
        "Copyright (c) 2001, X. All rights reserved.\n\n" + grant: "BSD-2-Clause",
        grant + "Copyright X, all rights reserved.": "BSD-2-Clause,Proprietary",
        "All rights reserved. Released under the MIT License.": "MIT,Proprietary",
        "All rights are reserved seats.": "",
    }
    docs = spark.createDataFrame(list(enumerate(cases)), "doc_id int, text string")
    found = [",".join(sorted(r.licenses.split(","))) for r in sorted(licenses.license_report(docs).collect())]
    assert found == list(cases.values())


SSN, IBAN = "123-45-6789", "GB82 WEST 1234 5698 7654 32"
CUED = [
    ("Social Security Number: ", "ssn", SSN),
    ("SOCIAL SECURITY ", "ssn", SSN),
    ("SSN Number ", "ssn", SSN),
    ("sSn NO. IS ", "ssn", SSN),
    ("ssn is ", "ssn", SSN),
    ("\u0130\u0130 Social Security: ", "ssn", SSN),  # two letters each in lower case
    ("iBAN Number: ", "iban", IBAN),
    ("IBAN IS ", "iban", IBAN),
    ("IBAN ", "iban", "IS14 0159 2600 7654 5510 7303 39"),
]


@pytest.mark.parametrize("cue, kind, value", CUED)
def test_cues_in_any_case(cue, kind, value):
    text = f"{cue}{value}, then more"
    spans = [s for s in pii.find(text) if s[0] == kind]
    assert spans == [(kind, len(cue), len(cue) + len(value))]
    assert value not in pii.masked(text, pii.find(text))


def repeated_ids(spark, tmp_path):
    """Ids that repeat with other vectors, with the same one, and as queries."""
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(4).tolist()) for i in [*range(120), *[50] * 4, *[100] * 20, *[7] * 30, *[8, 9, 9, 9]]]
    rows += [(60, [3.0, 3.0, 3.0, 3.0])] * 9 + [(0, [1.0, 1.0, 1.0, 1.0])] * 12
    path = str(tmp_path / "embeddings.parquet")
    spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3).write.parquet(path)
    return rows, path


@pytest.mark.parametrize("block", [16, 4096])
def test_top_k_of_repeated_ids_matches_sql(spark, tmp_path, block):
    _, path = repeated_ids(spark, tmp_path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{path}/*.parquet')")
    rows = blocks.valid_vectors(spark.read.parquet(path))
    r = compare(topk.top_k(rows, rows.where("id % 50 = 0"), block=block), con, ORACLES["op8_top_k"])
    assert r["match"], r


@pytest.mark.parametrize("block", [16, 4096])
def test_forest_on_repeated_ids(spark, tmp_path, block):
    rows, path = repeated_ids(spark, tmp_path)
    valid = blocks.valid_vectors(spark.read.parquet(path), nonzero=True)
    found = [(r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in ann.nearest(valid, valid.where("id % 50 = 0"), effort=64, block=block).collect()]
    expected = []
    for q in (0, 50, 100):
        pairs = [(np.linalg.norm(np.array(a) - np.array(b)), j) for i, a in rows if i == q for j, b in rows if j != q]
        expected += [(q, n + 1, j, round(float(d), 9)) for n, (d, j) in enumerate(sorted(pairs)[:10])]
    assert sorted(found) == expected
    # little effort: the rows of the query's own id don't stand for others
    few = ann.nearest(valid, valid.where("id = 100").limit(1), effort=0.0, block=4096)
    assert few.count() == 10


def test_a_set_once_for_a_repeated_id(spark):
    words = [f"w{i}" for i in range(100)]
    near, other = " ".join([*words[:99], "x"]), " ".join(words[::-1])
    rows = [(1, " ".join(words))] * 40 + [(1, other)] * 10 + [(2, near)] * 20 + [(3, other)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    wanted = minhash.fingerprints(docs).groupBy("set_id").agg({"doc_id": "min"}).toDF("set_id", "rep")
    sets = minhash._full_sets(docs, wanted, "text", "doc_id").collect()
    assert len(sets) == 3 and {bytes(r.set_id) for r in sets} == {bytes(r.set_id) for r in wanted.collect()}
    assert all(minhash.set_digest(np.frombuffer(r.elements, np.uint64)) == r.set_id for r in sets)
    found = minhash.near_duplicates(docs).collect()
    assert len(found) == len(rows) and {(r.doc_id, r.component_id) for r in found} == {(1, 1), (2, 1), (3, 1)}


LARGE = "/root/testdata/sf0.1"


def recall(rows, every):
    """The share of the ten nearest rows that is found for every so many rows, at the operator's own setting."""
    known = {r.id: r.vec for r in rows.collect()}
    ids = np.array(sorted(known))
    matrix = np.array([known[i] for i in ids], float)
    found = {}
    for r in ann.nearest(rows, rows.where(f"id % {every} = 0")).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    assert set(found) == {int(i) for i in ids if i % every == 0}
    hits = 0
    for q, near in found.items():
        distance = ((matrix - known[q]) ** 2).sum(axis=1)
        order = [int(i) for i in ids[np.lexsort((ids, distance))] if i != q][:10]
        hits += len(near & set(order))
    return hits / (10 * len(found)), len(ids), len(found)


def test_forest_recall_on_the_large_table(spark):
    share, rows, queries = recall(blocks.valid_vectors(table(spark, LARGE, "embeddings"), nonzero=True), 10)
    print(f"recall {share:.4f}, {rows} rows, {queries} queries")
    assert queries >= 200 and share >= 0.9


def test_forest_recall_over_blocks_with_a_crowd(spark, tmp_path):
    rng = np.random.default_rng(11)
    matrix = rng.standard_normal((10_000, 64))
    matrix[::3] = rng.standard_normal(64) + 0.01 * rng.standard_normal((3_334, 64))
    path = str(tmp_path / "vectors.parquet")
    pa.parquet.write_table(pa.table({"vec_id": np.arange(10_000), "embedding": list(matrix)}), path)
    share, rows, queries = recall(blocks.valid_vectors(spark.read.parquet(path), nonzero=True), 50)
    print(f"recall {share:.4f}, {rows} rows, {queries} queries")
    assert rows > 2 * blocks.BLOCK and share >= 0.9
