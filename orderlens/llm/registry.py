"""The registered queries of this subpackage and, where SQL expresses them, their DuckDB SQL."""

from __future__ import annotations

from orderlens.llm import ann, bpe, divergence, licenses, minhash, mixing, pii, pivot_join, quality, spelling, token_count, topk, warc
from orderlens.llm.common import table
from orderlens.llm.oracles import ORACLES  # noqa: F401

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_minhash_dedup(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).drop("set_id")


@query
def op2_quality(spark, sf_dir):
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_bpe_round_trip(spark, sf_dir):
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"))


@query
def op4_token_counts(spark, sf_dir):
    return token_count.count_tokens(table(spark, sf_dir, "documents"))


@query
def op5_warc(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query
def op6_pii(spark, sf_dir):
    return pii.pii_counts(table(spark, sf_dir, "documents"))


@query
def op7_mixing(spark, sf_dir):
    return mixing.taken_words(table(spark, sf_dir, "documents")).drop("source")


@query
def op8_top_k(spark, sf_dir):
    return topk.search(table(spark, sf_dir, "embeddings"))


@query
def op9_licenses(spark, sf_dir):
    return licenses.license_report(table(spark, sf_dir, "documents"))


@query
def op10_prefix_forest(spark, sf_dir):
    return ann.search(table(spark, sf_dir, "embeddings"))


@query
def op11_spelling(spark, sf_dir):
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


@query
def op12_pivot_join(spark, sf_dir):
    return pivot_join.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


@query
def op13_divergence(spark, sf_dir):
    return divergence.source_divergence(table(spark, sf_dir, "documents"))
