"""The corpus pipeline: quality classifier, near-dedup, PII, mixing, BPE, each on what the last one kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame,
which ``run`` writes as Parquet to the shared folder and reads again as the next stage's docs.  All
but the last stage return the columns of ``documents``.

What a stage has written goes as soon as the next one is written, and each stage removes the tables of its own; the
result, a narrow row for each document that the mix takes, is a checkpoint.

Cases: null texts count as empty in every stage; rows without an id pass near-dedup and have a draw of their own in the
mix; rows that repeat id and words are near duplicates, of which one stays; very long texts are read whole; an empty
table gives an empty result; further columns of ``documents``, whatever their names, are carried to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderlens.llm import bpe, minhash, mixing, pii, quality
from orderlens.llm.common import remove, scratch, settled, table, workspace


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return minhash.drop_near_duplicates(docs)


def mask(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind; every document stays."""
    return pii.mask_pii(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of the sources takes it."""
    return mixing.mix(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids' count and digest of each row, and the digest of what they decode to."""
    return bpe.round_trip_digests(docs)


STAGES = [
    ("quality", good),
    ("near-dedup", distinct),
    ("pii", mask),
    ("mixing", mix),
    ("bpe", tokenize),
]

#: the stages on signatures and fitted rules aren't SQL; tests hold the run against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    with workspace(spark):
        last = None
        for name, stage in STAGES[:-1]:
            path = scratch(spark, f"pipeline-{name}")
            kept = stage(spark, docs, sf_dir)
            kept.write.parquet(path)
            docs = spark.read.schema(kept.schema).parquet(path)
            if last:
                remove(spark, last)
            last = path
        return settled(STAGES[-1][1](spark, docs, sf_dir))
