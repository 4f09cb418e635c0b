"""Mixing sources to target weights, in DataFrame functions only.

The words of each source are summed, a repetition rate is derived per source, and each document
is emitted ``floor(rate)`` times plus one more time when a number falls below the fraction of the rate.
That number is hashed from the seed, the document's id and text, and its place among rows of equal id, source and
text, so that rows without an id, or with one id, draw on their own.  Reruns and recomputed partitions agree, and no
document depends on a different one.

Rows of equal id, source and text are counted by a map-side combined aggregate, never gathered: their places are
dealt out in ranges of ``RANGE``, whatever their number.

Targets: the sources in code-point order (null last) weigh 1, 2, 3, 1, 2, 3, ... (or as the caller
gives) and share all words by weight.  A target stops at ``max_rate`` times its source's size; the
excess goes to the others by weight until none is above.  That fixed point is found in one pass
over the sources ordered by ``size / weight``: a source is capped if its cap lies below its share
of what the sources before it leave.  These windows sort the sources in one task: narrow rows that
spill, one for each source, whose number is taken to be far below that of the documents.

Cases: a null text has size 0; a null source is a source of its own; a source without words has
target and rate 0 and keeps nothing; repeated rows are documents of their own; very long texts are read whole;
an empty table gives an empty result; columns with the names used here are kept as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import fresh, hash_fraction, settled, small, stored, word_count, workspace

WEIGHTS = (1, 2, 3)
MAX_RATE = 3
SEED = "mix-1"
#: places of equal rows that are dealt out together
RANGE = 4096


def text_digest(text: Column) -> Column:
    return F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))


def document_sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, digest, size, n) for each id, source and text, of which there are ``n`` rows; the text is read a single time."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), text_digest(F.col(text_col)).alias("digest"), word_count(text_col).alias("size"))
    return stored(rows.groupBy("doc_id", "source", "digest", "size").agg(F.count(F.lit(1)).alias("n")), "mix-sizes")


def source_rates(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_rate: int = MAX_RATE) -> DataFrame:
    """(source, source_size, weight, target, rate) per source of rows (source, size), or (source, size, n) for n rows each.

    The windows run over one row per source, after the map-side combined sum.
    """
    n = F.col("n") if "n" in sizes.columns else F.lit(1)
    by_source = sizes.groupBy("source").agg(F.sum(F.col("size") * n).alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weighed = by_source.withColumn(
        "weight", F.element_at(F.array(*[F.lit(w) for w in weights]), ((rank - 1) % len(weights) + 1).cast("int"))
    ).withColumn("cap", F.col("source_size") * max_rate)

    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weight_left = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = (F.sum("source_size").over(every) - before) / weight_left
    levelled = weighed.withColumn("_level", level)
    # the first source whose cap isn't below its share sets the common level of all later ones; from
    # there on, taking out a source that needs no cap only lowers the level, so that it's the largest
    open_level = F.max(F.when(F.col("cap") >= F.col("_level") * F.col("weight"), F.col("_level"))).over(every)
    share = open_level * F.col("weight")
    capped = F.col("cap") < share
    target = F.when(capped, F.col("cap").cast("double")).otherwise(share)
    rate = (
        F.when(F.col("source_size") == 0, F.lit(0.0))
        .when(F.col("target") >= F.col("cap"), F.lit(float(max_rate)))
        .otherwise(F.col("target") / F.col("source_size"))
    )
    return stored(
        levelled.withColumn("target", target)
        .withColumn("rate", rate)
        .select("source", F.col("source_size").cast("long").alias("source_size"), "weight", "target", "rate"),
        "mix-rates",
    )


def copies(rate: Column, doc_id: Column, digest: Column, place: Column, seed: str = SEED) -> Column:
    """floor(rate), plus one with a probability of the fraction, decided by a hash; ``place``: among equal rows, from 0."""
    whole = F.floor(rate)
    extra = (hash_fraction(F.lit(seed), doc_id, digest, place) < rate - whole).cast("long")
    return (whole + extra).cast("long")


def _ranges(n: Column) -> Column:
    """The first place of each range of ``n`` equal rows."""
    return F.sequence(F.lit(0).cast("long"), n - 1, F.lit(RANGE).cast("long"))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    max_rate: int = MAX_RATE,
    seed: str = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The mixed corpus: every column of ``docs``, each row as often as the mix takes it."""
    with workspace(docs.sparkSession):
        sizes = document_sizes(docs, id_col, text_col, source_col)
        rates = settled(source_rates(sizes, weights, max_rate).select("source", "rate"))
        repeated = settled(sizes.where("n > 1").select("doc_id", "source", "digest"))
    key, rate, digest, copy, *again = fresh(docs, "_mix_source", "_mix_rate", "_mix_digest", "_mix_copy", "_mix_n", "_mix_first", "_mix_at", "_mix_id", "_mix_hash")
    n, first, at, same_id, row_hash = again
    rates = rates.select(F.col("source").alias(key), F.col("rate").alias(rate))
    joined = docs.join(small(rates, 64), docs[source_col].eqNullSafe(rates[key]), "inner").drop(key)
    joined = joined.withColumn(digest, text_digest(F.col(text_col)))
    if repeated.isEmpty():
        single, many = joined, None
    else:
        named = repeated.select(F.col("doc_id").alias(same_id), F.col("source").alias(key), F.col("digest").alias(f"{digest}_2"))
        on = joined[id_col].eqNullSafe(named[same_id]) & joined[source_col].eqNullSafe(named[key]) & (joined[digest] == named[f"{digest}_2"])
        single, many = joined.join(small(named, 64), on, "left_anti"), joined.join(small(named, 64), on, "left_semi")
    times = copies(F.col(rate), F.col(id_col), F.col(digest), F.lit(0), seed)
    out = single.withColumn(copy, F.explode(F.array_repeat(F.lit(1), times.cast("int")))).select(*[F.col(f"`{c}`") for c in docs.columns])
    if many is None:
        return out
    # equal rows become one with their number; rows of equal id, source and text that differ elsewhere follow each other
    counted = many.groupBy(*[F.col(f"`{c}`") for c in many.columns]).agg(F.count(F.lit(1)).alias(n))
    counted = counted.withColumn(row_hash, F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    before = Window.partitionBy(id_col, source_col, digest).orderBy(row_hash).rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn(first, F.coalesce(F.sum(n).over(before), F.lit(0))).withColumn(at, F.explode(_ranges(F.col(n))))
    each = F.sequence(F.col(first) + F.col(at), F.col(first) + F.least(F.col(at) + RANGE, F.col(n)) - 1)
    total = F.aggregate(each, F.lit(0).cast("long"), lambda sum_, place: sum_ + copies(F.col(rate), F.col(id_col), F.col(digest), place, seed))
    dealt = placed.withColumn(copy, total.cast("int")).repartition(F.xxhash64(F.col(row_hash), F.col(at)))
    return out.unionByName(dealt.withColumn(copy, F.explode(F.array_repeat(F.lit(1), F.col(copy)))).select(*[F.col(f"`{c}`") for c in docs.columns]))


def taken_words(docs: DataFrame) -> DataFrame:
    """What the mix takes of each document: (doc_id, source, size, source_size, target, taken)."""
    with workspace(docs.sparkSession):
        sizes = document_sizes(docs)
        rates = source_rates(sizes)
        joined = sizes.alias("d").join(small(rates, 64).alias("r"), F.col("d.source").eqNullSafe(F.col("r.source")), "inner")
        ranged = joined.select("d.*", "r.source_size", "r.target", "r.rate", F.explode(_ranges(F.col("d.n"))).alias("first"))
        placed = ranged.withColumn("place", F.explode(F.sequence("first", F.least(F.col("first") + RANGE, F.col("n")) - 1)))
        times = copies(F.col("rate"), F.col("doc_id"), F.col("digest"), F.col("place"))
        return settled(placed.select("doc_id", "source", "size", "source_size", "target", (times * F.col("size")).alias("taken")))
