"""Source divergence audit: how far the words of each source are from those of its language's other sources.

The counts of a language's terms form a matrix, a row for each (lang, source) group and a column for each kept term.  Most
of it is zero, and a zero's probability depends on the group alone.

1. Terms are counted per group, and per language the documents that hold them, in one pass: tasks pre-aggregate
   their documents, so a group of any size is a row for each task and term.
2. Terms in at least ``MIN_DOCS`` documents of their language are kept and numbered, the commonest first, so that the
   nonzero cells lie together.  The matrix is cut into tiles of ``TILE`` groups and strips of ``STRIP`` terms.
3. For each pair of tiles and each strip, a task builds the quadtrees of both tiles, whose nodes tell whether a
   quadrant holds a nonzero cell, and descends in both at once: ``(rows, other rows, columns)``.  Where both quadrants
   are all zero, every pair of their groups gets the price of a zero cell times the quadrant's columns; leaves with a
   nonzero cell are computed cell by cell.
4. The strips' sums are added for each pair of groups.

All arithmetic is in integers.  Probabilities are made in decimals of 38 digits; a squared difference of two fits 64 bits.

Cases: null text, lang and source are empty strings; a group without terms, or a language without kept terms, still has its pairs (with the
value that two groups without counts have; 0 if there is no kept term); a language with one source has no pairs; very long texts are
read whole; repeated rows are documents of their own; an empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import settled, small, stored, workspace

MIN_DOCS, TOP = 10, 10
SCALE = 1_000_000_000
#: groups of a tile, terms of a strip, and groups and terms of a leaf; powers of two
TILE, STRIP, LEAF_GROUPS, LEAF_TERMS = 32, 8192, 4, 64
#: terms of documents that a task counts before it passes the counts on
HELD = 1 << 19
#: pairs of leaves that are computed together
PAIRS = 512

#: ASCII letters in lower case, every other ASCII character a blank; the bytes of other characters stay
_LETTERS = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def terms(text: str) -> list[bytes]:
    """The terms of a text in UTF-8: runs of ASCII letters, lower-cased, and characters beyond ASCII."""
    return text.encode().translate(_LETTERS).split()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) of the documents (lang, source, text) so far, whenever many have come together."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            if n:
                words = pa.array(list(n), pa.binary()).cast(pa.string())
                same = [pa.array([x] * len(n), pa.string()) for x in (lang, source)]
                counts = [pa.array(list(n.values()), pa.int64()), pa.array([docs[w] for w in n], pa.int64())]
                yield pa.RecordBatch.from_arrays([*same, words, *counts], ["lang", "source", "term", "n", "docs"])
        held.clear()

    for batch in batches:
        for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            words = terms(text)
            n.update(words)
            once = set(words)
            docs.update(once)
            size += len(once)
            if size > HELD:
                yield from flush()
                size = 0
    yield from flush()


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)) of positive integers."""
    d = p - q
    return d * d // (p + q)


def tree(nonzero: np.ndarray) -> list[np.ndarray]:
    """The levels of the quadtree over a boolean matrix of leaves, from the leaves up to the root.

    A level has half the rows and columns of the one below; an axis that has come down to one stays.
    """
    levels = [nonzero]
    while levels[-1].size > 1:
        x = levels[-1]
        r, c = (2 if n > 1 else 1 for n in x.shape)
        levels.append(x.reshape(x.shape[0] // r, r, x.shape[1] // c, c).any(axis=(1, 3)))
    return levels


def _leaves(cells: np.ndarray) -> np.ndarray:
    """Whether each leaf of a tile, a matrix of probabilities with 0 for a zero cell, holds a nonzero cell."""
    g, t = cells.shape
    return (cells > 0).reshape(g // LEAF_GROUPS, LEAF_GROUPS, t // LEAF_TERMS, LEAF_TERMS).any(axis=(1, 3))


def tile_sums(a: np.ndarray, b: np.ndarray, zero_a: np.ndarray, zero_b: np.ndarray, width: int) -> np.ndarray:
    """Sums of the divergence over the first ``width`` terms, for each pair of groups of two tiles.

    ``a`` and ``b``: probabilities by group and term, 0 for a zero cell, whose probability is in ``zero_a`` and ``zero_b``.
    """
    sums = np.zeros((len(a), len(b)), np.int64)
    trees = tree(_leaves(a)), tree(_leaves(b))
    #: columns of all-zero quadrants, for each pair of leaves' groups
    priced = np.zeros((len(a) // LEAF_GROUPS, len(b) // LEAF_GROUPS), np.int64)
    frontier = np.zeros((1, 3), np.int64)  # (quadrant's row in a, in b, column)
    for level in range(len(trees[0]) - 1, -1, -1):
        ta, tb = trees[0][level], trees[1][level]
        i, j, c = frontier.T
        open_ = ta[i, c] | tb[j, c]
        tall, wide = priced.shape[0] // ta.shape[0], a.shape[1] // ta.shape[1]
        z = frontier[~open_]
        columns = np.clip(width - z[:, 2] * wide, 0, wide)
        for x, y, n in zip(z[:, 0] * tall, z[:, 1] * tall, columns):
            if n:
                priced[x : x + tall, y : y + tall] += n
        frontier = frontier[open_ & (c * wide < width)]
        if not level or not len(frontier):
            break
        below = trees[0][level - 1].shape
        r, k = below[0] // ta.shape[0], below[1] // ta.shape[1]
        steps = np.array([(x, y, z) for x in range(r) for y in range(r) for z in range(k)])
        frontier = (frontier[:, None, :] * (r, r, k) + steps).reshape(-1, 3)
    zeros = divergence(zero_a[:, None], zero_b[None, :])
    sums += np.repeat(np.repeat(priced, LEAF_GROUPS, 0), LEAF_GROUPS, 1) * zeros
    # the leaves, those of one column at a time
    full_a, full_b = np.where(a > 0, a, zero_a[:, None]), np.where(b > 0, b, zero_b[:, None])
    ra, rb = (x.reshape(-1, LEAF_GROUPS, x.shape[1]) for x in (full_a, full_b))
    blocks = sums.reshape(len(ra), LEAF_GROUPS, len(rb), LEAF_GROUPS).transpose(0, 2, 1, 3)
    order = frontier[np.argsort(frontier[:, 2], kind="stable")]
    for c in np.unique(order[:, 2]):
        at = slice(c * LEAF_TERMS, min((c + 1) * LEAF_TERMS, width))
        i, j = order[order[:, 2] == c, :2].T
        for s in range(0, len(i), PAIRS):
            x, y = i[s : s + PAIRS], j[s : s + PAIRS]
            # the pairs (x, y) of a column differ, so that each block is met once
            blocks[x, y] += divergence(ra[x, :, None, at], rb[y, None, :, at]).sum(axis=3)
    return sums


def _strips(batches: Iterator[pa.RecordBatch], tile_groups: int, strip_terms: int) -> Iterator[pa.RecordBatch]:
    """Sorted cells (lang, ta, tb, strip, side, g, zero, t, p, width) -> (lang, ga, gb, value) of each strip of a pair of tiles.

    A group's row with t = -1 only names it.  Side 0 is tile ``ta``, side 1 tile ``tb``; a tile meets itself on side 0 alone.
    """
    held, parts = None, []

    def close() -> Iterator[pa.RecordBatch]:
        lang, ta, tb, _ = held
        side, g, zero, t, p, width = (np.concatenate(c) for c in zip(*parts))
        tiles, zeros, present = [], [], []
        for k, tile in ((0, ta), (1, tb)) if ta != tb else ((0, ta),):
            mine = side == k
            cells, none, here = np.zeros((tile_groups, strip_terms), np.int64), np.ones(tile_groups, np.int64), np.zeros(tile_groups, bool)
            row = g[mine] - tile * tile_groups
            none[row], here[row] = zero[mine], True
            some = t[mine] >= 0
            cells[row[some], t[mine][some] % strip_terms] = p[mine][some]
            tiles.append(cells)
            zeros.append(none)
            present.append(here)
        sums = tile_sums(tiles[0], tiles[-1], zeros[0], zeros[-1], int(width[0]))
        i, j = np.nonzero(present[0][:, None] & present[-1][None, :])
        if ta == tb:
            i, j = i[i < j], j[i < j]
        n = len(i)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * n, pa.string()), pa.array(i + ta * tile_groups, pa.int64()), pa.array(j + tb * tile_groups, pa.int64()), pa.array(sums[i, j], pa.int64())],
            ["lang", "ga", "gb", "value"],
        )

    for batch in batches:
        langs = batch.column(0).to_pylist()
        columns = [c.to_numpy() for c in batch.columns[1:]]
        change = [0, *(i for i in range(1, len(langs)) if langs[i] != langs[i - 1])]
        ties = np.zeros(len(langs), bool)
        ties[change] = True
        for c in columns[:3]:
            ties[1:] |= c[1:] != c[:-1]
        edges = [*np.flatnonzero(ties).tolist(), len(langs)] if langs else []
        for i, j in zip(edges, edges[1:]):
            key = (langs[i], *(int(c[i]) for c in columns[:3]))
            if key != held and parts:
                yield from close()
                parts = []
            held = key
            parts.append(tuple(c[i:j] for c in columns[3:]))
    if parts:
        yield from close()


def _probability(count: str, total: str, kept: str):
    """1 + floor(SCALE * (count + 2) / (total + 2 * kept)), exactly."""
    wide = lambda x: f"cast({x} as decimal(19, 0))"
    return F.expr(f"1 + (({wide(SCALE)} * ({wide(count)} + 2)) div ({wide(total)} + 2 * {wide(kept)}))").cast("long")


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, tile: int = TILE, strip: int = STRIP) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair``, an item for each other source of the language; part ``term``, the
    ``top`` terms that are likelier in the group than in its language.

    ``tile`` and ``strip``: groups of a tile and terms of a strip, powers of two."""
    with workspace(docs.sparkSession):
        text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
        rows = docs.select(text("lang").alias("lang"), text("source").alias("source"), text("text").alias("text"))
        counted = rows.mapInArrow(_counted, "lang string, source string, term string, n bigint, docs bigint")
        counts = stored(counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "divergence-counts")
        by_lang = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
        kept = stored(by_lang.where(F.col("docs") >= min_docs), "divergence-terms")
        cells = stored(counts.select("lang", "source", "term", "n").join(kept.select("lang", "term", "lang_n"), ["lang", "term"]), "divergence-cells")

        sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total"))
        totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        groups = rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
        groups = groups.na.fill(0, ["total", "kept", "lang_total"])
        # a row for each group of a language
        groups = groups.withColumn("g", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1)
        groups = stored(groups.withColumn("zero", F.when(F.col("kept") > 0, _probability("0", "total", "greatest(kept, 1)")).otherwise(F.lit(1))), "divergence-groups")

        with_p = cells.join(small(groups, 80), ["lang", "source"]).withColumn("p", _probability("n", "total", "kept"))
        priced = stored(
            with_p.withColumn("q", _probability("lang_n", "lang_total", "kept")).select("lang", "source", "g", "zero", "term", "p", "q"), "divergence-priced"
        )
        pairs = _pair_values(priced, groups, kept, tile, strip)
        names = groups.select("lang", F.col("g"), "source")
        pairs = pairs.join(small(names.withColumnRenamed("g", "ga"), 64), ["lang", "ga"])
        pairs = pairs.join(small(names.select("lang", F.col("g").alias("gb"), F.col("source").alias("item")), 64), ["lang", "gb"])
        pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")
        order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        pairs = pairs.withColumn("rank", F.row_number().over(order).cast("int"))

        value = F.expr("((p - q) * (p - q)) div (p + q)")
        terms_ = priced.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), value.alias("value"))
        terms_ = terms_.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= top)
        return settled(pairs.union(terms_))


def _pair_values(priced: DataFrame, groups: DataFrame, kept: DataFrame, tile: int, strip: int) -> DataFrame:
    """(lang, ga, gb, value) for each ordered pair of groups of a language."""
    strips = _numbered(kept)
    tiles = groups.groupBy("lang").agg((F.floor(F.max("g") / tile) + 1).alias("tiles"))
    cells = priced.select("lang", "g", "zero", "term", "p").join(strips, ["lang", "term"]).select("lang", "g", "zero", "t", "p")
    width = F.least(F.lit(strip).cast("long"), F.col("kept") - F.col("strip") * strip)
    # a row for each group and strip of its language, so that groups without a cell there are priced
    named = groups.where("kept > 0").select("lang", "g", "zero", "kept", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("kept") - 1) / strip))).alias("strip"))
    named = named.select("lang", "g", "zero", F.lit(-1).cast("long").alias("t"), F.lit(0).cast("long").alias("p"), "strip", width.alias("width"))
    sizes = groups.select("lang", "kept").distinct()
    cells = cells.withColumn("strip", F.floor(F.col("t") / strip)).join(sizes, "lang").select("lang", "g", "zero", "t", "p", "strip", width.alias("width"))
    both = named.union(cells).join(tiles, "lang").withColumn("tile", F.floor(F.col("g") / tile))
    # a tile is side 0 of its pairs with itself and later ones, side 1 of those with earlier ones
    sided = both.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    sided = sided.select(
        "lang", F.least("tile", "with").alias("ta"), F.greatest("tile", "with").alias("tb"), "strip",
        F.when(F.col("with") >= F.col("tile"), 0).otherwise(1).cast("long").alias("side"), "g", "zero", "t", "p", "width",
    )
    key = ["lang", "ta", "tb", "strip"]
    dealt = sided.repartition(*key).sortWithinPartitions(*key)
    sums = dealt.mapInArrow(lambda b: _strips(b, tile, strip), "lang string, ga bigint, gb bigint, value bigint").groupBy("lang", "ga", "gb").agg(F.sum("value").alias("value"))
    sums = stored(sums, "divergence-pairs")
    both_ways = sums.union(sums.select("lang", F.col("gb").alias("ga"), F.col("ga").alias("gb"), "value"))
    # a language without kept terms has no strip
    none = groups.where("kept = 0").select("lang", F.col("g").alias("ga"))
    other = none.select(F.col("lang").alias("other_lang"), F.col("ga").alias("gb"))
    without = none.join(other, (F.col("lang") == F.col("other_lang")) & (F.col("ga") != F.col("gb"))).select("lang", "ga", "gb", F.lit(0).cast("long").alias("value"))
    return both_ways.union(without)


def _numbered(kept: DataFrame) -> DataFrame:
    """(lang, term, t): the kept terms of a language, numbered from 0 by falling count.

    Terms are ranked within ranges of their count, and a range starts where the one before ends, so no task holds a language.
    """
    ranged = kept.select("lang", "term", "lang_n").repartitionByRange(F.col("lang"), F.col("lang_n").desc(), F.col("term"))
    placed = stored(ranged.sortWithinPartitions(F.col("lang"), F.col("lang_n").desc(), F.col("term")).withColumn("part", F.spark_partition_id()), "terms-ranged")
    in_part = Window.partitionBy("lang", "part").orderBy(F.col("lang_n").desc(), "term")
    before = Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("lang", "part").agg(F.count(F.lit(1)).alias("in_part")).withColumn("start", F.coalesce(F.sum("in_part").over(before), F.lit(0)))
    place = placed.withColumn("place", F.row_number().over(in_part) - 1).join(starts.select("lang", "part", "start"), ["lang", "part"])
    return stored(place.select("lang", "term", (F.col("start") + F.col("place")).cast("long").alias("t")), "terms-numbered")
