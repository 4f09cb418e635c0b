"""SuperMinHash near-duplicate detection over word shingles.

Signatures: every element of a document's shingle set walks through a random permutation of the
signature's positions and offers ``round + uniform`` to the position it meets in each round; a position keeps
its smallest offer.  The ranks that one element gives are correlated (it offers each round
number once, to different positions), which lowers the variance against independent hash functions.
Offers of later rounds are larger by at least one, so a document stops as soon as all positions
hold less than the next round's number: after one or two rounds for most texts.

Grouping works on classes of equal shingle sets: exact copies collapse first, with a map-side
combine, so a group of copies of any size costs a row a task.  Classes are numbered, so that what is
shuffled for them is a few integers.  Then

1. bands of the signature give buckets; classes that share one are candidates.  Of buckets with the same
   members that of the first band counts;
2. the star: every class meets one of the centres of its buckets.  Full sets travel once, to the centre,
   for verification, 100 * intersection >= 75 * union, and union-find merges the links;
3. the rest: in buckets that still hold several components, the members outside the largest one meet
   the others in blocks, by signature.  A pair is taken up in the first band that both share, and only
   if its ends are in different components.  A row of candidates holds a class and its partners;
4. each of those classes tries its most similar partner on the full sets, and the links are merged;
   what is then still between different components is verified to the last pair, each set being sent
   once for each square of its bucket in which it has a partner.  Pairs stay in arrays beside a class, and are no rows.

A group of near copies, however large, is thus mostly settled by its star.  Candidates are pairs that share
a bucket and match in ``matches`` of the 128 positions.  Both filters lose a link at the threshold with a small
probability (``POSITIONS``, ``MATCHES``); with ``matches=0`` every pair of a bucket is verified.  No link
between candidates is lost.

Cases: texts without words have an empty set and are linked with nothing; a text of fewer than five
words has one shingle, its whole word sequence; very long texts are read whole; rows without an id keep a
row with a null component and stay; repeated rows are copies of each other; an empty table gives an
empty result; other columns, whatever their names, play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.llm.bpe import steps
from orderlens.llm.common import settled, small, stored, workspace

SHINGLE = 5
SIMILARITY = 75  # per cent
#: positions of a signature, and rows of a band: a pair at the threshold is missed with probability
#: (1 - 0.75 ** 4) ** 32 = 5e-6
POSITIONS, ROWS = 128, 4
#: matching positions that a pair needs to be verified (0: none): at the threshold a pair has 96 of 128 with
#: a standard deviation under 4.9, so fewer than 77 come up with probability 4e-5
MATCHES = 77
#: bits of a bucket's key below the number of its band
BAND_SHIFT = 57
#: members of a block that are compared by signature, and by full set
BLOCK, SET_BLOCK = 8192, 512
#: elements that walk together
SLICE = 1 << 17

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads 64-bit integers evenly."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, width: int = SHINGLE) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the word shingles of a text (A-Z lower-cased)."""
    from xxhash import xxh64_intdigest

    words = text.encode().translate(_LOWER).split()  # bytes.split cuts at the six ASCII white-space characters
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(xxh64_intdigest, words), np.uint64, n)
    k = min(n, width)
    h = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        h = h * _MULTIPLIER + w[i : n - k + 1 + i]
    return np.unique(mixed(h))


def signatures(sets: list[np.ndarray], m: int = POSITIONS) -> np.ndarray:
    """The SuperMinHash of each set: an array (sets, m) of doubles; infinite for an empty set."""
    best = np.full(len(sets) * m, np.inf)
    if not sets:
        return best.reshape(0, m)
    sizes = np.array([len(s) for s in sets])
    elements = np.concatenate(sets) if sizes.sum() else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    for at in range(0, len(elements), SLICE):
        _walk(elements[at : at + SLICE], owner[at : at + SLICE], best, m)
    return best.reshape(-1, m)


def _walk(elements: np.ndarray, owner: np.ndarray, best: np.ndarray, m: int) -> None:
    """Lower ``best`` by the offers of some elements; a set's elements may come in several calls,
    as an offer of a round beyond the set's largest value changes nothing."""
    order = None  # the permutations, drawn step by step; only for elements that go beyond round 0
    for j in range(m):
        draw = mixed(elements + np.uint64((j + 1) * int(_MULTIPLIER) & 0xFFFFFFFFFFFFFFFF))
        offer = j + (draw >> np.uint64(11)) * 2.0**-53
        k = j + ((mixed(draw) >> np.uint64(32)) * np.uint64(m - j) >> np.uint64(32)).astype(np.int64)
        if order is None:
            position = k
        else:
            rows = np.arange(len(elements))
            position = order[rows, k].astype(np.int64)
            order[rows, k] = order[:, j]
            order[:, j] = position
        np.minimum.at(best, owner * m + position, offer)
        if j == m - 1:
            return
        sets = np.unique(owner)
        open_sets = sets[best.reshape(-1, m)[sets].max(axis=1) >= j + 1]
        if not len(open_sets):
            return
        stay = np.isin(owner, open_sets)
        elements, owner = elements[stay], owner[stay]
        if order is None:
            first = position[stay]
            order = np.broadcast_to(np.arange(m, dtype=np.uint8), (len(elements), m)).copy()
            order[np.arange(len(elements)), first] = 0
            order[:, 0] = first
        else:
            order = order[stay]


def set_digest(elements: np.ndarray) -> bytes | None:
    """128 bits that stand for a shingle set; None for the empty set."""
    from xxhash import xxh3_128_digest

    return xxh3_128_digest(elements.tobytes()) if len(elements) else None


def fingerprints(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, n_shingles, set_id, sig) per row of ``docs``; ``sig`` has 16 bits a position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for s in steps([len(t or "") for t in texts], 1 << 22):
                sets = [shingles(t or "") for t in texts[s]]
                short = (mixed(signatures(sets).view(np.uint64)) >> np.uint64(48)).astype("<u2")
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[s],
                        pa.array([len(x) for x in sets], pa.int64()),
                        pa.array([set_digest(x) for x in sets], pa.binary()),
                        pa.array([x.tobytes() for x in short], pa.binary()),
                    ],
                    ["doc_id", "n_shingles", "set_id", "sig"],
                )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_shingles bigint, set_id binary, sig binary")


def bands(classes: DataFrame) -> DataFrame:
    """(bucket, cid) for each band of each class: the band's number, and a hash of its positions in ``sig``."""
    size = 2 * ROWS
    number = POSITIONS // ROWS

    def key(band: Column) -> Column:
        cut = F.substring("sig", band * size + 1, F.lit(size))
        return F.shiftleft(band.cast("long"), BAND_SHIFT) + F.shiftrightunsigned(F.xxhash64(band, cut), 64 - BAND_SHIFT)

    every = F.transform(F.sequence(F.lit(0), F.lit(number - 1)), key)
    return classes.select("cid", F.explode(every).alias("bucket")).select("bucket", "cid")


def _full_sets(docs: DataFrame, wanted: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """(cid, center, elements), a row for each class in ``wanted`` (set_id, cid, rep, center), computed anew from the text of ``rep``.

    Classes without numbers, (set_id, rep), are named by their set: (set_id, elements)."""
    named = ["cid", "center"] if "cid" in wanted.columns else ["set_id"]
    k = len(named)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(k + 1).to_pylist()
            for s in steps([len(t or "") for t in texts], 1 << 22):
                sets = [shingles(t or "") for t in texts[s]]
                # rows that share an id may have other texts
                same = pa.array([set_digest(x) == d for x, d in zip(sets, batch.column(k)[s].to_pylist())], pa.bool_())
                elements = pa.array([x.tobytes() for x in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([*(batch.column(i)[s] for i in range(k)), elements], [*named, "elements"]).filter(same)

    texts = docs.select(F.col(id_col).alias("rep"), F.col(text_col).cast("string").alias("text"))
    asked = texts.join(small(wanted, 64), "rep").select(*named, F.col("set_id").alias("digest"), "text")
    found = asked.mapInArrow(run, ", ".join([*(f"{c} {asked.schema[c].dataType.simpleString()}" for c in named), "elements binary"]))
    sets = stored(found, "full-sets")
    # only rows that share an id repeat a set
    if sets.groupBy(named[0]).count().where("count > 1").isEmpty():
        return sets
    return stored(sets.dropDuplicates(named[:1]), "single-sets")


def linked(a: np.ndarray, b: np.ndarray, similarity: int = SIMILARITY) -> bool:
    """Whether 100 * intersection >= similarity * union, for sorted distinct elements."""
    if 100 * min(len(a), len(b)) < similarity * max(len(a), len(b)):
        return False
    both = np.concatenate((a, b))
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= similarity * (len(a) + len(b) - shared)


def _likely(batches: Iterator[pa.RecordBatch], matches: int) -> Iterator[pa.RecordBatch]:
    """The pairs whose signatures match in enough positions."""
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u2").reshape(-1, POSITIONS) for i in (2, 3))
        yield batch.select([0, 1]).filter(pa.array((a == b).sum(axis=1) >= matches))


def _confirmed(batches: Iterator[pa.RecordBatch], similarity: int) -> Iterator[pa.RecordBatch]:
    """The pairs whose full sets are similar enough."""
    for batch in batches:
        sets = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
        yes = [linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), similarity) for x, y in sets]
        yield batch.select([0, 1]).filter(pa.array(yes, pa.bool_()))


def _groups(batches: Iterator[pa.RecordBatch], key: int) -> Iterator[list[tuple]]:
    """Consecutive rows that agree in their first ``key`` columns, across batches."""
    group: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if group and group[0][:key] != row[:key]:
                yield group
                group = []
            group.append(row)
    if group:
        yield group


_CANDIDATES = pa.schema(
    [("bucket", pa.int64()), ("sq", pa.int32()), ("st", pa.int32()), ("cid", pa.int64()), ("partners", pa.list_(pa.int64())), ("matches", pa.int32())]
)


def _block_candidates(batches: Iterator[pa.RecordBatch], matches: int, set_block: int) -> Iterator[pa.RecordBatch]:
    """The members that have a likely partner in another component, with the partners, most similar first, and these partners themselves.

    Rows (bucket, sq, st, cid, partners, most matches), for each square of at most about ``set_block`` members on either side: a row for
    a member that asks, and one without partners for each that is asked.  A block's rows come with those that are asked
    before those that ask; the latter are streamed.
    """
    key, rows, held = None, [], None
    asked: set[tuple[int, int, int, int]] = set()

    def told() -> Iterator[tuple]:
        for bucket, sq, st, cid in asked:
            yield bucket, sq, st, cid, [], -1
        asked.clear()

    def batch_of(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*found), _CANDIDATES)], schema=_CANDIDATES)

    for batch in batches:
        found: list[tuple] = []
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            bucket, bq, bt, asking, size, cid, label, minor, sig = row
            if key != (bucket, bq, bt):
                found.extend(told())
                key, rows, held = (bucket, bq, bt), [], None
            if not asking:
                rows.append(row)
                continue
            if not rows:
                continue
            if held is None:
                squares = -(-size // set_block)
                sigs = np.frombuffer(b"".join(r[8] for r in rows), "<u2").reshape(-1, POSITIONS)
                cids, labels, minors = (np.array([r[i] for r in rows]) for i in (5, 6, 7))
                held = sigs, cids, labels, minors, squares, (mixed(cids.astype(np.uint64)) % np.uint64(squares)).astype(int)
            sigs, cids, labels, minors, squares, square = held
            # of two members outside the largest component, the smaller one asks
            others = np.flatnonzero((labels != label) & (~minors | (cid < cids)))
            same = sigs[others] == np.frombuffer(sig, "<u2")
            total = same.sum(axis=1)
            near = np.flatnonzero(total >= matches)
            # the pair belongs to the first band that both share
            first = same[near].reshape(-1, POSITIONS // ROWS, ROWS).all(axis=2).argmax(axis=1)
            near = near[first == bucket >> BAND_SHIFT]
            if len(near):
                sq = int(mixed(np.array([cid], np.uint64))[0] % np.uint64(squares))
                near = near[np.lexsort((cids[others[near]], -total[near]))]
                theirs = square[others[near]]
                for st in np.unique(theirs).tolist():
                    partners = cids[others[near[theirs == st]]].tolist()
                    found.append((bucket, sq, st, cid, partners, int(total[near[theirs == st][0]])))
                    asked.update((bucket, sq, st, p) for p in partners)
        if found:
            yield batch_of(found)
    if asked:
        yield batch_of(list(told()))


def _block_links(batches: Iterator[pa.RecordBatch], similarity: int) -> Iterator[pa.RecordBatch]:
    """In each square, links on full sets that join components: a spanning forest."""
    for group in _groups(batches, 3):
        sets = {r[3]: np.frombuffer(r[6], np.uint64) for r in group}
        label = {r[3]: r[4] for r in group}
        parent: dict[int, int] = {}

        def root(x: int, parent: dict[int, int] = parent) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        edges = []
        for a, partners in {r[3]: r[5] for r in group}.items():
            for b in partners or ():
                ra, rb = root(label[a]), root(label[b])
                if ra != rb and linked(sets[a], sets[b], similarity):
                    parent[ra] = rb
                    edges.append((a, b))
        if edges:
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.int64()) for x in zip(*edges)], ["a", "b"])


def components(edges: DataFrame, what: str = "components") -> DataFrame:
    """(node, label) of the nodes of ``edges`` (a, b): the smallest node that is reachable.

    Hooking (the least label among the neighbours) and pointer jumping, round by round; each round's
    labels are written to the shared folder.  A round costs rows in proportion to the edges, with a
    map-side minimum, and their number grows with the logarithm of the longest path.
    """
    kind = edges.schema["a"].dataType
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), f"{what}-edges")
    labels = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).select(F.col("a").alias("node"), "label"), what)
    while True:
        offered = both.join(labels, both["b"] == labels["node"]).select(F.col("a").alias("node"), "label", F.lit(None).cast(kind).alias("old"))
        own = labels.select("node", "label", F.col("label").alias("old"))
        hooked = offered.union(own).groupBy("node").agg(F.min("label").alias("label"), F.min("old").alias("old"))
        above = labels.select(F.col("node").alias("above"), F.col("label").alias("above_label"))
        jumped = hooked.join(above, hooked["label"] == above["above"], "left")
        moved = stored(jumped.select("node", F.least("label", "above_label").alias("label"), "old"), what)
        labels = moved.select("node", "label")
        if moved.where(F.col("label") != F.col("old")).isEmpty():
            return labels


def _verified(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The links among ``pairs`` (a, b): the set of ``a`` goes to that of ``b``."""
    full = pairs.join(sets.select(F.col("cid").alias("a"), "elements"), "a")
    return _meet(full, sets, similarity)


def _meet(full: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Those of ``full`` (a, b, elements) whose sets are similar."""
    centers = sets.join(full.select(F.col("b").alias("cid")).distinct(), "cid", "left_semi")
    both = full.join(centers.select(F.col("cid").alias("b"), F.col("elements").alias("other")), "b")
    return both.select("a", "b", "elements", "other").mapInArrow(lambda x: _confirmed(x, similarity), "a bigint, b bigint")


def _relabelled(labels: DataFrame, links: DataFrame, what: str) -> DataFrame:
    """``labels`` (node, label) after ``links`` (a, b) were added."""
    return components(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).union(links.select("a", "b")), what)


def _candidates(members: DataFrame, labels: DataFrame, classes: DataFrame, matches: int, block: int, set_block: int) -> DataFrame:
    """(bucket, sq, st, cid, partners, matches): likely pairs between components that share a bucket, by squares of a bucket."""
    labelled = stored(
        members.join(labels.withColumnRenamed("node", "cid"), "cid", "left").select("bucket", "cid", "size", F.coalesce("label", "cid").alias("label")),
        "labelled",
    )
    per_label = labelled.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
    largest = stored(
        per_label.groupBy("bucket").agg(F.max_by("label", F.struct("n", "label")).alias("major"), F.count(F.lit(1)).alias("labels"))
        .where(F.col("labels") > 1).select("bucket", "major"),
        "open-buckets",
    )
    blocks = F.ceil(F.col("size") / block).cast("int")
    mine = F.pmod(F.xxhash64("cid"), blocks).cast("int")
    every = F.explode(F.sequence(F.lit(0), blocks - 1))
    rows = labelled.join(largest, "bucket").withColumn("minor", F.col("label") != F.col("major")).join(classes.select("cid", "sig"), "cid")
    columns = ["bucket", "bq", "bt", "asking", "size", "cid", "label", "minor", "sig"]
    asking = rows.where("minor").withColumn("bq", mine).withColumn("bt", every).withColumn("asking", F.lit(True)).select(*columns)
    asked = rows.withColumn("bt", mine).withColumn("bq", every).withColumn("asking", F.lit(False)).select(*columns)
    key = ["bucket", "bq", "bt"]
    dealt = asking.union(asked).repartition(*key).sortWithinPartitions(*key, "asking")
    schema = "bucket bigint, sq int, st int, cid bigint, partners array<bigint>, matches int"
    return stored(dealt.mapInArrow(lambda b: _block_candidates(b, matches, set_block), schema), "candidates")


def _last_links(candidates: DataFrame, labels: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The links among all candidates, but for those whose ends are in one component already."""
    key = ["bucket", "sq", "st"]
    # a member may be asked in several blocks of its bucket
    rows = candidates.groupBy(*key, "cid").agg(F.flatten(F.collect_list("partners")).alias("partners"))
    named = rows.join(labels.withColumnRenamed("node", "cid"), "cid", "left").select(*key, "cid", F.coalesce("label", "cid").alias("label"), "partners")
    # a square whose members are all in one component has nothing left
    spread = named.groupBy(*key).agg(F.min("label").alias("least"), F.max("label").alias("most")).where("least <> most").select(*key)
    held = named.join(spread, key, "left_semi").join(sets.select("cid", "elements"), "cid").select(*key, "cid", "label", "partners", "elements")
    return held.repartition(*key).sortWithinPartitions(*key).mapInArrow(lambda b: _block_links(b, similarity), "a bigint, b bigint")


def _grouped(
    docs: DataFrame, text_col: str, id_col: str, similarity: int, matches: int, block: int, set_block: int
) -> DataFrame:
    """(doc_id, n_shingles, set_id, component) per row of ``docs``; it reads what is stored."""
    prints = stored(fingerprints(docs, text_col, id_col), "fingerprints")
    classes = stored(
        prints.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("set_id").agg(F.min("doc_id").alias("rep"), F.any_value("sig").alias("sig"))
        # a number that is unique, and stays as it is once written
        .withColumn("cid", F.monotonically_increasing_id()),
        "classes",
    )
    in_bands = bands(classes)
    buckets = (
        in_bands.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("size"), F.min("cid").alias("center"), F.bit_xor(F.xxhash64("cid")).alias("all"))
        .where("size > 1")
    )
    buckets = stored(buckets, "all-buckets")
    # of buckets with the same members, that of the first band
    buckets = stored(buckets.groupBy("size", "center", "all").agg(F.min("bucket").alias("bucket")).select("bucket", "size", "center"), "buckets")
    members = stored(in_bands.join(buckets, "bucket"), "members")

    # a class has one centre, the smallest; centres that have none send their set nowhere
    first = members.groupBy("cid").agg(F.min("center").alias("center"))
    sig = classes.select("cid", "sig")
    star = first.where("cid <> center").join(sig, "cid").join(sig.select(F.col("cid").alias("center"), F.col("sig").alias("center_sig")), "center")
    star = stored(star.select("cid", "center", "sig", "center_sig").mapInArrow(lambda b: _likely(b, matches), "cid bigint, center bigint"), "star")
    wanted = classes.select("set_id", "cid", "rep").join(first.select("cid"), "cid").join(star, "cid", "left").select("set_id", "cid", "rep", "center")
    sets = _full_sets(docs, stored(wanted, "wanted"), text_col, id_col)
    to_center = sets.where("center IS NOT NULL").select(F.col("cid").alias("a"), F.col("center").alias("b"), "elements")
    labels = components(stored(_meet(to_center, sets, similarity), "star-links"), "star-labels")

    candidates = _candidates(members, labels, classes, matches, block, set_block)
    top = F.get("partners", F.lit(0))
    best = candidates.where("matches >= 0").groupBy("cid").agg(F.max_by(top, F.struct("matches", top)).alias("b"))
    links = stored(_verified(stored(best.select(F.col("cid").alias("a"), "b"), "best"), sets, similarity), "best-links")
    if not links.isEmpty():
        labels = _relabelled(labels, links, "best-labels")
    links = stored(_last_links(candidates, labels, sets, similarity), "last-links")
    if not links.isEmpty():
        labels = _relabelled(labels, links, "last-labels")

    reps = classes.join(labels.withColumnRenamed("node", "cid"), "cid").select("set_id", "label", "rep")
    smallest = stored(reps.groupBy("label").agg(F.min("rep").alias("component")), "smallest")
    grouped = stored(reps.join(smallest, "label").select("set_id", "component"), "grouped")
    by_class = stored(
        classes.select("set_id", "rep").join(grouped, "set_id", "left").select("set_id", F.coalesce("component", "rep").alias("component")),
        "class-components",
    )
    return prints.select("doc_id", "n_shingles", "set_id").join(by_class, "set_id", "left")


def near_duplicates(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    similarity: int = SIMILARITY,
    matches: int = MATCHES,
    block: int = BLOCK,
    set_block: int = SET_BLOCK,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, set_id) per row of ``docs``.

    ``component_id`` is the smallest id reachable over links, ``kept`` whether that is the row's own.
    """
    with workspace(docs.sparkSession):
        component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
        kept = F.coalesce(F.col("doc_id") == component, F.lit(True))
        grouped = _grouped(docs, text_col, id_col, similarity, matches, block, set_block)
        return settled(grouped.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"), "set_id"))


def drop_near_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each group of near duplicates: the one with the smallest id.

    Rows without an id stay.  Rows that share an id are told apart by their shingle sets; of equal
    ones, one stays.
    """
    found = near_duplicates(docs, text_col, id_col)
    gone = settled(found.where("NOT kept").select(F.col("doc_id").alias(id_col)).distinct())
    gone = small(gone, 16)
    repeated = settled(found.groupBy("doc_id").count().where("count > 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias(id_col)))
    if repeated.isEmpty():
        return docs.join(gone, id_col, "left_anti").select(*docs.columns)
    single = docs.join(repeated, id_col, "left_anti").join(gone, id_col, "left_anti").select(*docs.columns)
    return single.unionByName(_one_of_each(docs.join(repeated, id_col, "left_semi").select(*docs.columns), found, text_col, id_col))


def _one_of_each(docs: DataFrame, found: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """The rows of ``docs`` that are kept, one for each id and shingle set."""
    index, name = docs.columns.index(text_col), "_set_id"
    while name.lower() in {c.lower() for c in docs.columns}:
        name = f"_{name}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = [set_digest(shingles(t or "")) for t in batch.column(index).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.binary())], [*batch.schema.names, name])

    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.BinaryType())])
    kept = found.where("kept").select(F.col("doc_id").alias("_kept_id"), F.col("set_id").alias("_kept_set")).distinct()
    rows = docs.mapInArrow(run, schema)
    on = (rows[id_col] == kept["_kept_id"]) & rows[name].eqNullSafe(kept["_kept_set"])
    return rows.join(kept, on, "left_semi").dropDuplicates([id_col, name]).select(*docs.columns)
