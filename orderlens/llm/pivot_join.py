"""Embedding near-duplicates: an exact range join in cells around pivots.

Vectors are compared by cosine, which on unit vectors is a distance: cosine >= c means at most
``reach = sqrt(2 - 2 * c)`` apart, and the triangle inequality holds.

1. Equal vectors are one class with a count, by a map-side combined aggregate; what follows has a row a class.
2. Pivots come from a bounded sample of classes (``SAMPLE``): first the centres of crowds, then others, no two closer
   than ``2 * reach``.  Every class belongs to the cell of its nearest pivot.
3. Boundary replication: a class x of cell p visits a cell q before p only if the triangle inequality allows a partner
   there: its distance to q is at most the cell's radius plus ``reach``, and it's no farther than ``reach`` from
   the plane between the pivots.  Of every linked pair of two cells, the class of the later one thus visits the other's.
4. Each cell joins on its own.  Classes within ``reach / 2`` of the pivot, its core, are all linked with each other and
   are counted as such, not compared; others meet the core only from within ``3 / 2 * reach`` of the pivot.  The rest are
   compared block by block: a cell of any size is dealt to blocks of about ``BLOCK`` rows, and those that ask are
   streamed past them.
5. Blocks return a row for each class that has a link: how many rows it is linked with, and a class of its component
   (so links aren't listed in pairs).  Union-find over those rows gives the components.

The pivots only decide how much is compared: sample and ``CELL`` have no effect on the links.  Vectors that crowd
anywhere, in clusters or under a few pivots, visit few cells.  Isotropic vectors in many dimensions are as
good as equally far from all pivots and visit many: there the join nears a comparison of blocks.

A pair is linked if the cosine in double precision is at least ``cosine``; within 1e-9 of it, it's computed anew with
exact sums.

Cases: vectors that are null, empty, zero or hold a null or a component that isn't finite are linked with nothing, and so are rows without
an id (their component is null); vectors of different lengths never meet; rows that repeat a vector are linked with
each other, also under one id; very long vectors are handled alike; an empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import fsum, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.blocks import takes_part, valid_vectors
from orderlens.llm.common import settled, small, stored, workspace
from orderlens.llm.minhash import components

COSINE = 0.95
#: classes from which pivots are taken, most pivots, classes wished for in a cell, rows of a block, rows that ask at once
SAMPLE, PIVOTS, CELL, BLOCK, CHUNK = 2048, 1024, 16384, 4096, 512
#: a crowd holds one of so many sampled classes at least
CROWD = 256
#: room for rounding in bounds that only leave out comparisons, and around the threshold
SLACK = 1e-9
#: partitions of the join at most
TASKS = 20_000


def unit(vectors: np.ndarray) -> np.ndarray:
    """The rows scaled to length 1; by a power of two first, so that no square overflows."""
    scaled = _scaled(vectors)
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def _scaled(vectors: np.ndarray) -> np.ndarray:
    if not vectors.size:
        return vectors
    exponent = np.frexp(np.abs(vectors).max(axis=-1, keepdims=True))[1]
    # in two steps, as the power itself may overflow
    return np.ldexp(np.ldexp(vectors, -(exponent // 2)), -(exponent - exponent // 2))


def cosine_of(a: np.ndarray, b: np.ndarray) -> float:
    """The cosine of two vectors, with exact sums."""
    a, b = _scaled(a), _scaled(b)
    return fsum(a * b) / (sqrt(fsum(a * a)) * sqrt(fsum(b * b)))


def choose_pivots(sample: np.ndarray, wanted: int, reach: float) -> np.ndarray:
    """Rows of ``sample``, unit vectors, as pivots: centres of crowds, then others in their order, no two within ``2 * reach``."""
    far = 1 - 2 * reach**2  # the cosine at 2 * reach
    products = sample @ sample.T
    near = products >= 1 - reach**2 / 8  # within reach / 2
    free = np.ones(len(sample), bool)
    chosen: list[int] = []
    while True:
        degree = np.where(free, (near & free).sum(axis=1), 0)
        i = int(degree.argmax()) if len(degree) else 0
        if not len(degree) or degree[i] < max(3, len(sample) // CROWD):
            break
        chosen.append(i)
        free &= products[i] < far
    for i in range(len(sample)):
        if len(chosen) >= wanted:
            break
        if free[i]:
            chosen.append(i)
            free &= products[i] < far
    return sample[chosen]


def _by_dim(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dim, rows, their vectors) for each length of the vectors in a batch."""
    lists = batch.column(column)
    sizes = np.diff(lists.offsets.to_numpy())
    for dim in np.unique(sizes):
        rows = np.flatnonzero(sizes == dim)
        yield int(dim), rows, lists.take(pa.array(rows)).flatten().to_numpy().reshape(-1, dim)


def _vectors(rows: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1], np.ascontiguousarray(rows).ravel())


_ROW = "cid bigint, n bigint, dim int, cell int, far double, vec array<double>"
_NAMES = ["cid", "n", "dim", "cell", "far", "vec"]


def _rows(cid, n, dim: int, cell, far, vectors) -> pa.RecordBatch:
    arrays = [pa.array(cid, pa.int64()), pa.array(n, pa.int64()), pa.array(np.full(len(cid), dim, np.int32)), pa.array(cell, pa.int32()), pa.array(far, pa.float64()), _vectors(vectors)]
    return pa.RecordBatch.from_arrays(arrays, _NAMES)


def _apart(products: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * products, 0))


def _at_home(batches: Iterator[pa.RecordBatch], pivots: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Each class (cid, n, vec) with the cell of its nearest pivot and the distance from it; a length without pivots is one cell."""
    for batch in batches:
        cid, n = (batch.column(i).to_numpy() for i in (0, 1))
        for dim, rows, vectors in _by_dim(batch, 2):
            cell, far = np.zeros(len(rows), np.int32), np.full(len(rows), 9.0)
            if dim in pivots:
                products = unit(vectors) @ pivots[dim].T
                cell = products.argmax(axis=1).astype(np.int32)
                far = _apart(products[np.arange(len(rows)), cell])
            yield _rows(cid[rows], n[rows], dim, cell, far, vectors)


def _visiting(batches: Iterator[pa.RecordBatch], pivots: dict[int, np.ndarray], radius: dict[int, np.ndarray], reach: float) -> Iterator[pa.RecordBatch]:
    """A row for each earlier cell in which a class at home in another one may have a partner."""
    between = {dim: _apart(p @ p.T) for dim, p in pivots.items()}
    for batch in batches:
        cid, n, home = (batch.column(i).to_numpy() for i in (0, 1, 3))
        for dim, rows, vectors in _by_dim(batch, 5):
            if dim not in pivots:
                continue
            for s in range(0, len(rows), CHUNK):
                part = rows[s : s + CHUNK]
                products = unit(vectors[s : s + CHUNK]) @ pivots[dim].T
                own = products[np.arange(len(part)), home[part]][:, None]
                far = _apart(products)
                allowed = far <= radius[dim] + reach + SLACK
                allowed &= own - products <= reach * between[dim][home[part]] + SLACK
                allowed &= np.arange(len(pivots[dim])) < home[part][:, None]
                who, where = np.nonzero(allowed)
                for t in range(0, len(who), CHUNK):
                    w, q = who[t : t + CHUNK], where[t : t + CHUNK]
                    yield _rows(cid[part[w]], n[part[w]], dim, q, far[w, q], vectors[s + w])


class _Block:
    """The rows of a block that are asked, how many rows each is linked with, and their components so far."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, ...]] = []

    def add(self, *columns: np.ndarray) -> None:
        self.parts.append(columns)

    def close(self) -> None:
        if self.parts:
            self.cid, self.n, self.core, self.vectors = (np.concatenate(c) for c in zip(*self.parts))
            self.units = unit(self.vectors)
            self.links = np.zeros(len(self.cid), np.int64)
            self.component = np.arange(len(self.cid))
            self.parts = []

    def ask(self, cid, n, full, own, near, vectors, cosine: float) -> tuple[np.ndarray, np.ndarray]:
        """(rows linked with, a linked class) of each that asks; the class is its own where there's none.

        ``full``: meets those outside the core; ``own``: is among them itself; ``near``: meets the core."""
        products = unit(vectors) @ self.units.T
        meets = np.where(self.core, near[:, None], full[:, None] & (~own[:, None] | (self.cid < cid[:, None])))
        hits = meets & (products >= cosine)
        for i, j in np.argwhere(meets & (np.abs(products - cosine) < SLACK)):
            hits[i, j] = cosine_of(vectors[i], self.vectors[j]) >= cosine
        self.links += n @ hits
        other = cid.copy()
        for i in np.flatnonzero(hits.any(axis=1)):
            found = np.unique(self.component[hits[i]])
            if len(found) > 1:
                self.component[np.isin(self.component, found[1:])] = found[0]
            other[i] = self.cid[found[0]]
        return hits @ self.n, other

    def totals(self) -> pa.RecordBatch | None:
        if not hasattr(self, "links") or not self.links.any():
            return None
        some = self.links > 0
        return _links(self.cid[some], self.links[some], self.cid[self.component[some]])


def _links(cid, links, other) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (cid, links, other)], ["cid", "links", "other"])


def _within(batches: Iterator[pa.RecordBatch], cosine: float) -> Iterator[pa.RecordBatch]:
    """Join the blocks of a partition: sorted rows (dim, cell, block, asking, cid, n, core, full, own, near, vec)."""
    held, block = None, _Block()
    for batch in batches:
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(10)]
        keys = np.stack([c.astype(np.int64) for c in columns[:4]])
        edges = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
        for i, j in zip(edges, edges[1:]):
            if i == j:
                continue
            key = tuple(keys[:3, i].tolist())
            if key != held:
                if (rows := block.totals()) is not None:
                    yield rows
                held, block = key, _Block()
            cid, n, core, full, own, near = (c[i:j] for c in columns[4:])
            vectors = batch.column(10)[i:j].flatten().to_numpy().reshape(-1, key[0])
            if not columns[3][i]:
                block.add(cid, n, core, vectors)
                continue
            block.close()
            if not hasattr(block, "links"):
                continue
            for s in range(0, j - i, CHUNK):
                c = slice(s, s + CHUNK)
                links, other = block.ask(cid[c], n[c], full[c], own[c], near[c], vectors[c], cosine)
                if links.any():
                    yield _links(cid[c][links > 0], links[links > 0], other[links > 0])
    if (rows := block.totals()) is not None:
        yield rows


def _pivots(classes: DataFrame, wanted: int, sample: int, reach: float) -> dict[int, np.ndarray]:
    """Length of the vectors -> pivots, from the classes with the smallest hashes."""
    picked: dict[int, list] = {}
    # a bounded number of rows
    for r in classes.select("vec").orderBy(F.xxhash64("vec"), "vec").limit(sample).collect():
        picked.setdefault(len(r.vec), []).append(r.vec)
    return {dim: choose_pivots(unit(np.array(v, float)), wanted, reach) for dim, v in picked.items()}


def class_links(classes: DataFrame, cosine: float = COSINE, cell: int = CELL, block: int = BLOCK, sample: int = SAMPLE) -> DataFrame:
    """(cid, links, other) of ``classes`` (cid, n, vec): rows of other classes with a cosine of at least ``cosine``, and a class that is reachable.

    A class may have several rows, whose links add up.
    """
    reach = sqrt(2 - 2 * cosine)
    count = classes.count()
    pivots = _pivots(classes, min(max(1, -(-count // cell)), PIVOTS), sample, reach)
    homes = stored(classes.select("cid", "n", "vec").mapInArrow(lambda b: _at_home(b, pivots), _ROW), "pivot-homes")
    core = F.col("far") <= reach / 2 - SLACK
    cells = stored(
        homes.groupBy("dim", "cell").agg(
            F.count(F.lit(1)).alias("size"),
            F.max("far").alias("radius"),
            F.coalesce(F.sum(F.when(core, F.col("n"))), F.lit(0)).alias("core_rows"),
            F.min(F.when(core, F.col("cid"))).alias("core_cid"),
        ),
        "pivot-cells",
    )
    radius = {dim: np.full(len(p), -9.0) for dim, p in pivots.items()}
    # at most a row for each pivot
    for r in cells.where(F.col("dim").isin(*pivots) if pivots else F.lit(False)).collect():
        radius[r.dim][r.cell] = r.radius
    visits = homes.mapInArrow(lambda b: _visiting(b, pivots, radius, reach), _ROW)

    sizes = small(cells.select("dim", "cell", F.ceil(F.col("size") / block).cast("int").alias("blocks"), "core_rows", "core_cid"), 40)
    key, every = ["dim", "cell"], F.sequence(F.lit(0), F.col("blocks") - 1)
    near = (F.col("far") <= 1.5 * reach + SLACK) & (F.col("core_rows") > 0)
    placed = homes.join(sizes, key).withColumn("mine", F.pmod(F.xxhash64("cid"), "blocks").cast("int"))
    columns = ["dim", "cell", "block", "asking", "cid", "n", "core", "full", "own", "near", "vec"]
    no, yes = F.lit(False), F.lit(True)
    asked = placed.select("*", F.col("mine").alias("block"), no.alias("asking"), core.alias("core"), no.alias("full"), no.alias("own"), no.alias("near"))
    outside = placed.where(~core).withColumn("block", F.explode(every)).withColumn("full", F.col("block") <= F.col("mine")).withColumn("near", near)
    outside = outside.where(F.col("full") | F.col("near")).withColumn("own", F.col("block") == F.col("mine")).withColumn("asking", yes).withColumn("core", no)
    guests = visits.join(sizes, key).withColumn("block", F.explode(every)).withColumn("near", near)
    guests = guests.withColumn("full", yes).withColumn("own", no).withColumn("asking", yes).withColumn("core", no)
    everyone = asked.select(*columns).union(outside.select(*columns)).union(guests.select(*columns))
    # a number of its own: what a block costs is work, not bytes
    tasks = min(max(2 * cells.agg(F.sum(F.ceil(F.col("size") / block))).first()[0] if count else 1, 1), TASKS)
    dealt = everyone.repartition(tasks, "dim", "cell", "block").sortWithinPartitions("dim", "cell", "block", "asking", "cid")
    compared = dealt.mapInArrow(lambda b: _within(b, cosine), "cid bigint, links bigint, other bigint")
    cored = homes.where(core).join(sizes, key).where("core_cid IS NOT NULL")
    return compared.union(cored.select("cid", (F.col("core_rows") - F.col("n")).alias("links"), F.col("core_cid").alias("other")))


def near_duplicate_vectors(
    embeddings: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cosine: float = COSINE, cell: int = CELL, block: int = BLOCK, sample: int = SAMPLE
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row: other rows linked with, the smallest id reachable, whether that's its own."""
    with workspace(embeddings.sparkSession):
        vectors = valid_vectors(embeddings, id_col, vec_col, nonzero=True)
        # 128 bits stand for a vector
        keyed = vectors.select("id", "vec", F.xxhash64("vec").alias("k1"), F.xxhash64(F.lit("vector"), "vec").alias("k2"))
        classes = stored(
            keyed.groupBy("k1", "k2").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"), F.any_value("vec").alias("vec"))
            # a number that is unique, and stays as it is once written
            .withColumn("cid", F.monotonically_increasing_id()),
            "vector-classes",
        )
        found = class_links(classes, cosine, cell, block, sample)
        found = stored(found.groupBy("cid", "other").agg(F.sum("links").alias("links")), "vector-links")
        labels = components(found.where("cid <> other").select(F.col("cid").alias("a"), F.col("other").alias("b")), "vector-labels")
        links = found.groupBy("cid").agg(F.sum("links").alias("links"))
        described = stored(
            classes.select("cid", "k1", "k2", "rep", "n").join(links, "cid", "left").join(labels.withColumnRenamed("node", "cid"), "cid", "left")
            .select("k1", "k2", "rep", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("label", "cid").alias("label")),
            "vectors-described",
        )
        smallest = described.groupBy("label").agg(F.min("rep").alias("component"))
        described = stored(described.join(smallest, "label").select("k1", "k2", "n_links", "component"), "vector-components")
        rows = keyed.select(F.col("id").alias("vec_id"), "k1", "k2").join(small(described, 48), ["k1", "k2"], "left")
        linked = rows.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
        alone = embeddings.where(~takes_part(id_col, vec_col, nonzero=True)).select(F.col(id_col).cast("long").alias("vec_id"))
        alone = alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
        everyone = linked.union(alone)
        return settled(everyone.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))

