"""Spelling variants: near words by blocked Gram matrices of letter counts, and the form each word is a variant of.

1. Words with their numbers of occurrences: tasks pre-aggregate their documents, so a frequent word is a row a task.
2. Blocks.  Letters fall into ``CLASSES`` classes; words with the same number of letters of each class, and so of one
   length, are a cell.  An edit adds one letter, drops one, or replaces one, so a near word lies in the same cell or in
   a cell of the same or an adjacent length that differs by one letter in one or two classes.  Each word goes to its own
   cell and asks in the cells on one side: those where a letter of one class has become one of a later class, and those
   of words shorter by a letter.  Every pair of adjacent cells thus meets once, whatever the size of the vocabulary.
3. Gram matrices.  In a block of a cell, a NumPy product of the letter counts of the words there and of those that ask gives
   the squared distances ``|x|^2 + |y|^2 - 2 x.y``.  Pairs with at most two are kept: two for a replaced letter, one for a
   letter more or less.  Those are verified on their letters.  Cells larger than ``BLOCK`` words are dealt to several blocks,
   past which those that ask are streamed.
4. Pairs stay in their task: a block returns how many near words a word has there, and the best one.  These are added up.
5. The form of a word is its near word with the largest count (ties: the smaller word), if that is at least ``RATIO`` times
   its own.  Roots follow forms to the end, by pointer jumping: counts grow tenfold each step, so a few rounds do.

Words.  Runs of A-Z, a-z and the characters U+00C0 to U+00FF; A-Z lower-cased.  With ``drop``, the run of a document loses a
letter where a hash of id and run says so, which plants variants (contract of the registered query).

Cases: null texts have no words, very long texts and words are read whole; rows without an id have an empty one in the hash; repeated rows
count again; words without near words have themselves as root; an empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import settled, small, stored, workspace

MIN_LETTERS, MIN_COUNT, RATIO, DROP = 7, 2, 10, 31
#: classes of letters, words of a block, words that ask at once, words that a task counts before it passes the counts on
CLASSES, BLOCK, CHUNK, HELD = 8, 2048, 1024, 1 << 19
#: letters that are verified together
VERIFIED = 1 << 20
#: words of the vocabulary for each partition of the blocks, partitions at most
WORDS, TASKS = 2000, 20_000

#: in Latin-1: letters stay, A-Z in lower case; anything else is a blank
_LETTERS = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


def runs(text: str) -> list[bytes]:
    """The runs of letters of a text, lower-cased, in Latin-1: a byte a code point, in code-point order."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split()


def _dropped(run: bytes, seed: int, drop: int) -> bytes:
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
    if h % drop:
        return run
    i = h % len(run)
    return run[:i] + run[i + 1 :]


def _counted(batches: Iterator[pa.RecordBatch], letters: int, drop: int | None) -> Iterator[pa.RecordBatch]:
    """(word, n) of the documents (id, text) so far, whenever many have come together."""
    held: Counter = Counter()

    def flush() -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in held], pa.string())
        rows = pa.RecordBatch.from_arrays([words, pa.array(list(held.values()), pa.int64())], ["word", "n"])
        held.clear()
        return rows

    for batch in batches:
        for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
            found = Counter(r for r in runs(text or "") if len(r) >= letters)
            if drop is None:
                held.update(found)
            else:
                seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for run, n in found.items():
                    word = _dropped(run, seed, drop)
                    if len(word) >= letters:
                        held[word] += n
            if len(held) > HELD:
                yield flush()
    if held:
        yield flush()


def vocabulary(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", letters: int = MIN_LETTERS, least: int = MIN_COUNT, drop: int | None = DROP) -> DataFrame:
    """(word, n) of the words with at least ``letters`` letters and ``least`` occurrences."""
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    counted = rows.mapInArrow(lambda b: _counted(b, letters, drop), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


# a cell's key is a sum over its classes, so that a neighbour's is a difference away; no two differences are equal, so no
# word asks twice in a cell, and no two words ask each other
_WEIGHTS = np.random.default_rng(11).integers(1, 2**63, CLASSES, dtype=np.uint64)


def _steps() -> np.ndarray:
    """What a word's cell is away from those where it asks besides its own."""
    i, j = np.triu_indices(CLASSES, 1)
    later, shorter = _WEIGHTS[j] - _WEIGHTS[i], np.zeros(CLASSES, np.uint64) - _WEIGHTS
    return np.concatenate([np.zeros(1, np.uint64), later, shorter])


def _classes(words: list[bytes]) -> np.ndarray:
    """How many letters of each class each word has."""
    letters = np.frombuffer(b"".join(words), np.uint8) % CLASSES
    owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
    return np.bincount(owner * CLASSES + letters, minlength=len(words) * CLASSES).reshape(-1, CLASSES)


def _placed(batches: Iterator[pa.RecordBatch], asking: bool) -> Iterator[pa.RecordBatch]:
    """(cell, wid, word, n): each word (wid, word in Latin-1, n) in its own cell, or in those where it asks besides."""
    # what a cell is away, and the class that loses a letter on the way
    away = list(zip(_steps()[1:], [*np.triu_indices(CLASSES, 1)[0].tolist(), *range(CLASSES)])) if asking else [(np.uint64(0), None)]
    for batch in batches:
        if not batch.num_rows:
            continue
        counts = _classes(batch.column(1).to_pylist())
        home = (counts.astype(np.uint64) * _WEIGHTS).sum(axis=1, dtype=np.uint64)
        for step, lost in away:
            rows = np.arange(len(home)) if lost is None else np.flatnonzero(counts[:, lost])
            if len(rows):
                part = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([pa.array((home[rows] + step).view(np.int64)), *part.columns], ["cell", "wid", "word", "n"])


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether one replaced letter, or one that ``a`` has more, makes each word of ``a`` into that of ``b``; matrices of letters."""
    same = a[:, : b.shape[1]] == b
    if a.shape[1] == b.shape[1]:
        return same.sum(axis=1) == b.shape[1] - 1
    start = np.logical_and.accumulate(same, axis=1).sum(axis=1)
    end = np.logical_and.accumulate((a[:, 1:] == b)[:, ::-1], axis=1).sum(axis=1)
    return start + end >= b.shape[1]


class _Words:
    """Words of a block, in the order of their rows."""

    def __init__(self, wid: np.ndarray, n: np.ndarray, words: list[bytes]):
        self.wid, self.n, self.words = wid, n, words
        self.lengths = np.array([len(w) for w in words])
        self.bytes = np.frombuffer(b"".join(words), np.uint8)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def counts(self, place: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """How often the letters of each place (one for each of the 256) are in each word, and the sums of their squares."""
        owner = np.repeat(np.arange(len(self.words)), self.lengths)
        found = np.bincount(owner * width + place[self.bytes], minlength=len(self.words) * width).reshape(-1, width).astype(float)
        return found, (found**2).sum(axis=1)

    def letters(self, rows: np.ndarray, length: int) -> np.ndarray:
        return self.bytes[self.starts[rows][:, None] + np.arange(length)]


_FOUND = ["wid", "n_near", "best"]
_BEST = pa.struct([("less", pa.int64()), ("word", pa.binary())])


def _best(mine: _Words, i: np.ndarray, theirs: _Words, j: np.ndarray) -> pa.RecordBatch:
    """(wid, near words, best of them) of the words ``i`` of ``mine`` that are near the words ``j`` of ``theirs``."""
    met, place = np.unique(j, return_inverse=True)
    words = np.array([theirs.words[k] for k in met])  # bytes compare as the letters do
    rank = np.empty(len(met), np.int64)
    rank[np.argsort(words, kind="stable")] = np.arange(len(met))
    order = np.lexsort((rank[place], -theirs.n[j], i))
    first = order[np.flatnonzero(np.concatenate(([True], i[order][1:] != i[order][:-1])))]
    best = [pa.array(-theirs.n[j[first]], pa.int64()), pa.array([theirs.words[k] for k in j[first]], pa.binary())]
    count = np.bincount(i, minlength=len(mine.words))[i[first]]
    return pa.RecordBatch.from_arrays([pa.array(mine.wid[i[first]], pa.int64()), pa.array(count, pa.int64()), pa.StructArray.from_arrays(best, fields=list(_BEST))], _FOUND)


def _near_pairs(asking: _Words, held: _Words, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of near words; ``home``: of those whose own cell this is, a pair is taken from the side with the larger number."""
    letters = np.unique(held.bytes)
    # a near word has at most one letter that the other doesn't have, so letters that none of the words held has can be one
    place, width = np.full(256, len(letters)), len(letters) + 1
    place[letters] = np.arange(len(letters))
    theirs, their_squares = held.counts(place, width)
    found_i, found_j = [], []
    for s in range(0, len(asking.words), CHUNK):
        part = _Words(asking.wid[s : s + CHUNK], asking.n[s : s + CHUNK], asking.words[s : s + CHUNK])
        mine, squares = part.counts(place, width)
        distance = squares[:, None] + their_squares - 2 * (mine @ theirs.T)
        longer = part.lengths[:, None] - held.lengths
        kept = (distance <= 2) & ((longer == 0) | (longer == 1))
        own = home[s : s + CHUNK]
        kept &= ~own[:, None] | (held.wid < part.wid[:, None])
        i, j = np.nonzero(kept)
        for n in np.unique(part.lengths[i]).tolist():
            for m in (n, n - 1):
                at = np.flatnonzero((part.lengths[i] == n) & (held.lengths[j] == m))
                step = VERIFIED // n + 1
                for t in range(0, len(at), step):
                    x, y = i[at[t : t + step]], j[at[t : t + step]]
                    yes = one_edit(part.letters(x, n), held.letters(y, m))
                    found_i.append(x[yes] + s)
                    found_j.append(y[yes])
    if not found_i:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(found_i), np.concatenate(found_j)


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words within the blocks of a partition: sorted rows (cell, block, asks, home, wid, word, n)."""
    key, parts, held = None, [], None
    for batch in batches:
        cell, block, asks, home, wid, n = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1, 2, 3, 4, 6))
        words = batch.column(5).to_pylist()
        change = (cell[1:] != cell[:-1]) | (block[1:] != block[:-1]) | (asks[1:] != asks[:-1])
        edges = [0, *(np.flatnonzero(change) + 1).tolist(), len(words)]
        for a, b in zip(edges, edges[1:]):
            if a == b:
                continue
            if key != (cell[a], block[a]):
                key, parts, held = (cell[a], block[a]), [], None
            rows = wid[a:b], n[a:b], words[a:b]
            if not asks[a]:
                parts.append(rows)
                continue
            if held is None and parts:
                held, parts = _Words(*(np.concatenate(x) for x in list(zip(*parts))[:2]), [w for p in parts for w in p[2]]), []
            if held is None:
                continue
            asking = _Words(*rows)
            i, j = _near_pairs(asking, held, home[a:b])
            if len(i):
                yield _best(asking, i, held, j)
                yield _best(held, j, asking, i)


def near_words(vocab: DataFrame, block: int = BLOCK) -> DataFrame:
    """(wid, n_near, less, form) of ``vocab`` (wid, word, n): near words, the largest count among them negated, the least word with it."""
    row = "cell bigint, wid bigint, word binary, n bigint"
    coded = vocab.select("wid", F.encode("word", "ISO-8859-1").alias("word"), "n")
    own = stored(coded.mapInArrow(lambda b: _placed(b, False), row), "spelling-cells")
    sizes = stored(own.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks")), "spelling-blocks")
    columns = ["cell", "block", "asks", "home", "wid", "word", "n"]
    no, yes, every = F.lit(False), F.lit(True), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    placed = own.join(small(sizes, 16), "cell")
    held = placed.withColumn("block", F.pmod(F.xxhash64("wid"), "blocks").cast("int")).withColumn("asks", no).withColumn("home", yes)
    at_home = placed.withColumn("block", every).withColumn("asks", yes).withColumn("home", yes)
    # cells that hold no word are left out by the join
    asking = coded.mapInArrow(lambda b: _placed(b, True), row).join(small(sizes, 16), "cell")
    guests = asking.withColumn("block", every).withColumn("asks", yes).withColumn("home", no)
    # a number of its own: what a cell costs is work, not bytes
    tasks = min(vocab.count() // WORDS + 2, TASKS)
    everyone = held.select(*columns).union(at_home.select(*columns)).union(guests.select(*columns))
    dealt = everyone.repartition(tasks, "cell", "block").sortWithinPartitions("cell", "block", "asks", "wid")
    found = dealt.mapInArrow(_met, "wid bigint, n_near bigint, best struct<less:bigint,word:binary>")
    best = found.groupBy("wid").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    return best.select("wid", "n_near", "best.less", F.decode("best.word", "ISO-8859-1").alias("form"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where the forms of ``forms`` (word, form) lead."""
    at = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = small(at.select(F.col("word").alias("root"), F.col("root").alias("next")), 64)
        moved = stored(at.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if moved.where("moved").isEmpty():
            return moved.select("word", "root")
        at = moved.select("word", "root")


def spelling_variants(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", letters: int = MIN_LETTERS, least: int = MIN_COUNT,
    ratio: int = RATIO, drop: int | None = DROP, block: int = BLOCK,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) per word."""
    with workspace(docs.sparkSession):
        vocab = vocabulary(docs, text_col, id_col, letters, least, drop)
        # a number that is unique, and stays as it is once written
        vocab = stored(vocab.withColumn("wid", F.monotonically_increasing_id()), "vocabulary")
        found = vocab.join(near_words(vocab, block), "wid", "left")
        has_form = -F.col("less") >= F.lit(ratio) * F.col("n")
        described = stored(
            found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has_form, F.col("form")).alias("form"), F.when(has_form, -F.col("less")).alias("form_n")),
            "spelling-forms",
        )
        ends = small(roots(described.where("form IS NOT NULL")), 64)
        return settled(described.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
