"""Token counts, with overlap resynchronisation for huge documents.

A document of at most ``chunk`` characters is encoded whole, by the codec of ``bpe``, which gives the
library's ids and keeps a table of the fragments it has met.  A longer one is dealt out as
overlapping chunks, which may be encoded in different tasks: chunk k owns the characters from
``k * chunk`` and is encoded with ``overlap`` more on either side, with offsets.  Where two
neighbours overlap, both report the token boundaries there that are provably stable, and the two
encodings are spliced at the last one they share.

A boundary is stable if a non-space character stands before it and a space character after it.
The vocabulary's pattern always ends a piece there whatever surrounds it, has no look-behind, and
looks ahead only after white space; so the tokens left of it don't depend on what follows, nor
those right of it on what precedes.  A chunk therefore vouches only for boundaries right of its own
first stable one, since what precedes that may be cut in the middle of a word.

If two neighbours share none (a passage without white space), the document is encoded again with
an overlap that is eight times wider, until a chunk covers the document.  Texts that occur more
than once are encoded once; the count is looked up by the digest of the text.

Cases: null and empty texts have 0 tokens; strings of special tokens are encoded as the library
does by default, and a text that holds one is encoded whole, as a special token may end a piece
inside a word.  Rows are never merged: repeated rows and null ids keep a row each.  An empty table gives an
empty result; other columns, whatever their names, play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.llm.bpe import TOKENIZER, codec, load, steps, tokenizer_path
from orderlens.llm.common import settled, stored, workspace

#: characters that a chunk owns, and that it shares with each neighbour at first
CHUNK, OVERLAP = 32_768, 512
#: chunks for each partition, and partitions at most
PIECES, TASKS = 32, 20_000
WIDEN = 8
#: ASCII white space is enough for stable boundaries
SPACE = "\t\n\v\f\r "


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    tok, spec = load(path)
    return tok, [a["content"] for a in spec["added_tokens"]]


def _counts(batches: Iterator[pa.RecordBatch], tokenizer: str) -> Iterator[pa.RecordBatch]:
    encoder = codec(tokenizer_path(tokenizer))
    for batch in batches:
        texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
        counts: list[int] = []
        for s in steps([len(t) for t in texts], 1 << 20):
            counts += [len(ids) // 4 for ids in encoder.encode(texts[s])]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(counts, pa.int64())], [*batch.schema.names[:-1], "n_tokens"]
        )


def _with_counts(rows: DataFrame, tokenizer: str) -> DataFrame:
    """Replace the last column of ``rows``, a text, by its number of tokens."""
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("n_tokens", T.LongType())])
    return rows.mapInArrow(lambda batches: _counts(batches, tokenizer), schema)


def _deal(batches: Iterator[pa.RecordBatch], chunk: int, overlap: int, specials: list[str]) -> Iterator[pa.RecordBatch]:
    """The overlapping chunks of each text: (digest, k, last, offset, text)."""
    names = ["digest", "k", "last", "offset", "text"]
    for batch in batches:
        for digest, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            whole = any(t in text for t in specials)
            n = 1 if whole or 2 * overlap >= len(text) else -(-len(text) // chunk)
            for k in range(n):
                start = max(0, k * chunk - overlap)
                end = len(text) if k == n - 1 else (k + 1) * chunk + overlap
                yield pa.RecordBatch.from_pydict(
                    {"digest": [digest], "k": [k], "last": [k == n - 1], "offset": [start], "text": [text[start:end]]}
                ).select(names)


def _stable(text: str, encoding, start: int, end: int, offset: int) -> list[dict[str, int]]:
    """The token boundaries in [start, end) that have a non-space character before and a space after."""
    marks = []
    for at in range(max(start, 1), min(end, len(text))):
        if text[at] in SPACE and not text[at - 1].isspace():
            token = encoding.char_to_token(at)
            if token is not None and encoding.token_to_chars(token)[0] == at:
                marks.append({"at": offset + at, "before": token})
    return marks


def _encode_chunks(batches: Iterator[pa.RecordBatch], chunk: int, overlap: int, tokenizer: str) -> Iterator[pa.RecordBatch]:
    """Per chunk its number of tokens and, for both overlaps, the stable token boundaries as
    (position in the document, number of the chunk's tokens before it)."""
    tok, _ = _tokenizer(tokenizer_path(tokenizer))
    marks = pa.list_(pa.struct([("at", pa.int64()), ("before", pa.int64())]))
    for batch in batches:
        rows = batch.to_pylist()
        out = {"digest": [], "k": [], "last": [], "n": [], "left": [], "right": []}
        for s in steps([len(r["text"]) for r in rows], 1 << 20):
            encodings = tok.encode_batch([r["text"] for r in rows[s]], add_special_tokens=False)
            for r, e in zip(rows[s], encodings):
                left = r["k"] * chunk + overlap - r["offset"]  # where the overlaps end and begin in this chunk
                right = (r["k"] + 1) * chunk - overlap - r["offset"]
                left_marks = _stable(r["text"], e, 0, left + 1, r["offset"])[1:] if r["k"] else []
                right_marks = [] if r["last"] else _stable(r["text"], e, right, len(r["text"]), r["offset"])
                out["digest"].append(r["digest"])
                out["k"].append(r["k"])
                out["last"].append(r["last"])
                out["n"].append(len(e))
                out["left"].append(left_marks)
                out["right"].append(right_marks)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(out["digest"], pa.string()),
                pa.array(out["k"], pa.int64()),
                pa.array(out["last"], pa.bool_()),
                pa.array(out["n"], pa.int64()),
                pa.array(out["left"], marks),
                pa.array(out["right"], marks),
            ],
            list(out),
        )


_MARKS = "array<struct<at: bigint, before: bigint>>"


def _spliced(texts: DataFrame, chunk: int, overlap: int, tokenizer: str) -> DataFrame:
    """(digest, n_tokens) of huge texts; null where two neighbours share no stable boundary."""
    specials = _tokenizer(tokenizer_path(tokenizer))[1]
    # a number of its own: what a chunk costs is work, not bytes
    pieces = texts.agg(F.coalesce(F.sum(F.ceil(F.length("text") / chunk)), F.lit(0))).first()[0]
    chunks = texts.mapInArrow(
        lambda b: _deal(b, chunk, overlap, specials), "digest string, k bigint, last boolean, offset bigint, text string"
    ).repartition(min(pieces // PIECES + 2, TASKS), "digest", "k")  # the chunks of one document go to many tasks
    encoded = chunks.mapInArrow(
        lambda b: _encode_chunks(b, chunk, overlap, tokenizer),
        f"digest string, k bigint, last boolean, n bigint, left {_MARKS}, right {_MARKS}",
    )
    # both neighbours report within the same stretch of the document
    following = F.lead("left").over(Window.partitionBy("digest").orderBy("k"))
    shared = F.array_max(F.array_intersect(F.col("right.at"), F.col("next.at")))
    before = lambda marks: F.get(F.filter(marks, lambda m: m["at"] == F.col("at")), F.lit(0))["before"]
    paired = encoded.withColumn("next", following).withColumn("at", shared)
    return (
        paired.withColumn("own", F.when(F.col("last"), F.col("n")).otherwise(before("right")))
        .withColumn("passed", F.when(F.col("last"), F.lit(0)).otherwise(before("next")))
        .groupBy("digest")
        # each chunk counts up to its splice, and the next one from there
        .agg(F.when(F.count("own") == F.count(F.lit(1)), F.sum("own") - F.sum("passed")).alias("n_tokens"))
    )


def huge_text_counts(
    docs: DataFrame, text_col: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP, tokenizer: str = TOKENIZER
) -> DataFrame:
    """(digest, n_tokens) of the distinct texts of ``docs``; the overlap widens until all align."""
    texts = docs.select(F.sha2(text_col, 256).alias("digest"), F.col(text_col).alias("text"))
    # one row a text, by its digest alone: rows of the same text collapse before any text is shuffled
    texts = stored(texts.dropDuplicates(["digest"]), "huge-texts")
    done = None
    while True:
        counts = stored(_spliced(texts, chunk, overlap, tokenizer), "huge-counts")
        aligned = counts.where(F.col("n_tokens").isNotNull())
        done = aligned if done is None else done.unionByName(aligned)
        left = counts.where(F.col("n_tokens").isNull())
        if left.isEmpty():
            return done
        texts = stored(texts.join(left, "digest", "left_semi"), "huge-texts")
        overlap *= WIDEN
        chunk = max(chunk, 4 * overlap)


def count_tokens(
    docs: DataFrame, limit: int = 1024, chunk: int = CHUNK, overlap: int = OVERLAP, tokenizer: str = TOKENIZER
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) per row of ``docs``."""
    huge = F.length("text") > chunk
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    small = _with_counts(rows.where(~huge), tokenizer)
    with workspace(docs.sparkSession):
        counts = settled(huge_text_counts(rows.where(huge), "text", chunk, overlap, tokenizer))
    long_rows = rows.where(huge).select("doc_id", "n_bytes", F.sha2("text", 256).alias("digest"))
    long = long_rows.join(counts, "digest", "inner").select("doc_id", "n_bytes", "n_tokens")
    return small.unionByName(long).withColumn("over_limit", F.col("n_tokens") > limit)
