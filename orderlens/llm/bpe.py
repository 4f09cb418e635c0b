"""Byte-pair encoding with forced boundaries, and decoding.

A pair of neighbouring bytes that occurs inside no token of the vocabulary can be inside no token
of an encoded text either: no merge ever joins the two bytes.  Such pairs mark certain cuts.  A
text is cut there, the fragments are encoded independently and their ids are concatenated.
Fragments repeat (they are mostly single words), so each task keeps a table of those it has met.

Cuts must also leave the vocabulary's pre-splitting pattern undisturbed.  That pattern looks
ahead only after white space, and joins across character classes only in the contractions after an
apostrophe.  Hence no cut is placed inside a character, after a white-space character or before an
apostrophe; at every other forced boundary a fragment is split exactly as it is inside its text:
either the pattern has its own boundary there, or both sides belong to one run of letters,
digits or marks, whose rest the pattern splits the same way.

Cases: a null text counts as empty and has no ids; a text holding the string of a special token
has that token's id there, as the library's default; long texts are cut like any other, and one
that has no forced boundary is a single fragment; repeated rows and null ids keep a row each; an empty table gives
an empty result; other columns, whatever their names, play no part.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOKENIZER = "byte_bpe_50k.json"
#: entries of a task's fragment table, and the longest fragment kept in it (bytes)
TABLE_ENTRIES, TABLE_BYTES = 300_000, 48
#: text encoded and handed on at once (bytes); a longer document goes alone
STEP_BYTES = 2 << 20

# ---- fixed values: white space in UTF-8 ends with one of these bytes ----
SPACE_ENDS = [*range(0x09, 0x0E), *range(0x1C, 0x21), *range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]


def tokenizer_path(name: str) -> str:
    """The place of a vocabulary file: a path as it is, a bare name by the installed collection."""
    if os.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write byte b as a printable character: itself, or the next free one from 256."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def load(path: str):
    """The library's tokenizer without truncation or padding, and its description."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    if spec["model"]["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or spec.get("normalizer"):
        raise ValueError(f"{path}: only byte-level BPE with the standard pattern and no normalizer has these boundaries")
    return tok, spec


class ForcedBoundaryCodec:
    """Encoder and decoder of one byte-level vocabulary."""

    def __init__(self, path: str):
        self._tok, spec = load(path)
        byte_of = _byte_of_char()
        special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.bytes_of: list[bytes] = [b""] * self._tok.get_vocab_size(with_added_tokens=True)
        inside = np.zeros((256, 256), bool)
        for token, i in spec["model"]["vocab"].items():
            if token not in special:
                self.bytes_of[i] = raw = bytes(byte_of[c] for c in token)
                a = np.frombuffer(raw, np.uint8)
                inside[a[:-1], a[1:]] = True
        for token, i in special.items():
            self.bytes_of[i] = token.encode()
        forced = ~inside
        forced[:, 0x80:0xC0] = False  # inside a character
        forced[:, ord("'")] = False
        forced[SPACE_ENDS, :] = False
        self._forced = forced.ravel()
        self._special = {t: np.array([i], "<u4").tobytes() for t, i in special.items()}
        longest_first = sorted(special, key=len, reverse=True)
        self._special_re = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if special else None
        self._table: dict[bytes, bytes] = {}

    def cuts(self, raw: bytes) -> list[int]:
        """Where the fragments of ``raw`` begin and end."""
        a = np.frombuffer(raw, np.uint8)
        pair = (a[:-1].astype(np.uint16) << 8) | a[1:]
        return [0, *(np.flatnonzero(self._forced[pair]) + 1).tolist(), len(raw)]

    def fragments(self, text: str) -> list[bytes]:
        raw = text.encode()
        if len(raw) < 2:
            return [raw] if raw else []
        at = self.cuts(raw)
        return [raw[i:j] for i, j in zip(at, at[1:])]

    def _parts(self, text: str) -> list[str]:
        """The text around and at special tokens' strings."""
        return self._special_re.split(text) if self._special_re and any(t in text for t in self._special) else [text]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        cut = [[[part] if part in self._special else self.fragments(part) for part in self._parts(text)] for text in texts]
        known = dict(self._special)
        table = self._table
        new = {f for parts in cut for fragments in parts for f in fragments if f not in table and f not in known}
        if new:
            if len(table) > TABLE_ENTRIES:
                table.clear()
                new = {f for parts in cut for fragments in parts for f in fragments if f not in known}
            fragments = list(new)
            for i in range(0, len(fragments), 4096):
                some = fragments[i : i + 4096]
                for f, e in zip(some, self._tok.encode_batch([f.decode() for f in some], add_special_tokens=False)):
                    known[f] = np.array(e.ids, "<u4").tobytes()
            table.update((f, ids) for f, ids in known.items() if isinstance(f, bytes) and len(f) <= TABLE_BYTES)
        # what is too long to keep is in known, the rest in the table
        find = table.get
        return [b"".join([find(f) or known[f] for fragments in parts for f in fragments]) for parts in cut]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def codec(path: str) -> ForcedBoundaryCodec:
    return ForcedBoundaryCodec(path)


def steps(lengths: list[int], most: int = STEP_BYTES) -> Iterator[slice]:
    """Consecutive slices of rows that hold about ``most`` bytes each."""
    start, total = 0, 0
    for i, n in enumerate(lengths):
        if i > start and total + n > most:
            yield slice(start, i)
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield slice(start, len(lengths))


def encode(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", tokenizer: str = TOKENIZER) -> DataFrame:
    """(id, ids array<int>) per row of ``docs``; a partition at a time, some megabytes of text at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(tokenizer_path(tokenizer))
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for s in steps([len(t) for t in texts]):
                raw = c.encode(texts[s])
                ends = np.cumsum([0] + [len(r) // 4 for r in raw])
                values = pa.array(np.frombuffer(b"".join(raw), "<i4"), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[s], pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)], ["id", "ids"]
                )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, ids_col: str = "ids", id_col: str = "doc_id", tokenizer: str = TOKENIZER) -> DataFrame:
    """(id, ids, text) per row of ``encoded``, special tokens written out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(tokenizer_path(tokenizer))
        for batch in batches:
            lists = batch.column(1)
            counts = [n or 0 for n in lists.value_lengths().to_pylist()]
            for s in steps([4 * n for n in counts]):
                some = lists[s]
                texts = [c.decode(x.values.to_numpy()) if x.is_valid else "" for x in some]
                yield pa.RecordBatch.from_arrays([batch.column(0)[s], some, pa.array(texts, pa.string())], ["id", "ids", "text"])

    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    schema = T.StructType([*rows.schema.fields, T.StructField("text", T.StringType())])
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def round_trip_digests(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Encode, decode, and digest both: (doc_id, n_tokens, ids_sha256, decoded_sha256).

    Encoder and decoder run in the same pass over a batch, so that the ids aren't copied to the JVM
    and back in between; the ids that are hashed are the ids that are decoded.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(tokenizer_path(tokenizer))
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for s in steps([len(t) for t in texts]):
                raw = c.encode(texts[s])
                decoded = [c.decode(np.frombuffer(r, "<u4")).encode() for r in raw]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[s],
                        pa.array([len(r) // 4 for r in raw], pa.int64()),
                        pa.array([hashlib.sha256(r).hexdigest() for r in raw]),
                        pa.array([hashlib.sha256(t).hexdigest() for t in decoded]),
                    ],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = T.StructType(
        [
            T.StructField("doc_id", rows.schema["doc_id"].dataType),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
    )
    return rows.mapInArrow(run, schema)
