"""WARC archives: a deterministic sharded writer, and a reader.

Writing.  Of pages with equal payloads, the one with the largest id is archived in full (a response)
and the others refer to it (revisits).  Records are sorted by id (null first), digest and URL; a shard is a range of that order with
about ``shard_bytes`` of payload.  The bounds of the ranges are exact: running sums of bytes over ids and digests, which no
layout of the input changes, so the same pages give the same files byte for byte: dates are a
parameter, record ids derive from page id, digest and place among equal records, and compressed members carry no time.
Within a shard, files roll by compressed size.  A task writes one shard or more, each bounded, whatever the number of rows
under one id or without an id.  There are ``MAX_SHARDS`` at most, so that their bounds fit every task; beyond that
number shards get larger.

Commit.  A task attempt writes its files under a temporary name of its own and returns a manifest row
for each; Spark's own commit decides which attempt's rows count.  A second pass moves exactly those
files to their final names (moving again is harmless) and writes the final manifest, with the shard's first key.  Files of lost
or repeated attempts are in no manifest and go with the temporary folder.

Reading.  The files that the manifest names, and no others, are read; a file's length and digest must be those of the
manifest.  Every record's headers are parsed, and digests and lengths are computed anew and compared.

The payloads are shuffled once: which pages are revisits is found on ids and digests alone, and meets
the payloads in the writer as a merge of two sorted streams.

Files are written and read with Arrow's file systems in the folder given, which all executors must reach: local or mounted
paths (``file:``), ``s3:`` (``s3a:`` and ``s3n:`` count as such), ``gs:``, ``hdfs:`` where Arrow has them.  Another scheme is an error.

Cases: a null html is an empty payload; a null url is an empty target; pages without an id are responses only if
no page with an id has their payload; rows that repeat the largest id of their payload are responses each;
very long payloads are records like others (a record is never split); an empty table gives an empty manifest and no archive; other columns play no part.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlens.llm.common import importable, remove, scratch, settled, small, stored, workspace

#: payload bytes of a shard, compressed bytes at which a file rolls, payloads from which repeats are revisits
SHARD_BYTES, ROLL_BYTES, REVISIT_BYTES = 64 << 20, 8 << 20, 0
#: shards at most, equal records that are dealt out together, bytes that a record costs besides its payload
MAX_SHARDS, RANGE, RECORD_BYTES = 20_000, 256, 512
LEVEL = 5
#: compressed bytes that are read at once, rows that are Python objects at once
_PIECE, _ROWS = 1 << 14, 64
DATE = "2024-01-01T00:00:00Z"
SOFTWARE = "orderlens"

# ---- fixed values of the format ----
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_RESPONSE, HTTP_INFO = "application/http;msgtype=response", "application/warc-fields"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL namespace of RFC 4122
# ------------------------------------


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(*parts) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, ':'.join(map(str, parts)))}>"


def _member(headers: list[tuple[str, object]], block: bytes) -> bytes:
    """One record as a gzip member of its own."""
    lines = [VERSION, *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}", "", ""]
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n") + z.flush()


def _http_head(length: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()


def info_record(name: str) -> bytes:
    block = f"software: {SOFTWARE}\r\nformat: {VERSION}\r\n".encode()
    return _member(
        [("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id("info", name)), ("WARC-Date", DATE), ("WARC-Filename", name), ("Content-Type", HTTP_INFO)],
        block,
    )


def page_record(page_id: int | None, url: str, payload: bytes, newest: tuple[int, str] | None = None, place: int = 0) -> bytes:
    """A response with its payload, or a revisit of the page ``newest`` (id, URL) with the headers only; ``place``: among equal records."""
    digest = payload_digest(payload)
    head = _http_head(len(payload))
    block = head if newest else head + payload
    headers = [
        ("WARC-Type", "revisit" if newest else "response"),
        ("WARC-Record-ID", _page_record_id(page_id, digest, url, place)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", "".join(url.split())),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{payload_digest(block)}"),
        ("Content-Type", HTTP_RESPONSE),
    ]
    if page_id is not None:
        headers.append(("Page-ID", page_id))
    if newest:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _page_record_id(newest[0], digest, newest[1], 0)), ("Refers-To-Page-ID", newest[0])]
    return _member(headers, block)


def _page_record_id(page_id: int | None, digest: str, url: str, place: int) -> str:
    return record_id("page", "" if page_id is None else page_id, digest, place, hashlib.sha1(url.encode()).hexdigest())


#: schemes that Arrow knows by another name
_SCHEMES = {"s3a://": "s3://", "s3n://": "s3://"}


def _filesystem(folder: str):
    from pyarrow import fs

    for scheme, known in _SCHEMES.items():
        if folder.startswith(scheme):
            folder = known + folder[len(scheme) :]
    try:
        return fs.FileSystem.from_uri(folder)
    except pa.ArrowInvalid as e:
        raise ValueError(f"archives can't be kept in {folder}: a path or one of file:, s3:, gs:, hdfs: is needed") from e


def _sort_key(page_id: Column, digest: Column, url: Column, place: Column) -> Column:
    """A text whose order is that of the records: id (null first), digest, URL, place among equal records."""
    # ids as unsigned numbers from the least one on
    shifted = F.lpad(F.hex(page_id.bitwiseXOR(F.lit(-(2**63)))), 16, "0")
    return F.concat(
        F.when(page_id.isNull(), F.lit("0" * 17)).otherwise(F.concat(F.lit("1"), shifted)), digest, F.md5(url.cast("binary")), F.lpad(F.hex(place), 16, "0")
    )


def _sharded(batches: Iterator[pa.RecordBatch], bounds: list[str]) -> Iterator[pa.RecordBatch]:
    """Each row, whose first column is its sort key, with the number of its shard in front."""
    for batch in batches:
        shards = pa.array([bisect.bisect_right(bounds, k) - 1 for k in batch.column(0).to_pylist()], pa.int32())
        yield pa.RecordBatch.from_arrays([shards, *batch.columns], ["shard", *batch.schema.names])


def _bounds(keys: DataFrame, shard_bytes: int) -> list[str]:
    """The first sort key of each shard, for keys (key, bytes, records): exact running sums of bytes in the order of the keys."""
    total = keys.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    size = max(shard_bytes, -(-total // MAX_SHARDS))
    ranged = keys.repartitionByRange("key").sortWithinPartitions("key").withColumn("part", F.spark_partition_id())
    placed = stored(ranged, "warc-ranged")
    starts = placed.groupBy("part").agg(F.sum("bytes").alias("in_part"))
    # a row for each partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # so many numbers: broadcast as they are
    starts = F.broadcast(starts.withColumn("start", F.coalesce(F.sum("in_part").over(before), F.lit(0))).select("part", "start"))
    in_part = Window.partitionBy("part").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    summed = placed.withColumn("before", F.coalesce(F.sum("bytes").over(in_part), F.lit(0))).join(starts, "part")
    shard = F.floor((F.col("start") + F.col("before")) / size)
    # as many rows as there are shards
    firsts = summed.groupBy(shard.alias("shard")).agg(F.min("key").alias("first")).select("first").collect()
    return sorted(r[0] for r in firsts)


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, few at a time: as Python objects, payloads take memory a second time."""
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            yield batch.slice(at, _ROWS)


def _write(batches: Iterator[pa.RecordBatch], folder: str, roll: int) -> Iterator[pa.RecordBatch]:
    """Write the sorted rows (shard, key, page_id, digest, kind, url, html, place, records, newest) of a partition; a manifest row for each file."""
    store, root = _filesystem(folder)
    attempt = f"{root}/_temporary/{uuid.uuid4().hex}"
    store.create_dir(attempt, recursive=True)
    buffer, records, shard, part, decided, first = io.BytesIO(), 0, None, 0, None, None

    def name() -> str:
        return f"shard-{shard:05d}-{part:05d}.warc.gz"

    def close() -> pa.RecordBatch:
        data = buffer.getvalue()
        with store.open_output_stream(f"{attempt}/{name()}", compression=None) as f:
            f.write(data)
        return pa.RecordBatch.from_pydict(
            {"name": [name()], "attempt": [attempt.rsplit("/", 1)[1]], "records": [records], "bytes": [len(data)], "sha256": [hashlib.sha256(data).hexdigest()], "first_key": [first]}
        )

    for batch in _sliced(batches):
        for s, key, page_id, digest, kind, url, html, place, times, newest in zip(*(c.to_pylist() for c in batch.columns)):
            if kind == 0:  # a decision, right before its page
                decided = (key, newest, url)
                continue
            revisit = decided is not None and decided[0] == key
            for i in range(place, place + times):
                if s != shard or buffer.tell() >= roll:
                    if records:
                        yield close()
                    part = part + 1 if s == shard else 0
                    shard, records, first = s, 0, key
                    buffer = io.BytesIO()
                    buffer.write(info_record(name()))
                buffer.write(page_record(page_id, url, html.encode(), decided[1:] if revisit else None, i))
                records += 1
    if records:
        yield close()


def _move(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """Give the files of the staged manifest their final names; a file that is there already stays."""
    from pyarrow import fs

    store, root = _filesystem(folder)
    store.create_dir(f"{root}/archives", recursive=True)
    for batch in batches:
        for name, attempt, size in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
            final = f"{root}/archives/{name}"
            temporary = f"{root}/_temporary/{attempt}/{name}"
            if store.get_file_info(temporary).type == fs.FileType.File:
                try:
                    store.move(temporary, final)
                except FileNotFoundError:  # a second attempt of this task has moved it meanwhile
                    pass
            if store.get_file_info(final).size != size:
                raise OSError(f"{final} isn't what the manifest says")
        yield batch


MANIFEST = "name string, attempt string, records bigint, bytes bigint, sha256 string, first_key string"


def write_archives(pages: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES, roll: int = ROLL_BYTES, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives under ``folder``; the manifest."""
    spark = pages.sparkSession
    store, root = _filesystem(folder)
    store.create_dir(f"{root}/_temporary", recursive=True)  # also if there is no page to write
    with workspace(spark):
        staged, shards = _staged(pages, folder, shard_bytes, roll, revisit_bytes)
        manifest = f"{folder}/manifest"
        staged.repartition(min(max(shards, 1), MAX_SHARDS), "name").mapInArrow(lambda b: _move(b, folder), MANIFEST).write.parquet(manifest)
    store.delete_dir(f"{root}/_temporary")
    return spark.read.schema(MANIFEST).parquet(manifest)


def _staged(pages: DataFrame, folder: str, shard_bytes: int, roll: int, revisit_bytes: int) -> tuple[DataFrame, int]:
    """The rows of the files written so far, and the number of shards."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.sha1(payload.cast("binary")).alias("digest"),
        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        payload.alias("html"),
    )
    same = ["page_id", "digest", "url"]
    # ids and digests alone
    keys = rows.select(*same, F.octet_length("html").cast("long").alias("length")).groupBy(*same, "length").agg(F.count(F.lit(1)).alias("n"))
    # equal records in ranges: (page_id, digest, url, place of the first, how many)
    place = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(RANGE).cast("long")))
    ranges = keys.select(*same, "length", "n", place.alias("place")).withColumn("records", F.least(F.lit(RANGE), F.col("n") - F.col("place")))
    sort_key = _sort_key(F.col("page_id"), F.col("digest"), F.col("url"), F.col("place"))
    # the one table of them that is kept; each has a first range
    ranges = stored(ranges.withColumn("key", sort_key), "warc-ranges")
    keys = ranges.where("place = 0")
    # equal payloads meet by digest and length
    newest = (
        keys.where(F.col("length") >= revisit_bytes).groupBy("digest", "length")
        .agg(F.max(F.struct("page_id", "url")).alias("newest"), F.sum("n").alias("times")).where("times > 1 AND newest.page_id IS NOT NULL")
        .select("digest", "length", F.col("newest.page_id").alias("newest"), F.col("newest.url").alias("newest_url"))
    )
    decisions = ranges.join(newest, ["digest", "length"]).where("page_id IS NULL OR page_id <> newest")
    weight = F.col("records") * (F.col("length") + RECORD_BYTES)
    bounds = _bounds(ranges.select("key", weight.alias("bytes")), shard_bytes)

    columns = ["key", "page_id", "digest", "kind", "url", "html", "place", "records", "newest"]
    text, one = F.lit(None).cast("string"), F.lit(1).cast("long")
    told = decisions.select("key", "page_id", "digest", F.lit(0).alias("kind"), F.col("newest_url").alias("url"), text.alias("html"), "place", one.alias("records"), "newest")
    repeated = keys.where("n > 1").select(*same)
    if repeated.isEmpty():
        full = rows.withColumn("place", F.lit(0).cast("long")).withColumn("records", one)
    else:
        again = repeated.select(*[F.col(c).alias(f"again_{c}") for c in same])
        on = rows["page_id"].eqNullSafe(again["again_page_id"]) & (rows["digest"] == again["again_digest"]) & (rows["url"] == again["again_url"])
        single = rows.join(small(again, 128), on, "left_anti").withColumn("place", F.lit(0).cast("long")).withColumn("records", one)
        # one payload of each, before its ranges
        one_each = rows.join(small(again, 128), on, "left_semi").groupBy(*same).agg(F.any_value("html").alias("html"))
        on = one_each["page_id"].eqNullSafe(ranges["page_id"]) & (one_each["digest"] == ranges["digest"]) & (one_each["url"] == ranges["url"])
        many = one_each.join(ranges.where("n > 1"), on).select(*[one_each[c] for c in same], "html", "place", "records")
        full = single.unionByName(many)
    full = full.withColumn("key", sort_key).withColumn("kind", F.lit(1)).withColumn("newest", F.lit(None).cast("long"))
    # a page's decision sorts right before it
    both = full.select(*columns).union(told.select(*columns))
    schema = ", ".join(["shard int", *(f"`{f.name}` {f.dataType.simpleString()}" for f in both.schema)])
    dealt = both.mapInArrow(lambda b: _sharded(b, bounds), schema).repartitionById(max(len(bounds), 1), "shard")
    files = dealt.sortWithinPartitions("shard", "key", "kind").mapInArrow(lambda b: _write(b, folder, roll), MANIFEST)
    return stored(files, "warc-staged"), len(bounds)


def members(data: bytes) -> Iterator[bytes]:
    """The decompressed gzip members of an archive, one after the other."""
    view, at = memoryview(data), 0
    while at < len(view):
        z = zlib.decompressobj(31)
        parts = []
        # piece by piece, as what is left over is copied each time
        while not z.eof:
            if at >= len(view):
                raise ValueError("an archive ends within a record")
            piece = view[at : at + _PIECE]
            parts.append(z.decompress(piece))
            at += len(piece)
        at -= len(z.unused_data)
        yield b"".join(parts)


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record; the declared length must be the real one."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    length = int(headers["Content-Length"])
    if version != VERSION or len(rest) != length + 4 or not rest.endswith(b"\r\n\r\n"):
        raise ValueError(f"damaged record {headers.get('WARC-Record-ID')}")
    return headers, rest[:length]


def _records(path: str, data: bytes) -> Iterator[tuple]:
    """The pages of an archive, each record checked."""
    for record in members(data):
        headers, block = parse(record)
        kind = headers["WARC-Type"]
        if kind == "warcinfo":
            continue
        if headers["WARC-Block-Digest"] != f"sha1:{payload_digest(block)}":
            raise ValueError(f"{path}: damaged block of {headers['WARC-Record-ID']}")
        http, _, payload = block.partition(b"\r\n\r\n")
        digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
        length = int(http.decode().rpartition("Content-Length: ")[2])
        if kind == "response" and (len(payload), payload_digest(payload)) != (length, digest):
            raise ValueError(f"{path}: damaged payload of {headers['WARC-Record-ID']}")
        ids = [int(x) if (x := headers.get(k)) else None for k in ("Page-ID", "Refers-To-Page-ID")]
        text = payload.decode() if kind == "response" else None
        yield ids[0], headers["WARC-Target-URI"], length, digest, kind, ids[1], text, path, headers["WARC-Record-ID"]


_COLUMNS = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload", "file", "record_id"]
_TYPES = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
#: records and payload bytes that are passed on together
_PASSED, _PASSED_BYTES = 1000, 4 << 20


def _read(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    store, root = _filesystem(folder)
    for batch in batches:
        for name, size, sha256 in zip(*(c.to_pylist() for c in batch.columns)):
            with store.open_input_stream(f"{root}/archives/{name}", compression=None) as f:
                data = f.read()
            if (len(data), hashlib.sha256(data).hexdigest()) != (size, sha256):
                raise ValueError(f"{name} isn't what the manifest says")
            rows: list[tuple] = []
            held = 0
            for row in _records(name, data):
                rows.append(row)
                # a revisit has a length and no payload
                held += row[2] if row[6] is not None else 0
                if len(rows) == _PASSED or held >= _PASSED_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), _TYPES)], _COLUMNS)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), _TYPES)], _COLUMNS)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each response and revisit in the archives that the manifest under ``folder`` names."""
    importable(spark)
    named = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").select("name", "bytes", "sha256")
    # a task reads its files one after the other; what they cost is in the files, not in these rows
    files = named.repartition(min(max(named.count(), 1), MAX_SHARDS), "name")
    return files.mapInArrow(
        lambda b: _read(b, folder),
        "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload string, file string, record_id string",
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives and read them back: (page_id, payload_bytes, payload_digest, record_type, refers_to)."""
    spark = pages.sparkSession
    folder = scratch(spark, "warc")
    try:
        write_archives(pages, folder)
        return settled(read_archives(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
    finally:
        remove(spark, folder)
