"""WARC archives with a chunked record table.

A payload is held as rows (record id, chunk number, bytes), and no step puts one together. ``chunk_table`` cuts payloads, in the buffer they are
read into, into chunks of at most ``chunk_bytes`` and carries the SHA-1 and length of everything up to and with each chunk; the last one's are
the payload's. ``write_warc`` joins chunk rows and writes one WARC 1.0 record a chunk: payloads of one chunk become plain records, longer ones are
segmented as the standard lays down (``WARC-Segment-Number``, ``continuation`` records,
``WARC-Segment-Total-Length`` on the last). ``read_warc`` gives the chunk rows back, and ``digest_records`` sums them
up in one pass over chunks in order, holding one batch of rows.

Archives are written and read with Spark's text source, so they live in any store that Spark reaches: CRLFCRLF ends a
record, and reading splits before each version line. A payload that holds the version line itself is cut inside it
(between two chunks), so that no block of a written archive contains it. In archives from elsewhere such a block is
found by its Content-Length and raises an error.

Equal payloads of ``min_revisit_bytes`` or more are stored once: the largest id is the response, the others are revisit
records that refer to it.

Defined results: NULL payloads are empty payloads; NULL urls give a record without a target URI. A NULL id comes back as
NULL; it is no response to others unless all copies lack one. Repeated rows give records with equal ids, each digested on
its own. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.llm.storage import stored
from wattloom.shared import scratch_path

VERSION_LINE = b"WARC/1.0\r\n"
END = "\r\n\r\n"
_version_line = re.compile(re.escape(VERSION_LINE))
DATE = "1970-01-01T00:00:00Z"

CHUNKS = "id bigint, chunk int, last boolean, data binary, bytes_so_far bigint, sha1_so_far string, bytes bigint, sha1 string, uri string, row bigint"
RECORDS = "id bigint, row bigint, chunk int, type string, refers_to bigint, digest string, total bigint, uri string, data binary"
_batch_bytes = 4 << 20


def cuts(data: bytes | memoryview, chunk_bytes: int) -> list[int]:
    """Chunk borders from 0 to the end; a version line never lies within one chunk."""
    edges, at = [0], 0
    for mark in [*(m.start() + 4 for m in _version_line.finditer(data)), len(data)]:
        while mark - at > chunk_bytes:
            at += chunk_bytes
            edges.append(at)
        if mark > at or len(edges) == 1:
            at = mark
            edges.append(at)
    return edges


def _digested(data: memoryview, chunk_bytes: int) -> list[tuple[int, int, str]]:
    """(begin, end, SHA-1 up to the end) of each chunk."""
    edges, digest, out = cuts(data, chunk_bytes), hashlib.sha1(), []
    for a, b in zip(edges, edges[1:]):
        digest.update(data[a:b])
        out.append((a, b, digest.hexdigest()))
    return out


def _views(column: pa.Array) -> Iterator[memoryview]:
    for value in column:
        yield memoryview(value.as_buffer()) if value.is_valid else memoryview(b"")


def chunk_table(
    pages: DataFrame, chunk_bytes: int, id_column: str = "page_id", payload: str = "html", uri: str | None = None
) -> DataFrame:
    """The chunk rows of each payload, with digest and length up to and with each chunk, and of the whole (``bytes``, ``sha1``).

    ``row`` tells rows of ``pages`` apart.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        for part in parts:
            for number, uri, row, data in zip(*(part.column(k).to_pylist() for k in (0, 1, 2)), _views(part.column(3))):
                chunks = _digested(data, chunk_bytes)
                for k, (a, b, so_far) in enumerate(chunks):
                    out.append((number, k, b == len(data), bytes(data[a:b]), b, so_far, len(data), chunks[-1][2], uri, row))
                    held += b - a
                    if held > _batch_bytes:
                        yield _rows(out, CHUNKS)
                        out, held = [], 0
        yield _rows(out, CHUNKS)

    return _narrow(pages, id_column, payload, uri).mapInArrow(run, CHUNKS)


def _narrow(pages: DataFrame, id_column: str, payload: str, uri: str | None) -> DataFrame:
    named = F.col(uri).cast("string") if uri else F.lit(None).cast("string")
    return pages.select(
        F.col(id_column).cast("bigint").alias("id"), named.alias("uri"), F.monotonically_increasing_id().alias("row"), F.col(payload).cast("binary").alias("data")
    )


_types = {"bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string()}


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [x.split() for x in schema.split(", ")]
    columns = zip(*rows) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, _types[t]) for c, (_, t) in zip(columns, fields)], [n for n, _ in fields])


def repeated_payloads(
    pages: DataFrame, min_revisit_bytes: int, id_column: str = "page_id", payload: str = "html", chunk_bytes: int = 32 << 10
) -> DataFrame:
    """(sha1, bytes, response): the largest id of each payload of ``min_revisit_bytes`` or more that is there twice or more."""
    schema = "id bigint, bytes bigint, sha1 string"

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            yield _rows([(i, len(d), _digested(d, chunk_bytes)[-1][2]) for i, d in zip(part.column(0).to_pylist(), _views(part.column(3)))], schema)

    digests = _narrow(pages, id_column, payload, None).where(F.octet_length("data") >= min_revisit_bytes).mapInArrow(run, schema)
    counted = digests.groupBy("sha1", "bytes")
    return counted.agg(F.max("id").alias("response"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).drop("n")


_NO_ID = "<urn:uuid:00000000-0000-0001-0000-000000000000>"


def _urn(number: Column) -> Column:
    """The record id of a row: a urn that holds its id."""
    low = F.lpad(F.lower(F.hex(number)), 16, "0")
    urn = F.concat(F.lit("<urn:uuid:00000000-0000-0000-"), F.substring(low, 1, 4), F.lit("-"), F.substring(low, 5, 12), F.lit(">"))
    return F.coalesce(urn, F.lit(_NO_ID))


def _continuation_urn(row: Column, chunk: Column) -> Column:
    h = F.md5(F.concat_ws(":", row, chunk).cast("binary"))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _header(name: str, value: Column) -> Column:
    """One header line, or nothing where the value is NULL."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))


def write_warc(
    pages: DataFrame, path: str, chunk_bytes: int = 32 << 10, min_revisit_bytes: int = 1000,
    id_column: str = "page_id", payload: str = "html", uri: str | None = "url", compression: str = "gzip",
) -> str:
    """Write a record (or its segments) for each row of ``pages`` to WARC files under ``path``.

    One pass finds repeated payloads by their digests. A second cuts payloads into chunk rows, joins those with them, and writes; where few
    payloads repeat, Catalyst broadcasts them and no chunk is shuffled, else adaptive execution splits the rows of a payload
    repeated very often. Of a revisit only the first row stays, without its bytes.
    """
    again = stored(repeated_payloads(pages, min_revisit_bytes, id_column, payload, chunk_bytes), "repeated-payloads")
    again_of = F.when(~F.col("response").eqNullSafe(F.col("id")), F.col("response"))
    joined = chunk_table(pages, chunk_bytes, id_column, payload, uri).join(again, ["sha1", "bytes"], "left").withColumn("refers_to", again_of)
    is_revisit = F.col("refers_to").isNotNull()
    chunks = joined.where(~is_revisit | (F.col("chunk") == 0)).withColumns(
        {"data": F.when(is_revisit, F.lit(b"")).otherwise(F.col("data")), "last": F.col("last") | is_revisit}
    )
    first, revisit, one = F.col("chunk") == 0, F.col("refers_to").isNotNull(), (F.col("chunk") == 0) & F.col("last")
    head = F.concat(
        F.lit(VERSION_LINE.decode()),
        _header("WARC-Type", F.when(~first, "continuation").when(revisit, "revisit").otherwise("response")),
        _header("WARC-Record-ID", F.when(first, _urn(F.col("id"))).otherwise(_continuation_urn(F.col("row"), F.col("chunk")))),
        _header("WARC-Date", F.lit(DATE)),
        _header("WARC-Target-URI", F.when(first, F.regexp_replace("uri", r"[\r\n]", ""))),
        _header("WARC-Payload-Digest", F.when(first, F.concat(F.lit("sha1:"), "sha1"))),
        _header("WARC-Payload-Length", F.when(first, F.col("bytes"))),
        _header("WARC-Profile", F.when(revisit, "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")),
        _header("WARC-Refers-To", F.when(revisit, _urn(F.col("refers_to")))),
        _header("WARC-Segment-Number", F.when(~one, F.col("chunk") + 1)),
        _header("WARC-Segment-Origin-ID", F.when(~first, _urn(F.col("id")))),
        _header("WARC-Segment-Total-Length", F.when(~one & F.col("last"), F.col("bytes"))),
        _header("X-Segmented-Row", F.when(~one, F.col("row"))),
        _header("Content-Length", F.octet_length("data")),
        F.lit("\r\n"),
    )
    chunks.select(F.concat(head.cast("binary"), "data").cast("string").alias("value")).write.option("lineSep", END).option(
        "compression", compression
    ).text(path)
    return path


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Chunk rows (``RECORDS``) of the WARC files under ``path``, one for each record.

    ``type`` is response or revisit on first chunks, continuation on others. Blocks are checked against their Content-Length.
    """
    lines = spark.read.option("lineSep", VERSION_LINE.decode()).text(path).select(F.col("value").cast("binary").alias("value"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        for part in parts:
            for value in part.column(0):
                record = value.as_py()
                if not record:
                    continue
                out.append(parse_record(record))
                held += len(record)
                if held > _batch_bytes:
                    yield _rows(out, RECORDS)
                    out, held = [], 0
        yield _rows(out, RECORDS)

    return lines.mapInArrow(run, RECORDS)


def _number(urn: str | None) -> int | None:
    """The record id in a urn written by ``write_warc``."""
    if urn is None:
        return None
    if urn == _NO_ID:
        return None
    value = int(urn.strip("<>").removeprefix("urn:uuid:").replace("-", "")[-16:], 16)
    return value - (1 << 64) if value >> 63 else value


def parse_record(record: bytes) -> tuple:
    """The fields of ``RECORDS`` from a record without its version line."""
    head, _, rest = record.partition(END.encode())
    fields = {}
    for line in head.split(b"\r\n"):
        name, _, value = line.partition(b": ")
        fields[name.decode()] = value.decode()
    length = int(fields["Content-Length"])
    if len(rest) < length or rest[length:].strip(b"\r\n"):
        raise ValueError(f"{fields.get('WARC-Record-ID')}: the block has {len(rest)} bytes, its Content-Length is {length}")
    segment = int(fields.get("WARC-Segment-Number", 1))
    total = fields.get("WARC-Payload-Length")
    return (
        _number(fields.get("WARC-Segment-Origin-ID") or fields["WARC-Record-ID"]), int(row) if (row := fields.get("X-Segmented-Row")) else None, segment - 1, fields["WARC-Type"], _number(fields.get("WARC-Refers-To")),
        fields.get("WARC-Payload-Digest", "").removeprefix("sha1:") or None, int(total) if total else None, fields.get("WARC-Target-URI"), rest[:length],
    )


def digest_records(records: DataFrame) -> DataFrame:
    """(id, payload_bytes, payload_digest, record_type, refers_to): one row a record, summed up over its chunks.

    A revisit has no block; its digest and length are those of its header. Others are digested again and checked against
    their header. Records of one chunk are digested where they are read. Chunks of segmented records meet in one
    task, in order, and go into a running digest one by one.
    """
    whole = records.where(F.col("row").isNull()).withColumn("found", F.sha1("data"))
    revisit = F.col("type") == "revisit"
    right = revisit | ((F.col("found") == F.col("digest")) & (F.octet_length("data") == F.col("total")))
    checked = F.when(right, F.col("digest")).otherwise(F.raise_error(F.concat(F.lit("wrong digest or length, record "), F.col("id").cast("string"))))
    schema = "id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    single = whole.select("id", F.col("total").alias("payload_bytes"), checked.alias("payload_digest"), F.col("type").alias("record_type"), "refers_to")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, length, chunks, out = None, hashlib.sha1(), 0, 0, []

        def closed() -> tuple:
            _, number, kind, refers, said, total = now
            if (digest.hexdigest(), length) != (said, total):
                raise ValueError(f"record {number}: digest or length differ from its header")
            return number, length, said, kind, refers

        for part in parts:
            names = ("row", "id", "chunk", "type", "refers_to", "digest", "total")
            for row, number, chunk, kind, refers, said, total, data in zip(
                *(part.column(part.schema.get_field_index(n)).to_pylist() for n in names), part.column(part.schema.get_field_index("data"))
            ):
                if chunk == 0:
                    if now is not None:
                        out.append(closed())
                    now, digest, length, chunks = (row, number, kind, refers, said, total), hashlib.sha1(), 0, 0
                if now is None or now[0] != row or chunk != chunks:
                    raise ValueError(f"record {number}: segment {chunk + 1} is out of place")
                piece = data.as_buffer()
                digest.update(piece)
                length += piece.size
                chunks += 1
            if len(out) > 10_000:
                yield _rows(out, schema)
                out = []
        if now is not None:
            out.append(closed())
        yield _rows(out, schema)

    segmented = records.where(F.col("row").isNotNull())
    return single.unionAll(segmented.repartition("row").sortWithinPartitions("row", "chunk").mapInArrow(run, schema))


def archive_pages(
    pages: DataFrame, chunk_bytes: int = 32 << 10, min_revisit_bytes: int = 1000, id_column: str = "page_id", payload: str = "html", uri: str | None = "url",
) -> DataFrame:
    """Write ``pages`` to a new WARC folder in the shared scratch folder, and what ``digest_records`` finds there."""
    path = write_warc(pages, scratch_path(pages.sparkSession, "warc"), chunk_bytes, min_revisit_bytes, id_column, payload, uri)
    return digest_records(read_warc(pages.sparkSession, path))
