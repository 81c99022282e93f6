import gzip
import hashlib
import os
import random

from llm_texts import _package_on_workers  # noqa: F401
import pytest
from pyspark.sql import functions as F

from wattloom.llm import warc
from wattloom.shared import scratch_path

SCHEMA = "page_id bigint, url string, html string"


def expected(rows, least):
    largest = {}
    for i, _, html in rows:
        data = (html or "").encode()
        if len(data) >= least and i is not None:
            largest[data] = max(i, largest.get(data, i))
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        refers = largest.get(data)
        refers = None if refers == i else refers
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if refers is not None else "response", refers))
    return sorted(out, key=str)


def pages(seed=1):
    rng = random.Random(seed)
    bodies = ["", "é" * 10, "x" * 999, "x" * 1000, "a\r\n\r\nb" * 300, "WARC/1.0\r\n" * 300, "WARC/1.0\r\nWARC-Type: response\r\n\r\n", "日本" * 4000, "WARC/1.", "end WARC/1.0\r\n"]
    rows = [(i, f"http://h{i}.example/", rng.choice(bodies)) for i in range(60)]
    return [*rows, (100, None, None), (101, "http://a\r\nb", "q" * 5000), (-5, "u", "q" * 5000), (None, None, "q" * 5000), (None, "u", "z" * 3000), (1 << 62, "u", "y" * 70_000)]


@pytest.mark.parametrize("chunk", [7, 1000, 1 << 20])
def test_round_trip(spark, chunk):
    rows = pages()
    got = warc.archive_pages(spark.createDataFrame(rows, SCHEMA).repartition(5), chunk_bytes=chunk).collect()
    assert sorted(map(tuple, got), key=str) == expected(rows, 1000)


def test_archives_are_plain_warc(spark):
    rows = pages(2)
    path = warc.write_warc(spark.createDataFrame(rows, SCHEMA), scratch_path(spark, "warc"), chunk_bytes=2000)
    payloads, ids = {}, set()
    for name in sorted(f for f in os.listdir(path.removeprefix("file:")) if f.endswith(".gz")):
        data = gzip.open(os.path.join(path.removeprefix("file:"), name)).read()
        while data:
            head, _, data = data.partition(b"\r\n\r\n")
            version, *lines = head.decode().split("\r\n")
            fields = dict(x.split(": ", 1) for x in lines)
            length = int(fields["Content-Length"])
            assert version == "WARC/1.0" and length <= 2000 and data[length : length + 4] == b"\r\n\r\n"
            block, data = data[:length], data[length + 4 :]
            origin = fields.get("WARC-Segment-Origin-ID", fields["WARC-Record-ID"])
            segment = int(fields.get("WARC-Segment-Number", 1))
            assert (fields["WARC-Type"] == "continuation") == (segment > 1)
            ids.add((fields["WARC-Record-ID"], fields.get("X-Segmented-Row")))
            if fields["WARC-Type"] != "revisit":
                payloads.setdefault((origin, fields.get("X-Segmented-Row")), {})[segment] = block
    whole = {b"".join(parts[k] for k in sorted(parts)) for parts in payloads.values()}
    assert whole == {(h or "").encode() for _, _, h in rows}


def test_chunks_carry_running_digests(spark):
    rows = [(1, "u", "abc" * 1000), (2, "u", None), (3, "u", "xWARC/1.0\r\ny")]
    chunks = warc.chunk_table(spark.createDataFrame(rows, SCHEMA), 1024).orderBy("id", "chunk").collect()
    for i, _, html in rows:
        data, own = (html or "").encode(), [c for c in chunks if c.id == i]
        assert b"".join(c.data for c in own) == data and [c.chunk for c in own] == list(range(len(own)))
        assert [c.last for c in own] == [False] * (len(own) - 1) + [True]
        for c in own:
            assert c.sha1_so_far == hashlib.sha1(data[: c.bytes_so_far]).hexdigest() and warc.VERSION_LINE not in bytes(c.data)


def test_damaged_records_raise():
    good = b"WARC-Type: response\r\nWARC-Record-ID: <urn:uuid:00000000-0000-0000-0000-000000000001>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert warc.parse_record(good)[-1] == b"abc"
    with pytest.raises(ValueError):
        warc.parse_record(good.replace(b": 3", b": 300"))


def test_empty_and_clashing_columns(spark):
    table = spark.createDataFrame(pages(3)[:5], SCHEMA).withColumn("id", F.lit(1)).withColumn("data", F.lit("x")).withColumn("sha1", F.lit("y")).withColumn("bytes", F.lit(0))
    assert warc.archive_pages(table).count() == 5
    assert warc.archive_pages(table.limit(0)).count() == 0
