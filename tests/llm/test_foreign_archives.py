"""Archives that others wrote: other digests, missing lengths, damaged members, leftover lines."""

import gzip
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from portolan.llm import warc
from portolan.session import scratch_path


def _record(i, payload, *headers, http=True):
    block = (b"HTTP/1.1 200 OK\r\n\r\n" if http else b"") + payload
    head = ["WARC/1.0", "WARC-Type: response", f"WARC-Record-ID: <urn:{i}>", *headers, f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _archive(spark, *members, name="a.warc.gz"):
    path = scratch_path(spark, "foreign")
    os.makedirs(path)
    with open(f"{path}/{name}", "wb") as f:
        for m in members:
            f.write(m)
    return path


def _rows(spark, path, **kwargs):
    return {r.record_id: r for r in warc.read_warc(spark, path, **kwargs).collect()}


def test_digests_are_checked_by_the_algorithm_they_name(spark):
    body = b"some payload"
    sha256, sha1 = hashlib.sha256(body), hashlib.sha1(body)
    labels = [f"sha256:{sha256.hexdigest()}", f"sha-256:{sha256.hexdigest().upper()}", f"md5:{hashlib.md5(body).hexdigest()}",
              f"sha1:{warc.sha1_base32(body)}", f"sha1:{sha1.hexdigest()}", "crc9:whatever", ""]
    path = _archive(spark, *[gzip.compress(_record(i, body, f"WARC-Payload-Digest: {x}")) for i, x in enumerate(labels)])
    assert {bytes(r.payload) for r in _rows(spark, path).values()} == {body} and len(_rows(spark, path)) == len(labels)
    bad = _archive(spark, gzip.compress(_record(0, body, f"WARC-Payload-Digest: sha256:{hashlib.sha256(b'x').hexdigest()}")))
    with pytest.raises(Exception, match="digest"):
        _rows(spark, bad)


@pytest.mark.parametrize("name", ["a.warc.gz", "a.warc"])
def test_a_record_without_headers_is_no_silent_end(spark, name):
    pack = gzip.compress if name.endswith(".gz") else bytes
    good = [_record(i, b"p%d" % i) for i in range(3)]
    path = _archive(spark, pack(good[0]), pack(b"not a record\r\n\r\nat all"), pack(good[1]), pack(good[2]), name=name)
    with pytest.raises(Exception, match="no WARC headers"):
        _rows(spark, path)
    # Blank lines between records and empty members are none.
    path = _archive(spark, pack(good[0]), pack(b"\r\n\r\n"), pack(good[1] + b"\r\n"), pack(good[2]), pack(b""), name=name)
    assert sorted(_rows(spark, path)) == ["<urn:0>", "<urn:1>", "<urn:2>"]


def test_lengths_that_an_archive_lacks_are_taken_from_the_payload(spark):
    path = _archive(spark, *[gzip.compress(_record(i, b"x" * (100 + i), http=i % 2 == 0)) for i in range(4)])
    assert {k: r.payload_bytes for k, r in _rows(spark, path).items()} == {f"<urn:{i}>": 100 + i for i in range(4)}
    rows = warc.read_warc(spark, path).where(F.col("payload_bytes") == 102)
    assert [r.record_id for r in rows.collect()] == ["<urn:2>"]
    assert {r.payload_bytes for r in _rows(spark, path, payload=False).values()} == {None}


def test_very_long_payloads_pass(spark):
    pages = spark.createDataFrame([(1, "u", "long é " * 3_000_000), (2, "u" * 100_000, ""), (3, None, None)], "page_id long, url string, html string")
    path = scratch_path(spark, "long-warc")
    warc.write_warc(warc.records(pages, least_bytes=1), path)
    got = {r.page_id: (r.payload_bytes, r.record_type) for r in warc.read_warc(spark, path).collect()}
    assert got == {1: (24_000_000, "response"), 2: (0, "response"), 3: (0, "response")}
