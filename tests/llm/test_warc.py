import base64
import glob
import gzip
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from bulkapply.llm import queries, warc

HTML = ["<p>one</p>", None, "", "two\r\n\r\nthree", "<p>one</p>", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc", "é\r\n", "\r\n\r\n", "x" * 300_000, None]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"http://h.org/{i}\n\r", h, 1, "z") for i, h in enumerate(HTML)]
    rows += [(None, None, "<p>one</p>", 1, "z"), (None, None, "alone", 1, "z"), (4, "u", "<p>one</p>", 1, "z"), (4, "u", "<p>one</p>", 1, "z")]
    return spark.createDataFrame(rows, "page_id long, url string, html string, record int, first string")


def archived(spark, pages, folder):
    warc.write_monolithic(warc.records(pages), f"{folder}/whole")
    warc.normalise(spark, f"{folder}/whole", f"{folder}/warc")
    return warc.read(spark, f"{folder}/warc/kind=archive") if glob.glob(f"{folder}/warc/kind=archive") else None


def wanted(rows):
    """page_id, bytes, digest, type, refers_to by brute force."""
    out = []
    for page_id, html in rows:
        data = (html or "").encode()
        ids = [i for i, h in rows if (h or "") == (html or "") and i is not None]
        first = min(ids) if ids else None
        revisit = first is not None and first != page_id
        out.append((page_id, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def test_round_trip(spark, pages, folder):
    found = warc.payloads(archived(spark, pages, folder)).collect()
    assert sorted((tuple(r)[:5] for r in found), key=str) == wanted([(r.page_id, r.html) for r in pages.collect()])
    assert all(r.digest_holds is (True if r.record_type == "response" else None) for r in found)


def test_index_points_at_records_that_plain_gzip_reads(spark, pages, folder):
    archived(spark, pages.repartition(3), folder)
    n = 0
    for index in glob.glob(f"{folder}/warc/kind=index/part-*"):
        part = index.rsplit("/", 1)[1][:10]
        (archive,) = glob.glob(f"{folder}/warc/kind=archive/{part}*")
        data = open(archive, "rb").read()
        assert gzip.decompress(data).startswith(b"WARC/1.1\r\n")
        for line in gzip.decompress(open(index, "rb").read()).splitlines():
            entry = json.loads(line)
            record = gzip.decompress(data[entry["offset"] : entry["offset"] + entry["length"]])
            assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
            assert warc.header(record, b"warc-record-id") == entry["record"]
            assert warc.header(record, b"warc-target-uri") == entry["url"]
            n += 1
    assert n == pages.count()


def test_small_payloads_are_no_revisits(spark, pages, folder):
    warc.write_monolithic(warc.records(pages, least=1), f"{folder}/whole")
    warc.normalise(spark, f"{folder}/whole", f"{folder}/warc")
    found = warc.payloads(warc.read(spark, f"{folder}/warc/kind=archive"))
    assert found.where("payload_bytes = 0 and record_type = 'revisit'").isEmpty()


def test_base32(spark):
    row = spark.createDataFrame([("0123456789abcdef0123456789abcdefffffffff",)], "h string").select(warc.base32(F.col("h"))).first()
    assert row[0] == base64.b32encode(bytes.fromhex("0123456789abcdef0123456789abcdefffffffff")).decode()


def test_query_and_empty_table(spark, pages, folder):
    pages.drop("record", "first").write.parquet(f"{folder}/pages.parquet")
    assert queries.op3_warc(spark, folder).count() == pages.count()
    warc.write_monolithic(warc.records(pages.limit(0)), f"{folder}/none")
    warc.normalise(spark, f"{folder}/none", f"{folder}/nothing")
    assert glob.glob(f"{folder}/nothing/kind=archive/part-*") == []
