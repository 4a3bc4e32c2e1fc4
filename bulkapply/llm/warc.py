"""WARC archives: monolithic gzip files rewritten record by record, with a sidecar index of offsets.

``write_monolithic`` has Spark's text writer gzip whole files of records. ``normalise`` inflates each such file once, as a stream, cuts it
into records by their Content-Length, and writes every record as a gzip member of its own; beside each archive stands an
index with the offset, length, id and target of its records. ``read`` streams archives back, record by record. Files are
read and written by Spark alone, so they may be in any store Spark reaches, and a task never holds more than a record.

A normalised archive is ``kind=archive/part-N...``, its index ``kind=index/part-N...``, a gzip file of JSON lines. Spark's
writer puts a separator behind every row; here that is an empty gzip member, which inflates to nothing, so both files are
valid gzip whatever reads them. (Spark names them .txt; the content is what counts.)

Equal payloads are found by their SHA-256. Payloads with more than a thousandth of all pages join by broadcast, so no
task gathers a hot payload.

Defined cases: a null html is an empty payload. A null url writes no target. Line breaks in a url are percent-encoded. A page without
an id never stands for others; alone with its payload it is a response. Rows that repeat an id and payload are alike:
all are the response, or all revisit. Only page_id, url and html are read. Empty tables give empty archives.
"""

from __future__ import annotations

import json
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bulkapply.llm.common import in_arrow, join_counted
from bulkapply.storage import materialize

# An empty gzip member, as text of one character per byte.
EMPTY_MEMBER = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x02\xff\x03\x00" + bytes(8)
RECORD_END = b"\r\n\r\n"
LEVEL = 6
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32(hex_digits):
    """A column of 40 hexadecimal digits in base 32: 32 characters of five bits each."""
    characters = []
    for i in range(0, 40, 5):
        twenty = F.conv(F.substring(hex_digits, i + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            characters.append(F.substring(F.lit(_BASE32), F.shiftright(twenty, shift).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*characters)


def records(pages: DataFrame, least: int = 0) -> DataFrame:
    """``record``: the text of each page's WARC record, without the line breaks that end it.

    Of records with equal payloads of at least ``least`` bytes that of the smallest page_id is a response and the others revisit
    it; records of smaller payloads are responses.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.withColumns({"bytes": F.octet_length("payload").cast("long"), "same": F.sha2(F.col("payload").cast("binary"), 256)})
    groups = rows.where(F.col("bytes") >= least).groupBy("same").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    groups = materialize(groups.where("copies > 1"), "payloads")
    rows = join_counted(rows, groups, "same", "copies")
    revisits = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))

    def line(name: str, value) -> object:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    def record_id(number):
        return F.concat(F.lit("<urn:page:"), number.cast("string"), F.lit(">"))

    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    digest = F.concat(F.lit("sha1:"), base32(F.sha1(F.col("payload").cast("binary"))))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("bytes").cast("string"), F.lit("\r\n\r\n"))
    rows = rows.withColumn("block", F.concat(http, F.when(revisits, F.lit("")).otherwise(F.col("payload"))))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisits, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", F.coalesce(record_id(F.col("page_id")), F.lit("<urn:page:>"))),
        line("WARC-Date", F.lit(_DATE)),
        line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", digest),
        line("WARC-Refers-To", F.when(revisits, record_id(F.col("first")))),
        line("WARC-Profile", F.when(revisits, F.lit(_PROFILE))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length("block").cast("string")),
        F.lit("\r\n"),
    )
    return rows.select(F.concat(head, "block").alias("record"))


def write_monolithic(record_rows: DataFrame, path: str) -> None:
    """Files of records, each gzipped as a whole."""
    record_rows.write.option("lineSep", RECORD_END.decode()).option("compression", "gzip").text(path)


def _pieces(spark: SparkSession, path: str, end: bytes) -> DataFrame:
    """The files under ``path`` in pieces between ``end``, with their names, in order within a task.

    A gzip file is one task's; an archive of members may be split, and then every split begins with a member.
    """
    lines = spark.read.option("lineSep", end.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)
    return lines.select(F.input_file_name().alias("file"), F.col("value").cast("binary").alias("piece"))


class _Records:
    """Cuts a stream of bytes into WARC records by their Content-Length."""

    def __init__(self):
        self.held, self.wanted = bytearray(), 0

    def add(self, piece: bytes) -> list[bytes]:
        self.held += piece
        out = []
        while len(self.held) >= self.wanted:
            if not self.wanted:
                begin = 0
                while self.held[begin : begin + 2] == b"\r\n":
                    begin += 2
                del self.held[:begin]
                head = self.held.find(RECORD_END)
                if head < 0:
                    break
                self.wanted = head + 4 + int(header(self.held[:head], b"content-length") or 0)
            else:
                out.append(bytes(self.held[: self.wanted]))
                del self.held[: self.wanted]
                self.wanted = 0
        return out


def header(head: bytes, name: bytes) -> str | None:
    """The value of a header line of a record."""
    for line in bytes(head).split(b"\r\n"):
        key, _, value = line.partition(b":")
        if key.strip().lower() == name:
            return value.strip().decode("utf-8", "replace")
    return None


def normalise(spark: SparkSession, source: str, target: str) -> None:
    """Rewrite the monolithic archives under ``source`` with a gzip member per record, and indexes beside them."""

    def members(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        file, cutter, offset, index, number = None, None, 0, [], 0
        for batch in batches:
            out, order = [], []
            for name, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if name != file:
                    file, cutter = name, _Records()
                for record in cutter.add(piece + RECORD_END):
                    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                    member = packer.compress(record + RECORD_END) + packer.flush()
                    head = record[: record.find(RECORD_END)]
                    entry = {"part": part, "offset": offset, "length": len(member), "record": header(head, b"warc-record-id"),
                             "type": header(head, b"warc-type"), "url": header(head, b"warc-target-uri")}
                    index.append(json.dumps(entry, ensure_ascii=False) + "\n")
                    offset += len(member) + len(EMPTY_MEMBER)
                    out.append(member)
                    order.append(number)
                    number += 1
            lines = []
            if len(index) >= 1000:
                lines, index = [_packed(index)], []
            yield [out + lines, ["archive"] * len(out) + ["index"] * len(lines), order + [number] * len(lines)]
        if index:
            yield [[_packed(index)], ["index"], [number]]

    rows = in_arrow(_pieces(spark, source, RECORD_END), members, "member binary, kind string, number long")
    rows = rows.sortWithinPartitions("kind", "number").select(F.col("member").cast("string").alias("value"), "kind")
    rows.write.option("lineSep", EMPTY_MEMBER.decode("latin-1")).option("encoding", "ISO-8859-1").partitionBy("kind").text(target)


def _packed(lines: list[str]) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress("".join(lines).encode()) + packer.flush()


def read(spark: SparkSession, path: str) -> DataFrame:
    """``file, head, block`` of every record of normalised archives."""

    def inflate(batches):
        file, inflater, cutter = None, None, None
        for batch in batches:
            files, heads, blocks = [], [], []
            for name, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if name != file:
                    file, inflater, cutter = name, zlib.decompressobj(31), _Records()
                rest = piece + EMPTY_MEMBER
                while rest:
                    for record in cutter.add(inflater.decompress(rest)):
                        cut = record.find(RECORD_END)
                        files.append(name)
                        heads.append(record[:cut])
                        blocks.append(record[cut + 4 :])
                    rest = inflater.unused_data
                    if inflater.eof:
                        inflater = zlib.decompressobj(31)
            yield [files, heads, blocks]

    return in_arrow(_pieces(spark, path, EMPTY_MEMBER), inflate, "file string, head binary, block binary")


def payloads(archived: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to, digest_holds`` from the records read back.

    ``digest_holds`` is whether a response's payload has the digest that its record names; null for revisits.
    """

    def parse(batches):
        import base64
        import hashlib

        def number(value):
            digits = (value or "").removeprefix("<urn:page:").removesuffix(">")
            return int(digits) if digits else None

        for batch in batches:
            rows = []
            for head, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                http, _, payload = block.partition(RECORD_END)
                kind = header(head, b"warc-type")
                digest = (header(head, b"warc-payload-digest") or "").removeprefix("sha1:")
                holds = base64.b32encode(hashlib.sha1(payload).digest()).decode() == digest if kind == "response" else None
                rows.append((number(header(head, b"warc-record-id")), int(header(http, b"content-length") or 0), digest, kind,
                             number(header(head, b"warc-refers-to")), holds))
            yield [list(c) for c in zip(*rows)] if rows else [[]] * 6

    return in_arrow(archived.select("head", "block"), parse,
                    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, digest_holds boolean")
