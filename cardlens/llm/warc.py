"""WARC archives: one gzip member per record, written and read by Spark tasks.

Writing goes through Spark's text writer, whose commit protocol keeps the files whole
when executors are lost.  Its line separator is set to an empty gzip member, so each
file is a plain sequence of gzip members.

Reading is splittable without an index: a task gets a byte range, scans it for the gzip
magic, decodes each candidate's first bytes, and takes the candidate for a record if they
are a WARC header.  It owns the records that start inside its range and reads the last
one to its end, wherever that is.  (A payload cannot hold the magic in the clear when it is
UTF-8 text: 0x8B never follows 0x1F there.)
"""

from __future__ import annotations

import gzip
import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_tasks

MAGIC = b"\x1f\x8b\x08"
EMPTY_MEMBER = gzip.compress(b"", mtime=0)
DATE = "2000-01-01T00:00:00Z"      # of all records, so that a task that runs again writes the same bytes
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REVISIT_BYTES = 1000               # shorter payloads are always stored
SPLIT_BYTES = 8 << 20
SALTS = 256


def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", text_col: str = "html") -> DataFrame:
    """page_id, url, payload (binary), digest (hex SHA-1), size, response_id: of the rows with
    equal payloads of at least ``REVISIT_BYTES``, the largest page_id (null for payloads that
    no other row has, and for shorter ones).

    Groups are counted per (digest, salt of the id) first, and the rows meet their
    group's answer on that pair, so a group of any size is spread over ``SALTS`` keys.
    """
    payload = F.encode(F.coalesce(pages[text_col].cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"), payload.alias("payload"))
    rows = rows.select("*", F.sha1("payload").alias("digest"), F.octet_length("payload").cast("long").alias("size"),
                       F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int").alias("salt"))
    parts = (rows.where(F.col("size") >= REVISIT_BYTES).groupBy("digest", "salt")
             .agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")))
    groups = parts.groupBy("digest").agg(F.max("last").alias("response_id"), F.sum("n").alias("n")).where("n > 1")
    answers = parts.select("digest", "salt").join(groups.select("digest", "response_id"), "digest")
    return rows.join(answers, ["digest", "salt"], "left").drop("salt")


def _record(page_id, url, payload: bytes, digest: str, response_id) -> bytes:
    name = lambda i: f"<urn:page:{'null' if i is None else i}>"
    revisit = response_id is not None and page_id != response_id
    # no line break or other control character may reach a header
    uri = "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "")
    block = HTTP if revisit else HTTP + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", name(page_id)), ("WARC-Date", DATE),
              ("WARC-Target-URI", uri), ("Content-Type", "application/http; msgtype=response"),
              ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Length", str(len(block)))]
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", name(response_id)), ("WARC-Payload-Length", str(len(payload)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v) + "\r\n"
    return gzip.compress(head.encode() + block + b"\r\n\r\n", 6, mtime=0)


def _members(batches):
    for batch in batches:
        out, size = [], 0
        for row in zip(*(batch.column(i) for i in range(5))):
            m = _record(*(x.as_py() for x in row))
            out.append(m)
            size += len(m)
            if size > 4 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["member"])
                out, size = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["member"])


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", text_col: str = "html") -> None:
    """One record per row into ``path``: a response with the payload, or a revisit that refers
    to the response with the same payload and the largest id.

    Null and empty payloads are responses without a body; a null url has no target URI; a
    null id is written as ``null`` and never chosen while the group has another id (a group of
    null ids only is all responses); rows that repeat the chosen id are responses too; an empty
    table makes files without records; other columns are not read.
    """
    rows = with_revisits(pages, id_col, url_col, text_col)
    members = in_tasks(rows.select("page_id", "url", "payload", "digest", "response_id"), _members, "member binary")
    (members.select(F.col("member").cast("string")).write.option("encoding", "ISO-8859-1")
     .option("lineSep", EMPTY_MEMBER.decode("latin-1")).text(path))


class _Range:
    """Bytes of a file from ``start``; read on when a record goes past the range."""

    def __init__(self, path: str, start: int, end: int):
        from pyarrow import fs
        if path.startswith("file:/") and not path.startswith("file://"):
            path = "file://" + path[5:]
        system, name = fs.FileSystem.from_uri(path)
        self.file = system.open_input_file(name)
        self.start, self.end, self.size = start, end, self.file.size()
        self.data = bytearray(self.file.read_at(min(end + len(MAGIC) - 1, self.size) - start, start))

    def more(self) -> bool:
        at = self.start + len(self.data)
        if at >= self.size:
            return False
        self.data += self.file.read_at(min(1 << 18, self.size - at), at)
        return True

    def member(self, at: int) -> tuple[bytes, int] | None:
        """(content, place after it) of the gzip member at ``at``, or None when there is no
        member that starts with a WARC header.  A record that breaks off raises."""
        while len(self.data) - at < 256 and self.more():
            pass
        try:    # the first bytes alone, so that damage further on cannot hide a record
            if zlib.decompressobj(31).decompress(bytes(self.data[at:at + 4096]), 5) != b"WARC/":
                return None
        except zlib.error:
            return None
        d, out, place = zlib.decompressobj(31), bytearray(), at
        try:
            while not d.eof:
                if place >= len(self.data) and not self.more():
                    raise EOFError(f"record at {self.start + at} is cut off")
                piece = bytes(self.data[place:place + 65536])
                out += d.decompress(piece)
                place += len(piece)
        except zlib.error as e:
            raise OSError(f"record at {self.start + at} is damaged: {e}") from e
        return bytes(out), place - len(d.unused_data)

    def records(self):
        at = 0
        while True:
            at = self.data.find(MAGIC, at)
            if at < 0 or self.start + at >= self.end:
                return
            got = self.member(at)
            if got:
                yield self.start + at, got[0]
                at = got[1]
            else:
                at += 1


def parse(content: bytes) -> tuple[dict[str, str], bytes]:
    """(header fields by lower-case name, block) of a record."""
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        k, _, v = line.partition(b":")
        fields[k.decode("utf-8", "replace").strip().lower()] = v.decode("utf-8", "replace").strip()
    return fields, rest[:int(fields.get("content-length", 0))]


def _read(with_payload: bool):
    types = [("path", pa.string()), ("offset", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()),
             ("refers_to", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())]

    def run(batches):
        for batch in batches:
            for path, start, end in zip(*(c.to_pylist() for c in batch.columns)):
                rows, size = [], 0
                for at, content in _Range(path, start, end).records():
                    f, block = parse(content)
                    kind = f.get("warc-type")
                    body = block
                    if f.get("content-type", "").startswith("application/http"):
                        body = block.partition(b"\r\n\r\n")[2]
                    if kind == "revisit":
                        digest, n = f.get("warc-payload-digest", "").removeprefix("sha1:"), int(f.get("warc-payload-length", 0))
                    else:
                        digest, n = hashlib.sha1(body).hexdigest(), len(body)
                    rows.append((path, at, kind, f.get("warc-record-id"), f.get("warc-target-uri"), f.get("warc-refers-to"), digest, n,
                                 body if with_payload and kind != "revisit" else None))
                    size += len(body)
                    if size > 4 << 20 or len(rows) >= 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), types)], [n for n, _ in types])
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), types)], [n for n, _ in types])
    return run


def read_warc(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives under ``path``: path, offset, record_type, record_id,
    target_uri, refers_to, payload_digest, payload_bytes, payload (null for revisits)."""
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    ranges = files.select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split_bytes).cast("long"))).alias("start"),
                          "length")
    ranges = ranges.select("path", "start", F.least(F.col("start") + split_bytes, "length").alias("end"))
    n = max(1, ranges.count())
    return in_tasks(ranges.repartition(n, "path", "start"), _read(with_payload),
                    "path string, offset long, record_type string, record_id string, target_uri string, refers_to string, "
                    "payload_digest string, payload_bytes long, payload binary")


def page_of(record_id: str) -> F.Column:
    """The page id in a record id (null for ``null``)."""
    return F.regexp_extract(record_id, "urn:page:(-?[0-9]+|null)", 1).try_cast("long")
