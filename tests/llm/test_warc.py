import gzip
import hashlib

import pytest

from cardlens.llm import warc
from cardlens.session import scratch_path

from .helpers import prose


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, payload string, digest string, salt int")


ROWS = ([(i, f"http://a.example/{i}", prose(i, 50 + 40 * i), "clash", None, None) for i in range(30)]
        + [(100 + i, f"http://b.example/{i}", prose(777, 400), None, None, None) for i in range(20)]      # copies
        + [(200 + i, "http://c.example/", "short", None, None, None) for i in range(3)]
        + [(300, None, None, None, None, None), (301, "", "", None, None, None), (302, "http://x/é \r\nWARC-Type: bad", prose(9, 300000), None, None, None),
           (303, "u", "été WARC/1.1\r\n\r\n" + prose(5, 300), None, None, None), (None, "u", prose(777, 400), None, None, None),
           (119, "again", prose(777, 400), None, None, None), (400, "u", prose(6, 400), None, None, None), (400, "u", prose(6, 400), None, None, None),
           (None, "u", prose(8, 400), None, None, None), (None, "v", prose(8, 400), None, None, None)])


@pytest.fixture(scope="module")
def archive(spark):
    path = scratch_path(spark, "warc")
    warc.write_warc(pages(spark, ROWS).repartition(3), path)
    return path


def expected():
    last = {}
    for i, _, h, *_ in ROWS:
        b = (h or "").encode()
        if len(b) >= 1000:
            last.setdefault(b, []).append(i)
    out = []
    for i, _, h, *_ in ROWS:
        b = (h or "").encode()
        ids = last.get(b, [])
        top = max((x for x in ids if x is not None), default=None)
        revisit = len(ids) > 1 and top is not None and i != top
        out.append((i or -1, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", top if revisit else -1))
    return sorted(out)


@pytest.mark.parametrize("split", [warc.SPLIT_BYTES, 1000, 333, 37])
def test_round_trip_from_any_byte_ranges(spark, archive, split):
    if split == 37:
        small = scratch_path(spark, "warc")
        warc.write_warc(pages(spark, [r for r in ROWS if len(r[2] or "") < 3000]), small)
        assert warc.read_warc(spark, small, split).count() == sum(len(r[2] or "") < 3000 for r in ROWS)
        return
    df = warc.read_warc(spark, archive, split)
    rows = df.select("*", warc.page_of("record_id").alias("page_id"), warc.page_of("refers_to").alias("to")).collect()
    assert sorted((r.page_id or -1, r.payload_bytes, r.payload_digest, r.record_type, r.to or -1) for r in rows) == expected()
    for r in rows:
        if r.record_type == "response":
            assert hashlib.sha1(r.payload).hexdigest() == r.payload_digest and len(r.payload) == r.payload_bytes
        else:
            assert r.payload is None


def test_files_are_plain_gzip_of_warc_records(spark, archive):
    files = [r.path for r in spark.read.format("binaryFile").load(archive).select("path").collect()]
    whole = b"".join(gzip.decompress(open(f.removeprefix("file:").replace("//", "/"), "rb").read()) for f in files)
    n = 0
    while whole:
        assert whole.startswith(b"WARC/1.1\r\n")
        head, _, rest = whole.partition(b"\r\n\r\n")
        length = int([x for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")][0].split(b":")[1])
        assert rest[length:length + 4] == b"\r\n\r\n"
        whole, n = rest[length + 4:], n + 1
    assert n == len(ROWS)


def test_damage_is_an_error(spark, tmp_path):
    good = warc._record(1, "u", prose(1, 5000).encode(), "0" * 40, None)
    for data in (good + good[:len(good) // 2], good + good[:3000] + b"\0" * 50 + good[3050:]):
        f = tmp_path / "x.warc.gz"
        f.write_bytes(data)
        with pytest.raises((OSError, EOFError)):
            list(warc._Range(f"file://{f}", 0, len(data)).records())
    noise = tmp_path / "noise"
    noise.write_bytes(b"abc" + warc.MAGIC + b"zzz" + warc.MAGIC * 3 + warc.EMPTY_MEMBER + good + b"tail")
    assert [len(warc.parse(c)[1]) > 0 for _, c in warc._Range(f"file://{noise}", 0, noise.stat().st_size).records()] == [True]


def test_empty_table(spark):
    path = scratch_path(spark, "warc")
    warc.write_warc(pages(spark, []), path)
    assert warc.read_warc(spark, path).collect() == []
