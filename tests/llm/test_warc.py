import hashlib
import io
import zlib

import pytest

from shelfspark.llm import warc

BIG = "<p>" + "é text " * 300 + "</p>"
PAGES = [(1, "http://a.example/x y?q=%20ü", BIG), (2, None, BIG), (3, "u3", None), (4, "u4", ""), (5, "u5", "small"),
         (6, "u6", "small"), (7, "u7", "x" * 999), (8, "u8", "x" * 999), (9, "u9", "z" * 1000), (10, "u10", "z" * 1000),
         (10, "again", "z" * 1000), (None, "none", "z" * 1000), (11, "crlf", "a\r\n\r\nb" * 400),
         (12, "long", "".join(chr(33 + (i * i) % 90) for i in range(700_000)))]


@pytest.fixture(scope="module")
def back(spark):
    pages = spark.createDataFrame([(i, u, h, "z", 1) for i, u, h in PAGES],
                                  "page_id long, url string, html string, payload string, chosen int")
    manifest = warc.write_archives(pages, archive_bytes=4000)
    return manifest, warc.read_archives(manifest).collect()


def test_round_trip(back):
    manifest, rows = back
    assert len(rows) == len(PAGES) == sum(r.records for r in manifest.collect())
    got = {(r.page_id, r.url): r for r in rows}
    for i, u, h in PAGES:
        r, data = got[i, u], (h or "").encode()
        assert r.payload_bytes == len(data) and r.payload_digest == hashlib.sha1(data).hexdigest()
        if r.record_type == "response":
            assert r.payload == data and r.refers_to is None
    assert {(r.page_id, r.refers_to) for r in rows if r.record_type == "revisit"} == {(1, 2), (9, 10), (None, 10)}


def test_archives_are_gzip_members_and_bounded(back):
    for r in back[0].collect():
        fs, path = warc.filesystem(r.path)
        data = fs.open_input_stream(path, compression=None).read()
        members = 0
        while data:
            z = zlib.decompressobj(31)
            assert z.decompress(data).startswith(b"WARC/1.1\r\n")
            data, members = z.unused_data, members + 1
        assert members == r.records + 1  # warcinfo first


def test_damage_is_found():
    good = warc.page_member(1, "u", b"abc" * 500, hashlib.sha1(b"abc" * 500).hexdigest(), None, False)
    assert [r["payload_bytes"] for r in warc.read_records(io.BytesIO(good + good))] == [1500, 1500]
    bad = warc.page_member(1, "u", b"abc" * 500, "0" * 40, None, False)
    with pytest.raises(warc.WarcError, match="payload digest"):
        list(warc.read_records(io.BytesIO(bad)))
    with pytest.raises(warc.WarcError):
        list(warc.read_records(io.BytesIO(good[:-30])))
    text = zlib.decompress(good, 31)
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    with pytest.raises(warc.WarcError):
        list(warc.read_records(io.BytesIO(z.compress(text.replace(b"abc", b"abd", 1)) + z.flush())))


def test_empty_table(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(warc.write_archives(none)).collect() == []
