import hashlib
import uuid

import pytest
from corpus_helpers import sentence

from tidewater.llm import warc as W
from tidewater.session import shared_dir


@pytest.fixture
def folder(spark):
    return shared_dir(spark, f"warc-test-{uuid.uuid4().hex}")


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1) for i, u, h in rows],
                                 "page_id long, url string, html string, digest string, first int")


LONG = "\n".join(sentence(k, 50) + " é漢😀" for k in range(400))
ROWS = [(1, "http://a/x y", "short"), (2, None, None), (3, "http://b", ""), (4, "http://c\r\nX: 1", LONG),
        (5, "http://d", LONG), (6, "http://e", sentence(1, 40)), (7, "http://e", sentence(1, 40)),
        (8, "http://f", "short"), (9, "http://g", "a WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 30),
        (10, "http://h", "\r\n0\r\n\r\n" * 40), (None, "http://i", sentence(1, 40)),
        (None, "http://j", sentence(9, 40)), (11, "http://k", LONG + "!"), (11, "http://k", LONG + "!"),
        (12, "http://l", "x" * 99), (13, "http://m", "x" * 99), (14, "http://n", "WARC/1.1\r\n" * 9000)]


@pytest.mark.parametrize("segment, chunk", [(W.SEGMENT_BYTES, W.CHUNK_BYTES), (300, 7), (64, 1000)])
def test_round_trip(spark, folder, segment, chunk):
    W.write_archives(pages(spark, ROWS), folder, segment_bytes=segment, chunk_bytes=chunk)
    first = {}
    for i, _, h in ROWS:
        d = hashlib.sha256((h or "").encode()).hexdigest()
        if i is not None and len((h or "").encode()) >= W.REVISIT_BYTES:
            first[d] = min(first.get(d, i), i)
    want = []
    for i, u, h in ROWS:
        p = (h or "").encode()
        d = hashlib.sha256(p).hexdigest()
        ref = first.get(d) if first.get(d) != i else None
        want.append((None if i is None else str(i), W.clean_uri(u), len(p), d,
                     "response" if ref is None else "revisit", None if ref is None else str(ref),
                     True, p if ref is None else None))
    got = [tuple(bytes(x) if isinstance(x, bytearray) else x for x in r)
           for r in W.read_pages(spark, folder).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_archives_are_plain_records(spark, folder):
    W.write_archives(pages(spark, ROWS[3:4]).coalesce(1), folder, segment_bytes=5000)
    text = b"".join(bytes(r.content) for r in
                    spark.read.format("binaryFile").load(folder + "/part-*").collect())
    at, kinds, total = 0, [], 0
    while at < len(text):  # a sequential reader gets along with the lengths alone
        head, _, _ = text[at:].partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        n = int(fields["Content-Length"])
        kinds.append((fields["WARC-Type"], int(fields["WARC-Segment-Number"])))
        total += n
        at += len(head) + 4 + n
        assert text[at:at + 4] == b"\r\n\r\n"
        at += 4
    assert kinds[0] == ("response", 1) and len(kinds) > 3
    assert kinds[1:] == [("continuation", k) for k in range(2, len(kinds) + 1)]
    assert int(fields["WARC-Segment-Total-Length"]) == total


def test_lost_and_foreign_segments_are_told(spark, folder):
    rows = [r for k, p in enumerate([LONG, LONG[:9000]]) for r in W.page_records(
        k, "u", p.encode(), hashlib.sha256(p.encode()).hexdigest(), None, False, 2000, 500)]
    rows = [r for r in rows if "<urn:page:0" not in r or "Segment-Number: 3\r\n" not in r]
    rows = list(reversed(rows)) + ["WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 99\r\n\r\nx\r\n\r"]
    spark.createDataFrame([(r,) for r in rows], "value string").write.option(
        "lineSep", "\n").text(folder)
    got = {r.page_id: r for r in W.read_pages(spark, folder).collect()}
    assert set(got) == {"0", "1"}  # the record that is cut short is no page
    assert not got["0"].complete and got["0"].payload is None
    assert got["1"].complete and bytes(got["1"].payload).decode() == LONG[:9000]


@pytest.mark.parametrize("body, payload", [
    (b"5\r\nhello\r\n0\r\n\r\n", b"hello"), (b"0\r\n\r\n", b""),
    (b"3;x=1\r\nabc\r\nA\r\n0123456789\r\n0\r\nTrailer: x\r\n\r\n", b"abc0123456789"),
    (b"5\r\nhell", None), (b"", None), (b"zz\r\n", None), (b"5\r\nhelloXX0\r\n\r\n", None),
    (b"5\r\nhello\r\n", None)])
def test_unchunk(body, payload):
    assert W.unchunk(body) == payload


def test_empty_table(spark, folder):
    W.write_archives(pages(spark, ROWS).limit(0), folder)
    assert W.read_pages(spark, folder).count() == 0


@pytest.mark.parametrize("segment, chunk", [(W.SEGMENT_BYTES, W.CHUNK_BYTES), (300, 7), (64, 1000)])
def test_version_completed_by_a_line_end(spark, folder, segment, chunk):
    rows = [(1, "http://a", "WARC/1.1"), (2, "http://a", sentence(5, 200) + " WARC/1.1"),
            (3, "http://a/WARC/1.1", "short"), (4, "WARC/1.1", LONG), (5, "http://b/WARC/1.1", LONG)]
    W.write_archives(pages(spark, rows), folder, segment_bytes=segment, chunk_bytes=chunk)
    got = {r.page_id: r for r in W.read_pages(spark, folder).collect()}
    assert set(got) == {str(i) for i, _, _ in rows}
    for i, u, h in rows:
        r = got[str(i)]
        assert r.complete and r.url.replace("%31", "1") == u
        assert r.record_type == "revisit" if i == 5 else bytes(r.payload) == h.encode()
