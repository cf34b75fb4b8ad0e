"""Web archives: writing pages as segmented WARC records and reading them back.

Pages become response records (HTTP header and chunked body) or, where an
earlier page has the same payload, revisit records. Blocks longer than a
segment are spread over a first record and continuation records. Records
are written and read by Spark's text source, whose line separator is the
record's version line, so archives are split between tasks, reach any store
that Spark reaches, and a lost task is simply run again.

Reading groups segments by the id of their origin, orders them by number,
checks that none is missing and that the lengths add up to the total, takes
the HTTP header off and decodes the chunked body.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, written

# fixed values of the formats
VERSION = "WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
#: Largest block of a record and largest chunk of a body, in bytes.
SEGMENT_BYTES, CHUNK_BYTES = 16_384, 4_096
#: Smaller payloads are never revisits.
REVISIT_BYTES = 100
#: The date in all records: that of the crawl is not in the table.
DATE = "1970-01-01T00:00:00Z"
BROADCAST_IDS = 1_000_000


def cuts(data: bytes, size: int, apart: bytes | None = None) -> list[bytes]:
    """Pieces of at most ``size`` bytes that end between UTF-8 characters.

    With ``apart`` pieces also end inside every occurrence of it, so that it
    is in no piece. No piece but the last ends like a version line without
    its line end, which the end of a record would complete.
    """
    name = VERSION.rstrip().encode()
    stops = [m.start() + len(apart) - 1 for m in re.finditer(re.escape(apart), data)] \
        if apart else []
    pieces, at = [], 0
    stops = iter([*stops, len(data)])
    stop = next(stops)
    while at < len(data):
        end = min(at + size, stop)
        while end < len(data) and end > at + 1 and data[end] & 0xC0 == 0x80:
            end -= 1
        if end < len(data) and end - at > 1 and data.endswith(name, 0, end):
            end -= 1
        pieces.append(data[at:end])
        at = end
        if at == stop and at < len(data):
            stop = next(stops)
    return pieces


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer coding of a payload; no version line stands in it.

    A last chunk that ends like one is cut in two, as the chunk's line end would complete it.
    """
    pieces = cuts(payload, size, VERSION.encode())
    if pieces and pieces[-1].endswith(VERSION.rstrip().encode()):
        pieces[-1:] = [pieces[-1][:-1], pieces[-1][-1:]]
    parts = [b"%x\r\n%s\r\n" % (len(c), c) for c in pieces]
    return b"".join(parts) + b"0\r\n\r\n"


def unchunk(body: bytes) -> bytes | None:
    """Payload of a chunked body; null if the framing is broken or cut short."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not re.fullmatch(rb"[0-9A-Fa-f]{1,16}", size):
            return None
        n = int(size, 16)
        at = end + 2
        if n == 0:  # trailer fields up to an empty line
            return b"".join(parts) if body[at:] == b"\r\n" or body.endswith(b"\r\n\r\n") else None
        if body[at + n:at + n + 2] != b"\r\n":
            return None
        parts.append(body[at:at + n])
        at += n + 2


def record(fields: list[tuple[str, object]], block: bytes) -> str:
    """A record without its last newline, which the text writer adds."""
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return f"{VERSION}{head}Content-Length: {len(block)}\r\n\r\n{block.decode()}\r\n\r"


def record_id(page_id, digest: str) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{digest}>"


def clean_uri(url: str | None) -> str | None:
    """``url`` as a field: no space or control character, and no version at its end."""
    if url is None:
        return None
    clean = "".join(f"%{ord(c):02X}" if c <= " " else c for c in url)
    return f"{clean[:-1]}%{ord(clean[-1]):02X}" if clean.endswith(VERSION.rstrip()) else clean


def page_records(page_id, url, payload: bytes, digest: str, first, is_revisit: bool,
                 segment_bytes: int, chunk_bytes: int) -> list[str]:
    """All records of one page."""
    own = record_id(page_id, digest)
    common = [("WARC-Date", DATE), ("WARC-Target-URI", clean_uri(url)),
              ("WARC-Payload-Digest", f"sha256:{digest}"),
              ("Content-Type", "application/http;msgtype=response")]
    if is_revisit:
        block = f"{HTTP}Content-Length: {len(payload)}\r\n\r\n".encode()
        return [record([("WARC-Type", "revisit"), ("WARC-Record-ID", own), *common,
                        ("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(first, digest))],
                       block)]
    block = f"{HTTP}Transfer-Encoding: chunked\r\n\r\n".encode() + chunked(payload, chunk_bytes)
    parts = cuts(block, segment_bytes)
    if len(parts) == 1:
        return [record([("WARC-Type", "response"), ("WARC-Record-ID", own), *common], block)]
    found = [record([("WARC-Type", "response"), ("WARC-Record-ID", own), *common,
                     ("WARC-Segment-Number", 1)], parts[0])]
    for k, part in enumerate(parts[1:], 2):
        found.append(record([
            ("WARC-Type", "continuation"), ("WARC-Record-ID", f"{own[:-1]}:{k}>"),
            ("WARC-Date", DATE), ("WARC-Target-URI", clean_uri(url)),
            ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", k),
            ("WARC-Segment-Total-Length", len(block) if k == len(parts) else None)], part))
    return found


def write_archives(pages: DataFrame, path: str, *, segment_bytes: int = SEGMENT_BYTES,
                   chunk_bytes: int = CHUNK_BYTES, revisit_bytes: int = REVISIT_BYTES) -> None:
    """Write ``pages`` (``page_id, url, html``) as archives under ``path``.

    Every row becomes one page; its payload is the html in UTF-8, empty for
    null. Of the pages with equal payloads of at least ``revisit_bytes`` the
    one with the smallest id is the response and the others revisit it (a
    null id comes after all others; rows that repeat the smallest id are
    responses too). A null url leaves its field out. Payloads are compared
    by SHA-256. Other columns are not read.
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary")
                        .alias("payload")).withColumn("digest", F.sha2("payload", 256))
    large = rows.where(F.octet_length("payload") >= revisit_bytes).select("page_id", "digest")
    # only payloads that several pages share; ids and digests move, not payloads
    first = large.groupBy("digest").agg(F.min("page_id").alias("first"),
                                        F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    again = written(large.join(first, "digest").where(
        F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))).select(
        F.col("page_id").alias("_id"), F.col("digest").alias("_digest"), "first").distinct(),
        "warc-revisits")
    few = F.broadcast(again) if again.count() <= BROADCAST_IDS else again
    marked = rows.join(few, F.col("page_id").eqNullSafe(F.col("_id"))
                       & (F.col("digest") == F.col("_digest")), "left").select(
        "page_id", "url", "payload", "digest", "first", F.col("_digest").isNotNull().alias("again"))

    def batches(it):
        for b in it:
            found = [r for row in zip(*(c.to_pylist() for c in b.columns))
                     for r in page_records(*row, segment_bytes, chunk_bytes)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["value"])

    marked.mapInArrow(batches, "value string").write.option("lineSep", "\n").text(path)


def parse_record(raw: bytes) -> dict | None:
    """Fields and block of a record after its version line; null for what is none."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    if not gap:
        return None
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n"):
        k, colon, v = line.partition(":")
        if not colon:
            return None
        fields[k.strip().lower()] = v.strip()
    n = fields.get("content-length", "")
    if not n.isdigit() or len(rest) < int(n):
        return None
    return fields | {"block": rest[:int(n)]}


def read_records(spark: SparkSession, path: str, version: str = VERSION) -> DataFrame:
    """Records of uncompressed archives, one row each, in no order.

    ``record_id, type, uri, digest`` (of the payload, as written), ``refers_to,
    origin_id, segment, total, block``. Broken records (no header, or a block
    shorter than it says) come back with ``type`` null.
    """
    bounded_batches(spark)
    raw = spark.read.option("lineSep", version).text(path).where(F.length("value") > 0)
    names = {"record_id": "warc-record-id", "type": "warc-type", "uri": "warc-target-uri",
             "digest": "warc-payload-digest", "refers_to": "warc-refers-to",
             "origin_id": "warc-segment-origin-id"}

    def batches(it):
        for b in it:
            found = [parse_record(r) or {} for r in b.column(0).to_pylist()]
            cols = [pa.array([f.get(k) for f in found], pa.string()) for k in names.values()]
            for k in ("warc-segment-number", "warc-segment-total-length"):
                cols.append(pa.array([int(f[k]) if f.get(k, "").isdigit() else None
                                      for f in found], pa.int64()))
            cols.append(pa.array([f.get("block") for f in found], pa.binary()))
            yield pa.RecordBatch.from_arrays(cols, names=[*names, "segment", "total", "block"])

    return raw.select(F.col("value").cast("binary")).mapInArrow(
        batches, ", ".join(f"{n} string" for n in names)
        + ", segment long, total long, block binary")


def http_payload(block: bytes) -> tuple[bytes | None, int | None]:
    """Payload of an HTTP response, and the length its header states."""
    head, gap, body = block.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("latin-1").split("\r\n")[1:]:
        k, _, v = line.partition(":")
        fields[k.strip().lower()] = v.strip()
    n = fields.get("content-length", "")
    stated = int(n) if n.isdigit() else None
    if not gap:
        return None, stated
    if "chunked" in fields.get("transfer-encoding", "").lower():
        return unchunk(body), stated
    return body, stated


def read_pages(spark: SparkSession, path: str, *, with_payload: bool = True) -> DataFrame:
    """One row per page of the archives that ``write_archives`` wrote.

    ``page_id`` (as text), ``url``, ``payload_bytes``, ``payload_digest``,
    ``record_type``, ``refers_to`` (a page's id, as text), ``complete`` and,
    unless ``with_payload=False``, ``payload`` (null for revisits). Segments
    are put together by their origin; ``complete`` is false, and the payload
    null, if a segment is missing or doubled, lengths do not add up to the
    total, the framing is broken or the payload's digest is another than the
    record's. For a revisit, bytes and digest are those its record states.
    """
    records = read_records(spark, path).where(F.col("type").isin(
        "response", "revisit", "continuation"))
    single = records.where(F.col("segment").isNull()).select(
        "record_id", "type", "uri", "digest", "refers_to", F.array("block").alias("blocks"),
        F.lit(True).alias("complete"))
    parts = records.where(F.col("segment").isNotNull()).withColumn(
        "origin", F.coalesce("origin_id", "record_id"))
    # one page's own segments; pages written twice have every segment twice
    met = parts.groupBy("origin").agg(
        F.max(F.when(F.col("segment") == 1, F.struct("type", "uri", "digest"))).alias("head"),
        F.count_if(F.col("segment") == 1).alias("times"), F.max("total").alias("total"),
        F.sort_array(F.collect_set(F.struct("segment", "block"))).alias("s"))
    lengths = F.aggregate("s", F.lit(0).cast("long"), lambda a, x: a + F.octet_length(x["block"]))
    in_order = F.transform("s", lambda x, i: x["segment"] == i + 1)
    whole = met.select(
        F.col("origin").alias("record_id"), F.coalesce("head.type", F.lit("response")).alias("type"),
        F.col("head.uri").alias("uri"), F.col("head.digest").alias("digest"),
        F.lit(None).cast("string").alias("refers_to"), F.col("s.block").alias("blocks"),
        (F.coalesce(F.col("total") == lengths, F.lit(False))
         & F.forall(in_order, lambda x: x)).alias("complete"),
        F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.col("times").cast("int")))))
    pages = single.unionByName(whole.drop("col"))
    schema = ("page_id string, url string, payload_bytes long, payload_digest string, "
              "record_type string, refers_to string, complete boolean, payload binary")

    def id_of(urn):
        return (urn or "").removeprefix("<urn:page:").rpartition(":")[0] or None

    def batches(it):
        for b in it:
            rows = b.to_pydict()
            out = {k: [] for k in ("n", "digest", "ok", "payload")}
            for kind, digest, blocks, ok in zip(rows["type"], rows["digest"], rows["blocks"],
                                                rows["complete"]):
                stated = (digest or "").removeprefix("sha256:")
                payload, n = http_payload(b"".join(blocks)) if ok else (None, None)
                if kind == "revisit":
                    payload, own, ok = None, stated, ok and n is not None
                else:
                    own = None if payload is None else hashlib.sha256(payload).hexdigest()
                    n = None if payload is None else len(payload)
                    ok = ok and payload is not None and own == stated
                out["n"].append(n)
                out["digest"].append(own)
                out["ok"].append(ok)
                out["payload"].append(payload if ok and with_payload else None)
            yield pa.RecordBatch.from_arrays([
                pa.array(list(map(id_of, rows["record_id"])), pa.string()),
                pa.array(rows["uri"], pa.string()), pa.array(out["n"], pa.int64()),
                pa.array(out["digest"], pa.string()), pa.array(rows["type"], pa.string()),
                pa.array([id_of(r) if r else None for r in rows["refers_to"]], pa.string()),
                pa.array(out["ok"], pa.bool_()), pa.array(out["payload"], pa.binary())],
                names=["page_id", "url", "payload_bytes", "payload_digest", "record_type",
                       "refers_to", "complete", "payload"])

    found = pages.mapInArrow(batches, T.StructType.fromDDL(schema))
    return found if with_payload else found.drop("payload")


#: What the archives must give back, from the table itself.
ORACLE_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
g AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS first FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM g
"""
