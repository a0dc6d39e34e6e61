"""Web archives: writing with revisit, continuation and chunked framing, and reading by segment reassembly.

The writer puts one record on one row and lets Spark's text sink end each with
the format's own ``CRLF CRLF``, so archives land wherever Spark can write.  The
reader takes whole archive files from Spark's binary source and walks them by
Content-Length, decompressing as it goes.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import Store, map_batches, pick

LEAST_REVISIT = 1000  # payload bytes from which a repeat becomes a revisit
SEGMENT = 32 * 1024  # block bytes a record holds at most
CHUNK = 4 * 1024
FILE_BYTES = 64 * 1024 * 1024  # an archive's worst case: a reader's task holds one whole

_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def chunked(payload: bytes, size: int) -> bytes:
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload under chunked transfer framing; raises ValueError if the framing is broken."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        at = end + 2
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk does not end where its size says")
        out.append(body[at : at + size])
        at += size + 2


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in headers)
    return b"WARC/1.1\r\n" + f"{head}Content-Length: {len(block)}\r\n\r\n".encode() + block


def _uri(page_id, sha1: str) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}:{sha1}>"


def _records(page_id, url, payload: bytes, sha1: str, size: int, owner, segment: int, chunk: int) -> Iterator[bytes]:
    """The records of one page: a revisit, a response, or a response and its continuations."""
    digest = "sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode()
    name = _uri(page_id, sha1)
    base = [("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Payload-Digest", digest)]
    base += [("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A"))] if url else []
    kind = [("Content-Type", "application/http;msgtype=response")]
    if owner is not None:
        block = _HTTP + b"Content-Length: %d\r\n\r\n" % size
        yield _record([("WARC-Type", "revisit"), ("WARC-Record-ID", name), ("WARC-Refers-To", _uri(owner, sha1)), ("WARC-Profile", _PROFILE), *base, *kind], block)
        return
    block = _HTTP + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload, chunk)
    parts = [block[i : i + segment] for i in range(0, len(block), segment)]
    for n, part in enumerate(parts, 1):
        own = [("WARC-Segment-Number", str(n))] if len(parts) > 1 else []
        own += [("WARC-Segment-Total-Length", str(len(block)))] if n == len(parts) > 1 else []
        if n == 1:
            yield _record([("WARC-Type", "response"), ("WARC-Record-ID", name), *own, *base, *kind], part)
        else:
            yield _record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"{name[:-1]}:{n}>"), ("WARC-Segment-Origin-ID", name), *own, *base], part)


def write_warc(pages: DataFrame, path: str, segment: int = SEGMENT, chunk: int = CHUNK) -> None:
    """Write ``page_id, url, html`` as gzipped archives under ``path``.

    Of rows with equal payloads of at least ``LEAST_REVISIT`` bytes the one with
    the largest page_id is the response and the others revisit it (rows that
    repeat that page_id too are responses); smaller payloads are all responses.
    Null html is an empty payload; null ids and urls are written as such; an
    empty table writes an archive without records; other columns are ignored."""
    rows = pick(pages, "page_id", "url", "html").select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("long").alias("size"), F.sha1("payload").alias("sha1"))
    repeats = rows.where(F.col("size") >= LEAST_REVISIT).groupBy("sha1").agg(F.max("page_id").alias("owner"), F.count("*").alias("n")).where("n > 1").drop("n")
    joined = rows.join(repeats, "sha1", "left").withColumn("owner", F.when(F.col("owner").eqNullSafe(F.col("page_id")), F.lit(None)).otherwise(F.col("owner")))
    joined = joined.withColumn("payload", F.when(F.col("owner").isNull(), F.col("payload")))

    def run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        for row in zip(*(b[c].to_pylist() for c in ("page_id", "url", "payload", "sha1", "size", "owner"))):
            out += _records(*row, segment, chunk)
            held += row[4]
            if held > 8_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])
                out, held = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    records = map_batches(joined, run, "record binary").select(F.col("record").cast("string").alias("value"))
    records.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", FILE_BYTES // (segment + 1024)).text(path)


def records_of(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and block of each record of an archive, gzipped or plain; one record is held at a time."""
    buffer, at = bytearray(), 0
    plain = content[:2] != b"\x1f\x8b"
    inflate = zlib.decompressobj(31)

    def more() -> bool:
        nonlocal at, inflate
        if at >= len(content):
            return False
        piece = content[at : at + (1 << 20)]
        at += len(piece)
        while piece:
            if plain:
                buffer.extend(piece)
                break
            buffer.extend(inflate.decompress(piece))
            piece = inflate.unused_data
            if piece:  # the next member
                inflate = zlib.decompressobj(31)
        return True

    while True:
        while (end := buffer.find(b"\r\n\r\n")) < 0:
            if not more():
                if buffer.strip():
                    raise ValueError("an archive ends inside a record's header")
                return
        lines = buffer[:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record starts here: {lines[0][:40]!r}")
        headers = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = int(headers["content-length"])
        while len(buffer) < end + 8 + size:
            if not more():
                raise ValueError("an archive ends inside a record")
        block = bytes(buffer[end + 4 : end + 4 + size])
        del buffer[: end + 8 + size]
        yield headers, block


_PART = "origin string, type string, page_id long, refers_to long, sha1 string, number int, total long, block binary"


def _page(uri: str | None) -> int | None:
    found = (uri or "<urn:page:none:>").split(":")[2]
    return None if found == "none" else int(found)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Responses and revisits of all archives under ``path``: page_id, record_type, payload, payload_bytes, payload_digest (hex SHA-1), refers_to.

    Records without segment numbers are whole.  The rest are grouped by their
    origin's identifier and ordered by segment number; missing or surplus bytes
    against the declared total length, broken chunks and digests that differ
    raise.  Equal records that repeat an identifier give a row each.  A
    revisit's payload is null; its size comes from its kept HTTP header."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _PART.split(", ")]
        types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.binary()]

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names=names)

        for b in batches:
            for content in b["content"]:
                rows, held = [], 0
                for h, block in records_of(content.as_py()):
                    origin = h.get("warc-segment-origin-id", h["warc-record-id"])
                    sha1 = base64.b32decode(h["warc-payload-digest"].removeprefix("sha1:")).hex()
                    refers = _page(h["warc-refers-to"]) if "warc-refers-to" in h else None
                    rows.append((origin, h["warc-type"], _page(origin), refers, sha1, int(h.get("warc-segment-number", 0)), int(h.get("warc-segment-total-length", 0)), block))
                    held += len(block)
                    if held > 8_000_000:
                        yield batch(rows)
                        rows, held = [], 0
                if rows:
                    yield batch(rows)

    parts = files.mapInArrow(run, _PART)
    whole = parts.where("number = 0").select("page_id", "type", "refers_to", "sha1", F.array("block").alias("blocks"))
    # one group is one page's records: its size is that of a single payload
    pieces = parts.where("number > 0").groupBy("origin", "page_id", "sha1").agg(
        F.array_sort(F.collect_set(F.struct("number", "block"))).alias("pieces"), F.max("total").alias("total"), F.sum(F.when(F.col("number") == 1, 1).otherwise(0)).alias("copies")
    )
    blocks = F.transform("pieces", lambda p: p["block"])
    there = F.aggregate(blocks, F.lit(0).cast("long"), lambda n, x: n + F.octet_length(x))
    checked = F.when(there != F.col("total"), F.raise_error(F.concat(F.lit("wrong total length: "), F.col("origin")))).otherwise(blocks)
    joined = pieces.withColumn("blocks", checked).withColumn("copy", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.col("copies")).cast("int"))))
    joined = joined.select("page_id", F.lit("response").alias("type"), F.lit(None).cast("long").alias("refers_to"), "sha1", "blocks")

    def decode(b: pa.RecordBatch) -> pa.RecordBatch:
        payloads, sizes = [], []
        for kind, sha1, blocks in zip(b["type"].to_pylist(), b["sha1"].to_pylist(), b["blocks"]):
            head, _, body = b"".join(blocks.as_py()).partition(b"\r\n\r\n")
            fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:])}
            if kind == "revisit":
                payloads.append(None)
                sizes.append(int(fields[b"content-length"]))
                continue
            payload = unchunked(body) if fields.get(b"transfer-encoding") == b"chunked" else body
            if hashlib.sha1(payload).hexdigest() != sha1:
                raise ValueError("a payload differs from its digest")
            payloads.append(payload)
            sizes.append(len(payload))
        return pa.RecordBatch.from_arrays([b["page_id"], b["type"], pa.array(payloads, pa.binary()), pa.array(sizes, pa.int64()), b["sha1"], b["refers_to"]], names=["page_id", "record_type", "payload", "payload_bytes", "payload_digest", "refers_to"])

    return map_batches(whole.unionByName(joined), decode, "page_id long, record_type string, payload binary, payload_bytes long, payload_digest string, refers_to long")


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages as archives in the shared folder and read them back.

    Null html is an empty payload; null and repeated page_ids are records
    each; a null url is written as empty; an empty table gives no rows; other
    columns are ignored."""
    store = Store(pages.sparkSession, "warc")
    path = store.path("archive")
    write_warc(pages, path)
    store.release()
    return read_warc(pages.sparkSession, path)
