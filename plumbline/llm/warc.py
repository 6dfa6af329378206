"""WARC archives: written as whole-file gzip streams, normalised to a gzip member per record, indexed and read back.

Archives are written through Spark's text writer, so they land wherever Spark can write: a record's end mark is the line
separator, and the writer's gzip makes one stream of the file. The normaliser inflates each stream once and writes every record as a
gzip member of its own. A member of less than 16 MiB of content ends in a zero byte (the top of its size field); a
longer one is followed by an empty member, which does. That byte is the line
separator of the second text writer, so its files are byte for byte the concatenated members.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from plumbline.llm.common import small_or_shuffled
from plumbline.session import scratch_dir

END = "\r\n\r\n"  # behind each record
ROW_BYTES = 2 << 20  # of records in a row of the text writer; a longer record is a row of its own
ROWS_PER_FILE = 64  # so a file inflates to 128 MiB, or to 64 times its longest record
READ = 1 << 16  # compressed bytes inflated at a time
EMPTY_MEMBER = gzip.compress(b"", mtime=0)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


def payload_digest(payload: bytes) -> str:
    """Upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: object, url: str, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {digest} {url}')}>"


def _record(page_id, url, html, refers_to, revisit: bool, date: str) -> str:
    """A record without its end mark."""
    body = html or ""
    raw = body.encode()
    digest = payload_digest(raw)
    target = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url or f"urn:page:{page_id}")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(raw)}\r\n\r\n"
    length = len(http.encode()) + (0 if revisit else len(raw))
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id, target, digest)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(raw)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {length}",
    ]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page-Id: {refers_to}"]
    return "\r\n".join(head) + "\r\n\r\n" + http + ("" if revisit else body)


def _records(date: str):
    """Records in rows of about ROW_BYTES: what stands between two of a row is the end mark, as between rows."""

    def row(held: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([END.encode().join(held)]).cast(pa.string())], names=["value"])

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for r in batch.slice(at, 256).to_pylist():
                    made = _record(r["page_id"], r["url"], r["html"], r["refers_to"], r["revisit"], date).encode()
                    if held and size + len(made) > ROW_BYTES:
                        yield row(held)
                        held, size = [], 0
                    held.append(made)
                    size += len(made)
        if held:
            yield row(held)

    return go


def write_archives(pages: DataFrame, path: str, least_revisit: int = 0, date: str = DATE) -> None:
    """Write (page_id, url, html) as gzip streams of WARC records below ``path``, one record per row.

    Of rows with equal payloads of ``least_revisit`` bytes or more, those with the largest page_id are responses and the others revisit it; rows
    without page_id revisit only if some row of their payload has one. A null html is an empty payload, a null url
    becomes urn:page:<page_id>. Only digests that occur more than once are joined back. Files are bounded by bytes: 64 rows of
    2 MiB of records, or of one longer record, each.
    """
    body = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    given = pages.select("page_id", "url", "html", F.sha1(body).alias("digest"), F.octet_length(body).alias("bytes"))
    large = given.where(F.col("bytes") >= least_revisit)
    shared = large.groupBy("digest").agg(F.count("*").alias("n"), F.max("page_id").alias("refers_to"))
    shared = shared.where("n > 1 and refers_to is not null").select("digest", "refers_to")
    joined = given.join(small_or_shuffled(shared), "digest", "left").withColumn(
        "revisit", F.expr("refers_to is not null and not (page_id <=> refers_to)")
    )
    records = joined.select("page_id", "url", "html", "refers_to", "revisit").mapInArrow(_records(date), "value string")
    writer = records.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", ROWS_PER_FILE)
    writer.text(path)


def _inflated(content: memoryview) -> Iterator[tuple[bytes, int, int]]:
    """(piece, begin, end): inflated pieces of a file of gzip members; begin and end of the member, with its last piece only."""
    at = begin = 0
    while at < len(content):
        inflate = zlib.decompressobj(31)
        while not inflate.eof:
            chunk = content[at : at + READ]
            if not len(chunk):
                raise ValueError("a gzip member is cut off")
            piece = inflate.decompress(chunk)
            at += len(chunk) - len(inflate.unused_data)
            yield piece, begin, at if inflate.eof else -1
        begin = at


def _head(raw: bytes) -> dict[str, str]:
    lines = raw.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}


def split_records(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records, end mark included, of an inflated stream; only the record under way is held."""
    held = bytearray()
    need = -1
    for piece in pieces:
        held += piece
        while True:
            if need < 0:
                edge = held.find(b"\r\n\r\n")
                if edge < 0:
                    break
                need = edge + 4 + int(_head(bytes(held[:edge]))["content-length"]) + len(END)
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = -1
    if held:
        raise ValueError("the archive ends inside a record")


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column(0):
            rows, size = [], 0
            for record in split_records(piece for piece, _, _ in _inflated(memoryview(content.as_buffer()))):
                member = gzip.compress(record, 6, mtime=0)
                if member[-1]:
                    member += EMPTY_MEMBER
                rows.append(member[:-1])
                size += len(member)
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["value"])
                    rows, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["value"])


def normalise_archives(spark: SparkSession, source: str, path: str) -> None:
    """Rewrite the gzip archives below ``source`` with a member per record, below ``path``."""
    whole = spark.read.format("binaryFile").load(source).select("content")
    members = whole.mapInArrow(_members, "value binary")
    members.select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\x00").text(path)


def _entry(raw: bytes) -> dict:
    edge = raw.index(b"\r\n\r\n")
    head = _head(raw[:edge])
    block = raw[edge + 4 : len(raw) - len(END)]
    if len(block) != int(head["content-length"]):
        raise ValueError("a record's length differs from its header")
    digest, size = head["warc-payload-digest"].removeprefix("sha1:"), int(head["x-payload-length"])
    if head["warc-type"] == "response":
        payload = block[block.index(b"\r\n\r\n") + 4 :]
        if payload_digest(payload) != digest or len(payload) != size:
            raise ValueError("a payload differs from its digest")
    return {
        "record_id": head["warc-record-id"],
        "record_type": head["warc-type"],
        "target_uri": head["warc-target-uri"],
        "page_id": int(head["x-page-id"]) if "x-page-id" in head else None,
        "payload_bytes": size,
        "payload_digest": digest,
        "refers_to": int(head["x-refers-to-page-id"]) if "x-refers-to-page-id" in head else None,
    }


INDEX = pa.schema(
    [
        ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()),
        ("target_uri", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()),
    ]
)


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            rows: list[dict] = []
            held = bytearray()
            for piece, begin, end in _inflated(memoryview(content.as_buffer())):
                held += piece
                if end < 0:
                    continue
                if held:
                    rows.append({"archive": path, "offset": begin, "length": end - begin, **_entry(bytes(held))})
                    held.clear()
                elif rows:  # the empty member behind a long record
                    rows[-1]["length"] += end - begin
            yield from pa.Table.from_pylist(rows, INDEX).to_batches()


def index_archives(spark: SparkSession, source: str, path: str) -> DataFrame:
    """Read every record below ``source`` back, check its payload, and write the sidecar index of offsets to ``path``."""
    whole = spark.read.format("binaryFile").load(source).select("path", "content")
    kinds = {pa.string(): "string", pa.int64(): "long"}
    schema = ", ".join(f"`{f.name}` {kinds[f.type]}" for f in INDEX)
    whole.mapInArrow(_index, schema).write.parquet(path)
    return spark.read.parquet(path)


def record_at(content: bytes, offset: int, length: int) -> bytes:
    """One record, from its place in the index alone."""
    return gzip.decompress(content[offset : offset + length])


def archived(pages: DataFrame, least_revisit: int = 0) -> DataFrame:
    """Write, normalise and index archives of ``pages`` in the shared folder; the index, a row per page.

    Empty input makes archives without records and an empty index. Repeated rows are records of their own.
    """
    spark = pages.sparkSession
    base = scratch_dir(spark, "warc")
    write_archives(pages, f"{base}/stream", least_revisit)
    normalise_archives(spark, f"{base}/stream", f"{base}/members")
    return index_archives(spark, f"{base}/members", f"{base}/index")
