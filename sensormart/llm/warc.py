"""WARC archives: written with revisit records, read back by byte ranges."""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensormart.llm.common import open_store, slices, text_or_empty
from sensormart.session import materialise, scratch_path

MAGIC = b"\x1f\x8b\x08"
#: Payloads below this size are always stored again.
REVISIT_BYTES = 100
SPLIT_BYTES = 32 << 20
FILE_BYTES = 1 << 30
_CHUNK = 256 << 10
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "1970-01-01T00:00:00Z"


# -- records -----------------------------------------------------------------
def encode_record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record as a gzip member of its own; a revisit keeps only the HTTP head."""
    revisit = refers_to is not None
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = head.encode() + (b"" if revisit else payload)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {' '.join(url.split())}",
        f"WARC-Date: {_DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        *([f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_PROFILE}"] if revisit else []),
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    record = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return deflate.compress(record) + deflate.flush()


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def decode_record(record: bytes) -> dict:
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    revisit = fields["warc-type"] == "revisit"
    if not revisit and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"payload of {fields['warc-record-id']} differs from its digest")
    return {
        "page_id": _page(fields["warc-record-id"]),
        "payload_bytes": int(_fields(http)["content-length"]) if revisit else len(payload),
        "payload_digest": digest,
        "record_type": fields["warc-type"],
        "refers_to": _page(fields.get("warc-refers-to", "")),
        "payload": None if revisit else payload,
    }


def _page(name: str) -> int | None:
    number = name.strip("<>").removeprefix("urn:page:")
    return int(number) if number else None


# -- byte ranges -------------------------------------------------------------
def read_member(stream, size: int, at: int, keep: bool) -> tuple[int, bytes] | None:
    """The end of the gzip member at ``at`` and its content (if kept).

    None if no member with a WARC head starts there. A member that begins well
    and then breaks is damage, not chance: it raises.
    """
    inflate, content, seen, started = zlib.decompressobj(31), [], b"", False
    place = at
    while not inflate.eof:
        data = stream.read_at(min(_CHUNK, size - place), place) if place < size else b""
        try:
            part = inflate.decompress(data)
        except zlib.error as error:
            if started or _begins_well(data):
                raise ValueError(f"damaged member at byte {at}") from error
            return None
        if not started:
            seen += part
            if len(seen) >= 5 and seen[:5] != b"WARC/":
                return None
            started = b"\r\n\r\n" in seen
        if keep:
            content.append(part)
        if not data:
            if started:
                raise ValueError(f"cut member at byte {at}")
            return None
        place += len(data)
    return (place - len(inflate.unused_data), b"".join(content)) if started else None


def _begins_well(data: bytes) -> bool:
    """Whether the first bytes of a member that fails later decode to a WARC head."""
    try:
        return zlib.decompressobj(31).decompress(data[:64]).startswith(b"WARC/")
    except zlib.error:
        return False


def first_member(stream, size: int, start: int, end: int) -> int | None:
    """The first true member that starts in [start, end).

    Magic bytes also turn up inside members. A candidate counts if it decodes,
    and all that follows it does, up to the end of the range: inside another
    member such a chain ends in bytes that are no member.
    """
    place = start
    while place < end:
        data = bytes(stream.read_at(min(_CHUNK, size - place), place))
        found = data.find(MAGIC)
        if found < 0:
            if place + len(data) >= size:
                return None
            place += max(1, len(data) - len(MAGIC) + 1)
            continue
        place += found
        if place >= end:
            return None
        if _chain(stream, size, place, end):
            return place
        place += 1
    return None


def _chain(stream, size: int, at: int, end: int) -> bool:
    while at < min(end, size):
        member = read_member(stream, size, at, keep=False)
        if member is None:
            return False
        at = member[0]
    return at == size or bytes(stream.read_at(min(len(MAGIC), size - at), at)) == MAGIC


def read_range(stream, size: int, start: int, end: int) -> Iterator[bytes]:
    """The records whose members start in [start, end)."""
    at = first_member(stream, size, start, end)
    while at is not None and at < min(end, size):
        at, record = read_member(stream, size, at, keep=True)
        yield record


# -- operators ---------------------------------------------------------------
def write_warc(pages: DataFrame, folder: str | None = None, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write one record per page and return the manifest: path, size.

    The payload is the html in UTF-8 (null: empty). Of pages with equal payloads
    of at least ``REVISIT_BYTES`` the one with the smallest page_id is a response,
    the others are revisits that refer to it. Pages that share that smallest id
    are all responses; without any id all are. Null ids follow all others. An url
    column is used if there is one; other columns are not read. An empty table
    gives an empty manifest. Files of failed tasks are in no manifest.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    url = F.col("url").cast("string") if "url" in pages.columns else F.lit("")
    html = text_or_empty("html")
    narrow = pages.select(
        F.col("page_id").cast("long"),
        F.coalesce(url, F.lit("")).alias("url"),
        html.alias("html"),
        F.sha2(F.encode(html, "UTF-8"), 256).alias("digest"),
    )
    repeated = (
        narrow.filter(F.octet_length("html") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("pages"))
        .filter("pages > 1")
        .select("digest", "first")
    )
    # Written, so that Spark knows its size and can split a digest with very many pages.
    repeated = materialise(repeated, "repeated-payloads")
    records = narrow.join(repeated, "digest", "left").withColumn(
        "refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, path, size, done = None, "", 0, []
        for batch in batches:
            for part in slices(batch, "html"):
                for row in part.to_pylist():
                    if stream is None or size >= file_bytes:
                        if stream is not None:
                            stream.close()
                            done.append({"path": path, "size": size})
                        store, root = open_store(folder)
                        store.create_dir(root, recursive=True)
                        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                        stream, path, size = store.open_output_stream(f"{root}/{name}", compression=None), f"{folder}/{name}", 0
                    payload = row["html"].encode()
                    size += stream.write(
                        encode_record(row["page_id"], row["url"], payload, row["digest"], row["refers_to"])
                    )
        if stream is not None:
            stream.close()
            done.append({"path": path, "size": size})
            yield pa.RecordBatch.from_pylist(done)

    columns = records.select("page_id", "url", "html", "digest", "refers_to")
    return materialise(columns.mapInArrow(write, "path string, size long"), "warc-manifest")


def read_warc(manifest: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Read archives in byte ranges; each record belongs to the range it starts in.

    Returns page_id, payload_bytes, payload_digest, record_type, refers_to, and
    the payload (null for revisits). A payload that differs from its digest, and
    a damaged member, raise. Members inside a range are told from chance by
    decoding up to the range's end, so ``split_bytes`` should exceed archives that
    are themselves stored inside records.
    """
    step = F.lit(split_bytes).cast("long")
    ranges = manifest.filter("size > 0").select(
        "path", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, step)).alias("start")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.to_pylist():
                store, path = open_store(part["path"])
                rows, held = [], 0
                with store.open_input_file(path) as stream:
                    for record in read_range(stream, part["size"], part["start"], part["start"] + split_bytes):
                        rows.append(decode_record(record))
                        held += len(record)
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, _RECORD)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, _RECORD)

    return ranges.repartition(max(1, ranges.count())).mapInArrow(
        read,
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary",
    )


_RECORD = pa.schema(
    [
        ("page_id", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)
