"""WARC archives: written with an index, read back by coalesced byte ranges.

Writing gives one index row per record (file, offset, length, URL, digest, ...) before anything is read. Readers
select rows of the index, sort them by file and offset, merge neighbouring byte ranges into one read each, and
parse only those bytes. Archives of other origin get their index from ``index_archives``.

Records are gzip members of their own, so that any byte range of whole records can be read alone. A response
holds an HTTP head and the payload; a revisit only the HTTP head, whose Content-Length and the record's
WARC-Payload-Digest describe the full payload.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabguard.llm.common import keyed, parallelism, saved
from tabguard.runtime import scratch_path

#: Payloads below this many bytes are never deduplicated.
MIN_REVISIT_BYTES = 100
#: An archive file is closed when it has reached this size.
FILE_BYTES = 64 << 20
#: Records whose gap is at most this are read with one request, as long as the read stays below MAX_READ.
MAX_GAP = 64 << 10
MAX_READ = 8 << 20
#: Bytes of one file whose selected records one task reads.
SEGMENT = 32 << 20

_INDEX = (
    "file string, offset long, length long, url string, payload_digest string, payload_bytes long, "
    "record_type string, key long, refers_to long"
)
_URN = "<urn:record:{}>"
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _head(url: str) -> str:
    """The URL on one header line: blanks and control characters become percent codes."""
    return re.sub(r"[\x00-\x20\x7f\x85\u2028\u2029]", lambda m: quote(m[0]), url)


def encode_record(key, url: str | None, payload: bytes, digest: str, kind: str, refers_to, size: int) -> bytes:
    """One record as a gzip member."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    head = ["WARC/1.1", f"WARC-Type: {kind}", "WARC-Record-ID: " + _URN.format("none" if key is None else key)]
    head += ["WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha256:{digest}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_head(url)}")
    if kind == "revisit":
        head += [f"WARC-Profile: {_REVISIT_PROFILE}", "WARC-Refers-To: " + _URN.format(refers_to)]
    else:
        block += payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def decode_record(raw: bytes) -> dict:
    """Header fields (lower-case names) and block of one uncompressed record; a response also has its payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = {n.strip().lower(): v.strip() for n, _, v in (line.partition(":") for line in lines[1:])}
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    sizes = [v for n, _, v in (h.partition(b":") for h in http.split(b"\r\n")) if n.strip().lower() == b"content-length"]
    fields["block"], fields["payload"] = block, payload if fields.get("warc-type") == "response" else b""
    fields["payload_bytes"] = int(sizes[0]) if sizes else len(payload)
    return fields


def _urn_key(text: str | None) -> int | None:
    name = (text or "").removeprefix("<urn:record:").removesuffix(">")
    return int(name) if name.lstrip("-").isdigit() else None


def _described(fields: dict) -> tuple:
    """url, digest, payload bytes, type, key and refers_to of a decoded record, digest recomputed if there is a payload."""
    kind = fields.get("warc-type")
    url = fields.get("warc-target-uri")
    digest = hashlib.sha256(fields["payload"]).hexdigest() if kind == "response" else fields.get("warc-payload-digest", "").rpartition(":")[2]
    return (
        url, digest, fields["payload_bytes"], kind,
        _urn_key(fields.get("warc-record-id")), _urn_key(fields.get("warc-refers-to")),
    )


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


_INDEX_SCHEMA = pa.schema(
    [("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("url", pa.string()), ("payload_digest", pa.string()),
     ("payload_bytes", pa.int64()), ("record_type", pa.string()), ("key", pa.int64()), ("refers_to", pa.int64())]
)


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """Write rows (key, url, payload, payload_digest, payload_bytes, record_type, refers_to) as archives below
    ``folder``; returns the index.

    File names are unique per attempt and the index is kept by a committed write, so files of failed or repeated
    attempts are never referred to.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pafs.FileSystem.from_uri(folder)
        out, name, at, index = None, "", 0, []
        for batch in batches:
            for row in batch.to_pylist():
                if out is None or at >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    name, at = f"records-{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                payload = row["payload"] or b""
                record = encode_record(
                    row["key"], row["url"], payload, row["payload_digest"], row["record_type"], row["refers_to"], row["payload_bytes"]
                )
                out.write(record)
                index.append(
                    (f"{folder}/{name}", at, len(record), row["url"], row["payload_digest"], row["payload_bytes"], row["record_type"],
                     row["key"], row["refers_to"])
                )
                at += len(record)
            yield _rows(index, _INDEX_SCHEMA)
            index = []
        if out is not None:
            out.close()

    pafs_uri, base = pafs.FileSystem.from_uri(folder)
    pafs_uri.create_dir(base, recursive=True)
    return saved(rows.mapInArrow(run, _INDEX), "warc-index")


def index_archives(spark: SparkSession, files: list[str]) -> DataFrame:
    """Index of archives (``.warc`` or ``.warc.gz`` with a member per record) that came without one, a task per file.

    Files are read as a stream; a record is the most that is held. Records of other types than response and revisit
    are listed, too. Keys are taken from record ids of the form that ``write_archives`` uses, else null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                store, path = pafs.FileSystem.from_uri(uri)
                with store.open_input_stream(path, compression=None) as stream:
                    rows = []
                    for offset, length, raw in _records(stream):
                        rows.append((uri, offset, length, *_described(decode_record(raw))))
                        if len(rows) == 1000:
                            yield _rows(rows, _INDEX_SCHEMA)
                            rows = []
                    yield _rows(rows, _INDEX_SCHEMA)

    listed = spark.createDataFrame([(f,) for f in files], "file string")
    return listed.repartition(max(1, len(files)), "file").mapInArrow(run, _INDEX)


def _records(stream) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, uncompressed record) of each record of an archive that is read from its start."""
    buffer, offset, ended = b"", 0, False

    def more() -> bytes:
        return stream.read(1 << 20)

    while True:
        if not buffer and not ended:
            buffer = more()
        if not buffer:
            return
        if buffer[:1] == b"\x1f":
            unpacker, raw, used = zlib.decompressobj(31), [], 0
            while not unpacker.eof:
                if not buffer and not (buffer := more()):
                    raise EOFError("an archive ends within a record")
                raw.append(unpacker.decompress(buffer))
                used += len(buffer) - len(unpacker.unused_data)
                buffer = unpacker.unused_data if unpacker.eof else b""
            yield offset, used, b"".join(raw)
        else:
            while (end := buffer.find(b"\r\n\r\n")) < 0:
                if not (piece := more()):
                    raise EOFError("an archive ends within a record")
                buffer += piece
            head = buffer[:end].lower()
            size = int(next(x for x in head.split(b"\r\n") if x.startswith(b"content-length:")).partition(b":")[2])
            used = end + 4 + size + 4
            parts, have = [buffer], len(buffer)
            while have < used:
                if not (piece := more()):
                    raise EOFError("an archive ends within a record")
                parts.append(piece)
                have += len(piece)
            whole = b"".join(parts)
            yield offset, used, whole[:used]
            buffer = whole[used:]
        offset += used


def coalesced(ranges: list[tuple[int, int]], max_gap: int = MAX_GAP, max_read: int = MAX_READ) -> list[tuple[int, int, int, int]]:
    """Sorted (offset, length) pairs as reads (start, end, first, last + 1) that each cover the pairs first to last."""
    reads: list[tuple[int, int, int, int]] = []
    for i, (offset, length) in enumerate(ranges):
        end = offset + length
        if reads and offset - reads[-1][1] <= max_gap and end - reads[-1][0] <= max_read:
            start, before, first, _ = reads[-1]
            reads[-1] = (start, max(before, end), first, i + 1)
        else:
            reads.append((offset, end, i, i + 1))
    return reads


def read_records(selected: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records that rows (file, offset, length) of an index select, read from the archives.

    Returns key, url, payload_digest (of the payload read, for revisits the recorded one), payload_bytes,
    record_type, refers_to and, if asked for, payload (null for revisits).
    """
    schema = pa.schema([*list(_INDEX_SCHEMA)[3:], *([pa.field("payload", pa.binary())] if with_payload else [])])

    def read_file(file: str, spans: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
        store, path = pafs.FileSystem.from_uri(file)
        with store.open_input_file(path) as source:
            for start, end, first, last in coalesced(spans):
                source.seek(start)
                data, rows = source.read(end - start), []
                for offset, length in spans[first:last]:
                    raw = data[offset - start : offset - start + length]
                    fields = decode_record(zlib.decompress(raw, 31) if raw[:1] == b"\x1f" else raw)
                    payload = fields["payload"] if fields.get("warc-type") == "response" else None
                    rows.append((*_described(fields), *([payload] if with_payload else [])))
                yield _rows(rows, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, spans = None, []
        for batch in batches:
            for name, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if file is not None and name != file:
                    yield from read_file(file, spans)
                    spans = []
                file = name
                spans.append((offset, length))
        if spans:
            yield from read_file(file, spans)

    segment = F.floor(F.col("offset") / SEGMENT)
    ordered = selected.select("file", "offset", "length").repartition(parallelism(selected.sparkSession), "file", segment)
    ordered = ordered.sortWithinPartitions("file", "offset")
    types = {"int64": "long", "string": "string", "binary": "binary"}
    return ordered.mapInArrow(run, ", ".join(f"{f.name} {types[str(f.type)]}" for f in schema))


def revisit_roles(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Adds payload_digest, payload_bytes, record_type and refers_to to rows (key, url, payload).

    Of rows with equal payloads of ``min_bytes`` or more, those with the smallest key are responses and the others
    revisit it. Null keys count as larger than any; if all keys of a group are null, all are responses.
    """
    bytes_of = F.coalesce(F.col("payload"), F.lit(b""))
    described = pages.withColumns({"payload_digest": F.sha2(bytes_of, 256), "payload_bytes": F.octet_length(bytes_of).cast("long")})
    copies = (
        described.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest")
        .agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("first_key")).where("n > 1").select("payload_digest", "first_key")
    )
    joined = described.join(copies, "payload_digest", "left")
    later = F.col("first_key").isNotNull() & (F.col("key").isNull() | (F.col("key") > F.col("first_key")))
    return joined.withColumns(
        {
            "record_type": F.when(later, "revisit").otherwise("response"),
            "refers_to": F.when(later, F.col("first_key")),
        }
    ).select("key", "url", "payload", "payload_digest", "payload_bytes", "record_type", "refers_to")


def archive_pages(
    pages: DataFrame, folder: str, key_col: str = "page_id", url_col: str = "url", payload_col: str = "html"
) -> DataFrame:
    """Write a record per row of ``pages`` below ``folder`` (a URI) and return the index.

    The payload is the column's text in UTF-8, or its bytes; null is an empty payload. Null URLs give records
    without a target, null keys records without a number. Repeated keys and rows give a record each. Other columns
    are ignored. Blanks and control characters of a URL are percent-encoded in its record; the index has it as it is.
    An empty table gives an empty index.
    """
    rows = keyed(pages, key=key_col, url=url_col, payload=payload_col).withColumns(
        {"key": F.col("key").cast("long"), "payload": F.col("payload").cast("binary")}
    )
    return write_archives(revisit_roles(rows), folder)


def round_trip(pages: DataFrame, key_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Archive all rows in the shared folder, then read every record back through the index."""
    folder = scratch_path(pages.sparkSession, "warc")
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    index = archive_pages(pages, folder, key_col, url_col, payload_col)
    return read_records(index, with_payload=False)
