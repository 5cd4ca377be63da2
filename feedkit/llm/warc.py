"""WARC archives: one gzip member per record, written and read by Spark tasks.

The reader is sequential: it inflates one member at a time with an incremental decompressor, takes the block by its
Content-Length and checks the digests. It reads archives of other writers as well: digests by their label, header lines
in any case, with or without a space and folded, records without digests, and ids of any form. Archives are opened
through Arrow's file systems, by the URI of the folder.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedkit.errors import FeedkitError
from feedkit.llm.text import pieces, utf8
from feedkit.operators.skew import join_on
from feedkit.session import fresh_path

VERSION = "WARC/1.1"
# Shorter payloads are never revisits.
MIN_REVISIT_BYTES = 100
# A task begins another archive beyond this many compressed bytes.
ARCHIVE_BYTES = 1 << 30
READ_BYTES = 1 << 18
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = "urn:page:"


class WarcError(FeedkitError):
    """An archive that breaks the format, or a record whose digest does not fit."""


class Record(NamedTuple):
    """Place in the archive, header fields by lower-case name (the first of repeated ones), and the block."""

    offset: int
    headers: dict[str, str]
    block: bytes


class Payload(NamedTuple):
    """A revisit has no data and speaks for the full payload; its size and digest are None where it does not say them.

    ``digest`` is the hex SHA-256, ``stated`` what the record says, ``checked`` whether that was compared: None without a
    payload to compare or a stated digest, False for a label that is not known.
    """

    size: int | None
    digest: str | None
    data: bytes | None
    stated: str | None = None
    checked: bool | None = None


def _digest(data: bytes) -> str:
    return "sha256:" + hashlib.sha256(data).hexdigest()


_HASHES = {"md5": hashlib.md5, "sha1": hashlib.sha1, "sha256": hashlib.sha256, "sha512": hashlib.sha512}


def stated_digest(stated: str) -> tuple[str, bytes] | None:
    """Label and bytes of a digest such as ``sha1:...`` in base16 or base32, None if the label is not known.

    Raises WarcError for a value that has neither form.
    """
    label, _, value = stated.strip().partition(":")
    label, value = label.strip().lower().replace("-", ""), value.strip()
    if label not in _HASHES:
        return None
    size = _HASHES[label]().digest_size
    try:
        if len(value) == 2 * size:
            return label, bytes.fromhex(value)
        bare = value.rstrip("=").upper()
        data = base64.b32decode(bare + "=" * (-len(bare) % 8))
    except (ValueError, binascii.Error) as e:
        raise WarcError(f"no digest: {stated}") from e
    if len(data) != size:
        raise WarcError(f"no digest: {stated}")
    return label, data


def fits(stated: str, data: bytes) -> bool | None:
    """Whether the data have the stated digest; None if its label is not known."""
    known = stated_digest(stated)
    return None if known is None else _HASHES[known[0]](data).digest() == known[1]


def header_fields(lines: list[str]) -> dict[str, str]:
    """Header lines as fields by lower-case name; lines that begin with white space go on with the one before.

    Of repeated fields the first counts; lines without a colon are passed over.
    """
    whole: list[str] = []
    for line in lines:
        if line[:1] in (" ", "\t") and whole:
            whole[-1] += " " + line.strip()
        else:
            whole.append(line)
    fields: dict[str, str] = {}
    for name, colon, value in (x.partition(":") for x in whole):
        if colon:
            fields.setdefault(name.strip().lower(), value.strip())
    return fields


def _length(fields: dict[str, str]) -> int | None:
    """The Content-Length, None if there is none or it is no number."""
    value = fields.get("content-length", "")
    return int(value) if value.isascii() and value.isdigit() else None


def _line(value: str) -> str:
    """A header value without line breaks."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def encode_record(headers: dict[str, str], block: bytes) -> bytes:
    """One record as a gzip member of its own."""
    fields = headers | {"WARC-Block-Digest": _digest(block), "Content-Length": str(len(block))}
    head = VERSION + "\r\n" + "".join(f"{k}: {_line(v)}\r\n" for k, v in fields.items()) + "\r\n"
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(head.encode()) + deflate.compress(block) + deflate.compress(b"\r\n\r\n") + deflate.flush()


def read_records(stream, path: str = "") -> Iterator[Record]:
    """Records of an archive in order; memory is bounded by one record.

    Raises WarcError for a cut-off member, a record without Content-Length, a block that is shorter or longer than it,
    and a block that differs from its digest. A block digest of an unknown label is not checked.
    """
    rest, position = b"", 0
    while True:
        rest = rest or stream.read(READ_BYTES)
        if not rest:
            return
        offset, inflate, data, size, headers = position, zlib.decompressobj(31), bytearray(), None, {}
        while True:
            data += inflate.decompress(rest)
            position += len(rest) - len(inflate.unused_data)
            if size is None and (end := data.find(b"\r\n\r\n")) >= 0:
                first, *lines = bytes(data[:end]).decode(errors="replace").split("\r\n")
                if not first.startswith("WARC/"):
                    raise WarcError(f"{path} at {offset}: no WARC record")
                headers = header_fields(lines)
                if (size := _length(headers)) is None:
                    raise WarcError(f"{path} at {offset}: no Content-Length")
                del data[: end + 4]
            if inflate.eof:
                rest = inflate.unused_data
                break
            if not (rest := stream.read(READ_BYTES)):
                raise WarcError(f"{path} at {offset}: the record is cut off")
        if size is None or len(data) != size + 4 or data[size:] != b"\r\n\r\n":
            raise WarcError(f"{path} at {offset}: the block does not fit its Content-Length")
        block = bytes(data[:size])
        if "warc-block-digest" in headers and fits(headers["warc-block-digest"], block) is False:
            raise WarcError(f"{path} at {offset}: the block differs from its digest")
        yield Record(offset, headers, block)


def http_payload(record: Record, path: str = "") -> Payload:
    """The payload of a record: what follows the HTTP header, or the whole block where there is none.

    A length that the HTTP header states counts for revisits alone; what was stored may be cut or chunked. Raises
    WarcError for a payload that differs from its digest.
    """
    head, _, data = record.block.partition(b"\r\n\r\n")
    http = head.startswith(b"HTTP/")
    stated = record.headers.get("warc-payload-digest")
    if record.headers.get("warc-type", "").lower() == "revisit":
        size = _length(header_fields(head.decode(errors="replace").split("\r\n")[1:])) if http else None
        known = stated_digest(stated) if stated else None
        return Payload(size, known[1].hex() if known and known[0] == "sha256" else None, None, stated)
    data = data if http else record.block
    checked = None if stated is None else fits(stated, data)
    if checked is False:
        raise WarcError(f"{path} at {record.offset}: the payload differs from its digest")
    return Payload(len(data), hashlib.sha256(data).hexdigest(), data, stated, None if stated is None else bool(checked))


def mark_revisits(pages: DataFrame, id_: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Rows (id, url, payload, digest, refers_to): refers_to is the smallest id with an equal payload, for other rows.

    Payloads under MIN_REVISIT_BYTES refer to nothing. A null payload is an empty one. Rows that repeat the smallest id
    of their payload are responses as well; a row without id refers to the smallest id there is. Other columns are
    left out.
    """
    rows = pages.select(F.col(id_).alias("id"), F.col(url).alias("url"), utf8(html).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    # Only payloads that occur again are joined. Counting combines before the shuffle, so a hot payload is no burden.
    again = (
        rows.filter(F.octet_length("payload") >= MIN_REVISIT_BYTES)
        .groupBy(F.col("digest").alias("again"))
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .drop("n")
    )
    later = F.col("id").isNull() | (F.col("id") > F.col("first"))
    joined = join_on(rows, again, {"digest": "again"})
    return joined.withColumn("refers_to", F.when(later, F.col("first"))).drop("first")


def _records_of(batch: pa.RecordBatch) -> Iterator[bytes]:
    for row in batch.to_pylist():
        page, payload, revisit = row["id"], row["payload"], row["refers_to"] is not None
        block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
        headers = {
            "WARC-Type": "revisit" if revisit else "response",
            "WARC-Record-ID": f"<{_ID}{'' if page is None else page}>",
            "WARC-Date": "1970-01-01T00:00:00Z",
            "Content-Type": "application/http;msgtype=response",
            "WARC-Payload-Digest": "sha256:" + row["digest"],
        }
        if row["url"] is not None:
            headers["WARC-Target-URI"] = row["url"]
        if revisit:
            headers |= {"WARC-Refers-To": f"<{_ID}{row['refers_to']}>", "WARC-Profile": IDENTICAL}
        yield encode_record(headers, block.encode() + (b"" if revisit else payload))


def write_warc(marked: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes the rows of ``mark_revisits`` as archives into the folder and returns the manifest (path, records).

    Every attempt of a task writes archives of its own; the manifest is written by Spark and names only those of the
    attempts that succeeded. Readers go by the manifest, so a lost executor leaves no half archive behind in it.
    """
    spark = marked.sparkSession
    folder = folder or fresh_path(spark, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        out, done, name, count, size = None, [], "", 0, 0
        for batch in pieces(batches, "payload"):
            for record in _records_of(batch):
                if out is None:
                    name = f"{base}/pages-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                    out, count, size = store.open_output_stream(name, compression=None), 0, 0
                    info = {"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>"}
                    info |= {"WARC-Date": "1970-01-01T00:00:00Z", "Content-Type": "application/warc-fields"}
                    out.write(encode_record(info, b"format: WARC File Format 1.1\r\n"))
                out.write(record)
                count, size = count + 1, size + len(record)
                if size >= ARCHIVE_BYTES:
                    out.close()
                    done, out = [*done, (name, count)], None
        if out is not None:
            out.close()
            done.append((name, count))
        for path, n in done:
            yield pa.RecordBatch.from_pydict({"path": [path], "records": [n]})

    manifest = f"{folder}/manifest"
    marked.select("id", "url", "payload", "digest", "refers_to").mapInArrow(write, "path string, records long").write.parquet(
        manifest
    )
    return spark.read.schema("path string, records long").parquet(manifest).withColumn("folder", F.lit(folder))


RECORD_SCHEMA = (
    "path string, offset long, id long, url string, record_type string, refers_to long, "
    "payload_bytes long, payload_digest string, record_id string, refers_to_id string, refers_to_uri string, "
    "stated_digest string, digest_checked boolean"
)
_TYPES = {"long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}


def archives(spark: SparkSession, folder: str, pattern: str = "*.warc.gz") -> DataFrame:
    """The archives of a folder and the folders below it as a manifest for ``read_warc``, whoever wrote them.

    Spark lists the files; their content is not read. A folder without such files gives an empty manifest.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    path = F.regexp_replace("path", "^file:/+", "file:///")
    return files.load(folder).select(path.alias("path"), path.alias("folder"))


def read_warc(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """One row per response or revisit record of the archives that the manifest (path, folder) names.

    Archives are read one after another within a task, each as a stream. ``payload`` is added on demand. ``record_id``
    and ``refers_to_id`` are the ids without angle brackets, of any form; ``id`` and ``refers_to`` are the numbers of
    pages in ids that ``write_warc`` gave, else null. ``payload_digest`` is the hex SHA-256 of the payload; a revisit has
    it if it states one. ``digest_checked`` is false for a digest of an unknown label and null where there is nothing to
    compare. Records that repeat an id each have their row.
    """
    schema = RECORD_SCHEMA + (", payload binary" if with_payload else "")
    types = {x.split()[0]: _TYPES.get(x.split()[1], pa.string()) for x in schema.split(", ")}

    def bare(urn: str | None) -> str | None:
        return None if urn is None else urn.strip().removeprefix("<").removesuffix(">")

    def number(urn: str | None) -> int | None:
        digits = urn[len(_ID) :] if urn is not None and urn.startswith(_ID) else ""
        plain = digits.removeprefix("-")
        return int(digits) if plain.isascii() and plain.isdigit() and abs(int(digits)) < 1 << 63 else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, folder in zip(*(batch.column(c).to_pylist() for c in ("path", "folder")), strict=True):
                store, at = fs.FileSystem.from_uri(folder)
                rows, held = [], 0
                with store.open_input_stream(at if path == folder else path, compression=None) as stream:
                    for record in read_records(stream, path):
                        h = record.headers
                        if (kind := h.get("warc-type", "").lower()) not in ("response", "revisit"):
                            continue
                        size, digest, payload, stated, checked = http_payload(record, path)
                        own, refers = bare(h.get("warc-record-id")), bare(h.get("warc-refers-to"))
                        row = (path, record.offset, number(own), h.get("warc-target-uri"), kind, number(refers), size, digest)
                        row += (own, refers, h.get("warc-refers-to-target-uri"), stated, checked)
                        rows.append(row + ((payload,) if with_payload else ()))
                        held += len(payload or b"") if with_payload else 0
                        if len(rows) >= 4096 or held > 8_000_000:
                            yield _batch(rows, types)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows, types)

    # One partition per archive or so; the number is stated because adaptive execution would merge such small rows.
    parts = max(1, min(manifest.count(), 100_000))
    return manifest.select("path", "folder").repartition(parts, "path").mapInArrow(read, schema)


def _batch(rows: list[tuple], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types.values(), strict=True)], list(types))
