"""WARC archives in Zstandard: a dictionary in a leading skippable frame, one frame a record, checked on reading."""

from __future__ import annotations

import base64
import hashlib
import io
import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, cut, sized

#: The skippable frame that holds the dictionary, as the format's public description fixes it.
DICT_MAGIC = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class WarcParams:
    """Archives are closed at ``archive_bytes``, so that a reader holds no more than that at a time; payloads of at least
    ``least_revisit`` bytes are written once. ``date`` stamps every record, which makes a repeated task write the same."""

    level: int = 3
    dict_bytes: int = 64 * 1024
    dict_samples: int = 256
    sample_bytes: int = 16 * 1024
    archive_bytes: int = 32 << 20
    least_revisit: int = 1000
    date: str = "2024-01-01T00:00:00Z"


class WarcError(ValueError):
    """An archive that breaks the format."""


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes
    http: dict[str, str] = field(default_factory=dict)
    payload: bytes = b""


def _clean(value: str) -> str:
    return " ".join(value.split())


def record_id(page_id: int | None) -> str:
    return f"<urn:tessera:page:{'none' if page_id is None else page_id}>"


def page_of(urn: str) -> int | None:
    last = urn.strip("<>").rpartition(":")[2]
    return None if last == "none" else int(last)


def sha1_header(payload: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()


def sha1_hex(header: str) -> str:
    """Hex of a ``sha1:`` digest header in base 32 or hex."""
    name, _, value = header.partition(":")
    if name.lower() != "sha1" or len(value) not in (32, 40):
        raise WarcError(f"unknown digest {header!r}")
    return base64.b32decode(value.upper()).hex() if len(value) == 32 else value.lower()


def encode_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """A response record, or a revisit record, which has the HTTP header of the payload but not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {date}"]
    if url and url.strip():
        lines.append(f"WARC-Target-URI: {_clean(url)}")
    lines.append(f"WARC-Payload-Digest: {sha1_header(payload)}")
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(lines: list[bytes]) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise WarcError(f"bad header line {line[:60]!r}")
        out[name.strip().decode("ascii").lower()] = value.strip().decode("utf-8", "replace")
    return out


def decode_record(raw: bytes) -> Record:
    """Parses and validates one record: version, mandatory headers, block length, trailer, HTTP length, payload digest."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if not gap or not version.startswith(b"WARC/1."):
        raise WarcError(f"not a WARC record: {raw[:40]!r}")
    headers = _headers(lines)
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise WarcError(f"no {name} header")
    length = int(headers["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise WarcError(f"content-length {length}, but {len(rest) - 4} bytes before the trailer")
    record = Record(headers, rest[:length])
    if headers["warc-type"] in ("response", "revisit"):
        http, gap, record.payload = record.block.partition(b"\r\n\r\n")
        status, *lines = http.split(b"\r\n")
        if not gap or not status.startswith(b"HTTP/"):
            raise WarcError("no HTTP header in the block")
        record.http = _headers(lines)
        if headers["warc-type"] == "response":
            if int(record.http.get("content-length", len(record.payload))) != len(record.payload):
                raise WarcError("the payload has another length than its HTTP header says")
            if "warc-payload-digest" in headers and sha1_hex(headers["warc-payload-digest"]) != hashlib.sha1(record.payload).hexdigest():
                raise WarcError("the payload has another digest than its header says")
        elif "warc-refers-to" not in headers:
            raise WarcError("a revisit that refers to nothing")
    return record


def train_dictionary(samples: list[bytes], size: int) -> bytes:
    """A Zstandard dictionary; the last of the samples as raw content where they are too few or too small to train one."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


class ArchiveWriter:
    """Writes one archive to a binary stream."""

    def __init__(self, stream, dictionary: bytes, level: int):
        import zstandard

        self.stream = stream
        held = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.packer = zstandard.ZstdCompressor(level=level, dict_data=held, write_checksum=True)
        stored = zstandard.ZstdCompressor(level=level).compress(dictionary)
        self.size = stream.write(struct.pack("<II", DICT_MAGIC, len(stored)) + stored)

    def write(self, record: bytes) -> None:
        self.size += self.stream.write(self.packer.compress(record))


def read_archive(data: bytes) -> Iterator[Record]:
    """The records of an archive. A frame that is cut short, holds no single record or fails its checksum raises."""
    import zstandard

    view, at, dictionary = memoryview(data), 0, None
    if len(view) >= 8 and struct.unpack_from("<I", view)[0] == DICT_MAGIC:
        at = 8 + struct.unpack_from("<I", view, 4)[0]
        if at > len(view):
            raise WarcError("the dictionary frame is cut short")
        dictionary = bytes(view[8:at])
        if dictionary.startswith(ZSTD_MAGIC):
            dictionary = zstandard.ZstdDecompressor().decompress(dictionary)
    unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    while at < len(view):
        if bytes(view[at : at + 4]) != ZSTD_MAGIC:
            if len(view) - at >= 8 and struct.unpack_from("<I", view, at)[0] & 0xFFFFFFF0 == 0x184D2A50:
                at += 8 + struct.unpack_from("<I", view, at + 4)[0]  # another skippable frame
                continue
            raise WarcError(f"no frame at byte {at}")
        frame, out = unpacker.decompressobj(), io.BytesIO()
        while not frame.eof:
            chunk = view[at : at + 16384]
            if not len(chunk):
                raise WarcError("the last frame is cut short")
            try:
                out.write(frame.decompress(chunk))
            except zstandard.ZstdError as e:
                raise WarcError(f"damaged frame: {e}") from e
            at += len(chunk)
        at -= len(frame.unused_data)
        yield decode_record(out.getvalue())


def _filesystem(uri: str):
    """An Arrow file system and the path in it; a path without a scheme is local or mounted everywhere."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if ":/" in uri else (fs.LocalFileSystem(), uri)


def write_archives(pages: DataFrame, uri: str, params: WarcParams = WarcParams()) -> int:
    """Writes ``pages(page_id, url, html)`` to archives under ``uri``, a folder all executors reach; returns the records.

    Each task writes archives of its own, under a name that its partition fixes, and renames each when it is complete:
    a task that runs again replaces them by the same bytes, and a reader never sees half of one.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("large", F.octet_length("payload") >= params.least_revisit)
    copies = cut(rows.where("large").groupBy("digest").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first"))
    rows = rows.join(sized(copies), "digest", "left").select("page_id", "url", "payload", F.when(F.col("large"), F.col("first")).alias("first"))

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        files, root = _filesystem(uri)
        files.create_dir(root, recursive=True)
        context = TaskContext.get()
        pending: list[bytes] = []
        state: dict = {"writer": None, "n": 0, "records": 0}

        def opened() -> ArchiveWriter:
            name = f"{root}/part-{context.partitionId():06d}-{state['n']:04d}.warc.zst"
            state["names"] = (f"{root}/.{os.path.basename(name)}.{context.taskAttemptId()}", name)
            dictionary = train_dictionary([p[: params.sample_bytes] for p in pending], params.dict_bytes)
            state["writer"] = ArchiveWriter(files.open_output_stream(state["names"][0]), dictionary, params.level)
            return state["writer"]

        def flush(end: bool) -> None:
            writer = state["writer"] or opened()
            for record in pending:
                writer.write(record)
            pending.clear()
            if end or writer.size >= params.archive_bytes:
                writer.stream.close()
                files.move(*state["names"])
                state["writer"], state["n"] = None, state["n"] + 1

        for batch in batches:
            for page_id, url, payload, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                pending.append(encode_record(page_id, url, payload, first, first is not None and first != page_id, params.date))
                state["records"] += 1
                if len(pending) >= params.dict_samples or state["writer"]:
                    flush(False)
        if pending or state["writer"]:
            flush(True)
        yield pa.RecordBatch.from_arrays([pa.array([state["records"]], pa.int64())], ["records"])

    return rows.mapInArrow(run, "records long").agg(F.sum("records")).first()[0] or 0


def read_archives(spark: SparkSession, uri: str) -> DataFrame:
    """``page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload`` of every record under ``uri``.

    Spark lists and reads the files; each is at most ``archive_bytes`` and a record long. The payload of a revisit is null.
    """

    def run(batches):
        import pyarrow as pa

        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])
        for batch in batches:
            for data in batch.column(0):
                rows, held = [], 0
                for r in read_archive(data.as_py()):
                    revisit = r.headers["warc-type"] == "revisit"
                    refers = page_of(r.headers["warc-refers-to"]) if revisit else None
                    rows.append((page_of(r.headers["warc-record-id"]), r.headers.get("warc-target-uri"), r.headers["warc-type"], refers, int(r.http["content-length"]), sha1_hex(r.headers["warc-payload-digest"]), None if revisit else r.payload))
                    held += len(r.payload)
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(uri)
    return files.select("content").mapInArrow(run, "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary")


def round_trip(pages: DataFrame, params: WarcParams = WarcParams()) -> DataFrame:
    """Writes ``pages(page_id, url, html)`` as archives, reads them back, and returns what the records say.

    ``page_id, payload_bytes, payload_digest, record_type, refers_to`` per row. Null html is an empty payload, null url a
    record without target. Of equal payloads of ``least_revisit`` bytes and more, rows of the largest page_id are
    responses and the others revisit it; rows of a null page_id revisit too, unless no row has one. An empty table gives
    no rows.
    """
    with Scratch(pages.sparkSession, "warc") as scratch:
        uri = f"{scratch.root}/archives"
        wrote = write_archives(pages, uri, params)
        if not wrote:
            return pages.sparkSession.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
        out = cut(read_archives(pages.sparkSession, uri).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
        read = out.count()
        if read != wrote:
            raise WarcError(f"wrote {wrote} records and read {read}")
        return out
