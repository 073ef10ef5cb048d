"""WARC archives of single-record Zstandard frames behind a dictionary in a leading skippable frame."""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscope.llm.frames import batched, stored
from tabscope.session import scratch_path

# Fixed value: the skippable frame that announces a dictionary.
DICTIONARY_MAGIC = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILE_BYTES = 16 << 20
SAMPLE_BYTES = 2 << 20
DICTIONARY_BYTES = 64 << 10
_READ = 1 << 16


def _place(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a Hadoop-style location (``file:/x``, ``hdfs://host/x`` or a plain path)."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(
    page_id: str | None, url: str | None, payload: bytes, refers_to: str | None, date: str = "2024-01-01T00:00:00Z"
) -> bytes:
    """One WARC record: a response with its payload, or a revisit whose HTTP header still states its length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{url}')}>"),
        ("WARC-Date", date),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"),
        ("Content-Length", str(len(block))),
    ]
    if page_id is not None:
        fields.append(("X-Page-ID", page_id))
    if url is not None:
        fields.append(("WARC-Target-URI", "".join(c if c > " " else f"%{ord(c):02X}" for c in url)))
    if refers_to is not None:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("X-Refers-To-Page-ID", refers_to)]
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """Page id, type, digest, payload length, reference, URL and payload of a record; its digest is verified."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b": ")[1]) for x in http.split(b"\r\n") if x.startswith(b"Content-Length"))
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    response = fields["WARC-Type"] == "response"
    if response and (len(payload) != length or payload_digest(payload) != digest):
        raise ValueError("payload does not have its digest")
    return {
        "page_id": fields.get("X-Page-ID"), "record_type": fields["WARC-Type"], "payload_digest": digest,
        "payload_bytes": length, "refers_to": fields.get("X-Refers-To-Page-ID"), "url": fields.get("WARC-Target-URI"),
        "payload": payload if response else None,
    }


RECORD = (
    "page_id string, record_type string, payload_digest string, payload_bytes long, refers_to string, url string, "
    "payload binary"
)


def dictionary(records: list[bytes]) -> bytes:
    """A Zstandard dictionary from records spread evenly over the archive, about ``SAMPLE_BYTES`` of them."""
    step = max(1, sum(map(len, records)) // SAMPLE_BYTES)
    samples = records[::step]
    total = sum(map(len, samples))
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, total // 8 + 256), samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:  # too few or too equal records to train on: the first ones serve as raw content
        return b"".join(samples)[:DICTIONARY_BYTES].ljust(8, b" ")


def _as_dictionary(raw: bytes) -> zstandard.ZstdCompressionDict:
    trained = raw[:4] == b"\x37\xa4\x30\xec"
    return zstandard.ZstdCompressionDict(raw, zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT)


def write_archive(path: str, records: list[bytes], level: int = 3) -> None:
    raw = dictionary(records)
    compressor = zstandard.ZstdCompressor(level=level, dict_data=_as_dictionary(raw))
    system, at = _place(path)
    system.create_dir(at.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(at, compression=None) as out:
        out.write(struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw)
        for one in records:
            out.write(compressor.compress(one))


def read_archive(path: str) -> Iterator[dict]:
    """The records of an archive one by one; only the current record and a small buffer are in memory."""
    system, at = _place(path)
    with system.open_input_stream(at, compression=None) as source:
        magic, size = struct.unpack("<II", source.read(8))
        if magic != DICTIONARY_MAGIC:
            raise ValueError("the archive does not start with a dictionary")
        decompressor = zstandard.ZstdDecompressor(dict_data=_as_dictionary(source.read(size)))
        rest = source.read(_READ)
        while rest:
            frame = decompressor.decompressobj()
            out = [frame.decompress(rest)]
            while not frame.eof:
                more = source.read(_READ)
                if not more:
                    raise ValueError("the archive ends within a record")
                out.append(frame.decompress(more))
            yield parse(b"".join(out))
            rest = frame.unused_data or source.read(_READ)


def write_archives(pages: DataFrame, folder: str, least: int = 0, id_col: str = "page_id") -> DataFrame:
    """Write a record per row of ``pages`` (id, ``url``, ``html``) below ``folder``; returns ``path``, ``records``.

    Of rows with equal payloads of at least ``least`` bytes that with the smallest id is a response and the others
    revisit it; rows with that id and payload are all responses. Null html is an empty payload, a null id never
    is the smallest (payloads that only occur with null ids are all responses). Only digests are grouped; pages
    are dealt by id, so that copies do not meet in one task. Files hold about ``FILE_BYTES`` of records, with a
    dictionary of their own. Files of lost task attempts are not in the returned table.
    """
    rows = pages.select(
        F.col(id_col).alias("id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"),
    )
    rows = rows.withColumn("digest", F.sha1("payload"))
    keys = rows.where(F.octet_length("payload") >= least).select("id", "digest")
    first = keys.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    revisits = keys.join(first.select("digest", "first"), "digest").where("first IS NOT NULL AND NOT (id <=> first)")
    revisits = revisits.distinct().select(F.col("id").alias("r_id"), F.col("digest").alias("r_digest"), "first")
    rows = rows.join(revisits, F.expr("id <=> r_id AND digest = r_digest"), "left").select(
        F.col("id").cast("string"), "url", "payload", F.col("first").cast("string")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
            write_archive(path, held)
            return pa.RecordBatch.from_pydict({"path": [path], "records": [len(held)]})

        for batch in batches:
            for row in batch.to_pylist():
                held.append(record(row["id"], row["url"], row["payload"], row["first"]))
                size += len(held[-1])
                if size >= FILE_BYTES:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return stored(batched(rows).mapInArrow(run, "path string, records long"), "archives")


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of all archives in column ``path``; without their bodies if ``payloads`` is false."""
    schema = RECORD if payloads else RECORD.removesuffix(", payload binary")
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([(n, pa.int64() if n == "payload_bytes" else pa.binary() if n == "payload" else pa.string()) for n in names])
        for batch in batches:
            for path in batch.column("path").to_pylist():
                held: list[dict] = []
                size = 0
                for found in read_archive(path):
                    held.append({n: found[n] for n in names})
                    size += 100 + (found["payload_bytes"] if payloads else 0)
                    if size >= 1 << 21:
                        yield pa.RecordBatch.from_pylist(held, kind)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, kind)

    spread = archives.select("path").repartition(max(1, archives.count()))
    return spread.mapInArrow(run, schema)
