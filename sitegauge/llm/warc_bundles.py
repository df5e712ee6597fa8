"""WARC records in seekable Zstandard bundles.

Records are grouped into frames that are compressed each on its own; a bundle is a file of frames that ends with a seek
table (a skippable frame with the sizes of all frames).  Any Zstandard reader gets the plain WARC file, and a reader that
knows the seek table decompresses single frames.  The index maps each record identifier to bundle, frame, and offset
inside the frame.  Records whose payload another record already carries are written as revisits without it.

Tasks write to new files of their own.  Files count only if the index names them, and Spark writes the index of
those attempts alone that it accepts: what lost tasks leave behind is never read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegauge.llm.common import shared_dir, staged, whole_text
from sitegauge.operators.joins import lookup_join

#: Payloads below this size are stored again; bytes of records in a frame, of frames in a bundle; compression level.
LEAST_SHARED, FRAME, BUNDLE, LEVEL = 1_000, 1 << 20, 1 << 30, 3
#: Bytes of records that one task reads back, about.
READ = 256 << 20
CAPTURED = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = ("record_id string, bundle string, frame int, offset bigint, length bigint, record_type string")
RECORDS = ("record_id string, bundle string, frame int, offset bigint, record_type string, page_id bigint, url string, "
           "payload_bytes bigint, payload_digest string, refers_to bigint, payload binary")
# fixed values of the format
_TABLE_MAGIC, _FOOTER_MAGIC, _FOOTER = 0x184D2A5E, 0x8F92EAB1, struct.Struct("<IBI")
_ENTRY, _HEAD = struct.Struct("<II"), struct.Struct("<II")
_BREAK = re.compile(r"[\x00-\x20\x7f]+")


# records

def record_id(page_id: int | None, digest: str) -> str:
    return f"urn:page:{'' if page_id is None else page_id}:{digest}"


def page_of(identifier: str) -> int | None:
    number = identifier.split(":")[2]
    return int(number) if number else None


def _sha1(digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, captured: str = CAPTURED) -> bytes:
    """One WARC record; with `refers_to` a revisit, which keeps the response's HTTP header but not its body."""
    revisit = refers_to is not None
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block += b"" if revisit else payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<{record_id(page_id, digest)}>"), ("WARC-Date", captured)]
    if url:
        fields.append(("WARC-Target-URI", _BREAK.sub(lambda m: "".join(f"%{ord(c):02X}" for c in m[0]), url)))
    fields.append(("WARC-Payload-Digest", _sha1(digest)))
    if revisit:
        fields += [("WARC-Refers-To", f"<{record_id(refers_to, digest)}>"), ("WARC-Profile", PROFILE)]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode() + block + b"\r\n\r\n"


def _fields(raw: bytes, at: int, first: bytes) -> tuple[dict[str, str], int]:
    """Header fields by lower-case name, and where the header ends."""
    end = raw.index(b"\r\n\r\n", at)
    lines = raw[at:end].split(b"\r\n")
    if not lines[0].startswith(first):
        raise ValueError(f"no {first.decode()} header at {at}")
    return {k.strip().lower().decode(): v.strip().decode() for k, v in (line.split(b":", 1) for line in lines[1:])}, end + 4


def parse(raw: bytes) -> Iterator[tuple[int, dict[str, str], dict[str, str], bytes]]:
    """(offset, WARC fields, HTTP fields, HTTP body) of the records of a frame."""
    at = 0
    while at < len(raw):
        warc, start = _fields(raw, at, b"WARC/")
        end = start + int(warc["content-length"])
        http, body = _fields(raw, start, b"HTTP/")
        yield at, warc, http, raw[body:end]
        if raw[end:end + 4] != b"\r\n\r\n":
            raise ValueError(f"record at {at} does not end where its length says")
        at = end + 4


# bundles

class BundleWriter:
    """One open bundle: frames as they come, then the seek table."""

    def __init__(self, stream, level: int = LEVEL):
        import zstandard

        self.stream, self.compressor = stream, zstandard.ZstdCompressor(level=level)
        self.sizes: list[tuple[int, int]] = []
        self.written = 0

    def frame(self, raw: bytes) -> None:
        packed = self.compressor.compress(raw)
        self.stream.write(packed)
        self.sizes.append((len(packed), len(raw)))
        self.written += len(packed)

    def close(self) -> None:
        entries = b"".join(_ENTRY.pack(*s) for s in self.sizes)
        self.stream.write(_HEAD.pack(_TABLE_MAGIC, len(entries) + _FOOTER.size) + entries + _FOOTER.pack(len(self.sizes), 0, _FOOTER_MAGIC))
        self.stream.close()


class BundleReader:
    """Reads single frames of a bundle through its seek table."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        file.seek(size - _FOOTER.size)
        frames, flags, magic = _FOOTER.unpack(file.read(_FOOTER.size))
        if magic != _FOOTER_MAGIC:
            raise ValueError("no seek table")
        width = _ENTRY.size + (4 if flags & 0x80 else 0)  # entries may carry a checksum
        table = frames * width + _FOOTER.size
        file.seek(size - table - _HEAD.size)
        if _HEAD.unpack(file.read(_HEAD.size)) != (_TABLE_MAGIC, table):
            raise ValueError("broken seek table")
        entries = file.read(frames * width)
        self.sizes = [_ENTRY.unpack_from(entries, k * width) for k in range(frames)]
        self.starts = [0]
        for packed, _ in self.sizes:
            self.starts.append(self.starts[-1] + packed)

    def frame(self, number: int) -> bytes:
        import zstandard

        packed, plain = self.sizes[number]
        self.file.seek(self.starts[number])
        raw = zstandard.ZstdDecompressor().decompress(self.file.read(packed), max_output_size=plain)
        if len(raw) != plain:
            raise ValueError(f"frame {number} has {len(raw)} bytes, the seek table says {plain}")
        return raw


def _folder(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of any address that Arrow knows: local, HDFS, S3 and the like."""
    return fs.FileSystem.from_uri(path) if re.match(r"[a-z][a-z0-9+.-]*:", path) else (fs.LocalFileSystem(), path)


# the job

@dataclass
class Archive:
    """Where the bundles lie, and the index: one row per record."""

    folder: str
    index: DataFrame


def _digests(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest, size and a second hash: payloads are told apart by all three."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), whole_text("html").alias("payload"))
    return rows.withColumns({
        "digest": F.sha1(F.col("payload").cast("binary")), "size": F.octet_length("payload").cast("long"), "hash": F.xxhash64("payload")})


def with_verdict(pages: DataFrame, least: int = LEAST_SHARED) -> DataFrame:
    """page_id, url, payload, digest and refers_to: the largest id with an equal payload, null where the row keeps its own."""
    rows = _digests(pages)
    same = ["digest", "size", "hash"]
    shared = (rows.where(F.col("size") >= least).groupBy(*same).agg(F.max("page_id").alias("largest"), F.count("*").alias("n"))
              .where((F.col("n") > 1) & F.col("largest").isNotNull()).select(*same, "largest"))
    shared = staged(shared, "warc-shared")  # its size is known to the planner then
    joined = lookup_join(rows, shared, same, "left", spread=["page_id"])
    return joined.select("page_id", "url", "payload", "digest", F.when(~F.col("largest").eqNullSafe(F.col("page_id")), F.col("largest")).alias("refers_to"))


def write_archive(pages: DataFrame, folder: str | None = None, frame: int = FRAME, bundle: int = BUNDLE, level: int = LEVEL, captured: str = CAPTURED) -> Archive:
    """One WARC record per row of `pages` (page_id, url, html), in new bundles below `folder`.

    A null html is an empty payload, a null url leaves out the record's address.  Of rows with equal payloads of at least
    1000 bytes, that with the largest page_id is a response, the others revisit it; rows that share that id are responses
    each; rows without an id revisit, but none is revisited.  Repeated rows are records of their own under one identifier, and the
    index lists each of their places.  An empty table gives no bundles and an empty index; other columns are ignored.
    """
    spark = pages.sparkSession
    folder = folder or f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, path = _folder(folder)
        context = TaskContext.get()
        writer, name, files, held, size, index = None, "", 0, [], 0, []

        def flush():
            nonlocal writer, name, files, held, size
            if writer is None:
                target.create_dir(path, recursive=True)
                name = f"bundle-{context.partitionId():06d}-{files:04d}-{uuid.uuid4().hex}.warc.zst"
                writer, files = BundleWriter(target.open_output_stream(f"{path}/{name}", compression=None), level), files + 1
            at = 0
            for identifier, kind, raw in held:
                index.append((identifier, name, len(writer.sizes), at, len(raw), kind))
                at += len(raw)
            writer.frame(b"".join(h[2] for h in held))
            held, size = [], 0
            if writer.written >= bundle:
                writer.close()
                writer = None

        def rows():
            columns = list(zip(*index, strict=True)) or [()] * 6
            index.clear()
            kinds = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=[c.split()[0] for c in INDEX.split(", ")])

        for batch in batches:
            for page_id, url, payload, digest, refers_to in zip(*batch.columns, strict=True):
                page_id, refers_to, digest = page_id.as_py(), refers_to.as_py(), digest.as_py()
                raw = record(page_id, url.as_py(), payload.as_py().encode("utf-8"), digest, refers_to, captured)
                if held and size + len(raw) > frame:
                    flush()
                held.append((record_id(page_id, digest), "response" if refers_to is None else "revisit", raw))
                size += len(raw)
            if len(index) > 50_000:
                yield rows()
        if held:
            flush()
        if writer is not None:
            writer.close()
        yield rows()

    return Archive(folder, staged(with_verdict(pages).mapInArrow(write, INDEX), "warc-index"))


def read_frames(archive: Archive, wanted: DataFrame, payloads: bool = True) -> DataFrame:
    """All records of the frames `wanted` (bundle, frame), read from the bundles: the columns RECORDS.

    Only those frames are read and decompressed.  Payloads are digested anew; a digest that differs from the record's is an error.
    A revisit's size comes from the HTTP header that it keeps, its payload is null.
    """
    spark = wanted.sparkSession
    folder = archive.folder
    # a row here stands for a frame of data, so the number of tasks comes from frames, not from the bytes of these rows
    frames = staged(wanted.groupBy("bundle", "frame").agg(F.sum("length").alias("length")), "warc-frames")
    total = frames.agg(F.sum("length")).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // READ))
    frames = frames.repartition(tasks, "bundle", "frame").sortWithinPartitions("bundle", "frame")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, path = _folder(folder)
        opened, reader = None, None
        names, kinds = zip(*(c.split() for c in RECORDS.split(", ")), strict=True)
        types = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
        for batch in batches:
            for name, number in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if name != opened:
                    opened, reader = name, BundleReader(source.open_input_file(f"{path}/{name}"))
                found = [(_opened(warc, http, body, payloads, name, number, at)) for at, warc, http, body in parse(reader.frame(number))]
                columns = list(zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, types[k]) for c, k in zip(columns, kinds, strict=True)], names=list(names))

    return frames.select("bundle", "frame").mapInArrow(read, RECORDS)


def _opened(warc: dict, http: dict, body: bytes, payloads: bool, bundle: str, frame: int, at: int) -> tuple:
    identifier = warc["warc-record-id"].strip("<>")
    digest = base64.b32decode(warc["warc-payload-digest"].removeprefix("sha1:")).hex()
    response = warc["warc-type"] == "response"
    if response and hashlib.sha1(body).hexdigest() != digest:
        raise ValueError(f"payload of {identifier} is broken")
    refers = warc.get("warc-refers-to")
    return (identifier, bundle, frame, at, warc["warc-type"], page_of(identifier), warc.get("warc-target-uri"),
            len(body) if response else int(http["content-length"]), digest,
            page_of(refers.strip("<>")) if refers else None, body if response and payloads else None)


def read_archive(archive: Archive, payloads: bool = False) -> DataFrame:
    """Every record of the archive."""
    return read_frames(archive, archive.index, payloads)


def find_records(archive: Archive, identifiers: DataFrame) -> DataFrame:
    """The records whose identifiers are in the column record_id of `identifiers`, by their places in the index.

    Unknown and null identifiers have no row, repeated ones count once.
    """
    ids = identifiers.select("record_id").distinct()
    places = staged(archive.index.join(ids, "record_id", "left_semi"), "warc-places")
    key = ["bundle", "frame", "offset"]
    return read_frames(archive, places).join(places.select(*key), key, "left_semi")


def pages_of(archive: Archive) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record, as read back from the bundles."""
    return read_archive(archive).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
q AS (SELECT page_id, strlen(payload) AS n, sha1(payload) AS digest, max(page_id) OVER (PARTITION BY payload) AS largest FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
    CASE WHEN n >= {LEAST_SHARED} AND largest <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN n >= {LEAST_SHARED} AND largest <> page_id THEN largest END AS refers_to FROM q
"""
