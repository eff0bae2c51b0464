"""Seekable Zstandard bundles of WARC records.

Records are grouped into independent Zstandard frames; a bundle ends with the
seek table of the Zstandard seekable format (a skippable frame that lists the
sizes of all frames, and a footer).  An index maps each record to its bundle,
frame and the offset inside the frame, so one record costs one ranged read and
the decoding of one frame.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.llm.common import materialised, shuffle_partitions, small_batches

#: a frame closes at so many bytes of records, a bundle at so many of frames
#: compressed bytes that a reading task takes
TASK_BYTES = 64 << 20
FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 64 << 20
LEVEL = 6
#: fixed values of the seekable format: skippable frame, footer
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
#: pages carry no fetch time, and archives of equal pages should be equal
DATE = "1970-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "record_id string, bundle string, frame int, frame_offset long, frame_bytes long, record_offset long, record_bytes long"


def _open(uri: str, mode: str):
    from pyarrow import fs

    if "://" in uri or uri.startswith("file:"):
        store, path = fs.FileSystem.from_uri(uri)
    else:
        store, path = fs.LocalFileSystem(), uri
    if mode == "r":
        return store.open_input_file(path)
    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return store.open_output_stream(path, compression=None)  # else it compresses by the name's ending


def record_id(page_id: int | None, digest: str) -> str:
    return f"urn:page:{page_id}" if page_id is not None else f"urn:page:null:{digest}"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response record, or with ``refers_to`` a revisit without payload."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{record_id(page_id, digest)}>",
        f"WARC-Date: {DATE}",
    ]
    if url is not None:  # white space and control characters cannot stand in a header
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <{record_id(refers_to, digest)}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record at ``at``."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode("utf-8", "surrogatepass").split("\r\n")
    head = dict(x.split(": ", 1) for x in lines[1:])
    stop = end + 4 + int(head["Content-Length"])
    return head, data[end + 4 : stop], stop + 4


class _Bundle:
    """Writes one bundle; ``close`` adds the seek table."""

    def __init__(self, uri: str):
        self.uri, self.out, self.at = uri, _open(uri, "w"), 0
        self.frames: list[tuple[int, int]] = []
        self.codec = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)

    def add(self, raw: bytes) -> tuple[int, int, int]:
        packed = self.codec.compress(raw)
        place = (len(self.frames), self.at, len(packed))
        self.out.write(packed)
        self.frames.append((len(packed), len(raw)))
        self.at += len(packed)
        return place

    def close(self) -> None:
        entries = b"".join(struct.pack("<II", *f) for f in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(entries) + len(footer)) + entries + footer)
        self.out.close()


def seek_table(uri: str) -> list[tuple[int, int, int]]:
    """(offset, compressed bytes, bytes) of a bundle's frames, from its footer."""
    with _open(uri, "r") as f:
        size = f.size()
        f.seek(size - 9)
        n, flags, magic = struct.unpack("<IBI", f.read(9))
        if magic != SEEKABLE:
            raise ValueError(f"no seek table: {uri}")
        width = 12 if flags & 0x80 else 8
        f.seek(size - 9 - n * width)
        table = f.read(n * width)
    frames, at = [], 0
    for k in range(n):
        packed, raw = struct.unpack_from("<II", table, k * width)
        frames.append((at, packed, raw))
        at += packed
    return frames


def read_record(uri: str, frame_offset: int, frame_bytes: int, record_offset: int) -> tuple[dict[str, str], bytes]:
    """One record by its index entry."""
    with _open(uri, "r") as f:
        f.seek(frame_offset)
        raw = zstandard.ZstdDecompressor().decompress(f.read(frame_bytes))
    return parse(raw, record_offset)[:2]


def with_revisits(pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(page_id, url, payload, sha1, refers_to): of records with equal payloads
    of at least ``min_bytes`` that with the largest id is the response, others
    refer to it.  Rows that repeat the largest id are all responses; a null id
    is smaller than any, and payloads with null ids only are all responses."""
    base = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"),
        F.col("url"),
        F.coalesce(F.col(f"`{html_col}`").cast("binary"), F.lit(b"")).alias("payload"),
    )
    base = base.withColumn("sha1", F.sha1("payload"))
    long_enough = F.octet_length("payload") >= min_bytes
    last = base.where(long_enough).groupBy("sha1").agg(F.max("page_id").alias("last"), F.count("*").alias("k")).where("k > 1").select("sha1", "last")
    joined = base.join(last, "sha1", "left")
    return joined.select("page_id", "url", "payload", "sha1", F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last")).alias("refers_to"))


def write_bundles(records: DataFrame, out_dir: str, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Write the records of ``with_revisits`` into bundles under ``out_dir`` (a
    folder that all executors reach); returns the index, one row per record.

    A task names its bundles by partition and attempt, and the index holds what
    succeeded: bundles of lost attempts are left unnamed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        stem = f"{out_dir}/part-{context.partitionId():05d}-{context.taskAttemptId()}"
        bundle, n, frame, entries = None, 0, [], []

        def flush():
            nonlocal bundle, n, frame, entries
            if bundle is None:
                bundle, n = _Bundle(f"{stem}-{n:04d}.warc.zst"), n + 1
            k, at, size = bundle.add(b"".join(frame))
            rows = [(i, bundle.uri, k, at, size, o, b) for i, o, b in entries]
            if bundle.at >= bundle_bytes:
                bundle.close()
                bundle = None
            frame, entries = [], []
            cols = list(zip(*rows, strict=True))
            kinds = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 4]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=[x.split()[0] for x in INDEX.split(", ")])

        size = 0
        for b in batches:
            for page, url, payload, sha1, refers in zip(*[b.column(i).to_pylist() for i in range(5)], strict=True):
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                raw = record(page, url, payload, digest, refers)
                if frame and size + len(raw) > frame_bytes:
                    yield flush()
                    size = 0
                entries.append((record_id(page, digest), size, len(raw)))
                frame.append(raw)
                size += len(raw)
        if frame:
            yield flush()
        if bundle is not None:
            bundle.close()

    small_batches(records.sparkSession)
    # the index is a table, so the bundles are written once
    return materialised(records.select("page_id", "url", "payload", "sha1", "refers_to").mapInArrow(run, INDEX), "warc-index")


def archive(pages: DataFrame, out_dir: str, min_bytes: int = 0) -> DataFrame:
    """Write ``pages(page_id, url, html)`` as WARC bundles; the index.

    A null html is an empty payload; a null url leaves its header out; other
    columns are not read; an empty table gives no record.
    """
    return write_bundles(with_revisits(pages, min_bytes), f"{out_dir}/{uuid.uuid4().hex}")


def read_bundles(index: DataFrame) -> DataFrame:
    """Read the bundles that an index names: one row per record, by the frames
    of each bundle's seek table.  Payload digests of responses are recomputed
    and must agree with their headers."""
    names = index.select("bundle").distinct()

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri in b.column(0).to_pylist():
                table = seek_table(uri)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uri] * len(table), pa.string()), pa.array([x[0] for x in table], pa.int64()), pa.array([x[1] for x in table], pa.int64())],
                    names=["bundle", "offset", "size"],
                )

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = zstandard.ZstdDecompressor()
        for b in batches:
            for uri, at, size in zip(*[b.column(i).to_pylist() for i in range(3)], strict=True):
                with _open(uri, "r") as f:
                    f.seek(at)
                    raw = codec.decompress(f.read(size))
                rows, pos = [], 0
                while pos < len(raw):
                    head, block, pos = parse(raw, pos)
                    http, _, payload = block.partition(b"\r\n\r\n")
                    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    full = int(re.search(rb"Content-Length: (\d+)", http)[1])
                    if head["WARC-Type"] == "response":
                        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                        if found != digest or len(payload) != full:
                            raise ValueError(f"payload of {head['WARC-Record-ID']} does not match its digest")
                    rows.append((head["WARC-Record-ID"].strip("<>"), head.get("WARC-Target-URI"), full, digest, head["WARC-Type"], head.get("WARC-Refers-To", "").strip("<>") or None, payload))
                cols = list(zip(*rows, strict=True))
                kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["record_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])

    listed = materialised(names.mapInArrow(frames, "bundle string, offset long, size long"), "warc-frames")
    # rows of the list are small whatever they name: the frames' bytes say how many tasks read them
    size = listed.agg(F.sum("size")).first()[0] or 0
    tasks = max(shuffle_partitions(index.sparkSession), -(-size // TASK_BYTES))
    listed = listed.repartition(tasks, "bundle", "offset")
    return listed.mapInArrow(records, "record_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string, payload binary")

