"""WARC archives in seekable Zstandard bundles.

A task writes its records into bundles in a shared folder. Records are grouped into
independent Zstandard frames; a bundle ends with a skippable frame that holds the seek
table of the public seekable format (sizes of all frames). The index maps each record to
its bundle, frame and offset inside the frame's content, so reading one record costs one
frame. Reading everything deals frames to tasks; no file is read whole.

Of records with equal payloads of at least ``min_bytes`` bytes, the one of the smallest id
is a response and the others are revisits without payload that refer to it.

A retried task writes bundles of new names; only those of the successful attempt are in
the index, so a lost executor costs its tasks and leaves at most unread files.

Defined results: a null payload is empty; rows of one id and payload are alike (all
responses, or all revisits); a null id is never referred to and revisits the record of
the smallest id with its payload, if there is one; line breaks in addresses are written
percent-encoded; an empty table writes no bundle; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.llm.store import Store, small_batches

FRAME_BYTES = 512 << 10
BUNDLE_BYTES = 64 << 20
# Compressed frames, in all, that one task reads back.
READ_BYTES = 4 << 20
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"

# Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
FOOTER_BYTES = 9

INDEX = "page_id bigint, bundle string, frame int, frame_start bigint, frame_bytes bigint, offset bigint, length bigint"
RECORD = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def _open(path: str, mode: str):
    """A file of the shared folder, by its URI."""
    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        return open(parts.path, mode)
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    return system.open_output_stream(inner) if "w" in mode else system.open_input_file(inner)


def _make_folder(path: str) -> None:
    from pyarrow import fs

    parts = urlsplit(path)
    system, inner = (fs.LocalFileSystem(), parts.path) if parts.scheme in ("", "file") else fs.FileSystem.from_uri(path)
    system.create_dir(inner, recursive=True)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page(urn: str) -> int | None:
    number = urn.strip("<>").rpartition(":")[2]
    return None if number == "none" else int(number)


def encode_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One WARC/1.1 record. A revisit keeps the HTTP header and drops the payload."""
    address = "".join(c if c > " " else f"%{ord(c):02X}" for c in url or "about:blank")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _urn(page_id)),
        ("WARC-Date", date),
        ("WARC-Target-URI", address),
        ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"),
    ]
    if revisit:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", _urn(refers_to)),
        ]
    fields.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def decode_records(content: bytes) -> Iterator[tuple[int, dict[str, str], dict[str, str], bytes]]:
    """Offset, WARC fields, HTTP fields and payload of each record of a frame's content."""

    def fields(lines: bytes) -> dict[str, str]:
        return dict(line.split(": ", 1) for line in lines.decode().split("\r\n")[1:])

    at = 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at)
        warc = fields(content[at:end])
        start, size = end + 4, int(warc["Content-Length"])
        block = content[start : start + size]
        http, _, payload = block.partition(b"\r\n\r\n")
        yield at, warc, fields(http), payload
        at = start + size + 4


class BundleWriter:
    """One bundle file: frames of records, then the seek table."""

    def __init__(self, path: str):
        import zstandard

        self.path, self.file = path, _open(path, "wb")
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
        self.frames: list[tuple[int, int]] = []
        self.written, self.pending, self.pending_bytes = 0, [], 0

    def add(self, record: bytes) -> tuple[int, int]:
        """Frame number and offset in it."""
        place = len(self.frames), self.pending_bytes
        self.pending.append(record)
        self.pending_bytes += len(record)
        return place

    def end_frame(self) -> tuple[int, int]:
        """Start and size of the frame in the file."""
        packed = self.compressor.compress(b"".join(self.pending))
        place = self.written, len(packed)
        self.file.write(packed)
        self.frames.append((len(packed), self.pending_bytes))
        self.written += len(packed)
        self.pending, self.pending_bytes = [], 0
        return place

    def close(self) -> None:
        entries = b"".join(struct.pack("<II", *sizes) for sizes in self.frames)
        self.file.write(struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + FOOTER_BYTES) + entries)
        self.file.write(struct.pack("<IBI", len(self.frames), 0, SEEKABLE_MAGIC))
        self.file.close()


def read_seek_table(file) -> list[tuple[int, int, int]]:
    """(start, size in the file, size of the content) of every frame of a bundle."""
    size = file.seek(0, 2)
    file.seek(size - FOOTER_BYTES)
    count, flags, magic = struct.unpack("<IBI", file.read(FOOTER_BYTES))
    if magic != SEEKABLE_MAGIC or flags:
        raise ValueError("no seek table at the end of the bundle")
    file.seek(size - FOOTER_BYTES - 8 * count)
    entries = struct.iter_unpack("<II", file.read(8 * count))
    frames, start = [], 0
    for packed, content in entries:
        frames.append((start, packed, content))
        start += packed
    return frames


def read_frame(file, start: int, size: int) -> bytes:
    import zstandard

    file.seek(start)
    return zstandard.ZstdDecompressor().decompress(file.read(size))


def _write_bundles(folder: str, frame_bytes: int, bundle_bytes: int, date: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        writer: BundleWriter | None = None
        waiting: list[tuple] = []
        ready: list[tuple] = []

        def end_frame() -> None:
            start, size = writer.end_frame()
            ready.extend((key, writer.path, frame, start, size, offset, length) for key, frame, offset, length in waiting)
            waiting.clear()

        def rows() -> pa.RecordBatch:
            columns = list(zip(*ready, strict=True))
            names = [part.split()[0] for part in INDEX.split(", ")]
            kinds = (pa.int64(), pa.string(), pa.int32(), *[pa.int64()] * 4)
            ready.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            for row in batch.to_pylist():
                if writer is None:
                    name = f"part-{context.partitionId():05d}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}.warc.zst"
                    writer = BundleWriter(f"{folder}/{name}")
                record = encode_record(
                    row["page_id"], row["url"], row["payload"], row["refers_to"], row["revisit"], date
                )
                waiting.append((row["page_id"], *writer.add(record), len(record)))
                if writer.pending_bytes >= frame_bytes:
                    end_frame()
                    if writer.written >= bundle_bytes:
                        writer.close()
                        writer = None
            if ready:
                yield rows()
        if writer is not None:
            if waiting:
                end_frame()
            writer.close()
            if ready:
                yield rows()

    return write


def write_archive(
    pages: DataFrame,
    folder: str | None = None,
    min_bytes: int = 0,
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
    date: str = DATE,
) -> DataFrame:
    """Writes pages (page_id, url, html) and returns the stored index of their records."""
    small_batches(pages, 500)
    store = Store(pages, "warc")
    folder = folder or store.folder("bundles")
    _make_folder(folder)
    read = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url"), F.coalesce("html", F.lit("")).alias("html")
    ).withColumn("digest", F.sha1(F.encode("html", "utf-8")))
    # Payloads held once need no look-up, so the stored table is that of repeats only.
    repeated = (
        read.where(F.octet_length("html") >= min_bytes)
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("held"), F.min("page_id").alias("first"))
        .where("held > 1 and first is not null")
    )
    first = store.write(repeated.select("digest", "first"), "repeated")
    decided = read.join(first, "digest", "left").select(
        "page_id",
        "url",
        F.encode("html", "utf-8").alias("payload"),
        (F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))).alias("revisit"),
        F.col("first").alias("refers_to"),
    )
    return store.write(decided.mapInArrow(_write_bundles(folder, frame_bytes, bundle_bytes, date), INDEX), "index")


def _decode(content: bytes) -> Iterator[tuple]:
    for _, warc, http, payload in decode_records(content):
        digest = warc["WARC-Payload-Digest"].removeprefix("sha1:")
        revisit = warc["WARC-Type"] == "revisit"
        if not revisit and (payload_digest(payload) != digest or len(payload) != int(http["Content-Length"])):
            raise ValueError(f"the payload of {warc['WARC-Record-ID']} is not what was written")
        yield (
            _page(warc["WARC-Record-ID"]),
            int(http["Content-Length"]),
            digest,
            warc["WARC-Type"],
            _page(warc["WARC-Refers-To"]) if revisit else None,
        )


def _read_frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in RECORD.split(", ")]
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
    opened, file, table = None, None, []
    try:
        for batch in batches:
            for bundle, frame in zip(batch.column("bundle").to_pylist(), batch.column("frame").to_pylist(), strict=True):
                if bundle != opened:
                    if file is not None:
                        file.close()
                    opened, file = bundle, _open(bundle, "rb")
                    table = read_seek_table(file)
                start, size, _ = table[frame]
                columns = list(zip(*_decode(read_frame(file, start, size)), strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
    finally:
        if file is not None:
            file.close()


def read_archive(index: DataFrame, read_bytes: int = READ_BYTES) -> DataFrame:
    """Every record of the bundles that the index names, read frame by frame from the files.

    Frames are dealt to tasks by range, so a task opens each of its bundles once; there are
    as many tasks as the frames' bytes ask for.
    """
    frames = index.select("bundle", "frame", "frame_bytes").distinct()
    total = frames.agg(F.coalesce(F.sum("frame_bytes"), F.lit(0))).first()[0]
    tasks = max(1, -(-total // read_bytes))
    dealt = frames.repartitionByRange(tasks, "bundle", "frame").sortWithinPartitions("bundle", "frame")
    return dealt.select("bundle", "frame").mapInArrow(_read_frames, RECORD)


def fetch(index: DataFrame, page_ids: DataFrame) -> DataFrame:
    """page_id, url, html of chosen records: one frame is read for each, at its offset.

    A revisit gives the payload of the response it refers to.
    """

    def records(wanted: DataFrame) -> DataFrame:
        return wanted.join(index, "page_id").mapInArrow(_read_records, "page_id bigint, url string, refers_to bigint, html string")

    found = records(page_ids.select("page_id").distinct())
    origin = records(found.where("refers_to is not null").select(F.col("refers_to").alias("page_id")).distinct())
    origin = origin.select(F.col("page_id").alias("refers_to"), F.col("html").alias("_html"))
    return found.join(origin, "refers_to", "left").select("page_id", "url", F.coalesce("_html", "html").alias("html"))


def _read_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            with _open(row["bundle"], "rb") as file:
                content = read_frame(file, row["frame_start"], row["frame_bytes"])
            _, warc, _, payload = next(decode_records(content[row["offset"] : row["offset"] + row["length"]]))
            refers = _page(warc["WARC-Refers-To"]) if "WARC-Refers-To" in warc else None
            rows.append((row["page_id"], warc["WARC-Target-URI"], refers, payload.decode()))
        columns = list(zip(*rows, strict=True)) if rows else [(), (), (), ()]
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string())
        names = ["page_id", "url", "refers_to", "html"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
