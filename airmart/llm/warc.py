"""WARC archives as seekable Zstandard bundles.

`write_archive` writes one record per page: of pages with equal payloads the one
with the smallest id is a response, the others are revisits that refer to it.
Each task packs its records into bundles of bounded size. In a bundle, groups of
records are independent Zstandard frames, and a last skippable frame holds the
seek table of the public seekable format (compressed and plain size of each
frame). The returned index maps each record to bundle, frame, the frame's offset
and the record's offset within the plain frame. `read_archive` opens the bundles
by their footers and parses the records again; `read_records` fetches single
records by their index rows.

Payloads are compressed before the shuffle that brings them to their response's
id, so it moves about as much as the archive holds. Bundles are named by task
attempt: what a lost task left is in no index. The index is written before it
is returned, so that later reads never write bundles anew.

A null payload is empty. Pages without an id take part: they revisit a page
that has one, or else are responses. Repeated rows with the smallest id are all
responses, as they are one record. A null url leaves the target out; line
breaks and blanks in it are percent-encoded. Extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from airmart.session import materialize, scratch_path

FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 64 << 20
LEVEL = 6
DATE = "2024-01-01T00:00:00Z"
# Fixed values of the seekable format and of the revisit profile.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_IDS = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

INDEX = "record_id string, page_id {id}, bundle string, frame long, frame_offset long, frame_bytes long, record_offset long, record_bytes long"
RECORDS = "page_id {id}, url string, record_id string, record_type string, payload_bytes long, payload_digest string, refers_to {id}, payload binary"


def record_id(page_id: int | None, digest: str) -> str:
    return f"urn:uuid:{uuid.uuid5(_IDS, f'{page_id}/{digest}')}"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def make_record(page_id, url, payload: bytes, refers_to) -> tuple[str, bytes]:
    """Identifier and bytes of a record; a revisit if refers_to is given."""
    digest = base32_sha1(payload)
    own = record_id(page_id, digest)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{own}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c > " " else "".join(f"%{b:02X}" for b in c.encode()) for c in url))
    if page_id is not None:
        lines.append(f"Page-ID: {page_id}")
    lines += [f"WARC-Payload-Digest: sha1:{digest}", f"Payload-Length: {len(payload)}"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{record_id(refers_to, digest)}>", f"Refers-To-Page: {refers_to}", f"WARC-Profile: {PROFILE}"]
    block = head if refers_to is not None else head + payload
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return own, "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower case names) and block of each record of a plain frame."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no record begins at {at}")
        headers = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines)}
        begin, size = end + 4, int(headers["content-length"])
        if data[begin + size : begin + size + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at {at} is cut")
        yield headers, data[begin : begin + size]
        at = begin + size + 4


class BundleWriter:
    """Packs records into frames, and frames into bundles with a seek table."""

    def __init__(self, folder: str, name: str, frame_bytes: int, bundle_bytes: int):
        import zstandard

        self.folder = folder.rstrip("/")
        self.store, self.path = store_of(self.folder)
        self.store.create_dir(self.path, recursive=True)
        self.name, self.frame_bytes, self.bundle_bytes = name, frame_bytes, bundle_bytes
        self.press = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
        self.number, self.out, self.held, self.size = 0, None, [], 0

    def add(self, page_id, own: str, record: bytes) -> list[tuple]:
        """Index rows of a frame, when this record filled one."""
        self.held.append((own, page_id, self.size, len(record), record))
        self.size += len(record)
        return self.flush() if self.size >= self.frame_bytes else []

    def flush(self) -> list[tuple]:
        if not self.held:
            return []
        if self.out is None:
            name = f"{self.name}-{self.number:05d}.warc.zst"
            self.file = f"{self.folder}/{name}"
            self.out, self.table, self.offset = self.store.open_output_stream(f"{self.path}/{name}", compression=None), [], 0
            self.number += 1
        frame = self.press.compress(b"".join(r for *_, r in self.held))
        self.out.write(frame)
        rows = [(own, page, self.file, len(self.table), self.offset, len(frame), at, n) for own, page, at, n, _ in self.held]
        self.table.append((len(frame), self.size))
        self.offset += len(frame)
        self.held, self.size = [], 0
        if self.offset >= self.bundle_bytes:
            self.close()
        return rows

    def close(self) -> None:
        if self.out is not None:
            table = b"".join(struct.pack("<II", *x) for x in self.table) + struct.pack("<IBI", len(self.table), 0, SEEKABLE)
            self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
            self.out.close()
            self.out = None


def seek_table(file) -> list[tuple[int, int, int]]:
    """Offset, compressed and plain size of each frame, from the footer of an open bundle."""
    size = file.size()
    file.seek(size - 9)
    n, flags, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE or flags:
        raise ValueError("no seek table without checksums at the end")
    file.seek(size - 9 - 8 * n)
    found, at = [], 0
    for packed, plain in struct.iter_unpack("<II", file.read(8 * n)):
        found.append((at, packed, plain))
        at += packed
    return found


def write_archive(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    min_revisit_bytes: int = 0, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES,
) -> DataFrame:
    """Writes the bundles below `folder` (a path or URI that all executors reach) and returns the index of records."""
    import zstandard

    html = F.coalesce(F.col(html_col), F.lit(""))
    own = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), html.alias("html"))
    keyed = own.withColumns({"payload_bytes": F.octet_length("html").cast("long"), "payload_key": F.sha2("html", 256)})
    heads = keyed.where(F.col("payload_bytes") >= min_revisit_bytes).groupBy("payload_key", "payload_bytes").agg(F.min("page_id").alias("head"))

    @F.arrow_udf("binary")
    def packed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            yield pa.array([press.compress(t.encode()) for t in batch.to_pylist()], pa.binary())

    joined = keyed.select("page_id", "url", "payload_bytes", "payload_key", packed("html").alias("packed")).join(heads, ["payload_key", "payload_bytes"], "left")
    index = INDEX.format(id=pages.schema[id_col].dataType.simpleString())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, unpack = TaskContext.get(), zstandard.ZstdDecompressor()
        bundle = BundleWriter(folder, f"part-{task.partitionId():06d}-{task.taskAttemptId()}", frame_bytes, bundle_bytes)
        for batch in batches:
            rows = []
            for page, url, data, head in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "packed", "head"))):
                rows += bundle.add(page, *make_record(page, url, unpack.decompress(data), None if page == head else head))
            yield from as_batch(rows)
        yield from as_batch(bundle.flush())
        bundle.close()

    def as_batch(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(list(c)) if i != 1 else pa.array(list(c), kind) for i, c in enumerate(zip(*rows))], names)

    names = [x.split()[0] for x in index.split(", ")]
    kind = to_arrow(pages, id_col)
    return materialize(joined.mapInArrow(write, index), "warc-index")


def to_arrow(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)


def read_archive(index: DataFrame, with_payload: bool = False) -> DataFrame:
    """All records of the bundles that the index names, parsed from the bundles themselves."""
    kind = to_arrow(index, "page_id")
    schema = RECORDS.format(id=index.schema["page_id"].dataType.simpleString())
    bundles = index.select("bundle").distinct()
    # As many tasks as bundles, up to four for each partition of the session: the few bytes of their names say nothing of what is read.
    most = 4 * int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bundles = bundles.repartition(max(1, min(most, bundles.count())))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for path in batch.column("bundle").to_pylist():
                with open_uri(path) as file:
                    for at, size, plain in seek_table(file):
                        file.seek(at)
                        data = unpack.decompress(file.read(size), max_output_size=plain)
                        yield records_batch(data, kind, with_payload)

    return bundles.mapInArrow(read, schema)


def read_records(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of the given index rows, each by its offset; other frames are not read."""
    kind = to_arrow(index, "page_id")
    schema = RECORDS.format(id=index.schema["page_id"].dataType.simpleString())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for row in batch.to_pylist():
                with open_uri(row["bundle"]) as file:
                    file.seek(row["frame_offset"])
                    data = unpack.decompress(file.read(row["frame_bytes"]))
                yield records_batch(data[row["record_offset"] : row["record_offset"] + row["record_bytes"]], kind, with_payload)

    return index.mapInArrow(read, schema)


def store_of(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = f"file://{uri[5:]}"
    return fs.FileSystem.from_uri(uri)


def open_uri(uri: str):
    store, path = store_of(uri)
    return store.open_input_file(path)


def records_batch(data: bytes, kind: pa.DataType, with_payload: bool) -> pa.RecordBatch:
    rows = []
    for h, block in parse_records(data):
        payload = block[block.index(b"\r\n\r\n") + 4 :]
        digest = h["warc-payload-digest"].removeprefix("sha1:")
        if h["warc-type"] == "response" and base32_sha1(payload) != digest:
            raise ValueError(f"payload of {h['warc-record-id']} does not have its digest")
        rows.append((
            h.get("page-id"), h.get("warc-target-uri"), h["warc-record-id"][1:-1], h["warc-type"], int(h["payload-length"]), digest,
            h.get("refers-to-page"), payload if with_payload and h["warc-type"] == "response" else None,
        ))
    page, url, own, sort, size, digest, refers, payload = zip(*rows)
    as_id = lambda x: pa.array(x, pa.string()).cast(kind)
    return pa.RecordBatch.from_arrays(
        [as_id(page), pa.array(url, pa.string()), pa.array(own), pa.array(sort), pa.array(size, pa.int64()), pa.array(digest), as_id(refers), pa.array(payload, pa.binary())],
        ["page_id", "url", "record_id", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"],
    )


def archive_folder(spark) -> str:
    """A new folder for bundles below the shared scratch folder."""
    return scratch_path(spark, "warc")
