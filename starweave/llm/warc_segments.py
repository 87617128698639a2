"""WARC archives with segmented records: writing, and reassembly on reading.

The writer appends records to archives of gzip members. A record whose block is longer than
``segment`` bytes, or than the room left in an archive, is cut: the first piece is the record with
``WARC-Segment-Number: 1``, the others are ``continuation`` records that name its id in
``WARC-Segment-Origin-ID``, and the last carries ``WARC-Segment-Total-Length``. HTTP bodies use chunked
transfer framing. A page whose payload is that of a page with a larger id becomes a ``revisit``.

The reader parses archives in parallel, groups segments by origin id, orders them by number,
checks that none is missing and that lengths add up to the total, and undoes the framing.
One record is the largest thing in one place. Revisits get size and page of the record they refer to by a join.

Archive names carry a random part; only those of finished tasks are listed, so tasks may run again.

Defined results: null html is an empty payload; a null url has no target header; a null page id stays null.
Rows that repeat a page id are records of their own, the last in order of payload digest being the
response of equal payloads. Extra columns are ignored. A record that lacks a segment has
``complete`` false and no payload; where that is the first one, its id is known and its other fields are null.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starweave.session import scratch_path

from .common import file_system, identified, keep

SEGMENT_BYTES = 16_384
ARCHIVE_BYTES = 64_000_000
CHUNK_BYTES = 4096
REVISIT_FROM = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = []
    for at in range(0, len(payload), size):
        piece = payload[at : at + size]
        parts += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    """Undo chunked transfer framing; extensions and trailers are skipped."""
    parts, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if size == 0:
            return b"".join(parts)
        at = end + 2
        if len(body) < at + size + 2:
            raise ValueError("a chunk is cut short")
        parts.append(body[at : at + size])
        at += size + 2


def http_payload(block: bytes) -> bytes:
    head, _, body = block.partition(b"\r\n\r\n")
    framed = any(
        line.lower().startswith(b"transfer-encoding:") and b"chunked" in line.lower() for line in head.split(b"\r\n")
    )
    return unchunked(body) if framed else body


def _record(headers: dict[str, object], block: bytes) -> bytes:
    lines = [f"{name}: {value}" for name, value in headers.items() if value is not None]
    head = "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}"])
    return head.encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _urn(name: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, str(name))}>"


class _Archives:
    """Archives of one task; a record may go on in the next archive."""

    def __init__(self, folder: str, segment: int, limit: int):
        self.system, self.base = file_system(folder)
        self.segment, self.limit = segment, limit
        self.file, self.room, self.paths = None, 0, []

    def _put(self, record: bytes, block: int) -> None:
        if self.file is None:
            if not self.paths:
                self.system.create_dir(self.base, recursive=True)
            part = TaskContext.get().partitionId()
            self.paths.append(f"{self.base}/part-{part:06d}-{uuid.uuid4().hex}.warc.gz")
            self.file, self.room = self.system.open_output_stream(self.paths[-1], compression=None), self.limit
        tool = zlib.compressobj(1, zlib.DEFLATED, 31)
        self.file.write(tool.compress(record) + tool.flush())
        self.room -= block
        if self.room <= 0:
            self.close()

    def add(self, headers: dict[str, object], block: bytes) -> None:
        pieces, at = [], 0
        room = self.room if self.file is not None else self.limit
        while at < len(block) or not pieces:
            size = min(self.segment, room) if room > 0 else min(self.segment, self.limit)
            pieces.append(block[at : at + size])
            room = room - size if room > size else self.limit
            at += size
        for number, piece in enumerate(pieces, 1):
            own = dict(headers)
            if number > 1:
                own = {
                    "WARC-Type": "continuation",
                    "WARC-Record-ID": _urn(f"{headers['WARC-Record-ID']}/{number}"),
                    "WARC-Date": headers["WARC-Date"],
                    "WARC-Segment-Origin-ID": headers["WARC-Record-ID"],
                }
            if len(pieces) > 1:
                own["WARC-Segment-Number"] = number
                if number == len(pieces):
                    own["WARC-Segment-Total-Length"] = len(block)
            self._put(_record(own, piece), len(piece))

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.file = None


def write(pages: DataFrame, folder: str, segment: int = SEGMENT_BYTES, limit: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) and return the archives' paths, as a kept table."""
    pages = identified(pages, "page_id", "html", ["url"]).withColumn("text", F.coalesce("text", F.lit("")))
    pages = pages.withColumn("digest", F.sha1("text"))
    sized = pages.where(F.octet_length("text") >= REVISIT_FROM)
    groups = sized.groupBy("digest").agg(F.max("rid").alias("last"), F.count("*").alias("n")).where("n > 1")
    found = pages.join(groups.select("digest", "last"), "digest", "left")
    refers = F.when(F.col("last") != F.col("rid"), F.col("last"))
    found = found.select("rid", "doc_id", "url", "digest", refers.alias("refers"), "text")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archives = _Archives(folder, segment, limit)
        for batch in batches:
            for row in range(batch.num_rows):
                rid, page, url, digest, refers, text = (batch.column(k)[row].as_py() for k in range(6))
                url = None if url is None else url.replace("\r", "%0D").replace("\n", "%0A")
                headers = {
                    "WARC-Type": "response" if refers is None else "revisit",
                    "WARC-Record-ID": _urn(rid),
                    "WARC-Date": "2024-01-01T00:00:00Z",
                    "WARC-Target-URI": url,
                    "WARC-Payload-Digest": f"sha1:{digest}",
                    "WARC-Profile": None if refers is None else PROFILE,
                    "WARC-Refers-To": None if refers is None else _urn(refers),
                    "X-Page-Id": page,
                    "Content-Type": "application/http; msgtype=response",
                }
                archives.add(headers, HTTP if refers is not None else HTTP + chunked(text.encode()))
        archives.close()
        yield pa.RecordBatch.from_pydict({"path": pa.array(archives.paths, pa.string())})

    return keep(found.mapInArrow(emit, "path string"), "archives")


_FIELDS = "kind string, id string, origin string, number int, total long, page_id long, url string, digest string, refers string"


def _members(stream) -> Iterator[bytes]:
    """The records of an archive: the content of each gzip member."""
    tool, parts = zlib.decompressobj(31), []
    while data := stream.read(1 << 20):
        while data:
            parts.append(tool.decompress(data))
            if not tool.eof:
                break
            data = tool.unused_data
            yield b"".join(parts)
            tool, parts = zlib.decompressobj(31), []


def records(archives: DataFrame, folder: str) -> DataFrame:
    """The records of the archives at ``path``: header fields and block."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = file_system(folder)
        schema = pa.schema([(n.split()[0], _ARROW[n.split()[1]]) for n in _FIELDS.split(", ")] + [("block", pa.binary())])
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                with system.open_input_stream(path, compression=None) as stream:
                    for member in _members(stream):
                        rows.append(_parsed(member))
                        held += len(member)
                        if held > 4_000_000:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    return archives.mapInArrow(emit, f"{_FIELDS}, block binary")


_ARROW = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}


def _parsed(member: bytes) -> dict:
    head, _, rest = member.partition(b"\r\n\r\n")
    lines = [line.partition(": ") for line in head.decode().split("\r\n")[1:]]
    own = {name.lower(): value for name, _, value in lines}
    whole = lambda name: int(own[name]) if name in own else None
    return {
        "kind": own["warc-type"],
        "id": own["warc-record-id"],
        "origin": own.get("warc-segment-origin-id"),
        "number": whole("warc-segment-number"),
        "total": whole("warc-segment-total-length"),
        "page_id": whole("x-page-id"),
        "url": own.get("warc-target-uri"),
        "digest": own.get("warc-payload-digest", "").removeprefix("sha1:"),
        "refers": own.get("warc-refers-to"),
        "block": rest[: int(own["content-length"])],
    }


def reassembled(found: DataFrame) -> DataFrame:
    """One row per logical record: its fields, ``complete`` and the ordered ``blocks``."""
    fields = ["kind", "id", "page_id", "url", "digest", "refers"]
    single = found.where("number is null").select(*fields, F.lit(True).alias("complete"), F.array("block").alias("blocks"))
    pieces = found.where("number is not null").withColumn("key", F.coalesce("origin", "id"))
    first = F.when(F.col("number") == 1, F.struct(*fields))
    grouped = pieces.groupBy("key").agg(
        F.max(first).alias("head"),
        F.array_sort(F.collect_list(F.struct("number", "block"))).alias("parts"),
        F.max("total").alias("total"),
        F.sum(F.octet_length("block")).alias("length"),
    )
    numbers = F.transform("parts", lambda p: p["number"]) == F.sequence(F.lit(1), F.size("parts"))
    fits = numbers & F.coalesce(F.col("total") == F.col("length"), F.lit(False))
    # without segment 1 only the id is known
    own = [F.coalesce("head.id", "key").alias("id") if f == "id" else F.col(f"head.{f}") for f in fields]
    joined = grouped.select(*own, fits.alias("complete"), F.transform("parts", lambda p: p["block"]).alias("blocks"))
    return single.union(joined)


def read(archives: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """(page_id, url, record_type, complete, payload, payload_bytes, payload_digest, refers_to) of all pages.

    ``payload`` is null with ``payloads`` off and for revisits, whose size is that of the response.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies, sizes, digests = [], [], []
            for kind, complete, blocks, digest in zip(*(batch.column(k) for k in (0, 6, 7, 4))):
                if kind.as_py() != "response" or not complete.as_py():
                    bodies.append(None)
                    sizes.append(None)
                    digests.append(digest.as_py() if complete.as_py() else None)
                    continue
                body = http_payload(b"".join(blocks.as_py()))
                bodies.append(body if payloads else None)
                sizes.append(len(body))
                digests.append(hashlib.sha1(body).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in (0, 1, 2, 3, 5, 6)), pa.array(bodies, pa.binary()), pa.array(sizes, pa.int64()), pa.array(digests, pa.string())],
                ["kind", "id", "page_id", "url", "refers", "complete", "payload", "size", "payload_digest"],
            )

    schema = "kind string, id string, page_id long, url string, refers string, complete boolean, payload binary, size long, payload_digest string"
    rows = keep(reassembled(records(archives, folder)).mapInArrow(emit, schema), "records")
    responses = rows.where("kind = 'response'").select(
        F.col("id").alias("refers"), F.col("page_id").alias("refers_to"), F.col("size").alias("known")
    )
    return rows.join(responses, "refers", "left").select(
        "page_id", "url", F.col("kind").alias("record_type"), "complete", "payload",
        F.coalesce("size", "known").alias("payload_bytes"), "payload_digest", "refers_to",
    )


def round_trip(pages: DataFrame, payloads: bool = False) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back."""
    folder = scratch_path(pages.sparkSession, "warc")
    paths = write(pages, folder)
    return read(paths.repartition("path"), folder, payloads)
