"""WARC records in seekable Zstandard bundles.

A bundle is a sequence of independent Zstandard frames, each of whole records, and a last, skippable frame that holds the
seek table: compressed and decompressed size of every frame. An index maps each record to its frame and its offset within
it, so one record is read by one seek and one frame. Bundles are rows of a table (`data` is a whole .warc.zst file), so
any file system that Spark writes to serves.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainloom.llm.common import stored as stored_table

#: Decompressed bytes after which a frame is closed, and compressed bytes after which a bundle is.
FRAME, BUNDLE = 256 << 10, 8 << 20
#: Payloads shorter than this are never revisits.
LEAST = 1000
#: Fixed values of the seekable format: the skippable frame's and the table's magic numbers.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
LEVEL = 3
#: Payloads that come twice, up to this number, are broadcast (about 60 bytes each); more are joined by a shuffle.
FEW_PAYLOADS = 200_000
DATE = "1970-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record(page_id: str, url: str, payload: bytes, digest: str, refers_to: str | None, length: int) -> bytes:
    """A WARC/1.1 response record, or a revisit record without the payload."""
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT}"]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % length
    block = http + (payload if refers_to is None else b"")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers in lower case, payload) of each record from `at` on; the payload follows the HTTP head."""
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError("not a WARC record")
        headers = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines)}
        begin = end + 4
        block = data[begin : begin + int(headers["content-length"])]
        http, _, payload = block.partition(b"\r\n\r\n")
        headers["http-length"] = next(x.split(b": ")[1].decode() for x in http.split(b"\r\n") if x.startswith(b"Content-Length: "))
        yield at, headers, payload
        at = begin + len(block) + 4


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    body = b"".join(struct.pack("<II", *f) for f in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(data: bytes) -> list[tuple[int, int, int]]:
    """(start, compressed size, decompressed size) of each frame, from the footer alone."""
    n, _, magic = struct.unpack_from("<IBI", data, len(data) - 9)
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    at, out = 0, []
    for k in range(n):
        size, whole = struct.unpack_from("<II", data, len(data) - 9 - 8 * (n - k))
        out.append((at, size, whole))
        at += size
    return out


class Bundle:
    """Collects records; close() gives the file and the index rows (record id, frame, offset within the frame, length)."""

    def __init__(self) -> None:
        import zstandard

        self.name = uuid.uuid4().hex
        self.zstd = zstandard.ZstdCompressor(level=LEVEL)
        self.parts: list[bytes] = []
        self.frames: list[tuple[int, int]] = []
        self.open: list[bytes] = []
        self.held = self.size = 0
        self.index: list[tuple[str, int, int, int]] = []

    def add(self, page_id: str, data: bytes) -> None:
        self.index.append((page_id, len(self.frames), self.held, len(data)))
        self.open.append(data)
        self.held += len(data)
        if self.held >= FRAME:
            self._close_frame()

    def _close_frame(self) -> None:
        if self.open:
            frame = self.zstd.compress(b"".join(self.open))
            self.parts.append(frame)
            self.frames.append((len(frame), self.held))
            self.size += len(frame)
            self.open, self.held = [], 0

    def close(self) -> bytes:
        self._close_frame()
        return b"".join(self.parts) + seek_table(self.frames)


def frame_of(data: bytes, frame: int) -> bytes:
    import zstandard

    start, size, whole = read_seek_table(data)[frame]
    return zstandard.ZstdDecompressor().decompress(data[start : start + size], max_output_size=whole)


@dataclass
class Archive:
    """`path`/bundles and `path`/index are Parquet tables; index rows: bundle, page_id, frame, offset, length."""

    path: str


def planned(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """pages (page_id, url, html) with digest, length and refers_to: null for a response, else the greatest page_id of the same payload.

    Only payloads of at least `least` bytes are compared, by SHA-1 and length; a null html is empty. Of rows that repeat
    both page_id and payload, all are responses if that id is the greatest. A null page_id never refers to itself.
    """
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), body.alias("html"))
    rows = rows.withColumn("digest", F.sha1("html")).withColumn("length", F.octet_length("html").cast("long"))
    large = F.col("length") >= least
    # hashes alone are shuffled; a hot payload is counted by each task before that
    largest = rows.where(large).groupBy("digest", "length").agg(F.max("page_id").alias("_top"), F.count(F.lit(1)).alias("_n"))
    largest = stored_table(largest.where("_n > 1 AND _top IS NOT NULL").drop("_n"))
    refers = F.when(F.col("page_id").eqNullSafe(F.col("_top")), None).otherwise(F.col("_top"))
    if largest.count() <= FEW_PAYLOADS:
        return rows.join(F.broadcast(largest), ["digest", "length"], "left").withColumn("refers_to", refers).drop("_top")
    # pages that can't refer to others stay where they are
    met = rows.where(large).join(largest, ["digest", "length"], "left").withColumn("refers_to", refers).drop("_top")
    return met.unionByName(rows.where(~large).withColumn("refers_to", F.lit(None).cast(dict(pages.dtypes)["page_id"])))


def write(pages: DataFrame, path: str, least: int = LEAST) -> Archive:
    """Writes one record for each row of pages into bundles at path, and the index beside them."""

    def bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(b: Bundle) -> pa.RecordBatch:
            index = [{"page_id": p, "frame": f, "offset": o, "length": n} for p, f, o, n in b.index]
            return pa.RecordBatch.from_arrays([pa.array([b.name]), pa.array([b.close()], pa.binary()), pa.array([index], entries)], ["bundle", "data", "entries"])

        now = Bundle()
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "html", "digest", "refers_to", "length")]
            for i in range(len(batch)):
                page_id, url, html, digest, refers_to, length = (c[i].as_py() for c in columns)
                name = "" if page_id is None else str(page_id)
                now.add(name, record(name, " ".join(url.split()), html, digest, None if refers_to is None else str(refers_to), length))
                if now.size >= BUNDLE:
                    yield done(now)
                    now = Bundle()
        if now.index:
            yield done(now)

    entries = pa.list_(pa.struct([("page_id", pa.string()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())]))
    schema = "bundle string, data binary, entries array<struct<page_id: string, frame: int, offset: long, length: long>>"
    planned(pages, least).mapInArrow(bundles, schema).write.parquet(f"{path}/bundles")
    return Archive(path)


def index(archive: Archive, spark) -> DataFrame:
    """(page_id string, bundle, frame, offset, length) of every record, without reading any bundle's data."""
    return spark.read.parquet(f"{archive.path}/bundles").select("bundle", F.explode("entries").alias("_e")).select("_e.page_id", "bundle", "_e.frame", "_e.offset", "_e.length")


_ROW = "page_id string, record_type string, refers_to string, payload_bytes long, payload_digest string, payload binary"


def _row(headers: dict[str, str], payload: bytes, keep: bool) -> tuple:
    response = headers["warc-type"] == "response"
    urn = lambda x: x[len("<urn:page:") : -1]
    refers = None if response else urn(headers["warc-refers-to"])
    size, digest = (len(payload), hashlib.sha1(payload).hexdigest()) if response else (int(headers["http-length"]), headers["warc-payload-digest"].removeprefix("sha1:"))
    if response and headers["warc-payload-digest"] != f"sha1:{digest}":
        raise ValueError(f"record {headers['warc-record-id']} is damaged")
    return urn(headers["warc-record-id"]) or None, headers["warc-type"], refers, size, digest, payload if keep and response else None


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary())
    names = ["page_id", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def read(archive: Archive, spark, payloads: bool = False) -> DataFrame:
    """Every record of the archive, frame by frame.

    payload_bytes and payload_digest are taken from the stored payload, which must have the digest its record names; a
    revisit holds no payload and gives the length and digest of the full one in its headers.
    """

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("data"):
                data = data.as_py()
                for k in range(len(read_seek_table(data))):
                    if rows := [_row(h, p, payloads) for _, h, p in parse(frame_of(data, k))]:
                        yield _batch(rows)

    return spark.read.parquet(f"{archive.path}/bundles").select("data").mapInArrow(records, _ROW)


def lookup(archive: Archive, spark, wanted: DataFrame) -> DataFrame:
    """The records of wanted (page_id string): only their bundles are read, and in these each of their frames is decompressed once."""
    at = index(archive, spark).join(wanted.select("page_id").distinct(), "page_id", "left_semi")
    places = at.groupBy("bundle").agg(F.collect_list(F.struct("frame", "offset")).alias("places"))  # bounded by a bundle's records

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, found in zip(batch.column("data"), batch.column("places"), strict=True):
                data, by_frame = data.as_py(), {}
                for p in found.as_py():
                    by_frame.setdefault(p["frame"], []).append(p["offset"])
                for frame, offsets in by_frame.items():
                    whole = frame_of(data, frame)
                    yield _batch([_row(headers, payload, True) for _, headers, payload in (next(parse(whole, at)) for at in offsets)])

    return spark.read.parquet(f"{archive.path}/bundles").select("bundle", "data").join(places, "bundle").select("data", "places").mapInArrow(records, _ROW)


def stored(pages: DataFrame, path: str, least: int = LEAST) -> DataFrame:
    """Writes pages (page_id, url, html; other columns are ignored) to bundles at path and reads them back: one row a record.

    Returns page_id, payload_bytes and payload_digest (of the full payload: a revisit's are its response's), record_type
    and refers_to. Null html is empty; repeated rows are records of their own; an empty table gives no rows.
    """
    spark, kind = pages.sparkSession, dict(pages.dtypes)["page_id"]
    back = read(write(pages, path, least), spark)
    return back.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
