"""Media columns: Netpbm and BMP pictures as numpy arrays, NPY tiles and difference hashes.

decode() reads the stored bytes of P1 to P6 and of uncompressed BMP; area_resize() averages exactly the area that each
new sample covers, by integral images; a tile is that smaller picture as NPY bytes, and its difference hash says for
each pair of neighbours which is brighter.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainloom.llm.common import short_batches

#: Samples in a row of a picture made of plain bytes.
WIDTH = 64
#: Rows whose integral image is held at once.
STRIP = 4096


def encode_pgm(samples: np.ndarray) -> bytes:
    """A two-dimensional array of 8-bit samples as binary PGM (P5)."""
    high, wide = samples.shape
    return b"P5\n%d %d\n255\n" % (wide, high) + np.ascontiguousarray(samples, np.uint8).tobytes()


def encode_bmp(samples: np.ndarray) -> bytes:
    """A two-dimensional array of 8-bit samples as BMP with a grey palette, rows from bottom to top."""
    high, wide = samples.shape
    stride = (wide + 3) // 4 * 4
    rows = np.zeros((high, stride), np.uint8)
    rows[:, :wide] = samples[::-1]
    palette = b"".join(bytes((i, i, i, 0)) for i in range(256))
    start = 14 + 40 + len(palette)
    head = b"BM" + struct.pack("<IHHI", start + rows.size, 0, 0, start)
    return head + struct.pack("<IiiHHIIiiII", 40, wide, high, 1, 8, 0, rows.size, 2835, 2835, 256, 0) + palette + rows.tobytes()


_FIELD = re.compile(rb"(?:\s|#[^\n]*\n)*([0-9]+)")


def _netpbm(data: bytes) -> np.ndarray:
    kind = data[1] - 0x30
    at, fields = 2, []
    for _ in range(2 if kind in (1, 4) else 3):
        found = _FIELD.match(data, at)
        if not found:
            raise ValueError("a Netpbm header ends too early")
        fields.append(int(found[1]))
        at = found.end()
    wide, high, top = (*fields, 1)[:3]
    depth = 3 if kind in (3, 6) else 1
    n = wide * high * depth
    if kind <= 3:
        text = re.sub(rb"#[^\n]*", b"", data[at:])
        digits = re.findall(rb"[01]", text) if kind == 1 else text.split()
        flat = np.array(digits[:n]).astype(np.int64)
    elif kind == 4:
        row = (wide + 7) // 8
        flat = np.unpackbits(np.frombuffer(data, np.uint8, row * high, at + 1).reshape(high, row), axis=1)[:, :wide].ravel()
    else:
        flat = np.frombuffer(data, np.uint8 if top < 256 else ">u2", n, at + 1)
    if len(flat) < n:
        raise ValueError("a Netpbm picture ends too early")
    if kind in (1, 4):
        flat, top = 1 - flat, 1  # 1 is black there
    out = flat.reshape((high, wide, depth) if depth == 3 else (high, wide))
    return out.astype(np.uint8 if top < 256 else np.uint16, copy=False)


def _bmp(data: bytes) -> np.ndarray:
    start, head = struct.unpack_from("<I", data, 10)[0], struct.unpack_from("<I", data, 14)[0]
    if head == 12:
        wide, high, _, bits = struct.unpack_from("<HHHH", data, 18)
        packing, used, entry = 0, 0, 3
    else:
        wide, high, _, bits, packing = struct.unpack_from("<iiHHI", data, 18)
        used, entry = struct.unpack_from("<I", data, 46)[0], 4
    if packing or bits not in (1, 4, 8, 24, 32):
        raise ValueError("only uncompressed BMP of 1, 4, 8, 24 or 32 bits is read")
    down, high = high < 0, abs(high)
    stride = (wide * bits + 31) // 32 * 4
    rows = np.frombuffer(data, np.uint8, stride * high, start).reshape(high, stride)
    rows = rows if down else rows[::-1]
    if bits >= 24:
        return rows[:, : wide * bits // 8].reshape(high, wide, bits // 8)[:, :, 2::-1].copy()
    if bits == 8:
        index = rows[:, :wide]
    else:
        each = np.unpackbits(rows, axis=1).reshape(high, -1, bits)
        index = (each * (1 << np.arange(bits)[::-1])).sum(2).astype(np.uint8)[:, :wide]
    palette = np.frombuffer(data, np.uint8, entry * (used or 1 << bits), 14 + head).reshape(-1, entry)[:, 2::-1]
    if (palette == palette[:, :1]).all():  # grey
        grey = palette[:, 0]
        return index.copy() if len(grey) == 256 and (grey == np.arange(256)).all() else grey[index]
    return palette[index]


def decode(data: bytes) -> np.ndarray:
    """height x width samples, or height x width x 3 in the order red, green, blue."""
    if data[:2] == b"BM":
        return _bmp(data)
    if len(data) > 2 and data[:1] == b"P" and data[1:2] in b"123456":
        return _netpbm(data)
    raise ValueError("neither Netpbm nor BMP")


def _corner(integral: np.ndarray, edges: np.ndarray, axis: int) -> np.ndarray:
    """An integral image between its whole places: it is linear there, because samples are constant."""
    whole = np.floor(edges).astype(np.int64)
    part = edges - whole
    above = np.minimum(whole + 1, integral.shape[axis] - 1)
    shape = [1, 1]
    shape[axis] = -1
    return np.take(integral, whole, axis) * (1 - part).reshape(shape) + np.take(integral, above, axis) * part.reshape(shape)


def area_resize(samples: np.ndarray, high: int, wide: int) -> np.ndarray:
    """The mean over the area of each of high x wide equal cells, as floats; colours become their mean first.

    Integral images are taken strip by strip, so memory follows STRIP rows and not the picture.
    """
    if samples.ndim == 3:
        samples = samples.mean(2)
    rows, columns = samples.shape
    if not samples.size:
        return np.zeros((high, wide))
    across = np.linspace(0, columns, wide + 1)
    down = np.linspace(0, rows, high + 1)
    total = np.zeros((high, wide))
    for top in range(0, rows, STRIP):
        strip = samples[top : top + STRIP]
        integral = np.zeros((len(strip) + 1, columns + 1))
        np.cumsum(np.cumsum(strip, 0, dtype=np.float64), 1, out=integral[1:, 1:])
        at = np.clip(down - top, 0, len(strip))
        total += np.diff(np.diff(_corner(_corner(integral, at, 0), across, 1), axis=0), axis=1)
    return total / (rows / high * columns / wide)


def npy(samples: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, samples, allow_pickle=False)
    return out.getvalue()


def tile(samples: np.ndarray, high: int, wide: int) -> np.ndarray:
    """area_resize() rounded to 8-bit samples."""
    return np.clip(np.floor(area_resize(samples, high, wide) + 0.5), 0, 255).astype(np.uint8)


def difference_hash(small: np.ndarray) -> str:
    """Bits, row by row, of which sample is brighter than its left neighbour, as hexadecimal."""
    return np.packbits((small[:, 1:] > small[:, :-1]).ravel()).tobytes().hex()


def pad(payload: bytes, unit: int = WIDTH) -> bytes:
    """Bytes 0 appended up to a positive multiple of unit."""
    return payload + bytes(-len(payload) % unit or (0 if payload else unit))


def store(docs: DataFrame, form: str = "pgm", high: int = 8, wide: int = 9) -> DataFrame:
    """Every whole text of docs (doc_id, text; other columns are ignored) as a picture of its UTF-8 bytes.

    Returns doc_id, n_bytes, media (the stored form: "pgm" or "bmp"), payload_bytes, payload_sha256 and tail_crc32 of the
    samples decoded from media, tile (NPY bytes) and dhash. A null text is empty: one row of zeros. Equal texts have
    equal values; repeated rows and null ids stay as they are; texts of any length are
    stored whole; an empty table gives no rows.
    """
    kind = dict(docs.dtypes)["doc_id"]
    encode = {"pgm": encode_pgm, "bmp": encode_bmp}[form]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, at, most = len(batch), 0, 8 << 20
            texts = batch.column("text")
            while at < n:
                out: list[tuple] = []
                held = 0
                while at + len(out) < n and held < most:
                    text = texts[at + len(out)].as_py()
                    raw = text.encode() if text else b""
                    samples = np.frombuffer(pad(raw), np.uint8).reshape(-1, WIDTH)
                    media = encode(samples)
                    back = decode(media)
                    payload = back.tobytes()
                    small = tile(back, high, wide)
                    out.append((len(raw), media, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), npy(small), difference_hash(small)))
                    held += len(media)
                kinds = (pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.string())
                columns = [pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(out)), *columns], ["doc_id", "n_bytes", "media", "payload_bytes", "payload_sha256", "tail_crc32", "tile", "dhash"])
                at += len(out)

    return docs.select("doc_id", "text").mapInArrow(rows, f"doc_id {kind}, n_bytes long, media binary, payload_bytes long, payload_sha256 string, tail_crc32 long, tile binary, dhash string")


def digests(stored: DataFrame) -> DataFrame:
    """The stored table's rows without the pictures themselves: their length and SHA-256, and the hash and tile as one feature."""
    return stored.select(
        "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"),
        F.concat(F.lit("dhash:"), "dhash", F.lit(" tile:"), F.substring(F.sha2("tile", 256), 1, 16)).alias("feature"),
    )


def write_tiles(stored: DataFrame, path: str) -> None:
    """The pictures, tiles and hashes as Parquet; each `tile` is a whole NPY file."""
    stored.write.mode("overwrite").option("compression", "zstd").parquet(path)


def reread(spark: SparkSession, path: str) -> DataFrame:
    """digests() of what write_tiles() left at path, from the stored bytes alone: media is decoded anew, and the hash is that of the tile as NPY reads it."""
    table = spark.read.parquet(path).select("doc_id", "n_bytes", "media", "tile")
    kind = dict(table.dtypes)["doc_id"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for media, packed in zip(batch.column("media"), batch.column("tile"), strict=True):
                media, packed = media.as_py(), packed.as_py()
                payload = decode(media).tobytes()
                small = np.load(io.BytesIO(packed), allow_pickle=False)
                feature = f"dhash:{difference_hash(small)} tile:{hashlib.sha256(packed).hexdigest()[:16]}"
                out.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), hashlib.sha256(media).hexdigest(), feature))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            columns = [pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), *columns], ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    return table.mapInArrow(rows, f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def kept(docs: DataFrame, path: str, form: str = "pgm") -> DataFrame:
    """Writes store()'s table to path and gives the digests of what is read back from there."""
    with short_batches(docs.sparkSession):
        write_tiles(store(docs, form), path)
    return reread(docs.sparkSession, path)
