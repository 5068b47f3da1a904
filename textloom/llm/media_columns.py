"""Media columns: Netpbm and BMP bytes as numpy arrays, NPY tiles and difference hashes.

Images are decoded losslessly (all six Netpbm formats, samples of up to 16 bits, bit maps as 0
and 255; uncompressed BMP of 8, 24 or 32 bits, whose fourth byte is left out), resized by area
with integral images, and written as NPY tiles.

Defined results: a null or empty text is stored as one row of blanks; a text of any length is
one image of as many rows as it needs; equal texts have equal values; repeated rows are stored
one by one; an empty table gives no rows; other columns, whatever their names, are left alone.
A broken, cut or unknown image, or none, has no tile and no hash, and ``error`` says why.
"""

from __future__ import annotations

import hashlib
import io
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of payload in one image row: 64 RGB pixels.
ROW = 192
#: Tile written as NPY: rows, columns. One column more than hash bits in a row.
TILE = (8, 9)

BLANKS = b" \t\n\v\f\r"


def encode_netpbm(image: np.ndarray) -> bytes:
    """An (h, w) array as PGM, an (h, w, 3) array as PPM."""
    h, w = image.shape[:2]
    return b"P%d\n%d %d\n255\n" % (5 if image.ndim == 2 else 6, w, h) + np.ascontiguousarray(image, np.uint8).tobytes()


def encode_bmp(image: np.ndarray) -> bytes:
    """An (h, w, 3) array as bottom-up 24-bit BMP, rows padded to four bytes."""
    h, w = image.shape[:2]
    stride = (3 * w + 3) // 4 * 4
    rows = np.zeros((h, stride), np.uint8)
    rows[:, : 3 * w] = image[::-1, :, ::-1].reshape(h, 3 * w)
    return struct.pack("<2sIHHI", b"BM", 54 + h * stride, 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, w, h, 1, 24, 0, h * stride, 2835, 2835, 0, 0) + rows.tobytes()


class _Header:
    """Reads the tokens of a Netpbm header from left to right; comments end with their line."""

    def __init__(self, data: bytes) -> None:
        self.data, self.at = data, 2

    def number(self) -> int:
        data, at = self.data, self.at
        while at < len(data) and (data[at] in BLANKS or data[at] == 35):
            if data[at] == 35:
                at = data.find(b"\n", at)
                at = len(data) if at < 0 else at
            else:
                at += 1
        first = at
        while at < len(data) and at - first < 10 and 48 <= data[at] <= 57:
            at += 1
        if at == first:
            raise ValueError("a number is missing in the Netpbm header")
        self.at = at
        return int(data[first:at])


def _shape(width: int, height: int, size: int) -> tuple[int, int]:
    """The shape that a header names, unless so many bytes can't hold as many pixels: a pixel has one bit at least."""
    if width < 1 or height < 1 or width * height > 8 * size:
        raise ValueError(f"an image of {width} x {height} pixels is not decoded")
    return height, width


def _decode_netpbm(data: bytes) -> np.ndarray:
    kind, header = data[1] - 48, _Header(data)
    width, height = header.number(), header.number()
    shape = _shape(width, height, len(data))
    most = 1 if kind in (1, 4) else header.number()
    if not 1 <= most < 65536:
        raise ValueError(f"samples up to {most} are not decoded")
    if kind in (3, 6):
        shape = (*shape, 3)
    n, at = int(np.prod(shape)), header.at
    if kind > 3:
        if at >= len(data) or data[at] not in BLANKS:
            raise ValueError("the Netpbm header does not end")
        at += 1
    if kind == 4:
        stride = (width + 7) // 8
        if len(data) < at + height * stride:
            raise ValueError("Netpbm is cut short")
        bits = np.unpackbits(np.frombuffer(data, np.uint8, height * stride, at).reshape(height, stride), axis=1)[:, :width]
        return np.where(bits, 0, 255).astype(np.uint8)
    if kind > 4:
        sample = np.dtype(np.uint8 if most < 256 else ">u2")
        if len(data) < at + n * sample.itemsize:
            raise ValueError("Netpbm is cut short")
        out = np.frombuffer(data, sample, n, at).reshape(shape)
        return out if most < 256 else out.astype(np.uint16)
    body = b"\n".join(x.partition(b"#")[0] for x in data[at:].split(b"\n"))
    if kind == 1:  # digits may touch
        digits = np.frombuffer(body, np.uint8)
        digits = digits[(digits == 48) | (digits == 49)][:n]
        if len(digits) < n:
            raise ValueError("Netpbm is cut short")
        return np.where(digits == 49, 0, 255).astype(np.uint8).reshape(shape)
    words = body.split(None, n)[:n]
    if len(words) < n:
        raise ValueError("Netpbm is cut short")
    return np.array([int(x) for x in words], np.uint8 if most < 256 else np.uint16).reshape(shape)


def _decode_bmp(data: bytes) -> np.ndarray:
    if len(data) < 54:
        raise ValueError("BMP is cut short")
    (start,), (head, w, h), (planes, depth, packed) = struct.unpack_from("<I", data, 10), struct.unpack_from("<Iii", data, 14), struct.unpack_from("<HHI", data, 26)
    if head < 40 or planes != 1 or depth not in (8, 24, 32) or packed:
        raise ValueError("only uncompressed BMP of 8, 24 or 32 bits is decoded")
    rows, _ = _shape(w, abs(h), len(data))
    stride = (w * depth // 8 + 3) // 4 * 4
    if len(data) < start + rows * stride:
        raise ValueError("BMP is cut short")
    raw = np.frombuffer(data, np.uint8, rows * stride, start).reshape(rows, stride)[:, : w * depth // 8]
    raw = raw[::-1] if h > 0 else raw
    if depth != 8:
        return raw.reshape(rows, w, depth // 8)[:, :, 2::-1]
    colours = struct.unpack_from("<I", data, 46)[0] or 256
    if colours > 256 or len(data) < 14 + head + 4 * colours:
        raise ValueError("the BMP's palette is cut short")
    palette = np.zeros((256, 3), np.uint8)
    palette[:colours] = np.frombuffer(data, np.uint8, 4 * colours, 14 + head).reshape(colours, 4)[:, 2::-1]
    return palette[raw]


def decode(data: bytes | None) -> np.ndarray:
    """(h, w) or (h, w, 3) samples. Raises ValueError where data is no image that is read here."""
    if data and data[:2] == b"BM":
        return _decode_bmp(data)
    if data and data[:1] == b"P" and data[1:2] in (b"1", b"2", b"3", b"4", b"5", b"6") and data[2:3] and data[2] in BLANKS + b"#":
        return _decode_netpbm(data)
    raise ValueError("neither Netpbm nor BMP")


def area_resize(gray: np.ndarray, height: int, width: int) -> np.ndarray:
    """Mean of the area that each output pixel covers, from an integral image read between its points."""
    total = np.zeros((gray.shape[0] + 1, gray.shape[1] + 1))
    np.cumsum(gray, axis=0, out=total[1:, 1:])
    np.cumsum(total[1:, 1:], axis=1, out=total[1:, 1:])

    def between(x: np.ndarray, n: int, parts: int) -> np.ndarray:
        at = np.arange(parts + 1) * n / parts
        low = np.minimum(at.astype(int), n - 1)
        share = (at - low).reshape(-1, *[1] * (x.ndim - 1))
        return x[low] * (1 - share) + x[low + 1] * share

    total = between(between(total, gray.shape[0], height).T, gray.shape[1], width).T
    area = gray.shape[0] * gray.shape[1] / (height * width)
    return np.diff(np.diff(total, axis=0), axis=1) / area


def npy(tile: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.lib.format.write_array(out, np.ascontiguousarray(tile), version=(1, 0))
    return out.getvalue()


def tile_of(image: np.ndarray) -> np.ndarray:
    """The tile of an image: gray means of areas, samples of 16 bits brought to 0 to 255."""
    image = image if image.dtype == np.uint8 else image / 257.0
    gray = image if image.ndim == 2 else image @ np.array([0.299, 0.587, 0.114])
    return area_resize(gray.astype(np.float64), *TILE)


def difference_hash(tile: np.ndarray) -> int:
    """64 bits, row by row: 1 where a tile's pixel is darker than its right neighbour, by more than the rounding of sums."""
    return int.from_bytes(np.packbits(tile[:, 1:] - tile[:, :-1] > 1e-6).tobytes(), "big")


def store_text(text: str | None) -> bytes:
    """UTF-8, blanks up to a positive multiple of ROW, as an image of 64 pixels a row: BMP or PPM by the payload's checksum."""
    data = (text or "").encode()
    data = data.ljust(max(1, -(-len(data) // ROW)) * ROW, b" ")
    image = np.frombuffer(data, np.uint8).reshape(-1, ROW // 3, 3)
    return encode_bmp(image) if zlib.crc32(data) & 1 else encode_netpbm(image)


MEDIA = "media binary, tile_npy binary, dhash string, error string"


def _tile(media: bytes | None) -> tuple[bytes | None, str | None, str | None]:
    try:
        tile = tile_of(decode(media))
    except ValueError as e:
        return None, None, str(e)
    return npy(np.rint(tile).astype(np.uint8)), f"{difference_hash(tile):016x}", None


def media_tiles(images: DataFrame, id_col: str, media_col: str) -> DataFrame:
    """Stored images with their NPY tile and difference hash, or why there are none: id, media, tile_npy, dhash, error."""
    id_type = images.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = list(zip(*[_tile(x.as_py()) for x in batch.column(1)])) or [()] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(c, k) for c, k in zip(cols, (pa.binary(), pa.string(), pa.string()))]], names=["id", "media", "tile_npy", "dhash", "error"])

    return images.select(F.col(id_col).alias("id"), F.col(media_col).alias("media")).mapInArrow(run, f"id {id_type}, {MEDIA}")


DIGEST = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def store_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every text stored as an image: id, n_bytes, media."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x.as_py() for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len((t or "").encode()) for t in texts], pa.int64()), pa.array([store_text(t) for t in texts], pa.binary())],
                names=["id", "n_bytes", "media"],
            )

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {id_type}, n_bytes long, media binary")


def media_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every text stored, read back and described: doc_id and the columns of DIGEST."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for x in batch.column(1):
                text = x.as_py()
                media = store_text(text)
                image = decode(media)
                payload = image.tobytes()
                tile = tile_of(image)
                tail = npy(np.rint(tile).astype(np.uint8))
                rows.append((len((text or "").encode()), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(media), hashlib.sha256(media).hexdigest(), f"{difference_hash(tile):016x}:{zlib.crc32(tail):08x}"))
            cols = list(zip(*rows)) or [()] * 7
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(cols, kinds)]], names=["doc_id", *[c.split()[0] for c in DIGEST.split(", ")]])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {id_type}, {DIGEST}")
