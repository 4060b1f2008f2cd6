"""Media columns: Netpbm and BMP pictures as numpy arrays, area-resized tiles in NPY form, difference hashes.

Pictures are binary columns. ``decode`` reads plain and raw Netpbm (P1 to P6, 8 or 16 bits) and
uncompressed BMP (8, 24 or 32 bits). ``area_resize`` averages exact pixel areas through an integral image,
so that its cost doesn't depend on the tile's size.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from io import BytesIO

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from lectern.llm.bpe import slices
from lectern.llm.common import bound_batches, read_table, tidy

#: Width in samples of the pictures that carry a payload.
CARRIER_WIDTH = 64
#: Height and width of a tile; one column more than the difference hash has bits in a row.
TILE = (8, 9)


def _netpbm_tokens(data: bytes, n: int) -> tuple[list[int], int]:
    """n header numbers after the magic, without comments, and where the data begin."""
    out: list[int] = []
    at = 2
    while len(out) < n:
        while data[at : at + 1].isspace():
            at += 1
        if data[at : at + 1] == b"#":
            at = data.index(b"\n", at) + 1
            continue
        end = at
        while data[end : end + 1].isdigit():
            end += 1
        if end == at:
            raise ValueError("broken Netpbm header")
        out.append(int(data[at:end]))
        at = end
    return out, at + 1


def decode_netpbm(data: bytes) -> np.ndarray:
    """Samples as (height, width) or (height, width, 3); bitmaps have 0 for black and 255 for white."""
    kind = data[1] - 48
    if data[:1] != b"P" or not 1 <= kind <= 6:
        raise ValueError("not Netpbm")
    header, at = _netpbm_tokens(data, 2 if kind in (1, 4) else 3)
    width, height = header[:2]
    depth = 3 if kind in (3, 6) else 1
    if kind in (1, 4):
        if kind == 4:
            stride = (width + 7) // 8
            bits = np.unpackbits(np.frombuffer(data, np.uint8, stride * height, at).reshape(height, stride), axis=1)[:, :width]
        else:
            bits = np.array([c - 48 for c in data[at - 1 :] if c in b"01"][: width * height], np.uint8).reshape(height, width)
        return np.where(bits == 1, 0, 255).astype(np.uint8)
    kind_of = np.dtype(np.uint8 if header[2] < 256 else ">u2")
    if kind in (2, 3):
        body = b"\n".join(line.split(b"#")[0] for line in data[at - 1 :].split(b"\n"))
        flat = np.array(body.split(), kind_of)[: width * height * depth]
    else:
        flat = np.frombuffer(data, kind_of, width * height * depth, at)
    return flat.reshape((height, width, 3) if depth == 3 else (height, width))


def decode_bmp(data: bytes) -> np.ndarray:
    """Samples of an uncompressed BMP as (height, width, 3) in red, green, blue order, or (height, width) if its palette is grey."""
    if data[:2] != b"BM":
        raise ValueError("not BMP")
    (offset,) = struct.unpack_from("<I", data, 10)
    size, width, height, _, bits, compression = struct.unpack_from("<IiiHHI", data, 14)
    if compression not in (0, 3) or bits not in (8, 24, 32):
        raise ValueError(f"BMP of {bits} bits, compression {compression}")
    stride = (width * bits // 8 + 3) // 4 * 4
    rows = np.frombuffer(data, np.uint8, stride * abs(height), offset).reshape(abs(height), stride)
    rows = rows[::-1] if height > 0 else rows
    if bits == 8:
        (colours,) = struct.unpack_from("<I", data, 46)
        palette = np.frombuffer(data, np.uint8, (colours or 256) * 4, 14 + size).reshape(-1, 4)[:, 2::-1]
        picture = palette[rows[:, :width]]
        return picture[:, :, 0] if (palette == palette[:, :1]).all() else picture
    step = bits // 8
    return rows[:, : width * step].reshape(abs(height), width, step)[:, :, 2::-1]


def decode(data: bytes) -> np.ndarray:
    return decode_bmp(data) if data[:2] == b"BM" else decode_netpbm(data)


def encode_pgm(samples: np.ndarray) -> bytes:
    height, width = samples.shape
    return b"P5\n%d %d\n255\n" % (width, height) + np.ascontiguousarray(samples, np.uint8).tobytes()


def encode_bmp(samples: np.ndarray) -> bytes:
    """8-bit grey BMP."""
    height, width = samples.shape
    stride = (width + 3) // 4 * 4
    rows = np.zeros((height, stride), np.uint8)
    rows[:, :width] = samples[::-1]
    palette = np.repeat(np.arange(256, dtype=np.uint8)[:, None], 4, 1)
    palette[:, 3] = 0
    offset = 54 + 1024
    head = b"BM" + struct.pack("<IHHI", offset + rows.size, 0, 0, offset) + struct.pack("<IiiHHIIiiII", 40, width, height, 1, 8, 0, rows.size, 2835, 2835, 256, 0)
    return head + palette.tobytes() + rows.tobytes()


def area_resize(samples: np.ndarray, height: int, width: int) -> np.ndarray:
    """Mean of each target cell's exact area, by bilinear look-ups in the integral image; grey in, float64 out."""
    grey = samples.astype(np.float64).mean(axis=2) if samples.ndim == 3 else samples
    h, w = grey.shape
    rows = np.arange(height + 1) * h / height
    cols = np.arange(width + 1) * w / width
    # Columns first: along each row only the few sums at the cells' edges are kept.
    across = np.zeros((h, w + 1))
    np.cumsum(grey, axis=1, dtype=np.float64, out=across[:, 1:])
    across = _at(across, cols, 1)
    both = np.zeros((h + 1, width + 1))
    np.cumsum(across, axis=0, out=both[1:])
    both = _at(both, rows, 0)
    sums = np.diff(np.diff(both, axis=0), axis=1)
    return sums / ((h / height) * (w / width))


def _at(sums: np.ndarray, edges: np.ndarray, axis: int) -> np.ndarray:
    """Values of cumulative sums at fractional positions."""
    low = np.minimum(edges.astype(np.int64), sums.shape[axis] - 1)
    high = np.minimum(low + 1, sums.shape[axis] - 1)
    part = (edges - low).reshape((-1, 1) if axis == 0 else (1, -1))
    a, b = sums.take(low, axis), sums.take(high, axis)
    return a + (b - a) * part


def difference_hash(tile: np.ndarray) -> str:
    """16 hex digits: whether each cell is darker than its right neighbour, row by row."""
    return np.packbits(tile[:, :-1] < tile[:, 1:]).tobytes().hex()


def npy(tile: np.ndarray) -> bytes:
    out = BytesIO()
    np.save(out, tile, allow_pickle=False)
    return out.getvalue()


#: What decoding raises on pictures that aren't whole, or hold samples out of their range.
BROKEN = (ValueError, IndexError, OverflowError, struct.error)


def media_tiles(df: DataFrame, media_col: str = "media") -> DataFrame:
    """Adds width, height, the tile as NPY bytes and the difference hash of each picture.

    A picture that is null or can't be decoded, or has no pixels, gets null in the first four columns and the reason
    in ``media_error``. Other columns are kept; columns with the new ones' names are replaced.
    """
    new = [StructField("width", IntegerType()), StructField("height", IntegerType()), StructField("tile_npy", BinaryType()), StructField("dhash", StringType()), StructField("media_error", StringType())]
    df = df.drop(*(f.name for f in new))
    bound_batches(df.sparkSession)
    schema = StructType([*df.schema.fields, *new])

    def describe(data: bytes | None) -> tuple:
        if data is None:
            return None, None, None, None, "null"
        try:
            picture = decode(data)
            if not picture.size:
                raise ValueError("no pixels")
        except BROKEN as e:
            return None, None, None, None, str(e)
        tile = np.rint(area_resize(picture, *TILE)).astype(np.uint16 if picture.dtype.itemsize > 1 else np.uint8)
        return picture.shape[1], picture.shape[0], npy(tile), difference_hash(tile), None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, media_col):
                found = [describe(x.as_py()) for x in batch.column(media_col)]
                new_columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.int32(), pa.int32(), pa.binary(), pa.string(), pa.string()))]
                yield pa.RecordBatch.from_arrays([*batch.columns, *new_columns], names=schema.names)

    return df.mapInArrow(tidy(run), schema)


def text_media(df: DataFrame, text_col: str = "text", form: str = "pgm") -> DataFrame:
    """Adds ``n_bytes`` and ``media``: each whole text as UTF-8, zero-padded to a positive multiple of 64, as the samples of a grey picture.

    The picture is 64 samples wide; ``form`` is ``pgm`` or ``bmp``, or ``dealt``: either, by the payload's CRC-32, so that equal texts have equal pictures.
    Null counts as empty. The text column is dropped.
    """
    encode = {"pgm": encode_pgm, "bmp": encode_bmp, "dealt": lambda samples: (encode_bmp if zlib.crc32(samples.tobytes()) & 1 else encode_pgm)(samples)}[form]
    bound_batches(df.sparkSession)
    kept = [f for f in df.schema.fields if f.name not in (text_col, "n_bytes", "media")]
    schema = StructType([*kept, StructField("n_bytes", LongType()), StructField("media", BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text_col):
                raw = pc.fill_null(batch.column(text_col), "").cast(pa.binary())
                media = []
                for x in raw:
                    data = x.as_py()
                    data += b"\0" * (-len(data) % CARRIER_WIDTH if data else CARRIER_WIDTH)
                    media.append(encode(np.frombuffer(data, np.uint8).reshape(-1, CARRIER_WIDTH)))
                columns = [batch.column(f.name) for f in kept]
                yield pa.RecordBatch.from_arrays([*columns, pc.binary_length(raw).cast(pa.int64()), pa.array(media, pa.binary())], names=schema.names)

    return df.mapInArrow(tidy(run), schema)


def payload_digests(df: DataFrame, media_col: str = "media") -> DataFrame:
    """Reads the samples back from each stored picture and adds the payload's length, SHA-256 and the CRC-32 of its last 64 bytes, and the stored form's length and SHA-256.

    A null picture has null in all of them; one that can't be decoded keeps the stored form's, and has null for the payload.
    """
    new = [StructField("payload_bytes", LongType()), StructField("payload_sha256", StringType()), StructField("tail_crc32", LongType()), StructField("media_bytes", LongType()), StructField("media_sha256", StringType())]
    df = df.drop(*(f.name for f in new))
    kept = [f for f in df.schema.fields if f.name != media_col]
    schema = StructType([*kept, *new])

    def digests(data: bytes | None) -> tuple:
        if data is None:
            return (None,) * 5
        stored = len(data), hashlib.sha256(data).hexdigest()
        try:
            payload = decode(data).tobytes()
        except BROKEN:
            return None, None, None, *stored
        return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), *stored

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, media_col):
                found = []
                for x in batch.column(media_col):
                    found.append(digests(x.as_py()))
                columns = [batch.column(f.name) for f in kept]
                new_columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()))]
                yield pa.RecordBatch.from_arrays([*columns, *new_columns], names=schema.names)

    return df.mapInArrow(tidy(run), schema)


def op3_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts stored as grey pictures of both forms; the feature is the difference hash of their NPY tiles, which are returned with it."""
    stored = text_media(read_table(spark, sf_dir, "documents").select("doc_id", "text"), form="dealt")
    return payload_digests(media_tiles(stored)).selectExpr("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "dhash AS feature", "tile_npy")
