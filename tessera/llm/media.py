"""Media columns: Netpbm and BMP.

Images are decoded to numpy arrays (height, width, channels), resized by area through integral images, cut into tiles
that are written in NPY format, and summed up in a difference hash.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A payload is padded with PAD to a positive multiple of UNIT bytes: rows of 64 pixels of three samples.
UNIT, PAD, WIDTH = 192, b" ", 64
TILE = 32


def _netpbm(raw: bytes) -> np.ndarray:
    kind = raw[1:2]
    gap = rb"(?:\s|#[^\n]*\n)+"
    fields = 2 if kind in b"14" else 3
    head = re.compile(rb"P[1-6]" + rb"".join(gap + rb"(\d+)" for _ in range(fields)) + (rb"\s" if kind in b"456" else rb"(?=\s|$)")).match(raw)
    if not head:
        raise ValueError("not a Netpbm header")
    width, height, *most = map(int, head.groups())
    most = most[0] if most else 1
    if not (width and height and 0 < most < 1 << 16):
        raise ValueError("a picture has pixels, of 16 bits at most")
    depth = 3 if kind in b"36" else 1
    n = width * height * depth
    if kind == b"4":
        row = -(-width // 8)
        bits = np.unpackbits(_cells(raw, np.uint8, row * height, head.end()).reshape(height, row), axis=1)[:, :width]
        return (255 * (1 - bits)).astype(np.uint8).reshape(height, width, 1)
    if kind in b"123":
        body = re.sub(rb"#[^\n]*", b" ", raw[head.end() :])
        cells = [c - 48 for c in re.sub(rb"\s+", b"", body)[:n]] if kind == b"1" else [int(c) for c in body.split()[:n]]
        if len(cells) < n or not all(0 <= c <= most for c in cells):
            raise ValueError("samples are missing or out of range")
        cells = np.array(cells, np.uint8 if most < 256 else np.uint16)
        return (255 * (1 - cells) if kind == b"1" else cells).reshape(height, width, depth)
    return _cells(raw, np.uint8 if most < 256 else ">u2", n, head.end()).reshape(height, width, depth)


def _cells(raw: bytes, kind, count: int, start: int) -> np.ndarray:
    """count numbers from start on. ValueError if there are fewer, whatever sizes a head claims."""
    if count < 0 or start < 0 or start + count * np.dtype(kind).itemsize > len(raw):
        raise ValueError("the picture is larger than its bytes")
    return np.frombuffer(raw, kind, count, start)


def _bmp(raw: bytes) -> np.ndarray:
    start, size, width, height, _, bits, packed = struct.unpack_from("<10xIIiiHHI", raw)
    if packed or bits not in (1, 4, 8, 24, 32) or width <= 0 or not height:
        raise ValueError("only plain BMP is read")
    row = (width * bits + 31) // 32 * 4
    cells = _cells(raw, np.uint8, row * abs(height), start).reshape(abs(height), row)
    cells = cells[::-1] if height > 0 else cells
    if bits >= 24:
        return cells[:, : width * bits // 8].reshape(abs(height), width, bits // 8)[:, :, 2::-1]
    if bits < 8:
        cells = np.unpackbits(cells, axis=1).reshape(abs(height), -1, bits) @ (1 << np.arange(bits)[::-1]).astype(np.uint8)
    colours = struct.unpack_from("<I", raw, 46)[0] or 1 << bits
    if cells[:, :width].max() >= colours:
        raise ValueError("a pixel has none of the colours")
    return _cells(raw, np.uint8, 4 * colours, 14 + size).reshape(-1, 4)[:, 2::-1][cells[:, :width]]


def decode(raw: bytes) -> np.ndarray:
    """Netpbm (P1 to P6) or uncompressed BMP to (height, width, channels); a bitmap's white is 255. Raises ValueError otherwise."""
    if raw[:1] == b"P":
        return _netpbm(raw)
    if raw[:2] == b"BM":
        return _bmp(raw)
    raise ValueError("neither Netpbm nor BMP")


def encode_ppm(image: np.ndarray) -> bytes:
    return b"P6\n%d %d\n255\n" % (image.shape[1], image.shape[0]) + image.tobytes()


def encode_bmp(image: np.ndarray) -> bytes:
    height, width, _ = image.shape
    row = (width * 24 + 31) // 32 * 4
    cells = np.zeros((height, row), np.uint8)
    cells[:, : width * 3] = image[::-1, :, ::-1].reshape(height, -1)
    return struct.pack("<2sIHHIIiiHHIIiiII", b"BM", 54 + row * height, 0, 0, 54, 40, width, height, 1, 24, 0, row * height, 2835, 2835, 0, 0) + cells.tobytes()


#: Cells of a picture whose integral image is held at once.
BAND = 4096 * 64


def area_resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Mean over the area that each new cell covers, for any sizes; float64 (height, width, channels).

    The integral image is made of bands of rows, each going on from the last row of the one before, and only its rows at the
    new cells' bounds are kept: a tall picture takes a bounded multiple of a band, however much of it one new row covers."""
    h, w, depth = image.shape
    step, bounds = max(1, BAND // w), np.arange(height + 1) * (h / height)
    at_bounds, above = np.zeros((height + 1, w + 1, depth)), np.zeros((1, w + 1, depth))
    for top in range(0, h, step):
        band = image[top : top + step]
        total = np.zeros((len(band) + 1, w + 1, depth))
        np.cumsum(np.cumsum(band, 0, dtype=np.float64), 1, out=total[1:, 1:])
        total += above
        inside = (bounds >= top) & (bounds <= top + len(band))
        at_bounds[inside] = _between(total, bounds[inside] - top)
        above = total[-1:].copy()
    cells = _between(at_bounds.swapaxes(0, 1), np.arange(width + 1) * (w / width)).swapaxes(0, 1)
    return np.diff(np.diff(cells, axis=0), axis=1) * (height * width / (h * w))


def _between(table: np.ndarray, at: np.ndarray) -> np.ndarray:
    """An integral image at fractional rows."""
    low = np.minimum(at.astype(np.int64), len(table) - 2)
    part = (at - low).reshape(-1, *[1] * (table.ndim - 1))
    return table[low] * (1 - part) + table[low + 1] * part


def difference_hash(image: np.ndarray, side: int = 8) -> str:
    """Which cells of a side x (side + 1) grey reduction are brighter than their left neighbours, as hexadecimal digits."""
    small = area_resize(image[:, :, :3] if image.shape[2] >= 3 else image[:, :, :1], side, side + 1)
    grey = small @ np.array([0.299, 0.587, 0.114]) if small.shape[2] == 3 else small[:, :, 0]  # means of sums are sums of means
    small = np.rint(grey * 64).astype(np.int64)
    return np.packbits(small[:, 1:] > small[:, :-1]).tobytes().hex()


def npy_tiles(image: np.ndarray, tile: int = TILE) -> list[tuple[int, int, bytes]]:
    """(row, column, NPY bytes) of tiles of at most tile x tile pixels."""
    out = []
    for y in range(0, image.shape[0], tile):
        for x in range(0, image.shape[1], tile):
            np.save(buffer := io.BytesIO(), np.ascontiguousarray(image[y : y + tile, x : x + tile]))
            out.append((y // tile, x // tile, buffer.getvalue()))
    return out


def reduced_tiles(image: np.ndarray, height: int, width: int, tile: int = TILE) -> list[tuple[int, int, bytes]]:
    """The picture resized by area to height x width, as NPY tiles."""
    return npy_tiles(np.rint(area_resize(image, height, width)).astype(image.dtype), tile)


def store_payload(raw: bytes) -> bytes:
    """A picture that holds raw, padded, as its samples: PPM, or BMP if the number of rows is odd."""
    image = np.frombuffer(raw + PAD * (-len(raw) % UNIT or (UNIT if not raw else 0)), np.uint8).reshape(-1, WIDTH, 3)
    return encode_bmp(image) if len(image) % 2 else encode_ppm(image)


MEDIA = T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("media", T.BinaryType())])


def to_media(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs, without the text, with n_bytes and media (binary) added; one row out per row in.

    A null text is empty; equal texts and repeated rows give equal media. A long text is one tall picture. An empty table
    gives no rows. Columns of the added names are replaced."""
    names = [c for c in docs.columns if c not in ("n_bytes", "media", text_col)]

    def run(batches):
        for part in batches:
            raw = pc.fill_null(part.column(part.schema.get_field_index(text_col)).cast(pa.binary()), b"").to_pylist()
            yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index(c)) for c in names] + [pa.array(list(map(len, raw)), pa.int64()), pa.array(list(map(store_payload, raw)), pa.binary())], names=[*names, *MEDIA.names])

    return docs.mapInArrow(run, T.StructType([docs.schema[c] for c in names] + list(MEDIA)))


FEATURES = T.StructType([T.StructField(c, T.LongType() if c in ("payload_bytes", "tail_crc32", "media_bytes", "height", "width", "n_tiles") else T.StringType()) for c in ("payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "height", "width", "n_tiles", "tiles_sha256")])
#: Side of the reduction that is written in tiles.
SIDE = 64


def _features(raw: bytes | None) -> tuple:
    try:
        image = decode(raw or b"")
    except (ValueError, struct.error):
        return (None, None, None, len(raw or b""), hashlib.sha256(raw or b"").hexdigest(), None, None, None, None, None)
    samples = np.ascontiguousarray(image).tobytes()
    tiles = reduced_tiles(image, SIDE, SIDE)
    return (
        len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-16:]), len(raw), hashlib.sha256(raw).hexdigest(),
        difference_hash(image), image.shape[0], image.shape[1], len(tiles), hashlib.sha256(b"".join(npy for _, _, npy in tiles)).hexdigest(),
    )


def media_features(media: DataFrame, media_col: str = "media") -> DataFrame:
    """media, without the pictures, with FEATURES added: digests of the decoded samples and of the stored bytes, the
    difference hash, the size, and the number and digest of the NPY tiles of a SIDE x SIDE reduction (those of
    media_tiles). One row out per row in.

    Bytes that are no picture, and null, give nulls but for media_bytes and media_sha256. Repeated rows repeat; an empty
    table gives no rows. Columns of the added names are replaced."""
    names = [c for c in media.columns if c not in FEATURES.names and c != media_col]

    def run(batches):
        for part in batches:
            cols = list(zip(*map(_features, part.column(part.schema.get_field_index(media_col)).to_pylist()), strict=True)) or [[]] * len(FEATURES)
            yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index(c)) for c in names] + [pa.array(c, pa.int64() if isinstance(f.dataType, T.LongType) else pa.string()) for c, f in zip(cols, FEATURES, strict=True)], names=[*names, *FEATURES.names])

    return media.mapInArrow(run, T.StructType([media.schema[c] for c in names] + list(FEATURES)))


TILES = T.StructType([T.StructField("tile_row", T.IntegerType()), T.StructField("tile_col", T.IntegerType()), T.StructField("npy", T.BinaryType())])


def media_tiles(media: DataFrame, id_col: str, media_col: str = "media", height: int = SIDE, width: int = SIDE, tile: int = TILE) -> DataFrame:
    """id, tile_row, tile_col, npy: the picture resized by area to height x width, in NPY tiles; none for what is no picture."""

    def run(batches):
        for part in batches:
            rows = []
            for key, raw in zip(part.column(part.schema.get_field_index(id_col)).to_pylist(), part.column(part.schema.get_field_index(media_col)).to_pylist(), strict=True):
                try:
                    image = decode(raw or b"")
                except (ValueError, struct.error):
                    continue
                rows += [(key, *x) for x in reduced_tiles(image, height, width, tile)]
            yield pa.RecordBatch.from_pylist([dict(zip([id_col, *TILES.names], r, strict=True)) for r in rows], schema=pa.schema([(id_col, part.schema.field(id_col).type), ("tile_row", pa.int32()), ("tile_col", pa.int32()), ("npy", pa.binary())]))

    return media.select(id_col, media_col).mapInArrow(run, T.StructType([media.schema[id_col], *TILES]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = media_features(to_media(docs))
    return out.withColumn("n_bytes", F.col("n_bytes").cast("long"))
