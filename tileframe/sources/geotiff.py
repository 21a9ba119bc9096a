"""GeoTIFF: bands of a north-up raster, written with numpy and zlib, and read from files of others, too."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The format's tags, type sizes and sample formats.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, OFFSETS, SAMPLES, ROWS, COUNTS, PLANAR, PREDICTOR, FORMAT = 256, 257, 258, 259, 262, 273, 277, 278, 279, 284, 317, 339
TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_COUNTS = 322, 323, 324, 325
SCALE, TIEPOINT, GEOKEYS, NODATA = 33550, 33922, 34735, 42113
SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 12: 8}
CODES = {2: "s", 3: "H", 4: "I", 12: "d", 1: "B"}


def encode(bands: np.ndarray, transform: tuple[float, float, float, float], srid: int, nodata: str | None = None) -> bytes:
    """Deflated strips, one a band, of bands (n, h, w); transform is (x0, pixel width, y0, pixel height as a negative number). Integers use predictor 2."""
    n, h, w = bands.shape
    kind = bands.dtype.newbyteorder("<")
    whole = kind.kind in "iu"
    data = np.diff(bands, axis=2, prepend=np.zeros((n, h, 1), bands.dtype)) if whole else bands
    strips = [zlib.compress(np.ascontiguousarray(b, kind).tobytes(), 6) for b in data]
    x0, pw, y0, ph = transform
    keys = [1, 1, 0, 3, 1024, 0, 1, 2 if srid == 4326 else 1, 1025, 0, 1, 1, 2048 if srid == 4326 else 3072, 0, 1, srid]
    tags = [
        (WIDTH, 4, [w]), (HEIGHT, 4, [h]), (BITS, 3, [kind.itemsize * 8] * n), (COMPRESSION, 3, [8]), (PHOTOMETRIC, 3, [1]), (OFFSETS, 4, [0] * n), (SAMPLES, 3, [n]), (ROWS, 4, [h]),
        (COUNTS, 4, [len(s) for s in strips]), (PLANAR, 3, [2]), (PREDICTOR, 3, [2 if whole else 1]), (FORMAT, 3, [{"u": 1, "i": 2, "f": 3}[kind.kind]] * n),
        (SCALE, 12, [pw, -ph, 0.0]), (TIEPOINT, 12, [0.0, 0.0, 0.0, x0, y0, 0.0]), (GEOKEYS, 3, keys),
    ]
    if nodata is not None:
        tags.append((NODATA, 2, nodata.encode() + b"\0"))
    at = 8 + 2 + 12 * len(tags) + 4
    extra_size = sum(len(v) * SIZES[t] for _, t, v in tags if len(v) * SIZES[t] > 4)
    first = at + extra_size
    starts = [first + sum(map(len, strips[:i])) for i in range(n)]
    head, extra = struct.pack("<2sHIH", b"II", 42, 8, len(tags)), b""
    for tag, t, v in tags:
        v = starts if tag == OFFSETS else v
        raw = bytes(v) if t == 2 else struct.pack(f"<{len(v)}{CODES[t]}", *v)
        head += struct.pack("<2HI", tag, t, len(v)) + (raw.ljust(4, b"\0") if len(raw) <= 4 else struct.pack("<I", at + len(extra)))
        extra += raw if len(raw) > 4 else b""
    return head + struct.pack("<I", 0) + extra + b"".join(strips)


def _lzw(data: bytes) -> bytes:
    """Codes of 9 to 12 bits, most significant bit first, growing one code early."""
    table: list[bytes] = []
    out, width, held, n, last = [], 9, 0, 0, b""
    for byte in data:
        held, n = held << 8 | byte, n + 8
        if n < width:
            continue
        n -= width
        code, held = held >> n, held & ((1 << n) - 1)
        if code == 256:
            table, width, last = [bytes([i]) for i in range(256)] + [b"", b""], 9, b""
            continue
        if code == 257:
            break
        word = table[code] if code < len(table) else last + last[:1]
        out.append(word)
        if last:
            table.append(last + word[:1])
        last = word
        # the entry that the next code makes is counted already
        width = min(12, max(9, (len(table) + 1).bit_length()))
    return b"".join(out)


def _plain(data: bytes, compression: int) -> bytes:
    if compression in (8, 32946):
        return zlib.decompress(data)
    if compression == 5:
        return _lzw(data)
    if compression == 1:
        return data
    raise ValueError(f"compression {compression} is not read")


def tags_of(data: bytes) -> tuple[str, dict]:
    """(byte order, tags of the first image); tags of unknown types are left out."""
    order = {b"II": "<", b"MM": ">"}[data[:2]]
    at = struct.unpack_from(f"{order}I", data, 4)[0]
    tags = {}
    for i in range(struct.unpack_from(f"{order}H", data, at)[0]):
        tag, t, n = struct.unpack_from(f"{order}2HI", data, at + 2 + 12 * i)
        if t in SIZES:
            place = at + 10 + 12 * i if n * SIZES[t] <= 4 else struct.unpack_from(f"{order}I", data, at + 10 + 12 * i)[0]
            tags[tag] = data[place : place + n] if t == 2 else struct.unpack_from(f"{order}{n}{CODES[t]}", data, place)
    return order, tags


def profile(data: bytes) -> dict:
    """width, height, count, dtype, srid, transform (x0, pixel width, y0, pixel height) and nodata; what a file lacks is None."""
    _, tags = tags_of(data)
    keys = dict(zip(tags.get(GEOKEYS, ())[4::4], tags.get(GEOKEYS, ())[7::4], strict=True))
    x, y = tags.get(TIEPOINT, (0, 0, 0, None, None))[3:5]
    kind = np.dtype(f"{'_uif'[tags.get(FORMAT, (1,))[0]]}{tags[BITS][0] // 8}").name
    place = (x, tags[SCALE][0], y, -tags[SCALE][1]) if SCALE in tags and x is not None else None
    nodata = tags[NODATA].rstrip(b"\0").decode() if NODATA in tags else None
    return {"width": tags[WIDTH][0], "height": tags[HEIGHT][0], "count": tags.get(SAMPLES, (1,))[0], "dtype": kind, "srid": keys.get(3072) or keys.get(2048), "transform": place, "nodata": nodata}


def decode(data: bytes) -> tuple[np.ndarray, dict]:
    """Bands (n, h, w) and profile of the first image: strips or tiles, bands apart or together, plain, deflated or LZW, predictor 1 or 2."""
    order, tags = tags_of(data)
    own = profile(data)
    w, h, n = own["width"], own["height"], own["count"]
    kind, apart = np.dtype(own["dtype"]).newbyteorder(order), tags.get(PLANAR, (1,))[0] == 2
    starts, sizes = (tags[TILE_OFFSETS], tags[TILE_COUNTS]) if TILE_OFFSETS in tags else (tags[OFFSETS], tags[COUNTS])
    part_w, part_h = (tags[TILE_WIDTH][0], tags[TILE_HEIGHT][0]) if TILE_OFFSETS in tags else (w, min(h, tags.get(ROWS, (h,))[0]))
    across, down = -(-w // part_w), -(-h // part_h)
    depth = 1 if apart else n
    bands = np.zeros((n, down * part_h, across * part_w), kind.newbyteorder("="))
    for i, (at, size) in enumerate(zip(starts, sizes, strict=True)):
        flat = np.frombuffer(_plain(data[at : at + size], tags.get(COMPRESSION, (1,))[0]), kind)
        block = flat[: len(flat) // (part_w * depth) * part_w * depth].reshape(-1, part_w, depth)[:part_h].astype(bands.dtype)
        if tags.get(PREDICTOR, (1,))[0] == 2:
            block = np.cumsum(block, axis=1, dtype=bands.dtype)
        plane, k = divmod(i, across * down)
        y, x = k // across * part_h, k % across * part_w
        for b in range(depth):
            bands[plane if apart else b, y : y + len(block), x : x + part_w] = block[..., b]
    return bands[:, :h, :w], own


def pixels(files: DataFrame, column: str = "content") -> DataFrame:
    """Rows (path, band, r, c, v) of GeoTIFF files (path, content), of which each is decoded by one task; unreadable ones are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column(column), strict=True):
                try:
                    bands, _ = decode(content.as_py())
                except (ValueError, KeyError, TypeError, struct.error, zlib.error):
                    continue
                for k, band in enumerate(bands):
                    r, c = np.divmod(np.arange(band.size), band.shape[1])
                    columns = [pa.array([path] * band.size), pa.array(np.full(band.size, k, "i4")), pa.array(r), pa.array(c), pa.array(band.reshape(-1).astype("f8"))]
                    yield pa.RecordBatch.from_arrays(columns, ["path", "band", "r", "c", "v"])

    return files.select("path", column).mapInArrow(run, "path string, band int, r long, c long, v double")


def rasters(cells: DataFrame, transform: tuple[float, float, float, float], srid: int, *keys: str, dtype: str = "uint8", size: int = 256) -> DataFrame:
    """(keys, i, j, content): chunks of size x size of pixels (keys, band, r, c, v) as GeoTIFF files, each with its own place; absent cells are 0."""
    cut = cells.withColumns({"i": F.floor(F.col("c") / size).cast("int"), "j": F.floor(F.col("r") / size).cast("int")})
    kind = T.StructType([*(cut.schema[k] for k in keys), cut.schema["i"], cut.schema["j"], T.StructField("content", T.BinaryType())])

    def run(group: pa.Table) -> pa.Table:
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        band, r, c = (group.column(x).to_numpy() for x in ("band", "r", "c"))
        out = np.zeros((int(band.max()) + 1, size, size), dtype)
        out[band, r - j * size, c - i * size] = group.column("v").to_numpy()
        x0, pw, y0, ph = transform
        content = encode(out, (x0 + i * size * pw, pw, y0 + j * size * ph, ph), srid)
        return pa.table([*(group.column(k).slice(0, 1) for k in keys), pa.array([i], pa.int32()), pa.array([j], pa.int32()), pa.array([content])], names=[*keys, "i", "j", "content"])

    return cut.groupBy(*keys, "i", "j").applyInArrow(run, kind)
