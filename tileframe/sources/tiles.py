"""Tile scans: a table of tiles through an injected fetcher, and images from folders.

A fetcher is a picklable function of a URL that returns bytes, or None for a missing tile. It may raise; a tile
is tried three times.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as txt
from ..operators import grid, raster
from . import png

ATTEMPTS = 3
PIXEL = ("r", "c", "red", "green", "blue", "alpha")
#: Half the width of the Mercator map in metres.
WORLD = 20037508.342789244


def url(template: str, z: Column, x: Column, y: Column) -> Column:
    out = F.lit(template)
    for name, value in (("{z}", z), ("{x}", x), ("{y}", y)):
        out = F.replace(out, F.lit(name), value.cast("string"))
    return out


def basemaps(spark: SparkSession, services: dict[str, tuple[str, bool]], free_only: bool = True) -> DataFrame:
    """(name, url) of services, each a URL and whether it needs a token, by name; free_only leaves out those that do."""
    rows = [(name, address) for name, (address, token) in sorted(services.items()) if not (free_only and token)]
    return spark.createDataFrame(rows, "name string, url string")


def fetch(tiles: DataFrame, template: str, fetcher: Callable[[str], bytes | None], skip_errors: bool = False, threads: int = 5) -> DataFrame:
    """tiles (z, x, y and others) with data: null where the tile is missing, and with skip_errors where it fails for good.

    A task asks for so many tiles at once and holds no more than that.
    """

    def get(address: str) -> bytes | None:
        for left in range(ATTEMPTS - 1, -1, -1):
            try:
                return fetcher(address) or None
            except Exception:
                if not left and not skip_errors:
                    raise
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with ThreadPoolExecutor(threads) as pool:
            for batch in batches:
                for at in range(0, batch.num_rows, threads):
                    part = batch.slice(at, threads)
                    data = pa.array(pool.map(get, part.column("url").to_pylist()), pa.binary())
                    yield pa.RecordBatch.from_arrays([*part.columns[:-1], data], [*part.schema.names[:-1], "data"])

    asked = tiles.withColumn("url", url(template, F.col("z"), F.col("x"), F.col("y")))
    return asked.mapInArrow(run, T.StructType([*tiles.schema.fields, T.StructField("data", T.BinaryType())]))


def decoded(tiles: DataFrame) -> DataFrame:
    """Pixels (r, c, red, green, blue, alpha) of PNG tiles (data and others, which stay); tiles that are missing or unreadable have none."""
    others = [f for f in tiles.schema.fields if f.name != "data"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, data in enumerate(batch.column("data").to_pylist()):
                try:
                    image = png.decode(data) if data else None
                except (ValueError, KeyError, struct.error, zlib.error):
                    image = None
                if image is None:
                    continue
                r, c = np.divmod(np.arange(image.shape[0] * image.shape[1]), image.shape[1])
                flat = image.reshape(len(r), -1).astype("i4")
                bands = [pa.array(flat[:, k]) for k in range(3)] + [pa.array(flat[:, 3]) if flat.shape[1] > 3 else pa.nulls(len(r), pa.int32())]
                same = [pa.repeat(batch.column(f.name)[i], len(r)) for f in others]
                yield pa.RecordBatch.from_arrays([*same, pa.array(r), pa.array(c), *bands], [*[f.name for f in others], *PIXEL])

    fields = [T.StructField(x, T.LongType() if x in "rc" else T.IntegerType()) for x in PIXEL]
    return tiles.select(*[f.name for f in others], "data").mapInArrow(run, T.StructType([*others, *fields]))


def mosaic(tiles: DataFrame, x0: float, y0: float, x1: float, y1: float, z: int, size: int = 256) -> tuple[DataFrame, tuple[float, float, float, float]]:
    """(pixels (row, col, red, green, blue, alpha), geotransform in Mercator metres) of fetched tiles (x, y, data), cropped to a box in fractional tiles."""
    corner = int(x0 // 1), int(y0 // 1)
    whole = raster.tile_pixels(decoded(tiles), F.struct(F.lit(corner[0]).alias("minx"), F.lit(corner[1]).alias("miny")), size)
    step = 2 * WORLD / (2**z * size)
    left, top = corner[0] * size + round(size * (x0 - corner[0])), corner[1] * size + round(size * (y0 - corner[1]))
    return raster.crop(whole, x0, y0, x1, y1, corner, size), (left * step - WORLD, step, WORLD - top * step, -step)


def of_blocks(blocks: DataFrame, z: int) -> DataFrame:
    """(block, z, x, y, i, j) of the tiles of blocks (idx, x0, y0, x1, y1 in fractional tiles): whole tiles, i along x and j along y."""
    t = grid.tiles_of(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"))
    out = blocks.select(F.col("idx").alias("block"), "x0", "y0", F.explode(t).alias("t")).select("block", F.lit(z).alias("z"), "t.x", "t.y", "x0", "y0")
    return out.withColumns({"i": (F.col("x") - F.floor("x0")).cast("int"), "j": (F.col("y") - F.floor("y0")).cast("int")}).drop("x0", "y0")


def images(spark: SparkSession, path: str) -> DataFrame:
    """(folder, chunk_name, i, j, data) of the chunk images below a path; other files are left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.tif").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    at = txt.chunk_indices(name)
    return files.select(F.element_at(F.split("path", "/"), -3).alias("folder"), name.alias("chunk_name"), at["i"].alias("i"), at["j"].alias("j"), F.col("content").alias("data")).filter("i is not null")
