"""The flows' CSV tables: block status, tile mappings, detections and region properties.

Schemas are given, not inferred. A directory of part files is one table; write() with single gives one file, for tables that a task holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..functions import text as txt
from ..operators.grid import FLAGS

# The columns of the stored tables.
STATUS = "`index` int, points string, " + ", ".join(f"{flag} boolean" for flag in FLAGS)
MAPPING = "`Chunk Name` string, `Tile Name` string"
CORNERS = ("Center", "Top Left", "Top Right", "Bottom Left", "Bottom Right")
DETECTION_COLUMNS = ("Tile Name", "Predicted Class", *(f"{corner} {axis}" for corner in CORNERS for axis in ("Latitude", "Longitude")))


def write(df: DataFrame, path: str, single: bool = False) -> None:
    """With a header and no index."""
    (df.coalesce(1) if single else df).write.mode("overwrite").option("header", True).csv(path)


def read_status(spark: SparkSession, path: str) -> DataFrame:
    """Blocks (idx, tl, br, flags); stored points come as structs, null if they cannot be read."""
    rows = spark.read.schema(STATUS).option("header", True).csv(path)
    at = txt.corner_pair(F.col("points"))
    return rows.select(F.col("index").alias("idx"), at["tl"].alias("tl"), at["br"].alias("br"), *FLAGS)


def write_status(blocks: DataFrame, path: str) -> None:
    write(blocks.select(F.col("idx").alias("index"), txt.corner_text(F.col("tl"), F.col("br")).alias("points"), *FLAGS), path, single=True)


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """(chunk_name, tile_name) of a file, or of several below a path with their folder."""
    rows = spark.read.schema(MAPPING).option("header", True).option("recursiveFileLookup", True).csv(path)
    folder = F.element_at(F.split("_metadata.file_path", "/"), -2)
    return rows.select(F.col("Chunk Name").alias("chunk_name"), F.col("Tile Name").alias("tile_name"), folder.alias("folder"))


def write_mapping(chunks: DataFrame, path: str) -> None:
    write(chunks.select(F.col("chunk_name").alias("Chunk Name"), F.col("tile_name").alias("Tile Name")), path, single=True)


def write_detections(detections: DataFrame, path: str) -> int:
    """detections (tile_name, cls, corners, ring) as wide rows, as many X_n, Y_n as the longest ring has vertices; returns that number.

    corners is a struct of center, tl, tr, bl and br, each of lat and lon.
    """
    most = detections.agg(F.max(F.size("ring"))).first()[0] or 0
    places = [F.col(f"corners.{name}.{axis}") for name in ("center", "tl", "tr", "bl", "br") for axis in ("lat", "lon")]
    columns = [c.alias(name) for name, c in zip(DETECTION_COLUMNS, [F.col("tile_name"), F.col("cls"), *places], strict=True)]
    write(detections.select(*columns, *geo.wide(F.col("ring"), most)), path)
    return most


def read_detections(spark: SparkSession, path: str) -> DataFrame:
    """(tile_name, cls, lat, lon of the centre, ring up to the first null vertex); the header tells how wide rows are."""
    header = spark.read.option("header", True).csv(path).columns
    most = sum(name.startswith("X_") for name in header)
    doubles = {name for name in header if name not in DETECTION_COLUMNS[:2]}
    rows = spark.read.schema(", ".join(f"`{n}` {'double' if n in doubles else 'string'}" for n in header)).option("header", True).csv(path)
    ring = geo.from_wide(most) if most else F.array().cast("array<struct<x: double, y: double>>")
    return rows.select(F.col("Tile Name").alias("tile_name"), F.col("Predicted Class").alias("cls"), F.col("Center Latitude").alias("lat"), F.col("Center Longitude").alias("lon"), ring.alias("ring"))
