"""Web-Mercator tile, pixel and coordinate functions as Column expressions.

lat and lon are degrees, z is a zoom level, tiles are 256 pixels wide. Integer results truncate, as
tile numbers do; pixel results round half to even.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The sphere's radius in metres, metres a pixel at zoom 0, and the last latitude of the projection.
RADIUS = 6378137.0
METRES_PER_PIXEL = 156543.03392804097
LAST_LATITUDE = 85.0511
TILE = 256


def _n(z) -> Column:
    return F.pow(F.lit(2.0), F.lit(z) if isinstance(z, int) else z)


def zoom_for_resolution(metres: Column) -> Column:
    return F.log2(F.lit(METRES_PER_PIXEL) / metres).cast("int")


def tile_fraction(lat: Column, lon: Column, z) -> Column:
    """struct<x, y>: the position in tiles, not truncated."""
    phi = F.radians(lat)
    y = (1 - F.ln(F.tan(phi) + 1 / F.cos(phi)) / math.pi) / 2 * _n(z)
    return F.struct(((lon + 180) / 360 * _n(z)).alias("x"), y.alias("y"))


def tile_xy(lat: Column, lon: Column, z) -> Column:
    at = tile_fraction(lat, lon, z)
    return F.struct(at["x"].cast("bigint").alias("x"), at["y"].cast("bigint").alias("y"))


def _latitude(y: Column) -> Column:
    """Latitude of a height y from 0 (top) to 1 (bottom) of the square map."""
    return F.degrees(F.atan(F.sinh(math.pi * (1 - 2 * y))))


def tile_to_lonlat(x: Column, y: Column, z) -> Column:
    return F.struct((x / _n(z) * 360 - 180).alias("lon"), _latitude(y / _n(z)).alias("lat"))


def pixel_x(lon: Column, z) -> Column:
    return F.rint((lon + 180) / 360 * _n(z) * TILE).cast("bigint")


def pixel_y(lat: Column, z) -> Column:
    s = F.sin(F.radians(lat))
    return F.rint((0.5 - F.ln((1 + s) / (1 - s)) / (4 * math.pi)) * _n(z) * TILE).cast("bigint")


def pixel_to_lon(px: Column, z) -> Column:
    return px / (_n(z) * TILE) * 360 - 180


def pixel_to_lat(py: Column, z) -> Column:
    return _latitude(py / (_n(z) * TILE))


def opposite_corner(lat: Column, lon: Column, z, scale: int) -> Column:
    """The corner scale tiles to the south-east, from the pixel that both axes snap to."""
    step = TILE * scale
    return F.struct(pixel_to_lat(pixel_y(lat, z) + step, z).alias("lat"), pixel_to_lon(pixel_x(lon, z) + step, z).alias("lon"))


def opposite_corner_unsnapped(lat: Column, lon: Column, z, scale: int) -> Column:
    """The same with longitude advanced in degrees, without a snap."""
    step = TILE * scale
    return F.struct(pixel_to_lat(pixel_y(lat, z) + step, z).alias("lat"), (lon + degrees_per_pixel(z) * step).alias("lon"))


def degrees_per_pixel(z) -> Column:
    return F.lit(360.0) / (_n(z) * TILE)


def tile_corners(x: Column, y: Column, z) -> Column:
    """struct<tl, tr, bl, br> of struct<lat, lon>, latitudes clamped to the projection's."""
    clamp = lambda lat: F.greatest(F.lit(-LAST_LATITUDE), F.least(F.lit(LAST_LATITUDE), lat))
    west, east = x / _n(z) * 360 - 180, (x + 1) / _n(z) * 360 - 180
    north, south = clamp(_latitude(y / _n(z))), clamp(_latitude((y + 1) / _n(z)))
    point = lambda lat, lon, name: F.struct(lat.alias("lat"), lon.alias("lon")).alias(name)
    return F.struct(point(north, west, "tl"), point(north, east, "tr"), point(south, west, "bl"), point(south, east, "br"))


def tile_center(corners: Column) -> Column:
    """The mean of the corners, in degrees."""
    return F.struct(((corners["tl"]["lat"] + corners["bl"]["lat"]) / 2).alias("lat"), ((corners["tl"]["lon"] + corners["tr"]["lon"]) / 2).alias("lon"))


def pixel_to_geo(x: Column, y: Column, corners: Column, width: int = TILE, height: int = TILE) -> Column:
    """Linear in degrees on both axes."""
    tl, br = corners["tl"], corners["br"]
    return F.struct((tl["lon"] + x / width * (br["lon"] - tl["lon"])).alias("lon"), (tl["lat"] - y / height * (tl["lat"] - br["lat"])).alias("lat"))


def to_3857(lon: Column, lat: Column) -> Column:
    return F.struct((F.radians(lon) * RADIUS).alias("x"), (F.ln(F.tan(F.radians(45 + lat / 2))) * RADIUS).alias("y"))


def to_4326(x: Column, y: Column) -> Column:
    return F.struct(F.degrees(x / RADIUS).alias("x"), F.degrees(2 * F.atan(F.exp(y / RADIUS)) - math.pi / 2).alias("y"))


def transform_coords(x: Column, y: Column, source: int, target: int) -> Column:
    """struct<x, y> in the target reference system; only EPSG 4326 and 3857."""
    if {source, target} - {4326, 3857}:
        raise ValueError(f"no transformation from {source} to {target}")
    if source == target:
        return F.struct(x.alias("x"), y.alias("y"))
    return to_3857(x, y) if target == 3857 else to_4326(x, y)


def affine(minx: Column, miny: Column, maxx: Column, maxy: Column, width: int, height: int) -> Column:
    """A north-up geotransform from bounds."""
    zero = F.lit(0.0)
    return F.struct(minx.alias("x0"), ((maxx - minx) / width).alias("pw"), zero.alias("rx"), maxy.alias("y0"), zero.alias("ry"), ((miny - maxy) / height).alias("ph"))


def to_rowcol(x: Column, y: Column, t: Column) -> Column:
    return F.struct(F.floor((y - t["y0"]) / t["ph"]).alias("row"), F.floor((x - t["x0"]) / t["pw"]).alias("col"))


def from_rowcol(row: Column, col: Column, t: Column, offset: float = 0.5) -> Column:
    """Map coordinates of a cell: its centre with offset 0.5."""
    return F.struct((t["x0"] + (col + offset) * t["pw"]).alias("x"), (t["y0"] + (row + offset) * t["ph"]).alias("y"))


def inside(row: Column, col: Column, width: int, height: int) -> Column:
    return (row >= 0) & (row < height) & (col >= 0) & (col < width)


def bearing(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Initial compass bearing from one point to another, 0 to 360."""
    a, b, d = F.radians(lat1), F.radians(lat2), F.radians(lon2 - lon1)
    turn = F.atan2(F.sin(d) * F.cos(b), F.cos(a) * F.sin(b) - F.sin(a) * F.cos(b) * F.cos(d))
    return F.pmod(F.degrees(turn) + 360, F.lit(360.0))
