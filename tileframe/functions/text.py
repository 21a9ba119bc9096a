"""Names, paths and identifiers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that asset names keep, and where task identifiers stand, first match first.
UNSAFE = r"[^a-zA-Z0-9 .,:;_\-]"
TASK_PATTERNS = (r"Started upload task with ID: ([a-zA-Z0-9_]+)", r"Task ID: ([a-zA-Z0-9_]+)", r"ID: ([a-zA-Z0-9_]+)")


def valid_text(s: Column) -> Column:
    return F.replace(F.regexp_replace(s, UNSAFE, ""), F.lit(" "), F.lit("_"))


def asset_path(prefix: str, *parts: Column) -> Column:
    """prefix and the cleaned lower-case parts joined by slashes; null parts are left out."""
    return F.concat_ws("/", F.lit(prefix.rstrip("/")), *[valid_text(F.lower(p)) for p in parts])


def task_id(s: Column) -> Column:
    """What the first of the patterns that matches captures, else null."""
    return F.coalesce(*[F.nullif(F.regexp_extract(s, p, 1), F.lit("")) for p in TASK_PATTERNS])


def raw_url(url: Column) -> Column:
    """A repository host's page of a file to the address of its content."""
    blob = url.startswith("https://github.com") & url.contains("/blob/")
    return F.when(blob, F.replace(F.replace(url, F.lit("github.com"), F.lit("raw.githubusercontent.com")), F.lit("/blob/"), F.lit("/"))).otherwise(url)


def chunk_name(i: Column, j: Column) -> Column:
    return F.format_string("chunk_%d_%d.tif", i, j)


def tile_name(z: Column, x: Column, y: Column) -> Column:
    return F.format_string("tile_%d_%d_%d.tif", z, x, y)


def chunk_indices(name: Column) -> Column:
    """struct<i, j>, null if the name isn't a chunk's."""
    part = lambda k: F.regexp_extract(name, r"chunk_(\d+)_(\d+)\.tif", k).cast("int")
    return F.when(name.rlike(r"chunk_\d+_\d+\.tif"), F.struct(part(1).alias("i"), part(2).alias("j")))


def tile_numbers(name: Column, exact: bool = False) -> Column:
    """struct<x_tile, y_tile> from a tile's name or path, null if it has none.

    As for ponds: of at least 4 parts of the last path element, the third, and the fourth up to a dot or space. With exact, as for
    wells: of just 4 parts of the whole name without its .tif, the last two.
    """
    parts = F.split(F.replace(name, F.lit(".tif"), F.lit("")) if exact else F.element_at(F.split(name, "/"), -1), "_")
    last = F.get(parts, F.lit(3))
    x, y = F.get(parts, F.lit(2)).try_cast("bigint"), (last if exact else F.split_part(F.trim(F.split_part(last, F.lit("."), F.lit(1))), F.lit(" "), F.lit(1))).try_cast("bigint")
    enough = F.size(parts) == 4 if exact else F.size(parts) >= 4
    return F.when(enough & x.isNotNull() & y.isNotNull(), F.struct(x.alias("x_tile"), y.alias("y_tile")))


def corner_pair(text: Column) -> Column:
    """struct<tl, br> of lat and lon from a stored "((lat, lon), (lat, lon))"; null if it has not four numbers."""
    numbers = F.transform(F.regexp_extract_all(text, F.lit(r"([-+]?\d+(?:\.\d+)?(?:[eE][-+]?\d+)?)"), F.lit(1)), lambda x: x.cast("double"))
    at = lambda i: F.struct(F.get(numbers, F.lit(i)).alias("lat"), F.get(numbers, F.lit(i + 1)).alias("lon"))
    return F.when(F.size(numbers) == 4, F.struct(at(0).alias("tl"), at(2).alias("br")))


def corner_text(tl: Column, br: Column) -> Column:
    """The text that corner_pair() reads."""
    pair = lambda p: F.concat(F.lit("("), p["lat"].cast("string"), F.lit(", "), p["lon"].cast("string"), F.lit(")"))
    return F.concat(F.lit("("), pair(tl), F.lit(", "), pair(br), F.lit(")"))


def name_numbers(name: Column) -> Column:
    """The four integers before a name's last part, dots taken as underscores."""
    parts = F.split(F.replace(name, F.lit("."), F.lit("_")), "_")
    return F.array(*[F.element_at(parts, -k).try_cast("int") for k in (5, 4, 3, 2)])
