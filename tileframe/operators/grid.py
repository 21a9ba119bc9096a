"""Block grids, tile enumeration, windows over rasters, and ordinals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..functions import mercator as merc

#: The grid's steps are sized by this many tiles, whatever a block's own scale is.
GRID_TILES = 16
INDEX_ROWS = 100_000
MOST_RANGES = 1024
FLAGS = ("overall_status", "download_status_17", "download_status_18", "model_status", "segmentation_status", "postprocessing_status", "plantation_status")


def block_grid(bounds: DataFrame, z: int, scale: int, snap: bool = True) -> DataFrame:
    """Blocks (k, m, tl, br) over each row (minx, miny, maxx, maxy) of bounds, in closed form.

    The grid starts at the north-west corner, with snap at that of its tile, and has n + 1 rows and columns, n
    being how many blocks of GRID_TILES tiles the longer side needs.
    """
    step = merc.TILE * scale
    tile = merc.tile_xy(F.col("maxy"), F.col("minx"), z)
    corner = merc.tile_to_lonlat(F.col("tile.x"), F.col("tile.y"), z) if snap else F.struct(F.col("minx").alias("lon"), F.col("maxy").alias("lat"))
    start = bounds.withColumn("tile", tile).withColumn("corner", corner)
    start = start.withColumn("px0", merc.pixel_x(F.col("corner.lon"), z)).withColumn("py0", merc.pixel_y(F.col("corner.lat"), z))
    across = F.greatest(F.abs(F.col("px0") - merc.pixel_x(F.col("maxx"), z)), F.abs(merc.pixel_y(F.col("miny"), z) - F.col("py0")))
    n = F.ceil(across / merc.TILE / GRID_TILES).cast("int")
    ks = start.withColumn("n", n).withColumn("k", F.explode(F.sequence(F.lit(0), F.col("n")))).withColumn("m", F.explode(F.sequence(F.lit(0), F.col("n"))))

    def at(k: Column, m: Column) -> Column:
        return F.struct(merc.pixel_to_lat(F.col("py0") + step * k, z).alias("lat"), merc.pixel_to_lon(F.col("px0") + step * m, z).alias("lon"))

    return ks.select("k", "m", at(F.col("k"), F.col("m")).alias("tl"), at(F.col("k") + 1, F.col("m") + 1).alias("br"))


def in_region(blocks: DataFrame, ring: Column) -> DataFrame:
    """Blocks that meet a polygon: its bounds first, then the exact predicate."""
    box = geo.bounds(ring)
    west, east, north, south = F.col("tl.lon"), F.col("br.lon"), F.col("tl.lat"), F.col("br.lat")
    near = (west <= box["maxx"]) & (east >= box["minx"]) & (south <= box["maxy"]) & (north >= box["miny"])
    return blocks.filter(near & geo.box_intersects(west, south, east, north, ring))


def dense_index(df: DataFrame, first: str, *rest: str, name: str = "index") -> DataFrame:
    """Adds a gapless 0-based index in the order of the columns. first is numeric.

    Rows are numbered within ranges of first, whose cuts come from one approximate aggregation, and ranges are
    moved by the rows before them, so no task orders the whole table.
    """
    parts = max(1, min(MOST_RANGES, df.count() // INDEX_ROWS))
    steps = ", ".join(str(i / parts) for i in range(1, parts))
    cuts = sorted(set(df.select(F.expr(f"percentile_approx({first}, array({steps}))")).first()[0] or [])) if parts > 1 else []
    part = F.coalesce(F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= F.col(first))), F.lit(-1)) if cuts else F.lit(0)
    ranged = df.withColumn("__part", part)
    sizes = dict(ranged.groupBy("__part").count().collect())
    before, total = [], 0
    for p in range(-1, len(cuts) + 1):
        before.append(total)
        total += sizes.get(p, 0)
    offset = F.get(F.array(*[F.lit(x).cast("bigint") for x in before]), F.col("__part") + 1)
    rank = F.row_number().over(Window.partitionBy("__part").orderBy(first, *rest))
    return ranged.withColumn(name, offset + rank - 1).drop("__part")


def indexed_blocks(blocks: DataFrame) -> DataFrame:
    """Blocks with their dense index, by row and then column, and all status flags unset."""
    out = dense_index(blocks, "k", "m", name="idx")
    return out.select(F.col("idx").cast("int").alias("idx"), "tl", "br", *[F.lit(False).alias(f) for f in FLAGS])


def tiles_of(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """array<struct<x, y>>: the tiles of a box in fractional tile numbers, column by column."""
    span = lambda a, b: F.sequence(F.floor(a), F.greatest(F.floor(a), F.ceil(b) - 1))
    return F.flatten(F.transform(span(x0, x1), lambda x: F.transform(span(y0, y1), lambda y: F.struct(x.alias("x"), y.alias("y")))))


def tile_range(minx: Column, miny: Column, maxx: Column, maxy: Column, z: int) -> Column:
    """struct<xmin, xmax, ymin, ymax> of the whole tiles that a box's four corners are in; both ends belong to it."""
    tiles = [merc.tile_xy(lat, lon, z) for lat in (miny, maxy) for lon in (minx, maxx)]
    ends = [f(*[t[c] for t in tiles]).alias(f"{c}{n}") for c in "xy" for n, f in (("min", F.least), ("max", F.greatest))]
    return F.struct(*ends)


def tiles_within(span: Column) -> Column:
    """array<struct<x, y>> of a tile_range(), both ends included."""
    return F.flatten(F.transform(F.sequence(span["xmin"], span["xmax"]), lambda x: F.transform(F.sequence(span["ymin"], span["ymax"]), lambda y: F.struct(x.alias("x"), y.alias("y")))))


def sample_grid(height: Column, width: Column, sh: int, sw: int, bound: int) -> Column:
    """array of overlapping windows: origin, size with halo, and what to trim of the halo."""
    ys, xs = F.sequence(F.lit(-bound), height - 1, F.lit(sh)), F.sequence(F.lit(-bound), width - 1, F.lit(sw))
    h, w = sh + 2 * bound, sw + 2 * bound

    def window(y: Column, x: Column) -> Column:
        trim = lambda at, size, whole: F.greatest(F.lit(bound), at + size - whole)
        return F.struct(y.alias("y"), x.alias("x"), F.lit(h).alias("h"), F.lit(w).alias("w"), F.lit(bound).alias("top"), trim(y, h, height).alias("bottom"), F.lit(bound).alias("left"), trim(x, w, width).alias("right"))

    return F.flatten(F.transform(ys, lambda y: F.transform(xs, lambda x: window(y, x))))


def split_offsets(size: Column, tile: int, overlap: int) -> Column:
    """Where the tiles of one axis start; the last is moved back to have its full size."""
    step = tile - overlap
    n = F.floor((size - overlap) / step) + F.when((size - overlap) % step > 0, 1).otherwise(0)
    return F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1), lambda k: F.greatest(F.lit(0).cast("bigint"), F.least(k * step, size - tile)))


def slices(n: Column, size: int) -> Column:
    """array<struct<start, end>> of [start, start + size), the last clamped to n."""
    starts = F.sequence(F.lit(0).cast("bigint"), n - 1, F.lit(size).cast("bigint"))
    return F.transform(starts, lambda a: F.struct(a.alias("start"), F.least(a + size, n).alias("end")))


def region_ring(points) -> Column:
    return F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in points])


def bounds_frame(spark: SparkSession, points) -> DataFrame:
    xs, ys = [p[0] for p in points], [p[1] for p in points]
    return spark.createDataFrame([(min(xs), min(ys), max(xs), max(ys))], "minx double, miny double, maxx double, maxy double")
