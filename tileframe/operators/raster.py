"""Sparse rasters (img, r, c, values): stitching, merging, scaling and segment aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import kernels, windows


def stitch(chunks: DataFrame, size: int) -> DataFrame:
    """Chunk pixels (i, j, r, c): i counts chunks along x, j along y. Adds the whole raster's row and col."""
    return chunks.withColumn("row", F.col("r") + size * F.col("j")).withColumn("col", F.col("c") + size * F.col("i"))


def unstitch(pixels: DataFrame, size: int) -> DataFrame:
    """Adds the chunk (i, j) of each pixel and its place in it."""
    i, j = F.floor(F.col("c") / size), F.floor(F.col("r") / size)
    return pixels.select("*", i.alias("i"), j.alias("j"), (F.col("r") - j * size).alias("chunk_r"), (F.col("c") - i * size).alias("chunk_c"))


def mask_or(pixels: DataFrame, *keys: str) -> DataFrame:
    return pixels.groupBy(*keys).agg(F.max("m").alias("m"))


def merge_last(pixels: DataFrame, order: str, *keys: str) -> DataFrame:
    """A mosaic in which a later file wins."""
    return pixels.groupBy(*keys).agg(F.max_by("v", order).alias("v"))


def blend(a: Column, b: Column, alpha: float) -> Column:
    """Of two 8-bit values, rounded half to even and clamped."""
    return F.greatest(F.lit(0), F.least(F.lit(255), F.rint(F.lit(alpha) * a + F.lit(1 - alpha) * b).cast("int")))


def stretch(pixels: DataFrame, *keys: str) -> DataFrame:
    """Adds byte: v from its image's minimum to maximum as 0 to 255, truncated; null for a constant image."""
    ends = pixels.groupBy(*keys).agg(F.min("v").alias("least"), F.max("v").alias("most"))
    scaled = F.try_divide(F.col("v") - F.col("least"), F.col("most") - F.col("least")) * 255
    return pixels.join(ends, list(keys)).withColumn("byte", scaled.cast("int")).drop("least", "most")


def dtype(least: Column, most: Column) -> Column:
    """The narrowest type of the ladder that holds a range."""
    ladder = ((0, 1, "float32"), (0, 255, "uint8"), (-128, 127, "int8"), (0, 65535, "uint16"), (-32768, 32767, "int16"))
    out = F
    for low, high, name in ladder:
        out = out.when((least >= low) & (most <= high), name)
    return out.otherwise("float64")


def label_dtype(labels: Column) -> Column:
    return F.when(labels <= 255, "uint8").when(labels <= 65535, "uint16").otherwise("uint32")


def nodata_share(pixels: DataFrame, value: float, *keys: str) -> DataFrame:
    return pixels.groupBy(*keys).agg(F.avg((F.col("v") == value).cast("double")).alias("nodata"))


def luma(r: Column, g: Column, b: Column) -> Column:
    return 0.299 * r + 0.587 * g + 0.114 * b


def label_boxes(pixels: DataFrame, *keys: str) -> DataFrame:
    """Bounding box and size of every label, background included."""
    ends = [f(c).alias(f"{n}_{c}") for c in ("r", "c") for f, n in ((F.min, "min"), (F.max, "max"))]
    return pixels.groupBy(*keys).agg(*ends, F.count("*").alias("size"))


def band_means(pixels: DataFrame, bands: list[str], *keys: str) -> DataFrame:
    """Means over each label's whole bounding box, with zeros outside its mask."""
    box = (F.max("r") - F.min("r") + 1) * (F.max("c") - F.min("c") + 1)
    return pixels.groupBy(*keys).agg(*[(F.sum(b) / box).alias(b) for b in bands])


def local_entropy(pixels: DataFrame, radius: int, *keys: str, size: int = 256) -> DataFrame:
    """Pixels (keys, r, c, g) with ent: the entropy in bits of the values g, from 0 up, of those present in the disk around each.

    It is computed in windows of bounded size that carry a halo of the radius. Only pixels present (the mask) count and have a value.
    """
    rows = pixels.select(*keys, "r", "c", F.col("g").cast("double").alias("v"))
    found = windows.map_windows(rows, lambda v: kernels.entropy(v.astype("i8"), radius), max(size, 2 * radius), radius, -1.0, None, *keys)
    return pixels.join(found.withColumnRenamed("v", "ent"), [*keys, "r", "c"])


def entropy_score(pixels: DataFrame, above: float, *keys: str) -> DataFrame:
    """Sum of the entropies above a limit over the number of pixels. Limits are 5.2 at radius 5, and 0 at radius 30 for plantations."""
    return pixels.groupBy(*keys).agg((F.coalesce(F.sum(F.when(F.col("ent") > above, F.col("ent"))), F.lit(0.0)) / F.count("*")).alias("score"))


def pond_entropy(pixels: DataFrame, *keys: str) -> DataFrame:
    """(keys, entropy) of images (keys, r, c, red, green, blue, m): the score at radius 5 within the mask m, after a stretch of the whole image to bytes.

    An image without a mask has 0, and so has one whose grey is the same everywhere.
    """
    gray = pixels.withColumn("gray", F.rint(luma(F.col("red"), F.col("green"), F.col("blue"))))
    ends = gray.groupBy(*keys).agg(F.min("gray").alias("least"), F.max("gray").alias("most"))
    byte = F.rint(F.try_divide(F.col("gray") - F.col("least"), F.col("most") - F.col("least")) * 255)
    own = gray.filter("m > 0").join(ends, list(keys)).select(*keys, "r", "c", F.coalesce(byte, F.lit(0.0)).cast("int").alias("g"))
    score = entropy_score(local_entropy(own, 5, *keys), 5.2, *keys)
    return ends.select(*keys).join(score, list(keys), "left").select(*keys, F.coalesce("score", F.lit(0.0)).alias("entropy"))


def tile_pixels(tiles: DataFrame, bbox: Column, size: int, *keys: str) -> DataFrame:
    """Pixels (keys, x, y, r, c, red, green, blue, alpha) of tiles as those of their mosaic, row and col being counted from the corner of bbox (minx, miny in tiles).

    alpha is null for tiles without one. A tile with alpha that is empty, all transparent or black all over, is left out; one without is pasted as it is.
    """
    tile = Window.partitionBy(*keys, "x", "y")
    most = lambda c: F.max(c).over(tile) == 0
    black = most("red") & most("green") & most("blue")
    empty = F.coalesce(F.max("alpha").over(tile).isNotNull() & (most("alpha") | black), F.lit(False))
    kept = tiles.withColumn("__empty", empty).filter("not __empty").drop("__empty")
    return kept.withColumns({"row": F.col("r") + size * (F.col("y") - bbox["miny"]), "col": F.col("c") + size * (F.col("x") - bbox["minx"])})


def is_empty(tiles: DataFrame, *keys: str) -> DataFrame:
    """(keys, empty) of images (keys, red, green, blue, alpha): whether all is black, or all is transparent where there is alpha."""
    black = (F.max("red") == 0) & (F.max("green") == 0) & (F.max("blue") == 0)
    return tiles.groupBy(*keys).agg((black | F.coalesce(F.max("alpha") == 0, F.lit(False))).alias("empty"))


def crop(pixels: DataFrame, x0: float, y0: float, x1: float, y1: float, bbox: tuple[int, int], size: int) -> DataFrame:
    """Mosaic pixels (row, col) within a box in fractional tiles, counted from its corner; an alpha that is 255 throughout becomes null."""
    left, top = round(size * (x0 - bbox[0])), round(size * (y0 - bbox[1]))
    width, height = round(size * (x1 - x0)), round(size * (y1 - y0))
    own = pixels.filter(F.col("col").between(left, left + width - 1) & F.col("row").between(top, top + height - 1))
    own = own.withColumns({"row": F.col("row") - top, "col": F.col("col") - left})
    opaque = own.agg(F.coalesce(F.min("alpha") == 255, F.lit(True)).alias("__opaque"))
    return own.crossJoin(F.broadcast(opaque)).withColumn("alpha", F.when(~F.col("__opaque"), F.col("alpha"))).drop("__opaque")


def mask_crop(pixels: DataFrame, *keys: str) -> DataFrame:
    """Each label's cut-out: the pixels of its bounding box (keys, label, r, c and colours), with zeros and alpha 0 outside its mask.

    Rows go to the labels whose box they are in by the rows and columns of the boxes, cell by cell.
    """
    box = label_boxes(pixels.filter("label > 0"), *keys, "label")
    cells = box.select(*keys, F.col("label").alias("of"), F.explode(F.sequence("min_r", "max_r")).alias("r"), F.sequence("min_c", "max_c").alias("cs")).withColumn("c", F.explode("cs")).drop("cs")
    own = F.col("label").eqNullSafe(F.col("of"))
    colour = {c: F.when(own, F.col(c)).otherwise(0) for c in ("red", "green", "blue")}
    out = cells.join(pixels, [*keys, "r", "c"], "left").select(*keys, F.col("of").alias("segment"), "r", "c", *[v.alias(k) for k, v in colour.items()], F.when(own, 255).otherwise(0).alias("alpha"))
    return out


def channels(pixels: DataFrame, *keys: str) -> DataFrame:
    """Rows (keys, r, c, band, v) of separate bands as one row a pixel with the first three; further bands go."""
    bands = [F.max(F.when(F.col("band") == i, F.col("v"))).alias(name) for i, name in enumerate(("red", "green", "blue"))]
    return pixels.filter("band < 3").groupBy(*keys, "r", "c").agg(*bands)


def exposed_edges(pixels: DataFrame, *keys: str) -> DataFrame:
    """Perimeter of the set of pixels: sides that no other pixel of the group shares."""
    sides = F.array(*[F.struct((F.col("r") * 2 + a).alias("y"), (F.col("c") * 2 + b).alias("x")) for a, b in ((0, 1), (0, -1), (1, 0), (-1, 0))])
    shared = pixels.withColumn("side", F.explode(sides)).groupBy(*keys, "side").agg(F.count("*").alias("n"))
    return shared.filter("n = 1").groupBy(*keys).agg(F.count("*").alias("perimeter"))
