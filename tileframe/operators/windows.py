"""User functions over halo windows, nearest-neighbour warps, and pixel boxes."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import mercator as merc


def map_windows(pixels: DataFrame, func: Callable[[np.ndarray], np.ndarray], size: int, halo: int, nodata: float = 0.0, skip_share: float | None = None, *image: str) -> DataFrame:
    """(image, r, c, v) of func over windows of rasters (image, r, c, v), image being one key or several (img unless named): it gets the window with its halo and returns as many cells.

    Each pixel goes to the windows whose halo it is in, at most four if the halo is under half the size. Absent cells hold nodata. Only
    the interior is kept, and only cells that are in the input. With skip_share, windows whose share of nodata reaches it are left out.
    """
    keys = list(image or ("img",))
    near = lambda v: F.sequence(F.floor((v - halo) / size), F.floor((v + halo) / size))
    sent = pixels.select(*keys, "r", "c", F.col("v").cast("double").alias("v"), F.explode(near(F.col("r"))).alias("wr"), near(F.col("c")).alias("cs")).withColumn("wc", F.explode("cs")).drop("cs")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        top, left = int(pdf["wr"].iloc[0]) * size, int(pdf["wc"].iloc[0]) * size
        r, c = (pdf["r"] - top).to_numpy(), (pdf["c"] - left).to_numpy()
        whole = np.full((size + 2 * halo,) * 2, nodata)
        whole[r + halo, c + halo] = pdf["v"]
        inner = (r >= 0) & (r < size) & (c >= 0) & (c < size)
        if not inner.any() or skip_share is not None and (whole == nodata).mean() >= skip_share:
            return pdf.iloc[:0][[*keys, "r", "c", "v"]]
        out = func(whole)
        return pdf[inner].assign(v=out[r[inner] + halo, c[inner] + halo])[[*keys, "r", "c", "v"]]

    kind = T.StructType([*(sent.schema[k] for k in keys), sent.schema["r"], sent.schema["c"], T.StructField("v", T.DoubleType())])
    return sent.groupBy(*keys, "wr", "wc").applyInPandas(run, kind)


def warp(pixels: DataFrame, source: Column, source_srid: int, target: DataFrame, target_transform: Column, target_srid: int, image: str = "img") -> DataFrame:
    """(image, r, c, v) of the target's cells (image, r, c) by nearest neighbour: each looks up the source cell that its centre falls in; cells outside are left out.

    source and target_transform are geotransforms as of mercator.affine().
    """
    at = merc.from_rowcol(F.col("r"), F.col("c"), target_transform)
    p = merc.transform_coords(at["x"], at["y"], target_srid, source_srid)
    cell = merc.to_rowcol(p["x"], p["y"], source)
    asked = target.select(image, "r", "c", cell["row"].alias("sr"), cell["col"].alias("sc"))
    have = pixels.select(image, F.col("r").alias("sr"), F.col("c").alias("sc"), "v")
    return asked.join(have, [image, "sr", "sc"]).select(image, "r", "c", "v")


def boxes_to_pixels(boxes: DataFrame, transform: Column, width: int, height: int) -> DataFrame:
    """boxes (minx, miny, maxx, maxy) with pixel_box [min col, max row, max col, min row]; a box with a corner outside the raster goes."""
    low, high = merc.to_rowcol(F.col("minx"), F.col("miny"), transform), merc.to_rowcol(F.col("maxx"), F.col("maxy"), transform)
    inside = merc.inside(low["row"], low["col"], width, height) & merc.inside(high["row"], high["col"], width, height)
    return boxes.filter(inside).withColumn("pixel_box", F.array(low["col"], low["row"], high["col"], high["row"]))


def frames(numbers: DataFrame, fps: int, rate: int, prefix: str = "") -> DataFrame:
    """Of frame numbers (k), every fps // rate th, with zero-padded names."""
    step = max(1, fps // rate)
    return numbers.filter(F.col("k") % step == 0).withColumn("name", F.concat(F.lit(prefix), F.lpad((F.col("k") / step).cast("bigint").cast("string"), 6, "0"), F.lit(".jpg")))
