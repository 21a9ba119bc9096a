"""The three layers as dataflows: field boundaries, ponds and wells.

Models are not part of this library: a detector and a segmenter are functions given by the caller. Each flow is one lazy
plan over tables of chunks; what the caller writes by block can be resumed with run_pending().
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..functions import mercator as merc
from ..functions import text as txt
from ..operators import grid, raster, rules, vector

DETECTION = "block long, z int, x_tile long, y_tile long, cls string, conf double, entropy double, ring array<struct<x: double, y: double>>"
SEGMENTED = "block long, r long, c long, extent double, boundary double"
SLICE = 2000
MERGE = 200

#: A function of a pandas frame of chunks that returns rows of DETECTION or SEGMENTED.
Model = Callable[[pd.DataFrame], pd.DataFrame]


def infer(chunks: DataFrame, model: Model, schema: str, batch: int = 32) -> DataFrame:
    """Runs a model over chunks in batches; a chunk whose data is null is skipped."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), batch):
                yield model(frame.iloc[at : at + batch])

    return chunks.filter("data is not null").mapInPandas(run, schema)


def blocks(spark: SparkSession, ring: list[tuple[float, float]], z: int, scale: int) -> DataFrame:
    """Indexed blocks of a region (lon, lat), with flags, all unset."""
    near = grid.in_region(grid.block_grid(grid.bounds_frame(spark, ring), z, scale), grid.region_ring(ring))
    return grid.indexed_blocks(near)


def placed(detections: DataFrame, z: int) -> DataFrame:
    """Detections with their rings in degrees, and only those with three finite vertices."""
    out = detections.withColumn("ring", geo.finite(F.col("ring"))).filter(F.size("ring") >= 3)
    out = out.withColumn("__corners", merc.tile_corners(F.col("x_tile"), F.col("y_tile"), z))
    degrees = F.transform("ring", lambda p: merc.pixel_to_geo(p.x, p.y, F.col("__corners")))
    return out.withColumn("ring", F.transform(degrees, lambda p: F.struct(p.lon.alias("x"), p.lat.alias("y")))).drop("__corners")


def wells(detections: DataFrame, z: int = 18) -> DataFrame:
    """(Class, x, y, srid): a point in Mercator metres for each confident well, the mean of its vertices."""
    own = placed(rules.confident(detections.filter("cls = 'Wells'")), z).withColumn("at", geo.vertex_mean(F.col("ring")))
    p = merc.to_3857(F.col("at.x"), F.col("at.y"))
    return own.select(F.col("cls").alias("Class"), p["x"].alias("x"), p["y"].alias("y"), F.lit(3857).alias("srid"))


def ponds(detections: DataFrame, z: int = 17, distance: float = 0.0005, keep_null_entropy: bool = False) -> DataFrame:
    """(cluster, geom, srid): confident ponds of low entropy, those close to each other merged; classes are lost in the merge."""
    own = rules.gated(rules.confident(detections.filter("cls in ('Dry', 'Wet')")), keep_null_entropy)
    numbered = grid.dense_index(placed(own, z).withColumn("__k", F.array_min(F.transform("ring", lambda p: p.x))), "__k", "ring", name="id")
    return vector.dissolve(numbered.select("id", "ring"), distance, cell=20 * distance).withColumn("srid", F.lit(4326))


def merge_blocks(layers: DataFrame, n_blocks: int, district: str, block: str) -> DataFrame:
    """layers (layer, block and others) with the name of the merged layer that each row goes to: all blocks in one, or MERGE blocks each; rows of no block go."""
    start = F.floor(F.col("block") / MERGE) * MERGE if n_blocks > MERGE else F.lit(0)
    name = F.lit(f"{district}_{block}_boundaries")
    if n_blocks > MERGE:
        name = F.concat_ws("_", name, start.cast("string"), F.least(start + MERGE, F.lit(n_blocks)).cast("string"))
    return layers.filter((F.col("block") >= 0) & (F.col("block") < n_blocks)).withColumn("name", name)


def segment_features(pixels: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """The feature table of segments (block, label) from pixels (block, r, c, label, red, green, blue): shape, colour, both entropies, straight lines and class.

    Lines (block, label, x1, y1, x2, y2) are found in the pixels unless given.
    """
    keys = ["block", "label"]
    own = pixels.filter("label > 0")
    colour = raster.band_means(own, ["red", "green", "blue"], *keys)
    gray = own.select(*keys, "r", "c", F.rint(raster.luma(F.col("red"), F.col("green"), F.col("blue"))).cast("int").alias("g"))
    near = raster.entropy_score(raster.local_entropy(gray, 5, *keys), 5.2, *keys).withColumnRenamed("score", "ent")
    wide = raster.entropy_score(raster.local_entropy(gray, 30, *keys), 0.0, *keys).withColumnRenamed("score", "ent_pl")
    shape = vector.shape_features(own, *keys)
    size = own.groupBy(*keys).agg(F.count("*").alias("size"))
    out = size.join(colour, keys).join(near, keys).join(wide, keys).join(shape, keys)
    lines = vector.segment_lines(gray, "block") if lines is None else lines
    straight = lines.groupBy(*keys).agg(F.count("*").alias("num_lines"))
    right = rules.right_angles(lines.withColumn("__key", F.struct(*keys)), "__key").select("__key.*", F.col("pairs").alias("num_rt_ang"))
    out = out.join(straight, keys, "left").join(right, keys, "left")
    out = out.withColumns({"num_lines": F.coalesce("num_lines", F.lit(0)), "num_rt_ang": F.coalesce("num_rt_ang", F.lit(0))})
    kind = rules.classify(F.col("rect"), F.col("size"), F.col("ent"), F.col("num_lines"), F.col("red") > F.col("green"))
    return out.withColumns({"class": kind, "redness": F.col("red"), "greeness": F.col("green"), "blueness": F.col("blue"), "red": F.try_divide(F.col("red"), F.col("green"))}).drop("green", "blue")


def farm(probabilities: DataFrame, image: DataFrame, plantation: DataFrame | None = None, lines: DataFrame | None = None, placed_by: DataFrame | None = None) -> DataFrame:
    """(block, layer, value, class, geom) of field boundaries: segments of the probability maps classified by their image, and the plantation mask (block, r, c, label).

    With placed_by (block, transform), the geotransforms of the blocks in Mercator metres, geom is in degrees; else it is in pixel corners.
    """
    labels = vector.segment_images(probabilities, "block")
    features = segment_features(labels.join(image, ["block", "r", "c"]), lines)
    polygons = vector.polygonise(labels, "block")
    attributes = features.withColumnRenamed("label", "value")
    every = polygons.join(attributes, ["block", "value"]).withColumn("layer", F.lit("all"))
    if plantation is None:
        return _in_degrees(every, placed_by)
    extra = vector.polygonise(plantation, "block").withColumns({"layer": F.lit("plantation"), "class": F.lit("plantation")})
    return _in_degrees(every.unionByName(extra, allowMissingColumns=True), placed_by)


def _in_degrees(layer: DataFrame, placed_by: DataFrame | None) -> DataFrame:
    """A layer of rings (geom) from pixel corners to degrees, by its blocks' geotransforms in Mercator metres."""
    if placed_by is None:
        return layer
    t = F.col("transform")
    metres = lambda p: F.struct((t["x0"] + p.x * t["pw"]).alias("x"), (t["y0"] + p.y * t["ph"]).alias("y"))
    rings = F.transform("geom", lambda ring: vector.to_crs(F.transform(ring, metres), 3857, 4326))
    return layer.join(placed_by, "block").withColumn("geom", rings).drop("transform").withColumn("srid", F.lit(4326))


def merge_names(n_blocks: int, district: str, block: str) -> list[tuple[str, int, int]]:
    """(name, first, end) of the layers that blocks merge into, MERGE blocks each."""
    name = f"{district}_{block}_boundaries"
    return [(name, 0, n_blocks)] if n_blocks <= MERGE else [(f"{name}_{a}_{min(a + MERGE, n_blocks)}", a, min(a + MERGE, n_blocks)) for a in range(0, n_blocks, MERGE)]


def publish(layer: DataFrame, path: str, name: str, order: str, *ties: str, region: Column | None = None) -> str:
    """Writes a point layer as Parquet parted into slices of SLICE rows in order, named like the slices of an export.

    With a region (a ring in the layer's own coordinates) only points within it are written.
    """
    rows = layer.filter(geo.contains(region, F.col("x"), F.col("y"))) if region is not None else layer
    sliced = grid.dense_index(rows, order, *ties).withColumn("start", F.floor(F.col("index") / SLICE) * SLICE)
    named = sliced.withColumn("slice", F.concat_ws("_", F.lit(name), F.col("start").cast("string"), (F.col("start") + SLICE).cast("string")))
    out = f"{path.rstrip('/')}/{name}"
    named.drop("start", "index").repartition("slice").write.mode("overwrite").partitionBy("slice").parquet(out)
    return out


def asset(root: str, state: str, district: str, block: str) -> Column:
    return txt.asset_path(root, *map(F.lit, (state, district, block)))


def run_pending(keys: list, step: Callable[[object], None], tries: int = 5, delay: float = 1.0) -> list:
    """Runs a step for each key; a failed one is tried again after a delay, with a fresh budget after every success. Returns what is done.

    The last failure is raised, and keys already done need not run again.
    """
    done, left = [], tries
    queue = list(keys)
    while queue:
        try:
            step(queue[0])
        except Exception:
            if not left:
                raise
            left -= 1
            time.sleep(delay)
        else:
            done.append(queue.pop(0))
            left = tries
    return done
