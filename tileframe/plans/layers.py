"""The layers of a region (state, district, block), end to end: from its outline over tiles and a detector to published slices.

Everything a layer needs from outside is a parameter: the outline, a fetcher of tiles, the tiles' address and the detector. Work is
resumed by the status table below the region's path: pending blocks go through in batches, each one Spark job, and are marked done.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import mercator as merc
from ..functions import text as txt
from ..operators import grid, rules, vector
from ..sources import shapefile, tables, tiles
from . import jobs

#: Blocks that one job takes.
BATCH = 64
#: Zoom levels and tiles a block's side of the layers.
ZOOM, SCALE = {"farm": 17, "ponds": 17, "wells": 18}, 16


def area_path(root: str, state: str, district: str, block: str, z: int) -> str:
    names = [re.sub(txt.UNSAFE, "", x.lower()).replace(" ", "_") for x in (state, district, block)]
    return "/".join([root.rstrip("/"), *names, str(z)])


def exists(spark: SparkSession, path: str) -> bool:
    own = spark._jvm.org.apache.hadoop.fs.Path(path)
    return own.getFileSystem(spark._jsc.hadoopConfiguration()).exists(own)


def plan(spark: SparkSession, path: str, ring: list[tuple[float, float]], z: int, scale: int = SCALE) -> DataFrame:
    """The region's blocks with their status, read from the path or, the first time, written to it."""
    if not exists(spark, f"{path}/status"):
        tables.write_status(jobs.blocks(spark, ring, z, scale), f"{path}/status")
    return tables.read_status(spark, f"{path}/status")


def block_tiles(blocks: DataFrame, z: int, scale: int = SCALE) -> DataFrame:
    """(block, z, x, y, i, j): the scale x scale tiles from each block's corner on, i along x and j along y."""
    corner = merc.tile_fraction(F.col("tl.lat"), F.col("tl.lon"), z)
    # the corner is that of a tile, up to rounding
    at = blocks.select(F.col("idx").cast("long").alias("block"), F.round(corner["x"], 6).alias("cx"), F.round(corner["y"], 6).alias("cy"))
    box = at.select("block", F.floor("cx").alias("x0"), F.floor("cy").alias("y0")).withColumns({"x1": F.col("x0") + scale, "y1": F.col("y0") + scale})
    return tiles.of_blocks(box.withColumnRenamed("block", "idx"), z).select(F.col("block").cast("long").alias("block"), F.lit(z).alias("z"), "x", "y", "i", "j")


def detections(blocks: DataFrame, template: str, fetcher: Callable[[str], bytes | None], detector: jobs.Model, z: int, scale: int = SCALE) -> DataFrame:
    """What a detector finds in the tiles of blocks, in jobs.DETECTION; the detector gets (block, z, x, y, i, j, data)."""
    return jobs.infer(tiles.fetch(block_tiles(blocks, z, scale), template, fetcher), detector, jobs.DETECTION)


def run_pending(spark: SparkSession, path: str, step: Callable[[DataFrame, str], None], flag: str = "overall_status", batch: int = BATCH, tries: int = 5, delay: float = 1.0) -> list[list[int]]:
    """Runs a step on the pending blocks, batch by batch; after each, its blocks are marked in the status table. Returns the batches done.

    The step gets a batch's blocks and the path where what it writes belongs; a batch that failed writes there again.
    """
    queue = sorted(r["idx"] for r in rules.pending(tables.read_status(spark, f"{path}/status"), flag).select("idx").collect())

    def one(ids: list[int]) -> None:
        status = tables.read_status(spark, f"{path}/status")
        step(status.filter(F.col("idx").isin(ids)), f"{path}/parts/{ids[0]}_{ids[-1]}")
        done = spark.createDataFrame([(i,) for i in ids], "idx int")
        new = rules.mark_done(status, done, "idx", flag).orderBy("idx")
        # the table is read and written, so the new one is complete before the old one goes
        tables.write_status(new, f"{path}/status.new")
        tables.write_status(tables.read_status(spark, f"{path}/status.new"), f"{path}/status")

    return jobs.run_pending([queue[a : a + batch] for a in range(0, len(queue), batch)], one, tries, delay)


def wells_layer(spark: SparkSession, root: str, state: str, district: str, block: str, ring: list[tuple[float, float]], template: str, fetcher: Callable, detector: jobs.Model, **options) -> str:
    """Wells of a region as slices of points in Mercator metres; returns where they are."""
    return _layer(spark, "wells", root, state, district, block, ring, template, fetcher, detector, **options)


def ponds_layer(spark: SparkSession, root: str, state: str, district: str, block: str, ring: list[tuple[float, float]], template: str, fetcher: Callable, detector: jobs.Model, **options) -> str:
    """Merged ponds of a region as slices of polygons in degrees that meet its outline; returns where they are."""
    return _layer(spark, "ponds", root, state, district, block, ring, template, fetcher, detector, **options)


def _layer(spark, layer, root, state, district, block, ring, template, fetcher, detector, z: int | None = None, scale: int = SCALE, batch: int = BATCH, tries: int = 5, delay: float = 1.0) -> str:
    z = z or ZOOM[layer]
    path = area_path(root, state, district, block, z) + f"/{layer}"
    plan(spark, path, ring, z, scale)
    run_pending(spark, path, lambda blocks, at: detections(blocks, template, fetcher, detector, z, scale).write.mode("overwrite").parquet(at), batch=batch, tries=tries, delay=delay)
    found = spark.read.schema(jobs.DETECTION).option("recursiveFileLookup", True).parquet(f"{path}/parts")
    name = f"{layer}_{district}_{block}".lower().replace(" ", "_")
    outline = grid.region_ring(ring)
    if layer == "wells":
        points = jobs.wells(found, z)
        metres = F.transform(outline, lambda p: merc.to_3857(p.x, p.y))
        return jobs.publish(points, path, name, "x", "y", region=metres)
    polygons = jobs.ponds(found, z).withColumn("__x", F.array_min(F.transform(F.col("geom")[0], lambda p: p.x)))
    return jobs.publish(polygons.filter(vector.meets(F.col("geom")[0], outline)), path, name, "__x", "cluster")


def shapefiles(slices: DataFrame, path: str, srid: int, geometry: str = "geom", zipped: bool = True) -> list[str]:
    """Published slices (slice, geometry and attributes) as one shapefile each below a folder that executors share; each is written by one task.

    geometry is a column of rings, or of points as a struct of x and y. Returns the files' paths without ending.
    """
    point = "x" in (getattr(slices.schema[geometry].dataType, "names", None) or [])

    def write(pdf):
        rows = []
        for r in pdf.to_dict("records"):
            shape, name = r.pop(geometry), r.pop("slice")
            rows.append(((float(shape["x"]), float(shape["y"])) if point else [[(p["x"], p["y"]) for p in part] for part in shape], {k: v.item() if hasattr(v, "item") else v for k, v in r.items()}))
        shapefile.write(f"{path}/{name}", rows, srid, shapefile.POINT if point else shapefile.POLYGON)
        if zipped:
            shapefile.bundle(f"{path}/{name}")
        return pdf[["slice"]].iloc[:1]

    from pathlib import Path

    Path(path).mkdir(parents=True, exist_ok=True)
    return sorted(f"{path}/{r['slice']}" for r in slices.groupBy("slice").applyInPandas(write, "slice string").collect())


def region_area(ring: list[tuple[float, float]], spark: SparkSession) -> float:
    """The region's area in square kilometres."""
    return spark.range(1).select(vector.sphere_area(grid.region_ring(ring)).alias("a")).first()["a"]
