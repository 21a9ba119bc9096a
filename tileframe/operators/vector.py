"""Kernels over groups and rings as Spark operators, and spatial joins."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geometry as geo
from ..functions import mercator as merc
from . import kernels

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
RING = T.ArrayType(POINT)


def _dense(pdf: pd.DataFrame, column: str, fill=0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    r, c = (pdf["r"] - pdf["r"].min()).to_numpy(), (pdf["c"] - pdf["c"].min()).to_numpy()
    out = np.full((r.max() + 1, c.max() + 1), fill, pdf[column].dtype)
    out[r, c] = pdf[column]
    return out, r, c


def label_images(pixels: DataFrame, image: str = "img", value: str = "m", connectivity: int = 2) -> DataFrame:
    """Adds label to the pixels (image, r, c, value) that are not 0; an image is a chunk of bounded size."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        dense, r, c = _dense(pdf, value)
        return pdf.assign(label=kernels.label(dense, connectivity)[r, c]).query("label > 0")

    kind = pixels.select(image, "r", "c", value)
    return kind.groupBy(image).applyInPandas(run, T.StructType([*kind.schema.fields, T.StructField("label", T.IntegerType())]))


def segment_images(pixels: DataFrame, image: str = "img", t_extent: float = 0.3, t_boundary: float = 0.4) -> DataFrame:
    """(image, r, c, label) of watershed instances from the columns extent and boundary."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        extent, r, c = _dense(pdf, "extent", 0.0)
        boundary, _, _ = _dense(pdf, "boundary", 1.0)
        return pdf.assign(label=kernels.watershed(extent, boundary, t_extent, t_boundary)[r, c])[[image, "r", "c", "label"]].query("label > 0")

    kind = pixels.select(image, "r", "c", "extent", "boundary")
    return kind.groupBy(image).applyInPandas(run, T.StructType([*kind.select(image, "r", "c").schema.fields, T.StructField("label", T.IntegerType())]))


def fill_holes(labels: DataFrame, threshold: int, image: str = "img") -> DataFrame:
    """(image, r, c, label) over the whole raster with small holes filled; pixels of label 0 must be present."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        dense, r, c = _dense(pdf, "label")
        return pdf.assign(label=kernels.fill_holes(dense, threshold)[r, c])

    kind = labels.select(image, "r", "c", "label")
    return kind.groupBy(image).applyInPandas(run, kind.schema)


def polygonise(labels: DataFrame, image: str = "img", tolerance: float | None = None) -> DataFrame:
    """(image, value, geom) of the 4-connected regions of equal label; geom is the exterior ring and its holes, in pixel corners, simplified if a tolerance is given."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        dense, _, _ = _dense(pdf, "label")
        at = np.array([pdf["c"].min(), pdf["r"].min()])
        rows = [(pdf[image].iloc[0], v, [[{"x": float(x), "y": float(y)} for x, y in (ring if tolerance is None else kernels.simplify(ring, tolerance)) + at] for ring in rings]) for v, rings in kernels.polygons(dense)]
        return pd.DataFrame(rows, columns=[image, "value", "geom"])

    kind = labels.select(image, "r", "c", "label")
    schema = T.StructType([kind.schema[image], T.StructField("value", T.IntegerType()), T.StructField("geom", T.ArrayType(RING))])
    return kind.groupBy(image).applyInPandas(run, schema)


def region_groups(pixels: DataFrame, image: str = "img", value: str = "m", connectivity: int = 1, min_size: int = 10, max_size: int | None = None, threshold: int | None = None) -> DataFrame:
    """(image, r, c, label) of a raster's regions of equal value, sized, filled and numbered as by kernels.region_groups(); pixels of value 0 must be present."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        dense, r, c = _dense(pdf, value)
        return pdf.assign(label=kernels.region_groups(dense, connectivity, min_size, max_size, threshold)[r, c])[[image, "r", "c", "label"]]

    kind = pixels.select(image, "r", "c", F.col(value).cast("int").alias(value))
    return kind.groupBy(image).applyInPandas(run, T.StructType([*kind.select(image, "r", "c").schema.fields, T.StructField("label", T.IntegerType())]))


def _segments(labels: DataFrame, image: str, label: str, columns: list[str], fields: list[T.StructField], rows_of: Callable[[np.ndarray, pd.DataFrame], list[tuple]]) -> DataFrame:
    """(image, label, fields) from each segment's mask, cut to its bounds, and its pixels; rows_of may give none or several rows."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for name, own in pdf.groupby(label, sort=True):
            y, x = own["r"] - own["r"].min(), own["c"] - own["c"].min()
            mask = np.zeros((y.max() + 1, x.max() + 1), bool)
            mask[y, x] = True
            rows += [(pdf[image].iloc[0], name, *found) for found in rows_of(mask, own.assign(r=y, c=x))]
        return pd.DataFrame(rows, columns=[image, label, *[f.name for f in fields]])

    kind = labels.select(image, label, "r", "c", *columns)
    return kind.groupBy(image).applyInPandas(run, T.StructType([kind.schema[image], kind.schema[label], *fields]))


def region_table(labels: DataFrame, image: str = "img", intensity: str | None = None) -> DataFrame:
    """All properties of the regions (image, label) of a raster: moments by one aggregation, and the areas and perimeter that need the mask."""
    own = labels.filter("label > 0")
    fields = [T.StructField("area_convex", T.DoubleType()), T.StructField("area_filled", T.DoubleType()), T.StructField("perimeter", T.DoubleType())]
    shape = lambda mask, _: [(float(kernels.convex_area(mask)), float(kernels.filled_area(mask)), kernels.perimeter(mask))]
    out = region_properties(own, image, "label", intensity=intensity).join(_segments(own, image, "label", [], fields, shape), [image, "label"])
    return out.withColumn("solidity", F.col("area") / F.col("area_convex"))


def segment_lines(pixels: DataFrame, image: str = "img", erode: int = 3, least: int = 50, gap: int = 30) -> DataFrame:
    """(image, label, x1, y1, x2, y2): straight edges within each segment of pixels (image, label, r, c, g)."""
    fields = [T.StructField(x, T.LongType()) for x in ("x1", "y1", "x2", "y2")]

    def found(mask: np.ndarray, own: pd.DataFrame) -> list[tuple]:
        gray = np.zeros(mask.shape)
        gray[own["r"], own["c"]] = own["g"]
        return kernels.lines(gray, mask, least, gap, erode)

    return _segments(pixels.filter("label > 0"), image, "label", ["g"], fields, found)


def many_lines(pixels: DataFrame, image: str = "img") -> DataFrame:
    """(image, label) of the segments that have more than two straight edges in a mask that isn't eroded."""
    return segment_lines(pixels, image, erode=1).groupBy(image, "label").agg(F.count("*").alias("n")).filter("n > 2").drop("n")


def region_properties(labels: DataFrame, *keys: str, intensity: str | None = None) -> DataFrame:
    """Moment properties of the pixels of each region, by one aggregation.

    Axes are those of the ellipse with the region's second moments, each pixel being a unit square.
    """
    x, y, n = F.col("c").cast("double"), F.col("r").cast("double"), F.count("*").cast("double")
    sums = [F.avg(x).alias("mx"), F.avg(y).alias("my"), F.avg(x * x).alias("xx"), F.avg(y * y).alias("yy"), F.avg(x * y).alias("xy")]
    box = (F.max("r") - F.min("r") + 1) * (F.max("c") - F.min("c") + 1)
    extra = [f(F.col(intensity)).alias(f"intensity_{name}") for name, f in (("min", F.min), ("max", F.max), ("mean", F.avg), ("std", F.stddev_pop), ("median", F.median))] if intensity else []
    g = labels.groupBy(*keys).agg(n.alias("area"), box.cast("double").alias("area_bbox"), *sums, *extra)
    a, b, c = F.col("xx") - F.col("mx") ** 2 + 1 / 12, F.col("yy") - F.col("my") ** 2 + 1 / 12, F.col("xy") - F.col("mx") * F.col("my")
    spread = F.sqrt(F.greatest((a - b) ** 2 + 4 * c**2, F.lit(0.0)))
    major, minor = 4 * F.sqrt((a + b + spread) / 2), 4 * F.sqrt(F.greatest((a + b - spread) / 2, F.lit(0.0)))
    out = g.withColumns({"axis_major_length": major, "axis_minor_length": minor, "orientation": F.when(c == 0, F.when(b >= a, 0.0).otherwise(F.lit(np.pi / 2))).otherwise(0.5 * F.atan2(2 * c, b - a))})
    derived = {
        "extent": F.col("area") / F.col("area_bbox"),
        "equivalent_diameter_area": F.sqrt(4 * F.col("area") / F.lit(np.pi)),
        "eccentricity": F.sqrt(F.greatest(F.lit(0.0), 1 - (F.col("axis_minor_length") / F.col("axis_major_length")) ** 2)),
        "elongation": F.try_divide("axis_major_length", "axis_minor_length"),
    }
    return out.withColumns(derived).drop("xx", "yy", "xy").withColumnsRenamed({"mx": "centroid_c", "my": "centroid_r"})


def shape_features(labels: DataFrame, image: str, label: str) -> DataFrame:
    """(image, label, rect, frct_dim) of each segment's mask, image by image."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows, names = [], pdf[label].to_numpy()
        r, c = pdf["r"].to_numpy(), pdf["c"].to_numpy()
        order = np.argsort(names, kind="stable")
        for at in np.split(order, np.flatnonzero(np.diff(names[order])) + 1):
            y, x = r[at] - r[at].min(), c[at] - c[at].min()
            mask = np.zeros((y.max() + 1, x.max() + 1), bool)
            mask[y, x] = True
            ring = kernels.outline(mask)
            rows.append((pdf[image].iloc[0], names[at[0]], kernels.rectangularity(ring), kernels.fractal_dimension(ring)))
        return pd.DataFrame(rows, columns=[image, label, "rect", "frct_dim"])

    kind = labels.select(image, label, "r", "c")
    shape = [T.StructField("rect", T.DoubleType()), T.StructField("frct_dim", T.DoubleType())]
    return kind.groupBy(image).applyInPandas(run, T.StructType([kind.schema[image], kind.schema[label], *shape]))


def _flat(rings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(vertices of all rings as rows of x and y, where each ring ends); a null ring has none."""
    values = rings.flatten()
    xy = np.column_stack([values.field(c).to_numpy(zero_copy_only=False).astype("f8") for c in ("x", "y")])
    return xy, np.cumsum(pc.fill_null(pc.list_value_length(rings), 0).to_numpy(zero_copy_only=False))


def map_rings(kernel: Callable[[np.ndarray], np.ndarray]) -> Callable[[Column], Column]:
    """A ring kernel as a column function over Arrow lists; rings of under 3 vertices, and null ones as empty rings, stay as they are."""

    @F.arrow_udf(RING)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for rings in batches:
            xy, ends = _flat(rings)
            out = [kernel(xy[a:b]) if b - a >= 3 else xy[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
            flat = np.concatenate([np.zeros((0, 2)), *out])
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype("i4")
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], names=["x", "y"]))

    return run


def min_rectangle(ring: Column) -> Column:
    return map_rings(kernels.min_rectangle)(ring)


def simplify(ring: Column, tolerance: float) -> Column:
    return map_rings(lambda p: kernels.simplify(p, tolerance))(ring)


def orthogonalise(ring: Column, max_angle_change: float = 15.0, skew_tolerance: float = 15.0) -> Column:
    return map_rings(lambda p: kernels.orthogonalise(p, max_angle_change, skew_tolerance))(ring)


def total_bounds(layer: DataFrame, *keys: str) -> DataFrame:
    """(keys, minx, miny, maxx, maxy) of all rings (ring) of a layer."""
    box = geo.bounds(F.col("ring"))
    return layer.select(*keys, box.alias("b")).groupBy(*keys).agg(*[f(f"b.{c}").alias(c) for c, f in (("minx", F.min), ("miny", F.min), ("maxx", F.max), ("maxy", F.max))])


def to_crs(ring: Column, source: int, target: int) -> Column:
    """A ring (x, y) in another reference system."""
    return F.transform(ring, lambda p: merc.transform_coords(p.x, p.y, source, target))


def meets(a: Column, b: Column) -> Column:
    """Whether two rings have a point in common: a vertex of one in the other, or edges that cross."""
    inside = F.exists(a, lambda p: geo.contains(b, p.x, p.y)) | F.exists(b, lambda p: geo.contains(a, p.x, p.y))
    return inside | F.exists(geo.edges(a), lambda e: F.exists(geo.edges(b), lambda f: geo.crosses(e, f)))


def sphere_area(ring: Column) -> Column:
    """Area in square kilometres of a ring (lon, lat) on the sphere, edges being straight in longitude and the sine of latitude."""
    part = lambda e: F.radians(e.b.x - e.a.x) * (2 + F.sin(F.radians(e.a.y)) + F.sin(F.radians(e.b.y)))
    return F.abs(F.aggregate(geo.edges(ring), F.lit(0.0), lambda s, e: s + part(e))) * (6371.0088**2 / 2)


def centroid_cells(ring: Column, transform: Column, source: int = 4326, target: int = 4326) -> Column:
    """struct<row, col> of a raster's cell that a ring's area centroid falls in."""
    at = geo.area_centroid(ring)
    p = merc.transform_coords(at["x"], at["y"], source, target)
    return merc.to_rowcol(p["x"], p["y"], transform)


def spatial_semi(features: DataFrame, region: DataFrame, cell: float) -> DataFrame:
    """Point features (x, y) within any polygon (ring) of region, by an equi-join on grid cells and the exact predicate.

    A region polygon is listed in every cell that its bounds meet, so pairs are only those that share a cell.
    """
    box = geo.bounds(F.col("ring"))
    span = lambda a, b: F.sequence(F.floor(a / cell), F.floor(b / cell))
    listed = region.select("ring", F.explode(span(box["minx"], box["maxx"])).alias("__cx"), span(box["miny"], box["maxy"]).alias("ys")).withColumn("__cy", F.explode("ys"))
    own = features.withColumn("__cx", F.floor(F.col("x") / cell)).withColumn("__cy", F.floor(F.col("y") / cell))
    at = listed.select(F.col("__cx").alias("gx"), F.col("__cy").alias("gy"), "ring")
    met = own.join(at, (own["__cx"] == at["gx"]) & (own["__cy"] == at["gy"]) & geo.contains(at["ring"], own["x"], own["y"]), "left_semi")
    return met.drop("__cx", "__cy")


@F.arrow_udf(T.DoubleType())
def _distance(a: pa.Array, b: pa.Array) -> pa.Array:
    (x, x_ends), (y, y_ends) = _flat(a), _flat(b)
    pairs = zip(np.split(x, x_ends[:-1]), np.split(y, y_ends[:-1]), strict=True)
    return pa.array([kernels.ring_distance(p, q) for p, q in pairs], pa.float64())


def near_pairs(polygons: DataFrame, distance: float, cell: float) -> DataFrame:
    """(a, b), a < b: ids of polygons (id, ring) at most so far apart; candidates share a grid cell of their grown bounds."""
    box = geo.bounds(F.col("ring"))
    half = distance / 2
    span = lambda a, b: F.sequence(F.floor((a - half) / cell), F.floor((b + half) / cell))
    cells = F.flatten(F.transform(span(box["minx"], box["maxx"]), lambda x: F.transform(span(box["miny"], box["maxy"]), lambda y: F.struct(x.alias("x"), y.alias("y")))))
    listed = polygons.select("id", "ring", box.alias("box"), F.explode(cells).alias("cell"))
    a, b = listed.alias("a"), listed.alias("b")
    # a pair is looked at only in the first cell that both have
    apart = lambda low, high: F.greatest(F.col(f"a.box.{low}"), F.col(f"b.box.{low}")) - F.least(F.col(f"a.box.{high}"), F.col(f"b.box.{high}"))
    first = lambda low: F.floor((F.greatest(F.col(f"a.box.{low}"), F.col(f"b.box.{low}")) - half) / cell)
    met = a.join(b, (F.col("a.cell") == F.col("b.cell")) & (F.col("a.id") < F.col("b.id")) & (apart("minx", "maxx") <= distance) & (apart("miny", "maxy") <= distance))
    met = met.filter((F.col("a.cell.x") == first("minx")) & (F.col("a.cell.y") == first("miny")))
    return met.filter(_distance(F.col("a.ring"), F.col("b.ring")) <= distance).select(F.col("a.id").alias("a"), F.col("b.id").alias("b"))


def clusters(polygons: DataFrame, distance: float, cell: float) -> DataFrame:
    """(id, cluster): polygons chained by gaps of at most a distance; a cluster is named by its smallest id.

    Least ids spread over pairs and are followed to their own least ids, round by round; each round is checkpointed.
    """
    pairs = near_pairs(polygons, distance, cell)
    edges = pairs.union(pairs.select("b", "a")).toDF("id", "other").checkpoint()
    state = polygons.select("id", F.col("id").alias("cluster")).checkpoint()
    while True:
        met = edges.join(state.select(F.col("id").alias("other"), F.col("cluster").alias("near")), "other")
        least = met.groupBy("id").agg(F.min("near").alias("near"))
        step = state.join(least, "id", "left").select("id", "cluster", F.least("cluster", "near").alias("to"))
        jump = state.select(F.col("id").alias("to"), F.col("cluster").alias("jump"))
        new = step.join(jump, "to").select("id", F.least("to", "jump").alias("new"), "cluster").checkpoint()
        if new.filter("new <> cluster").isEmpty():
            return state
        state = new.select("id", F.col("new").alias("cluster"))


def dissolve(polygons: DataFrame, distance: float, cell: float) -> DataFrame:
    """(cluster, geom): polygons merged with all that are within twice the distance, gaps closed; only geometry stays.

    The closing runs cluster by cluster on a grid of a sixth of the distance.
    """
    joined = polygons.join(clusters(polygons, 2 * distance, cell), "id")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, geoms = [], []
            for cluster, rings in zip(batch.column("cluster").to_pylist(), batch.column("rings"), strict=True):
                merged = kernels.closing([[np.array([(p["x"], p["y"]) for p in ring], "f8")] for ring in rings.as_py()], distance)
                names += [cluster] * len(merged)
                geoms += [[[{"x": float(x), "y": float(y)} for x, y in r] for r in own] for own in merged]
            point = pa.struct([("x", pa.float64()), ("y", pa.float64())])
            yield pa.RecordBatch.from_arrays([pa.array(names, batch.column("cluster").type), pa.array(geoms, pa.list_(pa.list_(point)))], ["cluster", "geom"])

    groups = joined.groupBy("cluster").agg(F.collect_list("ring").alias("rings"))
    return groups.mapInArrow(merge, T.StructType([groups.schema["cluster"], T.StructField("geom", T.ArrayType(RING))]))
