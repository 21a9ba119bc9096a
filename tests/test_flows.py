"""Files of the flows, mosaics, region groups, entropies and a whole layer against hand-made or brute-force results."""

import math
import struct
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tileframe.functions import text as txt
from tileframe.operators import kernels, raster, rules, vector, windows
from tileframe.plans import jobs, layers
from tileframe.sources import geotiff, png, shapefile, tables, tiles

RING = [(80.0, 20.0), (80.011, 20.0), (80.011, 20.011), (80.0, 20.011)]


def frame(spark, columns):
    return spark.createDataFrame(pd.DataFrame(columns))


def test_task_ids(spark):
    said = {"Started upload task with ID: abcdef1234567890": "abcdef1234567890", "Task ID: abc_12": "abc_12", "task id ABC1": None, "ABCDEFGHIJKLMNOPQRSTUVWX": None, "ID: x Task ID: y": "y", "": None}
    out = spark.createDataFrame([(x,) for x in said], "said string").select("said", txt.task_id(F.col("said")).alias("id")).collect()
    assert {r["said"]: r["id"] for r in out} == said


def test_forward_replaces_all_at_once():
    assert kernels.forward(np.array([0, 1, 3, 1, 2])).tolist() == [0, 0, 1, 1, 1]


def test_directions_are_open_below_and_closed_above():
    quarters, deviations = kernels._directions(np.array([45.0, 45.1, 135.0, 225.1, 315.0, 359.0]), 45)
    assert quarters.tolist() == [0, 1, 1, 3, 3, 0] and deviations.tolist() == pytest.approx([45, -44.9, 45, -44.9, 45, -1])


def test_a_run_may_begin_before_the_first_vertex():
    metres = np.array([[50, 1.0], [100, 0], [101, 60], [0, 61], [-1, 0]])  # the first vertex stands in the middle of a side
    out = kernels.orthogonalise(metres / 111_000 + [80.0, 0.0])
    a, b = out[4] - out[0], out[1] - out[0]
    assert abs(a[0] * b[1] - a[1] * b[0]) < 1e-6 * np.hypot(*a) * np.hypot(*b)  # still a vertex within a straight side
    sides = np.roll(out[1:], -1, axis=0) - out[1:]
    sides /= np.hypot(*sides.T)[:, None]
    assert abs((sides * np.roll(sides, -1, axis=0)).sum(axis=1)).max() < 1e-4


def test_single_convex_rings_stay_and_stars_do_not():
    ring = np.array([[0, 0], [2, 0.1], [2.2, 2], [0, 2.0]])
    assert kernels.closing([[ring]], 0.5)[0][0] is ring
    star = np.array([[math.cos(4 * math.pi * k / 5), math.sin(4 * math.pi * k / 5)] for k in range(5)])
    assert kernels.convex(ring) and kernels.convex(ring[::-1]) and not kernels.convex(star) and not kernels.convex(np.array([[0, 0], [4, 0], [4, 4], [3, 1.0]]))


@pytest.mark.parametrize("radius, size", [(2, 256), (5, 7), (30, 256)])
def test_local_entropy(spark, radius, size):
    rng = np.random.default_rng(radius)
    g = np.where(rng.random((23, 31)) < 0.7, rng.integers(0, 9, (23, 31)), -1)
    r, c = np.nonzero(g >= 0)
    out = raster.local_entropy(frame(spark, {"img": 1, "r": r, "c": c, "g": g[r, c]}), radius, "img", size=size).collect()
    assert len(out) == len(r)
    for x in out[::17]:
        near = g[r, c][(r - x["r"]) ** 2 + (c - x["c"]) ** 2 <= radius * radius]
        p = np.unique(near, return_counts=True)[1] / len(near)
        assert x["ent"] == pytest.approx(-(p * np.log2(p)).sum(), abs=1e-9)


def test_region_groups_and_table(spark):
    a = np.array([[1, 1, 1, 0, 0, 0], [1, 0, 1, 0, 2, 0], [1, 1, 1, 0, 0, 0], [0, 0, 0, 0, 3, 3], [0, 0, 0, 0, 3, 3], [0, 0, 0, 0, 0, 3]])
    got = kernels.region_groups(a, 1, min_size=2, threshold=2)
    expected = np.zeros((6, 6), int)
    expected[:3, :3], expected[3:5, 4:], expected[5, 5] = 1, 2, 2
    assert (got == expected).all()  # the hole of one pixel is filled, the region of one pixel is gone
    assert kernels.region_groups(a, 1, min_size=2, max_size=6).max() == 1
    r, c = np.indices(a.shape).reshape(2, -1)
    pixels = frame(spark, {"img": 1, "r": r, "c": c, "m": a.ravel()})
    groups = vector.region_groups(pixels, min_size=2, threshold=0)
    rows = {x["label"]: x for x in vector.region_table(groups).collect()}
    assert (rows[1]["area"], rows[1]["area_filled"], rows[1]["area_convex"], rows[1]["solidity"]) == (8, 9, 9, 8 / 9)
    assert rows[2]["area"] == 5 and rows[2]["area_bbox"] == 6
    full = np.ones((5, 5), bool)
    assert kernels.perimeter(full) == 16 and kernels.perimeter(np.ones((1, 1), bool)) == 0
    assert rules.sized(vector.region_table(groups), 6, 8).count() == 1
    assert rules.extent(frame(spark, {"i": [1, 12], "j": [3, 2], "label": [7, 9]})).first().asDict() == {"max_i": 12, "max_j": 3, "max_label": 9}
    blocks = frame(spark, {"idx": [2, 10, 1]})
    assert [x["idx"] for x in rules.in_folder_order(blocks, "idx").collect()] == [1, 10, 2]


def test_segment_lines(spark):
    g = np.zeros((80, 80), int)
    g[:, 40:] = 200
    r, c = np.indices(g.shape).reshape(2, -1)
    pixels = frame(spark, {"img": 1, "r": r, "c": c, "label": 1, "g": g.ravel()})
    assert vector.segment_lines(pixels).count() >= 1
    assert vector.many_lines(pixels.withColumn("g", F.lit(0))).count() == 0


def test_png_round_trip_and_filters():
    rng = np.random.default_rng(1)
    for n in (3, 4):
        image = rng.integers(0, 256, (9, 7, n), dtype=np.uint8)
        assert (png.decode(png.encode(image)) == image).all()
    image = rng.integers(0, 256, (6, 5, 3), dtype=np.uint8).astype("i4")
    rows = b""
    for y in range(6):
        kind, line = y % 5, []
        for x in range(5):
            left, up = image[y, x - 1] if x else np.zeros(3, "i4"), image[y - 1, x] if y else np.zeros(3, "i4")
            corner = image[y - 1, x - 1] if x and y else np.zeros(3, "i4")
            p = left + up - corner
            pick = [min((abs(a - q), k, q) for k, q in enumerate(t))[2] for a, t in zip(p, zip(left, up, corner, strict=True), strict=True)]
            line.append(image[y, x] - (0, left, up, (left + up) // 2, np.array(pick))[kind])
        rows += bytes([kind]) + (np.array(line) % 256).astype("u1").tobytes()
    part = lambda kind, body: struct.pack(">I", len(body)) + kind + body + b"\0\0\0\0"
    data = png.SIGNATURE + part(b"IHDR", struct.pack(">2I5B", 5, 6, 8, 2, 0, 0, 0)) + part(b"IDAT", zlib.compress(rows)) + part(b"IEND", b"")
    assert (png.decode(data) == image).all()


def tiff(order, tags, blobs, at_tag, count_tag):
    """A file of the given tags and blocks."""
    start = 8
    places = [start + sum(map(len, blobs[:i])) for i in range(len(blobs))]
    body = b"".join(blobs)
    tags = sorted({**tags, at_tag: places, count_tag: [len(b) for b in blobs]}.items())
    first, extra, entries = start + len(body), b"", b""
    end = first + 2 + 12 * len(tags) + 4
    for tag, values in tags:
        raw = struct.pack(f"{order}{len(values)}I", *values)
        entries += struct.pack(f"{order}2HI", tag, 4, len(values)) + (raw.ljust(4, b"\0") if len(raw) <= 4 else struct.pack(f"{order}I", end + len(extra)))
        extra += raw if len(raw) > 4 else b""
    head = (b"II" if order == "<" else b"MM") + struct.pack(f"{order}HI", 42, first)
    return head + body + struct.pack(f"{order}H", len(tags)) + entries + b"\0\0\0\0" + extra


def lzw(data):
    """Codes for single bytes only, with a fresh table often enough that they all have 9 bits."""
    bits = ""
    for i in range(0, len(data), 200):
        bits += f"{256:09b}" + "".join(f"{b:09b}" for b in data[i : i + 200])
    bits += f"{257:09b}"
    bits += "0" * (-len(bits) % 8)
    return int(bits, 2).to_bytes(len(bits) // 8, "big")


@pytest.mark.parametrize("order", ["<", ">"])
def test_geotiffs_of_others(spark, order):
    image = np.random.default_rng(2).integers(0, 60000, (37, 50, 2), dtype=np.uint16)
    base = {256: [50], 257: [37], 258: [16, 16], 277: [2], 339: [1, 1]}
    raw = lambda x: np.ascontiguousarray(x.astype(f"{order}u2")).tobytes()
    strips = tiff(order, {**base, 259: [1], 278: [10]}, [raw(image[y : y + 10]) for y in range(0, 37, 10)], 273, 279)
    padded = np.zeros((48, 64, 2), np.uint16)
    padded[:37, :50] = image
    cut = [padded[y : y + 16, x : x + 16] for y in range(0, 48, 16) for x in range(0, 64, 16)]
    differences = [np.diff(t, axis=1, prepend=np.zeros((16, 1, 2), np.uint16)) for t in cut]
    tiled = tiff(order, {**base, 259: [8], 317: [2], 322: [16], 323: [16]}, [zlib.compress(raw(t)) for t in differences], 324, 325)
    packed = tiff(order, {**base, 259: [5], 322: [16], 323: [16]}, [lzw(raw(t)) for t in cut], 324, 325)
    for data in (strips, tiled, packed):
        bands, profile = geotiff.decode(data)
        assert (bands == image.transpose(2, 0, 1)).all() and (profile["srid"], profile["transform"], profile["count"]) == (None, None, 2)
    rows = geotiff.pixels(spark.createDataFrame([("a", bytearray(tiled)), ("b", bytearray(b"no image"))], "path string, content binary"))
    got = {(r["band"], r["r"], r["c"]): r["v"] for r in rows.collect()}
    assert len(got) == image.size and got[1, 36, 49] == image[36, 49, 1]


def test_rasters_are_chunks_in_their_places(spark):
    cells = frame(spark, {"block": 1, "band": 0, "r": [0, 5, 9], "c": [0, 3, 12], "v": [1.0, 2.0, 3.0]})
    out = {(r["i"], r["j"]): geotiff.decode(bytes(r["content"])) for r in geotiff.rasters(cells, (100.0, 0.5, 200.0, -0.5), 3857, "block", size=8).collect()}
    assert set(out) == {(0, 0), (1, 1)} and out[0, 0][0][0, 5, 3] == 2 and out[1, 1][0][0, 1, 4] == 3
    assert out[1, 1][1]["transform"] == (104.0, 0.5, 196.0, -0.5) and out[1, 1][1]["srid"] == 3857


def test_lzw_grows_its_codes():
    """Against an encoder that uses the whole table."""
    data = bytes(np.random.default_rng(3).integers(0, 6, 9000, dtype=np.uint8))
    table, bits, word = {bytes([i]): i for i in range(256)}, [(256, 9)], b""
    size, width = 258, 9
    for i in range(len(data)):
        longer = word + data[i : i + 1]
        if longer in table:
            word = longer
            continue
        bits.append((table[word], width))
        table[longer], size = size, size + 1
        width = min(12, max(9, size.bit_length()))
        word = data[i : i + 1]
        if size == 4094:
            bits.append((table[word], width))
            bits.append((256, width if size + 1 < 4096 else 12))
            table, size, width, word = {bytes([i]): i for i in range(256)}, 258, 9, b""
    bits += [(table[word], width)] * bool(word)
    text = "".join(f"{code:0{w}b}" for code, w in bits)
    assert geotiff._lzw(int(text + "0" * (-len(text) % 8), 2).to_bytes(-(-len(text) // 8), "big"))[:8000] == data[:8000]


def test_mosaic(spark):
    rng = np.random.default_rng(4)
    images = {(x, y): rng.integers(1, 256, (8, 8, 3), dtype=np.uint8) for x in (5, 6) for y in (3, 4)}
    clear = np.zeros((8, 8, 4), np.uint8)
    rows = [(x, y, bytearray(png.encode(a))) for (x, y), a in images.items()] + [(7, 3, None), (7, 4, bytearray(b"?")), (8, 3, bytearray(png.encode(clear)))]
    pixels, place = tiles.mosaic(spark.createDataFrame(rows, "x long, y long, data binary"), 5.25, 3.5, 7.0, 5.0, 4, size=8)
    whole = np.block([[[images[5, 3]], [images[6, 3]]], [[images[5, 4]], [images[6, 4]]]])
    got = {(r["row"], r["col"]): (r["red"], r["green"], r["blue"], r["alpha"]) for r in pixels.collect()}
    assert got == {(y, x): (*map(int, whole[y + 4, x + 2]), None) for y in range(12) for x in range(14)}
    step = 2 * 20037508.342789244 / 128
    assert place == pytest.approx((42 * step - 20037508.342789244, step, 20037508.342789244 - 28 * step, -step))


def test_csv_tables(spark, tmp_path):
    blocks = jobs.blocks(spark, RING, 17, 1)
    tables.write_status(blocks, f"{tmp_path}/status")
    back = tables.read_status(spark, f"{tmp_path}/status")
    assert back.columns == ["idx", "tl", "br", *tables.FLAGS] and sorted(back.collect()) == sorted(blocks.select(back.columns).collect())
    at = F.struct(F.lit(1.5).alias("lat"), F.lit(2.5).alias("lon"))
    ring = lambda n: [{"x": float(i), "y": -float(i)} for i in range(n)]
    rows = spark.createDataFrame([("t1", "Wells", ring(3)), ("t2", "Dry", ring(5))], "tile_name string, cls string, ring array<struct<x: double, y: double>>")
    own = rows.withColumn("corners", F.struct(*[at.alias(c) for c in ("center", "tl", "tr", "bl", "br")]))
    assert tables.write_detections(own, f"{tmp_path}/found") == 5
    got = {r["tile_name"]: (r["cls"], r["lat"], r["lon"], len(r["ring"])) for r in tables.read_detections(spark, f"{tmp_path}/found").collect()}
    assert got == {"t1": ("Wells", 1.5, 2.5, 3), "t2": ("Dry", 1.5, 2.5, 5)}
    tables.write_mapping(spark.createDataFrame([("chunk_0_0.tif", "tile_17_1_2.tif")], "chunk_name string, tile_name string"), f"{tmp_path}/7/tile_mapping.csv")
    assert [tuple(r) for r in tables.read_mapping(spark, f"{tmp_path}/7").collect()] == [("chunk_0_0.tif", "tile_17_1_2.tif", "tile_mapping.csv")]


def test_layers_end_to_end(spark, tmp_path):
    def fetch(address):
        x, y = map(int, address.split("/")[-2:])
        return png.encode(np.full((4, 4, 3), 7, np.uint8)) if (x + y) % 2 else None

    def detector(chunks):
        rows = []
        for r in chunks.itertuples():
            ring = [{"x": 100.0, "y": 100.0}, {"x": 140.0, "y": 100.0}, {"x": 140.0, "y": 140.0}, {"x": 100.0, "y": 140.0}]
            rows += [(r.block, r.z, r.x, r.y, cls, 0.9, 1.0, ring) for cls in ("Wells", "Wet")]
        return pd.DataFrame(rows, columns=["block", "z", "x_tile", "y_tile", "cls", "conf", "entropy", "ring"])

    spark.sparkContext.setCheckpointDir(f"{tmp_path}/checkpoints")
    args = (f"{tmp_path}/data", "State (A)", "District", "Block 1", RING, "http://tiles/{z}/{x}/{y}", fetch, detector)
    out = layers.wells_layer(spark, *args, z=16, scale=1, batch=3, delay=0.0)
    path = layers.area_path(*args[:4], 16)
    assert path.endswith("/state_a/district/block_1/16") and out == f"{path}/wells/wells_district_block_1"
    status = tables.read_status(spark, f"{path}/wells/status")
    assert status.filter("not overall_status").isEmpty()
    points = spark.read.parquet(out)
    lonlat = [(math.degrees(r["x"] / 6378137), math.degrees(2 * math.atan(math.exp(r["y"] / 6378137)) - math.pi / 2)) for r in points.collect()]
    assert lonlat and all(80 < x < 80.011 and 20 < y < 20.011 for x, y in lonlat)
    assert layers.run_pending(spark, f"{path}/wells", None) == []
    ponds = spark.read.parquet(layers.ponds_layer(spark, *args, z=16, scale=1, delay=0.0))
    assert ponds.count() >= len(lonlat) and {r["slice"] for r in ponds.select("slice").collect()} == {"ponds_district_block_1_0_2000"}
    files = layers.shapefiles(ponds.select("slice", "geom", "cluster"), f"{tmp_path}/shapes", 4326)
    assert len(list(shapefile.read(files[0]))) == ponds.count() and files[0].endswith("_0_2000")
    assert layers.region_area(RING, spark) == pytest.approx(1.41, abs=0.02)


def test_windows_of_several_keys(spark):
    p = frame(spark, {"a": [1, 1, 2], "b": [1, 2, 1], "r": 0, "c": 0, "v": [1.0, 2.0, 3.0]})
    out = windows.map_windows(p, lambda x: x * 10, 4, 1, 0.0, None, "a", "b")
    assert sorted(map(tuple, out.collect())) == [(1, 1, 0, 0, 10.0), (1, 2, 0, 0, 20.0), (2, 1, 0, 0, 30.0)]
