import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tileframe.functions import geometry as geo
from tileframe.functions import mercator as merc
from tileframe.functions import text as txt
from tileframe.operators import grid, vector
from tileframe.plans import jobs
from tileframe.sources import geojson, geotiff, shapefile, tiles
from tileframe.streaming import requests

BOX = [(0.0, 0.0), (2.0, 0.0), (2.0, 1.0), (0.0, 1.0)]
DETECTIONS = "block long, z int, x_tile long, y_tile long, cls string, conf double, entropy double, ring array<struct<x: double, y: double>>"


@pytest.fixture(scope="module", autouse=True)
def checkpoints(spark, tmp_path_factory):
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))


def test_shapefile_round_trip(tmp_path):
    rows = [([BOX, [(0.5, 0.2), (0.5, 0.6), (1.0, 0.6)]], {"value": 3, "class": "farm"}), ([[(5.0, 5.0), (6.0, 5.0), (6.0, 6.0)]], {"value": None, "class": "äöü"})]
    files = shapefile.write(str(tmp_path / "layer"), rows, 4326)
    back = list(shapefile.read(str(tmp_path / "layer")))
    assert [a for _, a in back] == [{"value": 3.0, "class": "farm"}, {"value": None, "class": "äöü"}]
    assert [len(g) for g, _ in back] == [2, 1] and set(back[0][0][0]) == set(BOX) and len(files) == 5
    assert shapefile.bundle(str(tmp_path / "layer")).endswith("layer.zip")
    shapefile.write(str(tmp_path / "points"), [((1.0, 2.0), {"Class": "Wells"})], 3857, shapefile.POINT)
    assert list(shapefile.read(str(tmp_path / "points"))) == [((1.0, 2.0), {"Class": "Wells"})]


@pytest.mark.parametrize("kind", ["u1", "u2", "i2", "f4", "f8"])
def test_geotiff_round_trip(kind):
    bands = (np.arange(3 * 7 * 5).reshape(3, 7, 5) * 7 % 251).astype(kind)
    back, profile = geotiff.decode(geotiff.encode(bands, (100.0, 2.0, 50.0, -2.0), 3857, "0"))
    assert (back == bands).all() and profile["srid"] == 3857 and profile["transform"] == (100.0, 2.0, 50.0, -2.0) and profile["nodata"] == "0"


def test_geojson_round_trip(spark, tmp_path):
    ring = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in BOX])
    doc = geojson.collection(spark.range(3).select(F.lit(1).alias("k"), F.array(ring).alias("geom"), F.create_map(F.lit("id"), F.col("id").cast("string")).alias("properties")), "k")
    (tmp_path / "a.json").write_text(doc.first()["geojson"])
    back = geojson.read(spark, str(tmp_path / "a.json")).collect()
    assert sorted(r["properties"]["id"] for r in back) == ["0", "1", "2"] and len(back[0]["ring"]) == 5
    point = spark.createDataFrame([('{"type":"FeatureCollection","features":[{"type":"Feature","geometry":{"type":"Point","coordinates":[1,2]},"properties":{}}]}',)], "value string")
    assert geojson.features(point).first()["ring"] is None


def test_fetch_retries_and_skips(spark, tmp_path):
    def fetcher(url):
        if url.endswith("/3"):
            raise OSError("gone")
        return None if url.endswith("/2") else url.encode()

    asked = spark.createDataFrame([(1, 5, y) for y in (1, 2, 3)], "z int, x long, y long")
    got = {r["y"]: r["data"] for r in tiles.fetch(asked, "t/{z}/{x}/{y}", fetcher, skip_errors=True).collect()}
    assert bytes(got[1]) == b"t/1/5/1" and got[2] is None and got[3] is None
    with pytest.raises(Exception, match="gone"):
        tiles.fetch(asked, "t/{z}/{x}/{y}", fetcher).collect()
    assert [r["name"] for r in tiles.basemaps(spark, {"b": ("u", False), "a": ("v", True)}).collect()] == ["b"]
    folder = tmp_path / "7" / "chunks"
    folder.mkdir(parents=True)
    (folder / "chunk_1_2.tif").write_bytes(b"x")
    (folder / "other.tif").write_bytes(b"y")
    assert [(r["folder"], r["i"], r["j"]) for r in tiles.images(spark, str(tmp_path)).collect()] == [("7", 1, 2)]


def test_blocks_and_tiles(spark):
    ring = [(82.07, 18.57), (82.60, 18.57), (82.60, 18.96), (82.07, 18.96)]
    out = jobs.blocks(spark, ring, 17, 16).collect()
    assert [r["idx"] for r in sorted(out, key=lambda r: r["idx"])] == list(range(len(out))) and not out[0]["overall_status"]
    per = spark.createDataFrame(out).withColumn("a", merc.tile_fraction(F.col("tl.lat"), F.col("tl.lon"), 17)).withColumn("b", merc.tile_fraction(F.col("br.lat"), F.col("br.lon"), 17))
    corners = per.select("idx", *[F.round(F.col(f"{p}.{c}"), 6).alias(f"{c}{i}") for i, p in enumerate("ab") for c in "xy"])
    counts = tiles.of_blocks(corners, 17).groupBy("block").agg(F.count("*").alias("n"), F.max("i").alias("i"), F.max("j").alias("j")).collect()
    assert {(r["n"], r["i"], r["j"]) for r in counts} == {(256, 15, 15)}


def test_names(spark):
    names = [("tile_17_5_6.tif",), ("tile_17_5_6_copy.tif",), ("tile_x_y_z.tif",), ("t",)]
    out = spark.createDataFrame(names, "n string").select(txt.tile_numbers(F.col("n")).alias("a"), txt.tile_numbers(F.col("n"), exact=True).alias("b")).collect()
    assert [r["a"] is not None for r in out] == [True, True, False, False] and [r["b"] is not None for r in out] == [True, False, False, False]


def make(cls, conf, entropy, x, n=4):
    ring = [(x, 10.0), (x + 8, 10.0), (x + 8, 18.0), (x, 18.0)][:n]
    return (0, 17, 96446, 56783, cls, conf, entropy, [{"x": float(a), "y": float(b)} for a, b in ring])


def test_ponds_and_wells(spark):
    rows = [make("Wet", 0.9, 1.0, 0), make("Wet", 0.9, 1.0, 10), make("Wet", 0.5, 1.0, 30), make("Dry", 0.9, None, 60), make("Wet", 0.9, 3.0, 90), make("Wet", 0.9, 1.0, 240), make("Wells", 0.71, None, 5), make("Wells", 0.7, None, 5), make("Wells", 0.9, None, 5, 2)]
    det = spark.createDataFrame(rows, DETECTIONS)
    assert jobs.wells(det, 17).count() == 1
    assert jobs.ponds(det).count() == 2
    assert jobs.ponds(det, keep_null_entropy=True).count() == 3
    assert jobs.ponds(det.limit(0)).count() == 0


def test_farm(spark):
    extent = np.ones((12, 24))
    boundary = np.zeros((12, 24))
    boundary[:, 11:13] = 1.0
    pixels = [(0, r, c, float(extent[r, c]), float(boundary[r, c])) for r in range(12) for c in range(24)]
    image = [(0, r, c, 10 * r % 256, 100, 50) for r in range(12) for c in range(24)]
    prob = spark.createDataFrame(pixels, "block long, r long, c long, extent double, boundary double")
    rgb = spark.createDataFrame(image, "block long, r long, c long, red int, green int, blue int")
    plant = spark.createDataFrame([(0, 1, 1, 1), (0, 1, 2, 1)], "block long, r long, c long, label int")
    out = jobs.farm(prob, rgb, plant).collect()
    assert {r["class"] for r in out} == {"rest", "plantation"} and sum(r["size"] or 0 for r in out) == 12 * 24 and len([r for r in out if r["layer"] == "all"]) >= 2


def test_infer_skips_unreadable(spark):
    chunks = spark.createDataFrame([(1, b"abc"), (2, None)], "block long, data binary")
    model = lambda pdf: pd.DataFrame({"block": pdf["block"], "n": pdf["data"].map(len)})
    assert [tuple(r) for r in jobs.infer(chunks, model, "block long, n long").collect()] == [(1, 3)]


def test_publish_and_names(spark, tmp_path):
    points = spark.range(4500).select((F.col("id") % 100).cast("double").alias("x"), (F.col("id") / 100).alias("y"), "id")
    out = jobs.publish(points, str(tmp_path), "wells", "id")
    sizes = {r["slice"]: r["count"] for r in spark.read.parquet(out).groupBy("slice").count().collect()}
    assert sizes == {"wells_0_2000": 2000, "wells_2000_4000": 2000, "wells_4000_6000": 500}
    region = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((-1.0, -1.0), (9.5, -1.0), (9.5, 99.0), (-1.0, 99.0))])
    assert spark.read.parquet(jobs.publish(points, str(tmp_path), "some", "id", region=region)).count() == 450
    assert jobs.merge_names(450, "d", "b") == [("d_b_boundaries_0_200", 0, 200), ("d_b_boundaries_200_400", 200, 400), ("d_b_boundaries_400_450", 400, 450)]


def test_run_pending_retries():
    calls = []

    def step(k):
        calls.append(k)
        if calls.count(k) < 3:
            raise OSError

    assert jobs.run_pending([1, 2], step, tries=2, delay=0) == [1, 2]
    with pytest.raises(OSError):
        jobs.run_pending([3], lambda k: step(9 if len(calls) > 99 else len(calls) + 100), tries=1, delay=0)


def test_clusters_chain_and_keep_singles(spark):
    rows = [(i, [{"x": x + a, "y": b} for a, b in BOX]) for i, x in enumerate([0.0, 2.5, 5.0, 7.5, 20.0, 22.0])]
    polys = spark.createDataFrame(rows, "id long, ring array<struct<x: double, y: double>>")
    got = {r["id"]: r["cluster"] for r in vector.clusters(polys, 0.6, 1.0).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 0, 4: 4, 5: 4}
    assert {(r["a"], r["b"]) for r in vector.near_pairs(polys, 0.6, 1.0).collect()} == {(0, 1), (1, 2), (2, 3), (4, 5)}


def test_dense_index_over_ranges(spark, monkeypatch):
    monkeypatch.setattr(grid, "INDEX_ROWS", 50)
    rows = spark.createDataFrame([(i % 97 if i % 50 else None, i) for i in range(1000)], "k int, t int").repartition(7)
    got = grid.dense_index(rows, "k", "t").orderBy("index").collect()
    assert [r["index"] for r in got] == list(range(1000))
    assert [(r["k"], r["t"]) for r in got] == sorted(((r["k"], r["t"]) for r in got), key=lambda p: (-1 if p[0] is None else p[0], p[1]))


def test_request_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"state":"Bihar","district":"Gaya","block":"X","requested":"2026-01-01T00:00:00"}\n{"state":"bihar","district":"gaya","block":"x","requested":"2026-01-01T00:01:00"}\n{"state":"bihar","block":"x"}\n')
    seen = []
    query = requests.start(requests.fresh(requests.read(spark, str(tmp_path / "in"))), lambda s, *names: seen.append(names), str(tmp_path / "cp"))
    query.awaitTermination(120)
    assert seen == [("bihar", "gaya", "x")]


def test_plans(spark, capsys):
    """Spatial joins are hash or merge joins on cells, and scans read only what they need."""
    region = spark.range(1).select(grid.region_ring([(0, 0), (5, 0), (5, 5)]).alias("ring"))
    points = spark.range(100).select(F.col("id").alias("event_id"), F.rand(1).alias("x"), F.rand(2).alias("y"))
    vector.spatial_semi(points, region, 1.0).explain()
    plan = capsys.readouterr().out
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert geo.area is not None
