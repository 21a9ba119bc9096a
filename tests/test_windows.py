import numpy as np
from pyspark.sql import functions as F

from tileframe.functions import mercator as merc
from tileframe.operators import windows


def frame(spark, a):
    return spark.createDataFrame([(1, int(r), int(c), float(a[r, c])) for r, c in np.ndindex(a.shape)], "img long, r long, c long, v double")


def image(df, shape):
    out = np.full(shape, np.nan)
    for r in df.collect():
        out[r["r"], r["c"]] = r["v"]
    return out


def make_blur():
    def blur(x):  # not a module's function: executors can't import the tests
        p = np.pad(x, 1)
        return sum(p[1 + i : p.shape[0] - 1 + i, 1 + j : p.shape[1] - 1 + j] for i in (-1, 0, 1) for j in (-1, 0, 1))

    return blur


def test_windows_equal_the_whole(spark):
    blur = make_blur()
    a = np.random.default_rng(0).integers(1, 9, (11, 13)).astype(float)
    got = image(windows.map_windows(frame(spark, a), blur, 4, 1), a.shape)
    assert (got == blur(a)).all()
    a[:4, :4] = 0
    some = image(windows.map_windows(frame(spark, a), blur, 4, 0, skip_share=1.0), a.shape)
    assert np.isnan(some[:4, :4]).all() and not np.isnan(some[4:8, 4:8]).any()


def test_warp(spark):
    a = np.arange(16.0).reshape(4, 4)
    box = lambda *b: merc.affine(*map(F.lit, b), 4, 4)
    low = merc.to_3857(F.lit(0.0), F.lit(0.0))
    high = merc.to_3857(F.lit(4.0), F.lit(4.0))
    cells = frame(spark, a).drop("v")
    same = windows.warp(frame(spark, a), box(0.0, 0.0, 4.0, 4.0), 4326, cells, box(0.0, 0.0, 4.0, 4.0), 4326)
    assert (image(same, a.shape) == a).all()
    ends = merc.affine(low["x"], low["y"], high["x"], high["y"], 4, 4)
    assert (image(windows.warp(frame(spark, a), box(0.0, 0.0, 4.0, 4.0), 4326, cells, ends, 3857), a.shape) == a).all()
    moved = windows.warp(frame(spark, a), box(0.0, 0.0, 4.0, 4.0), 4326, cells, box(1.0, 0.0, 5.0, 4.0), 4326)
    assert moved.count() == 12


def test_boxes_and_frames(spark):
    t = merc.affine(*map(F.lit, (0.0, 0.0, 10.0, 10.0)), 10, 10)
    boxes = spark.createDataFrame([(1.5, 1.5, 3.5, 4.5), (1.0, 1.0, 99.0, 2.0)], "minx double, miny double, maxx double, maxy double")
    assert [r["pixel_box"] for r in windows.boxes_to_pixels(boxes, t, 10, 10).collect()] == [[1, 8, 3, 5]]
    got = windows.frames(spark.range(10).select(F.col("id").alias("k")), 30, 10, "f").collect()
    assert [r["name"] for r in got] == ["f000000.jpg", "f000001.jpg", "f000002.jpg", "f000003.jpg"]
