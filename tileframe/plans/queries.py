"""Registered queries of the geospatial operators, each with SQL that checks it where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixtures import ROI, load, with_fixtures
from ..functions import geometry as geo
from ..functions import mercator as merc
from ..functions import text as txt
from ..operators import grid, raster, rules, vector, windows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
Z = 17


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = with_fixtures(sql)
        return f

    return add


def lat_lon():
    return F.col("lat"), F.col("lon")


# --- projection -------------------------------------------------------------------------------------

_N = "131072.0"
_TX = f"trunc((lon + 180) / 360 * {_N})"
_TY = f"trunc((1 - ln(tan(radians(lat)) + 1 / cos(radians(lat))) / pi()) / 2 * {_N})"
_LAT = "degrees(atan(sinh(pi() * (1 - 2 * ({y})))))"
_PX = f"round_even((lon + 180) / 360 * {_N} * 256, 0)"
_PY = f"round_even((0.5 - ln((1 + sin(radians(lat))) / (1 - sin(radians(lat)))) / (4 * pi())) * {_N} * 256, 0)"


@query(f"select event_id, cast({_TX} as bigint) as x, cast({_TY} as bigint) as y from geo_points")
def tile_xy(spark, d):
    t = merc.tile_xy(*lat_lon(), Z)
    return load(spark, d, "geo_points").select("event_id", t["x"].alias("x"), t["y"].alias("y"))


@query(f"select event_id, cast({_PX} as bigint) as px, cast({_PY} as bigint) as py from geo_points")
def pixel_xy(spark, d):
    return load(spark, d, "geo_points").select("event_id", merc.pixel_x(F.col("lon"), Z).alias("px"), merc.pixel_y(F.col("lat"), Z).alias("py"))


@query(f"select event_id, round((px + 512) / ({_N} * 256) * 360 - 180, 9) as lon, round({_LAT.format(y=f'(py + 512) / ({_N} * 256)')}, 9) as lat from (select event_id, {_PX} as px, {_PY} as py from geo_points)")
def pixel_corner(spark, d):
    c = merc.opposite_corner(*lat_lon(), Z, 2)
    return load(spark, d, "geo_points").select("event_id", F.round(c["lon"], 9).alias("lon"), F.round(c["lat"], 9).alias("lat"))


_CORNERS = f"""select det_id, x_tile / {_N} * 360 - 180 as west, (x_tile + 1) / {_N} * 360 - 180 as east,
    {_LAT.format(y=f'y_tile / {_N}')} as north, {_LAT.format(y=f'(y_tile + 1) / {_N}')} as south from detections"""


@query(f"select det_id, round(west, 9) as west, round(east, 9) as east, round(north, 9) as north, round(south, 9) as south from ({_CORNERS})")
def tile_corners(spark, d):
    c = merc.tile_corners(F.col("x_tile"), F.col("y_tile"), Z)
    out = {"west": c["tl"]["lon"], "east": c["br"]["lon"], "north": c["tr"]["lat"], "south": c["bl"]["lat"]}
    return load(spark, d, "detections").select("det_id", *[F.round(v, 9).alias(k) for k, v in out.items()])


@query(f"select det_id, round((north + south) / 2, 9) as lat, round((west + east) / 2, 9) as lon from ({_CORNERS})")
def tile_center(spark, d):
    c = merc.tile_center(merc.tile_corners(F.col("x_tile"), F.col("y_tile"), Z))
    return load(spark, d, "detections").select("det_id", F.round(c["lat"], 9).alias("lat"), F.round(c["lon"], 9).alias("lon"))


@query("select event_id, round(radians(lon) * 6378137.0, 4) as x, round(ln(tan(radians(45 + lat / 2))) * 6378137.0, 4) as y from geo_points")
def merc_3857(spark, d):
    p = merc.to_3857(F.col("lon"), F.col("lat"))
    return load(spark, d, "geo_points").select("event_id", F.round(p["x"], 4).alias("x"), F.round(p["y"], 4).alias("y"))


@query("select event_id, round(lon, 7) as lon, round(lat, 7) as lat from geo_points")
def merc_round_trip(spark, d):
    out = load(spark, d, "geo_points").withColumn("p", merc.transform_coords(F.col("lon"), F.col("lat"), 4326, 3857))
    q = merc.transform_coords(F.col("p.x"), F.col("p.y"), 3857, 4326)
    return out.select("event_id", F.round(q["x"], 7).alias("lon"), F.round(q["y"], 7).alias("lat"))


@query("""select event_id, round(fmod(degrees(atan2(sin(radians(77 - lon)) * cos(radians(28)),
    cos(radians(lat)) * sin(radians(28)) - sin(radians(lat)) * cos(radians(28)) * cos(radians(77 - lon)))) + 360, 360), 6) as bearing from geo_points""")
def bearing(spark, d):
    b = merc.bearing(F.col("lat"), F.col("lon"), F.lit(28.0), F.lit(77.0))
    return load(spark, d, "geo_points").select("event_id", F.round(b, 6).alias("bearing"))


@query("select p_partkey, round(360 / (256 * power(2.0, p_size % 20)), 12) as deg, cast(trunc(log2(156543.03392804097 / p_size)) as integer) as zoom from part")
def resolution(spark, d):
    return load(spark, d, "part").select("p_partkey", F.round(merc.degrees_per_pixel(F.col("p_size") % 20), 12).alias("deg"), merc.zoom_for_resolution(F.col("p_size")).alias("zoom"))


@query("""select * from (select event_id, cast(floor((lat - 30) / ((10 - 30) / cast(512 as double))) as bigint) as row, cast(floor((lon - 70) / (20 / cast(512 as double))) as bigint) as col
    from geo_points) where row >= 0 and row < 512 and col >= 0 and col < 512""")
def coords_to_cells(spark, d):
    t = merc.affine(*map(F.lit, (70.0, 10.0, 90.0, 30.0)), 512, 512)
    cell = merc.to_rowcol(F.col("lon"), F.col("lat"), t)
    out = load(spark, d, "geo_points").select("event_id", cell["row"].alias("row"), cell["col"].alias("col"))
    return out.filter(merc.inside(F.col("row"), F.col("col"), 512, 512))


@query("select img, r, c, round(68 + (c + 0.5) * 0.25, 9) as x, round(36 + (r + 0.5) * -0.5, 9) as y from emb_raster")
def cells_to_coords(spark, d):
    t = merc.affine(*map(F.lit, (68.0, 32.0, 70.0, 36.0)), 8, 8)
    p = merc.from_rowcol(F.col("r"), F.col("c"), t)
    return load(spark, d, "emb_raster").select("img", "r", "c", F.round(p["x"], 9).alias("x"), F.round(p["y"], 9).alias("y"))


@query("""select user_id, min(floor((lon - 68) * 10)) as min_col, min(floor((36 - lat) * 10)) as min_row, max(floor((lon - 68) * 10)) as max_col, max(floor((36 - lat) * 10)) as max_row
    from geo_points group by user_id""")
def pixel_bounds(spark, d):
    col, row = F.floor((F.col("lon") - 68) * 10), F.floor((36 - F.col("lat")) * 10)
    ends = [f(x).cast("double").alias(f"{n}_{a}") for n, f in (("min", F.min), ("max", F.max)) for a, x in (("col", col), ("row", row))]
    return load(spark, d, "geo_points").groupBy("user_id").agg(*ends)


# --- grids ------------------------------------------------------------------------------------------

ZG, SG = 12, 16
_GRID = f"""with b as (select cast(trunc((70 + 180) / 360.0 * 4096) as double) as tx, trunc((1 - ln(tan(radians(33)) + 1 / cos(radians(33))) / pi()) / 2 * 4096) as ty),
 c as (select tx / 4096 * 360 - 180 as lon, {_LAT.format(y='ty / 4096')} as lat from b),
 p as (select round_even((lon + 180) / 360 * 1048576, 0) as px, round_even((0.5 - ln((1 + sin(radians(lat))) / (1 - sin(radians(lat)))) / (4 * pi())) * 1048576, 0) as py from c),
 n as (select px, py, cast(ceil(greatest(abs(px - round_even((95 + 180) / 360.0 * 1048576, 0)), abs(round_even((0.5 - ln((1 + sin(radians(10))) / (1 - sin(radians(10)))) / (4 * pi())) * 1048576, 0) - py)) / 256 / 16) as integer) as n from p),
 g as (select k, m, {_LAT.format(y='(py + 4096 * k) / 1048576')} as north, (px + 4096 * m) / 1048576 * 360 - 180 as west, {_LAT.format(y='(py + 4096 * (k + 1)) / 1048576')} as south, (px + 4096 * (m + 1)) / 1048576 * 360 - 180 as east
   from n, generate_series(0, 64) s(k), generate_series(0, 64) t(m) where k <= n and m <= n)"""


def _grid(spark):
    return grid.block_grid(grid.bounds_frame(spark, ROI), ZG, SG)


@query(f"{_GRID} select cast(k as integer) as k, cast(m as integer) as m, round(north, 9) as north, round(west, 9) as west, round(south, 9) as south, round(east, 9) as east from g")
def block_grid(spark, d):
    cols = {"north": "tl.lat", "west": "tl.lon", "south": "br.lat", "east": "br.lon"}
    return _grid(spark).select("k", "m", *[F.round(v, 9).alias(k) for k, v in cols.items()])


_EDGES = """(values (cast(70 as double), cast(10 as double), cast(95 as double), cast(12 as double)), (95, 12, 90, 33), (90, 33, 72, 30), (72, 30, 70, 10)) e(x1, y1, x2, y2)"""
_SIDE = "(({2} - {0}) * ({5} - {1}) - ({3} - {1}) * ({4} - {0}))"


def _cross(a: tuple, b: tuple) -> str:
    side = lambda p, q: _SIDE.format(*p, *q)
    return f"{side(a, b[:2])} * {side(a, b[2:])} < 0 and {side(b, a[:2])} * {side(b, a[2:])} < 0"


_BOX = (("west", "north", "east", "north"), ("east", "north", "east", "south"), ("east", "south", "west", "south"), ("west", "south", "west", "north"))
_MEETS = f"""select k, m, any_value(north) as north, any_value(west) as west from (
    select k, m, north, west from g, {_EDGES} where x1 between west and east and y1 between south and north
      or {' or '.join(_cross(side, ('x1', 'y1', 'x2', 'y2')) for side in _BOX)}
    union all select k, m, any_value(north), any_value(west) from g, (values (0, 0), (0, 1), (1, 0), (1, 1)) q(a, b), {_EDGES}
      where (y1 > if(b = 0, north, south)) <> (y2 > if(b = 0, north, south)) and if(a = 0, west, east) < (x2 - x1) * (if(b = 0, north, south) - y1) / (y2 - y1) + x1
      group by k, m, a, b having count(*) % 2 = 1) group by k, m"""


@query(f"{_GRID} select cast(row_number() over (order by k, m) - 1 as integer) as idx, round(north, 9) as north, round(west, 9) as west, false as overall_status from ({_MEETS})")
def blocks_in_roi(spark, d):
    near = grid.in_region(_grid(spark), grid.region_ring(ROI))
    out = grid.indexed_blocks(near)
    return out.select("idx", F.round("tl.lat", 9).alias("north"), F.round("tl.lon", 9).alias("west"), "overall_status")


@query(f"""select event_id from geo_points, {_EDGES} where (y1 > lat) <> (y2 > lat) and lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1 group by event_id having count(*) % 2 = 1""")
def points_in_roi(spark, d):
    region = spark.range(1).select(grid.region_ring(ROI).alias("ring"))
    points = load(spark, d, "geo_points").select("event_id", F.col("lon").alias("x"), F.col("lat").alias("y"))
    return vector.spatial_semi(points, region, 5.0).select("event_id")


@query("""select det_id, x, y from (select det_id, x_tile + 0.25 as x0, x_tile + 2.5 as x1, y_tile + 0.75 as y0, y_tile + 1.5 as y1 from detections),
    lateral (select unnest(range(cast(floor(x0) as bigint), cast(ceil(x1) as bigint))) as x) a, lateral (select unnest(range(cast(floor(y0) as bigint), cast(ceil(y1) as bigint))) as y) b""")
def tile_enum(spark, d):
    tiles = grid.tiles_of(F.col("x_tile") + 0.25, F.col("y_tile") + 0.75, F.col("x_tile") + 2.5, F.col("y_tile") + 1.5)
    return load(spark, d, "detections").select("det_id", F.explode(tiles).alias("t")).select("det_id", "t.x", "t.y")


@query("""select p_partkey, y, x, cast(greatest(4, y + 72 - (p_size * 11 + 64)) as bigint) as bottom, cast(greatest(4, x + 72 - (p_size * 13 + 64)) as bigint) as "right"
    from part, lateral (select unnest(range(-4, p_size * 11 + 64, 64)) as y) a, lateral (select unnest(range(-4, p_size * 13 + 64, 64)) as x) b""")
def sample_grid(spark, d):
    wins = grid.sample_grid(F.col("p_size") * 11 + 64, F.col("p_size") * 13 + 64, 64, 64, 4)
    out = load(spark, d, "part").select("p_partkey", F.explode(wins).alias("w"))
    return out.select("p_partkey", *[F.col(f"w.{c}").cast("bigint").alias(c) for c in ("y", "x", "bottom", "right")])


@query("""select p_partkey, k, cast(greatest(0, least(k * 48, s - 64)) as bigint) as start from (select p_partkey, p_size * 37 + 64 as s from part),
    lateral (select unnest(range((s - 16) // 48 + case when (s - 16) % 48 > 0 then 1 else 0 end)) as k) a""")
def split_grid(spark, d):
    size = (F.col("p_size") * 37 + 64).cast("bigint")
    out = load(spark, d, "part").select("p_partkey", F.posexplode(grid.split_offsets(size, 64, 16)).alias("k", "start"))
    return out.select("p_partkey", F.col("k").cast("bigint").alias("k"), F.col("start").cast("bigint").alias("start"))


@query("""select cast(a as bigint) as start, least(a + 2000, n) as "end" from (select count(*) as n from orders), lateral (select unnest(range(0, n, 2000)) as a) t""")
def export_slices(spark, d):
    n = load(spark, d, "orders").agg(F.count("*").alias("n"))
    return n.select(F.explode(grid.slices(F.col("n"), 2000)).alias("s")).select("s.start", "s.end")


@query("select o_orderkey, cast((row_number() over (order by o_orderkey) - 1) // 2000 as bigint) as chunk from orders")
def export_chunks(spark, d):
    out = grid.dense_index(load(spark, d, "orders").select("o_orderkey"), "o_orderkey")
    return out.select("o_orderkey", F.floor(F.col("index") / 2000).alias("chunk"))


# --- names ------------------------------------------------------------------------------------------


@query("select det_id, 'chunk_' || (x_tile - 96446) || '_' || (y_tile - 56783) || '.tif' as chunk_name, 'tile_17_' || x_tile || '_' || y_tile || '.tif' as tile_name from detections")
def chunk_names(spark, d):
    t = load(spark, d, "detections")
    return t.select("det_id", txt.chunk_name(F.col("x_tile") - 96446, F.col("y_tile") - 56783).alias("chunk_name"), txt.tile_name(F.col("z"), F.col("x_tile"), F.col("y_tile")).alias("tile_name"))


@query("select det_id, x_tile, y_tile, cast(x_tile - 96446 as integer) as i, cast(y_tile - 56783 as integer) as j from detections")
def parse_names(spark, d):
    names = chunk_names(spark, d)
    t, c = txt.tile_numbers(F.col("tile_name"), exact=True), txt.chunk_indices(F.col("chunk_name"))
    return names.select("det_id", t["x_tile"].alias("x_tile"), t["y_tile"].alias("y_tile"), c["i"].alias("i"), c["j"].alias("j"))


_CLEAN = r"replace(regexp_replace({0}, '[^a-zA-Z0-9 .,:;_\-]', '', 'g'), ' ', '_')"


@query(f"select s_suppkey, {_CLEAN.format('block')} as name, concat_ws('/', 'assets', {_CLEAN.format('lower(state)')}, {_CLEAN.format('lower(district)')}, {_CLEAN.format('lower(block)')}) as path from places")
def valid_names(spark, d):
    return load(spark, d, "places").select("s_suppkey", txt.valid_text(F.col("block")).alias("name"), txt.asset_path("assets", F.col("state"), F.col("district"), F.col("block")).alias("path"))


@query("""select c_custkey, case c_custkey % 6 when 0 then null when 1 then 'ab_' || c_custkey when 2 then 'x' || c_custkey when 3 then 'second_' || c_custkey when 4 then null else 'Q' || c_custkey end as task, 'https://raw.githubusercontent.com/u/r/main/' || c_custkey as url from customer""")
def ids_and_urls(spark, d):
    key = F.col("c_custkey").cast("string")
    texts = ("nothing started, id {}", "Started upload task with ID: ab_{}-1", "ID: other Task ID: x{} done", "Task ID: second_{} ID: third", "task id ABC{}", "the ID: Q{}.")
    said = F.element_at(F.array(*[F.replace(F.lit(t), F.lit("{}"), key) for t in texts]), (F.col("c_custkey") % 6 + 1).cast("int"))
    return load(spark, d, "customer").select("c_custkey", txt.task_id(said).alias("task"), txt.raw_url(F.concat(F.lit("https://github.com/u/r/blob/main/"), key)).alias("url"))


@query("select o_orderkey, cast(year(o_orderdate) as integer) as y, cast(o_custkey as integer) as id from orders")
def name_numbers(spark, d):
    name = F.concat_ws("_", F.lit("img"), F.col("o_custkey").cast("string"), F.year("o_orderdate").cast("string"), F.lit("07"), F.concat(F.lit("11"), F.lit(".tif")))
    n = txt.name_numbers(name)
    return load(spark, d, "orders").select("o_orderkey", n[1].alias("y"), n[0].alias("id"))


# --- detections -------------------------------------------------------------------------------------

_THR = "case cls when 'Dry' then 0.75 when 'Wet' then 0.60 when 'Wells' then 0.71 end"


def _rings(spark, d):
    v = load(spark, d, "det_vertices").groupBy("det_id").agg(F.sort_array(F.collect_list(F.struct("k", "x", "y"))).alias("v"))
    return v.select("det_id", F.transform("v", lambda p: F.struct(p.x.alias("x"), p.y.alias("y"))).alias("ring"))


@query(f"select cls, count(*) as n, round(sum(conf), 6) as conf from detections where conf >= cast({_THR} as double) group by cls")
def conf_filter(spark, d):
    return rules.confident(load(spark, d, "detections")).groupBy("cls").agg(F.count("*").alias("n"), F.round(F.sum("conf"), 6).alias("conf"))


@query(f"select det_id, cls from detections where conf >= cast({_THR} as double) and entropy <= 2.5 and cls <> 'Wells'")
def pond_gate(spark, d):
    return rules.gated(rules.confident(load(spark, d, "detections").filter("cls <> 'Wells'"))).select("det_id", "cls")


_GEO = f"""select v.det_id, k, west + x / 256 * (east - west) as lon, north - y / 256 * (north - south) as lat, cls, conf from det_vertices v join ({_CORNERS}) c using (det_id) join detections using (det_id)"""


@query(f"select det_id, round(radians(avg(lon)) * 6378137.0, 2) as x, round(ln(tan(radians(45 + avg(lat) / 2))) * 6378137.0, 2) as y from ({_GEO}) where cls = 'Wells' and conf >= 0.71 group by det_id")
def wells_points(spark, d):
    det = rules.confident(load(spark, d, "detections").filter("cls = 'Wells'")).join(_rings(spark, d), "det_id")
    det = det.withColumn("corners", merc.tile_corners(F.col("x_tile"), F.col("y_tile"), Z))
    placed = F.transform("ring", lambda p: merc.pixel_to_geo(p.x, p.y, F.col("corners")))
    mean = geo.vertex_mean(F.transform(placed, lambda p: F.struct(p.lon.alias("x"), p.lat.alias("y"))))
    det = det.withColumn("at", mean).select("det_id", merc.to_3857(F.col("at.x"), F.col("at.y")).alias("p"))
    return det.select("det_id", F.round("p.x", 2).alias("x"), F.round("p.y", 2).alias("y"))


@query("select count(*) as n, max(nv) as most from detections")
def max_vertices(spark, d):
    return _rings(spark, d).agg(F.count("*").alias("n"), F.max(F.size("ring")).cast("bigint").alias("most"))


_SHOE = """select det_id, k, x, y, coalesce(lead(x) over w, first_value(x) over w) as x2, coalesce(lead(y) over w, first_value(y) over w) as y2 from det_vertices window w as (partition by det_id order by k)"""


@query(f"""select det_id, round(abs(sum(x * y2 - x2 * y)) / 2, 3) as area, round(sum((x + x2) * (x * y2 - x2 * y)) / (3 * sum(x * y2 - x2 * y)), 3) + 0.0 as cx,
    round(sum((y + y2) * (x * y2 - x2 * y)) / (3 * sum(x * y2 - x2 * y)), 3) + 0.0 as cy, round(sum(sqrt((x2 - x) * (x2 - x) + (y2 - y) * (y2 - y))), 3) as perimeter from ({_SHOE}) group by det_id""")
def polygon_measures(spark, d):
    c = geo.area_centroid(F.col("ring"))
    cols = {"area": geo.area(F.col("ring")), "cx": c["x"], "cy": c["y"], "perimeter": geo.perimeter(F.col("ring"))}
    return _rings(spark, d).select("det_id", *[(F.round(v, 3) + 0.0).alias(k) for k, v in cols.items()])


@query("""select d.det_id, nv, max(x) filter (where k = 0) as "X_1", max(y) filter (where k = 0) as "Y_1", max(x) filter (where k = 3) as "X_4", max(y) filter (where k = 3) as "Y_4" from detections d join det_vertices v using (det_id) group by d.det_id, nv""")
def wide_vertices(spark, d):
    wide = _rings(spark, d).select("det_id", *geo.wide(F.col("ring"), 8))
    back = wide.withColumn("ring", geo.from_wide(8))
    return back.select("det_id", F.size("ring").cast("bigint").alias("nv"), "X_1", "Y_1", "X_4", "Y_4")


@query("""select e.event_id from events e join (select distinct o_orderkey % 16 as i from orders where o_orderkey % 5 > 0) t on e.event_id % 32 = t.i""")
def mapped_chunks(spark, d):
    mapping = load(spark, d, "orders").filter("o_orderkey % 5 > 0").select((F.col("o_orderkey") % 16).alias("chunk")).distinct()
    return load(spark, d, "events").withColumn("chunk", F.col("event_id") % 32).join(mapping, "chunk", "left_semi").select("event_id")


@query("""select det_id, round(min(x), 3) as minx, round(min(y), 3) as miny, round(max(x), 3) as maxx, round(max(y), 3) as maxy from det_vertices group by det_id""")
def box_polygons(spark, d):
    b = geo.bounds(F.col("ring"))
    boxes = _rings(spark, d).select("det_id", geo.close(geo.box_ring(b["minx"], b["maxy"], b["maxx"], b["miny"])).alias("ring"))
    c = geo.bounds(F.col("ring"))
    return boxes.select("det_id", *[F.round(c[k], 3).alias(k) for k in ("minx", "miny", "maxx", "maxy")])


# --- status -----------------------------------------------------------------------------------------


@query("select idx from block_status where not overall_status")
def pending_blocks(spark, d):
    return rules.pending(load(spark, d, "block_status")).select("idx")


@query("select idx, overall_status, model_status or idx in (select o_custkey from orders where o_orderstatus = 'F') as model_status from block_status")
def status_update(spark, d):
    done = load(spark, d, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("idx"))
    return rules.mark_done(load(spark, d, "block_status"), done, "idx", "model_status").select("idx", "overall_status", "model_status")


@query("select o_orderkey as task from orders where o_orderkey % 4 not in (1, 3)")
def unfinished_tasks(spark, d):
    t = load(spark, d, "orders").select(F.col("o_orderkey").alias("task"))
    states = t.filter("task % 2 = 1 or task % 4 = 2").select("task", F.when(F.col("task") % 4 == 1, "SUCCEEDED").when(F.col("task") % 4 == 3, "FAILED").otherwise("RUNNING").alias("state"))
    return rules.unfinished(t, states)


# --- segments ---------------------------------------------------------------------------------------

_F8 = """case when rect >= 0.67 and size > 500 and size < 2000 and ent < 1 then 'farm'
    when (ent > 2.5 and num_lines <= 1 and size > 2000 and rect < 0.67 and red > 1) or size > 100000 then 'scrubland' else 'rest' end"""


def _classified(spark, d):
    return load(spark, d, "segments").withColumn("class", rules.classify(*map(F.col, ("rect", "size", "ent", "num_lines")), F.col("red") > 1))


@query(f'select value, {_F8} as "class" from segments')
def classify(spark, d):
    return _classified(spark, d).select("value", "class")


@query("""select value, case when size > 80000 then 0 when ent < 1 and rect > 0.6 then 1
    when rect > 0.67 and size < 20000 and (ent_pl < 8.5 or num_lines = 1) then 2 else 0 end as cls from segments""")
def classify_legacy(spark, d):
    return load(spark, d, "segments").select("value", rules.classify_legacy(*map(F.col, ("rect", "size", "ent", "ent_pl", "num_lines"))).alias("cls"))


@query(f"select value, case when ({_F8}) = 'farm' then value else 0 end as shown from segments")
def class_mask(spark, d):
    return _classified(spark, d).select("value", rules.only_class(F.col("value"), F.col("class"), "farm").alias("shown"))


@query(f"""select l.l_linenumber as line, s.class, count(*) as n, cast(sum(l.l_partkey) as bigint) as keys from lineitem l join (select value, {_F8} as "class" from segments) s on l.l_partkey = s.value group by all""")
def seg_join(spark, d):
    polygons = load(spark, d, "lineitem").select(F.col("l_partkey").alias("value"), F.col("l_linenumber").alias("line"))
    return polygons.join(_classified(spark, d).select("value", "class"), "value").groupBy("line", "class").agg(F.count("*").alias("n"), F.sum("value").alias("keys"))


@query("select p.p_partkey, count(l.l_partkey) as n, round(avg(l.l_quantity), 6) as quantity from part p left join lineitem l on p.p_partkey = l.l_partkey and l.l_returnflag = 'R' and l.l_linenumber = 7 group by p.p_partkey")
def region_left_join(spark, d):
    props = load(spark, d, "lineitem").filter("l_returnflag = 'R' and l_linenumber = 7").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("n"), F.avg("l_quantity").alias("q"))
    out = load(spark, d, "part").select("p_partkey").join(props, "p_partkey", "left")
    return out.select("p_partkey", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), F.round("q", 6).alias("quantity"))


@query(f"""select 'all' as layer, value, {_F8} as "class", size from segments union all select 'plantation', s_suppkey, 'plantation', null from supplier""")
def layer_union(spark, d):
    every = _classified(spark, d).select(F.lit("all").alias("layer"), "value", "class", "size")
    plantation = load(spark, d, "supplier").select(F.lit("plantation").alias("layer"), F.col("s_suppkey").alias("value"), F.lit("plantation").alias("class"))
    return every.unionByName(plantation, allowMissingColumns=True)


@query("""with a as (select seg, line_id, degrees(atan2(y2 - y1, x2 - x1)) as t from line_segments)
    select a.seg, count(*) as pairs from a join a b on a.seg = b.seg and a.line_id < b.line_id
    where abs(least(abs(a.t - b.t), 180 - abs(a.t - b.t)) - 90) <= 5 group by a.seg""")
def right_angles(spark, d):
    return rules.right_angles(load(spark, d, "line_segments"), "seg")


@query("""select label as img_label, vec_id, area from (select label, vec_id, round(list_max(embedding), 6) as area, row_number() over (partition by label order by list_max(embedding) desc, vec_id) as n from embeddings) where n = 1""")
def top_contour(spark, d):
    t = load(spark, d, "embeddings").select(F.col("label").alias("img_label"), F.array_max("embedding").alias("area"), F.col("vec_id").alias("position"))
    return rules.top_contour(t, "img_label").select("img_label", F.col("position").alias("vec_id"), F.round(F.col("area"), 6).alias("area"))


# --- rasters ----------------------------------------------------------------------------------------


@query("select label, r, c, max(m) as m from emb_raster group by label, r, c")
def mask_or(spark, d):
    return raster.mask_or(load(spark, d, "emb_raster"), "label", "r", "c")


@query("select img, g, r // 4 as j, c // 4 as i, r, c from emb_raster")
def stitch(spark, d):
    cut = raster.unstitch(load(spark, d, "emb_raster").select("img", "g", "r", "c"), 4)
    whole = raster.stitch(cut.select("img", "g", "i", "j", F.col("chunk_r").alias("r"), F.col("chunk_c").alias("c")), 4)
    return whole.select("img", "g", "i", "j", F.col("row").alias("r"), F.col("col").alias("c"))


@query("select label, r, c, round(arg_max(v, img), 6) as v from emb_raster group by label, r, c")
def merge_last(spark, d):
    out = raster.merge_last(load(spark, d, "emb_raster"), "img", "label", "r", "c")
    return out.withColumn("v", F.round("v", 6))


@query("""select img, r, c, cast(greatest(0, least(255, round_even(cast(0.25 as double) * g + cast(0.75 as double) * h, 0))) as integer) as v
    from (select img, r, c, g, lead(g) over w as h, lead(img) over w as after from emb_raster window w as (partition by r, c order by img)) where after = img + 1""")
def blend(spark, d):
    a = load(spark, d, "emb_raster").select("img", "r", "c", "g")
    b = load(spark, d, "emb_raster").select((F.col("img") - 1).alias("img"), "r", "c", F.col("g").alias("h"))
    return a.join(b, ["img", "r", "c"]).select("img", "r", "c", raster.blend(F.col("g"), F.col("h"), 0.25).alias("v"))


@query("""select img, r, c, cast(trunc((v - a) / (b - a) * 255) as integer) as byte from (select img, r, c, v, min(v) over (partition by img) as a, max(v) over (partition by img) as b from emb_raster)""")
def stretch(spark, d):
    return raster.stretch(load(spark, d, "emb_raster").select("img", "r", "c", "v"), "img").select("img", "r", "c", "byte")


_LADDER = "case when a >= 0 and b <= 1 then 'float32' when a >= 0 and b <= 255 then 'uint8' when a >= -128 and b <= 127 then 'int8' when a >= 0 and b <= 65535 then 'uint16' when a >= -32768 and b <= 32767 then 'int16' else 'float64' end"


@query(f"select o_custkey, {_LADDER} as dtype from (select o_custkey, min(o_totalprice - o_custkey * 100) as a, max(o_totalprice - o_custkey * 100) as b from orders group by o_custkey)")
def dtype_ladder(spark, d):
    v = F.col("o_totalprice") - F.col("o_custkey") * 100
    g = load(spark, d, "orders").groupBy("o_custkey").agg(F.min(v).alias("a"), F.max(v).alias("b"))
    return g.select("o_custkey", raster.dtype(F.col("a"), F.col("b")).alias("dtype"))


@query("select img, round(avg(case when m = 0 then 1.0 else 0.0 end), 9) as nodata from emb_raster group by img having avg(case when m = 0 then 1.0 else 0.0 end) < 0.7")
def nodata_skip(spark, d):
    out = raster.nodata_share(load(spark, d, "emb_raster").select("img", F.col("m").alias("v")), 0, "img")
    return out.filter("nodata < 0.7").select("img", F.round("nodata", 9).alias("nodata"))


@query("select img, m, min(r) as min_r, max(r) as max_r, min(c) as min_c, max(c) as max_c, count(*) as size from emb_raster group by img, m")
def label_bbox(spark, d):
    return raster.label_boxes(load(spark, d, "emb_raster"), "img", "m")


@query("""select img, round(sum(g) / cast((max(r) - min(r) + 1) * (max(c) - min(c) + 1) as double), 6) as red, round(sum(m) / cast((max(r) - min(r) + 1) * (max(c) - min(c) + 1) as double), 6) as mask from emb_raster where v >= 0.1 group by img""")
def band_means(spark, d):
    out = raster.band_means(load(spark, d, "emb_raster").filter("v >= 0.1D"), ["g", "m"], "img")
    return out.select("img", F.round("g", 6).alias("red"), F.round("m", 6).alias("mask"))


def _entropies(radius: int, source: str = "select img, r, c, g from emb_raster where m = 1") -> str:
    """CTE e (img, r, c, ent): each pixel meets those of its image within the radius."""
    return f"""with s as materialized ({source}),
    n as (select a.img, a.r, a.c, b.g, count(*) as n from s a join s b on a.img = b.img where (a.r - b.r) * (a.r - b.r) + (a.c - b.c) * (a.c - b.c) <= {radius * radius} group by all),
    e as (select img, r, c, log2(sum(n)) - sum(n * log2(n)) / sum(n) as ent from n group by img, r, c)"""


def _masked(spark, d):
    return load(spark, d, "emb_raster").filter("m = 1").select("img", "r", "c", "g")


@query(f"{_entropies(5)} select img, r, c, abs(round(ent, 6)) as ent from e")
def local_entropy(spark, d):
    return raster.local_entropy(_masked(spark, d), 5, "img").select("img", "r", "c", F.abs(F.round("ent", 6)).alias("ent"))


@query(f"{_entropies(5)} select img, round(coalesce(sum(ent) filter (where ent > 3.5), 0) / count(*), 6) as score, round(coalesce(sum(ent) filter (where ent > 5.2), 0) / count(*), 6) as strict from e group by img")
def entropy_score(spark, d):
    near = raster.local_entropy(_masked(spark, d), 5, "img")
    score, strict = (raster.entropy_score(near, above, "img") for above in (3.5, 5.2))
    return score.join(strict.withColumnRenamed("score", "strict"), "img").select("img", F.round("score", 6).alias("score"), F.round("strict", 6).alias("strict"))


@query(f"{_entropies(30)} select img, round(coalesce(sum(ent) filter (where ent > 0), 0) / count(*), 6) as ent_pl from e group by img")
def plantation_entropy(spark, d):
    return raster.entropy_score(raster.local_entropy(_masked(spark, d), 30, "img"), 0.0, "img").select("img", F.round("score", 6).alias("ent_pl"))


_RGB = """select a.img, a.r, a.c, a.g as red, b.g as green, c.g as blue, a.m from emb_raster a join emb_raster b on a.img = b.img and b.r * 8 + b.c = (a.r * 8 + a.c + 21) % 64
    join emb_raster c on a.img = c.img and c.r * 8 + c.c = (a.r * 8 + a.c + 42) % 64"""


def _rgb(spark, d):
    p = load(spark, d, "emb_raster")
    at = F.col("r") * 8 + F.col("c")
    shifted = lambda k, name: p.select("img", ((at - k + 64) % 64).alias("at"), F.col("g").alias(name))
    return p.withColumn("at", at).withColumnRenamed("g", "red").join(shifted(21, "green"), ["img", "at"]).join(shifted(42, "blue"), ["img", "at"])


@query(_entropies(5, f"""select img, r, c, cast(coalesce(round_even((y - a) / nullif(b - a, 0) * 255, 0), 0) as integer) as g from
    (select *, min(y) over (partition by img) as a, max(y) over (partition by img) as b from (select *, round_even(cast(0.299 as double) * red + cast(0.587 as double) * green + cast(0.114 as double) * blue, 0) as y from ({_RGB}))) where m > 0""")
    + """ select i.img, round(coalesce(any_value(t.entropy), 0), 6) as entropy from (select distinct img from emb_raster) i
    left join (select img, coalesce(sum(ent) filter (where ent > 5.2), 0) / count(*) as entropy from e group by img) t on i.img = t.img group by i.img""")
def pond_entropy(spark, d):
    return raster.pond_entropy(_rgb(spark, d), "img").select("img", F.round("entropy", 6).alias("entropy"))


@query(f"select img, max(red) = 0 and max(green) = 0 and max(blue) = 0 or coalesce(max(alpha) = 0, false) as empty from (select img, red * (img % 3) as red, green * (img % 3) as green, blue * (img % 3) as blue, case when img % 4 > 0 then 255 * (img % 5) end as alpha from ({_RGB})) group by img")
def tile_empty(spark, d):
    dark = {c: F.col(c) * (F.col("img") % 3) for c in ("red", "green", "blue")}
    return raster.is_empty(_rgb(spark, d).withColumns(dark).withColumn("alpha", F.when(F.col("img") % 4 > 0, 255 * (F.col("img") % 5))), "img")


@query(f"""select img, y * 8 + r - 12 as row, x * 8 + c - 4 as col, red, case when opaque then null else alpha end as alpha from
    (select *, min(alpha) over () = 255 as opaque from (select *, img % 16 as x, img // 16 as y, case when img % 2 = 1 then 0 else 255 end as alpha from ({_RGB})) where img % 2 = 0 and y * 8 + r between 12 and 123 and x * 8 + c between 4 and 83)""")
def mosaic_crop(spark, d):
    tiles = _rgb(spark, d).withColumns({"x": F.col("img") % 16, "y": F.floor(F.col("img") / 16), "alpha": F.when(F.col("img") % 2 == 1, 0).otherwise(255)})
    whole = raster.tile_pixels(tiles, F.struct(F.lit(0).alias("minx"), F.lit(0).alias("miny")), 8, "img")
    return raster.crop(whole, 0.5, 1.5, 10.5, 15.5, (0, 0), 8).select("img", "row", "col", "red", "alpha")


@query(f"""with p as materialized ({_RGB}), b as (select img, m, min(r) as r0, max(r) as r1, min(c) as c0, max(c) as c1 from p where m > 0 group by img, m)
    select p.img, cast(b.m as integer) as segment, p.r, p.c, case when p.m = b.m then red else 0 end as red, case when p.m = b.m then 255 else 0 end as alpha from b join p on p.img = b.img and p.r between r0 and r1 and p.c between c0 and c1""")
def mask_crops(spark, d):
    return raster.mask_crop(_rgb(spark, d).withColumn("label", F.col("m")), "img").select("img", "segment", "r", "c", "red", "alpha")


_CC = """with recursive p as (select img, r, c, r * 8 + c as id from emb_raster where m = 1),
    reach(img, id, root) as (select img, id, id from p union select p.img, p.id, reach.root from reach join p q on q.img = reach.img and q.id = reach.id join p on p.img = q.img and {near}),
    roots as (select img, id, min(root) as root from reach group by img, id)
    select img, id // 8 as r, id % 8 as c, cast(dense_rank() over (partition by img order by root) as integer) as label from roots"""


@query(_CC.format(near="abs(p.r - q.r) + abs(p.c - q.c) = 1"))
def cc4(spark, d):
    return vector.label_images(load(spark, d, "emb_raster"), connectivity=1).select("img", "r", "c", "label")


@query(_CC.format(near="greatest(abs(p.r - q.r), abs(p.c - q.c)) = 1"))
def cc8(spark, d):
    return vector.label_images(load(spark, d, "emb_raster"), connectivity=2).select("img", "r", "c", "label")


@query("""select img, cast(count(*) as double) as area, round(count(*) / cast((max(r) - min(r) + 1) * (max(c) - min(c) + 1) as double), 6) as extent, round(sqrt(4 * count(*) / pi()), 6) as diameter,
    round(2 * sqrt(2 * (a + b + sqrt((a - b) * (a - b) + 4 * k * k))), 5) as major, round(avg(v), 6) as mean from (select *, 0 as z from emb_raster where m = 1),
    lateral (select var_pop(c) + 1 / cast(12 as double) as a, var_pop(r) + 1 / cast(12 as double) as b, covar_pop(r, c) as k from emb_raster e where e.m = 1 and e.img = emb.img) x group by img, a, b, k""".replace("(select *, 0 as z from emb_raster where m = 1)", "(select * from emb_raster where m = 1) emb"))
def region_props(spark, d):
    out = vector.region_properties(load(spark, d, "emb_raster").filter("m = 1"), "img", intensity="v")
    return out.select("img", "area", F.round("extent", 6).alias("extent"), F.round("equivalent_diameter_area", 6).alias("diameter"), F.round("axis_major_length", 5).alias("major"), F.round("intensity_mean", 6).alias("mean"))


@query("""with p as (select img, r, c from emb_raster where m = 1), o as (values (0, 1), (0, -1), (1, 0), (-1, 0))
    select p.img, count(*) as perimeter from p cross join o left join p q on q.img = p.img and q.r = p.r + col0 and q.c = p.c + col1 where q.img is null group by p.img""")
def poly_perimeter(spark, d):
    return raster.exposed_edges(load(spark, d, "emb_raster").filter("m = 1").select("img", "r", "c"), "img")


@query("""with p as (select img, r, c from emb_raster where m = 1), o as (values (0, 1), (0, -1), (1, 0), (-1, 0)),
    e as (select p.img, count(*) as perimeter from p cross join o left join p q on q.img = p.img and q.r = p.r + col0 and q.c = p.c + col1 where q.img is null group by p.img)
    select img, cast(count(*) as double) as area, cast(any_value(perimeter) as double) as perimeter from p join e using (img) group by img""")
def polygonise(spark, d):
    polys = vector.polygonise(load(spark, d, "emb_raster").select("img", "r", "c", F.col("m").alias("label")))
    rings = polys.select("img", F.posexplode("geom").alias("k", "ring"))
    size = F.when(F.col("k") == 0, geo.area(F.col("ring"))).otherwise(-geo.area(F.col("ring")))
    return rings.groupBy("img").agg(F.round(F.sum(size), 6).alias("area"), F.round(F.sum(geo.perimeter(F.col("ring"))), 6).alias("perimeter"))


@query("""select s_suppkey, 'FeatureCollection' as type, n_name as name, 1 as features from supplier join nation on s_nationkey = n_nationkey""")
def geojson_features(spark, d):
    from ..sources import geojson

    t = load(spark, d, "supplier").join(load(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    ring = geo.box_ring(F.col("s_suppkey").cast("double"), F.lit(1.0), F.col("s_suppkey") + F.lit(1.0), F.lit(0.0))
    doc = geojson.collection(t.select("s_suppkey", F.array(ring).alias("geom"), F.create_map(F.lit("name"), F.col("n_name")).alias("properties")), "s_suppkey")
    back = geojson.features(doc.withColumnRenamed("geojson", "value"))
    return back.groupBy("s_suppkey", "type").agg(F.max("properties.name").alias("name"), F.count("*").cast("int").alias("features"))


# --- kernels without SQL ----------------------------------------------------------------------------


@query()
def watershed(spark, d):
    p = load(spark, d, "emb_raster").select("img", "r", "c", ((F.col("v") + 0.5).alias("extent")), F.abs(F.col("v")).alias("boundary"))
    return vector.segment_images(p, t_extent=0.4, t_boundary=0.05)


@query()
def hole_fill(spark, d):
    return vector.fill_holes(load(spark, d, "emb_raster").select("img", "r", "c", F.col("m").cast("int").alias("label")), 4)


@query()
def shape_features(spark, d):
    labels = vector.label_images(load(spark, d, "emb_raster"))
    return vector.shape_features(labels, "img", "label").select("img", "label", F.round("rect", 6).alias("rect"), F.round("frct_dim", 6).alias("frct_dim"))


@query("""with e as (select det_id, k, x, y, coalesce(lead(x) over w, first_value(x) over w) - x as dx, coalesce(lead(y) over w, first_value(y) over w) - y as dy from det_vertices window w as (partition by det_id order by k)),
    u as (select e.det_id, e.k, (max(v.x * dx + v.y * dy) - min(v.x * dx + v.y * dy)) * (max(v.y * dx - v.x * dy) - min(v.y * dx - v.x * dy)) / any_value(dx * dx + dy * dy) as area from e join det_vertices v on e.det_id = v.det_id group by e.det_id, e.k)
    select det_id, round(min(area), 2) as area from u group by det_id""")
def min_rect(spark, d):
    return _rings(spark, d).select("det_id", F.round(geo.area(vector.min_rectangle(F.col("ring"))), 2).alias("area"))


def _placed():
    """The ring as a small one in degrees."""
    return F.transform("ring", lambda p: F.struct((80 + p.x / 100_000).alias("x"), (20 + p.y / 100_000).alias("y")))


def _vertices(rings: DataFrame, digits: int) -> DataFrame:
    return rings.select("det_id", F.posexplode("ring").alias("k", "p")).select("det_id", "k", F.round("p.x", digits).alias("x"), F.round("p.y", digits).alias("y"))


@query()
def simplify(spark, d):
    return _vertices(_rings(spark, d).select("det_id", vector.simplify(F.col("ring"), 5.0).alias("ring")), 3)


@query()
def orthogonalise(spark, d):
    return _vertices(_rings(spark, d).select("det_id", vector.orthogonalise(_placed()).alias("ring")), 9)


@query()
def dissolve(spark, d):
    spark.sparkContext.getCheckpointDir() or spark.sparkContext.setCheckpointDir(_shared_dir(spark))
    at = lambda p: F.struct((p.x / 1e5 + F.col("det_id") % 1000 * 0.0024).alias("x"), (p.y / 1e5 + F.floor(F.col("det_id") / 1000) * 0.0024).alias("y"))
    out = vector.dissolve(_rings(spark, d).select(F.col("det_id").alias("id"), F.transform("ring", at).alias("ring")), 0.0005, 0.01)
    return out.select("cluster", F.size("geom").alias("rings"), F.round(geo.area(F.col("geom")[0]), 9).alias("area"), F.round(geo.perimeter(F.col("geom")[0]), 9).alias("perimeter"))


@query()
def region_groups(spark, d):
    groups = vector.region_groups(load(spark, d, "emb_raster"), min_size=3, max_size=30, threshold=2)
    table = vector.region_table(groups.join(load(spark, d, "emb_raster").select("img", "r", "c", "v"), ["img", "r", "c"]), intensity="v")
    names = ("area", "area_bbox", "area_convex", "area_filled", "perimeter", "solidity", "extent", "axis_major_length", "axis_minor_length", "eccentricity", "elongation", "orientation", "equivalent_diameter_area")
    extra = ("intensity_min", "intensity_max", "intensity_mean", "intensity_std", "intensity_median")
    return table.select("img", "label", *[F.round(c, 6).alias(c) for c in (*names, *extra)])


@query("select img, m, count(*) as area from emb_raster where m > 0 group by img, m having count(*) >= 10 and count(*) <= 24")
def region_sizes(spark, d):
    areas = load(spark, d, "emb_raster").filter("m > 0").groupBy("img", "m").agg(F.count("*").alias("area"))
    return rules.sized(areas, 10, 24)


@query("select cast(max(x_tile - 96446) as bigint) as max_i, cast(max(y_tile - 56783) as bigint) as max_j, max(det_id) as max_label from detections")
def chunk_extent(spark, d):
    own = load(spark, d, "detections").select((F.col("x_tile") - 96446).cast("bigint").alias("i"), (F.col("y_tile") - 56783).cast("bigint").alias("j"), F.col("det_id").alias("label"))
    return rules.extent(own)


@query(f"""with t as (select user_id, cast({_TX} as bigint) as x, cast({_TY} as bigint) as y from
    (select user_id, unnest([a, b]) as lon, unnest([p, q]) as lat from (select user_id, min(lon) as a, max(lon) as b, min(lat) as p, max(lat) as q from geo_points group by user_id)))
    select user_id, min(x) as xmin, max(x) as xmax, min(y) as ymin, max(y) as ymax from t group by user_id""")
def tile_ranges(spark, d):
    box = load(spark, d, "geo_points").groupBy("user_id").agg(F.min("lon").alias("minx"), F.max("lon").alias("maxx"), F.min("lat").alias("miny"), F.max("lat").alias("maxy"))
    span = grid.tile_range(*map(F.col, ("minx", "miny", "maxx", "maxy")), Z)
    return box.select("user_id", span.alias("s")).select("user_id", "s.*")


@query("""select det_id, x, y from (select det_id, x_tile, y_tile, det_id % 3 as w, det_id % 2 as h from detections),
    lateral (select unnest(range(x_tile, x_tile + w + 1)) as x) a, lateral (select unnest(range(y_tile, y_tile + h + 1)) as y) b""")
def tiles_inclusive(spark, d):
    span = F.struct(F.col("x_tile").alias("xmin"), (F.col("x_tile") + F.col("det_id") % 3).alias("xmax"), F.col("y_tile").alias("ymin"), (F.col("y_tile") + F.col("det_id") % 2).alias("ymax"))
    return load(spark, d, "detections").select("det_id", F.explode(grid.tiles_within(span)).alias("t")).select("det_id", "t.x", "t.y")


@query("select event_id, lat, lon, lat - 0.5 as south, lon + 0.25 as east from geo_points")
def corner_pairs(spark, d):
    at = lambda a, b: F.struct(a.alias("lat"), b.alias("lon"))
    stored = txt.corner_text(at(F.col("lat"), F.col("lon")), at(F.col("lat") - 0.5, F.col("lon") + 0.25))
    back = load(spark, d, "geo_points").select("event_id", txt.corner_pair(stored).alias("p"))
    return back.select("event_id", "p.tl.lat", "p.tl.lon", F.col("p.br.lat").alias("south"), F.col("p.br.lon").alias("east"))


@query("""select det_id, case when det_id % 4 < 2 then x_tile end as pond_x, case when det_id % 4 < 2 then y_tile end as pond_y, case when det_id % 4 in (0, 3) then y_tile end as well_y from detections""")
def tile_name_variants(spark, d):
    t = load(spark, d, "detections")
    name = txt.tile_name(F.col("z"), F.col("x_tile"), F.col("y_tile"))
    stem = F.replace(name, F.lit(".tif"), F.lit(""))
    odd = F.when(F.col("det_id") % 4 == 0, name).when(F.col("det_id") % 4 == 1, F.concat(F.lit("/data/a_b/"), stem, F.lit(" (1).x_y.png"))).when(F.col("det_id") % 4 == 2, F.concat(F.lit("tile_"), F.col("x_tile").cast("string"))).otherwise(F.concat(F.lit("a/"), stem))
    own = t.select("det_id", odd.alias("name"), F.when(F.col("det_id") % 4 == 3, F.lit(None)).otherwise(odd).alias("pond"))
    pond, well = txt.tile_numbers(F.col("pond")), txt.tile_numbers(F.col("name"), exact=True)
    return own.select("det_id", pond["x_tile"].alias("pond_x"), pond["y_tile"].alias("pond_y"), well["y_tile"].alias("well_y"))


@query(f"""select det_id, cast(k as integer) as k, round(radians(lon) * 6378137.0, 3) as x, round(ln(tan(radians(45 + lat / 2))) * 6378137.0, 3) as y from (select det_id, k, 80 + x / 100000 as lon, 20 + y / 100000 as lat from det_vertices)""")
def ring_to_mercator(spark, d):
    return _vertices(_rings(spark, d).select("det_id", vector.to_crs(_placed(), 4326, 3857).alias("ring")), 3)


@query("""with v as (select det_id, k, 80 + x / 100000 as lon, 20 + y / 100000 as lat from det_vertices),
    e as (select det_id, lon, lat, coalesce(lead(lon) over w, first_value(lon) over w) as lon2, coalesce(lead(lat) over w, first_value(lat) over w) as lat2 from v window w as (partition by det_id order by k))
    select det_id, round(abs(sum(radians(lon2 - lon) * (2 + sin(radians(lat)) + sin(radians(lat2))))) * 6371.0088 * 6371.0088 / 2, 6) as km2 from e group by det_id""")
def sphere_areas(spark, d):
    return _rings(spark, d).select("det_id", F.round(vector.sphere_area(_placed()), 6).alias("km2"))


@query(f"""select det_id, cast(floor((cy - 256) / (-256 / cast(64 as double))) as bigint) as row, cast(floor(cx / (256 / cast(64 as double))) as bigint) as col from (
    select det_id, sum((x + x2) * (x * y2 - x2 * y)) / (3 * sum(x * y2 - x2 * y)) + 0.013 as cx, sum((y + y2) * (x * y2 - x2 * y)) / (3 * sum(x * y2 - x2 * y)) + 0.013 as cy from ({_SHOE}) group by det_id)""")
def centroid_cells(spark, d):
    moved = F.transform("ring", lambda p: F.struct((p.x + 0.013).alias("x"), (p.y + 0.013).alias("y")))
    cell = vector.centroid_cells(moved, merc.affine(*map(F.lit, (0.0, 0.0, 256.0, 256.0)), 64, 64))
    return _rings(spark, d).select("det_id", cell["row"].alias("row"), cell["col"].alias("col"))


@query("""with n as (select count(*) as n from customer), l as (select 'all' as layer, c_custkey as idx from customer union all select 'plantation', c_custkey from customer where c_custkey % 2 = 0)
    select 'D_B_boundaries' || case when n > 200 then '_' || (idx // 200 * 200) || '_' || least(idx // 200 * 200 + 200, n) else '' end as name, layer, count(*) as rows from l, n where idx < n group by all""")
def merge_slices(spark, d):
    from . import jobs

    own = load(spark, d, "customer").select(F.lit("all").alias("layer"), F.col("c_custkey").alias("block"))
    n = own.count()
    extra = own.filter("block % 2 = 0").withColumn("layer", F.lit("plantation"))
    return jobs.merge_blocks(own.unionByName(extra), n, "D", "B").groupBy("name", "layer").agg(F.count("*").alias("rows"))


@query(f"select event_id, round(lon + 512 * 360 / ({_N} * 256), 9) as lon, round({_LAT.format(y=f'({_PY} + 512) / ({_N} * 256)')}, 9) as lat from geo_points")
def unsnapped_corner(spark, d):
    c = merc.opposite_corner_unsnapped(*lat_lon(), Z, 2)
    return load(spark, d, "geo_points").select("event_id", F.round(c["lon"], 9).alias("lon"), F.round(c["lat"], 9).alias("lat"))


@query(f"select event_id, round((lon + 180) / 360 * {_N}, 6) as x, round((1 - ln(tan(radians(lat)) + 1 / cos(radians(lat))) / pi()) / 2 * {_N}, 6) as y from geo_points")
def tile_fractions(spark, d):
    t = merc.tile_fraction(*lat_lon(), Z)
    return load(spark, d, "geo_points").select("event_id", F.round(t["x"], 6).alias("x"), F.round(t["y"], 6).alias("y"))


@query("""select event_id, c0, r0, c1, r1 from (select event_id, cast(floor((lon - 70) / (20 / cast(512 as double))) as bigint) as c0, cast(floor((lat - 30) / ((10 - 30) / cast(512 as double))) as bigint) as r0,
    cast(floor((lon + 1.5 - 70) / (20 / cast(512 as double))) as bigint) as c1, cast(floor((lat + 0.75 - 30) / ((10 - 30) / cast(512 as double))) as bigint) as r1 from geo_points)
    where c0 >= 0 and c0 < 512 and r0 >= 0 and r0 < 512 and c1 >= 0 and c1 < 512 and r1 >= 0 and r1 < 512""")
def boxes_to_cells(spark, d):
    t = merc.affine(*map(F.lit, (70.0, 10.0, 90.0, 30.0)), 512, 512)
    boxes = load(spark, d, "geo_points").select("event_id", F.col("lon").alias("minx"), F.col("lat").alias("miny"), (F.col("lon") + 1.5).alias("maxx"), (F.col("lat") + 0.75).alias("maxy"))
    box = F.col("pixel_box")
    return windows.boxes_to_pixels(boxes, t, 512, 512).select("event_id", *[box[i].alias(c) for i, c in enumerate(("c0", "r0", "c1", "r1"))])


@query("""select det_id, count(*) as vertices from det_vertices where (det_id + k) % 4 > 0 group by det_id having count(*) >= 3""")
def finite_rings(spark, d):
    broken = F.transform("ring", lambda p, k: F.struct(F.when((F.col("det_id") + k) % 8 == 0, F.lit(float("nan"))).when((F.col("det_id") + k) % 8 == 4, F.lit(float("inf"))).otherwise(p.x).alias("x"), p.y.alias("y")))
    rings = _rings(spark, d).select("det_id", geo.finite(broken).alias("ring")).filter(F.size("ring") >= 3)
    return rings.select("det_id", F.size("ring").cast("bigint").alias("vertices"))


@query("select o_orderkey as k, 'f' || lpad(cast(o_orderkey // 7 as varchar), 6, '0') || '.jpg' as name from orders where o_orderkey % 7 = 0")
def frame_numbers(spark, d):
    return windows.frames(load(spark, d, "orders").select(F.col("o_orderkey").alias("k")), 29, 4, "f")


@query("select event_type, min(lon) as minx, min(lat) as miny, max(lon) as maxx, max(lat) as maxy from geo_points group by event_type")
def total_bounds(spark, d):
    rings = load(spark, d, "geo_points").select("event_type", geo.box_ring(F.col("lon"), F.col("lat"), F.col("lon"), F.col("lat")).alias("ring"))
    return vector.total_bounds(rings, "event_type")


@query(f"select img, r, c, cast(round_even(cast(0.299 as double) * red + cast(0.587 as double) * green + cast(0.114 as double) * blue, 0) as integer) as gray from ({_RGB})")
def grayscale(spark, d):
    return _rgb(spark, d).select("img", "r", "c", F.rint(raster.luma(F.col("red"), F.col("green"), F.col("blue"))).cast("int").alias("gray"))


@query(f"select img, r, c, red, green, blue from ({_RGB})")
def band_channels(spark, d):
    bands = _rgb(spark, d).select("img", "r", "c", F.posexplode(F.array("red", "green", "blue", F.col("m").cast("bigint"))).alias("band", "v"))
    return raster.channels(bands, "img")


@query("select img, round(min(v), 6) as least, round(max(v), 6) as most, round(median(v), 6) as middle, round(stddev_pop(v), 6) as spread from emb_raster where m = 1 group by img")
def region_intensity(spark, d):
    out = vector.region_properties(load(spark, d, "emb_raster").filter("m = 1"), "img", intensity="v")
    names = {"least": "min", "most": "max", "middle": "median", "spread": "std"}
    return out.select("img", *[F.round(f"intensity_{v}", 6).alias(k) for k, v in names.items()])


@query("""select a.img, a.r, a.c, b.v as v from emb_raster a join emb_raster b on a.img = b.img and b.r = floor((a.r + 0.5) * 0.75 + 0.25) and b.c = floor((a.c + 0.5) * 0.75 + 0.5)""")
def warp_nearest(spark, d):
    p = load(spark, d, "emb_raster")
    source = merc.affine(*map(F.lit, (0.0, 0.0, 8.0, 8.0)), 8, 8)
    target = F.struct(F.lit(0.5).alias("x0"), F.lit(0.75).alias("pw"), F.lit(0.0).alias("rx"), F.lit(7.75).alias("y0"), F.lit(0.0).alias("ry"), F.lit(-0.75).alias("ph"))
    return windows.warp(p.select("img", "r", "c", "v"), source, 4326, p.select("img", "r", "c"), target, 4326)


@query("""select a.img, a.r, a.c, round(sum(b.v), 9) as v from emb_raster a join emb_raster b on a.img = b.img and abs(a.r - b.r) <= 1 and abs(a.c - b.c) <= 1 group by a.img, a.r, a.c""")
def halo_windows(spark, d):
    def blur(w):
        import numpy as np

        p = np.pad(w, 1)
        return sum(p[1 + i : p.shape[0] - 1 + i, 1 + j : p.shape[1] - 1 + j] for i in (-1, 0, 1) for j in (-1, 0, 1))

    out = windows.map_windows(load(spark, d, "emb_raster").select("img", "r", "c", "v"), blur, 5, 1)
    return out.select("img", "r", "c", F.round("v", 9).alias("v"))


@query()
def window_lead(spark, d):
    out = _rings(spark, d).select("det_id", F.posexplode(rules.ring_neighbours(F.transform("ring", lambda p: p.x))).alias("k", "n"))
    return out.select("det_id", "k", "n.before", "n.own", "n.after")


SQL["window_lead"] = with_fixtures("""select det_id, cast(k as integer) as k, coalesce(lag(x) over w, last_value(x) over (partition by det_id order by k rows between unbounded preceding and unbounded following)) as before,
    x as own, coalesce(lead(x) over w, first_value(x) over w) as after from det_vertices window w as (partition by det_id order by k)""")


def _shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; on a local master that names none, one of its own, removed at exit."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base
    import atexit
    import shutil
    import tempfile

    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a shared folder")
    base = tempfile.mkdtemp(prefix="tileframe-")
    atexit.register(shutil.rmtree, base, ignore_errors=True)
    return base
