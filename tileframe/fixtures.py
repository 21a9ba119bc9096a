"""Geospatial inputs derived from the base tables: SQL that Spark and DuckDB both run, or one text for each."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

SHARED = {
    "geo_points": """select event_id, user_id, event_type, 68 + (event_id*37 % 29000)/cast(1000 as double) as lon,
       8 + (event_id*91 % 28000)/cast(1000 as double) as lat from events""",
    "detections": """select o_orderkey as det_id, 17 as z, 96446 + o_orderkey % 16 as x_tile, 56783 + cast(floor(o_orderkey/16) as bigint) % 16 as y_tile,
       case o_orderkey % 3 when 0 then 'Dry' when 1 then 'Wet' else 'Wells' end as cls, (o_custkey % 101)/cast(100 as double) as conf,
       case when o_orderkey % 3 = 1 then (o_orderkey % 50)/cast(10 as double) end as entropy, 3 + o_orderkey % 6 as nv, 20 + o_custkey % 60 as rad from orders""",
    "segments": """select p_partkey as value, (p_partkey*7 % 60)/cast(10 as double) as ent, (p_partkey*11 % 120)/cast(10 as double) as ent_pl,
       (p_partkey*13 % 100)/cast(100 as double) as rect, case when p_partkey % 2 = 0 then p_partkey*37 % 2500 else p_partkey*p_partkey % 150000 end as size,
       p_partkey % 5 as num_lines, (p_partkey % 20)/cast(10 as double) as red from part""",
    "line_segments": """select event_id as line_id, event_id % 100 as seg, event_id*7 % 256 as x1, event_id*11 % 256 as y1, event_id*29 % 251 as x2, event_id*17 % 241 as y2
       from events""",
    "block_status": """select c_custkey as idx, c_custkey % 2 = 0 as overall_status, c_custkey % 3 <> 0 as download_status_17, c_custkey % 5 = 0 as download_status_18, c_custkey % 4 = 0 as model_status from customer""",
    "places": """select s_suppkey, r_name as state, n_name as district, concat(s_name, ' (x)!') as block
       from supplier join nation on s_nationkey=n_nationkey join region on n_regionkey=r_regionkey""",
}

SPARK = SHARED | {
    "det_vertices": """select det_id, k, round(128 + rad*cos(2*pi()*k/nv), 3) as x, round(128 + rad*sin(2*pi()*k/nv), 3) as y
       from (select *, explode(sequence(0, nv-1)) as k from detections) t""",
    "emb_raster": """select vec_id as img, label, cast(floor(p/8) as bigint) as r, cast(p%8 as bigint) as c, cast(v as double) as v,
       case when cast(v as double) >= cast(0.05 as double) then 1 else 0 end as m, cast(floor((cast(v as double)+1)*127) as bigint) as g
       from (select vec_id, label, posexplode(embedding) as (p,v) from embeddings) t""",
}

DUCKDB = SHARED | {
    "det_vertices": """select det_id, k, round(128 + rad*cos(2*pi()*k/nv), 3) as x, round(128 + rad*sin(2*pi()*k/nv), 3) as y
       from (select *, unnest(range(nv)) as k from detections) t""",
    "emb_raster": """select vec_id as img, label, cast(floor((p-1)/8) as bigint) as r, cast((p-1)%8 as bigint) as c, cast(embedding[p] as double) as v,
       case when cast(embedding[p] as double) >= cast(0.05 as double) then 1 else 0 end as m, cast(floor((cast(embedding[p] as double)+1)*127) as bigint) as g
       from embeddings, generate_series(1,64) t(p)""",
}

#: A convex region of interest, (lon, lat).
ROI = ((70.0, 10.0), (95.0, 12.0), (90.0, 33.0), (72.0, 30.0))


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table or a fixture."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = SPARK[name]
    used = sorted(x for x in [*TABLES, *SPARK] if re.search(rf"(from|join) {x}\b", text))
    for x in used:
        text = re.sub(rf"(from|join) {x}\b", rf"\1 {{{x}}}", text)
    return spark.sql(text, **{x: load(spark, sf_dir, x) for x in used})


def with_fixtures(sql: str) -> str:
    """DuckDB SQL with the fixtures that it names before it."""
    needed: list[str] = []

    def need(text: str) -> None:
        for x in DUCKDB:
            if re.search(rf"(from|join) {x}\b", text) and x not in needed:
                need(DUCKDB[x])
                needed.append(x)

    need(sql)
    ctes = ", ".join(f"{x} as ({DUCKDB[x]})" for x in needed)
    if not ctes:
        return sql
    sql = sql.strip()
    if sql.lower().startswith("with recursive "):
        return f"with recursive {ctes}, {sql[15:]}"
    return f"with {ctes}, {sql[5:]}" if sql.lower().startswith("with ") else f"with {ctes} {sql}"
