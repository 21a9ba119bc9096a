"""Rings as array<struct<x double, y double>>: measures and predicates as Column expressions.

Rings may be open or closed; every function closes them itself.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def close(ring: Column) -> Column:
    return F.concat(ring, F.slice(ring, 1, 1))


def finite(ring: Column) -> Column:
    """The ring's vertices without those that hold a null, NaN or infinite coordinate."""
    good = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    return F.filter(ring, lambda p: good(p.x) & good(p.y))


def edges(ring: Column) -> Column:
    """array<struct<a, b>> of consecutive vertices, the last with the first."""
    after = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    return F.zip_with(ring, after, lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def _sum(items: Column, f) -> Column:
    return F.aggregate(items, F.lit(0.0), lambda acc, e: acc + f(e))


def _cross(e: Column) -> Column:
    return e.a.x * e.b.y - e.b.x * e.a.y


def signed_area(ring: Column) -> Column:
    return _sum(edges(ring), _cross) / 2


def area(ring: Column) -> Column:
    return F.abs(signed_area(ring))


def perimeter(ring: Column) -> Column:
    return _sum(edges(ring), lambda e: F.hypot(e.b.x - e.a.x, e.b.y - e.a.y))


def area_centroid(ring: Column) -> Column:
    """struct<x, y>; null for a ring without area."""
    six = 6 * signed_area(ring)
    part = lambda c: F.try_divide(_sum(edges(ring), lambda e: (e.a[c] + e.b[c]) * _cross(e)), six)
    return F.struct(part("x").alias("x"), part("y").alias("y"))


def vertex_mean(ring: Column) -> Column:
    """struct<x, y>: the mean of the finite vertices."""
    own = finite(ring)
    part = lambda c: F.try_divide(_sum(own, lambda p: p[c]), F.size(own))
    return F.struct(part("x").alias("x"), part("y").alias("y"))


def box_ring(left: Column, top: Column, right: Column, bottom: Column) -> Column:
    corner = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    return F.array(corner(left, top), corner(right, top), corner(right, bottom), corner(left, bottom))


def bounds(ring: Column) -> Column:
    x, y = F.transform(ring, lambda p: p.x), F.transform(ring, lambda p: p.y)
    return F.struct(F.array_min(x).alias("minx"), F.array_min(y).alias("miny"), F.array_max(x).alias("maxx"), F.array_max(y).alias("maxy"))


def contains(ring: Column, x: Column, y: Column) -> Column:
    """Point in polygon, by the parity of edges to its right."""
    spans = F.filter(edges(ring), lambda e: (e.a.y > y) != (e.b.y > y))
    hits = F.filter(spans, lambda e: x < F.try_divide((e.b.x - e.a.x) * (y - e.a.y), e.b.y - e.a.y) + e.a.x)
    return F.size(hits) % 2 == 1


def _side(a: Column, b: Column, p: Column) -> Column:
    return (b.x - a.x) * (p.y - a.y) - (b.y - a.y) * (p.x - a.x)


def crosses(e: Column, f: Column) -> Column:
    """Two edges that properly cross."""
    return (_side(e.a, e.b, f.a) * _side(e.a, e.b, f.b) < 0) & (_side(f.a, f.b, e.a) * _side(f.a, f.b, e.b) < 0)


def box_intersects(minx: Column, miny: Column, maxx: Column, maxy: Column, ring: Column) -> Column:
    """Rectangle and polygon meet: a corner in the polygon, a vertex in the rectangle, or edges that cross."""
    corners = [(minx, miny), (minx, maxy), (maxx, miny), (maxx, maxy)]
    vertex = F.exists(ring, lambda p: (p.x >= minx) & (p.x <= maxx) & (p.y >= miny) & (p.y <= maxy))
    sides = edges(box_ring(minx, maxy, maxx, miny))
    return reduce(or_, [contains(ring, x, y) for x, y in corners]) | vertex | F.exists(sides, lambda s: F.exists(edges(ring), lambda e: crosses(s, e)))


def wide(ring: Column, most: int) -> list[Column]:
    """X_1, Y_1 ... as columns, padded with nulls."""
    return [F.get(ring, F.lit(i))[c].alias(f"{c.upper()}_{i + 1}") for i in range(most) for c in ("x", "y")]


def from_wide(most: int) -> Column:
    """The ring of X_1, Y_1 ... columns, up to the first null."""
    points = F.array(*[F.struct(F.col(f"X_{i}").alias("x"), F.col(f"Y_{i}").alias("y")) for i in range(1, most + 1)])
    ends = F.filter(F.sequence(F.lit(1), F.lit(most)), lambda i: F.element_at(points, i).x.isNull() | F.element_at(points, i).y.isNull())
    return F.slice(points, 1, F.coalesce(F.array_min(ends), F.lit(most + 1)) - 1)
