"""Geometry on fixed-point coordinates (integers of 1e-7 degrees) as Column expressions.

A point is ``struct<x,y>``, a line an array of points. Equality of lines is equality of
the arrays. Predicates are exact on integers; measures convert to double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 1e7
EARTH = 6378137.0


def start_point(line: Column) -> Column:
    return F.try_element_at(line, F.lit(1))


def end_point(line: Column) -> Column:
    return F.try_element_at(line, F.lit(-1))


def point_from_text(wkt: Column) -> Column:
    """``Point(lon lat)`` as a point; null for null, empty and unreadable text."""
    num = r"(-?[0-9.]+(?:[eE][-+]?[0-9]+)?)"
    pat = rf"(?i)^\s*point\s*\(\s*{num}\s+{num}\s*\)\s*$"
    x = F.regexp_extract(wkt, pat, 1).try_cast("double")
    y = F.regexp_extract(wkt, pat, 2).try_cast("double")
    return F.when(x.isNotNull() & y.isNotNull(), F.struct(F.round(x * SCALE).cast("bigint").alias("x"), F.round(y * SCALE).cast("bigint").alias("y")))


def line_of(a: Column, b: Column) -> Column:
    """Line of two points; null when either is."""
    return F.when(a.isNotNull() & b.isNotNull(), F.array(a, b))


def line_from_points(points: Column) -> Column:
    """Line through the points that aren't null; null when none is left."""
    c = F.array_compact(points)
    return F.when(F.size(c) > 0, c)


def mercator(p: Column) -> Column:
    """Spherical web mercator, metres."""
    return F.when(p.isNotNull(), F.struct(
        (F.lit(EARTH) * F.radians(p["x"] / SCALE)).alias("x"),
        (F.lit(EARTH) * F.log(F.tan(F.lit(0.7853981633974483) + F.radians(p["y"] / SCALE) / 2))).alias("y")))


def from_mercator(p: Column) -> Column:
    return F.when(p.isNotNull(), F.struct(
        F.round(F.degrees(p["x"] / EARTH) * SCALE).cast("bigint").alias("x"),
        F.round(F.degrees(2 * F.atan(F.exp(p["y"] / EARTH)) - F.lit(1.5707963267948966)) * SCALE).cast("bigint").alias("y")))


def segments(line: Column) -> Column:
    """Array of ``struct<a,b>`` of consecutive points."""
    n = F.size(line)
    return F.when(n > 1, F.zip_with(F.slice(line, F.lit(1), n - 1), F.slice(line, F.lit(2), n - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b"))))


def closest_point(line: Column, p: Column) -> Column:
    """``struct<d,i,x,y>``: distance, segment number and place of the line's point closest to ``p``; first on a tie."""
    def one(s: Column, i: Column) -> Column:
        dx, dy = (s["b"]["x"] - s["a"]["x"]).cast("double"), (s["b"]["y"] - s["a"]["y"]).cast("double")
        n = dx * dx + dy * dy
        t = F.when(n == 0, F.lit(0.0)).otherwise(((p["x"] - s["a"]["x"]) * dx + (p["y"] - s["a"]["y"]) * dy) / F.nullif(n, F.lit(0.0)))
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
        x, y = s["a"]["x"] + t * dx, s["a"]["y"] + t * dy
        return F.struct(F.hypot((x - p["x"]).cast("double"), (y - p["y"]).cast("double")).alias("d"), i.alias("i"), x.cast("double").alias("x"), y.cast("double").alias("y"))

    return F.when(p.isNotNull() & line.isNotNull(), F.array_min(F.transform(segments(line), one)))


def planar_distance(line: Column, p: Column) -> Column:
    return closest_point(line, p)["d"]


def on_segment(p: Column, a: Column, b: Column) -> Column:
    """Exact test that a point lies on a closed segment."""
    d = lambda c: c.cast("decimal(19,0)")
    inside = (
        (p["x"] >= F.least(a["x"], b["x"])) & (p["x"] <= F.greatest(a["x"], b["x"]))
        & (p["y"] >= F.least(a["y"], b["y"])) & (p["y"] <= F.greatest(a["y"], b["y"]))
    )
    return inside & (d(b["x"] - a["x"]) * d(p["y"] - a["y"]) == d(b["y"] - a["y"]) * d(p["x"] - a["x"]))


def on_line(p: Column, line: Column) -> Column:
    return F.exists(segments(line), lambda s: on_segment(p, s["a"], s["b"]))


def _side(p: Column, a: Column, b: Column) -> Column:
    d = lambda c: c.cast("decimal(19,0)")
    return F.signum((d(b["x"] - a["x"]) * d(p["y"] - a["y"]) - d(b["y"] - a["y"]) * d(p["x"] - a["x"])).cast("double"))


def segments_meet(a: Column, b: Column, c: Column, d: Column) -> Column:
    proper = (_side(a, c, d) * _side(b, c, d) < 0) & (_side(c, a, b) * _side(d, a, b) < 0)
    return proper | on_segment(a, c, d) | on_segment(b, c, d) | on_segment(c, a, b) | on_segment(d, a, b)


def lines_meet(l1: Column, l2: Column) -> Column:
    """Do two lines share a point?"""
    return F.coalesce(F.exists(segments(l1), lambda s: F.exists(segments(l2), lambda t: segments_meet(s["a"], s["b"], t["a"], t["b"]))), F.lit(False))


def bbox(line: Column) -> Column:
    """``[left, right, top, bottom]``."""
    xs, ys = F.transform(line, lambda p: p["x"]), F.transform(line, lambda p: p["y"])
    return F.array(F.array_min(xs), F.array_max(xs), F.array_max(ys), F.array_min(ys))
