"""Tables for maps and for browsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillwork.functions import geom, tags

#: Layers and the zooms they are made for.
LAYERS = {"err_points": range(0, 7), "water_lines": range(6, 10), "water_areas": range(7, 10)}
EXTENT = 4096


def object_link(id_: Column) -> Column:
    """``relation/5`` for negative ids, else ``way/5``."""
    return F.when(id_ < 0, F.concat(F.lit("relation/"), (-id_).cast("string"))).otherwise(F.concat(F.lit("way/"), id_.cast("string")))


def error_table_view(errors: DataFrame, id_: str = "way_osm_id", shape: str = "geom") -> DataFrame:
    """Adds ``bbox`` [left, right, top, bottom] in degrees, ``osm_ids`` and ``link`` to an error table."""
    box = F.transform(geom.bbox(F.col(shape)), lambda v: v / geom.SCALE)
    ids = F.col("osm_ids") if "osm_ids" in errors.columns else F.array(id_)
    return errors.withColumn("bbox", box).withColumn("osm_ids", ids).withColumn("link", object_link(F.col("osm_ids")[0]))


def line_type() -> Column:
    """r, c, s, d with t behind it in a tunnel; null for other ways."""
    kind = F.when(tags.tag("waterway") == "river", "r").when(tags.tag("waterway") == "canal", "c").when(tags.tag("waterway") == "stream", "s").when(tags.tag("waterway").isin("drain", "ditch"), "d")
    return F.concat(kind, F.when(tags.has("tunnel") & (tags.tag("tunnel") != "no"), F.lit("t")).otherwise(F.lit("")))


def tile_of(p: Column, zoom: Column | int) -> Column:
    """Tile ``struct<z,x,y,px,py>`` of a point; px and py are places within the tile's extent."""
    z = F.lit(zoom).cast("int") if isinstance(zoom, int) else zoom
    n = F.pow(F.lit(2.0), z)
    m = geom.mercator(p)
    world = 2 * 3.141592653589793 * geom.EARTH
    fx, fy = (m["x"] / world + 0.5) * n, (0.5 - m["y"] / world) * n
    top = n.cast("bigint") - 1
    tx, ty = F.least(F.greatest(F.floor(fx), F.lit(0)), top), F.least(F.greatest(F.floor(fy), F.lit(0)), top)
    return F.struct(z.alias("z"), tx.alias("x"), ty.alias("y"), F.floor((fx - tx) * EXTENT).cast("int").alias("px"), F.floor((fy - ty) * EXTENT).cast("int").alias("py"))


def _crossed(seg: Column, z: Column) -> Column:
    """Tiles ``x, y`` of a zoom that a segment passes: for each column of tiles the rows between its two crossings."""
    n = F.pow(F.lit(2.0), z)
    world = 2 * 3.141592653589793 * geom.EARTH
    a, b = geom.mercator(seg["a"]), geom.mercator(seg["b"])
    x1, y1, x2, y2 = (a["x"] / world + 0.5) * n, (0.5 - a["y"] / world) * n, (b["x"] / world + 0.5) * n, (0.5 - b["y"] / world) * n
    tile = lambda v: F.least(F.greatest(F.floor(v), F.lit(0)), n.cast("bigint") - 1)
    left, right = F.least(x1, x2), F.greatest(x1, x2)
    slope = (y2 - y1) / F.nullif(x2 - x1, F.lit(0.0))

    def column(x: Column) -> Column:
        ya = F.coalesce(y1 + (F.greatest(left, x.cast("double")) - x1) * slope, y1)
        yb = F.coalesce(y1 + (F.least(right, x + F.lit(1.0)) - x1) * slope, y2)
        return F.transform(F.sequence(tile(F.least(ya, yb)), tile(F.greatest(ya, yb))), lambda y: F.struct(x.alias("x"), y.alias("y")))

    return F.flatten(F.transform(F.sequence(tile(left), tile(right)), column))


def line_layer(ways: DataFrame, err_all: DataFrame, zooms=LAYERS["water_lines"]) -> DataFrame:
    """Features of the line layer: ``id, type, name, errs, z, x, y``, one row for each tile the line passes."""
    w = ways.where(F.size("geom") > 0).join(err_all.select(F.col("osm_id").alias("way_osm_id"), F.array_join("err_ids", ",").alias("errs")), "way_osm_id", "left")
    f = w.select(F.col("way_osm_id").alias("id"), line_type().alias("type"), tags.tag("name").alias("name"), "errs", "geom").where("type is not null")
    p = F.col("geom")[0]
    parts = F.coalesce(geom.segments(F.col("geom")), F.array(F.struct(p.alias("a"), p.alias("b"))))
    z = f.withColumn("parts", parts).withColumn("z", F.explode(F.array(*[F.lit(i) for i in zooms])))
    t = z.withColumn("t", F.explode(F.array_distinct(F.flatten(F.transform("parts", lambda s: _crossed(s, F.col("z")))))))
    return t.select("id", "type", "name", "errs", "z", F.col("t.x").alias("x"), F.col("t.y").alias("y"))


def point_layer(errors: DataFrame, zooms=LAYERS["err_points"]) -> DataFrame:
    """Error points of every zoom, those at one place of a tile as one with their number."""
    e = errors.select(F.col("osm_id"), F.col("p")).where("p is not null").withColumn("t", F.explode(F.array(*[tile_of(F.col("p"), i) for i in zooms])))
    return e.groupBy("t.z", "t.x", "t.y", "t.px", "t.py").agg(F.count("*").alias("n"), F.min("osm_id").alias("id"))
