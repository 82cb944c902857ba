"""Routing and shaping of raw nodes, ways and relations into typed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillwork.functions import measures, tags


def _cleaned(df: DataFrame) -> DataFrame:
    return df.withColumn("raw_tags", F.col("tags")).withColumn("tags", tags.clean_tags(F.col("tags"))).where(F.size("tags") > 0)


def route_points(nodes: DataFrame) -> DataFrame:
    """Water nodes: ``pnt_osm_id, tags, geom``. nodes: ``id, tags, x, y``. The kind is read before cleaning."""
    keep = tags.tag("natural", "raw_tags").isin("water", "spring", "hot_spring", "geyser") | tags.has("waterway", "raw_tags")
    return _cleaned(nodes).where(keep & F.col("x").isNotNull() & F.col("y").isNotNull()).select(
        F.col("id").alias("pnt_osm_id"), "tags", F.struct("x", "y").alias("geom"))


def way_lines(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """Adds ``geom`` to ways: their nodes' points in order, unknown nodes left out.

    ways: ``id, tags, nodes``; nodes: ``id, x, y``. Ways with fewer than two known points have a null geom.
    """
    at = ways.select("id", F.posexplode("nodes").alias("pos", "node"))
    xy = nodes.select(F.col("id").alias("node"), "x", "y").where("node is not null and x is not null and y is not null").groupBy("node").agg(F.min(F.struct("x", "y")).alias("p"))
    g = at.join(xy, "node").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "p"))).alias("g"))
    line = F.when(F.size("g") > 1, F.transform("g", lambda s: s["p"]))
    return ways.join(g.select("id", line.alias("geom")), "id", "left")


def is_closed() -> Column:
    n = F.col("nodes")
    return F.coalesce((F.size(n) > 2) & (F.try_element_at(n, F.lit(1)) == F.try_element_at(n, F.lit(-1))), F.lit(False))


def route_ways(ways: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Water ways as lines and, when closed, as areas. ways: ``id, tags, nodes, geom``."""
    w = _cleaned(ways).where(tags.has_water_tags() & F.col("geom").isNotNull())
    lines = w.where(~is_closed()).select(F.col("id").alias("way_osm_id"), "tags", "nodes", "geom")
    areas = w.where(is_closed()).select(F.col("id").alias("way_osm_id"), "tags", "nodes", F.array(F.array("geom")).alias("geom"))
    return lines, areas


def route_relations(relations: DataFrame) -> DataFrame:
    """Relations of watercourses: ``rel_osm_id, tags, members``. relations: ``id, tags, members``."""
    return _cleaned(relations).where(tags.tag("type", "raw_tags") == "waterway").select(F.col("id").alias("rel_osm_id"), "tags", "members")


@measures.arrow_udf("array<array<array<struct<x:bigint,y:bigint>>>>")
def _polygons(lines: list) -> list:
    def one(ls: list | None) -> list | None:
        return [[[{"x": int(x), "y": int(y)} for x, y in r] for r in p] for p in measures.polygons(ls or [])] or None

    return [one(ls) for ls in lines]


def relation_areas(relations: DataFrame, lines: DataFrame) -> DataFrame:
    """Multipolygon relations of water as areas: negative id, null nodes, rings put together from their ways.

    relations: ``id, tags, members``; lines: ``id, geom``. Rings are nested by what lies in what
    (even-odd), whatever the members' roles: ``geom`` has the polygons, each with its outer ring
    first and its holes behind; relations without a closed ring are dropped.
    """
    kind = (tags.tag("type", "raw_tags") == "multipolygon") & (tags.tag("natural", "raw_tags").isin("water", "wetland") | (tags.tag("landuse", "raw_tags") == "reservoir"))
    r = _cleaned(relations).where(kind)
    m = r.select("id", F.explode("members").alias("m")).where("m.type = 'way'").select("id", F.col("m.ref").alias("way"))
    g = m.distinct().join(lines.select(F.col("id").alias("way"), "geom").where("geom is not null"), "way").groupBy("id").agg(F.array_sort(F.collect_list("geom")).alias("ls"))
    shapes = g.select("id", _polygons("ls").alias("geom")).where("geom is not null")
    return r.select("id", "tags").join(shapes, "id").select((-F.col("id")).alias("way_osm_id"), "tags", F.lit(None).cast("array<bigint>").alias("nodes"), "geom")
