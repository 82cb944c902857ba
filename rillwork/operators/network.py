"""Current object versions, contours, graph nodes and their statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillwork.functions import geom, tags
from rillwork.operators.proximity import _cell, segment_cells, segments

#: Side of the cells of point-on-line joins, in coordinate units.
SIDE = 24_000
KINDS = ("str", "mid", "end", "bnk", "cst", "dam")


def current(df: DataFrame, key: str, order: tuple[str, ...] = ("loaded_at", "edited_at")) -> DataFrame:
    """Newest row of every key; rows with a null key are dropped. Equal rows are one.

    Ties of the order columns go to the row with the smaller hash.
    """
    rest = [c for c in df.columns if c != key]
    by = [F.col(c) for c in order if c in df.columns]
    plain = [c for c, t in df.dtypes if not t.startswith("map")]
    row = F.struct(*rest)
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(row, F.struct(*by, (-F.xxhash64(*plain)).alias("h"))).alias("r")).select(key, "r.*")


def with_ends(ways: DataFrame) -> DataFrame:
    """Adds ``start_node`` and ``end_node``; null for ways without nodes."""
    return ways.withColumn("start_node", F.try_element_at("nodes", F.lit(1))).withColumn("end_node", F.try_element_at("nodes", F.lit(-1)))


def contours(areas: DataFrame, pieces: int = 256) -> DataFrame:
    """Boundary lines of areas tagged natural=water, cut to at most ``pieces`` points: several rows for an area.

    areas: ``way_osm_id, tags, geom`` with polygons of rings of points.
    """
    ring = areas.where(tags.tag("natural") == "water").select("way_osm_id", "tags", F.explode(F.flatten("geom")).alias("ring"))
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("ring") - 1), F.lit(pieces - 1))
    return ring.select("way_osm_id", "tags", F.explode(F.transform(starts, lambda s: F.slice("ring", s, F.lit(pieces)))).alias("geom"))


def graph_nodes(ways: DataFrame) -> DataFrame:
    """Distinct first and last nodes of network ways with their points: ``pnt_osm_id, geom``."""
    w = with_ends(ways.where(tags.is_waterway()))
    ends = F.array(
        F.struct(F.col("start_node").alias("pnt_osm_id"), geom.start_point(F.col("geom")).alias("geom")),
        F.struct(F.col("end_node").alias("pnt_osm_id"), geom.end_point(F.col("geom")).alias("geom")))
    return w.select(F.explode(ends).alias("e")).select("e.*").distinct()


def touching(nodes: DataFrame, lines: DataFrame, id_: str = "way_osm_id", side: int = SIDE) -> DataFrame:
    """Distinct ``pnt_osm_id, way_osm_id`` of nodes that lie exactly on a line (cell join and integer test).

    A third of the nodes at one place costs one test: positions are joined, not nodes.
    """
    n = nodes.select("pnt_osm_id", F.col("geom.x").alias("x"), F.col("geom.y").alias("y")).where("x is not null and y is not null")
    sites = n.select("x", "y").distinct().select(_cell(F.col("x"), side).alias("cx"), _cell(F.col("y"), side).alias("cy"), "x", "y")
    s = segment_cells(segments(lines, id_, "geom").withColumnRenamed("id", "way_osm_id"), side, 0)
    pt = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    hit = sites.join(s, ["cx", "cy"]).where(geom.on_segment(pt("x", "y"), pt("x1", "y1"), pt("x2", "y2"))).select("x", "y", "way_osm_id").distinct()
    return hit.join(n, ["x", "y"]).select("pnt_osm_id", "way_osm_id").distinct()


def node_stats(nodes: DataFrame, ways: DataFrame, contour_lines: DataFrame) -> DataFrame:
    """Role of every node at every way, coastline, dam and bank it lies on: ``pnt_osm_id, way_osm_id, type``.

    One row for a node and an area's bank, however many pieces its contour has.
    """
    w = with_ends(ways.where(tags.is_waterway()))
    role = F.when(F.col("pnt_osm_id") == F.col("start_node"), F.lit("str")).when(F.col("pnt_osm_id") == F.col("end_node"), F.lit("end")).otherwise(F.lit("mid"))
    net = touching(nodes, w).join(w.select("way_osm_id", "start_node", "end_node"), "way_osm_id").select("pnt_osm_id", "way_osm_id", role.alias("type"))
    barrier = ways.where((tags.tag("natural") == "coastline") | tags.tag("waterway").isin("dam", "weir"))
    kind = F.when(tags.tag("natural") == "coastline", F.lit("cst")).otherwise(F.lit("dam"))
    walls = touching(nodes, barrier).join(barrier.select("way_osm_id", kind.alias("type")), "way_osm_id").select("pnt_osm_id", "way_osm_id", "type")
    banks = touching(nodes, contour_lines).withColumn("type", F.lit("bnk"))
    return net.unionByName(walls).unionByName(banks)


def node_stats_agg(stats: DataFrame) -> DataFrame:
    """Six counts for every node; a null node is a group as in SQL."""
    return stats.groupBy("pnt_osm_id").agg(*[F.count_if(F.col("type") == k).alias(k) for k in KINDS])


def water_areas(contour_rows: DataFrame) -> DataFrame:
    """Areas out of contour rows: ``way_osm_id, tags, boundary`` (distinct lines in a fixed order).

    tags are those of the newest row.
    """
    t = current(contour_rows.select("way_osm_id", "tags", "loaded_at"), "way_osm_id").select("way_osm_id", "tags")
    b = contour_rows.where("way_osm_id is not null and geom is not null").groupBy("way_osm_id").agg(F.array_sort(F.collect_set("geom")).alias("boundary"))
    return t.join(b, "way_osm_id", "left")
