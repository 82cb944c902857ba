"""Geometry and topology checks of the network."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillwork.functions import geom, measures, tags
from rillwork.operators.network import SIDE, with_ends
from rillwork.operators.proximity import _cell, segment_cells
from rillwork.runtime import spread_join

MAJOR = ("river", "canal")


def duplicates(objects: DataFrame, counted, shape: str = "geom") -> DataFrame:
    """All objects whose shape occurs more than once among the counted ones (ordered equality).

    counted: condition for the objects that count; the others are reported with them.
    Null shapes are equal to nothing. The join runs on a hash, shapes are compared after it.
    """
    h = objects.where(F.col(shape).isNotNull()).withColumn("__h", F.xxhash64(shape))
    twice = h.where(counted).groupBy("__h", F.col(shape).alias("__s")).agg(F.count("*").alias("__n")).where("__n > 1").select("__h", "__s")
    return h.join(twice, (h["__h"] == twice["__h"]) & (h[shape] == twice["__s"]), "left_semi").drop("__h")


def overlapping_ways(ways: DataFrame, side: int = SIDE) -> DataFrame:
    """Pairs of waterways that share a linear part, neither within the other: ``osm_ids, geom`` (parts).

    Only ways with parallel segments in one cell are compared.
    """
    w = ways.where(tags.has("waterway") & F.col("geom").isNotNull()).select("way_osm_id", "geom")
    s = w.select("way_osm_id", F.explode(geom.segments(F.col("geom"))).alias("s")).select(
        F.col("way_osm_id").alias("id"), F.col("s.a.x").alias("x1"), F.col("s.a.y").alias("y1"), F.col("s.b.x").alias("x2"), F.col("s.b.y").alias("y2")).where("x1 <> x2 or y1 <> y2")
    a = segment_cells(s, side, 0)
    b = a.select("cx", "cy", F.col("id").alias("id2"), F.col("x1").alias("u1"), F.col("y1").alias("v1"), F.col("x2").alias("u2"), F.col("y2").alias("v2"))
    d = lambda c: c.cast("decimal(19,0)")
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    on = lambda x, y: d(dx) * d(F.col(y) - F.col("y1")) == d(dy) * d(F.col(x) - F.col("x1"))
    apart = (
        (F.greatest("u1", "u2") < F.least("x1", "x2")) | (F.least("u1", "u2") > F.greatest("x1", "x2"))
        | (F.greatest("v1", "v2") < F.least("y1", "y2")) | (F.least("v1", "v2") > F.greatest("y1", "y2"))
    )
    pairs = a.join(b, ["cx", "cy"]).where((F.col("id") > F.col("id2")) & ~apart & on("u1", "v1") & on("u2", "v2")).select("id", "id2").distinct()
    j = pairs.join(w.select(F.col("way_osm_id").alias("id"), F.col("geom").alias("g1")), "id").join(w.select(F.col("way_osm_id").alias("id2"), F.col("geom").alias("g2")), "id2")
    return j.select(F.array("id", "id2").alias("osm_ids"), measures.overlap_parts("g1", "g2").alias("geom")).where("geom is not null")


def unconnected(ways: DataFrame, agg: DataFrame) -> DataFrame:
    """Ways ending on a bank where nothing goes on: all columns of ``ways`` and ``pnt_osm_id``."""
    ends = agg.where("str = 0 and mid = 0 and cst = 0 and bnk > 0").select("pnt_osm_id")
    return with_ends(ways.where(tags.tag("waterway").rlike(tags.WATERWAY_PATTERN))).join(ends, F.col("end_node") == F.col("pnt_osm_id"))


def wrong_direction(ways: DataFrame, agg: DataFrame) -> DataFrame:
    """Ways that probably run against the flow. The second branch has no tag condition, by design of the rule."""
    ws = agg.select(*[F.col(c).alias(f"s_{c}") for c in agg.columns])
    we = agg.select(*[F.col(c).alias(f"e_{c}") for c in agg.columns])
    j = with_ends(ways).join(ws, F.col("start_node") == F.col("s_pnt_osm_id"), "left").join(we, F.col("end_node") == F.col("e_pnt_osm_id"), "left")
    first = tags.tag("waterway").rlike(tags.WATERWAY_PATTERN) & (F.col("e_str") == 0) & (F.col("e_mid") == 0) & (F.col("s_mid") > 0) & (F.col("e_cst") == 0)
    second = (F.col("s_end") == 0) & (F.col("e_end") > 1) & (F.col("s_str") > 1)
    return j.where(first | second).select("way_osm_id", "tags", "geom")


def rank_errors(ways: DataFrame, stats: DataFrame, agg: DataFrame) -> DataFrame:
    """Minor ways that go on where only major ones end: ``way_osm_id, tags, geom, in_pnt``; repeats are kept."""
    busy = agg.where("`end` > 0 and (mid > 0 or str > 0)").select("pnt_osm_id")
    # A way may hold a tenth of all rows.
    t = spread_join(stats.join(busy, "pnt_osm_id"), with_ends(ways), ["way_osm_id"]).select("pnt_osm_id", "way_osm_id", "tags", "geom", "end_node")
    major = tags.tag("waterway").isin(*MAJOR)
    wi = t.where((F.col("end_node") == F.col("pnt_osm_id")) & major).select("pnt_osm_id", F.col("way_osm_id").alias("in_id"), geom.end_point(F.col("geom")).alias("in_pnt"))
    wo = t.where(F.col("end_node") != F.col("pnt_osm_id"))
    going_on = wi.join(wo.where(major).select("pnt_osm_id"), "pnt_osm_id", "left_semi").select("in_id").distinct()
    return wi.join(going_on, "in_id", "left_anti").join(wo.where(~major), "pnt_osm_id").select("way_osm_id", "tags", "geom", "in_pnt")


def missing_segments(ways: DataFrame, areas: DataFrame, stats: DataFrame, agg: DataFrame) -> DataFrame:
    """Shortest connector through a water area for every inflow: ``in_osm_id, wa_osm_id, out_osm_id, geom``.

    areas: ``way_osm_id, tags, boundary``. Ties go to the smaller outflow and area.
    """
    one_sided = agg.where("bnk > 0 and cst = 0 and ((str > 0 and `end` = 0) or (`end` > 0 and str = 0))").select("pnt_osm_id")
    lakes = areas.where(F.coalesce(tags.tag("water"), F.lit("")) != "river").select(F.col("way_osm_id").alias("wa_osm_id"), "boundary")
    pts = spread_join(stats.where("type = 'bnk'").join(one_sided, "pnt_osm_id").select("pnt_osm_id", F.col("way_osm_id").alias("wa_osm_id")), lakes.select("wa_osm_id"), ["wa_osm_id"])
    net = with_ends(ways.where(tags.is_waterway()))
    out = pts.join(net, F.col("start_node") == F.col("pnt_osm_id")).select("wa_osm_id", F.col("way_osm_id").alias("out_osm_id"), geom.start_point(F.col("geom")).alias("po"))
    inn = pts.join(net, F.col("end_node") == F.col("pnt_osm_id")).select("wa_osm_id", F.col("way_osm_id").alias("in_osm_id"), geom.end_point(F.col("geom")).alias("pi"))
    # The centre is searched only for areas that have both.
    both = inn.select("wa_osm_id").distinct().join(out.select("wa_osm_id").distinct(), "wa_osm_id")
    centre = lakes.join(both, "wa_osm_id").select("wa_osm_id", measures.inscribed_circle_centre("boundary").alias("pc")).withColumn("pc", F.when(F.col("pc.x").isNotNull(), F.col("pc")))
    j = inn.join(out, "wa_osm_id").where("in_osm_id <> out_osm_id").join(centre, "wa_osm_id")
    spoke = geom.line_of(geom.mercator(F.col("pc")), geom.mercator(F.col("po")))
    near = geom.closest_point(spoke, geom.mercator(F.col("pi")))
    via = geom.from_mercator(F.when(near.isNotNull(), F.struct(near["x"].alias("x"), near["y"].alias("y"))))
    j = j.withColumn("g1", geom.line_from_points(F.array("pi", "pc", "po"))).withColumn("g2", geom.line_from_points(F.array("pi", via, "po")))
    j = j.withColumn("l1", measures.geodesic_length("g1")).withColumn("l2", measures.geodesic_length("g2"))
    best = F.struct(F.least("l1", "l2").alias("len"), "wa_osm_id", "out_osm_id", F.when(F.col("l1") < F.col("l2"), F.col("g1")).otherwise(F.col("g2")).alias("geom"))
    return j.groupBy("in_osm_id").agg(F.min(best).alias("b")).select("in_osm_id", "b.wa_osm_id", "b.out_osm_id", "b.geom")


def nearest_lines(points: DataFrame, lines: DataFrame, admissible, side: int, rings: int = 8) -> DataFrame:
    """Nearest admissible line of every point by expanding rings of cells.

    points: ``pid, p`` and any columns; lines: ``lid, line`` and any columns; admissible:
    condition on both, applied before the choice. Round k looks up to 4**k cells around; a
    point is settled when its best distance is within that reach, the rest goes on with four
    times the reach, so every point finds its nearest line. Ties go to the smaller ``lid``.
    Returns all columns of both and ``dist`` (planar, coordinate units).
    """
    from rillwork.runtime import materialize

    todo, lines = materialize(points, "knn-points"), materialize(lines, "knn-lines")
    seg = lines.select(F.col("lid").alias("id"), F.explode(geom.segments(F.col("line"))).alias("s")).select(
        "id", F.col("s.a.x").alias("x1"), F.col("s.a.y").alias("y1"), F.col("s.b.x").alias("x2"), F.col("s.b.y").alias("y2"))
    done = None
    for k in range(rings + 1):
        cell = side << (2 * k)
        pts = todo.withColumn("cx", F.explode(F.array(*[_cell(F.col("p.x"), cell) + i for i in (-1, 0, 1)]))).withColumn("cy", F.explode(F.array(*[_cell(F.col("p.y"), cell) + i for i in (-1, 0, 1)])))
        cells = segment_cells(seg, cell, 0).select(F.col("id").alias("lid"), "cx", "cy").distinct()
        pairs = pts.select("pid", "cx", "cy").join(cells, ["cx", "cy"]).select("pid", "lid").distinct()
        cand = todo.join(pairs, "pid").join(lines, "lid").where(admissible)
        cand = cand.withColumn("dist", geom.planar_distance(F.col("line"), F.col("p")))
        best = cand.groupBy("pid").agg(F.min_by(F.struct(*[c for c in cand.columns if c != "pid"]), F.struct("dist", "lid")).alias("b")).select("pid", "b.*")
        last = k == rings
        hit = materialize(best if last else best.where(F.col("dist") <= cell), "knn-hits")
        done = hit if done is None else done.unionByName(hit)
        todo = materialize(todo.join(hit.select("pid"), "pid", "left_anti"), "knn-points")
        if todo.isEmpty():
            break
    return done


def missing_segments_at_banks(ways: DataFrame, areas: DataFrame, stats: DataFrame, agg: DataFrame, connected: DataFrame, side: int = 100_000) -> DataFrame:
    """Connector from an unconnected way's end on a riverbank to the nearest river or canal.

    ``in_osm_id, tags, out_osm_id, geom``. ``connected``: result of :func:`missing_segments`,
    whose inflows are left out. Repeats are kept: one row for each way, bank and other way at the node.
    """
    un = unconnected(ways, agg).select("way_osm_id", "tags", "geom", "pnt_osm_id")
    banks = (
        stats.where("type = 'bnk'").join(areas.where(tags.tag("water") == "river").select("way_osm_id"), "way_osm_id").select("pnt_osm_id")
        .join(un.select("pnt_osm_id"), "pnt_osm_id")
    )
    rows = un.join(banks, "pnt_osm_id").join(connected.select(F.col("in_osm_id").alias("way_osm_id")).distinct(), "way_osm_id", "left_anti")
    points = rows.select(F.col("way_osm_id").alias("pid"), geom.end_point(F.col("geom")).alias("p"), F.col("geom").alias("own")).where("p is not null").dropDuplicates(["pid"])
    lines = ways.where(tags.tag("waterway").isin(*MAJOR) & ~tags.has("tunnel") & F.col("geom").isNotNull()).select(F.col("way_osm_id").alias("lid"), F.col("geom").alias("line"))
    ok = (F.col("lid") != F.col("pid")) & ~geom.lines_meet(F.col("own"), F.col("line"))
    near = nearest_lines(points, lines, ok, side)
    at = geom.closest_point(F.transform("line", geom.mercator), geom.mercator(F.col("p")))
    link = near.select(F.col("pid").alias("way_osm_id"), F.col("lid").alias("out_osm_id"), F.array("p", geom.from_mercator(F.struct(at["x"].alias("x"), at["y"].alias("y")))).alias("link"))
    return rows.join(link, "way_osm_id").select(F.col("way_osm_id").alias("in_osm_id"), "tags", "out_osm_id", F.col("link").alias("geom"))
