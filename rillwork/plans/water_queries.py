"""Queries of the water-network engine over its whole tables; names begin with the operators' keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillwork.functions import geom, measures, tags
from rillwork.functions.keys import bare_qid
from rillwork.operators import checks, consolidate, ingest, knowledge, network, publish, tagging
from rillwork.plans.core_queries import table


def ways_of(spark: SparkSession, d: str) -> DataFrame:
    return network.current(table(spark, d, "osm_ways"), "way_osm_id")


def areas_of(spark: SparkSession, d: str) -> DataFrame:
    return network.water_areas(table(spark, d, "contours"))


def nodes_of(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "graph_nodes").where("pnt_osm_id is not null").select("pnt_osm_id", "geom").distinct()


def stats_of(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "graph_nodes_stat").where("pnt_osm_id is not null and way_osm_id is not null").select("pnt_osm_id", "way_osm_id", "type").distinct()


def agg_of(spark: SparkSession, d: str) -> DataFrame:
    return network.node_stats_agg(stats_of(spark, d))


def s5_current_ways(spark: SparkSession, d: str) -> DataFrame:
    return ways_of(spark, d).select("way_osm_id", tags.tag("waterway").alias("waterway"), tags.tag("name").alias("name"), F.size("nodes").cast("bigint").alias("n_nodes"), F.coalesce(F.size("geom"), F.lit(0)).cast("bigint").alias("n_points"))


def d2_graph_nodes(spark: SparkSession, d: str) -> DataFrame:
    return network.graph_nodes(ways_of(spark, d)).select("pnt_osm_id", F.col("geom.x").alias("x"), F.col("geom.y").alias("y"))


def d3_node_stats(spark: SparkSession, d: str) -> DataFrame:
    return network.node_stats(nodes_of(spark, d), ways_of(spark, d), table(spark, d, "contours"))


def d4_node_stats_agg(spark: SparkSession, d: str) -> DataFrame:
    return agg_of(spark, d)


def _ids(df: DataFrame) -> DataFrame:
    return df.select("way_osm_id", tags.tag("waterway").alias("waterway"), F.coalesce(F.size("geom"), F.lit(0)).cast("bigint").alias("n_points"))


def d5_wrong_direction(spark: SparkSession, d: str) -> DataFrame:
    return _ids(checks.wrong_direction(ways_of(spark, d), agg_of(spark, d)))


def d6_unconnected(spark: SparkSession, d: str) -> DataFrame:
    return _ids(checks.unconnected(ways_of(spark, d), agg_of(spark, d)))


def d7_duplicate_ways(spark: SparkSession, d: str) -> DataFrame:
    return _ids(checks.duplicates(ways_of(spark, d), tags.has("waterway")))


def d8_duplicate_areas(spark: SparkSession, d: str) -> DataFrame:
    return checks.duplicates(areas_of(spark, d), tags.tag("natural").isin("water", "wetland"), "boundary").select("way_osm_id", F.size("boundary").cast("bigint").alias("n_lines"))


def d9_overlapping_ways(spark: SparkSession, d: str) -> DataFrame:
    return checks.overlapping_ways(ways_of(spark, d)).select(F.col("osm_ids")[0].alias("first_id"), F.col("osm_ids")[1].alias("second_id"), F.size("geom").cast("bigint").alias("n_parts"))


def _connectors(spark: SparkSession, d: str) -> DataFrame:
    return checks.missing_segments(ways_of(spark, d), areas_of(spark, d), stats_of(spark, d), agg_of(spark, d))


def d10_missing_segments(spark: SparkSession, d: str) -> DataFrame:
    return _connectors(spark, d)


def d11_missing_segments_at_banks(spark: SparkSession, d: str) -> DataFrame:
    ways = ways_of(spark, d)
    got = checks.missing_segments_at_banks(ways, areas_of(spark, d), stats_of(spark, d), agg_of(spark, d), _connectors(spark, d))
    return got.select("in_osm_id", "out_osm_id", "geom")


def d12_rank_errors(spark: SparkSession, d: str) -> DataFrame:
    r = checks.rank_errors(ways_of(spark, d), stats_of(spark, d), agg_of(spark, d))
    return r.select("way_osm_id", F.col("in_pnt.x").alias("in_x"), F.col("in_pnt.y").alias("in_y"))


def d13_way_findings(spark: SparkSession, d: str) -> DataFrame:
    return tagging.way_findings(ways_of(spark, d))


def d13_area_findings(spark: SparkSession, d: str) -> DataFrame:
    return tagging.area_findings(areas_of(spark, d))


def d13_tagging_mistakes(spark: SparkSession, d: str) -> DataFrame:
    t = tagging.tagging_mistakes(ways_of(spark, d), areas_of(spark, d))
    return t.select("way_osm_id", F.array_join("err_list", ",", "null").alias("err_list"))


def _relational(spark: SparkSession, d: str) -> list[DataFrame]:
    one = lambda df, code: df.select(F.col("way_osm_id").alias("osm_id"), F.lit(code).alias("err_id"))
    mistakes = tagging.way_findings(ways_of(spark, d)).unionByName(tagging.area_findings(areas_of(spark, d)))
    return [
        one(d8_duplicate_areas(spark, d), "1"), one(d7_duplicate_ways(spark, d), "1"), one(d5_wrong_direction(spark, d), "3"),
        one(d12_rank_errors(spark, d), "4"), one(d6_unconnected(spark, d), "5"), mistakes.select(F.col("way_osm_id").alias("osm_id"), "err_id"),
    ]


def _flat(df: DataFrame) -> DataFrame:
    return df.select("osm_id", F.array_join("err_ids", ",").alias("err_ids"), F.size("err_list").cast("bigint").alias("n_descriptions"))


def d14_err_all(spark: SparkSession, d: str) -> DataFrame:
    both = checks.overlapping_ways(ways_of(spark, d)).select(F.explode("osm_ids").alias("osm_id"), F.lit("2").alias("err_id"))
    return _flat(consolidate.consolidate([*_relational(spark, d), both]))


def d14_err_all_relational(spark: SparkSession, d: str) -> DataFrame:
    """All findings that need no overlay of lines."""
    return _flat(consolidate.consolidate(_relational(spark, d)))


def t17_err_codes(spark: SparkSession, d: str) -> DataFrame:
    return consolidate.err_codes(spark)


def _raw_extract(spark: SparkSession, d: str) -> DataFrame:
    w = table(spark, d, "fin_wikidata_waterways_ru")
    text = lambda p: F.coalesce(F.when(F.col(p).isNotNull(), F.concat(F.lit("Point("), (F.col(f"{p}.x") / 1e7).cast("decimal(12,7)").cast("string"), F.lit(" "), (F.col(f"{p}.y") / 1e7).cast("decimal(12,7)").cast("string"), F.lit(")"))), F.lit(""))
    return w.select(
        F.concat(F.lit(knowledge.ENTITY), "id").alias("waterway"), F.coalesce("name_ru", F.lit("")).alias("labelru"), F.coalesce("name_en", F.lit("")).alias("labelen"),
        text("source_pnt").alias("sourcecoords"), text("mouth_pnt").alias("mouthcoords"), F.coalesce("mouthq_id", F.lit("")).alias("mouthqid"), F.col("length_km").alias("length"),
        F.coalesce("gvr_id", F.lit("")).alias("gvr"), "osm_id", F.array_join("tributary_id_list", "; ").alias("tributaries"))


def d15_normalized(spark: SparkSession, d: str) -> DataFrame:
    n = knowledge.normalize(_raw_extract(spark, d))
    return n.select("id", "name_ru", "name_en", F.col("source_pnt.x").alias("sx"), F.col("source_pnt.y").alias("sy"), F.col("mouth_pnt.x").alias("mx"), F.col("mouth_pnt.y").alias("my"), "mouthq_id", "osm_id", F.size("geom").cast("bigint").alias("n_points"))


def d16_pseudo_geometry(spark: SparkSession, d: str) -> DataFrame:
    w = table(spark, d, "fin_wikidata_waterways_ru").select(
        "id", "name_ru", "source_pnt", "mouth_pnt", geom.line_of(F.col("source_pnt"), F.col("mouth_pnt")).alias("geom"), F.transform("tributary_id_list", bare_qid).alias("tributary_id_list")).distinct()
    p = knowledge.pseudo_geometry(w)
    return p.select("id", F.size("tributary_names_list").cast("bigint").alias("n_names"), F.array_join(F.array_sort(F.array_compact("tributary_names_list")), ";").alias("names"), F.coalesce(F.size("geom"), F.lit(0)).cast("bigint").alias("n_points"))


def i1_clean_tags(spark: SparkSession, d: str) -> DataFrame:
    r = network.current(table(spark, d, "osm_relations"), "rel_osm_id").withColumn("tags", tags.clean_tags(F.col("tags")))
    return r.where(F.size("tags") > 0).select("rel_osm_id", F.array_join(F.array_sort(F.map_keys("tags")), ",").alias("keys"))


def i3_water_tags(spark: SparkSession, d: str) -> DataFrame:
    a, w = areas_of(spark, d), ways_of(spark, d)
    return w.select("way_osm_id", "tags").unionByName(a.select("way_osm_id", "tags")).select("way_osm_id", F.coalesce(tags.has_water_tags(), F.lit(False)).alias("water"))


def i4_route_ways(spark: SparkSession, d: str) -> DataFrame:
    lines, areas = ingest.route_ways(ways_of(spark, d).withColumnRenamed("way_osm_id", "id"))
    return lines.select("way_osm_id", F.lit("line").alias("kind")).unionByName(areas.select("way_osm_id", F.lit("area").alias("kind")))


def i5_route_relations(spark: SparkSession, d: str) -> DataFrame:
    r = ingest.route_relations(network.current(table(spark, d, "osm_relations"), "rel_osm_id").withColumnRenamed("rel_osm_id", "id"))
    return r.select("rel_osm_id", F.coalesce(F.size("members"), F.lit(0)).cast("bigint").alias("n_members"))


def i8_build_lines(spark: SparkSession, d: str) -> DataFrame:
    nodes = table(spark, d, "graph_nodes").select(F.col("pnt_osm_id").alias("id"), F.col("geom.x").alias("x"), F.col("geom.y").alias("y"))
    w = ingest.way_lines(ways_of(spark, d).select(F.col("way_osm_id").alias("id"), "tags", "nodes"), nodes)
    return w.where("geom is not null").select("id", F.size("geom").cast("bigint").alias("n_points"), F.col("geom")[0]["x"].alias("x"), F.col("geom")[0]["y"].alias("y"))


def q1_closure(spark: SparkSession, d: str) -> DataFrame:
    """Watercourses that flow, over any number of others, into a known water body."""
    t = table(spark, d, "fin_wikidata_waterways_ru").select(bare_qid(F.col("id")).alias("id"), bare_qid(F.col("mouthq_id")).alias("parent"))
    return knowledge.closure(t, table(spark, d, "wikidata_waterbodies").select(bare_qid(F.col("id")).alias("id")))


def q8_watercourses(spark: SparkSession, d: str) -> DataFrame:
    """The extract over triples: classes, country, optional label and mouth, tributaries as one list."""
    w = table(spark, d, "fin_wikidata_waterways_ru")
    s = F.concat(F.lit(knowledge.ENTITY), "id").alias("s")
    kind = F.when(F.col("osm_id").isNotNull(), "C3").when(F.col("gvr_id").isNotNull(), "C2").otherwise("C9")
    instance = w.select(s, kind.alias("o")).distinct()
    sub = spark.createDataFrame([("C3", "C2"), ("C2", "ROOT"), ("C9", "C8"), ("C8", "C9")], "s string, o string")
    country = w.select(s, F.lit("LAND").alias("o")).distinct()
    label = w.where("name_ru is not null").select(s, F.col("name_ru").alias("o")).distinct()
    trib = w.select(s, F.explode("tributary_id_list").alias("t")).select("s", F.concat(F.lit(knowledge.ENTITY), bare_qid(F.col("t"))).alias("o")).where("o is not null")
    got = knowledge.watercourses(instance, sub, country, {"labelru": label}, trib, "ROOT", "LAND")
    return got.select(F.substring_index("s", "/entity/", -1).alias("id"), "labelru", "tributaries")


def j15_nearest_way(spark: SparkSession, d: str) -> DataFrame:
    """Nearest river or canal without a tunnel of every node position."""
    pts = nodes_of(spark, d).where("geom.x is not null and geom.y is not null").select("geom").distinct().select(F.struct("geom.x", "geom.y").alias("p"), F.xxhash64("geom.x", "geom.y").alias("pid"))
    lines = ways_of(spark, d).where(tags.tag("waterway").isin(*checks.MAJOR) & ~tags.has("tunnel") & F.col("geom").isNotNull()).select(F.col("way_osm_id").alias("lid"), F.col("geom").alias("line"))
    n = checks.nearest_lines(pts, lines, F.lit(True), 100_000)
    return n.select(F.col("p.x").alias("x"), F.col("p.y").alias("y"), F.col("lid").alias("way_osm_id"), F.round("dist", 2).alias("dist"))


def g17_way_lengths(spark: SparkSession, d: str) -> DataFrame:
    return ways_of(spark, d).where("geom is not null").select("way_osm_id", F.round(measures.geodesic_length("geom"), 3).alias("metres"))


def g18_area_sizes(spark: SparkSession, d: str) -> DataFrame:
    return areas_of(spark, d).where("boundary is not null").select("way_osm_id", F.round(measures.geodesic_area("boundary"), 1).alias("square_metres"))


def g21_area_centres(spark: SparkSession, d: str) -> DataFrame:
    return areas_of(spark, d).where("boundary is not null").select("way_osm_id", measures.inscribed_circle_centre("boundary").alias("centre"))


def k6_line_layer(spark: SparkSession, d: str) -> DataFrame:
    """Every river, canal, stream, drain and ditch with its findings, for each tile it passes."""
    return publish.line_layer(ways_of(spark, d), consolidate.consolidate(_relational(spark, d)))


def k6_point_layer(spark: SparkSession, d: str) -> DataFrame:
    e = checks.rank_errors(ways_of(spark, d), stats_of(spark, d), agg_of(spark, d))
    return publish.point_layer(e.select(F.col("way_osm_id").alias("osm_id"), F.col("in_pnt").alias("p")))


def k9_error_table(spark: SparkSession, d: str) -> DataFrame:
    v = publish.error_table_view(checks.duplicates(ways_of(spark, d), tags.has("waterway")))
    return v.select("way_osm_id", *[F.col("bbox")[i].alias(n) for i, n in enumerate(("left_", "right_", "top_", "bottom_"))], F.col("osm_ids")[0].alias("osm_id"), "link")


QUERIES = {
    f.__name__: f
    for f in (
        s5_current_ways, d2_graph_nodes, d3_node_stats, d4_node_stats_agg, d5_wrong_direction, d6_unconnected, d7_duplicate_ways, d8_duplicate_areas,
        d9_overlapping_ways, d10_missing_segments, d11_missing_segments_at_banks, d12_rank_errors, d13_way_findings, d13_area_findings, d13_tagging_mistakes,
        d14_err_all, d14_err_all_relational, t17_err_codes, d15_normalized, d16_pseudo_geometry, i1_clean_tags, i3_water_tags, i4_route_ways,
        i5_route_relations, i8_build_lines, q1_closure, q8_watercourses, j15_nearest_way, g17_way_lengths, g18_area_sizes, g21_area_centres,
        k6_line_layer, k6_point_layer, k9_error_table,
    )
}
