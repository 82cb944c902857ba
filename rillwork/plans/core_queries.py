"""Queries of the general problems 1, 2, 3 and 5 over their whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillwork.functions.keys import bare_number, bare_qid
from rillwork.operators import hierarchy, proximity, references, shred
from rillwork.runtime import materialize

RADIUS = 1500


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def p1_found(spark: SparkSession, d: str, radius: int = RADIUS) -> DataFrame:
    """Nodes near nodes, nodes near foreign ways, and the areas that enclose nodes."""
    pos = proximity.positions(table(spark, d, "graph_nodes"), "pnt_osm_id", "geom")
    ways, contours = table(spark, d, "osm_ways"), table(spark, d, "contours")
    nodes = proximity.near_points(pos, radius)
    at_way = proximity.near_lines(pos, proximity.segments(ways, "way_osm_id", "geom"), radius)
    own = ways.select(F.col("way_osm_id").alias("other_id"), F.explode("nodes").alias("id")).dropna().distinct()
    areas = proximity.enclosing_areas(pos, contours, "way_osm_id", "geom", proximity.COARSE * radius)
    parts = [("node", nodes), ("way", at_way.join(own, ["id", "other_id"], "left_anti")), ("area", areas)]
    out = [p.select(F.lit(k).alias("kind"), F.col("id").alias("pnt_osm_id"), "other_id") for k, p in parts]
    return out[0].unionByName(out[1]).unionByName(out[2])


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Every watercourse with its root, depth, path and number of watercourses above it."""
    t = table(spark, d, "fin_wikidata_waterways_ru")
    return hierarchy.hierarchy(t.select(bare_qid(F.col("id")).alias("id"), bare_qid(F.col("mouthq_id")).alias("parent")))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """References of watercourses that are missing, deleted or late."""
    t, rel = table(spark, d, "fin_wikidata_waterways_ru"), table(spark, d, "osm_relations")
    bodies, gone = table(spark, d, "wikidata_waterbodies"), table(spark, d, "object_deletions")
    own = bare_qid(F.col("id")).alias("id")
    ref = lambda field, target, c: t.select(F.lit(field).alias("field"), own, F.lit(target).alias("target"), c.alias("ref"), F.col("loaded_at").alias("seen_at"))
    tributary = t.select(own, F.explode("tributary_id_list").alias("tributary"), F.col("loaded_at").alias("seen_at"))
    refs = (
        ref("mouthq_id", "wikidata", bare_qid(F.col("mouthq_id")))
        .unionByName(ref("osm_id", "relation", bare_number(F.col("osm_id"))))
        .unionByName(tributary.select(F.lit("tributary_id_list").alias("field"), "id", F.lit("wikidata").alias("target"), bare_qid(F.col("tributary")).alias("ref"), "seen_at"))
    )
    parents = (
        t.select(F.lit("wikidata").alias("target"), own.alias("ref"), F.col("loaded_at").alias("arrived_at"))
        .unionByName(bodies.select(F.lit("wikidata").alias("target"), bare_qid(F.col("id")).alias("ref"), F.lit(None).cast(t.schema["loaded_at"].dataType).alias("arrived_at")))
        .unionByName(rel.select(F.lit("relation").alias("target"), bare_number(F.col("rel_osm_id")).alias("ref"), F.col("loaded_at").alias("arrived_at")))
    )
    key = F.when(F.lower(F.trim("object_kind")) == "wikidata", bare_qid(F.col("object_key"))).otherwise(bare_number(F.col("object_key")))
    deletions = gone.where("deleted_at is not null").select(F.lower(F.trim("object_kind")).alias("target"), key.alias("ref"), "deleted_at")
    return references.orphan_references(refs, parents, deletions).select("field", "id", "ref", "period", "status")


def p3_report(spark: SparkSession, d: str) -> DataFrame:
    """Dangling references counted per field, month and state."""
    return references.orphan_report(p3_found(spark, d))


def _raw_triples(spark: SparkSession, d: str) -> DataFrame:
    """Triples of all payloads; each payload is parsed once."""
    return materialize(shred.shred(table(spark, d, "raw_relations"), "record_id", "payload", {"members": "member"}, {"tags"}), "triples")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """One row for each member and each tag of typed and of raw relations."""
    rel = table(spark, d, "osm_relations").where("rel_osm_id is not null")
    m = rel.select(F.col("rel_osm_id").alias("record_id"), F.posexplode("members").alias("pos", "m")).where("m is not null")
    typed = m.select("record_id", (F.col("pos") + 1).cast("string").alias("path"), F.lit("member").alias("kind"), shred.member_item(F.col("m.type"), F.col("m.ref").cast("string")).alias("item"))
    typed_tags = rel.select(F.col("rel_osm_id").alias("record_id"), F.lit("0").alias("path"), F.lit("tag").alias("kind"), F.explode(F.map_keys("tags")).alias("item"))
    t = _raw_triples(spark, d)
    raw = shred.pivot_group(t, "members", ["type", "ref"]).select("record_id", "path", F.lit("member").alias("kind"), shred.member_item(F.col("type"), F.col("ref")).alias("item"))
    raw_tags = t.where("grp = 'tags'").select("record_id", "path", F.lit("tag").alias("kind"), F.col("field").alias("item"))
    osm = typed.unionByName(typed_tags).select(F.lit("osm").alias("src"), "record_id", "path", "kind", "item")
    out = osm.unionByName(raw.unionByName(raw_tags).select(F.lit("raw").alias("src"), "record_id", "path", "kind", "item"))
    return out.distinct()


def p5_members(spark: SparkSession, d: str) -> DataFrame:
    """The flat table of raw members with their link to the parent."""
    m = shred.pivot_group(_raw_triples(spark, d), "members", ["type", "ref", "role"])
    parent = F.when(F.col("path").contains("."), F.regexp_replace("path", r"\.[0-9]+$", "")).otherwise(F.lit("0"))
    return m.select("record_id", "path", parent.alias("parent_path"), shred.member_item(F.col("type"), F.col("ref")).alias("item"), "role")


QUERIES = {f.__name__: f for f in (p1_found, p2_found, p3_found, p3_report, p5_found, p5_members)}
