"""Queries of the problems tagged llm over their whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillwork.llm import bpe, components, leaks, matching, residue


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Watercourses without an osm_id and their relations."""
    return p4_matches(spark, d).select("id", "rel_osm_id")


def p4_matches(spark: SparkSession, d: str) -> DataFrame:
    """The matches with their confidence."""
    m = matching.match_watercourses(table(spark, d, "fin_wikidata_waterways_ru"), table(spark, d, "osm_relations"), table(spark, d, "osm_ways"))
    return m.withColumn("confidence", F.round("confidence", 6))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Every graph node with the identifier of its water network."""
    return components.link_groups(table(spark, d, "graph_nodes_stat"), "pnt_osm_id", "way_osm_id")


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    """Token ids of every page."""
    return bpe.encode(table(spark, d, "documents"), "doc_id", "text")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Pages with the test items they give away."""
    return leaks.find_leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Pages with open template fields, or made of filler, error messages or script notices."""
    return residue.residue_pages(table(spark, d, "documents"))


QUERIES = {f.__name__: f for f in (p4_found, p4_matches, p6_found, p7_ids, p8_found, p9_found)}
