"""Sources and sinks: Parquet tables, the CSV extract, XML objects, configuration, full-refresh tables."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CSV_SCHEMA = "waterway string, labelru string, labelen string, sourcecoords string, mouthcoords string, mouthqid string, length decimal(38,18), gvr string, osm_id bigint, tributaries string"
XML_SCHEMA = (
    "_id bigint, _lat double, _lon double, nd array<struct<_ref:bigint>>, member array<struct<_type:string,_ref:bigint,_role:string>>, tag array<struct<_k:string,_v:string>>"
)


@dataclass(frozen=True)
class Config:
    """Settings from the environment, or from ``KEY=value`` lines of a file."""

    schema: str = "water"
    values: dict[str, str] = field(default_factory=dict)

    @staticmethod
    def read(path: str | None = None) -> "Config":
        values = dict(os.environ)
        if path:
            with open(path, encoding="utf-8") as f:
                for line in f:
                    key, eq, value = line.strip().partition("=")
                    if eq and not key.startswith("#"):
                        values[key.removeprefix("export ").strip()] = value.strip().strip("'\"")
        return Config(values.get("WATER_SCHEMA", "water"), values)


def read_extract(spark: SparkSession, path: str) -> DataFrame:
    """The knowledge graph's CSV with a header; quoted fields may hold line feeds."""
    return spark.read.csv(path, header=True, schema=CSV_SCHEMA, multiLine=True, escape='"')


def read_xml(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Nodes, ways or relations of an XML file of map objects: ``id, tags, nodes, members, x, y``."""
    df = spark.read.format("xml").option("rowTag", kind).schema(XML_SCHEMA).load(path)
    tags = F.map_from_entries(F.transform(F.coalesce("tag", F.array().cast("array<struct<_k:string,_v:string>>")), lambda t: F.struct(t["_k"], t["_v"])))
    return df.select(
        F.col("_id").alias("id"), tags.alias("tags"), F.transform("nd", lambda n: n["_ref"]).alias("nodes"),
        F.transform("member", lambda m: F.struct(m["_type"].alias("type"), m["_ref"].alias("ref"), m["_role"].alias("role"))).alias("members"),
        F.round(F.col("_lon") * 1e7).cast("bigint").alias("x"), F.round(F.col("_lat") * 1e7).cast("bigint").alias("y"))


def refresh(df: DataFrame, schema: str, name: str) -> DataFrame:
    """Drop and create a table from a query, in a database that is made where it is missing."""
    spark = df.sparkSession
    spark.sql(f"create database if not exists `{schema}`")
    df.write.mode("overwrite").format("parquet").saveAsTable(f"`{schema}`.`{name}`")
    return spark.table(f"`{schema}`.`{name}`")
