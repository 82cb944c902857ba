"""Watercourses of the knowledge graph: extraction from triples, normalisation, pseudo-geometry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillwork.functions import geom
from rillwork.runtime import materialize, release

# Fixed value: prefix of an entity's address.
ENTITY = "http://www.wikidata.org/entity/"


def closure(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Ids that reach one of the roots over one or more edges; cycles are no harm.

    edges: ``id, parent``; roots: ``id``. Works from the roots outward, a round for each
    level, and stops when a round finds nothing new.
    """
    e = edges.select("id", "parent").dropna().distinct()
    found = None
    front = materialize(roots.select("id").dropna().distinct(), "front")
    while True:
        new = e.join(front.withColumnRenamed("id", "parent"), "parent", "left_semi").select("id").distinct()
        if found is not None:
            new = new.join(found, "id", "left_anti")
        new = materialize(new, "front")
        if new.isEmpty():
            break
        found = new if found is None else materialize(found.unionByName(new), "closure")
        front = new
    return found if found is not None else roots.select("id").limit(0)


def watercourses(instance_of: DataFrame, subclass_of: DataFrame, country: DataFrame, optional: dict[str, DataFrame], tributaries: DataFrame, root: str, land: str) -> DataFrame:
    """Instances of a subclass of ``root`` in ``land``, with optional properties, tributaries as one list.

    instance_of, subclass_of, country, tributaries: ``s, o``; optional: column name to ``s, o``.
    Several values of a property give several rows. Values lose their entity prefix.
    """
    classes = closure(subclass_of.select(F.col("s").alias("id"), F.col("o").alias("parent")), subclass_of.sparkSession.createDataFrame([(root,)], "id string"))
    bare = lambda c: F.substring_index(c, "/entity/", -1)
    w = instance_of.join(classes.withColumnRenamed("id", "o"), "o", "left_semi").join(country.where(F.col("o") == land), "s", "left_semi").select("s").distinct()
    for name, p in optional.items():
        w = w.join(p.select("s", F.col("o").alias(name)), "s", "left")
    w = w.join(tributaries.select("s", bare(F.col("o")).alias("t")), "s", "left")
    keys = ["s", *optional]
    w = w.groupBy(*keys).agg(F.listagg_distinct("t", F.lit("; ")).alias("tributaries"))
    return w.withColumn("tributaries", F.array_join(F.array_sort(F.split("tributaries", "; ")), "; "))


def normalize(raw: DataFrame) -> DataFrame:
    """Raw text columns of the extract to typed watercourses; empty strings are null."""
    n = lambda c: F.nullif(F.col(c), F.lit(""))
    src, mouth = geom.point_from_text(n("sourcecoords")), geom.point_from_text(n("mouthcoords"))
    return raw.select(
        F.replace(F.col("waterway"), F.lit(ENTITY), F.lit("")).alias("id"), n("labelru").alias("name_ru"), n("labelen").alias("name_en"),
        src.alias("source_pnt"), mouth.alias("mouth_pnt"), geom.line_of(src, mouth).alias("geom"), n("mouthqid").alias("mouthq_id"),
        F.col("length").alias("length_km"), n("gvr").alias("gvr_id"), "osm_id", F.split(n("tributaries"), "; ").alias("tributary_id_list"))


def pseudo_geometry(w: DataFrame) -> DataFrame:
    """Line from the source over the tributaries' mouths, in their order along the course, to the mouth (twice).

    Null points are skipped; ``tributary_names_list`` keeps the nulls of unnamed or unknown
    tributaries, ordered as the mouths. One row for each distinct input row.
    """
    rows = w.distinct().withColumn("rid", F.xxhash64(*w.columns))
    t = rows.select("rid", "source_pnt", "geom", F.explode(F.array_distinct("tributary_id_list")).alias("tid"))
    other = w.select(F.col("id").alias("tid"), F.col("name_ru").alias("t_name"), F.col("mouth_pnt").alias("t_mouth"))
    along = geom.closest_point(F.transform("geom", geom.mercator), geom.mercator(F.col("t_mouth")))
    src = geom.mercator(F.col("source_pnt"))
    d = F.when(along.isNotNull(), F.hypot(src["x"] - along["x"], src["y"] - along["y"]))
    j = t.join(other, "tid").withColumn("d", d)
    agg = j.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct(F.col("d").isNull().alias("n"), "d", "tid", "t_name", "t_mouth"))).alias("ts"))
    none = F.array(F.lit(None).cast("string"))
    mouths = F.coalesce(F.transform("ts", lambda s: s["t_mouth"]), F.array().cast(f"array<{w.schema['mouth_pnt'].dataType.simpleString()}>"))
    line = geom.line_from_points(F.array_append(F.array_append(F.array_prepend(mouths, F.col("source_pnt")), F.col("mouth_pnt")), F.col("mouth_pnt")))
    out = rows.drop("tributary_names_list").join(agg, "rid", "left")
    return out.withColumn("tributary_names_list", F.coalesce(F.transform("ts", lambda s: s["t_name"]), none)).withColumn("geom", line).drop("rid", "ts")
