"""Tag rules as data: one scan of the ways and one of the areas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillwork.functions import measures
from rillwork.functions.tags import ABBREVIATIONS, AREA_ABBREVIATIONS, abbreviation_pattern, has, tag

# Codes of areas by their waterway value.
AREA_WATERWAY = {
    "rapids": "6-12", "bog": "6-15", "tidal": "6-16", "wetland": "6-17", "riverbank": "6-18", "pond": "6-19", "lake": "6-20", "canal": "6-21", "reservoir": "6-22",
    "oxbow": "6-23", "water_point": "6-24", "pressurised": "6-25", "river": "6-26", "pumping_station": "6-27", "drain": "6-30", "weir": "6-31",
    "brook": "6-32", "waterfall": "6-33", "lock_gate": "6-34",
}
ISLAND_AREA = 1000.0

# A rule: (condition for a finding, [(condition, code), ...]); the first true condition
# gives the code, none gives a finding with a null code.
Rule = tuple[Column, list[tuple[Column, str]]]


def _exactly(values: str) -> str:
    return rf"\A(?:{values})\z"


def way_rules() -> list[Rule]:
    ww, name = tag("waterway"), tag("name")
    no_oxbow = F.coalesce(tag("water"), F.lit("")) != "oxbow"
    abbreviated = name.rlike(abbreviation_pattern(ABBREVIATIONS))
    always = F.lit(True)
    return [
        (ww.isin("river", "stream", "canal", "drain") & (tag("bridge") != "aqueduct"), [(always, "6-2")]),
        (has("water"), [
            ((tag("natural") == "water") | (F.size("tags") == 1), "6-40"), (has("waterway"), "6-41"),
            ((tag("water") == "spring") & ~has("waterway"), "6-42"), (ww == "rapids", "6-43"), (always, "6-44")]),
        (name.rlike("(?iu)старица") & no_oxbow, [(name.rlike(rf"(?iu){_exactly('старица')}"), "6-45"), (always, "6-46")]),
        (abbreviated, [(abbreviated, "6-47")]),
        (ww == "wadi", [(always, "6-51")]),
        (ww == "waterfall", [(always, "6-52")]),
        (ww == "oxbow", [(always, "6-53")]),
        (tag("natural").isin("water", "wetland"), [(tag("natural") == "water", "6-54"), (tag("natural") == "wetland", "6-55")]),
    ]


def area_rules(area_m2: Column) -> list[Rule]:
    ww, water, natural, name = tag("waterway"), tag("water"), tag("natural"), tag("name")
    always = F.lit(True)
    wet = natural.isin("water", "wetland")
    by_value = [(ww == v, c) for v, c in AREA_WATERWAY.items()]
    return [
        (tag("landuse") == "reservoir", [(always, "6-3")]),
        (has("water:type"), [(always, "6-4")]),
        (water.rlike(rf"(?i){_exactly('tidal|intermittent|bay|cove|fishpond|riverbank|natural')}"), [
            ((water == "tidal") & wet, "6-5-1"), ((water == "tidal") & ~wet, "6-5-2"),
            ((water == "intermittent") & wet, "6-6-1"), ((water == "intermittent") & ~wet, "6-6-2"),
            (water == "cove", "6-7-1"), (water == "bay", "6-7-2"), (water == "fishpond", "6-8"), (water == "riverbank", "6-9"),
            (ww == "riverbank", "6-10"), (water == "natural", "6-11")]),
        (has("waterway") & ~ww.rlike(_exactly("dam|boatyard|dock|fuel|sluice_gate|offshore_field")), [
            ((ww == "intermittent") & (tag("intermittent") == "yes"), "6-13"), (ww == "intermittent", "6-14"), *by_value,
            ((ww == "island") & (area_m2 >= ISLAND_AREA), "6-28-1"), ((ww == "island") & (area_m2 < ISLAND_AREA), "6-28-2"),
            ((ww == "ditch") & (tag("area") == "no"), "6-29-1"), ((ww == "ditch") & ~has("area"), "6-29-2"), (always, "6-35")]),
        (name.rlike(abbreviation_pattern(AREA_ABBREVIATIONS)), [(name.rlike(abbreviation_pattern(ABBREVIATIONS)), "6-47")]),
        (ww == "wadi", [(always, "6-51")]),
    ]


def _findings(df: DataFrame, rules: list[Rule]) -> DataFrame:
    out = []
    for cond, ladder in rules:
        code = F.when(*_first(ladder))
        for c, e in ladder[1:]:
            code = code.when(c, F.lit(e))
        out.append(F.when(cond, F.struct(code.alias("err_id"))))
    return df.select("way_osm_id", F.explode(F.filter(F.array(*out), lambda s: s.isNotNull())).alias("e")).select("way_osm_id", "e.err_id")


def _first(ladder: list[tuple[Column, str]]) -> tuple[Column, Column]:
    return ladder[0][0], F.lit(ladder[0][1])


def way_findings(ways: DataFrame) -> DataFrame:
    """``way_osm_id, err_id`` of every rule that a way breaks."""
    return _findings(ways, way_rules())


def area_findings(areas: DataFrame, boundary: str | None = "boundary") -> DataFrame:
    """``way_osm_id, err_id`` of every rule that an area breaks; a null err_id is a finding without a code.

    boundary: column with the boundary lines, measured only for islands; None: no area is known.
    """
    if boundary is None:
        return _findings(areas, area_rules(F.lit(None).cast("double")))
    island = F.when(tag("waterway") == "island", F.col(boundary))
    is_island = F.coalesce(tag("waterway") == "island", F.lit(False))
    plain = areas.where(~is_island).withColumn("area_m2", F.lit(None).cast("double"))
    measured = areas.where(is_island).withColumn("area_m2", measures.geodesic_area(island))
    return _findings(plain.unionByName(measured), area_rules(F.col("area_m2")))


def tagging_mistakes(ways: DataFrame, areas: DataFrame, boundary: str | None = "boundary") -> DataFrame:
    """``way_osm_id, err_list`` with null elements kept; the list is sorted, nulls last."""
    f = way_findings(ways).unionByName(area_findings(areas, boundary))
    # Structs keep nulls that a collected scalar would lose.
    got = F.array_sort(F.collect_list(F.struct(F.col("err_id").isNull().alias("n"), "err_id")))
    return f.groupBy("way_osm_id").agg(F.transform(got, lambda s: s["err_id"]).alias("err_list"))
