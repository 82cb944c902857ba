"""Tag predicates, cleaning and names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: linear watercourses that make the network.
WATERWAYS = ("river", "stream", "canal", "drain", "ditch")
# Fixed value: the same as an unanchored pattern, which also hits longer values.
WATERWAY_PATTERN = "river|stream|canal|drain|ditch"

# Tag keys that are dropped on ingest; a final * matches a prefix.
DELETE_KEYS = (
    "source_ref", "CLC:*", "geobase:*", "canvec:*", "osak:*", "kms:*", "ngbe:*", "it:fvg:*", "KSJ2:*", "yh:*",
    "LINZ2OSM:*", "linz2osm:*", "LINZ:*", "ref:linz:*", "WroclawGIS:*", "naptan:*", "tiger:*", "gnis:*", "NHD:*", "nhd:*",
    "mvdgis:*", "project:eurosha_2012", "ref:UrbIS", "accuracy:meters", "sub_sea:type", "waterway:type", "statscan:rbuid",
    "ref:ruian:addr", "ref:ruian", "building:ruian:type", "dibavod:id", "uir_adr:ADRESA_KOD", "gst:feat_id", "maaamet:ETAK",
    "ref:FR:FANTOIR", "3dshapes:ggmodelk", "AND_nosr_r", "OPPDATERIN", "addr:city:simc", "addr:street:sym_ul",
    "building:usage:pl", "building:use:pl", "teryt:simc", "raba:id", "dcgis:gis_id", "nycdoitt:bin", "chicago:building_id",
    "lojic:bgnum", "massgis:way_id", "lacounty:*", "at_bev:addr_date", "import", "import_uuid", "OBJTYPE", "SK53_bulk:load", "mml:class",
)
# Abbreviated kinds in names; the third has its word boundary behind the dot.
ABBREVIATIONS = ("р", "руч", "кан", "прот", "овр", "пор", "род", "сух", "б", "бол", "бр", "вдп", "вдхр")
AREA_ABBREVIATIONS = (*ABBREVIATIONS, "оз", "пр")


def tag(key: str, tags: str = "tags") -> Column:
    return F.col(tags)[key]


def has(key: str, tags: str = "tags") -> Column:
    return F.map_contains_key(F.col(tags), F.lit(key))


def is_waterway(tags: str = "tags") -> Column:
    return tag("waterway", tags).isin(*WATERWAYS)


def clean_tags(tags: Column, delete: tuple[str, ...] = DELETE_KEYS) -> Column:
    """Tags without the keys of the deny-list; an object whose result is empty is dropped by the router."""
    exact = [k for k in delete if not k.endswith("*")]
    prefixes = [k[:-1] for k in delete if k.endswith("*")]

    def drop(k: Column) -> Column:
        c = k.isin(*exact)
        for p in prefixes:
            c = c | k.startswith(p)
        return c

    return F.map_filter(tags, lambda k, _: ~drop(k))


def has_water_tags(tags: str = "tags") -> Column:
    """Water objects: area kinds first, then no fairways, then any key of the water family."""
    t = lambda k: F.coalesce(tag(k, tags), F.lit(""))
    family = has("waterway", tags) | has("harbour", tags) | has("water", tags) | has("wetland", tags) | has("natural", tags)
    return t("natural").isin("water", "wetland", "coastline") | (t("landuse") == "reservoir") | ((t("waterway") != "fairway") & family)


def abbreviation_pattern(words: tuple[str, ...] = ABBREVIATIONS) -> str:
    """Java pattern of an abbreviated kind: not after a letter or digit; behind ``кан.`` a word has to follow at once."""
    parts = [r"кан\.(?=[\p{L}\p{N}_])" if w == "кан" else rf"(?<![\p{{L}}\p{{N}}_]){w}\." for w in words]
    return "(?:" + "|".join(parts) + ")"
