"""Matching entities across sources without keys.

Sorted neighbourhood: every entity enters several composite sort orders (name then place,
reversed name then place, place strips, shifted place strips), all in one distributed
sort; entities of the two sources at most WINDOW positions apart are compared. A weighted
sum of field similarities gives each pair its confidence. The one-to-one assignment of the
largest total confidence is exact: pairs that hang together are solved as one group, each in
one task up to SOLVE_EDGES pairs; larger groups go through a distributed auction (within
EPSILON a pair).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from rillwork.llm import components
from rillwork.runtime import materialize, release, spread_join

WINDOW = 12
#: Width of a strip of the place orders, in coordinate units.
STRIP = 60_000
#: Distance at which two ends count as half similar.
HALF = 25_000.0
#: Weights of the name and of the two ends, and the least confidence of a match.
W_NAME, W_PLACE, LEAST = 0.5, 0.5, 0.58
LEAST_NAME, LEAST_PLACE = 0.6, 0.15
#: Place similarity from which two ends alone make a match when one side has no name.
NAMELESS = 0.85
#: Largest group of pairs that one task solves.
SOLVE_EDGES = 2000
#: Least raise of a bid in larger groups. Smaller is closer to the best total and takes more rounds where many want the same.
EPSILON = 1e-6

# Words that tell the kind of a watercourse, and letters to their sounds.
STATUS_WORDS = (
    "река", "реки", "речка", "ручей", "ручья", "руч", "канал", "канава", "кан", "протока", "проток", "прот", "р", "овраг", "овр", "балка", "river", "brook", "stream", "creek", "canal", "channel", "reka", "ruchey", "ruchei", "kanal", "kanava", "ditch", "drain", "rechka", "protoka", "the",
)
_DIGRAPHS = (("shch", "W"), ("zh", "J"), ("kh", "H"), ("ts", "c"), ("ch", "Q"), ("sh", "X"), ("yu", "u"), ("ya", "a"), ("yo", "o"), ("ye", "e"), ("ju", "u"), ("ja", "a"), ("jo", "o"))


def sound(name: Column) -> Column:
    """One spelling for a name in either script: kinds, brackets, case, doubled letters and soft signs removed."""
    n = F.lower(F.regexp_replace(name, r"\([^)]*\)", " "))
    n = F.regexp_replace(n, r"[^\p{L}\p{N}]+", " ")
    words = "|".join(STATUS_WORDS)
    n = F.trim(F.regexp_replace(n, rf"(?<![\p{{L}}])(?:{words})(?![\p{{L}}])", " "))
    n = F.translate(n, "ё", "о")
    n = F.translate(n, "абвгдезийклмнопрстуфцыэжхчшщюяъь", "abvgdeziiklmnoprstufcieJHQXWua")
    for a, b in _DIGRAPHS:
        n = F.replace(n, F.lit(a), F.lit(b))
    n = F.translate(n, "yj'", "ii")
    n = F.regexp_replace(n, r"\s+", "")
    return F.regexp_replace(n, r"(.)\1+", "$1")


def candidates(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct pairs ``l, r`` of entities that come near each other in one of the sort orders.

    Both: ``id, names array<string>, points array<struct<x,y>>``, one row for each id.
    """
    def entries(df: DataFrame, side: str) -> DataFrame:
        e = df.select(F.lit(side).alias("side"), "id", F.explode_outer("names").alias("n"), F.col("points")).select("side", "id", "n", F.explode_outer("points").alias("p"))
        strip = F.floor(F.col("p.x") / STRIP).cast("string")
        shifted = F.floor((F.col("p.x") + STRIP // 2) / STRIP).cast("string")
        place = F.when(F.col("p").isNotNull(), F.floor(F.col("p.x") / (16 * STRIP)).cast("bigint"))
        keys = F.array(
            F.when(F.col("n").isNotNull(), F.struct(F.lit(0).alias("k"), F.col("n").alias("a"), place.alias("b"), F.col("p.y").alias("c"))),
            F.when(F.col("n").isNotNull(), F.struct(F.lit(1).alias("k"), F.reverse("n").alias("a"), place.alias("b"), F.col("p.y").alias("c"))),
            F.when(F.col("p").isNotNull(), F.struct(F.lit(2).alias("k"), strip.alias("a"), F.col("p.y").alias("b"), F.lit(None).cast("bigint").alias("c"))),
            F.when(F.col("p").isNotNull(), F.struct(F.lit(3).alias("k"), shifted.alias("a"), F.col("p.y").alias("b"), F.lit(None).cast("bigint").alias("c"))),
        )
        return e.select("side", "id", F.explode(F.array_compact(keys)).alias("s")).select("side", "id", "s.*").distinct()

    all_ = entries(left.withColumn("id", F.col("id").cast("string")), "l").unionByName(entries(right.withColumn("id", F.col("id").cast("string")), "r"))
    # Ties of an order are broken by id, so a key that many rows share spreads over partitions too.
    ordered = all_.repartitionByRange("k", "a", "b", "c", "id", "side").sortWithinPartitions("k", "a", "b", "c", "id", "side")
    ranked = materialize(ordered.withColumn("m", F.monotonically_increasing_id()), "ranked")
    # Rank in the whole order: place within the partition and the rows of those before it.
    part = F.shiftright("m", 33)
    sizes = ranked.groupBy(part.alias("part")).agg(F.count("*").alias("n"))  # a row for each partition
    offsets = sizes.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("off"))
    pos = ranked.withColumn("part", part).join(F.broadcast(offsets), "part").select("side", "id", "k", (F.col("off") + F.col("m") - F.shiftleft("part", 33)).alias("pos"))
    l = pos.where("side = 'l'").select(F.col("id").alias("l"), "k", "pos", F.explode(F.array(*[F.floor(F.col("pos") / WINDOW) + d for d in (-1, 0, 1)])).alias("bucket"))
    r = pos.where("side = 'r'").select(F.col("id").alias("r"), "k", F.col("pos").alias("pos2"), F.floor(F.col("pos") / WINDOW).alias("bucket"))
    return l.join(r, ["k", "bucket"]).where(F.abs(F.col("pos") - F.col("pos2")) <= WINDOW).select("l", "r").distinct()


def _name_similarity(a: Column, b: Column) -> Column:
    one = lambda x, y: 1 - F.levenshtein(x, y) / F.greatest(F.length(x), F.length(y), F.lit(1))
    return F.coalesce(F.array_max(F.flatten(F.transform(a, lambda x: F.transform(b, lambda y: one(x, y))))), F.lit(0.0))


def _nearest(p: Column, ends: Column) -> Column:
    return F.array_min(F.transform(ends, lambda q: F.hypot((p["x"] - q["x"]).cast("double"), (p["y"] - q["y"]).cast("double"))))


def scored(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """``l, r, name_sim, place_sim, confidence``. Sides: ``id, names, points`` as for :func:`candidates`.

    The place similarity is the mean over the left entity's points of their nearness to
    the nearest right point (coordinates with exchanged axes are tried too); it is null
    where a side has no point.
    """
    a = left.select(F.col("id").cast("string").alias("l"), F.col("names").alias("ln"), F.col("points").alias("lp"))
    b = right.select(F.col("id").cast("string").alias("r"), F.col("names").alias("rn"), F.col("points").alias("rp"))
    j = pairs.join(a, "l").join(b, "r")
    near = lambda p: 1 / (1 + F.pow(F.least(_nearest(p, F.col("rp")), _nearest(F.struct(p["y"].alias("x"), p["x"].alias("y")), F.col("rp"))) / HALF, 2))
    sims = F.transform("lp", near)
    place = F.when((F.size("lp") > 0) & (F.size("rp") > 0), F.aggregate(sims, F.lit(0.0), lambda s, x: s + x) / F.size("lp"))
    nameless = ((F.size("ln") == 0) | (F.size("rn") == 0)) & (F.size("lp") > 1) & (F.size("rp") > 1)
    j = j.select("l", "r", nameless.alias("nameless"), _name_similarity(F.col("ln"), F.col("rn")).alias("name_sim"), place.alias("place_sim"), F.array_max(F.when(F.size("lp") > 0, sims)).alias("best_sim"))
    conf = F.when(
        (F.col("name_sim") >= LEAST_NAME) & (F.col("place_sim") >= LEAST_PLACE),
        W_NAME * F.col("name_sim") + W_PLACE * (0.5 * F.col("place_sim") + 0.5 * F.col("best_sim")),
    ).when(F.col("nameless") & (F.col("place_sim") >= NAMELESS), 0.7 * F.col("place_sim")).otherwise(F.lit(0.0))
    return j.withColumn("confidence", conf).drop("nameless")


def best_total(gain: np.ndarray) -> np.ndarray:
    """Column of each row in the assignment of the largest total gain (shortest augmenting paths); rows <= columns."""
    n, m = gain.shape
    row_price, col_price = np.zeros(n), np.zeros(m)
    owner = np.full(m, -1)
    for start in range(n):
        # Cheapest way to a free column, over columns that are taken.
        far, via = np.full(m, np.inf), np.full(m, -1)
        open_ = np.ones(m, bool)
        row, col = start, -1
        while row >= 0:
            reach = -gain[row] - row_price[row] - col_price
            near = open_ & (reach < far)
            far[near], via[near] = reach[near], col
            nxt = int(np.where(open_, far, np.inf).argmin())
            step = far[nxt]
            row_price[start] += step
            taken = ~open_
            row_price[owner[taken]] += step
            col_price[taken] -= step
            far[open_] -= step
            open_[nxt] = False
            col, row = nxt, int(owner[nxt])
        while col >= 0:
            back = int(via[col])
            owner[col] = owner[back] if back >= 0 else start
            col = back
    out = np.full(n, -1)
    got = owner >= 0
    out[owner[got]] = np.flatnonzero(got)
    return out


def _solve(group: pa.Table) -> pa.Table:
    """Best one-to-one choice of the pairs of a group."""
    l, r, c = (group.column(x).to_pylist() for x in ("l", "r", "confidence"))
    rows, cols = ({x: i for i, x in enumerate(sorted(set(v)))} for v in (l, r))
    gain = np.zeros((len(rows), max(len(rows), len(cols))))
    for x, y, w in zip(l, r, c):
        gain[rows[x], cols[y]] = w
    pick = best_total(gain)
    keep = [(x, y, w) for x, y, w in zip(l, r, c) if pick[rows[x]] == cols[y]]
    return pa.table({"l": pa.array([x for x, _, _ in keep], pa.string()), "r": pa.array([y for _, y, _ in keep], pa.string()), "confidence": pa.array([w for _, _, w in keep], pa.float64())})


def assign(edges: DataFrame) -> DataFrame:
    """One-to-one choice of ``l, r, confidence`` rows with the largest total confidence.

    Strings ``l`` and ``r``; of repeated pairs the most confident counts; pairs without a
    positive confidence are none. Pairs are grouped by what they hang together with. A group of at most
    SOLVE_EDGES pairs is solved exactly in one task, the others by :func:`auction`. Ties
    go to one of the best totals, the same in every run.
    """
    edges = materialize(edges.where("confidence > 0").groupBy("l", "r").agg(F.max("confidence").alias("confidence")), "edges")
    # Pairs that nobody else wants need no choice.
    lone = edges.join(edges.groupBy("l").count().where("count = 1").select("l"), "l", "left_semi").join(edges.groupBy("r").count().where("count = 1").select("r"), "r", "left_semi")
    lone = materialize(lone, "lone").select("l", "r", "confidence")
    rest = materialize(edges.join(lone, ["l", "r"], "left_anti").withColumn("a", F.xxhash64("l")), "contested")
    n = rest.count()
    if not n:
        return lone
    if n <= SOLVE_EDGES:  # all of them are one small task
        one = rest.select("l", "r", "confidence", F.lit(0).alias("group_id"))
        return lone.unionByName(one.groupBy("group_id").applyInArrow(_solve, "l string, r string, confidence double"))
    # Equal hashes only join groups, which harms no result.
    groups = components.link_groups(rest.select("a", F.xxhash64("r").alias("b")), "a", "b")
    grouped = spread_join(rest, groups, ["a"])
    sizes = grouped.groupBy("group_id").count()
    grouped = materialize(spread_join(grouped, sizes, ["group_id"]).select("l", "r", "confidence", "group_id", "count"), "groups")
    small = grouped.where(F.col("count") <= SOLVE_EDGES).select("l", "r", "confidence", "group_id").groupBy("group_id").applyInArrow(_solve, "l string, r string, confidence double")
    large = grouped.where(F.col("count") > SOLVE_EDGES).select("l", "r", "confidence")
    out = lone.unionByName(small)
    return out if large.isEmpty() else out.unionByName(auction(materialize(large, "large")))


def auction(rest: DataFrame) -> DataFrame:
    """One-to-one choice of distinct ``l, r, confidence`` rows, within EPSILON for each pair of the largest total.

    Every free ``l`` bids for its best ``r`` what it would lose by taking its second best (or
    nothing) and EPSILON; an ``r`` goes to its highest bidder and the former holder is free
    again. Ends when no free ``l`` gains by bidding. Prices begin at nothing, as an ``r`` that
    stays free must have no price; so there is no run with larger raises before it.
    """
    held = materialize(rest.select("r").distinct().select("r", F.lit(0.0).alias("price"), F.lit(None).cast("string").alias("l")), "prices")
    retired = None
    while True:
        taken = held.where("l is not null").select("l")
        free = rest.join(taken, "l", "left_anti")
        if retired is not None:
            free = free.join(retired, "l", "left_anti")
        net = free.join(held.select("r", "price"), "r").withColumn("net", F.col("confidence") - F.col("price"))
        # The best choice, and the best gain among the others; no list of all choices is made.
        top = net.groupBy("l").agg(F.max(F.struct("net", "r", "price")).alias("t"))
        second = net.join(top.select("l", F.col("t.r").alias("r")), ["l", "r"], "left_anti").groupBy("l").agg(F.max("net").alias("next"))
        raised = F.col("t.price") + F.col("t.net") - F.greatest(F.lit(0.0), F.coalesce("next", F.lit(0.0))) + EPSILON
        bids = materialize(top.join(second, "l", "left").select("l", F.col("t.r").alias("r"), F.col("t.net").alias("gain"), raised.alias("bid")), "bids")
        if bids.isEmpty():
            break
        out = bids.where("gain <= 0").select("l")
        retired = materialize(out if retired is None else retired.unionByName(out).distinct(), "retired")
        won = bids.where("gain > 0").groupBy("r").agg(F.max(F.struct(F.col("bid"), F.col("l"))).alias("w"))
        new = materialize(held.join(won, "r", "left").select("r", F.coalesce("w.bid", "price").alias("price"), F.coalesce("w.l", "l").alias("l")), "prices")
        release(held, bids)
        held = new
    return held.where("l is not null").join(rest, ["l", "r"]).select("l", "r", "confidence")


def match_watercourses(waterways: DataFrame, relations: DataFrame, ways: DataFrame, linked: bool = False) -> DataFrame:
    """Watercourses without ``osm_id`` and the relations that describe the same one.

    Returns ``id, rel_osm_id, confidence``, one-to-one. All rows of an id or relation are
    joined into one entity: every spelling of its names, every known end. Relations that
    an ``osm_id`` names already are left out. Entities without a place match nothing; one without a name
    only when both of its ends agree.
    ``linked`` matches the watercourses that have an ``osm_id`` instead (to measure
    against the known links). Null ids, null names and null or empty geometries are skipped.
    """
    w, r = entities(waterways, relations, ways, linked)
    w, r = materialize(w, "left"), materialize(r, "right")
    s = scored(candidates(w, r), w, r)
    got = assign(s.where(F.col("confidence") >= LEAST).select("l", "r", "confidence"))
    return got.select(F.col("l").alias("id"), F.col("r").cast("bigint").alias("rel_osm_id"), "confidence")


def entities(waterways: DataFrame, relations: DataFrame, ways: DataFrame, linked: bool = False) -> tuple[DataFrame, DataFrame]:
    known = waterways.where("osm_id is not null").select(F.col("osm_id").alias("rel_osm_id")).distinct()
    names = lambda c: F.array_sort(F.filter(F.array_distinct(F.transform(F.array_compact(c), lambda x: sound(x))), lambda x: F.length(x) > 1))
    w = waterways.where("id is not null").groupBy("id").agg(
        F.max("osm_id").alias("osm_id"), F.collect_set("name_ru").alias("ru"), F.collect_set("name_en").alias("en"),
        F.collect_set("source_pnt").alias("s"), F.collect_set("mouth_pnt").alias("m"))
    w = w.where("osm_id is not null" if linked else "osm_id is null").select("id", names(F.array_union("ru", "en")).alias("names"), F.filter(F.array_union("s", "m"), lambda p: p["x"].isNotNull() & p["y"].isNotNull()).alias("points"))

    tags = F.col("tags")
    keys = F.filter(F.map_keys(tags), lambda k: k.isin("name", "alt_name", "old_name", "int_name", "official_name", "loc_name") | k.startswith("name:"))
    rel = relations.where("rel_osm_id is not null")
    all_names = rel.select("rel_osm_id", F.explode(keys).alias("k"), "tags").select("rel_osm_id", F.explode(F.split(F.col("tags")[F.col("k")], ";")).alias("n")).groupBy("rel_osm_id").agg(F.collect_set("n").alias("n"))
    g = ways.where("way_osm_id is not null and size(geom) > 0").groupBy("way_osm_id").agg(F.min(F.struct(F.get("geom", F.lit(0)).alias("a"), F.try_element_at("geom", F.lit(-1)).alias("b"))).alias("e"))
    member = rel.select("rel_osm_id", F.explode("members").alias("m")).where("m.type = 'way' and m.ref is not null").select("rel_osm_id", F.col("m.ref").alias("way_osm_id")).distinct()
    ends = member.join(g, "way_osm_id").select("rel_osm_id", F.explode(F.array("e.a", "e.b")).alias("p")).where("p is not null")
    # Ends of single ways count once; places where two members meet are inner points of the course.
    ends = ends.groupBy("rel_osm_id", "p").agg(F.count("*").alias("n"))
    pts = ends.groupBy("rel_osm_id").agg(F.collect_set(F.when(F.col("n") == 1, F.col("p"))).alias("outer"), F.collect_set("p").alias("all"))
    r = rel.select("rel_osm_id").distinct()
    if not linked:
        r = r.join(known, "rel_osm_id", "left_anti")
    r = r.join(all_names, "rel_osm_id", "left").join(pts, "rel_osm_id", "left").select(
        F.col("rel_osm_id").alias("id"), F.coalesce(names(F.col("n")), F.array().cast("array<string>")).alias("names"),
        F.coalesce(F.when(F.size("outer") > 0, F.col("outer")), F.col("all"), F.array().cast(pts.schema["all"].dataType)).alias("points"))
    return w, r
