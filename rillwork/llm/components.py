"""Consolidating pairwise matches into groups by low-diameter decomposition.

Every vertex draws an exponential shift from a hash of its id. Clusters grow from
the vertices in the order of their shifted start times: a vertex joins the centre
with the largest ``shift - distance``. ROUNDS steps of growth are taken per level
(a vertex reached later simply keeps the centre it has; any centre it holds is in its
own component, so stopping early is exact). Clusters are contracted to super-vertices,
edges inside a cluster vanish, the rest is solved on the next level, and the
assignments of all levels are composed from the last to the first. The shifts are large
enough for a level to leave about a tenth of the edges, also of long chains.

Every vertex has an edge of length 0 to itself, so a step of growth is one join and one
aggregation and refers to the step before it once. A level works only on the clusters
that still have edges. Vertices that many links share, contracted ones included, are
split in the joins of their level.

Each super-vertex carries the smallest label below it, so the group's identifier comes
out of the contraction, without grouping the rows of a component anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillwork.runtime import hot_keys, materialize, release, spread_join

#: Rate of the exponential shifts; larger means smaller clusters.
BETA = 0.1
ROUNDS = 6

# A vertex is a kind and an id, in two columns, so every 64-bit id is its own in each kind.


def _shift(kind: Column, v: Column, level: int) -> Column:
    u = (F.pmod(F.xxhash64(kind, v, F.lit(level)), F.lit(1 << 40)) + 1).cast("double") / float((1 << 40) + 1)
    return -F.log(u) / F.lit(BETA)


def _renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(a).alias(b) for a, b in names.items()])


def _join(big: DataFrame, small: DataFrame, on: list[str], hot: DataFrame | None) -> DataFrame:
    return big.join(small, on) if hot is None else spread_join(big, small, on, hot=_renamed(hot, dict(zip(hot.columns, [*on, "__hot"]))))


def _grow(edges: DataFrame, level: int, hot: DataFrame | None) -> DataFrame:
    """``k, v, ck, c``: the centre of every vertex. edges: both directions, ``uk, u, vk, v``."""
    own = edges.select("uk", "u").distinct().select("uk", "u", F.col("uk").alias("vk"), F.col("u").alias("v"), F.lit(0.0).alias("far"))
    steps = edges.withColumn("far", F.lit(1.0)).unionByName(own)  # every step reads the same exchange of it
    best = lambda offers: offers.groupBy("vk", "v").agg(F.max("s").alias("s"), F.max_by("ck", "s").alias("ck"), F.max_by("c", "s").alias("c"))
    # First step: all centres are at their own vertex, so no join is needed.
    lab = best(steps.select("vk", "v", (_shift(F.col("uk"), F.col("u"), level) - F.col("far")).alias("s"), F.col("uk").alias("ck"), F.col("u").alias("c")))
    for _ in range(1, ROUNDS):
        at = _renamed(lab, {"vk": "uk", "v": "u", "s": "s", "ck": "ck", "c": "c"})
        lab = best(_join(steps, at, ["uk", "u"], hot).select("vk", "v", (F.col("s") - F.col("far")).alias("s"), "ck", "c"))
    return materialize(_renamed(lab, {"vk": "k", "v": "v", "ck": "ck", "c": "c"}), "assign")


def _solve(both: DataFrame, labels: DataFrame) -> DataFrame | None:
    """``k, v, group_id`` of every vertex with an edge; None without edges.

    both: distinct ``uk, u, vk, v`` in both directions without loops, in the shared folder;
    labels: ``k, v, label`` of any vertices.
    """
    levels = []
    while not both.isEmpty():
        many = hot_keys(both, ["uk", "u"]).collect()  # fewer than HOT_SHARE rows
        hot = both.sparkSession.createDataFrame(many, "uk tinyint, u bigint, __hot boolean") if many else None
        assign = _grow(both, len(levels), hot)
        clusters = materialize(assign.join(labels, ["k", "v"], "left").groupBy("ck", "c").agg(F.min("label").alias("label")), "clusters")
        up = _join(both, _renamed(assign, {"k": "uk", "v": "u", "ck": "cuk", "c": "cu"}), ["uk", "u"], hot)
        up = _join(up, _renamed(assign, {"k": "vk", "v": "v", "ck": "cvk", "c": "cv"}), ["vk", "v"], hot)
        up = up.where("cuk <> cvk or cu <> cv")
        nxt = materialize(_renamed(up, {"cuk": "uk", "cu": "u", "cvk": "vk", "cv": "v"}).distinct(), "edges")
        release(both)
        both = nxt
        levels.append((assign, clusters))
        labels = _renamed(clusters, {"ck": "k", "c": "v", "label": "label"})
    final = None
    for assign, clusters in reversed(levels):
        if final is not None:
            # Clusters without an edge of their own were finished on this level.
            clusters = clusters.join(_renamed(final, {"k": "ck", "v": "c", "group_id": "above"}), ["ck", "c"], "left").select("ck", "c", F.coalesce("above", "label").alias("label"))
        final = spread_join(assign, clusters, ["ck", "c"]).select("k", "v", F.col("label").alias("group_id"))
    return final


def components(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Smallest label in the connected component of every vertex.

    edges: ``u, v`` bigint, in any direction, repeated rows and loops allowed; labels:
    ``v, label`` bigint, for any of the vertices (a vertex without an edge is its own
    component). Rows with a null vertex are no edge. Returns one row ``v, group_id`` for
    each vertex that is in an edge or has a label; group_id is null where no vertex of
    the component has a label. Empty tables give an empty result.
    """
    one = F.lit(0).cast("tinyint")
    clean = edges.where("u is not null and v is not null").select(one.alias("uk"), "u", one.alias("vk"), "v")
    lab = materialize(labels.where("v is not null").groupBy("v").agg(F.min("label").alias("label")).select(one.alias("k"), "v", "label"), "labels")
    alone = materialize(clean.select("u").unionByName(_renamed(clean, {"v": "u"})).distinct().select(F.col("u").alias("v")).unionByName(lab.select("v")).distinct(), "verts")
    both = clean.where("u <> v")
    both = materialize(both.unionByName(_renamed(both, {"vk": "uk", "v": "u", "uk": "vk", "u": "v"})).distinct(), "edges")
    got = _solve(both, lab)
    own = alone.join(lab.select("v", "label"), "v", "left")
    if got is None:
        return own.select("v", F.col("label").alias("group_id"))
    return own.join(got.select("v", "group_id", F.lit(True).alias("tied")), "v", "left").select(
        "v", F.when(F.col("tied"), F.col("group_id")).otherwise(F.col("label")).alias("group_id"))


def link_groups(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """Groups of a two-sided link table: ``left`` column's ids with the smallest ``right`` id of their group.

    Both sides have their own id space of any 64-bit numbers. Rows with a null key on either
    side are no link; repeated rows count once; other columns are not read. An empty table
    gives an empty result.
    """
    a, b = (F.lit(i).cast("tinyint") for i in (0, 1))
    p = pairs.select(F.col(left).cast("bigint").alias("u"), F.col(right).cast("bigint").alias("v")).dropna().distinct().select(a.alias("uk"), "u", b.alias("vk"), "v")
    p = materialize(p, "links")
    both = p.unionByName(_renamed(p, {"vk": "uk", "v": "u", "uk": "vk", "u": "v"}))
    labels = p.select(F.col("vk").alias("k"), "v", F.col("v").alias("label")).distinct()
    got = _solve(both, labels)
    if got is None:
        return p.select(F.col("u").alias(left), F.col("v").alias("group_id"))
    return got.where("k = 0").select(F.col("v").alias(left), F.col("group_id"))
