"""Parent-child links to full hierarchies.

Deterministic hash splitters cut every chain of parents into short pieces. Each
node walks to its next splitter or root (pointer doubling, so a piece of length g
takes log2 g rounds), the graph of splitters alone is solved the same way, and
exact paths are put together from the two. A walk that meets a node twice is on,
or runs into, a cycle; cycles without a splitter show up in the first phase,
cycles with splitters in the second.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillwork.runtime import materialize, release, spread_join

SPLIT = 8
_STATE = ["id", "ptr", "seg", "state"]


def _double(start: DataFrame, name: str) -> DataFrame:
    """Walk every row of ``start`` to a stop.

    start: ``id, ptr, seg, state``; seg holds the nodes passed, from just above
    ``id``'s stop down to ``id``; state is ``walk`` while ptr is an ordinary node,
    ``stop`` when ptr is where the walk ends, ``cycle`` when there is no end.
    """
    done, todo = None, materialize(start, name)
    table = todo
    while True:
        open_ = table.where("state = 'walk'")
        finished = table.where("state <> 'walk'")
        done = finished if done is None else done.unionByName(finished)
        if open_.isEmpty():
            return done.select(*_STATE)
        # Where ptr is itself finished, all of its walk is appended; else its walk so far.
        reach = done.unionByName(open_).select(F.col("id").alias("ptr"), F.col("ptr").alias("p2"), F.col("seg").alias("s2"), F.col("state").alias("st2"))
        step = spread_join(open_, reach, ["ptr"], "inner")
        seg = F.concat("s2", "seg")
        step = step.select(
            "id", F.col("p2").alias("ptr"), seg.alias("seg"),
            F.when((F.col("st2") == "cycle") | (F.size(F.array_distinct(seg)) < F.size(seg)), F.lit("cycle")).otherwise(F.col("st2")).alias("state"))
        # A cycle needs no path.
        step = step.withColumn("seg", F.when(F.col("state") == "cycle", F.array(F.col("id"))).otherwise(F.col("seg")))
        table = materialize(step, name)


def hierarchy(links: DataFrame, split: int = SPLIT) -> DataFrame:
    """Path, depth, root and number of descendants of every node of a forest.

    links: ``id`` string, ``parent`` string; rows repeat freely. Null ids give no
    row. A parent that is no id of the table is none. Of several valid parents of
    one id the smallest is taken. Returns one row for each id: ``id, root_id, depth,
    path, n_descendants``; ids on a cycle or below one have root_id ``cycle``, depth
    -1, an empty path and -1 descendants. An empty table gives an empty result.
    """
    ids = links.where(F.col("id").isNotNull()).select("id").distinct()
    valid = spread_join(
        links.where("id is not null and parent is not null").select("id", "parent").distinct(),
        ids.select(F.col("id").alias("parent")), ["parent"], "left_semi")
    up = valid.groupBy("id").agg(F.min("parent").alias("parent"))
    nodes = ids.join(up, "id", "left")
    is_split = lambda c: F.pmod(F.xxhash64(c), F.lit(split)) == 0
    nodes = materialize(nodes.select("id", "parent", (F.col("parent").isNull() | is_split(F.col("id"))).alias("stop")), "nodes")

    # Phase 1: each node to the next stop above it.
    inner = spread_join(
        nodes.where("parent is not null").withColumnRenamed("stop", "own_stop"),
        nodes.select(F.col("id").alias("parent"), F.col("stop").alias("p_stop")), ["parent"])
    walk = inner.select(
        "id", F.col("parent").alias("ptr"), F.array("id").alias("seg"),
        F.when(F.col("parent") == F.col("id"), F.lit("cycle")).when(F.col("p_stop"), F.lit("stop")).otherwise(F.lit("walk")).alias("state"))
    pieces = materialize(_double(walk, "walk"), "pieces")

    # Phase 2: the graph of stops. Roots end it.
    stops = nodes.where("stop").select("id", "parent")
    roots = stops.where("parent is null").select("id")
    reduced = stops.where("parent is not null").select("id").join(pieces, "id")
    reduced = spread_join(reduced, roots.select(F.col("id").alias("ptr"), F.lit(True).alias("at_root")), ["ptr"], "left")
    reduced = reduced.select("id", "ptr", "seg", F.when(F.col("state") == "cycle", F.lit("cycle")).when(F.col("at_root"), F.lit("stop")).otherwise(F.lit("walk")).alias("state"))
    solved = _double(reduced, "reduced")
    anchors = roots.select(F.col("id"), F.array("id").alias("seg"), F.lit("stop").alias("state")).unionByName(
        solved.select("id", F.when(F.col("state") == "cycle", F.col("seg")).otherwise(F.concat(F.array("ptr"), "seg")).alias("seg"), "state"))
    anchors = materialize(anchors, "anchors")

    # Phase 3: exact paths.
    ordinary = pieces.join(nodes.where("not stop").select("id"), "id", "left_semi")
    lower = spread_join(
        ordinary.where("state = 'stop'"),
        anchors.select(F.col("id").alias("ptr"), F.col("seg").alias("head"), F.col("state").alias("above")), ["ptr"])
    full = anchors.unionByName(ordinary.where("state = 'cycle'").select("id", "seg", "state")).unionByName(
        lower.select("id", F.concat("head", "seg").alias("seg"), F.col("above").alias("state")))
    full = materialize(full, "paths")

    # Phase 4: descendants. A stop stands for itself and the nodes that hang on it; its subtree's size is the sum
    # over the stops below it, and goes to the ordinary nodes of the piece above it in one number.
    # So only pieces are unfolded, and the paths of stops to their stops.
    above = F.slice("seg", F.lit(1), F.size("seg") - 1)
    hung = materialize(ordinary.where("state = 'stop'").select("ptr", above.alias("above")), "hung")
    weight = hung.groupBy(F.col("ptr").alias("id")).agg(F.count("*").alias("n"))
    chain = F.concat(F.slice("seg", 1, 1), F.filter(F.slice("seg", F.lit(2), F.greatest(F.size("seg") - 1, F.lit(0))), is_split))
    size = anchors.where("state = 'stop'").join(weight, "id", "left").select(F.explode(chain).alias("id"), (F.coalesce("n", F.lit(0)) + 1).alias("n"))
    size = materialize(size.groupBy("id").agg(F.sum("n").alias("n")), "sizes")
    below = (
        hung.select(F.explode("above").alias("id"), F.lit(1).cast("bigint").alias("n"))
        .unionByName(pieces.select("id", above.alias("above")).join(size, "id").select(F.explode("above").alias("id"), "n"))
        .unionByName(size.select("id", (F.col("n") - 1).alias("n")))
        .groupBy("id").agg(F.sum("n").alias("n_descendants"))
    )
    ok = F.col("state") == "stop"
    return full.join(below, "id", "left").select(
        "id",
        F.when(ok, F.col("seg")[0]).otherwise(F.lit("cycle")).alias("root_id"),
        F.when(ok, F.size("seg") - 1).otherwise(F.lit(-1)).cast("bigint").alias("depth"),
        F.when(ok, F.array_join("seg", ">")).otherwise(F.lit("")).alias("path"),
        F.when(ok, F.coalesce("n_descendants", F.lit(0))).otherwise(F.lit(-1)).cast("bigint").alias("n_descendants"))
