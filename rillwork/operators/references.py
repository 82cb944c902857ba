"""References to records that do not exist.

References and parent keys are reduced to what the decision needs, hashed by
key onto the same partitions, sorted there, and merged as two sorted streams
(Spark's sort-merge join). Each key of the parent stream carries its validity
interval: first arrival and first deletion. A key that a large share of the
references name is split before the shuffle (see :func:`spread_join`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillwork.runtime import spread_join


def orphan_references(refs: DataFrame, parents: DataFrame, deletions: DataFrame) -> DataFrame:
    """State of every dangling reference.

    refs: ``field, id, target, ref, seen_at``; parents: ``target, ref, arrived_at``
    (null = always present); deletions: ``target, ref, deleted_at``. Returns
    distinct ``field, id, ref, period, status``; status is ``deleted`` when the key
    was deleted not after ``seen_at``, else ``missing`` when no parent has the key,
    else ``late`` when the parent first arrived in a later month. Other references
    give no row. Null ``ref`` is no reference; a null ``seen_at`` has a null period
    and can only be missing. Repeated rows count once; extra columns are ignored.
    """
    # Only the newest reference of a month can decide "deleted", the others repeat it or not.
    r = (
        refs.where(F.col("ref").isNotNull())
        .select("field", "id", "target", "ref", "seen_at", F.date_format("seen_at", "yyyy-MM").alias("period"))
        .groupBy("field", "id", "target", "ref", "period")
        .agg(F.max("seen_at").alias("last_seen"), F.min("seen_at").alias("first_seen"))
    )
    p = parents.where(F.col("ref").isNotNull()).select(
        "target", "ref", F.coalesce("arrived_at", F.to_timestamp(F.lit("0001-01-01"))).alias("arrived_at"), F.lit(None).cast("timestamp").alias("deleted_at"))
    d = deletions.where(F.col("ref").isNotNull()).select(
        "target", "ref", F.lit(None).cast("timestamp").alias("arrived_at"), "deleted_at")
    intervals = p.unionByName(d).groupBy("target", "ref").agg(
        F.min("arrived_at").alias("arrived_at"), F.min("deleted_at").alias("deleted_at"))
    m = spread_join(r, intervals.hint("merge"), ["target", "ref"], "left")
    gone_last = F.coalesce(F.col("deleted_at") <= F.col("last_seen"), F.lit(False))
    gone_first = F.coalesce(F.col("deleted_at") <= F.col("first_seen"), F.lit(False))
    rest = (
        F.when(F.col("arrived_at").isNull(), F.lit("missing"))
        .when(F.date_format("arrived_at", "yyyy-MM") > F.col("period"), F.lit("late"))
    )
    # Rows of one month before and after the deletion are two references with two states.
    states = F.array(F.when(gone_last, F.lit("deleted")), F.when(~gone_first, rest))
    return m.select("field", "id", "ref", "period", F.explode(states).alias("status")).where(F.col("status").isNotNull()).distinct()


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Counts per field, period and status."""
    return orphans.groupBy("field", "period", "status").agg(F.count("*").alias("n_refs"), F.countDistinct("ref").alias("n_keys"))
