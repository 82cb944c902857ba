"""Session defaults, shared-folder tables and skew-safe joins.

Lineage is cut by writing a Parquet table below the folder that the session
names in ``spark.checkpoint.dir``; every executor can read it again, so a lost
executor costs a re-read and no recomputation of earlier rounds.
"""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import rillwork

#: A key is hot when it holds more than 1/HOT_SHARE of all rows, so there are
#: fewer than HOT_SHARE hot keys whatever the input: that bounds the broadcast.
HOT_SHARE = 256
#: Number of parts a hot key is split into.
SALTS = 32

# Functions sent to Python workers carry their code, so the package need not be installed there.
cloudpickle.register_pickle_by_value(rillwork)

_RUN = uuid.uuid4().hex[:12]
_COUNTER = iter(range(1 << 62))


def session(master: str = "local[*]", partitions: int = 8, **conf: str) -> SparkSession:
    """A session for local work; on a cluster the submitter's settings win."""
    b = (
        SparkSession.builder.master(master)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder of ``spark.checkpoint.dir``. Unset, it gets a local default where all tasks run in one process
    (tests); on several machines a local folder would lose rows, so there the call is refused."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="rillwork-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/rillwork-{_RUN}"


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` to the shared folder and return the reading side."""
    spark = df.sparkSession
    base = shared_dir(spark)
    if not getattr(spark, "_rillwork_cleanup", False):
        spark._rillwork_cleanup = True
        atexit.register(_quietly, spark, base)
    path = f"{base}/{next(_COUNTER):06d}-{name}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._rillwork_path = path
    return out


def release(*dfs: DataFrame) -> None:
    """Delete tables of :func:`materialize` that no later step reads."""
    for df in dfs:
        path = getattr(df, "_rillwork_path", None)
        if path:
            _delete(df.sparkSession, path)


def _quietly(spark: SparkSession, path: str) -> None:
    try:
        _delete(spark, path)
    except Exception:
        pass


def hot_keys(big: DataFrame, on: list[str]) -> DataFrame:
    """Keys with more than 1/HOT_SHARE of the rows of ``big``: fewer than HOT_SHARE rows, whatever the input."""
    total = big.agg(F.count("*").alias("__n"))
    return (
        big.select(*on).dropna(subset=on).groupBy(*on).agg(F.count("*").alias("__c"))
        .crossJoin(F.broadcast(total))  # one row
        .where(F.col("__c") * HOT_SHARE > F.greatest(F.col("__n"), F.lit(HOT_SHARE * SALTS)))
        .select(*on, F.lit(True).alias("__hot"))
    )


def spread_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner", hot: DataFrame | None = None) -> DataFrame:
    """Many-to-one equi-join that survives a key holding a third of ``big``.

    Hot keys are split into SALTS parts by a hash of the whole row, and only those rows
    of ``small`` are replicated. The list of hot keys has a proven size bound (see
    :func:`hot_keys`) and is broadcast; ``hot`` gives it when it is known already. ``how``:
    inner, left, left_semi or left_anti. Null keys never match, as in SQL.
    """
    hot = hot_keys(big, on) if hot is None else hot
    salt = F.pmod(F.xxhash64(*[c for c, t in big.dtypes if not t.startswith("map")]), F.lit(SALTS)).cast("int")
    left = big.join(F.broadcast(hot), on, "left").withColumn("__salt", F.when(F.col("__hot"), salt).otherwise(F.lit(0))).drop("__hot")
    right = (
        small.join(F.broadcast(hot), on, "left")
        .withColumn("__salt", F.explode(F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))
        .drop("__hot")
    )
    return left.join(right, [*on, "__salt"], how).drop("__salt")
