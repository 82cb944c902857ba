"""Tag rules over a stream of changed ways."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from rillwork.operators.tagging import way_findings


def stream_findings(ways: DataFrame, out: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append the findings of every arriving way to Parquet files; stateless, so late and repeated ways are judged as they come.

    ``ways``: a streaming DataFrame with ``way_osm_id, tags``; ``once`` handles what is there and ends.
    """
    w = way_findings(ways).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append")
    return (w.trigger(availableNow=True) if once else w).start()
