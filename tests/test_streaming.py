from rillwork.operators.tagging import way_findings
from rillwork.streaming.revalidate import stream_findings


def test_stream_equals_batch(spark, sf, tmp_path):
    batch = spark.read.parquet(f"{sf}/osm_ways.parquet").select("way_osm_id", "tags")
    batch.repartition(3).write.parquet(str(tmp_path / "in"))
    ways = spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in"))
    stream_findings(ways, str(tmp_path / "out"), str(tmp_path / "cp"), once=True).awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, way_findings(batch).collect()))
