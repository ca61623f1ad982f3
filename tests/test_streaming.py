"""Streamed and batch counts agree."""

from conftest import SMALL

from weftline.streaming.events import windowed_counts


def test_stream_equals_batch(spark, tmp_path):
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = windowed_counts(spark.readStream.schema(events.schema).parquet(str(tmp_path / "in")))
    query = stream.writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination(120)
    got = {(r.start, r.event_type): r.n for r in spark.table("counts").collect()}
    assert got == {(r.start, r.event_type): r.n for r in windowed_counts(events).collect()}
