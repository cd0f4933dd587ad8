import pytest
from pyspark.sql import functions as F

from widelog.operators.merge import merge_on_read
from widelog.spec import TableSpec
from widelog.streaming.upserts import current, latest_per_window, stream_writes

SPEC = TableSpec.of("events", {"user_id": "bigint"}, {"event_type": "text"}, {"event_id": "bigint", "value": "double"})


def test_stream_equals_batch(spark, small, tmp_path):
    events = spark.read.parquet(f"{small}/events.parquet")
    at = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts"))
    for k in range(3):
        events.filter(f"event_id % 3 = {k}").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    rows = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in").select("user_id", "event_type", "event_id", "value", at.alias("at"))
    for _ in range(2):  # the second finds nothing new
        stream_writes(rows, SPEC, f"{tmp_path}/log", f"{tmp_path}/ck", {"TIMESTAMP": "at"}).awaitTermination()
    want = merge_on_read(events.withColumn("_writetime", at), SPEC)
    got = current(spark, SPEC, f"{tmp_path}/log")
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    with pytest.raises(ValueError):
        stream_writes(rows, SPEC, f"{tmp_path}/log", f"{tmp_path}/ck")


def test_windows(spark, small):
    events = spark.read.parquet(f"{small}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    out = latest_per_window(events, SPEC, "ts", "1 day", "1 hour")
    want = events.groupBy(F.window("ts", "1 day"), "user_id", "event_type").agg(F.max_by("value", "ts").alias("value"))
    assert out.count() == want.count() and abs(out.agg(F.sum("value")).first()[0] - want.agg(F.sum("value")).first()[0]) < 1e-6
