"""The stream-stream join and the running metrics, in append mode over files that arrive one by one."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from glycotide.streaming import windows

T0 = datetime(2024, 1, 1, 8, 0)


def test_metrics_of_a_stream(spark, tmp_path):
    samples = [("s", T0 + timedelta(minutes=m), 100.0 + max(0, 60 - abs(m - 60))) for m in range(-60, 300, 5)]
    later = [("s", T0 + timedelta(days=d), 90.0) for d in (2, 3, 4)]
    events = [("e1", "s", T0), ("e2", "other", T0)]
    more = [(f"x{d}", "s", T0 + timedelta(days=d)) for d in (2, 3, 4)]
    for n, (s, e) in enumerate(((samples, events), (later, more))):
        spark.createDataFrame(s, "series_id string, ts timestamp, glucose_value double").coalesce(1).write.parquet(f"{tmp_path}/samples/{n}")
        spark.createDataFrame(e, "event_id string, series_id string, start_time timestamp").coalesce(1).write.parquet(f"{tmp_path}/events/{n}")
    stream = lambda name, schema: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/{name}")
    joined = windows.event_samples(stream("events", "event_id string, series_id string, start_time timestamp"), stream("samples", "series_id string, ts timestamp, glucose_value double"), "series_id")
    table = windows.running_metrics(joined, "series_id")
    query = table.writeStream.outputMode("append").format("memory").queryName("running").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
    query.awaitTermination(120)
    got = {r.event_id: r for r in spark.table("running").filter(F.col("event_id") == "e1").collect()}
    assert (got["e1"].baseline_glucose, got["e1"].peak_glucose, got["e1"].nadir_glucose, got["e1"].samples) == (100.0, 160.0, 100.0, 55)
    assert spark.table("running").filter("event_id = 'e2'").count() == 0
