"""Readings joined to the events around them as both arrive, and per-event aggregates that late readings still reach."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glycotide.config import MetricWindows


def event_samples(events: DataFrame, samples: DataFrame, key: str, *, low: float = -30, high: float = 240, delay: str = "1 hour") -> DataFrame:
    """An inner stream-stream join: event_id, key, start_time, sample_key, ts, glucose_value of samples low to high minutes from a start.

    Both sides have a watermark of ``delay``; with the bounds it lets state be dropped when no partner can come any more.
    events: event_id, key, start_time; samples: key, ts, glucose_value.
    """
    e = events.select("event_id", F.col(key).alias("_key"), "start_time").withWatermark("start_time", delay)
    s = samples.select(key, "ts", "glucose_value").withWatermark("ts", delay)
    within = F.expr(f"ts >= start_time + INTERVAL {int(low * 60)} SECONDS AND ts <= start_time + INTERVAL {int(high * 60)} SECONDS")
    return e.join(s, (F.col("_key") == F.col(key)) & within).drop("_key")


def running_metrics(joined: DataFrame, key: str, windows: MetricWindows | None = None, bucket: str = "1 day") -> DataFrame:
    """Baseline, largest and smallest value per event, by day of its start, for the append output mode.

    Over a stream-stream join Spark has no other mode: an event's row comes out when the watermark has passed its day.
    """
    w = windows or MetricWindows()
    offset = (F.unix_micros("ts") - F.unix_micros("start_time")) / 6e7
    inside = lambda x: offset.between(x.start, x.end)
    v = F.col("glucose_value")
    return joined.groupBy(F.window("start_time", bucket).alias("day"), "event_id", key).agg(
        F.avg(F.when(inside(w.baseline), v)).alias("baseline_glucose"), F.max(F.when(inside(w.peak), v)).alias("peak_glucose"), F.min(F.when(inside(w.nadir), v)).alias("nadir_glucose"), F.count("*").alias("samples"),
    )
