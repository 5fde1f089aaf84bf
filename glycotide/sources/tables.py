"""The driver's ``events`` table as readings and annotations, for queries over tables of any size.

Purchases are annotations, the rest readings. 150 users are one series, so that a series has a reading about every five
minutes; 15 are one subject, for operators between events. The scale of values makes all signals occur.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glycotide.functions.columns import wall_micros

UNIT, INTERVAL, SERIES_USERS, SUBJECT_USERS = "mg/dL", 5.0, 150, 15
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a wall clock without zone; it is read as UTC, by counting from the wall clock's 1970
    ts = F.col("ts").cast("timestamp_ntz")
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    return rows.withColumns({"ts_raw": F.date_format(ts, ISO), "ts": F.timestamp_micros(wall_micros(ts))})


def samples(spark: SparkSession, sf_dir: str, series_users: int = SERIES_USERS) -> DataFrame:
    """Flat samples: times are unique, so their microseconds are the places in a series."""
    rows = _events(spark, sf_dir).filter("event_type <> 'purchase'")
    return rows.select(
        F.expr(f"user_id div {series_users}").alias("series_id"), F.unix_micros("ts").alias("pos"), "ts", "ts_raw", (F.lit(70.0) + F.lit(0.25) * F.col("value")).alias("glucose_value"),
        F.lit(None).cast("array<string>").alias("quality_flags"), F.lit(UNIT).alias("unit"), F.lit(INTERVAL).alias("sampling_interval_minutes"),
    )


def shared_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotations that two series each have, as if read from one document: an id stands for an event of either. SUBJECT_USERS are a series here."""
    rows = annotations(spark, sf_dir)
    both = F.array(F.col("subject_id"), F.col("subject_id").bitwiseXOR(F.lit(1)))
    return rows.withColumn("series_id", F.explode(both)).withColumn("subject_id", F.col("series_id"))


def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat annotations without ends; the carbohydrates are the number in ``props``."""
    rows = _events(spark, sf_dir).filter("event_type = 'purchase'")
    carbs = F.get_json_object("props", "$.k").cast("double")
    component = F.struct(F.lit("carbohydrate").alias("name"), carbs.alias("value"), F.lit("g").alias("unit"))
    return rows.select(
        F.col("event_id").cast("string").alias("event_id"), F.expr(f"user_id div {SERIES_USERS}").alias("series_id"), F.expr(f"user_id div {SUBJECT_USERS}").alias("subject_id"),
        F.col("event_id").alias("pos"), F.lit("meal").alias("event_type"), F.col("ts").alias("start_time"), F.col("ts_raw").alias("start_time_raw"),
        F.lit(None).cast("timestamp").alias("end_time"), F.lit(None).cast("string").alias("end_time_raw"), F.lit(None).cast("double").alias("duration_minutes"),
        F.when(carbs.isNotNull(), F.array(component)).alias("exposure_components"), F.when(F.col("event_id") % 3 == 0, "manual").otherwise("app").alias("source"),
        (F.col("event_id") % 11 / F.lit(10.0)).alias("annotation_quality"), F.concat(F.lit("Food "), (F.col("event_id") % 4).cast("string")).alias("label"),
        F.when(F.col("event_id") % 2 == 0, "Context tags: dinner, Restaurant").alias("notes"), F.lit(UNIT).alias("unit"), F.lit(INTERVAL).alias("interval"),
    )
