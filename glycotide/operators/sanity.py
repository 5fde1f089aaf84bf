"""Sanity aggregates of sample series: coverage, regularity, extremes, suspicious changes and flags.

Samples have the key columns, ``pos``, ``ts``, ``glucose_value``, ``quality_flags``, and, per series, ``unit`` and
``sampling_interval_minutes``. Each function gives one row per series (suspicious: one per change).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glycotide import config
from glycotide.functions.columns import micros, minutes
from glycotide.operators import segments
from glycotide.operators.ingest import gap_counts

LONG_GAP, IRREGULAR, REGULAR_CV = 1.5, 0.2, 0.1


def _by_unit(limits: dict[str, float]) -> Column:
    return F.when(F.col("unit") == "mmol/L", limits["mmol/L"]).otherwise(limits["mg/dL"])


def coverage(samples: DataFrame, *keys: str, order: str = "pos", widths: Sequence[float] = segments.PLACES) -> DataFrame:
    """Span, expected and missing intervals, coverage percentage and long gaps, over the order of the document.

    An interval of 0 gives nulls. A series of one sample has no intervals and a coverage of 0.
    """
    key_cols = list(keys)
    iv = F.col("iv")
    span = minutes(F.col("last") - F.col("first"))
    expected = F.greatest(F.rint(span / F.nullif(iv, F.lit(0.0))).cast("long"), F.col("n") - 1)
    at = micros("ts")
    whole = samples.groupBy(*key_cols).agg(F.count("*").alias("n"), F.first("sampling_interval_minutes").alias("iv"), F.min_by(at, order).alias("first"), F.max_by(at, order).alias("last"))
    counts = gap_counts(samples, *keys, at=at, order=order, widths=widths).withColumnRenamed("n", "_times")
    long = counts.join(whole.select(*key_cols, "iv"), key_cols).filter(F.col("gap") > LONG_GAP * iv).groupBy(*key_cols).agg(F.sum("_times").alias("large_gaps"))
    out = whole.join(long, key_cols, "left").withColumns({"expected_intervals": expected, "actual_intervals": F.col("n") - 1, "large_gaps": F.coalesce("large_gaps", F.lit(0))})
    return out.select(
        *key_cols, span.alias("total_duration_minutes"), "expected_intervals", "actual_intervals", F.greatest(F.col("expected_intervals") - F.col("actual_intervals"), F.lit(0)).alias("missing_intervals"),
        F.when(F.col("expected_intervals") > 0, F.col("actual_intervals") / F.col("expected_intervals") * 100.0).otherwise(0.0).alias("coverage_percentage"),
        (F.col("actual_intervals") * iv).alias("total_actual_minutes"), "large_gaps",
    )


def regularity(samples: DataFrame, *keys: str, order: str = "pos", widths: Sequence[float] = segments.PLACES) -> DataFrame:
    """Mean and spread of the gaps, how many differ from the mean by over a fifth, and whether the series is regular."""
    key_cols = list(keys)
    counts = gap_counts(samples, *keys, at=micros("ts"), order=order, widths=widths)
    n, gap, mean = F.col("n"), F.col("gap"), F.col("mean")
    stats = counts.groupBy(*key_cols).agg(F.sum("n").alias("gaps"), (F.sum(gap * n) / F.sum("n")).alias("mean"))
    spread = counts.join(stats, key_cols).groupBy(*key_cols).agg(
        F.first("gaps").alias("gaps"), F.first("mean").alias("mean"), F.sqrt(F.sum((gap - mean) * (gap - mean) * n) / F.sum("n")).alias("std"), F.sum(F.when(F.abs(gap - mean) > IRREGULAR * mean, n)).alias("irregular_intervals"))
    cv = F.when(F.col("mean") > 0, F.col("std") / F.col("mean")).otherwise(0.0)
    out = samples.select(*key_cols).distinct().join(spread, key_cols, "left")
    return out.select(
        *key_cols, F.coalesce("mean", F.lit(0.0)).alias("mean_interval_minutes"), F.coalesce("std", F.lit(0.0)).alias("std_interval_minutes"),
        F.coalesce(cv, F.lit(0.0)).alias("coefficient_of_variation"), F.coalesce("irregular_intervals", F.lit(0)).alias("irregular_intervals"), (F.col("gaps").isNull() | (cv < REGULAR_CV)).alias("is_regular"),
    )


def extremes(samples: DataFrame, *keys: str) -> DataFrame:
    """Smallest, largest, mean and median value; values strictly beyond the unit's limits, counted and in percent."""
    v, n = F.col("glucose_value"), F.count("*")
    low, high = F.count_if(v < _by_unit(config.EXTREME_LOW)), F.count_if(v > _by_unit(config.EXTREME_HIGH))
    counts = samples.filter(v.isNotNull()).groupBy(*keys, v.alias("value")).agg(n.alias("n"))
    middle = segments.quantile(counts, keys, "value", "n", out="median_glucose").drop("least", "most")
    whole = samples.groupBy(*keys).agg(
        F.min(v).alias("min_glucose"), F.max(v).alias("max_glucose"), F.avg(v).alias("mean_glucose"),
        low.alias("extreme_low_count"), high.alias("extreme_high_count"), (low / n * 100.0).alias("extreme_low_percentage"), (high / n * 100.0).alias("extreme_high_percentage"),
    )
    return whole.join(middle, list(keys), "left")


def suspicious(samples: DataFrame, *keys: str, order: str = "pos", widths: Sequence[float] = segments.PLACES) -> DataFrame:
    """Keys, order column, kind (drop or spike), value, change_in, change_out of each sudden change that comes half back."""
    limit, v = _by_unit(config.SUSPICIOUS), F.col("glucose_value")
    near = segments.with_neighbours(samples.select(*keys, order, "unit", "glucose_value"), keys, order, {"_before": ("glucose_value", 1), "_after": ("glucose_value", -1)}, widths)
    rows = near.withColumns({"change_in": v - F.col("_before"), "change_out": F.col("_after") - v})
    into, out = F.col("change_in"), F.col("change_out")
    kind = F.when((into < -limit) & (out > 0.5 * limit), "drop").when((into > limit) & (out < -0.5 * limit), "spike")
    return rows.withColumn("kind", kind).filter("kind is not null").select(*keys, order, "kind", v.alias("value"), "change_in", "change_out")


def flag_counts(samples: DataFrame, *keys: str) -> DataFrame:
    """keys, flagged_samples, flagged_percentage, flag_breakdown (a map from flag to count)."""
    key_cols = list(keys)
    flagged = F.count_if(F.coalesce(F.size("quality_flags"), F.lit(0)) > 0)
    whole = samples.groupBy(*key_cols).agg(flagged.alias("flagged_samples"), (flagged / F.count("*") * 100.0).alias("flagged_percentage"))
    each = samples.select(*key_cols, F.explode("quality_flags").alias("flag")).groupBy(*key_cols, "flag").agg(F.count("*").alias("n"))
    maps = each.groupBy(*key_cols).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("flag", "n")))).alias("flag_breakdown"))
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<bigint>"))
    return whole.join(maps, key_cols, "left").withColumn("flag_breakdown", F.coalesce("flag_breakdown", empty))


def report(samples: DataFrame, *keys: str, order: str = "pos", widths: Sequence[float] = segments.PLACES) -> DataFrame:
    """One row per series with all aggregates as structs, and the assessment's ``issues``."""
    key_cols = list(keys)
    meta = samples.groupBy(*key_cols).agg(
        F.count("*").alias("total_samples"), F.first("unit").alias("unit"), F.first("sampling_interval_minutes").alias("sampling_interval_minutes"),
        F.min_by("ts_raw", order).alias("start_time"), F.max_by("ts_raw", order).alias("end_time"),
    )
    changes = suspicious(samples, *keys, order=order, widths=widths)
    parts = {"coverage": coverage(samples, *keys, order=order, widths=widths), "regularity": regularity(samples, *keys, order=order, widths=widths), "extremes": extremes(samples, *keys), "flags": flag_counts(samples, *keys)}
    out = meta
    for name, part in parts.items():
        out = out.join(part.select(*key_cols, F.struct(*[c for c in part.columns if c not in key_cols]).alias(name)), key_cols)
    listed = changes.groupBy(*key_cols).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("pos"), "kind", "value", "change_in", "change_out"))).alias("suspicious"))
    none = F.array().cast(listed.schema["suspicious"].dataType)
    out = out.join(listed, key_cols, "left").withColumn("suspicious", F.coalesce("suspicious", none))
    return out.withColumn("issues", assessment(F.size("suspicious")))


def assessment(n_suspicious: Column) -> Column:
    """The issues of a report row: each rule's text, in a fixed order; an empty array if there are none."""
    rules = [
        (F.col("coverage.coverage_percentage") < 80, F.format_string("Low coverage (%.1f%%)", F.col("coverage.coverage_percentage"))),
        (~F.col("regularity.is_regular"), F.lit("Irregular sampling")),
        (F.col("extremes.extreme_low_percentage") > 5, F.format_string("High extreme low values (%.1f%%)", F.col("extremes.extreme_low_percentage"))),
        (F.col("extremes.extreme_high_percentage") > 5, F.format_string("High extreme high values (%.1f%%)", F.col("extremes.extreme_high_percentage"))),
        (n_suspicious > F.col("total_samples") * 0.02, F.format_string("Many suspicious changes (%d)", n_suspicious)),
    ]
    return F.array_compact(F.array(*[F.when(c, text) for c, text in rules]))
