"""Spark schemas of the documents and of the flat tables."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _L = T.StringType(), T.DoubleType(), T.LongType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


COMPONENT = _struct(name=_S, value=_D, unit=_S)
SAMPLE = _struct(timestamp=_S, glucose_value=_D, sample_index=_L, quality_flags=T.ArrayType(_S))
EVENT = _struct(
    event_id=_S, event_type=_S, start_time=_S, end_time=_S, duration_minutes=_D, exposure_components=T.ArrayType(COMPONENT),
    source=_S, annotation_quality=_D, label=_S, notes=_S,
)
WINDOW = _struct(relative_to=_S, start_offset_minutes=_D, end_offset_minutes=_D)

SERIES_DOC = _struct(
    schema_version=_S, series_id=_S, subject_id=_S, device_id=_S, sensor_id=_S, time_zone=_S, unit=_S,
    sampling_interval_minutes=_D, samples=T.ArrayType(SAMPLE), notes=_S,
)
EVENTS_DOC = _struct(schema_version=_S, events_id=_S, subject_id=_S, time_zone=_S, events=T.ArrayType(EVENT), notes=_S)
#: A metric's window is one WINDOW or a bundle of named ones; a reader gets the fields of both.
METRIC_DOC_WINDOW = T.StructType(
    WINDOW.fields + [T.StructField(k, WINDOW) for k in ("baseline_window", "peak_window", "auc_window", "recovery_window")]
)
QUALITY_SUMMARY = _struct(
    sample_count=_L, window_samples=_L, expected_samples=_L, coverage_percentage=_D, peak_glucose=_D, baseline_glucose=_D, nadir_time=_S,
    peak_time=_S, recovery_start=_D, recovery_end=_D, return_toward_baseline_percentage=_D, peak_window_samples=_L,
    peak_expected_samples=_L, recovery_window_samples=_L, recovery_expected_samples=_L, peak_coverage_percentage=_D,
    recovery_coverage_percentage=_D,
)
METRIC = _struct(
    event_id=_S, metric_name=_S, metric_version=_S, window=METRIC_DOC_WINDOW, value=_D, unit=_S, computed_at=_S, method=_S,
    quality_flags=T.ArrayType(_S), coverage_ratio=_D, quality_summary=QUALITY_SUMMARY,
)
METRICS_DOC = _struct(metric_set_id=_S, subject_id=_S, time_zone=_S, series_id=_S, generated_at=_S, metrics=T.ArrayType(METRIC), warnings=T.MapType(_S, _S))
