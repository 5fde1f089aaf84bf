"""Metrics of the readings around each event: one bucketed range join, one sort per event, one wide aggregate.

Events have event_id, the key columns (series_id), ``start_us`` (microseconds), ``unit`` and ``interval`` (minutes);
samples have the key columns, ``at_us``, ``pos``, ``value``, ``flagged`` (an artifact or sensor error) and ``ts_raw``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glycotide.config import DEFAULT_INTERVAL, MetricWindows, Window
from glycotide.functions.columns import MICROS_PER_MINUTE, flags_of, micros
from glycotide.operators.range_join import points_in_intervals

VERSION = "1.0.0"
LOW_COVERAGE, FULL_COVERAGE, LOW_PERCENTAGE = 0.7, 1.0, 70.0
METRICS = ("baseline_glucose", "delta_peak", "iAUC", "time_to_peak", "nadir_glucose", "recovery_slope")
#: The windows that a metric and its summary are made of.
PARTS = {
    "baseline_glucose": ("baseline",), "delta_peak": ("baseline", "peak"), "iAUC": ("baseline", "auc"), "time_to_peak": ("time_to_peak",), "nadir_glucose": ("nadir",),
    "recovery_slope": ("baseline", "peak", "recovery"),
}


def metric_events(events: DataFrame, series: DataFrame | None = None, *keys: str) -> DataFrame:
    """Flat annotations as this module's events; unit and interval come from ``series`` by ``keys`` (5 minutes if unknown)."""
    rows = events.withColumn("start_us", micros("start_time"))
    if series is not None:
        header = series.select(*keys, "unit", F.col("sampling_interval_minutes").alias("interval"))
        rows = rows.drop("unit", "interval").join(header, list(keys), "left")
    return rows.withColumn("interval", F.coalesce("interval", F.lit(DEFAULT_INTERVAL)))


def metric_samples(samples: DataFrame, *keys: str) -> DataFrame:
    """Flat samples as this module's samples."""
    bad = F.array(F.lit("artifact"), F.lit("sensor_error"))
    return samples.select(
        *keys, micros("ts").alias("at_us"), "pos", F.col("glucose_value").alias("value"), F.coalesce(F.arrays_overlap("quality_flags", bad), F.lit(False)).alias("flagged"), "ts_raw"
    )


def _expected(w: Window) -> Column:
    """Samples that a window has at the interval, both ends counted; null for an interval of 0."""
    return F.greatest((F.lit(float(w.end - w.start)) / F.nullif(F.col("interval"), F.lit(0.0))).cast("int") + 1, F.lit(0))


def _coverage(n: str, w: Window) -> Column:
    expected = _expected(w)
    return F.when(expected == 0, 1.0).otherwise(F.least(F.col(n) / expected, F.lit(1.0)))


def _flags(coverage: str, flagged: str) -> Column:
    return flags_of(("interpolated", F.col(flagged)), ("low_coverage", F.col(coverage) < LOW_COVERAGE), ("missing_data", F.col(coverage) < FULL_COVERAGE))


def _within(w: Window) -> Column:
    return F.col("offset").between(F.lit(float(w.start)), F.lit(float(w.end)))


def _wanted(names: Sequence[str]) -> list[str]:
    """The windows of the metrics ``names``."""
    if unknown := set(names) - set(METRICS):
        raise ValueError(f"no metrics: {', '.join(sorted(unknown))}")
    return list(dict.fromkeys(part for n in METRICS if n in names for part in PARTS[n]))


def window_aggregates(events: DataFrame, samples: DataFrame, *keys: str, windows: MetricWindows | None = None, width_minutes: float = 30.0, names: Sequence[str] = METRICS) -> DataFrame:
    """One row per event that has a sample in any window: counts, coverages, flags and values of the metrics ``names``.

    A window starts and ends relative to the event's start and has both its ends. First peaks and nadirs are those of
    the smallest ``pos``. The area is of trapezoids over values above the baseline, cut off at the samples. Slopes are
    least-squares. What cannot be derived is null. Only samples in the windows of ``names`` are joined, and only the area
    needs its event's samples in order.
    """
    w, parts = windows or MetricWindows(), _wanted(names)
    low, high = min(getattr(w, p).start for p in parts), max(getattr(w, p).end for p in parts)
    carried = ["event_id", "unit", "interval", "start_us"]
    lo, hi = (F.col("start_us") + F.lit(int(m * MICROS_PER_MINUTE)) for m in (low, high))
    near = points_in_intervals(events.select(*keys, *carried), samples.select(*keys, "at_us", "pos", "value", "flagged", "ts_raw"), keys, lo, hi, "at_us", width_minutes=width_minutes, longest_minutes=high - low)
    near = near.withColumn("offset", (F.col("at_us") - F.col("start_us")) / F.lit(float(MICROS_PER_MINUTE)))
    event = ["event_id", *keys]
    v = F.col("value")
    base = F.avg(F.when(_within(w.baseline), v))
    if "auc" in parts:
        whole, ordered = W.partitionBy(*event), W.partitionBy(*event).orderBy("pos")
        near = near.withColumn("base", base.over(whole))
        # windows are intervals of an ordered series: a sample's neighbour in the auc window is the one before it there
        near = near.withColumn("_auc", _within(w.auc)).withColumn("_above", F.when(F.col("_auc"), F.greatest(v - F.col("base"), F.lit(0.0))))
        near = near.withColumns({"_above_before": F.lag("_above").over(ordered), "_offset_before": F.lag("offset").over(ordered)})
        base = F.first("base")

    def counted(name: str, window: Window) -> list[Column]:
        return [F.count_if(_within(window)).alias(f"n_{name}"), F.coalesce(F.bool_or(F.when(_within(window), F.col("flagged"))), F.lit(False)).alias(f"flagged_{name}")]

    def first_peak(window: Window, name: str) -> list[Column]:
        inside = _within(window)
        at = F.min_by(F.when(inside, F.struct("offset", "ts_raw", "at_us")), F.when(inside, F.struct((-v).alias("v"), "pos")))
        return [F.max(F.when(inside, v)).alias(f"{name}_value"), at.alias(f"{name}_at")]

    inside = _within(w.recovery)
    y, x = F.when(inside, v), F.when(inside, F.col("offset"))
    area = (F.col("_above") + F.col("_above_before")) / 2 * (F.col("offset") - F.col("_offset_before"))
    values = {
        "baseline": lambda: [base.alias("baseline_value")],
        "peak": lambda: first_peak(w.peak, "peak"),
        "auc": lambda: [F.sum(area).alias("area")],
        "time_to_peak": lambda: first_peak(w.time_to_peak, "ttp"),
        "nadir": lambda: [F.min(F.when(_within(w.nadir), v)).alias("nadir_value"), F.min_by("ts_raw", F.when(_within(w.nadir), F.struct(v.alias("v"), "pos"))).alias("nadir_time")],
        "recovery": lambda: [F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.min(x).alias("fit_from"), F.max(x).alias("fit_to")],
    }
    aggs = []
    for part in parts:
        aggs += counted(part, getattr(w, part)) + values[part]()
    # what is the same for all rows of an event is grouped by: a text among the aggregates would have all rows sorted
    out = near.groupBy(*event, *carried[1:]).agg(*aggs)
    out = out.withColumns({f"cov_{n}": _coverage(f"n_{n}", getattr(w, n)) for n in parts})
    return out.withColumns({f"flags_{n}": _flags(f"cov_{n}", f"flagged_{n}") for n in parts})


def _percent(coverage: Column) -> Column:
    return F.bround(coverage * 100, 1)


def _window(w: Window) -> Column:
    return F.struct(F.lit(w.relative_to).alias("relative_to"), F.lit(float(w.start)).alias("start_offset_minutes"), F.lit(float(w.end)).alias("end_offset_minutes"))


def there(name: str) -> Column:
    """Whether a row of ``window_aggregates`` has the samples that a metric needs."""
    least = {"iAUC": {"auc": 2}, "recovery_slope": {"recovery": 2, "baseline": 0}}.get(name, {})
    return reduce(Column.__and__, [F.col(f"n_{p}") >= least.get(p, 1) for p in PARTS[name]])


def coverage_of(name: str) -> Column:
    if name == "recovery_slope":
        return (F.col("cov_peak") + F.col("cov_recovery")) / 2
    return F.col(f"cov_{PARTS[name][-1]}")


def metrics(events: DataFrame, samples: DataFrame, *keys: str, windows: MetricWindows | None = None, width_minutes: float = 30.0, names: Sequence[str] = METRICS) -> DataFrame:
    """The long table of metrics: one row per event and metric of ``names`` that can be derived, in the order of ``pos``.

    ``window`` is null where a metric has several, which ``window_bundle`` then names. Each metric stands alone: one that
    can't be derived has no row and takes none of the others with it.
    """
    w = windows or MetricWindows()
    wide = window_aggregates(events, samples, *keys, windows=w, width_minutes=width_minutes, names=names)
    text = {
        "baseline_glucose": f"Mean glucose from {w.baseline.start:g} to {w.baseline.end:g} minutes.",
        "delta_peak": f"Largest glucose from {w.peak.start:g} to {w.peak.end:g} minutes minus the baseline.",
        "iAUC": f"Trapezoid area above the baseline from {w.auc.start:g} to {w.auc.end:g} minutes, values below it cut off.",
        "time_to_peak": f"Minutes to the first largest glucose from {w.time_to_peak.start:g} to {w.time_to_peak.end:g} minutes.",
        "nadir_glucose": f"Smallest glucose from {w.nadir.start:g} to {w.nadir.end:g} minutes.",
        "recovery_slope": f"Least-squares slope from {w.recovery.start:g} to {w.recovery.end:g} minutes; below 0: falling.",
    }
    both = lambda *names: F.array_sort(F.array_distinct(F.concat(*[F.col(f"flags_{n}") for n in names])))
    bundle = lambda **ws: F.map_from_arrays(F.array(*map(F.lit, ws)), F.array(*map(_window, ws.values())))
    fit = lambda at: F.col("intercept") + F.col("slope") * F.col(at)
    peak, base = F.col("peak_value"), F.col("baseline_value")
    common = lambda n: {"window_samples": F.col(f"n_{n}"), "expected_samples": _expected(getattr(w, n)).cast("long"), "coverage_percentage": _percent(F.col(f"cov_{n}"))}
    # name: value, unit, single window, bundle, flags, summary
    kinds_of: dict[str, Callable[[], tuple]] = {
        "baseline_glucose": lambda: (base, F.col("unit"), w.baseline, None, F.col("flags_baseline"), common("baseline")),
        "delta_peak": lambda: (
            peak - base, F.col("unit"), None, bundle(baseline_window=w.baseline, peak_window=w.peak), both("baseline", "peak"),
            common("peak") | {"peak_glucose": peak, "baseline_glucose": base, "peak_time": F.col("peak_at.ts_raw")},
        ),
        "iAUC": lambda: (F.col("area"), F.concat("unit", F.lit(" * minutes")), None, bundle(baseline_window=w.baseline, auc_window=w.auc), both("baseline", "auc"), common("auc") | {"baseline_glucose": base}),
        "time_to_peak": lambda: (F.col("ttp_at.offset"), F.lit("minutes"), w.time_to_peak, None, F.col("flags_time_to_peak"), common("time_to_peak") | {"peak_glucose": F.col("ttp_value"), "peak_time": F.col("ttp_at.ts_raw")}),
        "nadir_glucose": lambda: (F.col("nadir_value"), F.col("unit"), w.nadir, None, F.col("flags_nadir"), common("nadir") | {"nadir_time": F.col("nadir_time")}),
        "recovery_slope": lambda: (
            F.col("slope"), F.concat("unit", F.lit(" per minute")), None, bundle(peak_window=w.peak, recovery_window=w.recovery), both("peak", "recovery"),
            {
                "peak_glucose": peak, "baseline_glucose": base, "recovery_start": fit("fit_from"), "recovery_end": fit("fit_to"),
                "return_toward_baseline_percentage": F.when(peak != base, (peak - fit("fit_to")) / (peak - base) * 100),
                "peak_window_samples": F.col("n_peak"), "peak_expected_samples": _expected(w.peak).cast("long"), "recovery_window_samples": F.col("n_recovery"), "recovery_expected_samples": _expected(w.recovery).cast("long"),
                "peak_coverage_percentage": _percent(F.col("cov_peak")), "recovery_coverage_percentage": _percent(F.col("cov_recovery")),
            },
        ),
    }
    kinds = {n: kinds_of[n]() for n in METRICS if n in names}
    summary_types = {
        "window_samples": "long", "expected_samples": "long", "coverage_percentage": "double", "peak_glucose": "double", "baseline_glucose": "double", "peak_time": "string", "nadir_time": "string",
        "recovery_start": "double", "recovery_end": "double", "return_toward_baseline_percentage": "double", "peak_window_samples": "long", "peak_expected_samples": "long",
        "recovery_window_samples": "long", "recovery_expected_samples": "long", "peak_coverage_percentage": "double", "recovery_coverage_percentage": "double",
    }
    window_type = "struct<relative_to:string,start_offset_minutes:double,end_offset_minutes:double>"
    # a row per metric is made of its place alone; each column then picks that metric's value, so what isn't asked for isn't computed
    asked = [(pos, name) for pos, name in enumerate(METRICS) if name in names]
    found = [F.when(there(name) & kinds[name][0].isNotNull() & coverage_of(name).isNotNull(), F.lit(pos)) for pos, name in asked]
    long = wide.withColumn("pos", F.explode(F.array_compact(F.array(*found)))) if len(found) > 1 else wide.withColumn("pos", found[0]).filter("pos is not null")

    def pick(of: Callable[[str], Column | None], kind: str) -> Column:
        out = F.lit(None).cast(kind)
        for pos, name in reversed(asked):
            if (value := of(name)) is not None:
                out = F.when(F.col("pos") == pos, value.cast(kind)).otherwise(out)
        return out

    single = lambda n: None if kinds[n][2] is None else _window(kinds[n][2])
    summary = F.struct(*[pick(lambda n, k=k: kinds[n][5].get(k), t).alias(k) for k, t in summary_types.items()])
    columns = {
        "metric_name": pick(F.lit, "string"), "metric_version": F.lit(VERSION), "window": pick(single, window_type), "window_bundle": pick(lambda n: kinds[n][3], f"map<string,{window_type}>"),
        "value": pick(lambda n: kinds[n][0], "double"), "unit": pick(lambda n: kinds[n][1], "string"), "method": pick(lambda n: F.lit(text[n]), "string"), "coverage_ratio": pick(coverage_of, "double"),
        "quality_flags": pick(lambda n: kinds[n][4], "array<string>"), "quality_summary": summary,
    }
    return long.select("event_id", *keys, "pos", *[c.alias(n) for n, c in columns.items()])


def interval_warnings(events: DataFrame, *keys: str) -> DataFrame:
    """event_id, keys, warning: events whose series' sampling interval is 0, for which no coverage can be said and no metric exists."""
    return events.filter(F.col("interval") == 0).select("event_id", *keys, F.lit("sampling interval is 0").alias("warning"))


def subject_mismatch(series: DataFrame, events: DataFrame) -> DataFrame:
    """Subjects of ``events`` that no series has: a warning, not an error."""
    return events.select("subject_id").distinct().join(series.select("subject_id").distinct(), "subject_id", "left_anti")


def low_coverage_count(table: DataFrame, *keys: str) -> DataFrame:
    """keys, low_coverage_metrics: metrics whose coverage percentage is under 70; those that state none count as full."""
    percent = F.coalesce("quality_summary.coverage_percentage", F.lit(100.0))
    return table.groupBy(*keys).agg(F.count_if(percent < LOW_PERCENTAGE).alias("low_coverage_metrics"))
