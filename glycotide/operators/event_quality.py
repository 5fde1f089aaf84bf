"""How far events can be used: overlap with readings, isolation from other events, baseline before them, a score.

Events have event_id, the key columns, ``start_us``, ``end_us`` (null: none), ``label`` and ``interval``; samples have the
key columns and ``at_us``. An event is known by its id and keys: one id may stand for an event of each of several series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from glycotide.config import QualityConfig
from glycotide.functions.columns import MICROS_PER_MINUTE, minutes
from glycotide.operators import segments
from glycotide.operators.range_join import longest_of, overlapping_intervals, points_in_intervals

# The texts of issues and recommendations in this module are part of the results.
OVERLAP_GAP, BASELINE_GAP, BASELINE_MAX_GAP, GAP_SHARE, NEAR = 1.5, 2.0, 5.0, 0.2, 30.0
NO_DATA, NO_OVERLAP = "No CGM data available", "No CGM overlap"


def _us(mins: float) -> int:
    return int(mins * MICROS_PER_MINUTE)


def _end(config: QualityConfig) -> Column:
    return F.coalesce("end_us", F.col("start_us") + F.lit(_us(config.default_duration_minutes)))


def _issues(*rules: tuple[Column, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(c, t) for c, t in rules]))


def sample_checks(events: DataFrame, samples: DataFrame, *keys: str, config: QualityConfig = QualityConfig(), width_minutes: float = 60.0, longest_minutes: float | None = None) -> DataFrame:
    """One row per event: samples, gaps and coverage during it (``during_*``) and in the baseline before it (``base_*``).

    During: [start, end], gaps over 1.5 intervals, coverage capped at 1. Baseline: [start - 60, start), gaps over 2
    intervals, coverage not capped. Gaps are between samples that follow each other inside the window. ``has_data``
    tells whether the event's series has any sample. ``longest_minutes``: what no event is longer than, if that is known.
    """
    ev = events.select("event_id", *keys, "start_us", _end(config).alias("stop_us"), "interval")
    lo, hi = F.col("start_us") - F.lit(_us(config.min_baseline_minutes)), F.col("stop_us")
    longest = (longest_event(ev) if longest_minutes is None else longest_minutes) + config.min_baseline_minutes
    near = points_in_intervals(ev, samples.select(*keys, "at_us"), keys, lo, hi, "at_us", width_minutes=width_minutes, longest_minutes=longest)
    w = W.partitionBy("event_id", *keys).orderBy("at_us")
    near = near.withColumn("_before", F.lag("at_us").over(w))
    gap = minutes(F.col("at_us") - F.col("_before"))
    during, base = F.col("at_us") >= F.col("start_us"), F.col("at_us") < F.col("start_us")
    gap_during = F.when(during & (F.col("_before") >= F.col("start_us")), gap)
    gap_base = F.when(base, gap)
    span = lambda g: F.struct(F.col("_before").alias("start_us"), F.col("at_us").alias("end_us"), F.bround(g, 2).alias("duration_minutes"))
    long_during, long_base = gap_during > F.col("interval") * OVERLAP_GAP, gap_base > F.col("interval") * BASELINE_GAP
    found = near.groupBy("event_id", *keys).agg(
        F.count_if(during).alias("during_samples"), F.count_if(base).alias("base_samples"),
        F.sum(F.when(long_during, F.bround(gap_during, 2))).alias("during_gap_minutes"), F.array_sort(F.collect_list(F.when(long_during, span(gap_during)))).alias("during_gaps"),
        F.max(gap_base).alias("base_max_gap"), F.array_sort(F.collect_list(F.when(long_base, span(gap_base)))).alias("base_gaps"),
    )
    have = samples.select(*keys).distinct().withColumn("has_data", F.lit(True))
    out = ev.join(found, ["event_id", *keys], "left").join(have, list(keys), "left")
    zero = lambda c, t="double": F.coalesce(F.col(c), F.lit(0).cast(t)).alias(c)
    length = minutes(F.col("stop_us") - F.col("start_us"))
    step = F.nullif(F.col("interval"), F.lit(0.0))
    expected, expected_base = length / step + 1, F.lit(float(config.min_baseline_minutes)) / step
    empty = lambda c: F.coalesce(F.col(c), F.array().cast(found.schema[c].dataType)).alias(c)
    out = out.select(
        "event_id", *keys, "interval", F.coalesce("has_data", F.lit(False)).alias("has_data"), length.alias("length"), expected.alias("during_expected"), expected_base.alias("base_expected"),
        zero("during_samples", "long"), zero("base_samples", "long"), zero("during_gap_minutes"), zero("base_max_gap"), empty("during_gaps"), empty("base_gaps"),
    )
    return out.withColumns(
        {
            "during_coverage": F.when(F.col("during_expected") > 0, F.least(F.col("during_samples") / F.col("during_expected"), F.lit(1.0))).otherwise(0.0),
            "base_coverage": F.when(F.col("base_expected") > 0, F.col("base_samples") / F.col("base_expected")).otherwise(0.0),
        }
    )


def longest_event(ev: DataFrame) -> float:
    """Minutes; one job, whose result is one number."""
    return longest_of(ev, F.col("start_us"), F.col("stop_us")) / MICROS_PER_MINUTE


def overlap_of(config: QualityConfig = QualityConfig()) -> Column:
    """A row of ``sample_checks`` as what ``overlap`` says of its event."""
    cov, gap = F.col("during_coverage"), F.col("during_gap_minutes")
    issues = F.when(~F.col("has_data"), F.array(F.lit(NO_DATA))).otherwise(
        _issues((cov < config.min_during_coverage, F.format_string("Low CGM coverage during event: %.1f%%", cov * 100)), (gap > F.col("length") * GAP_SHARE, F.concat(F.lit("Large gaps during event: "), gap.cast("string"), F.lit(" minutes"))))
    )
    advice = (
        F.when(~F.col("has_data"), "Cannot analyze event without CGM data").when(cov < 0.5, "Insufficient CGM coverage. Consider event outside CGM recording period.")
        .when(cov < 0.8, "Low CGM coverage during event. Results may be unreliable.").when(F.size(issues) > 0, F.concat(F.lit("Address CGM coverage issues: "), F.array_join(issues, ", ")))
        .otherwise("CGM coverage during event is sufficient for analysis.")
    )
    return F.struct(
        (F.col("during_samples") > 0).alias("has_overlap"), F.bround(cov, 3).alias("coverage_fraction"), F.bround("during_expected", 1).alias("expected_samples"),
        F.col("during_samples").alias("actual_samples"), F.size("during_gaps").cast("long").alias("gap_count"), F.bround(gap, 2).alias("total_gap_minutes"), F.col("during_gaps").alias("gaps"), issues.alias("issues"), advice.alias("recommendation"),
    )


def overlap(checks: DataFrame, *keys: str, config: QualityConfig = QualityConfig()) -> DataFrame:
    """Coverage of each event by readings, with issues and a recommendation."""
    return checks.select("event_id", *keys, overlap_of(config).alias("o")).select("event_id", *keys, "o.*")


def baseline_of(config: QualityConfig = QualityConfig()) -> Column:
    """A row of ``sample_checks`` as what ``baseline`` says of its event."""
    cov, gap = F.col("base_coverage"), F.col("base_max_gap")
    issues = F.when(~F.col("has_data"), F.array(F.lit(NO_DATA))).otherwise(
        _issues(
            (cov < config.min_baseline_coverage, F.format_string(f"Insufficient baseline coverage: %.1f%% (need {config.min_baseline_coverage:.0%}%)", cov * 100)),
            (gap > F.col("interval") * BASELINE_MAX_GAP, F.format_string("Large gap in baseline: %.1f minutes", gap)),
        )
    )
    advice = (
        F.when(~F.col("has_data"), "Cannot establish baseline without CGM data").when(cov < 0.5, "Insufficient baseline data. Cannot establish pre-event glucose pattern.")
        .when(cov < 0.9, "Limited baseline coverage. Exercise caution in interpreting results.").when(F.size(issues) > 0, F.concat(F.lit("Improve baseline data quality: "), F.array_join(issues, ", ")))
        .otherwise("Pre-event baseline is sufficient for analysis.")
    )
    enough = F.col("has_data") & (cov >= config.min_baseline_coverage) & (F.size(issues) == 0)
    return F.struct(
        enough.alias("has_sufficient_baseline"), F.bround(cov, 3).alias("coverage_fraction"), F.bround("base_expected", 1).alias("expected_samples"), F.col("base_samples").alias("actual_samples"),
        F.size("base_gaps").cast("long").alias("gap_count"), F.bround(gap, 2).alias("max_gap_minutes"), F.col("base_gaps").alias("gaps"), issues.alias("issues"), advice.alias("recommendation"),
    )


def baseline(checks: DataFrame, *keys: str, config: QualityConfig = QualityConfig()) -> DataFrame:
    """Readings before each event, with issues and a recommendation; sufficient: covered to nine tenths and no issue."""
    return checks.select("event_id", *keys, baseline_of(config).alias("b")).select("event_id", *keys, "b.*")


def _nearest(ev: DataFrame, key_cols: list[str], widths: Sequence[float] = segments.TIMES) -> DataFrame:
    """event_id, keys, before_us (latest end of another event up to the start), after_us (earliest start from the end on).

    As-of joins by days: within a day a running maximum of ends (minimum of starts, backwards), and for a day the last end
    before it (the first start after it), carried over days without any. No pairs are made and no task holds a key's events.
    """
    ends = F.explode(F.array(F.struct(F.col("start_us").alias("at"), F.lit(True).alias("starts")), F.struct(F.col("stop_us").alias("at"), F.lit(False).alias("starts"))))
    points = ev.select(*key_cols, "event_id", ends.alias("p")).select(*key_cols, "event_id", "p.*").withColumn("_day", segments.piece(F.col("at"), widths[0]))
    stop, start = F.when(~F.col("starts"), F.col("at")), F.when(F.col("starts"), F.col("at"))
    days = points.groupBy(*key_cols, "_day").agg(F.max(stop).alias("_stop"), F.min(start).alias("_start"))
    rest = [w // widths[0] for w in widths[1:]]
    days = segments.carried(days, key_cols, "_day", "_stop", rest, F.max, False, "_stop_before")
    days = segments.carried(days, key_cols, "_day", "_start", rest, F.min, True, "_start_behind").drop("_stop", "_start")
    along = lambda *by: W.partitionBy(*key_cols, "_day").orderBy(*by).rowsBetween(W.unboundedPreceding, W.currentRow)
    inside = points.withColumns({"_before": F.max(stop).over(along("at", "starts")), "_behind": F.min(start).over(along(F.desc("at"), F.desc("starts")))})
    found = inside.join(days, [*key_cols, "_day"])
    before, after = F.when(F.col("starts"), F.coalesce("_before", "_stop_before")), F.when(~F.col("starts"), F.coalesce("_behind", "_start_behind"))
    return found.groupBy("event_id", *key_cols).agg(F.max(before).alias("before_us"), F.max(after).alias("after_us"))


def _hundredths(x: Column) -> Column:
    """``x``, not negative, rounded to two digits by its hundredths as they come out in binary, as DuckDB rounds."""
    return F.round(x * 100) / 100


def isolation(events: DataFrame, *keys: str, config: QualityConfig = QualityConfig(), longest_minutes: float | None = None) -> DataFrame:
    """Overlapping events and the gaps to the nearest ones that end before or start after; touching counts as overlap.

    ``nearest_event_gap_minutes`` is null for 0 (not for what rounds to 0), the other two gaps are not.
    """
    key_cols = list(keys)
    ev = events.select("event_id", *key_cols, "label", "start_us", _end(config).alias("stop_us")).dropDuplicates(["event_id", *key_cols])
    other = ev.select(*key_cols, F.col("event_id").alias("other_id"), F.coalesce("label", F.lit("Unlabeled event")).alias("other_label"), F.col("start_us").alias("other_start"), F.col("stop_us").alias("other_stop"))
    pairs = overlapping_intervals(ev, other, key_cols, (F.col("start_us"), F.col("stop_us")), (F.col("other_start"), F.col("other_stop")), longest_minutes=longest_event(ev) if longest_minutes is None else longest_minutes).filter("event_id <> other_id")
    one = F.struct(F.col("other_id").alias("event_id"), F.col("other_label").alias("label"), F.greatest("start_us", "other_start").alias("overlap_start_us"), F.least("stop_us", "other_stop").alias("overlap_end_us"))
    overlaps = pairs.groupBy("event_id", *key_cols).agg(F.array_sort(F.collect_list(one)).alias("overlapping_events"))
    out = ev.join(_nearest(ev, key_cols), ["event_id", *key_cols], "left").join(overlaps, ["event_id", *key_cols], "left")
    none = F.array().cast(overlaps.schema["overlapping_events"].dataType)
    out = out.withColumns({"overlapping_events": F.coalesce("overlapping_events", none), "before": minutes(F.col("start_us") - F.col("before_us")), "after": minutes(F.col("after_us") - F.col("stop_us"))})
    nearest, n = F.col("nearest"), F.size("overlapping_events")
    out = out.withColumn("nearest", F.least("before", "after"))
    issues = _issues((n > 0, F.format_string("Overlaps with %d other event(s)", n)), (nearest < config.min_isolation_minutes, F.concat(F.lit("Close to other events: "), nearest.cast("string"), F.lit(" minutes"))))
    advice = (
        F.when(n > 0, "Event overlaps with other events. Consider excluding from analysis.")
        .when(nearest < NEAR, F.format_string("Event is close to other events (%.0f min). Check for confounding effects.", F.rint(nearest))).otherwise("Event is well-isolated for analysis.")
    )
    return out.select(
        "event_id", *key_cols, (n == 0).alias("is_isolated"), "overlapping_events", _hundredths(F.nullif(nearest, F.lit(0.0))).alias("nearest_event_gap_minutes"),
        _hundredths(F.col("before")).alias("min_before_gap"), _hundredths(F.col("after")).alias("min_after_gap"), issues.alias("issues"), advice.alias("recommendation"),
    )


def score(events: DataFrame, samples: DataFrame, sample_keys: tuple[str, ...], event_keys: tuple[str, ...], config: QualityConfig = QualityConfig()) -> DataFrame:
    """One row per event: quality_score, is_usable_for_analysis, quality_issues, recommendations and the three analyses.

    Isolation counts only where events overlap, the baseline only where it isn't sufficient. Each issue takes a fifth;
    no readings at all, or none during the event, takes everything. From 0.6 on an event is usable.
    """
    longest = longest_event(events.select("start_us", _end(config).alias("stop_us")))
    checks = sample_checks(events, samples, *sample_keys, config=config, longest_minutes=longest)
    apart = isolation(events, *event_keys, config=config, longest_minutes=longest)
    apart = apart.select("event_id", *event_keys, F.struct(*[c for c in apart.columns if c not in ("event_id", *event_keys)]).alias("isolation"))
    out = events.select("event_id", *dict.fromkeys([*sample_keys, *event_keys]), F.coalesce("label", F.lit("Unlabeled event")).alias("label"))
    # one range join: what it found is carried through in columns
    found = checks.select("event_id", *sample_keys, "has_data", overlap_of(config).alias("overlap"), baseline_of(config).alias("baseline"))
    out = out.join(found, ["event_id", *sample_keys]).join(apart, ["event_id", *event_keys])
    none = F.array().cast("array<string>")
    seen = F.when(~F.col("has_data"), F.array(F.lit(NO_DATA))).when(~F.col("overlap.has_overlap"), F.array(F.lit(NO_OVERLAP))).otherwise(F.col("overlap.issues"))
    crowded = F.when(~F.col("isolation.is_isolated"), F.col("isolation.issues")).otherwise(none)
    before = F.when(F.col("has_data") & ~F.col("baseline.has_sufficient_baseline"), F.col("baseline.issues")).otherwise(none)
    out = out.withColumn("quality_issues", F.concat(seen, crowded, before))
    critical = F.arrays_overlap("quality_issues", F.array(F.lit(NO_DATA), F.lit(NO_OVERLAP)))
    value = F.when(critical, 0.0).otherwise(F.greatest(F.lit(0.0), 1.0 - F.size("quality_issues") * 0.2))
    keys = list(dict.fromkeys([*sample_keys, *event_keys]))
    return out.select(
        "event_id", *keys, "label", F.bround(value, 2).alias("quality_score"), (value >= 0.6).alias("is_usable_for_analysis"), "quality_issues",
        F.array("overlap.recommendation", "isolation.recommendation", "baseline.recommendation").alias("recommendations"), "overlap", "isolation", "baseline",
    )


def rollup(scores: DataFrame, *keys: str) -> DataFrame:
    """Per key (none: one row, of zeros for no events): totals, usable share, counts of high, medium and low scores, summary."""
    s = F.col("quality_score")
    out = scores.groupBy(*keys).agg(
        F.count("*").alias("total_events"), F.count_if("is_usable_for_analysis").alias("usable_events"), F.count_if(s >= 0.8).alias("high_quality"), F.count_if((s >= 0.6) & (s < 0.8)).alias("medium_quality"), F.count_if(s < 0.6).alias("low_quality"),
    )
    total, usable = F.col("total_events"), F.col("usable_events")
    text = F.when(total == 0, "No events to evaluate").otherwise(F.concat(usable.cast("string"), F.lit("/"), total.cast("string"), F.lit(" events are suitable for causal analysis")))
    return out.withColumns({"usability_fraction": F.when(total == 0, 0.0).otherwise(F.bround(usable / total, 2)), "summary": text})
