"""Red, yellow, green or gray per event: absolute limits and personal ones from the events before it.

The long table of metrics is turned into one row per event; events that can be judged are ordered in each series, and the
personal limits are percentiles over a frame of the rows before, so no history is kept by hand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glycotide.config import MGDL_PER_MMOL, NADIR_LIMIT_MMOL, PEAK_LIMIT_MMOL, SignalConfig
from glycotide.operators import metrics

REQUIRED = ("delta_peak", "iAUC", "nadir_glucose", "recovery_slope")
#: Metrics that are bad when high, in the order of their triggers; the nadir, bad when low, comes last.
HIGH, LOW = ("delta_peak", "iAUC", "recovery_slope"), "nadir_glucose"
# How messages name what they speak of.
LABELS = {"delta_peak": "ΔPeak", "iAUC": "iAUC_0-120", "nadir_glucose": "Nadir", "recovery_slope": "Recovery slope", "peak_glucose": "Peak glucose", "coverage_ratio": "Coverage"}
TRIGGER = "struct<metric:string,value:double,threshold:double,comparison:string,basis:string,severity:string,message:string>"


def _number(x: Column, unit: Column) -> Column:
    text = F.format_string("%.2f", F.bround(x, 2))
    return F.when(F.coalesce(F.length(unit), F.lit(0)) > 0, F.concat(text, F.lit(" "), unit)).otherwise(text)


def _percent(x: Column) -> Column:
    return F.format_string("%.0f%%", F.rint(x * 100))


def _trigger(metric: str, value: Column | None, threshold: Column | None, comparison: str, basis: str, severity: str, message: Column) -> Column:
    number = lambda x: (F.lit(None) if x is None else x).cast("double")
    return F.struct(
        F.lit(metric).alias("metric"), number(value).alias("value"), number(threshold).alias("threshold"), F.lit(comparison).alias("comparison"), F.lit(basis).alias("basis"), F.lit(severity).alias("severity"), message.alias("message")
    ).cast(TRIGGER)


def event_rows(events: DataFrame, table: DataFrame, *keys: str) -> DataFrame:
    """``events`` with value and coverage of each required metric and peak_glucose; of repeated metrics the last counts. Both have ``keys``."""
    last = lambda c: F.max_by(F.col(c), F.col("pos"))
    named = table.filter(F.col("metric_name").isin(*REQUIRED)).select("event_id", *keys, "metric_name", "pos", F.struct("value", "coverage_ratio", F.col("quality_summary.peak_glucose").alias("peak_glucose")).alias("metric"))
    wide = named.groupBy("event_id", *keys).pivot("metric_name", list(REQUIRED)).agg(last("metric"))
    out = events.join(wide, ["event_id", *keys], "left")
    columns = {f"v_{m}": F.col(f"{m}.value") for m in REQUIRED} | {f"has_{m}": F.col(m).isNotNull() for m in REQUIRED}
    columns |= {"peak_glucose": F.col("delta_peak.peak_glucose"), "coverage_ratio": F.least(*[F.col(f"{m}.coverage_ratio") for m in REQUIRED])}
    return out.withColumns(columns).drop(*REQUIRED)


def window_rows(events: DataFrame, wide: DataFrame, *keys: str) -> DataFrame:
    """What ``event_rows`` gives, from the row per event that ``metrics.window_aggregates`` of REQUIRED makes: no long table between."""
    value = {"delta_peak": F.col("peak_value") - F.col("baseline_value"), "iAUC": F.col("area"), "nadir_glucose": F.col("nadir_value"), "recovery_slope": F.col("slope")}
    found = {m: metrics.there(m) & value[m].isNotNull() & metrics.coverage_of(m).isNotNull() for m in REQUIRED}
    rows = wide.select(
        "event_id", *keys, *[F.when(found[m], value[m]).alias(f"v_{m}") for m in REQUIRED], *[found[m].alias(f"has_{m}") for m in REQUIRED],
        F.when(found["delta_peak"], F.col("peak_value")).alias("peak_glucose"), F.least(*[F.when(found[m], metrics.coverage_of(m)) for m in REQUIRED]).alias("coverage_ratio"),
    )
    return events.join(rows, ["event_id", *keys], "left").withColumns({f"has_{m}": F.coalesce(f"has_{m}", F.lit(False)) for m in REQUIRED})


def with_eligibility(rows: DataFrame, config: SignalConfig = SignalConfig()) -> DataFrame:
    """With ``missing`` (required metrics that aren't there) and ``eligible`` (none missing, coverage high enough)."""
    missing = F.array_compact(F.array(*[F.when(~F.col(f"has_{m}"), F.lit(m)) for m in REQUIRED]))
    enough = F.coalesce(F.col("coverage_ratio") >= config.coverage_soft, F.lit(False))
    return rows.withColumn("missing", missing).withColumn("eligible", (F.size("missing") == 0) & enough)


def personal_thresholds(eligible: DataFrame, *keys: str, config: SignalConfig = SignalConfig()) -> DataFrame:
    """``eligible`` events with p75 and p90 of the high metrics and p10 and p25 of the nadir.

    They are over the ``history_size`` eligible events before, by (start_us, pos) in each series, and null for fewer than
    ``min_history``. Percentiles are exact and interpolated.
    """
    w = Window.partitionBy(*keys).orderBy("start_us", "pos").rowsBetween(-config.history_size, -1)
    n = F.count(F.lit(1)).over(w)
    out = {}
    for metric, low, high in [(m, 0.75, 0.9) for m in HIGH] + [(LOW, 0.1, 0.25)]:
        for p in (low, high):
            out[f"p{round(p * 100)}_{metric}"] = F.when(n >= config.min_history, F.percentile(f"v_{metric}", F.lit(p)).over(w))
    return eligible.withColumns(out)


def _same(x: Column) -> Column:
    return x


def signals(rows: DataFrame, *keys: str, unit: Column, config: SignalConfig = SignalConfig(), compared=_same) -> DataFrame:
    """event_id, keys, status, coverage_ratio, triggers, metric_values of each row of ``event_rows``.

    Gray: a required metric is missing, or the coverage is too low or unknown; such events are no one's history. Red: a
    hard trigger; yellow: a soft one only. ``compared`` is applied to both sides of personal comparisons, which include
    equality.
    """
    judged = with_eligibility(rows, config)
    columns = [c for c in judged.columns if c != "eligible"]
    history = personal_thresholds(judged.filter("eligible"), *keys, config=config)
    added = [c for c in history.columns if c not in judged.columns]
    gray = judged.filter("not eligible").select(*columns, "eligible", *[F.lit(None).cast("double").alias(c) for c in added])
    every = history.select(*columns, "eligible", *added).unionByName(gray)

    coverage = F.col("coverage_ratio")
    gaps = [F.when(F.array_contains("missing", m), _trigger(m, None, None, "missing", "missing_metric", "soft", F.lit(f"missing metric: {LABELS[m]}"))) for m in REQUIRED]
    soft = F.lit(config.coverage_soft)
    low = F.concat(F.lit(f"{LABELS['coverage_ratio']}="), _percent(coverage), F.lit(" < "), _percent(soft), F.lit(" (soft)"))
    gaps.append(
        F.when(coverage.isNull(), _trigger("coverage_ratio", None, soft, "missing", "coverage_soft", "soft", F.lit("coverage unavailable"))).when(
            coverage < config.coverage_soft, _trigger("coverage_ratio", coverage, soft, "<", "coverage_soft", "soft", low)
        )
    )
    scale = F.when(unit == "mmol/L", 1.0).otherwise(MGDL_PER_MMOL)

    def said(metric: str, value: Column, sign: str, limit: Column, basis: str) -> Column:
        return F.concat(F.lit(f"{LABELS[metric]}="), _number(value, unit), F.lit(f" {sign} "), _number(limit, unit), F.lit(f" ({basis})"))

    hard, mild = [], []
    for metric, value, sign, limit in (("peak_glucose", F.col("peak_glucose"), ">", PEAK_LIMIT_MMOL * scale), (LOW, F.col(f"v_{LOW}"), "<", NADIR_LIMIT_MMOL * scale)):
        hit = value > limit if sign == ">" else value < limit
        hard.append(F.when(hit, _trigger(metric, value, limit, sign, "hard", "hard", said(metric, value, sign, limit, "hard"))))
    for metric, sign, strong, weak in [(m, ">", 90, 75) for m in HIGH] + [(LOW, "<", 10, 25)]:
        value = F.col(f"v_{metric}")
        reached = lambda p: compared(value) >= compared(p) if sign == ">" else compared(value) <= compared(p)  # noqa: E731, B023
        far, near = F.col(f"p{strong}_{metric}"), F.col(f"p{weak}_{metric}")
        hard.append(F.when(reached(far), _trigger(metric, value, far, sign, f"personal_p{strong}", "hard", said(metric, value, sign, far, f"personal P{strong}"))))
        mild.append(F.when(~F.coalesce(reached(far), F.lit(False)) & reached(near), _trigger(metric, value, near, sign, f"personal_p{weak}", "soft", said(metric, value, sign, near, f"personal P{weak}"))))
    every = every.withColumns({"_hard": F.array_compact(F.array(*hard)), "_mild": F.array_compact(F.array(*mild)), "_gaps": F.array_compact(F.array(*gaps))})
    status = F.when(~F.col("eligible"), "gray").when(F.size("_hard") > 0, "red").when(F.size("_mild") > 0, "yellow").otherwise("green")
    names = [*REQUIRED, "peak_glucose"]
    values = F.map_filter(F.map_from_arrays(F.array(*map(F.lit, names)), F.array(*[F.col(f"v_{m}") for m in REQUIRED], F.col("peak_glucose"))), lambda _, v: v.isNotNull())
    return every.select(
        "event_id", *keys, "start_us", "pos", status.alias("status"), "coverage_ratio",
        F.when(F.col("eligible"), F.concat("_hard", "_mild")).otherwise(F.col("_gaps")).alias("triggers"), values.alias("metric_values"),
    )
