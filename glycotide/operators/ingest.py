"""From raw readings to clean, indexed and flagged series.

Raw readings have a series key, a local time and a value, all text or typed. Clean readings have ``local_time``
(timestamp without zone) and ``glucose_value``; ``pos`` is the row's place in its series.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glycotide import config
from glycotide.functions.columns import flags_of, micros, minutes, wall_micros
from glycotide.operators import segments

SHORTEST_GAP, NEAR_MEDIAN = 0.001, 0.2


def clean_readings(raw: DataFrame, time_col: str, value_col: str, *, keep: tuple[str, ...] = (), strict: bool = True) -> DataFrame:
    """``keep`` columns, local_time, glucose_value: rows whose time and value are both there, values parsed as numbers.

    Text that is no number is a missing value and its row goes; text that is no time fails the job, as a column that
    isn't times is an error (not ``strict``: its row goes, and ``unusable_series`` tells). NaN counts as missing.
    """
    missing = [c for c in (time_col, value_col) if c not in raw.columns]
    if missing:
        raise ValueError(f"Missing required columns: {', '.join(missing)}")
    text = F.col(time_col).cast("string")
    parsed = F.expr(f"try_cast(`{time_col}` AS timestamp_ntz)")
    time = F.when(parsed.isNull() & text.isNotNull(), F.raise_error(F.concat(F.lit("not a timestamp: "), text)).cast("timestamp_ntz")).otherwise(parsed) if strict else parsed
    rows = raw.select(*keep, time.alias("local_time"), F.expr(f"try_cast(`{value_col}` AS double)").alias("glucose_value"))
    return rows.filter(F.col("local_time").isNotNull() & F.col("glucose_value").isNotNull() & ~F.isnan("glucose_value"))


def unusable_series(raw: DataFrame, time_col: str, value_col: str, *keys: str) -> DataFrame:
    """keys, p (nth, step, message) of series whose readings can't be imported: the first thing that is wrong, if any.

    read: ``problem`` of the source; parse: a time that is none (with the smallest such text), or no readings; duplicates:
    times that the series has more than once among readings that count. Readings are counted per time before they are
    counted per series, so a series of any length is spread over tasks.
    """
    text, time = F.col(time_col).cast("string"), F.expr(f"try_cast(`{time_col}` AS timestamp_ntz)")
    value = F.expr(f"try_cast(`{value_col}` AS double)")
    none = text.isNotNull() & time.isNull()
    counts = F.col("problem").isNull() & time.isNotNull() & value.isNotNull() & ~F.isnan(value)
    each = raw.select(*keys, "problem", time.alias("_time"), F.when(none, text).alias("_none"), counts.alias("_counts"))
    each = each.groupBy(*keys, "_time").agg(F.min("problem").alias("problem"), F.min("_none").alias("least"), F.count("_none").alias("none"), F.count_if("_counts").alias("n"))
    whole = each.groupBy(*keys).agg(F.min("problem").alias("problem"), F.min("least").alias("least"), F.sum("none").alias("none"), F.sum("n").alias("n"), F.sum(F.greatest(F.col("n") - 1, F.lit(0))).alias("extra"))
    said = lambda nth, step, message: F.struct(F.lit(nth).alias("nth"), F.lit(step).alias("step"), message.alias("message"))
    p = (
        F.when(F.col("problem").isNotNull(), said(0, "read", F.col("problem"))).when(F.col("none") > 0, said(1, "parse", F.format_string("not a timestamp: %s (%d in all)", "least", "none")))
        .when(F.col("n") == 0, said(1, "parse", F.lit("no readings"))).when(F.col("extra") > 0, said(2, "duplicates", F.format_string("found %d duplicate timestamps", "extra")))
    )
    return whole.select(*keys, p.alias("p")).filter("p is not null")


def dropped_readings(raw: DataFrame, value_col: str, *keys: str) -> DataFrame:
    """keys, not_numeric: how many values per key are there but are no number."""
    value = F.expr(f"try_cast(`{value_col}` AS double)")
    return raw.groupBy(*keys).agg(F.count_if(F.col(value_col).isNotNull() & (value.isNull() | F.isnan(value))).alias("not_numeric"))


def duplicate_timestamps(readings: DataFrame, *keys: str, time_col: str = "local_time") -> DataFrame:
    """keys, time, extra: times that a series has more than once, with the number of rows beyond the first."""
    return readings.groupBy(*keys, time_col).agg((F.count("*") - 1).alias("extra")).filter("extra > 0")


def require_unique_timestamps(readings: DataFrame, *keys: str, time_col: str = "local_time") -> DataFrame:
    """``readings`` itself; an error with the count if a series repeats a time. Runs one job whose result is one number."""
    extra = duplicate_timestamps(readings, *keys, time_col=time_col).agg(F.sum("extra")).first()[0]
    if extra:
        raise ValueError(f"found {extra} duplicate timestamps")
    return readings


def order_micros(rows: DataFrame, column: str) -> Column:
    """A time column as microseconds (a wall clock as if it were UTC); numbers as they are."""
    kind = rows.schema[column].dataType
    if isinstance(kind, T.TimestampNTZType):
        return wall_micros(F.col(column))
    return micros(column) if isinstance(kind, T.TimestampType) else F.col(column)


def indexed(readings: DataFrame, *keys: str, time_col: str = "local_time", widths: Sequence[float] = segments.TIMES) -> DataFrame:
    """With ``pos``: 0, 1, 2, ... in order of time within each series. Rows without a time or a key go."""
    return segments.numbered(readings, keys, time_col, "pos", widths, by=order_micros(readings, time_col))


def gap_counts(samples: DataFrame, *keys: str, at: Column, order: str = "pos", widths: Sequence[float] = segments.PLACES) -> DataFrame:
    """keys, gap (minutes since the sample before in the series), n: how often a series has a gap of that length."""
    each = segments.gaps(samples, keys, order, at, widths)
    return each.groupBy(*keys, "gap").agg(F.count("*").alias("n")).withColumn("gap", minutes(F.col("gap")))


def sampling_interval(samples: DataFrame, *keys: str, at: Column, order: str = "pos", widths: Sequence[float] = segments.PLACES) -> DataFrame:
    """keys, sampling_interval_minutes, issue, one row per series.

    The median gap, if all gaps are within a fifth of it; else the commonest gap in whole minutes (halves to even, ties
    to the smallest). The interval is null, and ``issue`` says why, for series of one row, gaps of no length, and gaps
    that differ although all round to the same minute. The interval can be 0 for very irregular series. All of it is
    read off one count of gaps by length.
    """
    key_cols = list(keys)
    counts = gap_counts(samples, *keys, at=at, order=order, widths=widths)
    stats = segments.quantile(counts, keys, "gap", "n", out="middle")
    rounded = counts.groupBy(*key_cols, F.rint("gap").alias("whole")).agg(F.sum("n").alias("times"))
    mode = rounded.groupBy(*key_cols).agg(F.min_by("whole", F.struct(-F.col("times"), F.col("whole"))).alias("mode"), F.count("*").alias("kinds"))
    every = samples.select(*key_cols).distinct()
    out = every.join(stats.join(mode, key_cols), key_cols, "left")
    off = lambda c: F.abs(F.col(c) - F.col("middle")) / F.nullif(F.col("middle"), F.lit(0.0)) < NEAR_MEDIAN
    even = off("least") & off("most")  # those between are no farther
    issue = (
        F.when(F.col("least").isNull(), "needs two samples").when(F.col("least") < SHORTEST_GAP, "duplicate or unordered timestamps")
        .when(~even & (F.col("kinds") < 2), "inconsistent sampling interval")
    )
    value = F.when(even, F.col("middle")).otherwise(F.col("mode"))
    return out.select(*key_cols, F.when(issue.isNull(), value).alias("sampling_interval_minutes"), issue.alias("issue"))


def artifact_flags(samples: DataFrame, *keys: str, unit: Column, interval: Column, order: str = "pos", value: str = "glucose_value", widths: Sequence[float] = segments.PLACES) -> DataFrame:
    """With ``quality_flags``: ``artifact`` for jumps that come back and for three equal values in a row; null for none.

    A jump is more than 3 mmol/L (54 mg/dL) per 5 minutes from the value before, with the value after within three
    tenths of the jump from the one before. Existing flags stay; flags are distinct and sorted.
    """
    limit = F.when(unit == "mmol/L", config.JUMP["mmol/L"]).otherwise(config.JUMP["mg/dL"]) * interval / F.lit(5.0)
    v, before, before2, after = F.col(value), F.col("_before"), F.col("_before2"), F.col("_after")
    jump = (F.abs(v - before) > limit) & (F.abs(after - before) < 0.3 * F.abs(v - before))
    flat = (v == before) & (before == before2)
    placed = segments.with_neighbours(samples, keys, order, {"_before": (value, 1), "_before2": (value, 2), "_after": (value, -1)}, widths)
    found = flags_of(("artifact", jump | flat))
    if "quality_flags" in samples.columns:
        found = F.array_sort(F.array_union(F.coalesce("quality_flags", F.array().cast("array<string>")), found))
    return placed.withColumn("quality_flags", F.when(F.size(found) > 0, found)).drop("_before", "_before2", "_after")


def localized(readings: DataFrame, time_zone: Column, local_col: str = "local_time", problem: str | None = None) -> DataFrame:
    """With ``ts`` (instant) and ``ts_raw`` (ISO with the zone's offset) of local times.

    Times that a zone skips, or has twice, when clocks change fail the job: which instant is meant isn't known. With
    ``problem``, a column of that name says so instead, and ``ts`` and ``ts_raw`` of the row are null. A
    zone's offset is read off the difference between the wall clock and UTC, so the session's zone plays no part.
    """
    local = F.col(local_col).cast("timestamp_ntz")
    utc = F.convert_timezone(time_zone, F.lit("UTC"), local)
    back = F.convert_timezone(F.lit("UTC"), time_zone, utc)
    hour = F.expr("INTERVAL '1' HOUR")
    twice = (F.convert_timezone(F.lit("UTC"), time_zone, utc + hour) == local) | (F.convert_timezone(F.lit("UTC"), time_zone, utc - hour) == local)
    bad = F.when(back != local, "skipped").when(twice, "ambiguous")
    said = F.when(bad.isNotNull(), F.concat(bad, F.lit(" local time: "), local.cast("string")))
    checked = F.when(bad.isNull(), utc) if problem else F.when(bad.isNotNull(), F.raise_error(said).cast("timestamp_ntz")).otherwise(utc)
    span = wall_micros(local) - wall_micros(F.col("_utc"))
    mins = F.abs(F.floor(span / 60_000_000)).cast("long")
    offset = F.format_string("%s%02d:%02d", F.when(span < 0, "-").otherwise("+"), F.floor(mins / 60).cast("long"), mins % 60)
    text = F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss")
    part = F.date_format(local, "SSSSSS")
    text = F.concat(text, F.when(part != "000000", F.concat(F.lit("."), part)).otherwise(F.lit("")), offset)
    out = readings.withColumn("_utc", checked)
    out = out.withColumns({"ts": F.timestamp_micros(wall_micros(F.col("_utc"))), "ts_raw": text} | ({problem: said} if problem else {}))
    return out.drop("_utc")


def series_ids(samples: DataFrame, *keys: str, subject: Column, device: Column, time_zone: Column, unit: Column) -> DataFrame:
    """keys, series_id: ``cgm_`` and 16 hex digits of the SHA-256 of the series' header and its samples in order.

    A digest has to see its series in order; it does so line by line in a sorted partition, so that no row holds a series.
    """
    line = F.concat(F.col("ts_raw"), F.lit(":"), F.format_string("%.6f", F.col("glucose_value")))
    head = F.concat_ws("_", subject, device, time_zone, unit, F.lit(""))
    lines = samples.select(*[F.col(k).alias(f"k{n}") for n, k in enumerate(keys)], "pos", head.alias("head"), line.alias("line"))
    names = [f"k{n}" for n in range(len(keys))]
    schema = T.StructType([*[T.StructField(f"k{n}", samples.schema[k].dataType) for n, k in enumerate(keys)], T.StructField("series_id", T.StringType())])

    def digests(batches):
        last, digest = None, None
        for batch in batches:
            done = []
            columns = [batch.column(n) for n in range(len(names))]
            same = [pc.fill_null(pc.equal(c.slice(1), c.slice(0, len(c) - 1)), False).to_numpy(zero_copy_only=False) for c in columns]
            starts = [0, *(np.flatnonzero(~np.logical_and.reduce(same)) + 1).tolist(), batch.num_rows] if batch.num_rows else [0]
            for a, b in zip(starts, starts[1:]):
                key = tuple(c[a].as_py() for c in columns)
                if digest is None or key != last:
                    if digest is not None:
                        done.append((*last, "cgm_" + digest.hexdigest()[:16]))
                    last, digest, joint = key, hashlib.sha256(batch.column(len(names) + 1)[a].as_py().encode()), ""
                digest.update((joint + ";".join(batch.column(len(names) + 2).slice(a, b - a).to_pylist())).encode())
                joint = ";"
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done), [*(c.type for c in columns), pa.string()])], names=[*names, "series_id"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((*last, "cgm_" + digest.hexdigest()[:16]), [*(c.type for c in columns), pa.string()])], names=[*names, "series_id"])

    return lines.repartition(*names).sortWithinPartitions(*names, "pos").mapInArrow(digests, schema).toDF(*keys, "series_id")


def device_id(stem: Column) -> Column:
    """The device in a file's stem: without a last part such as ``-2.21.00.00``."""
    return F.regexp_replace(stem, r"^(.+)-\d+(\.\d+)+$", "$1")


def violations(samples: DataFrame) -> DataFrame:
    """``samples`` rows that break the constraints of the document schema, with ``violations`` (names, sorted)."""
    zone = r"^[A-Za-z_]+(/[A-Za-z0-9_+-]+){1,2}$"
    known = F.array(*map(F.lit, ("missing", "interpolated", "sensor_error", "calibration", "artifact")))
    checks = {
        "series_id": ("not_a_series_id", ~F.col("series_id").rlike("^cgm_[0-9a-f]{16}$")),
        "subject_id": ("no_subject", F.col("subject_id").isNull() | (F.length("subject_id") == 0)),
        "device_id": ("no_device", F.col("device_id").isNull() | (F.length("device_id") == 0)),
        "time_zone": ("not_a_time_zone", F.col("time_zone").isNull() | ~F.col("time_zone").rlike(zone)),
        "unit": ("not_a_unit", F.col("unit").isNull() | ~F.col("unit").isin(*config.UNITS)),
        "sampling_interval_minutes": ("interval_not_positive", F.col("sampling_interval_minutes") <= 0),
        "ts_raw": ("not_an_instant", F.col("ts_raw").isNull() | ~F.col("ts_raw").rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?(Z|[+-]\d{2}:\d{2})$")),
        "glucose_value": ("negative_or_no_value", F.col("glucose_value").isNull() | F.isnan("glucose_value") | (F.col("glucose_value") < 0)),
        "pos": ("negative_index", F.col("pos") < 0),
        "quality_flags": ("flags_repeated_or_unknown", (F.size(F.array_distinct("quality_flags")) != F.size("quality_flags")) | (F.size(F.array_except("quality_flags", known)) > 0)),
    }
    found = flags_of(*[check for column, check in checks.items() if column in samples.columns])
    return samples.withColumn("violations", found).filter(F.size("violations") > 0)


def unordered_samples(samples: DataFrame, *keys: str, widths: Sequence[float] = segments.PLACES) -> DataFrame:
    """keys, unordered: samples per series whose instant isn't after the one before in document order."""
    late = segments.gaps(samples, keys, "pos", micros("ts"), widths).filter("gap <= 0").groupBy(*keys).agg(F.count("*").alias("unordered"))
    return samples.select(*keys).distinct().join(late, list(keys), "left").withColumn("unordered", F.coalesce("unordered", F.lit(0)))
