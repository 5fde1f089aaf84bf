"""Joins of intervals with points and with intervals, on equal keys and equal nodes of time.

Without nodes Spark can only hash the key and compare all pairs of a series. A node is a time bucket, or FAN, FAN * FAN, ...
buckets that begin at a multiple of their number. An interval is the union of few of them (some 6 a level, so a hundred years
in half hours are 66), and a point lies in one node of each level; so pairs meet in small groups, and a series of any
length is dealt over as many tasks as it has nodes. Where no interval is longer than LEAST_NODES buckets there is one level only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glycotide.functions.columns import MICROS_PER_MINUTE

FAN, LEAST_NODES = 4, 32


def bucket(us: Column, width_minutes: float) -> Column:
    """The number of the time bucket of an instant in microseconds (also right before 1970)."""
    return F.floor(us / F.lit(int(width_minutes * MICROS_PER_MINUTE)))


def levels_of(longest_us: float | None, width_minutes: float) -> int:
    """How many levels of nodes intervals of up to that length need, so that the uppermost has LEAST_NODES of them at most."""
    units, levels = (longest_us or 0) / (width_minutes * MICROS_PER_MINUTE) + 1, 1
    while units > LEAST_NODES:
        units, levels = units / FAN, levels + 1
    return levels


def longest_of(intervals: DataFrame, lo: Column, hi: Column) -> int:
    """The length of the longest interval; one job, whose result is one number."""
    return intervals.agg(F.max(hi - lo)).head()[0] or 0


def cover(lo: Column, hi: Column, width: float, levels: int) -> Column:
    """The nodes (level, number) of an interval, as an array: those of a level that no node of the next one has in it."""
    first, end = bucket(lo, width), bucket(hi, width) + 1
    up = lambda c, n: F.ceil(c / F.lit(FAN**n))
    down = lambda c, n: F.floor(c / F.lit(FAN**n))
    nodes = lambda n, a, b: F.when(a < b, F.transform(F.sequence(a, b - 1), lambda x: F.struct(F.lit(n).alias("level"), x.alias("node")))).otherwise(F.array().cast("array<struct<level:int,node:bigint>>"))
    parts = []
    for n in range(levels):
        a, b = up(first, n), down(end, n)
        if n + 1 == levels:
            parts.append(nodes(n, a, b))
            continue
        over_a, over_b = up(first, n + 1) * FAN, down(end, n + 1) * FAN
        parts += [nodes(n, a, F.when(over_a < over_b, over_a).otherwise(b)), nodes(n, F.when(over_a < over_b, over_b).otherwise(b), b)]
    return F.when(hi >= lo, F.concat(*parts) if len(parts) > 1 else parts[0])


def _covered(intervals: DataFrame, lo: Column, hi: Column, width: float, levels: int) -> DataFrame:
    """``intervals`` with _lo, _hi and a row per node (_level, _node)."""
    rows = intervals.withColumns({"_lo": lo, "_hi": hi})
    if levels == 1:
        return rows.withColumn("_node", F.explode(F.when(F.col("_hi") >= F.col("_lo"), F.sequence(bucket(F.col("_lo"), width), bucket(F.col("_hi"), width)))))
    rows = rows.withColumn("_at_node", F.explode(cover(F.col("_lo"), F.col("_hi"), width, levels)))
    return rows.withColumns({"_level": F.col("_at_node.level"), "_node": F.col("_at_node.node")}).drop("_at_node")


def _probing(points: DataFrame, at: Column, width: float, levels: int) -> DataFrame:
    """``points`` with a row per level."""
    if levels == 1:
        return points.withColumn("_node", bucket(at, width))
    rows = points.withColumn("_base", bucket(at, width)).withColumn("_level", F.explode(F.array(*map(F.lit, range(levels)))))
    return rows.withColumn("_node", F.floor(F.col("_base") / F.pow(F.lit(float(FAN)), F.col("_level"))).cast("long")).drop("_base")


def _on(keys: Sequence[str], levels: int) -> list[str]:
    return [*keys, *(["_level"] if levels > 1 else []), "_node"]


def points_in_intervals(
    intervals: DataFrame,
    points: DataFrame,
    keys: Sequence[str],
    lo: Column,
    hi: Column,
    at: str,
    *,
    width_minutes: float = 30.0,
    closed: str = "both",
    longest_minutes: float | None = None,
) -> DataFrame:
    """All pairs with equal ``keys`` and lo <= point <= hi (closed="left": point < hi), each once.

    ``lo`` and ``hi`` are over ``intervals`` and ``at`` is a column of ``points``, in microseconds. The tables must not
    share columns other than the keys. Null keys, bounds and points match nothing; empty intervals match nothing.
    ``longest_minutes``: what no interval is longer than, if that is known; else a job finds it (longer ones would still
    be found, in more rows).
    """
    if closed not in ("both", "left"):
        raise ValueError("closed is 'both' or 'left'")
    shared = (set(intervals.columns) & set(points.columns)) - set(keys)
    if shared:
        raise ValueError(f"both tables have {', '.join(sorted(shared))}")
    levels = levels_of(longest_of(intervals, lo, hi) if longest_minutes is None else longest_minutes * MICROS_PER_MINUTE, width_minutes)
    upper = F.col(at) <= F.col("_hi") if closed == "both" else F.col(at) < F.col("_hi")
    # an interval's nodes don't overlap, so no pair is found twice
    pairs = _covered(intervals, lo, hi, width_minutes, levels).join(_probing(points, F.col(at), width_minutes, levels), _on(keys, levels))
    return pairs.filter((F.col(at) >= F.col("_lo")) & upper).drop("_lo", "_hi", "_level", "_node")


def overlapping_intervals(
    a: DataFrame,
    b: DataFrame,
    keys: Sequence[str],
    a_bounds: tuple[Column, Column],
    b_bounds: tuple[Column, Column],
    *,
    width_minutes: float = 60.0,
    semi_on: tuple[str, str] | None = None,
    longest_minutes: float | None = None,
) -> DataFrame:
    """Pairs of overlapping closed intervals (touching counts), each once: the later start lies in the other interval.

    So each of the two is taken as an interval, and the other one's start as a point, in turn. With ``semi_on`` = (id of a, id
    of b): the rows of ``a`` (without its helper columns, once each by id) that overlap any ``b`` of another id; the search
    of a row ends at its first match. ``longest_minutes`` as in ``points_in_intervals``, for both tables.
    """
    longest = max(longest_of(a, *a_bounds), longest_of(b, *b_bounds)) if longest_minutes is None else longest_minutes * MICROS_PER_MINUTE
    levels = levels_of(longest, width_minutes)
    left = a.withColumns({"_a_lo": a_bounds[0], "_a_hi": a_bounds[1]}).filter("_a_lo <= _a_hi")
    right = b.withColumns({"_b_lo": b_bounds[0], "_b_hi": b_bounds[1]}).filter("_b_lo <= _b_hi")
    if semi_on:
        right = right.select(*keys, "_b_lo", "_b_hi", F.col(semi_on[1]).alias("_b_id"))
    found = []
    for first in (left, right):  # the one that starts first
        is_a = first is left
        starts = _covered(first, F.col("_a_lo" if is_a else "_b_lo"), F.col("_a_hi" if is_a else "_b_hi"), width_minutes, levels)
        later = _probing(right if is_a else left, F.col("_b_lo" if is_a else "_a_lo"), width_minutes, levels)
        x, y = (starts, later) if is_a else (later, starts)
        # of equal starts, the pair is the first turn's
        meets = F.col("_b_lo").between(F.col("_a_lo"), F.col("_a_hi")) if is_a else (F.col("_a_lo") > F.col("_b_lo")) & (F.col("_a_lo") <= F.col("_b_hi"))
        if semi_on:
            same = _on(keys, levels)
            y = y.select(*[F.col(c).alias(f"_of_b_{c}") for c in same], "_b_lo", "_b_hi", "_b_id")
            on = [F.col(c) == F.col(f"_of_b_{c}") for c in same] + [meets, F.col(semi_on[0]) != F.col("_b_id")]
            found.append(x.join(y, on, "left_semi").select(*keys, semi_on[0]))
        else:
            found.append(x.join(y, _on(keys, levels)).filter(meets).drop("_a_lo", "_a_hi", "_b_lo", "_b_hi", "_lo", "_hi", "_level", "_node"))
    both = found[0].unionByName(found[1])
    return both.distinct() if semi_on else both
