"""Column helpers that several operators share. All are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_MINUTE = 60_000_000
#: An explicit offset is required, so that no instant depends on the session's time zone.
INSTANT = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:\d{2})$"
#: Moves sums of short decimals off exact ties before they are rounded for comparison.
NUDGE = 3.3e-8


def micros(ts: Column | str) -> Column:
    """Microseconds since 1970 of a timestamp."""
    return F.unix_micros(ts)


def wall_micros(ntz: Column) -> Column:
    """Microseconds of a wall clock (a timestamp without zone), as if it were UTC."""
    return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), ntz)


def minutes(us: Column) -> Column:
    """Minutes, as a double, of a span in microseconds."""
    return us / F.lit(float(MICROS_PER_MINUTE))


def parse_instant(raw: Column) -> Column:
    """The instant of an ISO string with an offset; null for anything else."""
    return F.when(raw.rlike(INSTANT), F.try_to_timestamp(F.regexp_replace(raw, "Z$", "+00:00")))


def minutes_of_day(raw: Column) -> Column:
    """Minutes after midnight on the clock that an ISO string shows, whatever its offset."""
    return F.substring(raw, 12, 2).try_cast("int") * 60 + F.substring(raw, 15, 2).try_cast("int")


def tie_safe(x: Column, digits: int = 6) -> Column:
    """``x`` rounded for comparison between engines whose sums differ in the last bits."""
    return F.round(x + F.lit(NUDGE), digits)


def half_even(x: Column, digits: int = 0) -> Column:
    """Rounding of halves to the even digit."""
    return F.rint(x) if digits == 0 else F.bround(x, digits)


def flags_of(*conditions: tuple[str, Column]) -> Column:
    """The names whose condition holds, sorted; a null condition counts as false."""
    return F.array_sort(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in conditions])))
