"""Column helpers: instants, rounding and text."""

from glycotide.functions.columns import (
    flags_of,
    half_even,
    micros,
    minutes,
    minutes_of_day,
    parse_instant,
    tie_safe,
)

__all__ = ["flags_of", "half_even", "micros", "minutes", "minutes_of_day", "parse_instant", "tie_safe"]
