"""Selectors and conditions of questions, compiled to boolean columns over flat annotations.

A candidate is compared as text, number or list by what its component is and what the question's value is. Comparisons
that could never be made (a text with ``<`` and a number, a time that isn't HH:MM) are errors when the question is
compiled. A null candidate matches nothing.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from glycotide.functions.columns import minutes_of_day
from glycotide.operators.annotations import context_tags

LABEL, PLAIN, TIMES, TAGS = {"label", "food_name"}, {"event_type", "source", "annotation_quality"}, {"start_time", "end_time"}, {"context_tag", "context", "context_tags"}
ORDERED = {"<": "__lt__", ">": "__gt__", "<=": "__le__", ">=": "__ge__"}
_CLOCK = re.compile(r"^(\d{1,2}):(\d{2})")


@dataclass(frozen=True)
class Candidate:
    """What a component gives: its column, whether it is text, number or list, and the column of its unit."""

    column: Column
    kind: str
    unit: Column | None = None


def resolve(component: str) -> Candidate:
    name = component.lower()
    if name in LABEL:
        return Candidate(F.col("label"), "text")
    if name in PLAIN:
        return Candidate(F.col(name), "number" if name == "annotation_quality" else "text")
    if name in TIMES:
        return Candidate(F.col(f"{name}_raw"), "text", F.lit("datetime"))
    if name in TAGS:
        return Candidate(context_tags(F.col("notes")), "list")
    first = F.try_element_at(F.filter("exposure_components", lambda c: c["name"] == component), F.lit(1))
    return Candidate(first["value"], "number", first["unit"])


def _folded(x: Column) -> Column:
    return F.lower(F.trim(x))


def _equals(candidate: Column, kind: str, value: Any) -> Column:
    if isinstance(value, (list, tuple, dict)) or value is None:
        return F.lit(False)
    if kind == "list":
        return F.exists(candidate, lambda x: _equals(x, "text", value))
    if kind == "text":
        return _folded(candidate) == F.lit(value.strip().lower()) if isinstance(value, str) else F.lit(False)
    return candidate == F.lit(float(value)) if not isinstance(value, str) else F.lit(False)


def clock_minutes(value: Any) -> Any:
    """HH:MM as minutes after midnight; lists item by item; anything else as it is."""
    if isinstance(value, (list, tuple)):
        return [clock_minutes(v) for v in value]
    if isinstance(value, str) and ":" in value:
        if not (m := _CLOCK.match(value)):
            raise ValueError(f"not a time of day: {value!r}")
        return int(m[1]) * 60 + int(m[2])
    return value


def compare(operator: str | None, candidate: Candidate, value: Any) -> Column:
    """False for an unknown or absent operator."""
    c, kind = candidate.column, candidate.kind
    if operator == "=":
        return _equals(c, kind, value)
    if operator in ORDERED:
        if kind == "list" or (kind == "text") != isinstance(value, str):
            raise ValueError(f"{operator} can't compare a {kind} with {value!r}")
        return getattr(c, ORDERED[operator])(F.lit(value if kind == "text" else float(value)))
    if operator == "between":
        if not isinstance(value, (list, tuple)) or len(value) != 2:
            return F.lit(False)
        low, high = clock_minutes(list(value))
        if not all(isinstance(x, (int, float)) and not isinstance(x, bool) for x in (low, high)) or kind == "list":
            return F.lit(False)
        x = c if kind == "number" else F.when(c.rlike(r"^\d{1,2}:\d{2}$"), F.split_part(c, F.lit(":"), F.lit(1)).cast("int") * 60 + F.split_part(c, F.lit(":"), F.lit(2)).cast("int"))
        return x.between(low, high) if low <= high else (x >= low) | (x <= high)
    if operator == "in":
        if not isinstance(value, (list, tuple)):
            return F.lit(False)
        return reduce(lambda a, b: a | b, [_equals(c, kind, v) for v in value], F.lit(False))
    if operator == "exists":
        return c.isNotNull()
    return F.lit(False)


def _met(rule: dict, candidate: Candidate) -> Column:
    ok = compare(rule.get("operator"), candidate, rule.get("value"))
    if rule.get("unit") and candidate.unit is not None:
        ok = ok & (candidate.unit.isNull() | (candidate.unit == rule["unit"]))
    return F.coalesce(candidate.column.isNotNull() & ok, F.lit(False))


def selector(rule: dict) -> Column:
    """True where an event has the rule's component and it compares; units must agree only if both are given."""
    component = rule.get("component")
    if not component:
        return F.lit(False)
    candidate = resolve(component)
    if rule.get("operator") == "exists":
        return candidate.column.isNotNull()
    return _met(rule, candidate)


def condition(rule: dict) -> Column:
    """Like a selector; ``time_of_day`` is read off the event's own clock, and units are ignored for it and for tags."""
    name = rule.get("name") or ""
    if name in TAGS:
        return F.coalesce(compare(rule.get("operator"), resolve("context_tags"), rule.get("value")), F.lit(False))
    if name == "time_of_day":
        clock = Candidate(minutes_of_day(F.col("start_time_raw")), "number")
        return F.coalesce(compare(rule.get("operator"), clock, clock_minutes(rule.get("value"))), F.lit(False))
    return _met(rule, resolve(name)) if name else F.lit(False)


def definition(rule: dict, conditions: Sequence[dict] = ()) -> Column:
    """An event of the rule's type that its selector and all conditions accept."""
    matches = F.coalesce(F.col("event_type") == rule["event_type"], F.lit(False)) & selector(rule.get("selector") or {})
    return reduce(lambda a, b: a & b, map(condition, conditions), matches)
