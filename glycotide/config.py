"""Tunables of the operators, with their default values."""

from __future__ import annotations

from dataclasses import dataclass, field

UNITS = ("mg/dL", "mmol/L")
MGDL_PER_MMOL = 18.0

# Limits per unit as (mmol/L, mg/dL).
JUMP = {"mmol/L": 3.0, "mg/dL": 54.0}
SUSPICIOUS = {"mmol/L": 2.0, "mg/dL": 36.0}
EXTREME_LOW = {"mmol/L": 3.0, "mg/dL": 54.0}
EXTREME_HIGH = {"mmol/L": 15.0, "mg/dL": 270.0}
PEAK_LIMIT_MMOL, NADIR_LIMIT_MMOL = 7.8, 3.9
DEFAULT_INTERVAL, DEFAULT_DURATION = 5.0, 30


@dataclass(frozen=True)
class Window:
    """Minutes from an event's start, both ends included."""

    start: float
    end: float
    relative_to: str = "event_start"

    def __post_init__(self):
        if self.end < self.start:
            raise ValueError("a window must not end before it starts")


@dataclass(frozen=True)
class MetricWindows:
    baseline: Window = field(default_factory=lambda: Window(-30, 0))
    peak: Window = field(default_factory=lambda: Window(0, 180))
    auc: Window = field(default_factory=lambda: Window(0, 120))
    nadir: Window = field(default_factory=lambda: Window(0, 180))
    time_to_peak: Window = field(default_factory=lambda: Window(0, 180))
    recovery: Window = field(default_factory=lambda: Window(120, 240))

    def envelope(self) -> tuple[float, float]:
        every = (self.baseline, self.peak, self.auc, self.nadir, self.time_to_peak, self.recovery)
        return min(w.start for w in every), max(w.end for w in every)


@dataclass(frozen=True)
class QualityConfig:
    min_baseline_minutes: float = 60
    min_isolation_minutes: float = 30
    min_during_coverage: float = 0.8
    min_baseline_coverage: float = 0.9
    default_duration_minutes: float = DEFAULT_DURATION


@dataclass(frozen=True)
class SignalConfig:
    coverage_soft: float = 0.85
    history_size: int = 30
    min_history: int = 10


@dataclass(frozen=True)
class AnswerConfig:
    min_events_per_group: int = 2
    min_metric_coverage: float = 0.7
    min_isolation_minutes: float = 30
    default_duration_minutes: float = DEFAULT_DURATION
    #: Metrics whose window is a bundle never match a question's window, unless this maps them to one of its parts.
    match_bundle_outcome_window: bool = False
