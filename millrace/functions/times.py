"""Time expressions and the regular grid all durations are counted in."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed formats of event timestamps: read with or without a fraction, written with six digits.
EVENT_TIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]X"
OUTPUT_TIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def parse_event_time(col: Column) -> Column:
    """Event text to an instant; unreadable text gives null."""
    return F.try_to_timestamp(col, F.lit(EVENT_TIME_PATTERN))


def format_event_time(col: Column) -> Column:
    return F.date_format(col, OUTPUT_TIME_PATTERN)


def within_seconds(a: Column, b: Column, seconds: Column | float) -> Column:
    """True when two instants lie at most ``seconds`` apart, either way round."""
    limit = seconds if isinstance(seconds, Column) else F.lit(float(seconds))
    return F.abs(F.unix_micros(a) - F.unix_micros(b)) <= limit.cast("double") * 1e6


def whole_div(col: Column, divisor: int) -> Column:
    """Integer division without a detour through doubles."""
    return F.call_function("div", col, F.lit(divisor))


def floor_div(col: Column, divisor: int) -> Column:
    """Integer division downwards, also below zero (instants before 1970)."""
    return whole_div(col - F.pmod(col, F.lit(divisor)), divisor)


@dataclass(frozen=True)
class Grid:
    """A regular time grid; one step is a minute in production and any length in tests."""

    step_seconds: int = 60

    @property
    def step_micros(self) -> int:
        return self.step_seconds * 1_000_000

    def span(self, steps: int) -> int:
        """Length of so many steps in microseconds."""
        return steps * self.step_micros

    def back_micros(self, anchor: Column, ts: Column) -> Column:
        """How far an instant lies before its anchor, in microseconds."""
        return F.unix_micros(anchor) - F.unix_micros(ts)

    def floor(self, ts: Column) -> Column:
        """Start of the step an instant falls in, counted from the epoch."""
        micros = F.unix_micros(ts)
        return F.timestamp_micros(micros - F.pmod(micros, F.lit(self.step_micros)))

    def earlier(self, anchor: Column, steps: Column) -> Column:
        """The instant so many steps before the anchor."""
        return F.timestamp_micros(F.unix_micros(anchor) - steps.cast("bigint") * F.lit(self.step_micros))
