"""Column helpers. Each one is a composition of built-in functions, so it stays inside codegen."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# The five characters of markup text and their entities, in the order they must be replaced.
MARKUP_ENTITIES = (
    ("&", "&amp;"),
    ("<", "&lt;"),
    (">", "&gt;"),
    ('"', "&quot;"),
    ("'", "&#x27;"),
)


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def ratio(top: Column | str, bottom: Column | str) -> Column:
    """``top / bottom`` as double; null when the bottom is zero or null."""
    return _col(top).cast("double") / F.nullif(_col(bottom).cast("double"), F.lit(0.0))


def percent_of(part: Column, whole: Column, digits: int) -> Column:
    """``part`` of ``whole`` in percent, rounded half away from zero; null for an empty whole."""
    exact = (part.cast("decimal(20,0)") * 100).cast("decimal(28,4)") / F.nullif(whole, F.lit(0))
    return F.round(exact, digits).cast("double")


def money(value: Column | str) -> Column:
    """Two-decimal exact amount, so that sums do not depend on the order of rows."""
    return _col(value).cast("decimal(18,2)")


def moment(at: datetime) -> Column:
    """A zone-less time as a column. A plain literal would be taken as an instant and shifted into the
    session's time zone."""
    return F.lit(at.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")


def as_flag(value: Column | str) -> Column:
    """0/1 number to boolean; null stays null."""
    return _col(value) == 1


def day_of(at: Column | str) -> Column:
    return _col(at).cast("date")


def day_text(at: Column | str) -> Column:
    return _col(at).cast("date").cast("string")


def micros_between(later: Column, earlier: Column) -> Column:
    """Exact microseconds from ``earlier`` to ``later``. Subtracting zone-less times keeps the session
    zone out of it, which ``timestamp_diff`` would not."""
    gap = later - earlier
    part = {unit: F.extract(F.lit(unit), gap) for unit in ("DAY", "HOUR", "MINUTE", "SECOND")}
    minutes = (part["DAY"].cast("bigint") * 24 + part["HOUR"]) * 60 + part["MINUTE"]
    return minutes * 60_000_000 + (part["SECOND"] * 1_000_000).cast("bigint")


def hours_between(later: Column, earlier: Column) -> Column:
    return micros_between(later, earlier) / F.lit(3.6e9)


def minutes_between(later: Column, earlier: Column) -> Column:
    return micros_between(later, earlier) / F.lit(6e7)


def interval_hours(hours: Column) -> Column:
    return F.make_dt_interval(hours=hours)


def within_days(at: Column | str, as_of: datetime, days: int) -> Column:
    """True when ``at`` is at most ``days`` before ``as_of``; null when ``at`` is null."""
    return _col(at) >= moment(as_of) - F.expr(f"interval {int(days)} days")


def escape_markup(text: Column | str) -> Column:
    out = _col(text)
    for char, entity in MARKUP_ENTITIES:
        out = F.replace(out, F.lit(char), F.lit(entity))
    return out


def cut_text(text: Column | str, length: int = 300) -> Column:
    """The leading characters shown in an alert line."""
    return F.substring(_col(text), 1, length)
