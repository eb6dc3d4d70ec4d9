"""Clock and calendar expressions; local times are timestamp_ntz, and UTC is one too, so no session zone enters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_utc(local: Column, zone: str) -> Column:
    """UTC of a local time; the first of two where the clock goes back, and null where it skips."""
    utc = F.convert_timezone(F.lit(zone), F.lit("UTC"), local)
    return F.when(F.convert_timezone(F.lit("UTC"), F.lit(zone), utc) == local, utc)


def to_local(utc: Column, zone: str) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def add_hours(ts: Column, hours: Column | int) -> Column:
    return F.timestamp_add("HOUR", F.lit(hours) if isinstance(hours, int) else hours, ts)


def hours_between(a: Column, b: Column) -> Column:
    """Whole hours from a to b."""
    return F.timestamp_diff("HOUR", a, b)


def trunc(unit: str, ts: Column | str) -> Column:
    """The start of the unit, without a zone as the time itself."""
    return F.date_trunc(unit, ts).cast("timestamp_ntz")


def floor_minutes(ts: Column, minutes: int) -> Column:
    """The start of the block of so many minutes, counted from midnight."""
    day = trunc("DAY", ts)
    return F.timestamp_add("MINUTE", (F.floor(F.timestamp_diff("MINUTE", day, ts) / minutes) * minutes).cast("int"), day)


def weekday(day: Column) -> Column:
    """Monday is 0."""
    return F.weekday(day)


def hour_of_week(ts: Column) -> Column:
    return (F.weekday(ts) * 24 + F.hour(ts)).cast("int")


def in_ranges(day: Column, ranges: Sequence[tuple[str, str]]) -> Column:
    """Whether a date lies in any of the ranges, both ends included."""
    out = F.lit(False)
    for a, z in ranges:
        out = out | day.between(F.to_date(F.lit(a)), F.to_date(F.lit(z)))
    return out


def covered(day: Column, flag: Column, years: Sequence[int]) -> Column:
    """The flag where the calendar covers the date's year; else null, which is not false."""
    return F.when(F.year(day).isin(*years), flag)


def term_ranges(terms: Sequence[dict]) -> list[tuple[str, str]]:
    """Date ranges of school terms; where students start later than the term, that counts."""
    return [(str(t.get("students_start", t["start"])), str(t["end"])) for t in terms]


def period_ranges(calendar: Sequence[dict], kind: str) -> list[tuple[str, str]]:
    """The ranges of one kind (teaching, break, exams) in a list of semesters."""
    return [(str(p["start"]), str(p["end"])) for s in calendar for p in s.get(kind, ())]
