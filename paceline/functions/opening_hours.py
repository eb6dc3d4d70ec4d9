"""Opening hours as written on maps, turned into the hours of a week.

A value is read as tokens by a small parser of the published grammar: rules of days and times, apart by semicolons.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType

DAY = 1440
DAYS = {d: i for i, d in enumerate(("mo", "tu", "we", "th", "fr", "sa", "su"))}
_TOKEN = re.compile(r"24/7|\d{1,2}:\d{2}|[a-z]+|\|\||[-,;:+]|(\S)")


class NotUnderstood(ValueError):
    pass


class Parser:
    """Reads rules from left to right; `week` is a flag for each minute, from Monday."""

    def __init__(self, text: str):
        self.tokens = []
        for m in _TOKEN.finditer(text.lower()):
            if m[1]:
                raise NotUnderstood(m[1])
            self.tokens.append(";" if m[0] == "||" else m[0])
        self.at, self.rules = 0, 0
        self.days: list[set[int]] = [set() for _ in range(7)]  # minutes from a day's start, up to two days later

    def peek(self, ahead: int = 0) -> str:
        return self.tokens[self.at + ahead] if self.at + ahead < len(self.tokens) else ""

    def take(self, *wanted: str) -> bool:
        if self.peek() in wanted and self.peek():
            self.at += 1
            return True
        return False

    def clock(self) -> int:
        hour, _, minute = self.peek().partition(":")
        if not minute or int(hour) > 48 or int(minute) > 59:
            raise NotUnderstood(self.peek())
        self.at += 1
        return int(hour) * 60 + int(minute)

    def selector(self) -> set[int] | None:
        """The days that a rule names; holidays are none of them; None where it names nothing."""
        if self.peek() not in DAYS and self.peek() not in ("ph", "sh"):
            return None
        named: set[int] = set()
        while True:
            if not self.take("ph", "sh"):
                first = last = self.day()
                if self.take("-"):
                    last = self.day()
                day = first
                named.add(day)
                while day != last:
                    day = (day + 1) % 7
                    named.add(day)
            if not (self.peek() == "," and (self.peek(1) in DAYS or self.peek(1) in ("ph", "sh"))):
                break
            self.at += 1
        self.take(":")
        return named

    def day(self) -> int:
        if self.peek() not in DAYS:
            raise NotUnderstood(self.peek())
        self.at += 1
        return DAYS[self.tokens[self.at - 1]]

    def times(self) -> set[int]:
        """Minutes that a list of times covers; an end that is no later than its start is on the next day."""
        if self.take("off", "closed"):
            return set()
        if self.take("24/7"):
            return set(range(DAY))
        out: set[int] = set()
        while True:
            start = self.clock()
            end = DAY
            if not self.take("+"):
                if not self.take("-"):
                    raise NotUnderstood(self.peek())
                end = self.clock()
                self.take("+")
            out |= set(range(start, end if end > start else end + DAY))
            if not (self.peek() == "," and ":" in self.peek(1)):
                return out
            self.at += 1

    def rule(self) -> None:
        """A later rule replaces the days it names."""
        named = self.selector()
        bare = self.peek() in ("", ";")
        if bare and not named:
            raise NotUnderstood("nothing but holidays" if named is not None else self.peek())
        open_at = set(range(DAY)) if bare else self.times()
        for d in range(7) if named is None else named:
            self.days[d] = open_at
        self.rules += 1

    def parse(self) -> list[set[int]]:
        while self.peek():
            if self.take(";"):
                continue
            self.rule()
            # a comma before a day begins a rule as well
            if self.peek() == "," and self.peek(1) in DAYS:
                self.at += 1
            elif self.peek() not in ("", ";"):
                raise NotUnderstood(self.peek())
        return self.days


@lru_cache(100_000)
def week(value: str | None) -> list[bool] | None:
    """Whether each hour of the week, from Monday, is open at its half; null for what isn't understood.

    Times past midnight run into the next day, those of Sunday into Monday. Rules for holidays only are passed over.
    """
    if value is None or not value.strip():
        return None
    try:
        days = Parser(value).parse()
    except NotUnderstood:
        return None
    return [any(60 * h + 30 + DAY * back in days[(d - back) % 7] for back in range(3)) for d in range(7) for h in range(24)]


@F.pandas_udf(ArrayType(BooleanType()))
def open_hours(values: pd.Series) -> pd.Series:
    return values.map(lambda v: week(v) if isinstance(v, str) else None)
