"""Calendar attributes of a date: season, weekday, weekend flag, holidays.

Holiday tagging is data driven: ``HOLIDAY_RULES`` is compiled into one CASE
chain (first matching rule wins), so adding a rule is a data change.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spark ``dayofweek``: 1 = Sunday ... 7 = Saturday.
SUNDAY, MONDAY, THURSDAY, SATURDAY = 1, 2, 5, 7
# Full English weekday names, indexed by ``dayofweek - 1``.
FULL_WEEKDAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


class HolidayRule(NamedTuple):
    name: str
    month: int
    day_from: int | None = None  # inclusive; None = any day
    day_to: int | None = None  # inclusive; None = day_from
    weekday: int | None = None  # Spark dayofweek number; None = any
    min_iso_week: int | None = None  # ISO week >= this; None = any


# The holiday calendar of the warehouse, in rule order
# (first match wins).  Thanksgiving is "a Thursday of November in ISO week 47
# or later"; see ``holiday_name(strict_thanksgiving=True)`` for the 4th Thursday.
HOLIDAY_RULES: tuple[HolidayRule, ...] = (
    HolidayRule("New Years Day", 1, 1),
    HolidayRule("Valentines Day", 2, 14),
    HolidayRule("St. Patricks Day", 3, 17),
    HolidayRule("April Fools Day", 4, 1),
    HolidayRule("Earth Day", 4, 22),
    HolidayRule("May Day", 5, 1),
    HolidayRule("Cinco de Mayo", 5, 5),
    HolidayRule("Midsummer", 6, 19, 26),
    HolidayRule("Independence Day", 7, 4),
    HolidayRule("Labor Day (US)", 9, 1, 7, weekday=MONDAY),
    HolidayRule("Halloween", 10, 31),
    HolidayRule("Thanksgiving", 11, weekday=THURSDAY, min_iso_week=47),
    HolidayRule("Christmas Eve", 12, 24),
    HolidayRule("Christmas Day", 12, 25),
    HolidayRule("New Years Eve", 12, 31),
)

# Meteorological seasons by month.
SEASONS = (("Winter", (12, 1, 2)), ("Spring", (3, 4, 5)), ("Summer", (6, 7, 8)), ("Autumn", (9, 10, 11)))


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def season(col) -> Column:
    """Season name of a date (NULL date -> NULL)."""
    m = F.month(_c(col))
    expr = None
    for name, months in SEASONS:
        expr = F.when(m.isin(*months), name) if expr is None else expr.when(m.isin(*months), name)
    return expr


def weekday_name(col) -> Column:
    """Short English weekday name ('Mon' ... 'Sun')."""
    return F.date_format(_c(col), "E")


def _is_weekday(d: Column, day: int, by_name: bool) -> Column:
    """Is ``d`` on weekday ``day``?  ``by_name`` compares the short weekday
    name with the full one, as the warehouse model literally does: that test
    is never true (kept only to reproduce the model's output)."""
    if by_name:
        return weekday_name(d) == FULL_WEEKDAY_NAMES[day - 1]
    return F.dayofweek(d) == day


def is_weekend(col, by_name: bool = False) -> Column:
    """1 for Saturday or Sunday, else 0 (decided on the weekday number; see
    ``_is_weekday`` for ``by_name``)."""
    d = _c(col)
    return F.when(_is_weekday(d, SATURDAY, by_name) | _is_weekday(d, SUNDAY, by_name), 1).otherwise(0)


def _rule_condition(d: Column, rule: HolidayRule, strict_thanksgiving: bool, by_name: bool) -> Column:
    cond = F.month(d) == rule.month
    day_from, day_to = rule.day_from, rule.day_to
    if strict_thanksgiving and rule.name == "Thanksgiving":
        day_from, day_to = 22, 28  # the fourth Thursday always falls on the 22nd-28th
        min_week = None
    else:
        min_week = rule.min_iso_week
    if day_from is not None:
        cond = cond & F.dayofmonth(d).between(day_from, day_to if day_to is not None else day_from)
    if rule.weekday is not None:
        cond = cond & _is_weekday(d, rule.weekday, by_name)
    if min_week is not None:
        cond = cond & (F.weekofyear(d) >= min_week)
    return cond


def holiday_name(col, rules=HOLIDAY_RULES, strict_thanksgiving: bool = False,
                 weekday_by_name: bool = False) -> Column:
    """Name of the first matching holiday rule, NULL when none matches.

    ``weekday_by_name=True`` reproduces the model literally: its weekday rules
    (Labor Day, Thanksgiving) then never match.
    """
    d = _c(col)
    expr = None
    for rule in rules:
        cond = _rule_condition(d, rule, strict_thanksgiving, weekday_by_name)
        expr = F.when(cond, rule.name) if expr is None else expr.when(cond, rule.name)
    return expr
