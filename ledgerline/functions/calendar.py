"""US federal holidays by rule, as column expressions: no dimension table and no join."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

MONDAY, THURSDAY, FRIDAY = 0, 3, 4

# Month, day and first year of the holidays on fixed dates.
FIXED = (
    ("New Year's Day", 1, 1, 0),
    ("Juneteenth", 6, 19, 2021),
    ("Independence Day", 7, 4, 0),
    ("Veterans Day", 11, 11, 0),
    ("Christmas Day", 12, 25, 0),
)

# Month, weekday and the span of month days the holiday can fall on.
FLOATING = (
    ("Martin Luther King Jr. Day", 1, MONDAY, 15, 21),
    ("Washington's Birthday", 2, MONDAY, 15, 21),
    ("Memorial Day", 5, MONDAY, 25, 31),
    ("Labor Day", 9, MONDAY, 1, 7),
    ("Columbus Day", 10, MONDAY, 8, 14),
    ("Thanksgiving", 11, THURSDAY, 22, 28),
)


def _day_code(d: Column) -> Column:
    return F.month(d) * 100 + F.dayofmonth(d)


def _shifted(month: int, dom: int, days: int) -> int:
    """Month and day ``days`` later; no fixed holiday is near the end of February, so any year will do."""
    other = date(2001, month, dom) + timedelta(days=days)
    return other.month * 100 + other.day


def _rules(d: Column, observed: bool) -> list[tuple[Column, str]]:
    """(condition, name) per holiday, all on the day's own month, day and weekday."""
    code, weekday = _day_code(d), F.weekday(d)
    rules = []
    for name, month, dom, since in FIXED:
        known = F.year(d) >= since if since else F.lit(True)
        rules.append(((code == month * 100 + dom) & known, name))
        if observed:
            early = (weekday == FRIDAY) & (code == _shifted(month, dom, -1))
            late = (weekday == MONDAY) & (code == _shifted(month, dom, 1))
            rules.append(((early | late) & known, f"{name} (observed)"))
    for name, month, day, lo, hi in FLOATING:
        rules.append(((weekday == day) & code.between(month * 100 + lo, month * 100 + hi), name))
    return rules


def holiday_name(d: Column, observed: bool = True) -> Column:
    """Name of the holiday on date ``d``, or null.

    A fixed holiday on a Saturday is also observed on the Friday before, one on a Sunday on the Monday after.
    """
    first, *rest = _rules(d, observed)
    out = F.when(first[0], F.lit(first[1]))
    for hit, name in rest:
        out = out.when(hit, F.lit(name))
    return out


def _any_rule(d: Column, observed: bool = True) -> Column:
    """The rules of ``_rules`` folded into a few set lookups, so a date is taken apart only a few times."""
    code, weekday = _day_code(d), F.weekday(d)
    always = [m * 100 + dom for _, m, dom, since in FIXED if not since]
    hits = [code.isin(always)]
    by_weekday: dict[int, list[int]] = {}
    for _, month, day, lo, hi in FLOATING:
        by_weekday.setdefault(day, []).extend(range(month * 100 + lo, month * 100 + hi + 1))
    for _, month, dom, since in FIXED:
        if since:
            hits.append((code == month * 100 + dom) & (F.year(d) >= since))
        if observed:
            for day, shift in ((FRIDAY, -1), (MONDAY, 1)):
                if since:
                    hits.append((code == _shifted(month, dom, shift)) & (weekday == day) & (F.year(d) >= since))
                else:
                    by_weekday.setdefault(day, []).append(_shifted(month, dom, shift))
    hits += [code.isin(codes) & (weekday == day) for day, codes in by_weekday.items()]
    return reduce(or_, hits)


def is_holiday(d: Column, observed: bool = True) -> Column:
    return _any_rule(d, observed).cast("int")


def near_holiday(d: Column, days: int = 1) -> Column:
    """1 when a holiday lies within ``days`` before or after ``d``."""
    return reduce(or_, [_any_rule(F.date_add(d, k)) for k in range(-days, days + 1)]).cast("int")
