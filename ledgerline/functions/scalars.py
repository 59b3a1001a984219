"""Column expressions. Everything here is built-in and stays inside code generation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_hour(ts: Column) -> Column:
    """Nearest hour, half to the even hour. Sessions run in UTC, so an hour is always 3600 seconds."""
    floor = F.date_trunc("hour", ts).cast("timestamp_ntz")
    into = F.minute(ts) * 60 + F.date_part(F.lit("second"), ts)
    up = (into > 1800) | ((into == 1800) & (F.hour(ts) % 2 == 1))
    return floor + F.when(up, F.expr("interval 1 hour")).otherwise(F.expr("interval 0 hour"))


def day(ts: Column) -> Column:
    return ts.cast("date")


def hour_of(ts: Column) -> Column:
    return F.hour(ts).cast("int")


def weekday(ts: Column) -> Column:
    """Monday is 0."""
    return F.weekday(ts).cast("int")


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def safe_ratio(num: Column, den: Column) -> Column:
    """Null where the denominator is zero."""
    return F.try_divide(num, den)


def ratio_or_same(num: Column, den: Column) -> Column:
    """A zero denominator counts as one."""
    return num / F.when(den == 0, F.lit(1)).otherwise(den)


def row_mean(*cols: Column) -> Column:
    """Mean over the columns that are present."""
    total = sum((F.coalesce(c.cast("double"), F.lit(0.0)) for c in cols), F.lit(0.0))
    known = sum((c.isNotNull().cast("int") for c in cols), F.lit(0))
    return F.try_divide(total, known)


def parse_money(text: Column) -> Column:
    return F.regexp_replace(text, r"[$,]", "").try_cast("double")


def parse_timestamp(text: Column, formats: Sequence[str]) -> Column:
    """First format that fits wins; null when none does."""
    tried = [F.try_to_timestamp(text, F.lit(f)) for f in formats]
    return F.coalesce(*tried).cast("timestamp_ntz")


def recode(value: Column, mapping: Mapping, default=None) -> Column:
    """Dictionary recode for a handful of keys; larger dictionaries belong in a dimension join."""
    table = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    found = F.try_element_at(table, value)
    return found if default is None else F.coalesce(found, F.lit(default))


def right_closed(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Bins ``(edge[i], edge[i+1]]``; null outside."""
    out = None
    for lo, hi, label in zip(edges, edges[1:], labels):
        hit = (value > lo) & (value <= hi)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out


def cyclic(value: Column, period: float) -> tuple[Column, Column]:
    angle = value * F.lit(2.0) * F.pi() / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def clip(value: Column, low: Column, high: Column) -> Column:
    return F.least(F.greatest(value, low), high)
