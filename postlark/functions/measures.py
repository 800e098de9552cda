"""Column builders for ratios, totals and labels."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(part: Column, whole: Column) -> Column:
    """Division that yields NULL instead of an error when the divisor is zero."""
    return F.try_divide(part, whole)


def percent(part: Column, whole: Column, digits: int) -> Column:
    """Rounded share of the whole in percent."""
    return F.round(ratio(part, whole) * 100, digits)


def total(*parts: Column) -> Column:
    """Sum of the columns; NULL when any of them is NULL."""
    return reduce(add, parts)


def topic_label(domain: Column, entity: Column, style: str) -> Column:
    """Readable topic name; NULL when a part of it is missing.

    ``legacy`` repeats the entity, ``name (name)``; ``domain`` is ``domain: entity``.
    """
    if style == "legacy":
        return F.concat(entity, F.lit(" ("), entity, F.lit(")"))
    if style == "domain":
        return F.concat(domain, F.lit(": "), entity)
    raise ValueError(f"unknown label style: {style}")
