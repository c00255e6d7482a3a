"""Scalar functions as Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6371008.8


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once, however often use refers to it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres."""
    a = F.sin(F.radians(lat2 - lat1) / 2) ** 2 + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(F.radians(lon2 - lon1) / 2) ** 2
    return 2 * EARTH_M * F.asin(F.sqrt(a))


def cell(value: Column, size: float) -> Column:
    """Grid cell, towards zero."""
    return (value / F.lit(size)).cast("long")


def slug(key: Column) -> Column:
    """The first six hex digits of a key's SHA-1; of 'unnamed' for an empty one."""
    return F.substring(F.sha1(F.when(F.coalesce(key, F.lit("")) == "", F.lit("unnamed")).otherwise(key)), 1, 6)


def scrub_emails(text: Column, mark: str = "[הוסר]") -> Column:
    return F.regexp_replace(text, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", mark)


def year(text: Column) -> Column:
    """The first number of up to four digits, if from -4000 to 2100."""
    found = F.try_to_number(F.regexp_extract(text, r"-?\d{1,4}", 0), F.lit("S9999")).cast("int")
    return F.when(found.between(-4000, 2100), found)
