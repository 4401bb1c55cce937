"""Small numeric column expressions shared by several operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(value: Column, digits: int = 0) -> Column:
    """Half-away rounding without negative zero."""
    return F.round(value, digits) + F.lit(0.0)


def percent(part: Column, whole: Column, digits: int) -> Column:
    """`part` as a rounded percentage of `whole`; null when `whole` is zero or null."""
    return rounded(F.try_divide(part, whole) * 100, digits)


def nearest(value: Column) -> Column:
    """Nearest integer, halves upward (the dashboard's rounding)."""
    return F.floor(value + F.lit(0.5))


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))
