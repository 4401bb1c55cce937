"""Price arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemart.functions.numeric import rounded

# Payload prices above the threshold are scaled by the divisor.
SCALED_ABOVE = 1_000_000
SCALE = 100_000


def rescale(value: Column) -> Column:
    return F.when(value > SCALED_ABOVE, value / SCALE).otherwise(value)


def discount_percent(price: Column, original: Column) -> Column:
    """Discount off the original price to one decimal; null when there is none."""
    on_sale = (original > 0) & (price < original)
    return F.when(on_sale, rounded((1 - price / original) * 100, 1))


def change_percent(price: Column, previous: Column) -> Column:
    """Relative change to two decimals; null without a positive previous price."""
    return F.when(previous > 0, rounded((price - previous) / previous * 100, 2))
