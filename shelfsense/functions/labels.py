"""Case analysis as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# User segments as (name, smallest total, largest total) of units bought.
SEGMENTS = [
    ("one", 1, 1),
    ("two", 2, 2),
    ("three", 3, 3),
    ("four", 4, 4),
    ("five", 5, 5),
    ("six", 6, 6),
    ("seven_eleven", 7, 11),
    ("twelve", 12, 12),
    ("thirteen_twentyfour", 13, 24),
    ("twentyfive", 25, 25),
    ("twentysix_onehundred", 26, 100),
]
LARGEST_SEGMENT = ("onehundred_plus", 100)


def segment_name(total: Column) -> Column:
    """Segment of a user from the whole units they bought; null if no segment holds the total."""
    name, floor = LARGEST_SEGMENT
    expression = F.when(total > floor, name)
    for name, low, high in SEGMENTS:
        inside = (total >= low) & (total <= high) & (total == F.floor(total))
        expression = expression.when(inside, name)
    return expression


def steps_reached(value: Column, thresholds: Sequence[float]) -> Column:
    """How many of the thresholds ``value`` reaches."""
    reached = F.lit(0)
    for threshold in thresholds:
        reached = reached + (value >= F.lit(float(threshold))).cast("int")
    return reached


def safe_ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, null where ``whole`` is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))
