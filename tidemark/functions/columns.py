"""Column expressions used by the transforms and marts. All run inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Duration bands in seconds, and their labels.
LOW_BELOW = 150
MEDIUM_BELOW = 300
BAND_LABELS = ("low", "medium", "high")

_EXACT = "decimal(28,6)"


def standard_name(value: Column) -> Column:
    """Upper case without surrounding spaces (spaces only, tabs stay)."""
    return F.upper(F.trim(value))


def title_text(value: Column) -> Column:
    """Every hyphen becomes a space, then surrounding spaces go."""
    return F.trim(F.translate(value, "-", " "))


def duration_label(value: Column, low: float = LOW_BELOW, medium: float = MEDIUM_BELOW) -> Column:
    """Band of a duration. NULL matches no band test and so lands in the last one."""
    first, second, last = BAND_LABELS
    return F.when(value < F.lit(low), first).when(value < F.lit(medium), second).otherwise(last)


def minutes(seconds: Column, places: int = 2) -> Column:
    """Seconds as minutes, rounded half up. The division is decimal, so a half is a half."""
    return F.round(seconds.cast(_EXACT) / F.lit(60), places).cast("double")


def average(total: Column, count: Column) -> Column:
    """Mean from an exact total and a count; NULL over no rows.

    Dividing once at the end keeps the result independent of the order in which partitions were merged, which a
    running double sum is not; dividing decimals leaves nothing for a later rounding to trip over.
    """
    return F.try_divide(total.cast(_EXACT), count).cast("double")
