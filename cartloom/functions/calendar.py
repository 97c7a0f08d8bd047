"""Calendar parts of a timestamp."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_weekday(ts: Column) -> Column:
    return F.weekday(ts) + F.lit(1)


def day_frame(hour: Column) -> Column:
    """0 morning [6,12), 1 afternoon [12,18), 2 evening [18,24), 3 night."""
    return (
        F.when(hour.between(6, 11), 0)
        .when(hour.between(12, 17), 1)
        .when(hour >= 18, 2)
        .otherwise(3)
    )
