"""Seeded pseudo-random keys that any engine can recompute."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def draw(*parts: Column | str, seed: int) -> Column:
    """md5 over the parts and the seed: a fixed, evenly spread order of rows."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(F.concat_ws("|", *[c.cast("string") for c in cols], F.lit(str(seed))))


def draw_number(digest: Column) -> Column:
    """First 32 bits of the digest as a whole number."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def draw_slot(digest: Column) -> Column:
    """First 16 bits of the digest: one of 65,536 equally filled slots."""
    return F.conv(F.substring(digest, 1, 4), 16, 10).cast("long")
