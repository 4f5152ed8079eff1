"""Hashing and arithmetic that give the same value on every engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296


def hash32(seed: str, *cols: Column | str) -> Column:
    """First 32 bits of ``md5('<seed>:<c1>:<c2>…')`` as BIGINT.

    Used for every sample, split, fold and draw: it needs no state, so a
    re-run task draws the same values again.
    """
    parts = [F.lit(seed)] + [F.col(c) if isinstance(c, str) else c for c in cols]
    text = F.concat_ws(":", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def uniform(seed: str, *cols: Column | str) -> Column:
    """Uniform draw in [0, 1) from :func:`hash32`."""
    return hash32(seed, *cols) / F.lit(float(TWO_32))


def tenths_half_up(hundredths: Column) -> Column:
    """Round a whole number of hundredths to tenths, half up, without ever
    holding a binary fraction."""
    return F.floor((hundredths + 5) / 10).cast("bigint")


def truthy(*cols: Column) -> Column:
    """First value that is neither null nor the empty string."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols])
