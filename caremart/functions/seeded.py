"""Repeatable stand-ins for random attributes: a seeded hash of the natural key.

The value of a member does not change with the partitioning, a retry or a later run.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _bucket(keys: tuple[Column, ...], buckets: int, seed: int) -> Column:
    """The first 32 bits of the MD5 of the key's texts and the seed: a number any database can check."""
    digest = F.md5(F.concat_ws("|", *[F.coalesce(k.cast("string"), F.lit("")) for k in keys], F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % buckets


def seeded_uniform(low: float, high: float, *keys: Column, seed: int = 0, digits: int = 2) -> Column:
    """A number in [low, high] with ``digits`` decimals."""
    steps = 10**digits
    return F.round(F.lit(low) + _bucket(keys, int((high - low) * steps) + 1, seed) / steps, digits)


def seeded_integer(low: int, high: int, *keys: Column, seed: int = 0) -> Column:
    """An integer in [low, high)."""
    return (F.lit(low) + _bucket(keys, high - low, seed)).cast("int")


def seeded_choice(options: tuple[str, ...], *keys: Column, seed: int = 0) -> Column:
    """One of ``options``."""
    return F.element_at(F.array(*[F.lit(o) for o in options]), (_bucket(keys, len(options), seed) + 1).cast("int"))
