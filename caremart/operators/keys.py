"""First-seen members and dense surrogate keys without a single-partition sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caremart.session import materialise

#: 0-based row number of a source row; every standardised source carries it.
POSITION = "src_row"

#: Rows that one task numbers at most (about), and rows whose order gives the bounds of larger inputs.
ROWS_PER_RANGE = 1_000_000
BOUND_SAMPLE = 10_000


def first_seen(df: DataFrame, columns: Sequence[str], position: str = POSITION) -> DataFrame:
    """Distinct values over ``columns`` with the position of their first row.

    NULLs count as one value. The aggregate runs before the shuffle, so a hot value costs one
    row per input partition.
    """
    return df.groupBy(*columns).agg(F.min(position).alias(position))


def keep_first(df: DataFrame, key: str, position: str = POSITION) -> DataFrame:
    """The first row of each ``key`` in source order (NULL keys form one group); ``position`` is unique.

    Only keys and positions are aggregated. The rows themselves are matched by position, a key without hot values.
    """
    firsts = df.groupBy(key).agg(F.min(position).alias(position)).select(position)
    return df.join(firsts, position, "left_semi").select(*df.columns)


def _bounds(stored: DataFrame, order: Sequence[Column], ranges: int) -> list[Column]:
    """Places in ``order`` that part the rows into about equal ranges, from the ``BOUND_SAMPLE`` rows with the smallest hash."""
    names = [f"o{i}" for i in range(len(order))]
    keys = stored.select(*[o.alias(n) for o, n in zip(order, names)])
    sample = keys.orderBy(F.xxhash64(*names)).limit(BOUND_SAMPLE).orderBy(*names).collect()
    step = -(-len(sample) // ranges)
    return [
        F.struct(*[F.lit(row[n]).cast(keys.schema[n].dataType).alias(n) for n in names]) for row in sample[step::step]
    ]


def _range_of(place: Column, bounds: Sequence[Column], low: int = 0) -> Column:
    """How many bounds lie at or below a place, by halving."""
    if not bounds:
        return F.lit(low)
    middle = len(bounds) // 2
    return F.when(place < bounds[middle], _range_of(place, bounds[:middle], low)).otherwise(
        _range_of(place, bounds[middle + 1:], low + middle + 1))


def dense_key(df: DataFrame, order: Sequence[str | Column], name: str, start: int = 1) -> DataFrame:
    """Number the rows ``start``, ``start + 1``, … in ``order``, on any number of partitions.

    The input is computed once and written. Up to ``ROWS_PER_RANGE`` rows, which the files say, are
    numbered by one task. More are parted into ranges at bounds taken from a bounded sample of the written
    ``order``; each range is numbered by itself and shifted by the rows before it, counted from the written rows.
    ``order`` must be unique per row; no columns of it may be structs.
    """
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    columns = df.columns
    stored = materialise(df, name)
    ranges = -(-stored.count() // ROWS_PER_RANGE)
    before = F.lit(0)
    if ranges <= 1:
        ranged = stored.withColumn("_range", F.lit(0))
    else:
        place = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
        ranged = stored.withColumn("_range", _range_of(place, _bounds(stored, order, ranges)))
        counts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
        earlier = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        # One row for each range.
        shifts = counts.select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_shift"))
        ranged, before = ranged.join(F.broadcast(shifts), "_range"), F.col("_shift")
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return ranged.withColumn(name, (before + place + F.lit(start - 1)).cast("long")).select(name, *[F.col(f"`{c}`") for c in columns])


def number_members(df: DataFrame, columns: Sequence[str], name: str, start: int = 1,
                   position: str = POSITION) -> DataFrame:
    """``first_seen`` members with a dense key in first-seen order (values break ties)."""
    return dense_key(first_seen(df, columns, position), [position, *columns], name, start)
