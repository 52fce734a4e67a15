"""Daily series per group: aggregate, close gaps, carry forward, trend."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def daily(df: DataFrame, group: Sequence[str], day: str, how: str = "mean", **measures: Column | str) -> DataFrame:
    """One row per group and day: mean or sum of each measure (``name=column``).

    The aggregate is partial before the shuffle, so a group holding most rows is no hot spot.
    """
    combine = {"mean": F.avg, "sum": F.sum}[how]
    return df.groupBy(*group, day).agg(*[combine(c).alias(name) for name, c in measures.items()])


def densify(series: DataFrame, group: Sequence[str], day: str, values: Sequence[str], min_days: int = 0) -> DataFrame:
    """One row for every calendar day between the first and last day of each group.

    Missing values take the last known one. Each observed day is repeated up to the day before
    the next one, so closing the gaps needs no calendar join: one window over the observed days
    (at most one row per group and day). Groups spanning fewer than ``min_days`` days are left out.
    """
    ordered = Window.partitionBy(*group).orderBy(day)
    whole = Window.partitionBy(*group)
    known = {v: F.last(v, ignorenulls=True).over(ordered.rowsBetween(Window.unboundedPreceding, 0)) for v in values}
    spans = series.withColumns(
        {
            **known,
            "_next": F.lead(day).over(ordered),
            "_span": F.datediff(F.max(day).over(whole), F.min(day).over(whole)) + 1,
        }
    ).where(F.col("_span") >= min_days)
    until = F.coalesce(F.date_sub("_next", 1), F.col(day))
    return spans.select(
        *group, F.explode(F.sequence(F.col(day), until, F.expr("INTERVAL 1 DAY"))).alias(day), *values
    )


def with_index(series: DataFrame, group: Sequence[str], day: str, name: str = "i") -> DataFrame:
    """0-based position in a gap-free series."""
    first = F.min(day).over(Window.partitionBy(*group))
    return series.withColumn(name, F.datediff(day, first))


def lagged(series: DataFrame, group: Sequence[str], day: str, value: str, lags: int) -> DataFrame:
    """First difference ``dz`` of the value and its ``lags`` predecessors ``dz_1`` … ``dz_n``."""
    ordered = Window.partitionBy(*group).orderBy(day)
    differenced = series.withColumn("dz", F.col(value) - F.lag(value, 1).over(ordered))
    return differenced.withColumns({f"dz_{k}": F.lag("dz", k).over(ordered) for k in range(1, lags + 1)})
