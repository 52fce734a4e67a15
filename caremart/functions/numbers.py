"""Number extraction, coercion and guards."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the first number inside a text.
NUMBER_PATTERN = r"[-+]?\d*\.?\d+"
# Plain decimal text. A bare cast would also take Java forms such as "1d".
DECIMAL_TEXT = r"(?i)^\s*[-+]?(\d+\.?\d*|\.\d+)(e[-+]?\d+)?\s*$"
INFINITE_TEXT = r"(?i)^\s*[-+]?inf(inity)?\s*$"

# Fixed value: birth weights from here on are taken as entry errors.
WEIGHT_LIMIT = 10000


def extract_number(text: Column) -> Column:
    """The first number in the text as double, NULL when there is none."""
    return F.regexp_extract(text, NUMBER_PATTERN, 0).try_cast("double")


def to_number(text: Column) -> Column:
    """The whole text as double; anything else is NULL."""
    return F.when(text.rlike(DECIMAL_TEXT) | text.rlike(INFINITE_TEXT), text.try_cast("double"))


def truncate_int(number: Column, default: int | None = None) -> Column:
    """Truncate toward zero to int; missing or out-of-range values take ``default``."""
    whole = number.try_cast("int")
    return whole if default is None else F.coalesce(whole, F.lit(default))


def clamp_weight(weight: Column) -> Column:
    """The weight if it is known and plausible, else 0.0."""
    return F.when(weight.isNotNull() & (weight < WEIGHT_LIMIT), weight).otherwise(F.lit(0.0))


def clamp_unit(rate: Column) -> Column:
    """Clip a known rate to [0, 1]; NULL stays NULL."""
    return F.when(rate.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), rate)))


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """Floating division that is NULL for a zero denominator."""
    return numerator.cast("double") / F.nullif(denominator, F.lit(0))


def mean_of_valid(*values: Column, default: float) -> Column:
    """Mean over the non-missing values, ``default`` when all are missing."""
    known = F.filter(F.array(*values), lambda v: v.isNotNull() & ~F.isnan(v))
    start = F.struct(F.lit(0.0).alias("total"), F.lit(0).alias("n"))
    return F.aggregate(
        known,
        start,
        lambda acc, v: F.struct((acc["total"] + v).alias("total"), (acc["n"] + 1).alias("n")),
        lambda acc: F.when(acc["n"] > 0, acc["total"] / acc["n"]).otherwise(F.lit(default)),
    )


def round_half_even(number: Column, digits: int = 2) -> Column:
    return F.bround(number, digits)
