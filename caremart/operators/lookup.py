"""Foreign-key resolution: a left join onto one row per natural key, with a default key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caremart.operators.keys import POSITION
from caremart.operators.versions import version_at, version_table
from caremart.session import fits_broadcast, materialise

#: Key given to rows whose natural key is unknown.
DEFAULT_KEY = 1

#: Parts into which all keys are hashed to find the few that may be hot.
COUNTED_PARTS = 1 << 16

#: A key is hot when it holds more than 1/HOT_PARTS of the rows, so fewer than HOT_PARTS are. Each is spread over
#: so many salts that none holds more than that share.
HOT_PARTS = 1000


def lookup_table(dim: DataFrame, keys: dict[str, Column], surrogate: str) -> DataFrame:
    """One row per normalised natural key; of duplicates the highest surrogate stays."""
    return (
        dim.select(*[expr.alias(k) for k, expr in keys.items()], F.col(surrogate))
        .where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
        .groupBy(*keys)
        .agg(F.max(surrogate).alias(surrogate))
    )


def _known(keys: Sequence[str]) -> Column:
    """Whether all key columns have a value."""
    return reduce(and_, [F.col(k).isNotNull() for k in keys])


def hot_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, _salts): the keys that hold more than 1/``HOT_PARTS`` of the rows, with the number of parts to spread each over.

    Written once; fewer than ``HOT_PARTS`` values can pass the threshold. Rows with a missing key are not counted as a key.
    First the rows of ``COUNTED_PARTS`` parts of all keys are counted, a small table in each task. A hot key makes its part pass
    the threshold too, so single keys are counted in the parts that do, of which there are fewer than ``HOT_PARTS``.
    """
    part = F.when(_known(keys), F.pmod(F.xxhash64(*keys), F.lit(COUNTED_PARTS)))
    sizes = materialise(rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n")), "key-parts")
    total = sizes.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    crowded = sizes.where(F.col("_part").isNotNull() & (F.col("_n") * HOT_PARTS > total)).select("_part")
    candidates = rows.withColumn("_part", part).join(F.broadcast(crowded), "_part", "left_semi")
    counts = candidates.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.where(F.col("_n") * HOT_PARTS > total)
    return materialise(hot.select(*keys, F.ceil(F.col("_n") * HOT_PARTS / F.lit(max(total, 1))).cast("int").alias("_salts")), "hot-keys")


def salted_left_join(
    rows: DataFrame, table: DataFrame, keys: Sequence[str], counted: DataFrame | None = None
) -> DataFrame:
    """Left shuffle join in which no key meets more than about 1/``HOT_PARTS`` of the rows in one task.

    A hot key is spread over salts by its own count, and only its row of ``table`` is repeated, once for each salt. Rows with a
    missing key match nothing: they are spread over ``HOT_PARTS`` salts. (Kept apart and added behind the join, they would
    read the rows twice, and a chain of lookups would double with each.) The hot keys are few enough to
    broadcast to both sides. They are counted in ``counted`` (``rows`` unless given): a cheaper DataFrame
    with the same keys, such as the source the rows were derived from.
    """
    keys, columns = list(keys), rows.columns
    counted, by = rows if counted is None else counted, keys
    if all(dict(df.dtypes)[k] == "string" for df in (rows, table, counted) for k in keys):
        # Texts are counted and told hot by a hash of 8 bytes; texts that share one are only spread alike.
        by, mark = ["_mark"], F.when(_known(keys), F.xxhash64(*keys))
        rows, table, counted = (df.withColumn("_mark", mark) for df in (rows, table, counted))
    hot = F.broadcast(hot_keys(counted, by))
    salts = F.when(_known(keys), F.coalesce("_salts", F.lit(1))).otherwise(F.lit(HOT_PARTS))
    # A row's number tells it apart; other columns would be read only to be hashed.
    told = [POSITION] if POSITION in columns else columns
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in told]), salts).cast("int")
    salted_rows = rows.join(hot, by, "left").withColumn("_salt", spread).drop("_salts", "_mark")
    repeats = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    salted_table = table.join(hot, by, "left").withColumn("_salt", F.explode(repeats)).drop("_salts", "_mark")
    return salted_rows.join(salted_table, [*keys, "_salt"], "left").drop("_salt")


def resolve(
    rows: DataFrame,
    dim: DataFrame,
    surrogate: str,
    row_keys: Sequence[Column],
    dim_keys: Sequence[Column],
    default: int | None = DEFAULT_KEY,
    alias: str | None = None,
    small: bool | None = None,
    counted: DataFrame | None = None,
    at: Column | None = None,
) -> DataFrame:
    """Add the surrogate key of ``dim`` to ``rows``; NULL and unknown keys get ``default``.

    ``small`` says whether the dimension fits a broadcast. Left out, its keys are measured; beyond
    the limit its distinct keys are written and measured, and beyond that the join shuffles with salted hot keys, so neither
    size nor skew decides the result.
    ``default=None`` keeps NULL for unresolved rows. ``counted`` may name a cheaper DataFrame with
    the columns of ``row_keys`` to find hot keys in. With ``at``, a date of the rows, the version of a member that holds then is
    taken (see ``versions.version_table``); a member's versions travel together, so the join stays one on equal keys.
    """
    names = [f"_k{i}" for i in range(len(row_keys))]
    if at is None:
        table = lookup_table(dim, dict(zip(names, dim_keys)), surrogate).withColumnRenamed(surrogate, "_sk")
    else:
        table = version_table(dim, dict(zip(names, dim_keys)), surrogate)
    keyed = rows.withColumns(dict(zip(names, row_keys)))
    if small is None:
        small = fits_broadcast(dim.select(*[expr.alias(n) for n, expr in zip(names, dim_keys)], surrogate))
        if not small:
            table = materialise(table, "lookup")
            small = fits_broadcast(table)
    if small:
        joined = keyed.join(F.broadcast(table), names, "left")
    else:
        if counted is not None:
            counted = counted.select(*[expr.alias(name) for name, expr in zip(names, row_keys)])
        joined = salted_left_join(keyed, table, names, counted)
    found = F.col("_sk") if at is None else version_at(F.col("_versions"), at)
    key = found if default is None else F.coalesce(found, F.lit(default))
    return joined.withColumn(alias or surrogate, key.cast("int")).drop(*names, "_sk", "_versions")
