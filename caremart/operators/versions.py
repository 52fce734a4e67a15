"""Versioned dimensions: members that keep their keys, versions that open and close, and lookups as of a date."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caremart.operators.keys import dense_key
from caremart.session import fits_broadcast, materialise

VERSION_COLUMNS = ("date_debut_validite", "date_fin_validite", "est_actif", "version_ligne")

#: Stands for a missing date in lookups: only versions that are still open hold then.
_NO_DATE = dt.date(9999, 12, 31)


def _columns(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def _same(left: str, right: str, columns: Sequence[str]) -> Column:
    """Null-safe equality of all columns: an equi-join key, in which a missing value is a value like any other."""
    return reduce(and_, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns])


def digest(attributes: Sequence[str]) -> Column:
    """SHA-256 of the attributes with their names, missing values told apart: rows differ if their digests do."""
    return F.sha2(F.to_json(F.struct(*attributes)), 256) if attributes else F.lit("")


def new_members(stored: DataFrame, incoming: DataFrame, natural: str | Sequence[str]) -> DataFrame:
    """Rows of ``incoming`` whose natural key is not in ``stored``. A missing value in a key is a value like any other."""
    keys = _columns(natural)
    return incoming.alias("n").join(stored.select(*keys).alias("s"), _same("n", "s", keys), "left_anti")


def append_members(
    stored: DataFrame, incoming: DataFrame, surrogate: str, natural: str | Sequence[str], order: Sequence[str], highest: int
) -> DataFrame:
    """The new members of ``incoming``, numbered behind the ``highest`` stored key in ``order``."""
    numbered = dense_key(new_members(stored, incoming, natural), order, "_new", highest + 1)
    kind = incoming.schema[surrogate].dataType
    return numbered.withColumn(surrogate, F.col("_new").cast(kind)).select(*incoming.columns)


def latest_members(incoming: DataFrame, surrogate: str, natural: str | Sequence[str]) -> DataFrame:
    """One row per natural key: the one with the highest surrogate. Only keys are aggregated."""
    last = incoming.groupBy(*_columns(natural)).agg(F.max(surrogate).alias(surrogate)).select(surrogate)
    return incoming.join(last, surrogate, "left_semi").select(*incoming.columns)


def merge_versions(
    current: DataFrame,
    incoming: DataFrame,
    surrogate: str,
    natural: str | Sequence[str],
    attributes: Sequence[str],
    run_date: dt.date,
    carried: Sequence[str] = (),
) -> DataFrame:
    """The dimension after the incoming extract.

    Closed versions and active rows that are unchanged or absent from the extract stay as they
    are; a changed member's active row is closed on ``run_date`` and gets a next version; new
    members get version 1. A version holds from its first day until before its last. A member that changed again on the day
    its version opened gets the new attributes in place, so a corrected extract of the same day leaves no empty version, and a repeated one changes nothing. New
    rows take fresh keys above the highest one, ordered by natural key. ``incoming`` holds one row per natural key, which may be several
    columns; a missing value in a key is a value like any other. ``carried`` columns are not compared: a
    member keeps those of its first version.

    Members are compared by natural key and digest; whole rows move only for the few that changed.
    """
    keys, today = _columns(natural), F.lit(run_date).cast("date")
    columns = [surrogate, *keys, *attributes, *carried, *VERSION_COLUMNS]
    current = current.select(*columns)
    sent = incoming.select(*keys, *attributes, *carried)
    held = current.where("est_actif").select(
        *keys, digest(attributes).alias("_digest"), F.col("version_ligne").alias("_version"), F.col("date_debut_validite").alias("_since"),
        *[F.col(c).alias(f"_{c}") for c in carried])
    compared = sent.select(*keys, digest(attributes).alias("_digest")).alias("n").join(held.alias("c"), _same("n", "c", keys), "left")
    known = F.col("c._version").isNotNull()
    changes = compared.where(~known | (F.col("n._digest") != F.col("c._digest"))).select(
        *[F.col(f"n.{k}").alias(k) for k in keys], known.alias("_known"), "c._version",
        F.coalesce(known & (F.col("c._since") == today), F.lit(False)).alias("_corrected"), *[f"c._{c}" for c in carried])
    changes = materialise(changes, "changed-members")
    # Few members change between extracts; where many do, both sides are shuffled.
    small = F.broadcast if fits_broadcast(changes) else lambda df: df

    touched = current.alias("c").join(
        small(changes.where("_known").select(*keys, "_corrected")).alias("x"), _same("c", "x", keys) & F.col("c.est_actif"), "left")
    corrected, closes = F.coalesce("x._corrected", F.lit(False)), F.coalesce(~F.col("x._corrected"), F.lit(False))
    kept = touched.where(~corrected).select(
        *[F.col(f"c.{c}").alias(c) for c in columns if c not in ("date_fin_validite", "est_actif")],
        F.when(closes, today).otherwise(F.col("c.date_fin_validite")).alias("date_fin_validite"),
        (F.col("c.est_actif") & ~closes).alias("est_actif"),
    ).select(*columns)
    fresh = sent.alias("n").join(small(changes).alias("x"), _same("n", "x", keys))
    own = [F.col(f"n.{c}").alias(c) for c in (*keys, *attributes)]
    first = [F.when(F.col("x._known"), F.col(f"x._{c}")).otherwise(F.col(f"n.{c}")).alias(c) for c in carried]
    # The row that is corrected keeps its key, days and number.
    in_place = fresh.where("x._corrected").select(*own, *first).alias("n").join(
        current.where("est_actif").select(surrogate, *keys, *VERSION_COLUMNS).alias("c"), _same("n", "c", keys)
    ).select(*[F.col(f"{'c' if c == surrogate or c in VERSION_COLUMNS else 'n'}.{c}").alias(c) for c in columns])
    opened = fresh.where("NOT x._corrected").select(
        *own, *first, F.when(F.col("x._known"), F.col("x._version") + 1).otherwise(F.lit(1)).alias("version_ligne"))
    highest = current.agg(F.coalesce(F.max(surrogate), F.lit(0)).alias("_top")).scalar()
    added = {
        surrogate: (F.col("_new") + highest).cast(current.schema[surrogate].dataType),
        "date_debut_validite": today, "date_fin_validite": F.lit(None).cast("date"), "est_actif": F.lit(True),
    }
    numbered = dense_key(opened, keys, "_new").withColumns(added).select(*columns)
    return kept.unionByName(in_place).unionByName(numbered)


def version_table(dim: DataFrame, keys: dict[str, Column], surrogate: str) -> DataFrame:
    """One row per normalised natural key with its versions, in ``_versions``: first day, last day (not included), key.

    A member counts as known from the beginning: its first version has no first day. Versions of one member are few.
    """
    version = F.struct(F.col("date_debut_validite").alias("since"), F.col("date_fin_validite").alias("until"), F.col(surrogate).alias("sk"))
    ordered = (
        dim.select(*[expr.alias(k) for k, expr in keys.items()], version.alias("_v"))
        .where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list("_v")).alias("_versions"))
    )
    first = F.get(F.col("_versions"), 0)["since"]
    since = lambda v: F.when(v["since"] > first, v["since"])
    return ordered.withColumn(
        "_versions", F.transform("_versions", lambda v: F.struct(since(v).alias("since"), v["until"].alias("until"), v["sk"].alias("sk"))))


def version_at(versions: Column, day: Column) -> Column:
    """The key of the version that holds on ``day``, the highest if several do; a missing day asks for the open version."""
    at = F.coalesce(day, F.lit(_NO_DATE))
    holds = lambda v: (v["since"].isNull() | (v["since"] <= at)) & (v["until"].isNull() | (at < v["until"]))
    return F.array_max(F.transform(F.filter(versions, holds), lambda v: v["sk"]))


def one_active(current: DataFrame, surrogate: str, natural: str | Sequence[str], run_date: dt.date) -> DataFrame:
    """``current`` with one active row per natural key: of several, all but the one with the highest key are closed on ``run_date``."""
    keys, today = _columns(natural), F.lit(run_date).cast("date")
    several = current.where("est_actif").groupBy(*keys).agg(F.max(surrogate).alias("_last"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    joined = current.alias("c").join(several.alias("x"), _same("c", "x", keys) & F.col("c.est_actif"), "left")
    closes = F.coalesce(F.col(f"c.{surrogate}") < F.col("x._last"), F.lit(False))
    changed = {"date_fin_validite": F.when(closes, today).otherwise(F.col("c.date_fin_validite")), "est_actif": F.col("c.est_actif") & ~closes}
    return joined.select(*[changed.get(c, F.col(f"c.{c}")).alias(c) for c in current.columns])
