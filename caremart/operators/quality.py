"""Declared constraints as checks that return the violations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ForeignKey:
    """A column of ``child`` whose values stand in a column of ``parent``."""

    child: str
    column: str
    parent: str
    parent_column: str


def duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values held by more than one row, with the number of rows."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that break a rule, one output row per broken rule, in one pass.

    A rule holds unless it is false, so NULL passes as in SQL constraints.
    """
    broken = F.array(*[F.when(~rule, F.lit(name)) for name, rule in rules.items()])
    return df.withColumn("rule", F.explode(F.array_compact(broken)))


def violation_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Number of violations per rule (zero included): one scan, one partial aggregate."""
    counted = df.agg(*[F.count_if(~rule).alias(name) for name, rule in rules.items()])
    pairs = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"`{name}`").alias("violations")) for name in rules])
    return counted.select(F.inline(pairs))


def not_null_rules(columns: Sequence[str]) -> dict[str, Column]:
    return {f"{c} not null": F.col(c).isNotNull() for c in columns}


def length_rules(widths: Mapping[str, int]) -> dict[str, Column]:
    return {f"{c} length <= {n}": F.length(c) <= n for c, n in widths.items()}


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Foreign-key values without a parent row, with the number of child rows; NULL passes.

    The child is reduced to one row per value before the anti join, so a hot value (the default
    key) never reaches the shuffle as more than one row per input partition.
    """
    values = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    return values.join(parent.select(F.col(parent_column).alias("value")), "value", "left_anti")


def stacked_orphans(tables: Mapping[str, DataFrame], keys: Sequence[ForeignKey]) -> DataFrame:
    """(child, column, violations) of all foreign keys at once, zero included; NULL passes.

    Each child is read once: its rows become (parent, key, value) pairs, which are reduced to one row per value before
    they move, so a hot value (the default key) reaches the shuffle as one row per input partition. All pairs meet the values of all
    parents in one anti join. Values are compared as 64-bit integers.
    """
    by_child: dict[str, list[ForeignKey]] = {}
    for key in keys:
        by_child.setdefault(key.child, []).append(key)
    pairs = []
    for child, own in by_child.items():
        cells = [F.struct(F.lit(k.parent).alias("parent"), F.lit(k.column).alias("column"), F.col(k.column).cast("long").alias("value"))
                 for k in own]
        pairs.append(
            tables[child].select(F.inline(F.array(*cells))).where("value IS NOT NULL").groupBy("parent", "column", "value")
            .agg(F.count(F.lit(1)).alias("n")).withColumn("child", F.lit(child)))
    parents = {(k.parent, k.parent_column) for k in keys}
    known = [tables[p].select(F.lit(p).alias("parent"), F.col(c).cast("long").alias("value")) for p, c in sorted(parents)]
    lost = reduce(DataFrame.unionByName, pairs).join(reduce(DataFrame.unionByName, known), ["parent", "value"], "left_anti")
    found = lost.groupBy("child", "column").agg(F.sum("n").alias("violations"))
    spark = next(iter(tables.values())).sparkSession
    names = spark.createDataFrame([(k.child, k.column) for k in keys], "child string, column string")
    # One row for each key.
    return names.join(F.broadcast(found), ["child", "column"], "left").select(
        "child", "column", F.coalesce("violations", F.lit(0)).alias("violations"))


def stacked_duplicates(tables: Mapping[str, DataFrame], keys: Sequence[tuple[str, str]]) -> DataFrame:
    """(table_name, column, violations): rows that share their value in a unique column, for all columns at once, zero included; NULLs differ.

    Values are compared as text; one aggregate serves all columns.
    """
    cells = [tables[t].select(F.lit(t).alias("table_name"), F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
             .where("value IS NOT NULL") for t, c in keys]
    counts = reduce(DataFrame.unionByName, cells).groupBy("table_name", "column", "value").agg(F.count(F.lit(1)).alias("n"))
    shared = F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0))
    found = counts.groupBy("table_name", "column").agg(shared.alias("violations"))
    spark = next(iter(tables.values())).sparkSession
    names = spark.createDataFrame(list(keys), "table_name string, column string")
    # One row for each column.
    return names.join(F.broadcast(found), ["table_name", "column"], "left").select(
        "table_name", "column", F.coalesce("violations", F.lit(0)).alias("violations"))


def fill_declared_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Declared column defaults for missing values; a declared column that is absent is added."""
    filled = {
        c: F.coalesce(F.col(c), F.lit(value)) if c in df.columns else F.lit(value) for c, value in defaults.items()
    }
    return df.withColumns(filled)
