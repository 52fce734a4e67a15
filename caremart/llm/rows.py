"""Whole rows of any columns, and rows that share an id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caremart.session import materialise

#: Keys from here on are given to further texts under one id.
_FURTHER = 1 << 62


def quoted(name: str) -> Column:
    """A column by its exact name, dots and quotes included."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_row(df: DataFrame) -> Column:
    """All columns as the struct ``row``."""
    return F.struct(*[quoted(c).alias(c) for c in df.columns]).alias("row")


def ids_of_unlike_texts(rows: DataFrame) -> DataFrame:
    """(id, least): the ids of ``rows`` (id, text) under which different texts stand, with the least hash of a text. Mostly none."""
    hashed = rows.select("id", F.xxhash64("text").alias("h"))
    ends = hashed.groupBy("id").agg(F.min("h").alias("least"), F.max("h").alias("most"))
    return materialise(ends.where("least < most").select("id", "least"), "shared-ids")


def text_keys(rows: DataFrame) -> DataFrame:
    """``rows`` with ``key``, a number for each id and text: the id itself, or for further texts under one id a number beyond 2 ** 62."""
    shared = ids_of_unlike_texts(rows)
    if shared.isEmpty():
        return rows.withColumn("key", F.col("id"))
    own = F.xxhash64("text")
    further = F.lit(_FURTHER) + F.pmod(F.xxhash64("id", own), F.lit(_FURTHER))
    return rows.join(shared, "id", "left").withColumn(
        "key", F.when(F.col("least").isNotNull() & (own != F.col("least")), further).otherwise(F.col("id"))).drop("least")
