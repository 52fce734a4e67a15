"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caremart.session import materialise


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all texts one after another, start of each text and the end of the last, is null)."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0], np.asarray(column.is_null())


def text_slices(batch: pa.RecordBatch, name: str, limit: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``limit`` bytes of text, at least one row each, so that memory
    depends on the longest text and not on the number of rows."""
    column = batch.column(name)
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(lengths) // limit
    edges = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *edges], [*edges, len(batch)], strict=True):
        if b > a:
            yield batch.slice(a, b - a)


_keepers: list[Callable] = []


def kept_by_process(make: Callable) -> Callable:
    """``make`` with its last results kept by the process for its later tasks, until a task of another operator calls ``release_kept``."""
    keeper = lru_cache(maxsize=2)(make)
    _keepers.append(keeper)
    return keeper


def release_kept() -> None:
    """Drop what tasks of other operators left in this process: a worker serves all stages, and else holds their tables on."""
    held = [keeper for keeper in _keepers if keeper.cache_info().currsize]
    for keeper in held:
        keeper.cache_clear()
    if held:
        # Freed memory goes back to the machine.
        for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
            pool.release_unused()


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def binaries(values: list[bytes] | np.ndarray) -> pa.Array:
    return pa.array(values, pa.binary())


def frequent(groups: DataFrame, copies: str, total: int) -> DataFrame:
    """The groups with over a thousandth of all rows: fewer than a thousand."""
    return groups.where(F.col(copies) * 1000 > total)


def joined(rows: DataFrame, values: DataFrame, keys: list[str], hot: DataFrame) -> DataFrame:
    """``rows`` left-joined with ``values`` (one row a key). The values of the ``frequent`` keys in ``hot`` are broadcast, so
    that the rows of none of them meet in one task."""
    few = F.broadcast(hot.select(*keys).distinct())
    there = rows.join(few, keys, "left_semi").join(F.broadcast(values.join(few, keys, "left_semi")), keys, "left")
    return there.unionByName(rows.join(few, keys, "left_anti").join(values, keys, "left"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that ``edges`` (a, b: long) reach, for every node of an edge.

    Each round hooks a node onto its neighbour with the smallest round-dependent hash, jumps once
    more, and replaces both ends of every edge. Random priorities shorten chains by a constant
    factor a round; stars collapse at once. Only a count reaches the driver.
    """
    edges = materialise(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = materialise(
        edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().withColumn("root", F.col("node")),
        "labels")
    number = 0
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        number += 1
        rank = lambda c, k=number: F.struct(F.xxhash64(c, F.lit(k)).alias("h"), c.alias("v"))
        hooked = both.groupBy(F.col("a").alias("x")).agg(F.min(rank(F.col("b"))).alias("best")).select(
            "x", F.least(rank(F.col("x")), "best")["v"].alias("p"))
        hooked = materialise(hooked, "hooked")
        jump = materialise(
            hooked.join(hooked.select(F.col("x").alias("p"), F.col("p").alias("q")), "p").select("x", "q"), "jump")
        labels = materialise(
            labels.join(jump.withColumnRenamed("x", "root"), "root", "left")
            .select("node", F.coalesce("q", "root").alias("root")), "labels")
        edges = materialise(
            edges.join(jump.select(F.col("x").alias("a"), F.col("q").alias("c")), "a")
            .join(jump.select(F.col("x").alias("b"), F.col("q").alias("d")), "b")
            .where("c <> d").select(F.least("c", "d").alias("a"), F.greatest("c", "d").alias("b")).distinct(), "edges")
    smallest = labels.groupBy("root").agg(F.min("node").alias("component"))
    return labels.join(smallest, "root").select("node", "component")
