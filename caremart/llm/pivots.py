"""Embedding near-duplicates by a pivot-permutation index.

Every vector is described by its ``LIST`` nearest of a few hundred reference points, in order. Inverted lists
(label, reference point) hold the vectors that name the point; two vectors are candidates if they share at
least ``SHARED`` points, and each candidate pair is verified once by its cosine in double precision, in the list of their
smallest shared point. Lists longer than ``BLOCK`` are cut into a grid of blocks, so no task holds a whole hot list.
A task never emits pairs: it emits, per vector, the number of its links and one edge to its component in the cell.

Equal vectors of a label are linked with each other and with the same others, so they stand as one class: the smallest id is indexed
with the number of its copies, and the members get their counts and component from it.

The reference points come from a bounded sample: ``sqrt(classes)`` vectors, 64 at least and ``MAX_PIVOTS`` at most, those with the
smallest hash of their id. Of points within a cosine of ``APART`` only the first stays: a group of near copies, whatever its share of
the rows, has one point, so its members name the same points and its lists are verified whole. All classes are indexed. Recall
against brute force is measured in tests/llm.

Defined results: a vector that is null, empty, zero or holds a null or non-finite component, or whose label
is null, links with nothing; so does a vector of another length. Rows that share an id stand as one, with
the smallest (label, vector). Rows without an id are left out. An empty table gives no rows. Other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caremart.llm.common import components, frequent, joined
from caremart.session import materialise

MAX_PIVOTS, LIST, SHARED, BLOCK = 4096, 8, 2, 1024
#: Cosine above which a sampled vector is no reference point beside an earlier one.
APART = 0.9


def _described(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(id, label, copies, unit, near): the unit vector and the ordered nearest reference points."""
    shared = vectors.sparkSession.sparkContext.broadcast(pivots)

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        refs = shared.value
        for pdf in batches:
            for length, same in pdf.groupby(pdf["vector"].map(len)):
                x = np.stack(same["vector"].to_list()).astype(np.float64)
                # The largest component first, so that neither tiny nor huge vectors lose their norm.
                x = x / np.abs(x).max(axis=1, keepdims=True)
                x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
                width = min(length, refs.shape[1])
                scores = x[:, :width] @ refs[:, :width].T
                order = np.argsort(-scores, axis=1, kind="stable")[:, :LIST].astype(np.int32)
                yield pd.DataFrame({"id": same["id"].to_numpy(), "label": same["label"].to_numpy(),
                                    "copies": same["copies"].to_numpy(), "unit": list(x), "near": list(order)})

    return vectors.mapInPandas(describe, "id long, label string, copies long, unit array<double>, near array<int>")


def _spread(sample: list[list[float]]) -> np.ndarray:
    """Unit reference points, in the order of the sample, no two of them within ``APART``; shorter ones end in zeros."""
    width = max(map(len, sample))
    points = np.stack([np.pad(np.array(v) / np.abs(v).max(), (0, width - len(v))) for v in sample])
    points /= np.sqrt((points * points).sum(axis=1, keepdims=True))
    kept = 0
    for point in points:
        if not (points[:kept] @ point > APART).any():
            points[kept] = point
            kept += 1
    return points[:kept]


def _joined(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest place in the component of each place, once the places ``i`` and ``j`` are joined."""
    while True:
        apart = root[i] != root[j]
        i, j = i[apart], j[apart]
        if not len(i):
            return root
        np.minimum.at(root, np.maximum(root[i], root[j]), np.minimum(root[i], root[j]))
        while (root != root[root]).any():
            root = root[root]


def _linked(threshold: float, needed: int):
    """Links of one cell of a list: counts per class, and an edge from each to its component. Candidates share ``needed`` points."""

    def links(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        _, pivot, first, second = key
        ids, copies, near = pdf["id"].to_numpy(), pdf["copies"].to_numpy(), np.stack(pdf["near"].to_list())
        block, sizes = pdf["block"].to_numpy(), pdf["unit"].map(len).to_numpy()
        counts, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
        points = np.unique(near)
        named, below = _named(near, points), int(np.searchsorted(points, pivot))
        for length in np.unique(sizes):
            rows = np.flatnonzero(sizes == length)
            a, b = rows[block[rows] == first], rows[block[rows] == second]
            x = np.stack(pdf["unit"].iloc[b].to_list()) if len(b) else None
            for start in range(0, len(a) if len(b) else 0, 256):
                own = a[start:start + 256]
                shared = named[own] @ named[b].T
                before = named[own][:, :below] @ named[b][:, :below].T
                candidate = (shared >= needed) & (before == 0)
                if first == second:
                    candidate &= ids[own][:, None] < ids[b][None, :]
                u = np.stack(pdf["unit"].iloc[own].to_list())
                cosine = u @ x.T
                linked = candidate & (cosine >= threshold + 1e-9)
                # The order in which a product adds up decides nothing: what is this close is added in one order.
                i, j = np.nonzero(candidate & (np.abs(cosine - threshold) < 1e-9))
                linked[i, j] = np.einsum("ij,ij->i", u[i], x[j]) >= threshold
                i, j = np.nonzero(linked)
                i, j = own[i], b[j]
                np.add.at(counts, i, copies[j])
                np.add.at(counts, j, copies[i])
                root = _joined(root, i, j)
        linked, members = np.flatnonzero(counts), np.flatnonzero(root != np.arange(len(root)))
        return pd.DataFrame({
            "a": np.concatenate([ids[linked], ids[members]]),
            "b": np.concatenate([ids[linked], ids[root[members]]]),
            "links": np.concatenate([counts[linked], np.zeros(len(members), np.int64)]),
        })

    return links


def _named(near: np.ndarray, points: np.ndarray) -> np.ndarray:
    """One row a vector, one column a reference point: 1 where the vector names the point."""
    out = np.zeros((len(near), len(points)), np.float32)
    out[np.arange(len(near))[:, None], np.searchsorted(points, near)] = 1
    return out


def _classes(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(a row (id, label, vector, copies) for equal vectors of a label, with their smallest id; (id, class, copies) of each
    row with copies; the frequent classes)."""
    classes = materialise(rows.groupBy("label", "vector").agg(F.min("id").alias("id"), F.count("*").alias("copies")), "classes")
    several = classes.where("copies > 1").select("label", "vector", F.col("id").alias("class"), "copies")
    hot = frequent(several, "copies", classes.agg(F.sum("copies")).first()[0] or 0)
    members = joined(rows, several, ["label", "vector"], hot).where("copies IS NOT NULL").select("id", "class", "copies")
    return classes, materialise(members, "members"), hot


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id",
                    vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every id of the table."""
    x = F.col(vector_col).cast("array<double>")
    rows = vectors.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), x.alias("vector"))
    rows = materialise(rows.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("r")).select("id", "r.*"), "vectors")
    usable = F.col("label").isNotNull() & (F.size("vector") > 0) & F.forall(
        "vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))) & F.exists("vector", lambda v: v != 0)
    classes, members, hot = _classes(rows.where(usable))
    wanted = min(MAX_PIVOTS, max(64, int(classes.count() ** 0.5)))
    # At most MAX_PIVOTS vectors, whatever the table's size.
    sample = [r.vector for r in classes.orderBy(F.xxhash64("id"), "id").limit(wanted).collect()]
    if not sample:
        return rows.select(F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"),
                           F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    pivots = _spread(sample)
    described = materialise(_described(classes, pivots), "described")
    lists = described.select("id", "copies", "label", "unit", "near", F.explode("near").alias("pivot"))
    sizes = lists.groupBy("label", "pivot").agg(F.count("*").alias("n")).where("n > 1").withColumn(
        "blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    sizes = materialise(sizes, "sizes")
    placed = lists.join(sizes, ["label", "pivot"]).withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    cells = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "id", "copies", "unit", "near", "label", "pivot", "block",
        F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"))
    found = materialise(cells.groupBy("label", "pivot", "first", "second").applyInPandas(
        _linked(threshold, min(SHARED, len(pivots))), "a long, b long, links long"), "links")
    counts = found.where("a = b").groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("n_links"))
    groups = components(found.where("a <> b").select("a", "b")).withColumnRenamed("node", "id")
    of_class = counts.join(groups, "id", "full").withColumnRenamed("id", "own")
    placed = rows.select("id").join(members, "id", "left").withColumn("own", F.coalesce("class", "id"))
    placed = joined(placed, of_class, ["own"], hot.select(F.col("class").alias("own")))
    component = F.coalesce("component", "own")
    return placed.select(
        F.col("id").alias("vec_id"), (F.coalesce("n_links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).cast("long").alias("n_links"),
        component.alias("component_id"), (component == F.col("id")).alias("kept"))
