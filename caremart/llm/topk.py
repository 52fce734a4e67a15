"""Exact top-k search by term-at-a-time accumulation in blocks.

Vectors are rows of integer weights, one term per component. Queries and candidates are dealt into
blocks; a task holds one query block and one candidate block, turns the candidates into postings
(for each term the rows that have it, with their weights), and for each term scatters query weight
times posting weight into a dense array of scores. The k best of each row are taken by partition
selection, and the few survivors of all candidate blocks are merged.

Defined results: vectors that are null, empty or hold a null or non-finite component take no part, nor
do rows without an id. Rows that share an id stand as one, with the smallest of their vectors. Scores are 64-bit
sums, exact while |256 x| stays below 2^27 or so. Vectors of another length than a query's count
missing terms as zero. Other columns of the table are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows in one block; a task's score array has at most about this many squared cells.
QUERY_BLOCK, CANDIDATE_BLOCK = 1024, 4096

_SCHEMA = "query_id long, vec_id long, score long"


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, terms): floor(scale * x) of every component, one row an id, unusable vectors left out."""
    x = F.col(vector_col).cast("array<double>")
    usable = F.col(id_col).isNotNull() & (F.size(x) > 0) & F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    rows = vectors.where(usable).select(
        F.col(id_col).cast("long").alias("id"), F.transform(x, lambda v: F.floor(v * scale).cast("long")).alias("terms"))
    return rows.groupBy("id").agg(F.min("terms").alias("terms"))


def _scores(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Dense scores (queries x candidates), one term at a time."""
    scores = np.zeros((len(queries), len(candidates)), np.int64)
    for term in range(min(queries.shape[1], candidates.shape[1])):
        weights, postings = queries[:, term], candidates[:, term]
        having, rows = np.flatnonzero(weights), np.flatnonzero(postings)
        if len(having) == len(weights) and len(rows) == len(postings):
            scores += np.multiply.outer(weights, postings)
        elif len(having) and len(rows):
            scores[np.ix_(having, rows)] += np.multiply.outer(weights[having], postings[rows])
    return scores


def _matrix(terms: pd.Series) -> np.ndarray:
    width = max(map(len, terms))
    if all(len(t) == width for t in terms):
        return np.stack(terms.to_list()).astype(np.int64)
    out = np.zeros((len(terms), width), np.int64)
    for row, t in enumerate(terms):
        out[row, :len(t)] = t
    return out


def _best_of_block(k: int):
    def best(pdf_q: pd.DataFrame, pdf_c: pd.DataFrame) -> pd.DataFrame:
        if pdf_q.empty or pdf_c.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        pdf_c = pdf_c.sort_values("id")
        ids, query_ids = pdf_c["id"].to_numpy(), pdf_q["id"].to_numpy()
        candidates, found = _matrix(pdf_c["terms"]), []
        for start in range(0, len(pdf_q), 256):
            queries = pdf_q.iloc[start:start + 256]
            scores = _scores(_matrix(queries["terms"]), candidates)
            for query_id, row in zip(query_ids[start:start + 256], scores, strict=True):
                others = ids != query_id
                own, row = (ids, row) if others.all() else (ids[others], row[others])
                if len(row) > k:
                    bar = np.partition(row, len(row) - k)[len(row) - k]
                    above = np.flatnonzero(row > bar)
                    # Rows stand in the order of their ids, so the first ties are the smaller ids.
                    picked = np.concatenate([above, np.flatnonzero(row == bar)[:k - len(above)]])
                else:
                    picked = np.arange(len(row))
                found.append((np.full(len(picked), query_id), own[picked], row[picked]))
        cols = [np.concatenate(c) for c in zip(*found, strict=True)]
        return pd.DataFrame({"query_id": cols[0], "vec_id": cols[1], "score": cols[2]})

    return best


def top_k(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of every query, ties to smaller ids.

    Both inputs are (id, terms) as of :func:`integer_vectors`. Every query block meets every candidate block.
    """
    blocks = lambda df, rows: max(1, -(-df.count() // rows))
    n_q, n_c = blocks(queries, QUERY_BLOCK), blocks(candidates, CANDIDATE_BLOCK)
    deal = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    span = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = queries.select("id", "terms", deal(n_q).alias("qb"), span(n_c).alias("cb"))
    right = candidates.select("id", "terms", deal(n_c).alias("cb"), span(n_q).alias("qb"))
    found = left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb")).applyInPandas(_best_of_block(k), _SCHEMA)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def search(vectors: DataFrame, is_query: F.Column, k: int = 5, scale: int = 256,
           id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k best partners of every row that ``is_query`` (over column ``id``) marks, among all other rows."""
    rows = integer_vectors(vectors, id_col, vector_col, scale)
    return top_k(rows.where(is_query), rows, k)
