"""Language identification as a mixture of languages.

One trigram model a language is counted from a bounded sample of labelled documents (``PER_LANGUAGE`` whole texts each, those with
the smallest hash of their id). A text is then taken as a mixture: expectation-maximisation estimates the share of each language
from the likelihoods of its trigrams, and the set of languages is chosen by penalised likelihood, half the logarithm of the
number of trigrams for each language beyond the first.

Trigrams run over letters in lower case; everything else is a single space. They are counted in ``BUCKETS`` hashed cells.

Defined results: a null text or one without letters is ``und`` with score 0, and so is every text if nothing can be learned
from. Equal shares go to the language that sorts first. A null lang teaches nothing. A row is a document even if its id
repeats or is null. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caremart.llm.common import text_slices
from caremart.session import materialise

PER_LANGUAGE, BUCKETS, SMOOTH, STEPS = 1000, 1 << 16, 500.0, 25


def _letters() -> np.ndarray:
    """1 for each code point that is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), np.bool_, sys.maxunicode + 1)


def trigrams(text: str | None, letter: np.ndarray) -> np.ndarray:
    """Hashed trigrams of a text, none if it has no letter."""
    if not text:
        return np.zeros(0, np.uint32)
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    alpha = letter[codes]
    if not alpha.any():
        return np.zeros(0, np.uint32)
    keep = alpha.copy()
    keep[1:] |= alpha[:-1]
    codes = np.where(alpha, codes, 32)[keep]
    codes = np.concatenate([[32], codes, [32]]).astype(np.uint32)
    mixed = (codes[:-2] * np.uint32(0x9E3779B1)) ^ (codes[1:-1] * np.uint32(0x85EBCA77) + np.uint32(1)) ^ (codes[2:] * np.uint32(0xC2B2AE3D) + np.uint32(7))
    return ((mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(16)


def learn(docs: DataFrame, usable: Column, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """(languages in order, log-probabilities: one row a language). At most ``PER_LANGUAGE`` documents of each."""
    own = docs.where(usable & F.col(lang).isNotNull() & F.col(text).isNotNull())
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    sample = materialise(own.select(F.col(id_col).alias("id"), F.col(lang).cast("string").alias("lang")).distinct().withColumn(
        "k", F.row_number().over(order)).where(F.col("k") <= PER_LANGUAGE).select("id", "lang"), "lang-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letter, sums = _letters(), {}
        for batch in batches:
            for name, body in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                sums[name] = sums.get(name, 0) + np.bincount(trigrams(body, letter), minlength=BUCKETS)
        for name, counts in sums.items():
            cells = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(cells)), pa.array(cells, pa.int32()), pa.array(counts[cells], pa.int64())],
                                             ["lang", "cell", "n"])

    texts = own.select(F.col(id_col).alias("id"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).join(
        sample, ["id", "lang"], "left_semi").select("lang", "text")
    counted = texts.mapInArrow(count, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    # At most BUCKETS rows a language.
    rows = counted.toPandas()
    names = sorted(rows["lang"].unique())
    counts = np.zeros((len(names), BUCKETS))
    for k, name in enumerate(names):
        own_rows = rows[rows["lang"] == name]
        counts[k, own_rows["cell"].to_numpy()] = own_rows["n"].to_numpy()
    return names, np.log((counts + SMOOTH / BUCKETS) / (counts.sum(axis=1, keepdims=True) + SMOOTH))


def _climb(counts: np.ndarray, p: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, float]:
    """Shares after expectation-maximisation, and the log-likelihood they reach."""
    total = counts.sum()
    for _ in range(STEPS):
        mixture = p @ shares
        new = shares * ((counts / mixture) @ p) / total
        settled = np.abs(new - shares).max() < 1e-4
        shares = new
        if settled:
            break
    return shares, float(counts @ np.log(p @ shares))


def mixture(cells: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(languages of the text, their shares) by penalised likelihood; ``logs`` has one row a language."""
    kinds, counts = np.unique(cells, return_counts=True)
    own = logs[:, kinds]
    single = own @ counts
    best = int(np.argmax(single))
    cost = 0.5 * np.log(counts.sum())
    # Scaled per trigram, which changes neither the shares nor the comparison.
    top = own.max(axis=0)
    p = np.exp(own - top).T
    base = float(counts @ top)
    chosen = np.arange(len(logs))
    shares, reached = _climb(counts, p, np.full(len(logs), 1 / len(logs)))
    score = base + reached - cost * (len(chosen) - 1)
    # The full set's likelihood bounds that of any smaller one.
    while len(chosen) > 1 and base + reached - cost > single[best]:
        weakest = int(np.argmin(shares))
        less = np.delete(chosen, weakest)
        rest = np.delete(shares, weakest) + 1e-6
        new, value = _climb(counts, p[:, less], rest / rest.sum())
        new_score = base + value - cost * (len(less) - 1)
        if new_score < score:
            break
        chosen, shares, score = less, new, new_score
    if single[best] >= score:
        return np.array([best]), np.ones(1)
    return chosen, shares


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, languages, shares) for every row."""
    names, logs = model
    shared = docs.sparkSession.sparkContext.broadcast(logs.astype(np.float64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letter, tables = _letters(), shared.value
        for batch in batches:
            for part in text_slices(batch, "text"):
                found = []
                for body in part.column("text").to_pylist():
                    cells = trigrams(body, letter)
                    if not len(cells) or not names:
                        found.append(("und", 0.0, [], []))
                        continue
                    chosen, shares = mixture(cells, tables)
                    order = np.argsort(-shares, kind="stable")
                    found.append((names[chosen[order[0]]], float(shares[order[0]]), [names[c] for c in chosen[order]], shares[order].tolist()))
                cols = list(zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(cols[0], pa.string()), pa.array(cols[1], pa.float64()),
                     pa.array(cols[2], pa.list_(pa.string())), pa.array(cols[3], pa.list_(pa.float64()))],
                    ["doc_id", "lang_pred", "score", "languages", "shares"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, languages array<string>, shares array<double>")
