"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's score is the logistic of the summed weights of its words and of their first
letters, of those that go with toxic documents beyond chance (``EVIDENCE``); the document's score is the noisy-or of its sentences, so one offending sentence is enough. The weights are trained
from document labels alone, and the sentence scores then locate the offending sentences.

Training takes a bounded sample: ``PER_CLASS`` labelled documents of either label, those with the smallest hash of their id, as whole
texts, in one task. Scoring reads every text.

Defined results: an empty or null text has no sentence and scores 0. If either label is missing from the sample,
every text scores 0. A null label teaches nothing; if a document has several labels the highest holds. A row is a document even if its id
repeats or is null. An empty table gives no rows. Other columns are ignored, or kept by ``without_toxic``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caremart.llm.common import release_kept, text_slices
from caremart.session import materialise

PER_CLASS, STEPS, RATE, DECAY, BIAS = 3000, 200, 0.2, 1e-5, -8.0
#: Least likelihood ratio (G squared) of a feature: 25 is met by chance by less than one in a million.
EVIDENCE = 25.0
#: Letters of a word that also count as a feature, marked apart from words.
STEM, MARK = 4, "^"
KEPT_WORDS = 400_000
_UNITS = re.compile(r"[^\W\d_]+|[.!?\n|]")
_ENDS = frozenset(".!?\n|")


def _features(word: str) -> tuple[str, ...]:
    return (word, MARK + word[:STEM]) if len(word) > STEM else (word,)


def fit(pdf: pd.DataFrame) -> pd.DataFrame:
    """(feature, weight) from (text, toxic); the bias under the empty name."""
    nothing = pd.DataFrame({"feature": pd.Series([], dtype=str), "weight": pd.Series([], dtype=float)})
    if pdf["toxic"].nunique() < 2:
        return nothing
    # Documents of either label in which each feature occurs.
    seen: dict[str, list[int]] = {}
    for body, label in zip(pdf["text"], pdf["toxic"], strict=True):
        for feature in {f for w in set(_UNITS.findall((body or "").lower())) - _ENDS for f in _features(w)}:
            seen.setdefault(feature, [0, 0])[int(label > 0)] += 1
    totals = np.bincount((pdf["toxic"] > 0).astype(int), minlength=2)
    names = sorted(seen)
    index = {f: k for k, f in enumerate(np.array(names, object)[_telling(np.array([seen[f] for f in names]), totals)])}
    del seen, names
    blank = len(index)
    cols, sentence_at, bag_at, labels = [], [], [], []
    for body, label in zip(pdf["text"], pdf["toxic"], strict=True):
        start = len(sentence_at)
        for units in _sentences((body or "").lower()):
            sentence_at.append(len(cols))
            cols.extend({index[f] for w in units for f in _features(w) if f in index} or (blank,))
        if len(sentence_at) > start:
            bag_at.append(start)
            labels.append(label)
    sentences = len(sentence_at)
    y = np.array(labels, float)
    if not index or len(set(labels)) < 2:
        return nothing
    cols, sentence_at, bag_at = np.array(cols), np.array(sentence_at), np.array(bag_at)
    of_sentence = np.repeat(np.arange(sentences), np.diff([*sentence_at, len(cols)]))
    of_bag = np.repeat(np.arange(len(y)), np.diff([*bag_at, sentences]))
    # The last weight belongs to sentences without a feature and stays zero.
    weight, bias = np.zeros(blank + 1), BIAS
    m, v = np.zeros(blank + 2), np.zeros(blank + 2)
    for step in range(1, STEPS + 1):
        z = np.add.reduceat(weight[cols], sentence_at) + bias
        p = 1 / (1 + np.exp(-z))
        none = np.exp(-np.add.reduceat(np.logaddexp(0, z), bag_at))
        push = np.where(y > 0, -none / np.maximum(1 - none, 1e-12), 1.0) / len(y)
        dz = p * push[of_bag]
        grad = np.append(np.bincount(cols, dz[of_sentence], blank + 1) + DECAY * weight, dz.sum())
        grad[blank] = 0
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        move = RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        weight -= move[:-1]
        bias -= move[-1]
    names = np.array(list(index), object)
    used = np.abs(weight[:-1]) > 0.05
    return pd.DataFrame({"feature": [*names[used], ""], "weight": [*weight[:-1][used], bias]})


def _telling(seen: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Which features occur in toxic documents more often than chance explains, from (clean, toxic) counts."""
    there, whole = seen.sum(axis=1, keepdims=True), totals.sum()
    share = totals / whole
    absent = totals - seen
    part = lambda n, expected: np.where(n > 0, n * np.log(np.maximum(n, 1e-300) / np.maximum(expected, 1e-300)), 0.0)
    ratio = 2 * (part(seen, there * share) + part(absent, (whole - there) * share)).sum(axis=1)
    return (ratio >= EVIDENCE) & (seen[:, 1] > there[:, 0] * share[1])


def _sentences(text: str) -> Iterator[list[str]]:
    own: list[str] = []
    for unit in _UNITS.findall(text):
        if unit in _ENDS:
            if own:
                yield own
            own = []
        else:
            own.append(unit)
    if own:
        yield own


def learn(docs: DataFrame, labels: DataFrame, usable: Column | None = None, id_col: str = "doc_id", text: str = "text",
          label: str = "toxic") -> dict[str, float]:
    """Weights by feature, from labelled documents for which ``usable`` (over ``id``) holds."""
    known = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label).cast("int").alias("toxic"))
    known = known.join(docs.select(F.col(id_col).alias("id")), "id", "left_semi")
    if usable is not None:
        known = known.where(usable)
    pick = [known.where(F.col("toxic") == k).orderBy(F.xxhash64("id"), "id").limit(PER_CLASS) for k in (0, 1)]
    sample = materialise(pick[0].union(pick[1]), "toxic-sample")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    # 2 * PER_CLASS rows at most.
    bag = texts.join(F.broadcast(sample), "id").select("text", "toxic", "id", F.lit(0).alias("all"))

    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        release_kept()
        return fit(pdf.sort_values(["id"], kind="stable"))

    rows = bag.groupBy("all").applyInPandas(train, "feature string, weight double").collect()
    return {r.feature: r.weight for r in rows}


class _Weights(dict):
    """Total weight of a word; nan for the end of a sentence."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, unit: str) -> float:
        if len(self) >= KEPT_WORDS:
            self.clear()
        value = float("nan") if unit in _ENDS else sum(self.weights.get(f, 0.0) for f in _features(unit))
        self[unit] = value
        return value


def sentence_scores(text: str | None, words: _Weights, bias: float) -> np.ndarray:
    """Probability of each sentence that has a word, in order."""
    units = _UNITS.findall((text or "").lower())
    values = np.fromiter(map(words.__getitem__, units), float, len(units))
    end = np.isnan(values)
    inside = ~end
    if not inside.any():
        return np.zeros(0)
    first = np.flatnonzero(inside & np.concatenate([[True], end[:-1]]))
    values[end] = 0
    return 1 / (1 + np.exp(-(np.add.reduceat(values, first) + bias)))


def offending(text: str, scores: np.ndarray, least: float) -> list[dict]:
    """Place and score of each sentence of ``least`` or more, in characters of the text."""
    hits = np.flatnonzero(scores >= least)
    if not len(hits):
        return []
    out, number, start, last = [], 0, None, None
    wanted = set(hits.tolist())
    for unit in [*re.finditer(r"[^\W\d_]+|[.!?\n|]", text), None]:
        if unit is None or unit.group() in _ENDS:
            if start is not None:
                if number in wanted:
                    out.append({"start": start, "end": last, "score": float(scores[number])})
                number += 1
            start = None
        else:
            start = unit.start() if start is None else start
            last = unit.end()
    return out


def scored(docs: DataFrame, weights: dict[str, float], sentence_bar: float = 0.5, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, sentences): noisy-or of all sentences, and the offending ones with their places."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_scorer(shared, sentence_bar), f"doc_id {kind}, score double, sentences array<struct<start:int,end:int,score:double>>")


def _scorer(shared, sentence_bar: float):
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_kept()
        words = _Weights(shared.value)
        for batch in batches:
            for part in text_slices(batch, "text"):
                score, found = [], []
                for body in part.column("text").to_pylist():
                    own = sentence_scores(body, words, shared.value[""]) if shared.value else np.zeros(0)
                    score.append(noisy_or(own))
                    found.append(offending(body, own, sentence_bar) if len(own) else [])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(score, pa.float64()), pa.array(found, spans)],
                                                 ["doc_id", "score", "sentences"])

    return run


def without_toxic(docs: DataFrame, labels: DataFrame, bar: float = 0.7, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that score below ``bar``; same columns."""
    weights = learn(docs, labels, None, id_col, text)
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        release_kept()
        words = _Weights(shared.value)
        for part in parts:
            yield pd.Series([noisy_or(sentence_scores(body, words, shared.value[""])) if shared.value else 0.0
                             for body in part], dtype="float64")

    return docs.where(score(F.col(text)) < bar)


def noisy_or(scores: np.ndarray) -> float:
    """Probability that at least one sentence offends."""
    return float(-np.expm1(np.log1p(-np.minimum(scores, 1 - 1e-15)).sum()))
