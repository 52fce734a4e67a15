"""The corpus pipeline: toxicity, line dedup, near-dedup, mixing, packing.

Each stage takes all that its predecessor kept. The first four return documents with the columns of the input; the last
returns the pieces of the packed sequences. ``run`` writes each stage to the shared folder and reads it again, so a lost
executor costs no more than the stage it was in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from caremart.llm import lines, minhash, mixing, packing, toxicity
from caremart.llm.common import table
from caremart.llm.registry import tokenizer_path
from caremart.session import materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more go; the model is trained on the labels of the documents at hand."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"), bar=0.7)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on ten sites or more leave the texts."""
    return lines.dedup(docs, min_sites=10, min_chars=10, suspect_share=0.5)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: five-word shingles, similarity 0.8."""
    return minhash.without_copies(docs, words=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the tempered weights of their sources ask, each at least once."""
    return mixing.mixed(docs, mixing.Mix())


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens, with their token ids."""
    return packing.pack(docs, tokenizer_path(), end_id=1, length=2048)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("near_dedup", drop_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: A trained model and a tokenizer take part, which SQL cannot express; tests/llm hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces that come out of all stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
