"""Temperature mixing of sources, in DataFrame functions only.

Each source's share of the tokens is raised to an exponent between 0 (all alike) and 1 (as they are) and normalised.
The exponent is bisected to the smallest that keeps the entropy of the weights at the target and no source above the
repetition limit. The driver sees sums over the sources, four halvings at a time.

The weights are realised in whole blocks: a document belongs to the block of its source that the hash of its id names, and each
pass over a source reads its blocks in a permutation of its own. A source whose weight asks for r passes is read floor(r) times whole,
and the fraction that remains is filled with blocks in the order of the last permutation while they fit into its token budget. Block
sums are cumulated in ``GROUPS`` groups of the permutation, so no task orders all blocks of a hot source.

Unless a budget is given it is the least that reads every source whole at least once: nothing is lost, small sources repeat.

Tokens are runs of other characters than space and \\x09-\\x0D. Defined results: a null text has no tokens;
a null source is a source. Sources without tokens are read once. A row is a document even if its id repeats or is null
(all null ids are one block). An empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caremart.llm.rows import whole_row
from caremart.session import materialise

TOKEN = "[^\\x20\\x09-\\x0D]+"
GROUPS, _LEVELS, _PASSES = 256, 4, 6


@dataclass(frozen=True)
class Mix:
    """What to aim at. ``gain``: entropy between that of the natural shares (0) and equal shares (1)."""

    gain: float = 0.25
    max_epochs: float = 2.0
    budget: int | None = None
    block_tokens: int = 65_536
    min_blocks: int = 64
    seed: int = 42


def tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0)).cast("long")


def _digits(key: Column) -> Column:
    """The first eight hexadecimal digits of an md5 as a number."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long")


def _repeats(mix: Mix, share: float | Column, total: int, most: float, z: float, exponent: float) -> float | Column:
    """Passes over a source with that share."""
    power = F.pow if isinstance(share, Column) else pow
    if mix.budget is None:
        return power(F.lit(most) / share if isinstance(share, Column) else most / share, F.lit(1 - exponent)
                     if isinstance(share, Column) else 1 - exponent)
    return power(share, F.lit(exponent) if isinstance(share, Column) else exponent) / z * (mix.budget / total) / share


def exponent(shares: DataFrame, mix: Mix, total: int) -> tuple[float, float]:
    """(exponent, normaliser): ``shares`` has one row a source with its share of the tokens."""
    n, least, most = shares.agg(F.count("*"), F.min("share"), F.max("share")).first()

    def sums(exponents: list[float]) -> list[tuple[float, float]]:
        power = [F.pow("share", F.lit(a)) for a in exponents]
        row = shares.agg(*[F.sum(p) for p in power], *[F.sum(p * F.log("share")) for p in power]).first()
        return list(zip(row[:len(exponents)], row[len(exponents):], strict=True))

    entropy = lambda a, z, y: math.log(z) - a * y / z
    (z, y), = sums([1.0])
    natural = entropy(1.0, z, y)
    target = natural + mix.gain * (math.log(n) - natural)
    low, high = 0.0, 1.0
    for _ in range(_PASSES):
        steps = 2 ** _LEVELS
        inner = [low + (high - low) * k / steps for k in range(1, steps)]
        met = [entropy(a, z, y) <= target and _repeats(mix, least, total, most, z, a) <= mix.max_epochs
               for a, (z, y) in zip(inner, sums(inner), strict=True)]
        # Both conditions hold from some exponent on: the four bisection steps lead to the first that holds.
        k = 0
        while k < len(met) and not met[k]:
            k += 1
        low, high = (inner[k - 1] if k else low), (inner[k] if k < len(inner) else high)
    found = round(high, 6)
    (z, _), = sums([found])
    return found, z


def plan(docs: DataFrame, mix: Mix, id_col: str, text: str, source: str) -> DataFrame:
    """(source, blocks, epochs, bar): how often each source is read whole, and up to which block key once more."""
    rows = materialise(docs.select(
        F.col(source).cast("string").alias("source"), _digits(_id_text(id_col)).alias("digits"),
        tokens(F.col(text)).alias("n")), "mix-rows")
    sums = materialise(rows.groupBy("source").agg(F.sum("n").alias("tokens")), "mix-sources")
    total = sums.agg(F.sum("tokens")).first()[0] or 0
    if not total:
        return sums.select("source", F.lit(mix.min_blocks).cast("long").alias("blocks"), F.lit(1).alias("epochs"),
                           F.lit(None).cast("string").alias("bar"))
    shares = sums.where("tokens > 0").select("source", "tokens", (F.col("tokens") / F.lit(total)).alias("share"))
    found, z = exponent(shares, mix, total)
    most = shares.agg(F.max("share")).first()[0]
    passes = shares.withColumn("passes", _repeats(mix, F.col("share"), total, most, z, found)).select(
        "source", "tokens", F.greatest(F.lit(mix.min_blocks), F.ceil(F.col("tokens") / mix.block_tokens)).alias("blocks"),
        F.floor(F.col("passes") + 1e-9).cast("int").alias("epochs"), "passes")
    passes = materialise(passes.withColumn(
        "rest", F.floor((F.col("passes") - F.col("epochs")) * F.col("tokens") + 0.5)), "mix-passes")
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    wanted = passes.where("rest > 0")
    blocks = (rows.join(wanted, same(rows, wanted)).select(
        rows["source"], F.col("epochs"), F.col("rest"), (F.col("digits") % F.col("blocks")).alias("block"), "n")
        .groupBy("source", "block", "epochs", "rest").agg(F.sum("n").alias("n")))
    key = block_key(F.col("source"), F.col("block"), F.col("epochs"), mix.seed)
    keyed = materialise(blocks.select("source", "rest", "n", key.alias("key"), F.substring(key, 1, 2).alias("part")), "mix-blocks")
    parts = keyed.groupBy("source", "part").agg(F.sum("n").alias("n"))
    before = parts.select(F.col("source").alias("s"), F.col("part").alias("p"), F.coalesce(F.sum("n").over(
        Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    within = F.sum("n").over(Window.partitionBy("source", "part").orderBy("key"))
    bars = keyed.withColumn("within", within).join(
        before, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p"))).where(
        F.col("base") + F.col("within") <= F.col("rest")).groupBy(F.col("source").alias("s")).agg(F.max("key").alias("bar"))
    full = sums.select("source").join(passes.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").select(
        "source", F.coalesce("blocks", F.lit(mix.min_blocks)).cast("long").alias("blocks"), F.coalesce("epochs", F.lit(1)).alias("epochs"))
    return materialise(full.join(bars, F.col("source").eqNullSafe(F.col("s")), "left").select(
        "source", "blocks", "epochs", "bar"), "mix-plan")


def _id_text(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("string"), F.lit(""))


def block_key(source: Column, block: Column, epoch: Column, seed: int) -> Column:
    """The place of a block in the permutation of one pass over its source."""
    return F.md5(F.concat_ws("|", F.coalesce(source, F.lit("")), block.cast("string"), epoch.cast("string"), F.lit(str(seed))))


def readings(docs: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(row, block, epoch, block_key): one row for each reading of a document, epochs from 0."""
    sources = plan(docs, mix, id_col, text, source).withColumnRenamed("source", "s")
    rows = docs.select(
        whole_row(docs), F.col(source).cast("string").alias("source"),
        _digits(_id_text(id_col)).alias("digits"))
    placed = rows.join(sources, F.col("source").eqNullSafe(F.col("s"))).select(
        "row", "source", (F.col("digits") % F.col("blocks")).alias("block"), "epochs", "bar")
    once_more = F.col("bar").isNotNull() & (block_key(F.col("source"), F.col("block"), F.col("epochs"), mix.seed) <= F.col("bar"))
    times = F.col("epochs") + F.when(once_more, 1).otherwise(0)
    return placed.withColumn("times", times).where("times > 0").select(
        "row", "source", "block", F.explode(F.sequence(F.lit(0), F.col("times") - 1)).alias("epoch")).select(
        "row", "block", "epoch", block_key(F.col("source"), F.col("block"), F.col("epoch"), mix.seed).alias("block_key"))


def mixed(docs: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The documents as often as the mix reads them; same columns."""
    return readings(docs, mix, id_col, text, source).select("row.*")
