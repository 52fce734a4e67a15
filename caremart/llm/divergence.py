"""Source divergence audit: how a source's use of words differs from the other sources of its language, by a minimal-perfect-hash recount.

1. The first pass counts in how many documents of its language each term occurs. Terms in ``min_docs`` documents or more are kept; this count is
   exact.
2. The kept terms of a language are cut into shards of bounded size. One task a shard builds a minimal perfect hash: levels of bit
   arrays, in each of which the terms that fall on a bit alone are settled; the number of set bits before a term's own is its slot. The
   terms are stored by slot.
3. The second pass reads the texts again. Each distinct term of a group's texts is hashed to its slot, compared with the term stored there
   (any text hashes to some slot), and counted in the group's dense array of slots. Arrays are emptied into rows (group, slot, count) when they
   exceed ``DENSE_BYTES``, and the rows are summed up by aggregation.
4. Blocks of ``BLOCK`` slots hold the dense counts of all groups of a language. There all shares, divergences between sources and the candidates
   for a group's most overused terms are computed, and the sums and ranks follow by aggregation.

Shards are broadcast in batches of at most about ``BROADCAST_BYTES`` (a shard more); a vocabulary beyond that takes one reading of the texts for each batch.
A task that builds a shard, and one that holds a block of a language of S sources, is bounded by ``SHARD_TERMS`` terms and by S * ``BLOCK`` numbers.

A term is a run of ASCII letters and characters beyond ASCII, A-Z in lower case. With the counts c of the kept terms in a group, N their sum and V
the number of the language's kept terms, the share of a term is p = 1 + floor(SCALE * (c + 2) / (N + 2 * V)); the divergence of two shares is
floor((p - q) ** 2 / (p + q)). All numbers are integers.

Defined results: null texts, languages and sources are empty ones. Every row is a document, whatever
its id. A group without kept terms still has a row for each other source; with no kept term in the language the divergence is 0. Ties go by the
item's UTF-8 bytes. An empty table gives no rows. Other columns are ignored. Memory follows the longest text only where its distinct terms are listed.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caremart.llm.common import mix64, text_slices
from caremart.llm.words import blocks
from caremart.session import materialise

SCALE = 1_000_000_000
#: Terms and bytes of a shard, about.
SHARD_TERMS, SHARD_BYTES = 16_384, 250_000
#: Bytes of shards that are broadcast at once, about.
BROADCAST_BYTES = 16_000_000
#: Bytes of dense slots that a task of the second pass holds.
DENSE_BYTES = 64_000_000
#: Slots whose counts meet in one group.
BLOCK = 1024
#: Distinct terms that a task of the first pass holds.
HELD_TERMS = 1_000_000
#: Bits of a level for each term that is still unsettled, and levels at most.
GAMMA, LEVELS = 2.0, 64
#: Products up to here fit 64 bits.
_EXACT = (1 << 63) // SCALE - 1

#: Every byte that ends a term becomes a blank, A-Z lower case.
_FOLD = bytes(b if b > 0x7F or chr(b).islower() else b | 0x20 if chr(b).isupper() else 0x20 for b in range(256))


def terms(raw: bytes) -> list[bytes]:
    """The terms of a text in order."""
    return raw.translate(_FOLD).split()


# ---- first pass: exact document frequencies ------------------------------------------------------------------------------------

def _count_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = {}

    def emptied() -> Iterator[pa.RecordBatch]:
        for lang, own in counts.items():
            names, numbers = list(own), list(own.values())
            for at in range(0, len(names), 100_000):
                part = names[at:at + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang]).take(pa.array(np.zeros(len(part), np.int32))), pa.array(part, pa.binary()),
                     pa.array(numbers[at:at + 100_000], pa.int64())], ["lang", "term", "n"])
        counts.clear()

    for batch in batches:
        for part in text_slices(batch, "text"):
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
                seen: set[bytes] = set()
                for block in blocks(text.encode()):
                    seen.update(terms(block))
                counts.setdefault(lang, Counter()).update(seen)
            if sum(map(len, counts.values())) > HELD_TERMS:
                yield from emptied()
    yield from emptied()


def vocabulary(rows: DataFrame, min_docs: int) -> DataFrame:
    """(lang, term): terms in ``min_docs`` documents of their language or more, from (lang, text)."""
    counted = rows.select("lang", "text").mapInArrow(_count_documents, "lang string, term binary, n long")
    return counted.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs).select("lang", "term")


# ---- perfect hashes ------------------------------------------------------------------------------------------------------------

class PerfectHash:
    """Slots 0 to n - 1 of n different 64-bit keys. Other keys get some slot or none."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    @staticmethod
    def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return mix64(keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) % np.uint64(size)

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash | None:
        """The hash of these keys, none if two of them are equal."""
        sizes, words, left = [], [], keys
        for level in range(LEVELS):
            if not len(left):
                return cls(np.array(sizes, np.int64), np.concatenate(words) if words else np.zeros(0, np.uint64))
            size = 64 * math.ceil(GAMMA * len(left) / 64)
            place = cls._places(left, level, size)
            alone = np.bincount(place.astype(np.int64), minlength=size) == 1
            sizes.append(size)
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = left[~alone[place]]
        return None

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for none."""
        out, todo, start = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes.tolist()):
            place = self._places(keys[todo], level, size)
            at, bit = start + (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
            word = self.words[at]
            hit = (word >> bit & np.uint64(1)).astype(bool)
            below = word[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            out[todo[hit]] = self.before[at[hit]] + np.bitwise_count(below)
            todo = todo[~hit]
            start += size // 64
        return out

    def to_bytes(self) -> bytes:
        return np.int64(len(self.sizes)).tobytes() + self.sizes.tobytes() + self.words.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> PerfectHash:
        levels = int(np.frombuffer(data, "<i8", 1)[0])
        return cls(np.frombuffer(data, "<i8", levels, 8), np.frombuffer(data, "<u8", offset=8 + 8 * levels))


def _hashes(names: list[bytes], seed: int) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(x, seed) for x in names), np.uint64, len(names))


def _packed(names: list[bytes]) -> tuple[bytes, bytes]:
    """(all names one after another, the end of each)."""
    return b"".join(names), np.cumsum([len(x) for x in names], dtype="<i8").tobytes()


def _unpacked(joined: bytes, ends: bytes) -> list[bytes]:
    joined, ends = bytes(joined), np.frombuffer(ends, "<i8").tolist()
    return [joined[a:b] for a, b in zip([0, *ends], ends)]


_SHARD = "lang string, shard int, block int, shards int, kept long, seed long, levels binary, names binary, ends binary, size long"


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    """The hash of a shard and its terms by slot, one row for each block of slots; the first one has the levels."""
    names = [bytes(x) for x in pdf["term"]]
    # Terms that are equal in 64 bits under one seed are not under another.
    seed, table = next((s, t) for s in range(1 << 16) if (t := PerfectHash.of(keys := _hashes(names, s))) is not None)
    by_slot: list[bytes] = [b""] * len(names)
    for name, slot in zip(names, table.slots(keys).tolist(), strict=True):
        by_slot[slot] = name
    first = pdf.iloc[0]
    rows = []
    for block, at in enumerate(range(0, len(by_slot), BLOCK)):
        joined, ends = _packed(by_slot[at:at + BLOCK])
        levels = table.to_bytes() if not block else b""
        rows.append((first["lang"], first["shard"], block, first["shards"], first["kept"], seed, levels, joined, ends,
                     len(levels) + len(joined) + len(ends)))
    return pd.DataFrame(rows, columns=[c.split()[0] for c in _SHARD.split(", ")])


def shards(kept: DataFrame) -> DataFrame:
    """The perfect hashes of the kept terms (lang, term) of each language: a row for each block of slots of each shard."""
    size = F.octet_length("term")
    needed = F.ceil(F.greatest(F.count(F.lit(1)) / SHARD_TERMS, F.sum(size) / SHARD_BYTES)).cast("int")
    sizes = kept.groupBy("lang").agg(needed.alias("shards"), F.count(F.lit(1)).alias("kept"))
    dealt = kept.join(sizes, "lang").withColumn("shard", (F.crc32("term") % F.col("shards")).cast("int"))
    return dealt.groupBy("lang", "shard").applyInPandas(_build, _SHARD)


# ---- second pass: dense slots --------------------------------------------------------------------------------------------------

class _Shard:
    """A perfect hash with its terms by slot."""

    def __init__(self, seed: int, levels: bytes, names: list[bytes]):
        self.seed, self.names, self.table = seed, names, PerfectHash.from_bytes(levels)

    def find(self, names: list[bytes]) -> np.ndarray:
        """The slot of each name, -1 for names that are not kept."""
        slots = self.table.slots(_hashes(names, self.seed))
        stored = map(self.names.__getitem__, slots.tolist())
        same = np.fromiter((a == b for a, b in zip(stored, names, strict=True)), bool, len(names))
        return np.where(same, slots, -1)


def _lookup(rows: list[tuple]) -> dict[str, tuple[int, dict[int, _Shard]]]:
    """(number of shards, shards at hand) of each language, from rows (lang, shard, block, shards, seed, levels, names, ends)."""
    parts: dict[tuple[str, int], list[tuple]] = {}
    for row in sorted(rows, key=lambda r: r[:3]):
        parts.setdefault(row[:2], []).append(row)
    out: dict[str, tuple[int, dict[int, _Shard]]] = {}
    for (lang, shard), own in parts.items():
        names = [x for row in own for x in _unpacked(row[6], row[7])]
        out.setdefault(lang, (own[0][3], {}))[1][shard] = _Shard(own[0][4], bytes(own[0][5]), names)
    return out


def _recounter(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _lookup(shared.value)
        dense: dict[tuple[str, str, int], np.ndarray] = {}

        def emptied() -> Iterator[pa.RecordBatch]:
            for (lang, source, shard), counts in dense.items():
                slots = np.flatnonzero(counts)
                same = pa.array(np.zeros(len(slots), np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang]).take(same), pa.array([source]).take(same), pa.array([shard], pa.int32()).take(same),
                     pa.array(slots.astype(np.int32)), pa.array(counts[slots])], ["lang", "source", "shard", "slot", "n"])
            dense.clear()

        for batch in batches:
            for part in text_slices(batch, "text"):
                texts: dict[tuple[str, str], list[bytes]] = {}
                for lang, source, text in zip(*(part.column(c).to_pylist() for c in ("lang", "source", "text")), strict=True):
                    if lang in known:
                        texts.setdefault((lang, source), []).append(text.encode())
                for (lang, source), own in texts.items():
                    found: Counter = Counter()
                    for block in blocks(b" ".join(own)):
                        found.update(terms(block))
                    names, numbers = list(found), np.fromiter(found.values(), np.int64, len(found))
                    of, at_hand = known[lang]
                    place = np.fromiter(map(crc32, names), np.int64, len(names)) % of
                    for shard, table in at_hand.items():
                        here = np.flatnonzero(place == shard)
                        slots = table.find([names[k] for k in here.tolist()])
                        # Different terms have different slots.
                        counts = dense.setdefault((lang, source, shard), np.zeros(len(table.names), np.int64))
                        counts[slots[slots >= 0]] += numbers[here[slots >= 0]]
                if sum(x.nbytes for x in dense.values()) > DENSE_BYTES:
                    yield from emptied()
        yield from emptied()

    return run


def _batches(hashes: DataFrame) -> tuple[F.Column, int]:
    """(batch of a shard, number of batches) such that a batch holds about ``BROADCAST_BYTES``, or a single larger shard."""
    each = hashes.groupBy("lang", "shard").agg(F.sum("size").alias("size"))
    total, largest = each.agg(F.sum("size"), F.max("size")).first()
    number = math.ceil((total or 0) / BROADCAST_BYTES)
    deal = lambda n: F.pmod(F.xxhash64("lang", "shard"), F.lit(n))
    while number > 1:
        most = each.groupBy(deal(number)).agg(F.sum("size").alias("size")).agg(F.max("size")).first()[0]
        if most <= max(BROADCAST_BYTES * 5 // 4, largest):
            break
        number *= 2
    return deal(max(number, 1)), number


def group_counts(rows: DataFrame, hashes: DataFrame) -> DataFrame:
    """(lang, source, shard, slot, n): occurrences of each kept term in each group, from (lang, source, text)."""
    batch, number = _batches(hashes)
    counted = rows.sparkSession.createDataFrame([], "lang string, source string, shard int, slot int, n long")
    for k in range(number):
        # At most about BROADCAST_BYTES; a larger vocabulary takes more readings.
        own = hashes.where(batch == k).select("lang", "shard", "block", "shards", "seed", "levels", "names", "ends").collect()
        shared = rows.sparkSession.sparkContext.broadcast([tuple(r) for r in own])
        counted = counted.union(rows.select("lang", "source", "text").mapInArrow(_recounter(shared), counted.schema))
    return counted.groupBy("lang", "source", "shard", "slot").agg(F.sum("n").alias("n"))


# ---- shares and divergences ----------------------------------------------------------------------------------------------------

def shares(counts: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (counts + 2) / whole), exactly."""
    above = counts + 2
    if above.size and above.max() > _EXACT:
        above, whole = above.astype(object), whole.astype(object)
    return (1 + above * SCALE // whole).astype(np.int64)


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    apart = p - q
    return apart * apart // (p + q)


_AUDITED = "lang string, source string, part string, item string, value long"


def _audit_block(top: int):
    def run(counts: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        """Partial sums of divergence for each pair of sources, and each source's candidates for its most overused terms."""
        block = others[others["names"].notna()].iloc[0]
        groups = others[others["names"].isna()].sort_values("source")
        names = _unpacked(block["names"], block["ends"])
        sources = groups["source"].tolist()
        number = {s: k for k, s in enumerate(sources)}
        held = np.zeros((len(sources), len(names)), np.int64)
        held[counts["source"].map(number).to_numpy(np.int64), counts["slot"].to_numpy(np.int64)] = counts["n"].to_numpy(np.int64)
        whole, kept = groups["total"].to_numpy(np.int64), int(block["kept"])
        p = shares(held, (whole + 2 * kept)[:, None])
        q = shares(held.sum(axis=0), np.array(whole.sum() + 2 * kept))
        out = [(sources[g], "pair", sources[g + 1 + h], int(x)) for g in range(len(sources))
               for h, x in enumerate(divergence(p[g + 1:], p[g]).sum(axis=1).tolist())]
        by_bytes = np.empty(len(names), np.int64)
        by_bytes[sorted(range(len(names)), key=names.__getitem__)] = np.arange(len(names))
        for g, source in enumerate(sources):
            more = np.flatnonzero((held[g] > 0) & (p[g] > q))
            value = divergence(p[g][more], q[more])
            best = np.lexsort((by_bytes[more], -value))[:top]
            out.extend((source, "term", names[more[k]].decode(), int(value[k])) for k in best)
        found = pd.DataFrame(out, columns=["source", "part", "item", "value"])
        found.insert(0, "lang", block["lang"])
        return found

    return run


def audit(docs: DataFrame, min_docs: int = 10, top: int = 10, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank): in part ``pair`` the divergence of each other source of the language, in part ``term`` the
    ``top`` terms that the group uses more than its language does."""
    filled = {n: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for n, c in (("lang", lang), ("source", source), ("text", text))}
    rows = docs.select(*filled.values())
    kept = materialise(vocabulary(rows, min_docs), "kept-terms")
    hashes = materialise(shards(kept), "perfect-hashes")
    counts = materialise(group_counts(rows, hashes), "group-counts")
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = materialise(rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").fillna(0, ["total"]), "groups")
    places = hashes.select("lang", "shard", "block", F.lit(None).cast("string").alias("source"), F.lit(0).cast("long").alias("total"),
                           "kept", "names", "ends")
    each = hashes.select("lang", "shard", "block").join(groups, "lang").select(
        "lang", "shard", "block", "source", "total", F.lit(0).cast("long").alias("kept"), *[F.lit(None).cast("binary").alias(c) for c in ("names", "ends")])
    slots = counts.select("lang", "shard", F.floor(F.col("slot") / BLOCK).cast("int").alias("block"), "source",
                          (F.col("slot") % BLOCK).alias("slot"), "n")
    keys = ["lang", "shard", "block"]
    audited = materialise(
        slots.groupBy(*keys).cogroup(places.unionByName(each).groupBy(*keys)).applyInPandas(_audit_block(top), _AUDITED), "audited")
    half = audited.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    other = half.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    # Sources of a language without kept terms differ in nothing.
    bare = groups.join(hashes.select("lang").distinct(), "lang", "left_anti").select("lang", "source")
    still = bare.join(bare.withColumnRenamed("source", "item"), "lang").where("source <> item").withColumn("value", F.lit(0).cast("long"))
    pairs = half.union(other).union(still).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    ranked = pairs.union(audited.where("part = 'term'")).withColumn("rank", F.row_number().over(order).cast("int"))
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= top))
