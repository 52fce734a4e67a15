"""Near-duplicate documents by min-max hashing.

Each of ``HASHES`` random functions is evaluated once on a document's shingles and keeps both its least and its greatest value: two nearly
independent signature values for one evaluation. Values are banded, ``ROWS`` to a band; documents that share a band are
candidates, and candidates are confirmed on their full shingle sets. At the threshold of 0.8 a pair misses all bands
with a probability of about 3 in a million.

Groups never become pairs. Documents with equal sets are one class with one representative. A document is first tested against the
smallest pivot of its bands, then against the largest; whoever is linked needs no further test inside its component. What is
still apart in a band after that is compared across components: bands of at most ``SMALL`` members by a join, larger ones in a grid of blocks of
about ``BLOCK`` members that are given their full sets and emit a spanning forest of links; blocks of the band's largest component do not
meet each other. There, compact signatures rule out most
pairs (the estimate must lie six standard errors below the threshold), and each pair is looked at in the first band that it
shares. Components come from the links in rounds (:func:`caremart.llm.common.components`).

Words are what stands between white space bytes, A-Z in lower case; a shingle is ``words`` words in a row, a shorter text one shingle.

Defined results: a null or empty text, or one without words, has no shingles and links with nothing. For ``near_duplicates`` rows that
share an id count as one document: its first row by (number of shingles, digest); ``without_copies`` keeps unlike texts apart. Rows with a null id link with nothing and are kept.
An empty table gives no rows. Other columns are ignored, or kept by ``without_copies``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caremart.llm.common import components, frequent, joined, mix64, release_kept, text_slices, utf8_buffers
from caremart.llm.rows import text_keys, whole_row
from caremart.session import materialise

HASHES, ROWS = 80, 5
BANDS = 2 * HASHES // ROWS
#: Members of a band that one task compares at a time, and up to which a plain join compares them.
BLOCK, SMALL = 1024, 8
#: Bytes of text that a task hashes at a time.
SLICE = 4_000_000
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SPOT = mix64(np.arange(1001, 1257, dtype=np.uint64))


def word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of each word in the bytes of a text."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    inside = ~_SPACE[raw]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    # Byte by byte within each word: hash * odd + value of the byte, all words of a length step at once.
    lengths = ends - starts
    h = lengths.astype(np.uint64)
    values = _SPOT[_LOWER[raw]]
    order = np.argsort(-lengths, kind="stable")
    long_first, n = lengths[order], len(order)
    for step in range(int(long_first[0])):
        while n and long_first[n - 1] <= step:
            n = int(np.searchsorted(-long_first, -step, side="left"))
        own = order[:n]
        h[own] = (h[own] ^ values[starts[own] + step]) * _ODD
        h[own] ^= h[own] >> np.uint64(29)
    return starts, mix64(h)


def shingles(hashes: np.ndarray, words: int) -> np.ndarray:
    """Distinct shingle hashes in order."""
    if not len(hashes):
        return hashes
    width = min(words, len(hashes))
    out = np.full(len(hashes) - width + 1, width, np.uint64)
    for k in range(width):
        out = mix64(out * _ODD + hashes[k:len(hashes) - width + 1 + k])
    return np.unique(out)


def _functions() -> tuple[np.ndarray, np.ndarray]:
    seeds = mix64(np.arange(1, 2 * HASHES + 1, dtype=np.uint64))
    return seeds[:HASHES] | np.uint64(1), seeds[HASHES:]


def signature(own: np.ndarray, functions: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The least and greatest value of each function: 2 * HASHES numbers."""
    factor, shift = functions
    least = np.full(HASHES, np.iinfo(np.uint32).max, np.uint32)
    most = np.zeros(HASHES, np.uint32)
    for a in range(0, len(own), 2048):
        v = ((own[a:a + 2048, None] * factor + shift) >> np.uint64(32)).astype(np.uint32)
        np.minimum(least, v.min(axis=0), out=least)
        np.maximum(most, v.max(axis=0), out=most)
    return np.concatenate([least, most])


def _texts(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    return docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))


def _sets(part: pa.RecordBatch, words: int) -> Iterator[np.ndarray]:
    raw, at, _ = utf8_buffers(part.column("text"))
    starts, hashes = word_hashes(_apart(raw, at))
    # One separator was put after each text, so words never cross texts.
    first = np.searchsorted(starts, at + np.arange(len(at)))
    for row in range(len(part)):
        yield shingles(hashes[first[row]:first[row + 1]], words)


def _apart(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.insert(raw, at[1:], 0x20)


def signatures(docs: DataFrame, words: int, id_col: str, text: str, slice_bytes: int = SLICE) -> DataFrame:
    """(id, n, high, low, bands, signs): size and digest of the set, band keys, and the low byte of each signature value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_kept()
        functions, band = _functions(), np.arange(BANDS, dtype=np.uint64)
        for batch in batches:
            for part in text_slices(batch, "text", slice_bytes):
                n, digests, bands, signs = [], bytearray(), [], []
                for own in _sets(part, words):
                    n.append(len(own))
                    digests += xxhash.xxh3_128_digest(own.tobytes())
                    if not len(own):
                        bands.append(None)
                        signs.append(None)
                        continue
                    values = signature(own, functions)
                    key = mix64(band + np.uint64(77))
                    for k in range(ROWS):
                        key = mix64(key * _ODD + values.reshape(BANDS, ROWS)[:, k].astype(np.uint64))
                    bands.append(key.view(np.int64))
                    signs.append((values & 0xFF).astype(np.uint8).tobytes())
                digest = np.frombuffer(bytes(digests), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(n, pa.int64()), pa.array(digest[:, 0]), pa.array(digest[:, 1]),
                     pa.array(bands, pa.list_(pa.int64())), pa.array(signs, pa.binary())], ["id", "n", "high", "low", "bands", "signs"])

    return _texts(docs, id_col, text).mapInArrow(run, "id long, n long, high long, low long, bands array<long>, signs binary")


def _full_sets(docs: DataFrame, wanted: DataFrame, words: int, id_col: str, text: str, slice_bytes: int = SLICE) -> DataFrame:
    """(id, n, high, low, own): the sorted shingle hashes of the wanted documents (id, n, high, low)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_kept()
        for batch in batches:
            for part in text_slices(batch, "text", slice_bytes):
                sets = list(_sets(part, words))
                digest = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(digest[:, 0]), pa.array(digest[:, 1]), pa.array([s.tobytes() for s in sets], pa.binary())],
                    ["id", "high", "low", "own"])

    texts = _texts(docs, id_col, text).join(wanted.select("id"), "id", "left_semi")
    sets = texts.mapInArrow(run, "id long, high long, low long, own binary")
    return sets.join(wanted, ["id", "high", "low"], "left_semi").dropDuplicates(["id"]).select("id", "own")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets overlap enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_kept()
        for batch in batches:
            keep = []
            for left, right in zip(batch.column("left"), batch.column("right"), strict=True):
                x, y = np.frombuffer(left.as_buffer(), np.uint64), np.frombuffer(right.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("id").alias("a"), F.col("own").alias("left"))
    right = sets.select(F.col("id").alias("b"), F.col("own").alias("right"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(run, "a long, b long")


def _alike(a: str, b: str, percent: int) -> F.Column:
    """Whether two sizes allow the overlap at all."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _linked_in_cell(percent: int):
    """A spanning forest of the links between members of one cell of a large band that are still apart."""
    level = percent / 100
    needed = (level - 6 * (level * (1 - level) / (2 * HASHES)) ** 0.5) * 2 * HASHES

    def links(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        release_kept()
        band, first, second = key
        ids, n, block = pdf["id"].to_numpy(), pdf["n"].to_numpy(), pdf["block"].to_numpy()
        root = pdf["root"].to_numpy().copy()
        signs = np.frombuffer(b"".join(pdf["signs"]), np.uint8).reshape(len(pdf), -1)
        bands = np.stack(pdf["bands"].to_list())
        place = np.argmax(bands == band, axis=1)
        own = [np.frombuffer(x, np.uint64) for x in pdf["own"]]
        left, right = np.flatnonzero(block == first), np.flatnonzero(block == second)
        found = []
        for i in left:
            others = right[(root[right] != root[i]) & ((first != second) | (ids[right] > ids[i]))]
            others = others[100 * np.minimum(n[others], n[i]) >= percent * np.maximum(n[others], n[i])]
            # A pair belongs to the first band that it shares.
            others = others[np.argmax(bands[others] == bands[i], axis=1) == place[i]] if len(others) else others
            alike = (signs[others] == signs[i]).sum(axis=1)
            for j in others[np.argsort(-alike, kind="stable")][:int((alike >= needed).sum())]:
                if root[j] == root[i]:
                    continue
                both = len(np.intersect1d(own[i], own[j], assume_unique=True))
                if 100 * both >= percent * (len(own[i]) + len(own[j]) - both):
                    found.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
                    root[root == root[j]] = root[i]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return links


def clusters(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text: str = "text",
             slice_bytes: int = SLICE) -> DataFrame:
    """(id, n_shingles, component): one row an id; component is the smallest id that links reach."""
    every = materialise(signatures(docs, words, id_col, text, slice_bytes), "signatures")
    one = materialise(every.groupBy("id").agg(F.min(F.struct("n", "high", "low")).alias("s")).select("id", "s.*"), "one-set")
    equal = ["n", "high", "low"]
    classes = one.where("n > 0").groupBy(*equal).agg(F.min("id").alias("rep"), F.count("*").alias("copies")).where("copies > 1")
    classes = materialise(classes, "classes")
    hot = frequent(classes, "copies", one.count())
    members = joined(one, classes, equal, hot).withColumn("rep", F.when(F.col("n") > 0, F.coalesce("rep", "id")))
    members = materialise(members.select("id", "n", "high", "low", "rep"), "members")
    reps = every.join(members.where("id = rep").select("id", "n", "high", "low"), ["id", "n", "high", "low"], "left_semi").dropDuplicates(["id"])
    banded = reps.select("id", "n", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.count("*").alias("c"), F.min(F.struct("id", "n")).alias("low"), F.max(F.struct("id", "n")).alias("high")).where("c > 1")
    active = materialise(banded.join(shared, "band"), "bands")
    wanted = members.join(active.select("id").distinct(), "id", "left_semi").select("id", "high", "low")
    sets = materialise(_full_sets(docs, wanted, words, id_col, text, slice_bytes), "sets")

    def roots(links: DataFrame) -> DataFrame:
        return materialise(components(links).select(F.col("node").alias("id"), F.col("component").alias("root")), "roots")

    def star(pivot: str) -> DataFrame:
        return active.where((F.col("id") != F.col(pivot)["id"])).where(_alike("n", f"{pivot}.n", percent)).select(
            F.least("id", f"{pivot}.id").alias("a"), F.greatest("id", f"{pivot}.id").alias("b"), "id")

    # One pivot for each document at a time: the smallest among those of its bands, then the largest.
    nearest = star("low").groupBy("id").agg(F.min(F.struct("a", "b")).alias("p")).select("p.*").distinct()
    links = materialise(_confirmed(nearest, sets, percent), "links")
    farthest = star("high").groupBy("id").agg(F.max(F.struct("b", "a")).alias("p")).select("p.a", "p.b").distinct()
    apart = _apart_pairs(farthest, roots(links))
    links = links.union(materialise(_confirmed(apart, sets, percent), "links"))
    small, large = _remaining(active, roots(links), reps, sets, percent)
    links = links.union(materialise(_confirmed(small, sets, percent), "links")).union(materialise(large, "links"))
    root = roots(links).withColumnRenamed("id", "rep")
    return joined(members, root, ["rep"], hot).select(
        "id", F.col("n").alias("n_shingles"), F.coalesce("root", "rep", "id").alias("component"))


def _apart_pairs(pairs: DataFrame, root: DataFrame) -> DataFrame:
    of = lambda c, r: root.select(F.col("id").alias(c), F.col("root").alias(r))
    return pairs.join(of("a", "ra"), "a", "left").join(of("b", "rb"), "b", "left").where(
        F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b")


def _remaining(active: DataFrame, root: DataFrame, reps: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(pairs of small bands to confirm, links of large bands) between members that lie in different components."""
    placed = active.select("band", "id", "n", "c").join(root, "id", "left").withColumn("root", F.coalesce("root", "id"))
    mixed = placed.groupBy("band").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1").select("band")
    left = materialise(placed.join(mixed, "band", "left_semi"), "apart")
    few = left.where(F.col("c") <= SMALL)
    side = lambda x: few.select("band", F.col("id").alias(x), F.col("n").alias("n" + x), F.col("root").alias("r" + x))
    pairs = side("a").join(side("b"), "band").where((F.col("a") < F.col("b")) & (F.col("ra") != F.col("rb"))).where(
        _alike("na", "nb", percent)).select("a", "b").distinct()
    known = reps.select("id", "n", "signs", "bands").join(sets, "id")
    many = left.where(F.col("c") > SMALL)
    # Members of one component need no comparison: those of a band's largest component meet only the blocks of the others.
    parts = many.groupBy("band", "root").agg(F.count("*").alias("m"))
    parts = parts.groupBy("band").agg(F.max(F.struct("m", "root")).alias("core"), F.sum("m").alias("m"))
    parts = materialise(parts.select("band", F.col("core.root").alias("core"), F.ceil((F.col("m") - F.col("core.m")) / BLOCK).cast("int").alias("outer"),
                                     F.ceil(F.col("core.m") / BLOCK).cast("int").alias("inner")), "parts")
    spread = F.xxhash64("id")
    placed = many.join(parts, "band").withColumn("block", F.when(
        F.col("root") == F.col("core"), F.col("outer") + F.pmod(spread, F.col("inner"))).otherwise(F.pmod(spread, F.col("outer"))).cast("int"))
    last = F.when(F.col("root") == F.col("core"), F.col("outer")).otherwise(F.col("outer") + F.col("inner")) - 1
    cells = placed.join(known, ["id", "n"]).withColumn("other", F.explode(F.sequence(F.lit(0), last))).select(
        "band", "id", "n", "root", "signs", "bands", "own", "block", F.least("block", "other").alias("first"),
        F.greatest("block", "other").alias("second"))
    return pairs, cells.groupBy("band", "first", "second").applyInPandas(_linked_in_cell(percent), "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): one row an id, and one for each row without an id."""
    found = clusters(docs, words, percent, id_col, text).select(
        F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), (F.col("component") == F.col("id")).alias("kept"))
    lost = docs.where(F.col(id_col).isNull()).select(
        F.lit(None).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"),
        F.lit(True).alias("kept"))
    return found.union(lost)


def without_copies(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group, in one row; same columns. Rows without an id stay.

    Rows under one id are one document only if their texts are equal; unlike texts are compared and kept each for itself.
    """
    own = docs.where(F.col(id_col).isNotNull()).select(whole_row(docs))
    keyed = text_keys(own.select("row", F.col("row")[id_col].cast("long").alias("id"), F.col("row")[text].alias("text")))
    # Smaller slices: behind other stages the workers hold their tables still.
    kept = clusters(keyed.select("key", "text"), words, percent, "key", "text", SLICE // 4).where("component = id").select(F.col("id").alias("key"))
    stay = keyed.select("key", "row").join(kept, "key", "left_semi").dropDuplicates(["key"])
    return stay.select("row.*").unionByName(docs.where(F.col(id_col).isNull()))
