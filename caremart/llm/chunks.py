"""Substring dedup by content-defined chunking.

A gear hash rolls over the bytes of a text; a chunk ends where ``BITS`` bits of the hash are zero, so boundaries follow the
content and an insertion shifts none beyond its neighbourhood. Chunks hold ``LEAST`` to ``MOST`` bytes, about 56 on average, so a
passage of fifty words holds several whole ones. Chunks are deduplicated by a 128-bit digest: the first occurrence, by
document id and place, stays and every later one goes, in the same document too; a run of removed chunks shorter than ``min_run`` bytes stays.

First occurrences are found by an aggregate that combines on the map side, so a chunk of a third of all documents costs one row per
input partition; only digests that occur twice meet their occurrences again, in a join whose hot partitions Spark can split.

Texts are cut as bytes; a cut that would fall inside a character moves to the character's end, so every chunk is valid UTF-8.

Defined results: a null or empty text has no chunk and stays as it is. Rows that share an id and their text are one document written
twice: they stay as they are, since a chunk is compared by id and place. Unlike texts under one id are documents of their own, ordered by a hash of
the text: each is cut by its own spans. Rows with a null id come back untouched and
give no chunk. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caremart.llm.common import mix64, text_slices, utf8_buffers
from caremart.llm.rows import ids_of_unlike_texts
from caremart.session import materialise

LEAST, MOST, BITS, WINDOW = 32, 256, 5, 16


def _gear() -> np.ndarray:
    return (mix64(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def boundaries(raw: np.ndarray, gear: np.ndarray) -> np.ndarray:
    """Places after which the rolling hash of the last ``WINDOW`` bytes allows a cut."""
    h = gear[raw]
    width = 1
    while width < WINDOW:
        # The hash of 2w bytes is that of the first w, shifted w times, and that of the last w.
        h[width:] = h[width:] + (h[:-width] << np.uint32(width))
        width *= 2
    # Bits that every byte of the window has reached.
    cut = (h >> np.uint32(WINDOW - 1)) & np.uint32((1 << BITS) - 1)
    return np.flatnonzero(cut == 0) + 1


def chunk_ends(raw: np.ndarray, gear: np.ndarray) -> list[int]:
    """Ends of the chunks of one text, the last being its length."""
    n, ends, last = len(raw), [], 0
    allowed = boundaries(raw, gear).tolist() if n > LEAST else []
    inside = (raw & 0xC0) == 0x80
    k = 0
    while n - last > LEAST:
        while k < len(allowed) and allowed[k] < last + LEAST:
            k += 1
        end = min(allowed[k] if k < len(allowed) else n, last + MOST, n)
        while end < n and inside[end]:
            end += 1
        ends.append(end)
        last = end
    if n > last:
        ends.append(n)
    return ends


def chunks(rows: DataFrame) -> DataFrame:
    """(doc_id, tag, start, size, high, low): every chunk with its digest. ``tag`` tells unlike texts under one id apart, 0 for all others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gear = _gear()
        for batch in batches:
            for part in text_slices(batch, "text"):
                raw, at, _ = utf8_buffers(part.column("text"))
                rows, starts, sizes, digests = [], [], [], bytearray()
                view = memoryview(raw)
                for row in range(len(part)):
                    a, b = int(at[row]), int(at[row + 1])
                    last = 0
                    for end in chunk_ends(raw[a:b], gear):
                        starts.append(last)
                        sizes.append(end - last)
                        digests += xxhash.xxh3_128_digest(view[a + last:a + end])
                        last = end
                    rows.append(len(starts))
                counts = np.diff([0, *rows])
                digest = np.frombuffer(bytes(digests), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c).take(pa.array(np.repeat(np.arange(len(part)), counts))) for c in ("doc_id", "tag")),
                     pa.array(starts, pa.int32()), pa.array(sizes, pa.int32()), pa.array(digest[:, 0]), pa.array(digest[:, 1])],
                    ["doc_id", "tag", "start", "size", "high", "low"])

    return rows.where(F.col("doc_id").isNotNull() & (F.length("text") > 0)).mapInArrow(
        run, "doc_id long, tag long, start int, size int, high long, low long")


def tagged(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(doc_id, text, tag) of all rows."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    shared = ids_of_unlike_texts(rows.where("id IS NOT NULL")).select("id", F.lit(True).alias("unlike"))
    # Mostly no row, so the texts don't move.
    tag = F.when(F.col("unlike"), F.coalesce(F.xxhash64("text"), F.lit(0))).otherwise(F.lit(0)).cast("long")
    return rows.join(shared, "id", "left").select(F.col("id").alias("doc_id"), "text", tag.alias("tag"))


def removed_spans(rows: DataFrame, min_run: int) -> DataFrame:
    """(doc_id, tag, spans): byte ranges [start, end) that repeat earlier chunks, for the texts of ``tagged`` rows that have any."""
    pieces = materialise(chunks(rows), "chunks")
    place = F.struct("doc_id", "tag", "start")
    repeated = pieces.groupBy("high", "low").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last")
    later = pieces.join(repeated.select("high", "low", "first"), ["high", "low"]).where(place > F.col("first")).select(
        "doc_id", "tag", F.struct("start", (F.col("start") + F.col("size")).alias("end")).alias("span"))
    # A text's own chunks; equal rows of one id give equal spans, hence the set.
    own = later.groupBy("doc_id", "tag").agg(F.array_sort(F.collect_set("span")).alias("spans"))
    return own.select("doc_id", "tag", F.filter(_runs(F.col("spans")), lambda s: s["end"] - s["start"] >= min_run).alias("spans")).where(
        F.size("spans") > 0)


def _runs(spans: F.Column) -> F.Column:
    """Adjoining spans as one."""
    starts = F.filter(F.transform(spans, lambda s, i: F.when((i == 0) | (F.get(spans, i - 1)["end"] < s["start"]), s["start"])),
                      lambda x: x.isNotNull())
    ends = F.filter(F.transform(spans, lambda s, i: F.when(
        (i == F.size(spans) - 1) | (F.get(spans, i + 1)["start"] > s["end"]), s["end"])), lambda x: x.isNotNull())
    return F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("start"), b.alias("end")))


def dedup(docs: DataFrame, min_run: int = LEAST, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, spans, text) for every row; ``text`` without the removed bytes."""
    rows = tagged(docs, id_col, text)
    joined = rows.join(removed_spans(rows, min_run), ["doc_id", "tag"], "left")
    body = F.encode("text", "UTF-8")
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    none = F.array().cast("array<struct<start:int,end:int>>")
    have = F.coalesce("spans", none)
    # What stays lies before the first span, between neighbours, and after the last.
    starts = F.concat(F.array(F.lit(0)), F.transform("spans", lambda s: s["end"]))
    stays = F.transform(starts, lambda a, i: F.decode(F.substr(
        body, a + 1, F.coalesce(F.get(F.col("spans"), i)["start"], F.octet_length("text")) - a), "UTF-8"))
    return joined.select(
        "doc_id", size.cast("long").alias("n_bytes"),
        F.aggregate(have, F.lit(0).cast("long"), lambda t, s: t + s["end"] - s["start"]).alias("n_removed"),
        F.size(have).cast("long").alias("n_spans"), have.alias("spans"),
        F.when(F.col("spans").isNull(), F.col("text")).otherwise(F.array_join(stays, "")).alias("text"))
