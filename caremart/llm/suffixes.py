"""Dedup of repeated byte strings by minimizers and window hashes.

The method dealt was a depth-limited most-significant-digit radix sort of suffixes. It was exchanged: no suffix is ordered by its leading
bytes. A "digit" here is a hash, of a part of a window or of all its ``length`` bytes; windows that fall together in all hashes count as
equal and are not compared byte by byte. Only groups with more than one document go to the next digit:

1. Each window of ``length`` bytes is filed under its smallest hashed ``DIGIT``-byte string (leftmost on ties), which equal windows share.
   Consecutive windows with the same one form a run, so a text has about one run in 16 bytes. Runs are dealt by the first digit, its hash,
   and sorted.
2. Within a group the second digit is the whole content of a run. A run whose content a smaller document has is settled: all its
   windows are repeated.
3. Runs that share the first digit only, first of their content, are taken apart into windows, dealt by the hash of
   all ``length`` bytes and sorted again.

Runs are packed as arrays, so the shuffle moves about 21 bytes a run, and a content that a smaller document of the same
slice of input has is settled before it: a passage of a third of all documents costs one run for each slice. What a group finds
is packed by buckets of documents too, and becomes one row a document there. Runs under one digit mostly share the digit's real bytes, so there
equality rests on the 64 bits of the content alone: of n different runs with one digit about n * n / 2 ** 65 pairs fall together (10 million: 3 in a
million). The part is a function of the digit and adds none. The texts
themselves move compressed, once for the windows and once for the cut. Very long texts are read in pieces that overlap by a window.

Defined results: a null text is empty; texts below ``length`` bytes lose nothing. Rows that share an id never match each
other, and each is compared by its own text. Rows with a null id come back as they are. An empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caremart.llm.common import mix64, text_slices, utf8_buffers
from caremart.session import materialise

DIGIT = 20
#: Bytes of text whose runs are found at a time; a longer text comes in overlapping pieces.
SLICE = 300_000
#: Bytes of text whose runs one group sorts.
TEXT_OF_GROUP = 8_000_000
_TABLES = tuple(mix64(np.arange(k, k + 256, dtype=np.uint64)) for k in (5001, 9001))
_FACTORS = (0xD1342543DE82EF95, 0x2545F4914F6CDD1D)
_DOC = np.dtype([("id", "<i8"), ("tag", "<i4"), ("rows", "<u4")])
#: The digit has 48 bits beside those that choose the part; ``left`` and ``right`` go with it 15 bytes on to either side.
_RUN = np.dtype([("digit", "<u4"), ("more", "<u2"), ("content", "<u8"), ("left", "u1"), ("right", "u1"), ("at", "<u4"), ("windows", "u1")])
_SPAN = np.dtype([("start", "<u4"), ("end", "<u4")])
_SETTLED, _OPEN = 0, 1
_PACKED = "part int, docs binary, runs binary, spans binary"
_FOUND = "bucket int, kind int, docs binary, data binary"
_OF_DOCUMENT = "id long, tag int, data binary"


class _Prefix:
    """Hashes of any byte range of a buffer, by prefix sums."""

    def __init__(self, raw: np.ndarray, which: int):
        factor = _FACTORS[which]
        power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(raw), factor, np.uint64)]), dtype=np.uint64)
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(_TABLES[which][raw] * power[:-1], dtype=np.uint64)])
        self.back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(raw), pow(factor, -1, 1 << 64), np.uint64)]), dtype=np.uint64)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[start]) * self.back[start])


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest of each ``width`` consecutive values, the leftmost on ties."""
    place, have = np.arange(len(values), dtype=np.int32), 1
    while have < width:
        step = min(have, width - have)
        left, right = place[:len(place) - step], place[step:]
        place = np.where(values[right] < values[left], right, left)
        have += step
    return place


def _digit(out: np.ndarray, hashes: np.ndarray) -> None:
    out["digit"], out["more"] = hashes >> np.uint64(32), hashes & np.uint64(0xFFFF)


def _digits(records: np.ndarray) -> np.ndarray:
    return (records["digit"].astype(np.uint64) << np.uint64(16)) | records["more"]


def runs(raw: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(row of each run, its record): all windows of the texts between the places ``at``."""
    none = np.zeros(0, np.int64), np.zeros(0, _RUN)
    if len(raw) < length:
        return none
    digit = min(DIGIT, length)
    prefix = _Prefix(raw, 0)
    begin = np.arange(len(raw) - digit + 1)
    hashes = prefix.of(begin, begin + digit)
    best = _smallest(hashes, length - digit + 1)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    start = np.arange(len(best))
    start = start[start + length <= at[row[start] + 1]]
    if not len(start):
        return none
    best = best[start]
    first = np.flatnonzero(np.concatenate([[True], (best[1:] != best[:-1]) | (start[1:] != start[:-1] + 1)]))
    count = np.diff(np.concatenate([first, [len(start)]]))
    low = start[first]
    out = np.zeros(len(first), _RUN)
    _digit(out, hashes[best[first]])
    out["windows"], out["at"] = count, low - at[row[low]]
    # Equal windows agree on half of the other bytes at least, all on one side of the digit.
    half = (length - digit + 1) // 2
    here, to = best[first], best[first] + digit
    out["left"] = prefix.of(np.maximum(here - half, at[row[low]]), to) >> np.uint64(56)
    out["right"] = prefix.of(here, np.minimum(to + half, at[row[low] + 1])) >> np.uint64(56)
    shape = mix64(((best[first] - low) * 256 + count).astype(np.uint64))
    out["content"] = mix64(prefix.of(low, low + count - 1 + length) ^ shape)
    return row[low], out


def windows(raw: np.ndarray, at: np.ndarray, open_runs: list[np.ndarray], length: int, low: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(row, record) of each single window of the open runs of each text; ``raw`` begins at the byte ``low`` of its text."""
    counts = [r["windows"].astype(np.int64) for r in open_runs]
    row = np.repeat(np.arange(len(open_runs)), [c.sum() for c in counts])
    if not len(row):
        return row, np.zeros(0, _RUN)
    each = np.concatenate(counts)
    begin = np.repeat(np.concatenate([r["at"].astype(np.int64) for r in open_runs]), each)
    begin += np.arange(len(begin)) - np.repeat(np.cumsum(each) - each, each)
    own = at[row] + begin - low
    out = np.zeros(len(row), _RUN)
    _digit(out, _Prefix(raw, 0).of(own, own + length))
    out["content"] = _Prefix(raw, 1).of(own, own + length)
    out["at"], out["windows"] = begin, 1
    return row, out


def _settle(ids: np.ndarray, records: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, settled, open) along the sorted records: content that a smaller id has, and first contents that share the
    digit and the bytes on one side of it with another id."""
    digits = _digits(records)
    order = np.lexsort((ids, records["content"], digits))
    digit, content, own = digits[order], records["content"][order], ids[order]
    new = np.concatenate([[True], (digit[1:] != digit[:-1]) | (content[1:] != content[:-1])])
    settled = own > own[np.flatnonzero(new)][np.cumsum(new) - 1]
    several = np.zeros(len(order), bool)
    for side in ("left", "right"):
        key = (digits << np.uint64(8)) | records[side]
        by = np.argsort(key, kind="stable")
        heads = np.flatnonzero(np.concatenate([[True], key[by][1:] != key[by][:-1]]))
        least, most = (f.reduceat(ids[by], heads) for f in (np.minimum, np.maximum))
        # One content alone has nothing left to settle.
        c0, c1 = (f.reduceat(records["content"][by], heads) for f in (np.minimum, np.maximum))
        apart = np.zeros(len(order), bool)
        apart[by] = np.repeat((least < most) & (c0 < c1), np.diff([*heads, len(by)]))
        several |= apart
    return order, settled, ~settled & several[order]


def _spans(records: np.ndarray, length: int) -> np.ndarray:
    out = np.zeros(len(records), _SPAN)
    out["start"] = records["at"]
    out["end"] = records["at"] + records["windows"].astype(np.uint32) - 1 + length
    return out


def _part(key: np.ndarray, parts: int) -> np.ndarray:
    return mix64(key) % np.uint64(parts)


def _bucket(docs: np.ndarray, parts: int) -> np.ndarray:
    """Where the findings of a document meet."""
    return _part(docs["id"].astype(np.uint64) ^ mix64(docs["tag"].astype(np.uint64)), parts)


def _folded(part: np.ndarray, docs: np.ndarray, data: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(part, its documents with their numbers of records, the records), from one document and record a row."""
    if not len(part):
        return
    by = np.lexsort((docs["tag"], docs["id"], part))
    part, docs, data = part[by], docs[by], data[by]
    new = (part[1:] != part[:-1]) | (docs["id"][1:] != docs["id"][:-1]) | (docs["tag"][1:] != docs["tag"][:-1])
    heads = np.flatnonzero(np.concatenate([[True], new]))
    ends = np.append(heads, len(part))
    docs, part = docs[heads], part[heads]
    docs["rows"] = np.diff(ends)
    edges = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    for a, b in zip(edges, [*edges[1:], len(part)], strict=True):
        yield int(part[a]), docs[a:b], data[ends[a]:ends[b]]


def _unfolded(docs: pd.Series, data: pd.Series, dtype: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """One document and record a row."""
    docs = np.frombuffer(b"".join(docs), _DOC)
    return np.repeat(docs, docs["rows"]), np.frombuffer(b"".join(data), dtype)


def _packed(docs: np.ndarray, records: np.ndarray, parts: int, length: int) -> pa.RecordBatch | None:
    """One row a part: its runs with their documents, and the spans that this slice settles."""
    if not len(docs):
        return None
    order, settled, _ = _settle(docs["id"], records)
    done, rest = order[settled], order[~settled]
    runs = list(_folded(_part(_digits(records[rest]), parts), docs[rest], records[rest]))
    spans = list(_folded(_bucket(docs[done], parts), docs[done], _spans(records[done], length)))
    none = pa.nulls
    return pa.RecordBatch.from_arrays(
        [pa.array([p for p, _, _ in runs + spans], pa.int32()),
         pa.array([d.tobytes() for _, d, _ in runs + spans], pa.binary()),
         pa.concat_arrays([pa.array([x.tobytes() for _, _, x in runs], pa.binary()), none(len(spans), pa.binary())]),
         pa.concat_arrays([none(len(runs), pa.binary()), pa.array([x.tobytes() for _, _, x in spans], pa.binary())])],
        ["part", "docs", "runs", "spans"])


def _pieces(part: pa.RecordBatch, overlap: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, int, int]]:
    """(first row, bytes, starts of the texts in them, low, high): whole texts, or the piece of one long text for the windows
    that start at low or later and before high."""
    raw, at, _ = utf8_buffers(part.column("text"))
    last = 0
    for row in [*np.flatnonzero(np.diff(at) > 2 * SLICE), len(part)]:
        if row > last:
            yield last, raw[at[last]:at[row]], at[last:row + 1] - at[last], 0, 1 << 32
        if row < len(part):
            body = raw[at[row]:at[row + 1]]
            for low in range(0, len(body), SLICE):
                piece = body[low:low + SLICE + overlap]
                yield row, piece, np.array([0, len(piece)]), low, low + SLICE
        last = row + 1


def _documents(part: pa.RecordBatch) -> np.ndarray:
    out = np.zeros(len(part), _DOC)
    out["id"], out["tag"] = part.column("id").to_numpy(), part.column("tag").to_numpy()
    return out


def _sorted_group(length: int, last: bool, parts: int):
    """Sort one part and tell each document what is settled and, unless this is the last digit, what stays open."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        found = []

        def tell(docs: np.ndarray, data: np.ndarray, kind: int) -> None:
            found.extend((b, kind, d.tobytes(), x.tobytes()) for b, d, x in _folded(_bucket(docs, parts), docs, data))

        ready = pdf[pdf["spans"].notna()]
        if len(ready):
            tell(*_unfolded(ready["docs"], ready["spans"], _SPAN), _SETTLED)
        rows = pdf[pdf["runs"].notna()]
        if len(rows):
            docs, data = _unfolded(rows["docs"], rows["runs"], _RUN)
            order, settled, still = _settle(docs["id"], data)
            tell(docs[order[settled]], _spans(data[order[settled]], length), _SETTLED)
            if not last:
                tell(docs[order[still]], data[order[still]], _OPEN)
        return pd.DataFrame(found, columns=["bucket", "kind", "docs", "data"])

    return run


def _by_document(found: DataFrame, kind: int, dtype: np.dtype) -> DataFrame:
    """(id, tag, data): all that was found of a document, in one row."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        docs, data = _unfolded(pdf["docs"], pdf["data"], dtype)
        (_, docs, data), = _folded(np.zeros(len(docs), np.uint8), docs, data)
        ends = np.cumsum(docs["rows"].astype(np.int64))
        each = [data[a:b].tobytes() for a, b in zip(ends - docs["rows"], ends, strict=True)]
        return pd.DataFrame({"id": docs["id"].astype(np.int64), "tag": docs["tag"].astype(np.int32), "data": each})

    return found.where(F.col("kind") == kind).groupBy("bucket").applyInPandas(run, _OF_DOCUMENT)


def dedup(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept) for every row: ``kept`` holds the bytes outside the spans [start, end)."""
    if not 1 <= length <= 128:
        raise ValueError("length must be between 1 and 128")
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), body.alias("text"), F.hash(body).alias("tag"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // TEXT_OF_GROUP + 1)

    def first_digit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text", SLICE):
                docs = _documents(part)
                for first, raw, at, low, _ in _pieces(part, length - 1):
                    row, records = runs(raw, at, length)
                    records["at"] += low
                    out = _packed(docs[first + row], records, parts, length)
                    if out is not None:
                        yield out

    def all_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in map(_restored, batches):
            for part in text_slices(batch, "text", SLICE):
                docs = _documents(part)
                still = [np.frombuffer(x, _RUN) for x in part.column("open").to_pylist()]
                for first, raw, at, low, high in _pieces(part, 255 + length):
                    own = [r[(r["at"] >= low) & (r["at"] < high)] for r in still[first:first + len(at) - 1]]
                    row, records = windows(raw, at, own, length, low)
                    out = _packed(docs[first + row], records, parts, length)
                    if out is not None:
                        yield out

    sortable = rows.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("id"), "tag", "text")
    one = sortable.mapInArrow(first_digit, _PACKED).groupBy("part").applyInPandas(_sorted_group(length, False, parts), _FOUND)
    one = materialise(one, "first-digit")
    texts = sortable.mapInArrow(_squeezed, "id long, tag int, body binary")
    unsure = texts.join(_by_document(one, _OPEN, _RUN).withColumnRenamed("data", "open"), ["id", "tag"])
    two = unsure.select("id", "tag", "body", "open").mapInArrow(all_bytes, _PACKED).groupBy("part").applyInPandas(
        _sorted_group(length, True, parts), _FOUND)
    # Written, so that the files of this shuffle are gone before the texts move once more.
    two = materialise(two, "all-bytes")
    settled = _by_document(one.unionByName(two), _SETTLED, _SPAN).withColumnRenamed("data", "spans")
    final = texts.join(settled, ["id", "tag"], "left").select(F.col("id").alias("doc_id"), "body", "spans")
    lost = rows.where(F.col("doc_id").isNull()).select("doc_id", "tag", "text").mapInArrow(
        _squeezed, "doc_id long, tag int, body binary").select("doc_id", "body", F.lit(None).cast("binary").alias("spans"))
    return final.union(lost).mapInArrow(
        _cut, "doc_id long, n_bytes long, n_removed long, spans array<struct<start:int,end:int>>, kept binary")


def _squeezed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as compressed bytes, which is what moves."""
    press = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        body = pa.array([press.compress(t.encode()) for t in batch.column("text").to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], body], [*batch.schema.names[:2], "body"])


def _restored(batch: pa.RecordBatch) -> pa.RecordBatch:
    press, k = zstandard.ZstdDecompressor(), batch.schema.get_field_index("body")
    texts = pa.array([press.decompress(x).decode() for x in batch.column("body").to_pylist()], pa.string())
    return batch.set_column(k, "text", texts)


def merged(spans: np.ndarray) -> np.ndarray:
    """Maximal runs of covered bytes."""
    if not len(spans):
        return spans
    spans = spans[np.argsort(spans["start"], kind="stable")]
    reach = np.maximum.accumulate(spans["end"])
    heads = np.flatnonzero(np.concatenate([[True], spans["start"][1:] > reach[:-1]]))
    out = np.zeros(len(heads), _SPAN)
    out["start"], out["end"] = spans["start"][heads], reach[[*(heads[1:] - 1), len(spans) - 1]]
    return out


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    for batch in map(_restored, batches):
        sizes, gone, spans, kept = [], [], [], []
        for body, found in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            raw = body.encode()
            own = merged(np.frombuffer(found or b"", _SPAN))
            pieces, last = [], 0
            for a, b in own.tolist():
                pieces.append(raw[last:a])
                last = b
            pieces.append(raw[last:])
            sizes.append(len(raw))
            kept.append(b"".join(pieces))
            gone.append(len(raw) - len(kept[-1]))
            spans.append([{"start": a, "end": b} for a, b in own.tolist()])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "spans", "kept"])
