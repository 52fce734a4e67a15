"""Packing of documents into sequences in space-filling-curve order.

A document's token ids are hashed into a count vector and projected to ``DIMS`` dimensions; the Hilbert key of the point orders the
documents, so neighbours in a sequence use similar tokens. The rows (key, hash of the id) are range-sorted, which also splits a
key that many copies share. Running token sums place every document in one long stream that is cut every ``length`` tokens: full
sequences have no padding at all, and the rest at the very end is cut at powers of two.

Token ids are computed once, kept as 16- or 32-bit numbers in a written table, and meet their places by a join on the row's number.

Tokenizing: words recur, so each distinct word is given to the tokenizer's model once per worker and its ids are kept, as are those of
each run of words and marks between white space (bounded tables). That path is taken for texts of common Latin characters only, and only if the tokenizer file declares the steps that the
path takes (lower case, splitting by a pattern, bytes as characters); any other text goes to the tokenizer whole. tests/llm holds both against the tokenizer.

Defined results: a null or empty text is its end id alone. A row is a document even if its id
repeats or is null. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caremart.llm.common import kept_by_process, text_slices
from caremart.session import materialise

DIMS, BITS, FEATURES = 4, 8, 1024
#: Distinct words a worker keeps.
KEPT_WORDS = 400_000
#: Runs between white space that a worker keeps, none longer than so many characters.
KEPT_RUNS, LONGEST_KEPT_RUN = 200_000, 64
RANGES_PER_PARTITION = 4

#: Characters for which the pattern below splits as the tokenizer file declares: printable ASCII and white space,
#: Latin letters, common punctuation. Left out are other digits, combining marks and letters with special cases.
_UNSAFE = re.compile("[^\t\n\r\x20-\x7e\xa1-\xa9\xab-\xb1\xb4\xb6-\xb8\xbb\xbf-įĴ-ňŊ-ž–—‘-„…€]")
_PIECES = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
#: Fixed value: the pattern of the tokenizer files for which the path by words is right.
_DECLARED = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _byte_characters() -> dict[int, str]:
    """Byte-level vocabularies write printable Latin-1 bytes as themselves and the others from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


def _by_words(tokenizer) -> bool:
    """Whether the file's steps are those of the path by words."""
    steps = json.loads(tokenizer.to_str())
    kinds = lambda part, key: [x["type"] for x in (steps[part] or {}).get(key, [])]
    if kinds("normalizer", "normalizers") != ["NFC", "Replace", "Lowercase"] or kinds("pre_tokenizer", "pretokenizers") != ["Split", "ByteLevel"]:
        return False
    split, level = steps["pre_tokenizer"]["pretokenizers"]
    return split["pattern"] == {"Regex": _DECLARED} and split["invert"] and not level["add_prefix_space"] and not level["use_regex"]


class _Words(dict):
    """Token ids of a piece as bytes, looked up or computed."""

    def __init__(self, tokenizer, dtype: str):
        super().__init__()
        self.model, self.dtype, self.characters = tokenizer.model, dtype, _byte_characters()

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= KEPT_WORDS:
            self.clear()
        plain = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.characters)
        ids = np.array([t.id for t in self.model.tokenize(plain)], self.dtype).tobytes()
        self[piece] = ids
        return ids


class _Runs(dict):
    """Token ids of the text between two white spaces as bytes, looked up or put together from its pieces, none of which has white space."""

    def __init__(self, words: _Words):
        super().__init__()
        self.words = words

    def __missing__(self, run: str) -> bytes:
        ids = b"".join(map(self.words.__getitem__, _PIECES.findall(run)))
        # The frequent ones come early; a full table stays.
        if len(self) < KEPT_RUNS and len(run) <= LONGEST_KEPT_RUN:
            self[run] = ids
        return ids


@kept_by_process
def encoder(path: str, end_id: int) -> tuple[Callable[[str | None], np.ndarray], str]:
    """(text to ids with ``end_id`` last, dtype of the ids): kept by the process, with the words it knows, for its later tasks."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    dtype = "<u2" if tokenizer.get_vocab_size() < 65536 and end_id < 65536 else "<u4"
    runs, end = _Runs(_Words(tokenizer, dtype)), np.array([end_id], dtype).tobytes()
    by_words = _by_words(tokenizer)
    specials = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

    def encode(text: str | None) -> np.ndarray:
        if not text:
            return np.frombuffer(end, dtype)
        if not by_words or _UNSAFE.search(text) or any(s in text for s in specials):
            return np.array(tokenizer.encode(text, add_special_tokens=False).ids + [end_id], dtype)
        # The safe characters that split() parts at are those that the pattern parts at.
        return np.frombuffer(b"".join(chain(map(runs.__getitem__, text.lower().split()), [end])), dtype)

    return encode, dtype


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of grid coordinates below 2^bits."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    # From the finest cube to the coarsest, undo the reflections and exchanges of the curve.
    for level in range(bits - 1, 0, -1):
        bit, below = 1 << level, (1 << level) - 1
        for axis in range(n):
            turned = (x[axis] & bit) != 0
            swap = np.where(turned, 0, (x[0] ^ x[axis]) & below)
            x[0] = np.where(turned, x[0] ^ below, x[0] ^ swap)
            x[axis] ^= swap
    for axis in range(1, n):
        x[axis] ^= x[axis - 1]
    flips = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flips = np.where(x[n - 1] & (1 << level), flips ^ ((1 << level) - 1), flips)
    x ^= flips
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for axis in range(n):
            key = (key << 1) | ((x[axis] >> level) & 1)
    return key


@lru_cache(maxsize=1)
def _projection() -> np.ndarray:
    table = np.random.default_rng(20_240_501).standard_normal((FEATURES, DIMS))
    # As doubles, so that no document casts them again.
    return (table - table.mean(axis=0)).astype(np.float32).astype(np.float64)


def curve_keys(ids: list[np.ndarray]) -> np.ndarray:
    """Hilbert keys of documents by their token ids."""
    projection, out = _projection(), np.empty((len(ids), DIMS))
    for row, own in enumerate(ids):
        counts = np.sqrt(np.bincount(((own.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(22)), minlength=FEATURES))
        out[row] = counts @ projection / np.sqrt(counts @ counts)
    grid = np.clip((np.tanh(out) + 1) / 2 * (1 << BITS), 0, (1 << BITS) - 1)
    return hilbert(grid.astype(np.int64), BITS)


def tokenized(docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n, curve, ids): written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, _ = encoder(path, end_id)
        for batch in batches:
            for part in text_slices(batch, "text"):
                ids = [encode(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(i) for i in ids], pa.int64()), pa.array(curve_keys(ids), pa.int64()),
                     pa.array([i.tobytes() for i in ids], pa.binary())], ["doc_id", "n", "curve", "ids"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    out = rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n long, curve long, ids binary")
    return materialise(out.withColumn("row", F.monotonically_increasing_id()), "token-ids")


def places(rows: DataFrame) -> DataFrame:
    """(row, pos): the place of each row's first token in the stream, from (row, n, curve)."""
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) * RANGES_PER_PARTITION
    tie = F.xxhash64("row")
    ranged = rows.select("row", "n", "curve", tie.alias("tie")).repartitionByRange(partitions, "curve", "tie")
    ranged = materialise(ranged.withColumn("part", F.spark_partition_id()), "curve-order")
    totals = ranged.groupBy("part").agg(F.sum("n").alias("n"))
    # One row for each range.
    before = totals.select("part", F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    own = F.sum("n").over(Window.partitionBy("part").orderBy("curve", "tie", "row").rowsBetween(Window.unboundedPreceding, 0))
    return ranged.withColumn("own", own).join(before, "part").select(
        "row", (F.col("base") + F.col("own") - F.col("n")).alias("pos"))


def sequence_edges(total: int, length: int) -> tuple[int, list[int]]:
    """(full sequences, lengths of the powers of two that make up the rest)."""
    full, rest = divmod(total, length)
    return full, [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, path: str, end_id: int = 1, length: int = 2048, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a piece: doc_id, start, length, doc_tokens, sequence_id, offset, and ids as little-endian 32-bit numbers.

    ``path`` is a tokenizer file that every executor can open.
    """
    if length < 1:
        raise ValueError("length must be positive")
    rows = tokenized(docs, path, end_id, id_col, text)
    total = rows.agg(F.sum("n")).first()[0] or 0
    full, tail = sequence_edges(total, length)
    starts = np.array([full * length, *(full * length + np.cumsum(tail))], np.int64)
    wide = "<u2" if _narrow(path, end_id) else "<u4"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, begin, size, n, seq, off, ids = ([] for _ in range(7))
            for k, (raw, pos, count) in enumerate(zip(
                    batch.column("ids").to_pylist(), batch.column("pos").to_pylist(), batch.column("n").to_pylist(), strict=True)):
                own, at = np.frombuffer(raw, wide).astype("<u4"), pos
                while at < pos + count:
                    if at < starts[0]:
                        s, first, last = at // length, at // length * length, (at // length + 1) * length
                    else:
                        j = int(np.searchsorted(starts, at, side="right")) - 1
                        s, first, last = full + j, int(starts[j]), int(starts[j + 1])
                    end = min(last, pos + count)
                    doc.append(k)
                    begin.append(at - pos)
                    size.append(end - at)
                    n.append(count)
                    seq.append(s)
                    off.append(at - first)
                    ids.append(own[at - pos:end - pos].tobytes())
                    at = end
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(doc, pa.int64())), *(pa.array(v, pa.int64()) for v in (begin, size, n, seq, off)),
                 pa.array(ids, pa.binary())], ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    joined = rows.select("row", "doc_id", "n", "ids").join(places(rows), "row").select("doc_id", "n", "pos", "ids")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(cut, f"doc_id {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")


def _narrow(path: str, end_id: int) -> bool:
    return encoder(path, end_id)[1] == "<u2"
