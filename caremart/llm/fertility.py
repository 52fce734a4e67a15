"""Quality rules by tokeniser fertility.

Public vocabularies measure each text by its words: characters and letters per token under a byte-fallback vocabulary, letters per token under
a byte-level one, the share of tokens that are single bytes for want of a better one, and the entropy of its tokens. Text of the kind a language's other texts are
made of splits into tokens as those do; runs of symbols, shouting, keyboard noise, encoded data and repeated words do not. A text
is kept if each measure lies in the band of its language, taken at its own length: ``len_class`` is the doubling of the number of words.

Bands are quartiles widened by ``WIDTH`` times their distance (at least the measure's ``spread``), over all documents that pass the base rules. They come
from histograms with bins of fixed width, which are added up by aggregation. A language that holds more than a thousandth of all documents
has bands of its own (so fewer than a thousand have); others, and lengths with under ``MIN_GROUP`` documents, take those of
their main script, then those of all documents of the length, and then those of all documents. Where even these are missing, only the
base rules decide.

Tokens are taken word by word: words recur, so the tokens of a word are computed once per worker and kept in a bounded table.

Base rules: at least ``MIN_WORDS`` words, and at most ``MAX_REPEATED_PERCENT`` of them in windows of ``WINDOW`` words that occur twice in the text.

Defined results: a null or empty text has no words and fails the base rules. A null language is none and
takes the bands of the script. A row is a document even if its id repeats or is null. A text that passes the base rules but has no token
(characters that a vocabulary drops) is not kept. An empty table gives no rows. Other columns are ignored. Memory of a task follows
the longest text (about 40 times its words in bytes).
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caremart.llm.common import text_slices
from caremart.llm.words import blocks
from caremart.session import materialise

# The base rules.
MIN_WORDS, MAX_REPEATED_PERCENT, WINDOW = 20, 30, 8

#: Distinct words and their bytes that a worker keeps.
KEPT_WORDS, KEPT_BYTES = 300_000, 32_000_000
#: Bytes of text measured at a time.
SLICE = 2_000_000
#: A language with more than 1/LANGUAGE_PARTS of the documents has its own bands.
LANGUAGE_PARTS = 1000
#: Documents that make a band.
MIN_GROUP = 200
#: Stands for all lengths together.
ANY_LENGTH = -1
#: Distances between the quartiles that a band reaches beyond them.
WIDTH = 3.0
#: Bin and least distance between the quartiles of each measure.
MEASURES = {
    "chars_per_piece": (0.01, 0.08),
    "letters_per_piece": (0.01, 0.08),
    "letters_per_rank": (0.01, 0.08),
    "fallback_share": (0.002, 0.01),
    "token_entropy": (0.02, 0.25),
}

# Scripts by ranges of code points. A character of a script counts as a letter.
SCRIPTS = {
    "Latin": ((0x41, 0x5A), (0x61, 0x7A), (0xC0, 0x24F), (0x1E00, 0x1EFF)),
    "Greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "Cyrillic": ((0x400, 0x52F),),
    "Armenian": ((0x530, 0x58F),),
    "Hebrew": ((0x590, 0x5FF),),
    "Arabic": ((0x600, 0x6FF), (0x750, 0x77F)),
    "Devanagari": ((0x900, 0x97F),),
    "Bengali": ((0x980, 0x9FF),),
    "Tamil": ((0xB80, 0xBFF),),
    "Thai": ((0xE00, 0xE7F),),
    "Georgian": ((0x10A0, 0x10FF),),
    "Kana": ((0x3040, 0x30FF),),
    "Han": ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FFFF)),
    "Hangul": ((0x1100, 0x11FF), (0xAC00, 0xD7AF)),
}
NO_SCRIPT = "none"
SYMBOLS = "#*$%&|<>"

_SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_SYMBOL = np.isin(np.arange(256), list(SYMBOLS.encode()))
_MEASURED = ("n_words long, word_chars long, n_letters long, n_symbols long, n_dup_lines long, n_repeat_words long, script string, n_pieces long, "
             "n_ranks long, n_fallback long, token_entropy double")


def _script_table() -> np.ndarray:
    """Number of the script, 0 for none, by the first two bytes of a character in UTF-8."""
    table = np.zeros(1 << 16, np.uint8)
    for number, ranges in enumerate(SCRIPTS.values(), 1):
        for low, high in ranges:
            if high < 0x80:
                # One byte, whatever follows.
                table[low << 8:(high + 1) << 8] = number
            else:
                # Longer characters: those that share two bytes are neighbours; the first one speaks for them.
                step = 1 if high < 0x800 else 64 if high < 0x10000 else 4096
                for point in range(low - low % step if low % step else low, high + 1, step):
                    first, second = chr(point).encode()[:2]
                    table[first << 8 | second] = number
    return table


class _Index(dict):
    """Numbers of words by first use; new words are listed."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number


class Tokens:
    """The tokens of words under a byte-fallback vocabulary (pieces) and a byte-level one (ranks)."""

    def __init__(self, pieces: str, ranks: str, pattern: str):
        import sentencepiece
        import tiktoken

        self.pieces = sentencepiece.SentencePieceProcessor(model_file=pieces)
        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.ranks = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens={})
        self.size = self.pieces.get_piece_size()
        self.single = np.array([self.pieces.is_byte(k) for k in range(self.size)])
        self._clear()

    def _clear(self) -> None:
        self.index, self.bytes = _Index(), 0
        # By word: where its pieces start in ``flat`` (one more for the end), and its number of ranks.
        self.starts, self.flat, self.n_ranks = np.zeros(1, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32)

    def make_room(self) -> None:
        if len(self.index) > KEPT_WORDS or self.bytes > KEPT_BYTES:
            self._clear()

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, equal for equal words until room is made."""
        out = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        new, self.index.new = self.index.new, []
        if new:
            texts = [w.decode("utf-8", "replace") for w in new]
            ids = self.pieces.encode(texts, num_threads=1)
            ends = self.starts[-1] + np.cumsum([len(x) for x in ids])
            self.starts = np.concatenate([self.starts, ends])
            self.flat = np.concatenate([self.flat, np.fromiter((t for x in ids for t in x), np.int32)])
            more = [len(self.ranks.encode_ordinary(" " + t)) for t in texts]
            self.n_ranks = np.concatenate([self.n_ranks, np.array(more, np.int32)])
            self.bytes += sum(map(len, new))
        return out

    def pieces_of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of pieces of each word, all pieces in order)."""
        count = self.starts[numbers + 1] - self.starts[numbers]
        at = np.repeat(self.starts[numbers] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        return count, self.flat[at]


def repeated_words(numbers: np.ndarray, doc: np.ndarray, window: int) -> np.ndarray:
    """Which words stand in a run of ``window`` words that their document holds twice or more, from the words' numbers and documents.

    Runs are compared exactly: a longer run is known by its first and last shorter run, and only runs that occur twice go on.
    """
    if not len(numbers):
        return np.zeros(0, bool)
    label, have = _repeats(doc * (numbers.max() + 1) + numbers), 1
    while have < window:
        step = min(have, window - have)
        longer = np.full(len(numbers), -1, np.int64)
        at = np.flatnonzero((label[:-step] >= 0) & (label[step:] >= 0))
        # A run that ends in another document has no label of its own length there.
        at = at[at + have + step <= len(doc)]
        at = at[doc[at] == doc[at + have + step - 1]]
        if len(at):
            longer[at] = _repeats(label[at] * (label.max() + 1) + label[at + step])
        label, have = longer, have + step
    at = np.flatnonzero(label >= 0)
    change = np.zeros(len(numbers) + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + window, -1)
    return np.cumsum(change[:-1]) > 0


def _repeats(keys: np.ndarray) -> np.ndarray:
    """A number for each key that occurs twice or more, -1 for the others."""
    _, which, count = np.unique(keys, return_inverse=True, return_counts=True)
    return np.where(count[which] > 1, which, -1)


def _entropies(pieces: np.ndarray, of: np.ndarray, docs: int, size: int) -> np.ndarray:
    """Bits of entropy of the pieces of each document."""
    key, count = np.unique(of * size + pieces, return_counts=True)
    whole = np.bincount(of, minlength=docs).astype(float)
    inner = np.bincount(key // size, count * np.log2(count), minlength=docs)
    return np.log2(np.maximum(whole, 1)) - inner / np.maximum(whole, 1)


def _measure(texts: list[str | None], tokens: Tokens, scripts: np.ndarray) -> dict[str, np.ndarray | list[str]]:
    """The columns of ``_MEASURED`` for some texts; a long text comes alone."""
    bodies = [(t or "").encode() for t in texts]
    joined = b"\n".join(bodies)
    raw = np.frombuffer(joined, np.uint8)
    end = np.cumsum([len(b) + 1 for b in bodies]) - 1
    start = np.concatenate([[0], end[:-1] + 1]).astype(np.int64)
    space, symbol = _SPACE[raw], _SYMBOL[raw]
    inside = ~space & ((raw & 0xC0) != 0x80)
    first = ~space
    first[1:] &= space[:-1]
    doc = np.searchsorted(end, np.flatnonzero(first))
    del first, space
    pair = np.left_shift(raw, 8, dtype=np.uint16)
    pair[:-1] |= raw[1:]
    script = scripts[pair]
    spans = list(zip(start.tolist(), end.tolist(), strict=True))
    names = [NO_SCRIPT, *SCRIPTS]
    lines = [[x for x in b.split(b"\n") if x.strip()] for b in bodies]
    most = [np.bincount(script[a:b], minlength=len(names))[1:] for a, b in spans]
    n = len(texts)
    count = lambda mask: np.array([np.count_nonzero(mask[a:b]) for a, b in spans], np.int64)
    out = {
        "n_words": np.bincount(doc, minlength=n), "word_chars": count(inside), "n_letters": count(script), "n_symbols": count(symbol),
        "n_dup_lines": np.array([len(x) - len(set(x)) for x in lines], np.int64),
        "script": [names[int(m.argmax()) + 1] if m.any() else NO_SCRIPT for m in most],
    }
    del lines, pair, script, inside, symbol
    tokens.make_room()
    numbers = np.concatenate([np.zeros(0, np.int64), *(tokens.numbers(b.split()) for b in blocks(joined))])
    out["n_repeat_words"] = np.bincount(doc[repeated_words(numbers, doc, WINDOW)], minlength=n)
    out["n_ranks"] = np.bincount(doc, tokens.n_ranks[numbers], minlength=n).astype(np.int64)
    if n > 1:
        each, pieces = tokens.pieces_of(numbers)
        of = np.repeat(doc, each)
        out["n_pieces"] = np.bincount(of, minlength=n)
        out["n_fallback"] = np.bincount(of, tokens.single[pieces], minlength=n).astype(np.int64)
        out["token_entropy"] = _entropies(pieces, of, n, tokens.size)
        return out
    # One text, of any length: its pieces are counted by parts.
    held = np.zeros(tokens.size, np.int64)
    for at in range(0, len(numbers), SLICE):
        held += np.bincount(tokens.pieces_of(numbers[at:at + SLICE])[1], minlength=tokens.size)
    used = held[held > 0]
    whole = max(int(used.sum()), 1)
    out["n_pieces"], out["n_fallback"] = np.array([used.sum()]), np.array([held[tokens.single].sum()])
    out["token_entropy"] = np.array([np.log2(whole) - (used * np.log2(used)).sum() / whole])
    return out


def measured(docs: DataFrame, pieces: str, ranks: str, pattern: str, id_col: str = "doc_id", text: str = "text",
             lang: str = "lang") -> DataFrame:
    """(doc_id, lang, ...): what the vocabularies and the base rules measure on each text.

    ``pieces`` and ``ranks`` are vocabulary files that every executor can open, ``pattern`` splits text before the merges of the ranks.
    """
    names = [c.split()[0] for c in _MEASURED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, scripts = Tokens(pieces, ranks, pattern), _script_table()
        for batch in batches:
            for part in text_slices(batch, "text", SLICE):
                found = _measure(part.column("text").to_pylist(), tokens, scripts)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("lang"), *(pa.array(found[c]) for c in names)], ["doc_id", "lang", *names])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"doc_id {kind}, lang string, {_MEASURED}")
    per_token = lambda what, column: F.col(what) / F.nullif(column, F.lit(0))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    return out.withColumns({
        "chars_per_piece": per_token("word_chars", "n_pieces"),
        "letters_per_piece": per_token("n_letters", "n_pieces"),
        "letters_per_rank": per_token("n_letters", "n_ranks"),
        "fallback_share": per_token("n_fallback", "n_pieces"),
        "len_class": F.floor(F.log2(F.greatest("n_words", F.lit(1)))).cast("int"),
        "base_failed": failed,
    })


def _scopes(rows: DataFrame) -> DataFrame:
    """``rows`` with the names of the bands that are asked for, from the narrowest on; ``own`` is NULL for rare languages."""
    counts = rows.where("lang IS NOT NULL").groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    own = counts.where(F.col("n") * LANGUAGE_PARTS > rows.count()).select("lang", F.concat(F.lit("lang:"), "lang").alias("own"))
    # Fewer than LANGUAGE_PARTS rows.
    return rows.join(F.broadcast(own), "lang", "left").withColumn("shared", F.concat(F.lit("script:"), "script"))


def bands(rows: DataFrame, width: float = WIDTH, min_group: int = MIN_GROUP) -> DataFrame:
    """(scope, len_class, low and high of each measure) from scoped measures: at most 1,000 languages, the scripts and all documents, each
    times the doublings of a length."""
    bins = F.array(*[F.struct(F.lit(m).alias("measure"), F.floor(F.col(m) / bin_).alias("bin")) for m, (bin_, _) in MEASURES.items()])
    fine = rows.where(~F.col("base_failed")).select("own", "shared", "len_class", F.explode(bins).alias("b")).where("b.bin IS NOT NULL").groupBy(
        "own", "shared", "len_class", "b.measure", "b.bin").agg(F.count(F.lit(1)).alias("n"))
    at_length = F.transform(F.array_compact(F.array("own", "shared", F.lit("all"))), lambda s: F.struct(s.alias("scope"), F.col("len_class")))
    scopes = F.concat(at_length, F.array(F.struct(F.lit("all").alias("scope"), F.lit(ANY_LENGTH).alias("len_class"))))
    held = fine.select(F.explode(scopes).alias("s"), "measure", "bin", "n").groupBy("s.scope", "s.len_class", "measure", "bin").agg(
        F.sum("n").alias("n"))
    group = Window.partitionBy("scope", "len_class", "measure")
    below = F.sum("n").over(group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    placed = held.withColumns({"below": below, "whole": F.sum("n").over(group)}).where(F.col("whole") >= min_group)
    quartile = lambda k: F.min(F.when(4 * F.col("below") >= k * F.col("whole"), F.col("bin")))
    found = placed.groupBy("scope", "len_class", "measure").agg(quartile(1).alias("q1"), quartile(3).alias("q3"))
    limits = []
    for measure, (bin_, least) in MEASURES.items():
        mine = F.col("measure") == measure
        low, high = F.max(F.when(mine, F.col("q1"))) * bin_, (F.max(F.when(mine, F.col("q3"))) + 1) * bin_
        reach = F.greatest(high - low, F.lit(least)) * width
        limits += [(low - reach).alias(f"{measure}_low"), (high + reach).alias(f"{measure}_high")]
    return found.groupBy("scope", "len_class").agg(*limits)


def judged(docs: DataFrame, pieces: str, ranks: str, pattern: str, id_col: str = "doc_id", text: str = "text", lang: str = "lang",
           width: float = WIDTH, min_group: int = MIN_GROUP) -> DataFrame:
    """``measured`` with ``outside``, the measures that lie outside their bands, and ``kept``."""
    rows = _scopes(materialise(measured(docs, pieces, ranks, pattern, id_col, text, lang), "fertility"))
    limits = materialise(bands(rows, width, min_group), "bands")
    ends = [f"{m}_{e}" for m in MEASURES for e in ("low", "high")]
    own = F.col("len_class")
    asked = {"a": (F.col("own"), own), "b": (F.col("shared"), own), "c": (F.lit("all"), own), "d": (F.lit("all"), F.lit(ANY_LENGTH))}
    for name, (scope, length) in asked.items():
        near = limits.select(F.col("scope").alias("_scope"), F.col("len_class").alias("_class"), F.struct(*ends).alias(name))
        # One row for each scope and doubling.
        rows = rows.join(F.broadcast(near), (F.col("_scope") == scope) & (F.col("_class") == length), "left").drop("_scope", "_class")
    rows = rows.withColumn("band", F.coalesce(*asked))
    broken = [_broken(m, F.col("band")) for m in MEASURES]
    out = rows.withColumn("outside", F.array_compact(F.array(*broken)))
    kept = ~F.col("base_failed") & (F.col("n_pieces") > 0) & (F.size("outside") == 0)
    return out.withColumn("kept", kept).drop("own", "shared", "band", *asked)


def _broken(measure: str, band: Column) -> Column:
    low, high = band[f"{measure}_low"], band[f"{measure}_high"]
    return F.when((F.col(measure) < low) | (F.col(measure) > high), F.lit(measure))
