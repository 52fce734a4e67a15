"""Filter interaction audit by sorted posting lists.

What does a filter remove if others run before it? For each part of the corpus (a language) and each filter the ids of the failing
documents are kept as a sorted list. A step of an order of filters removes the filter's list without the union of the lists before
it, so all orders follow from the sizes of 16 differences a filter. Unions and differences are merges that gallop: the ids of the shorter list are
searched for in the longer one, whose stretches between them are taken over unread; a union of several lists grows by one list at a
time, so each of the 32 unions is merged once.

Ids are row numbers of the written table of judged documents, cut into ranges of ``2 ** RANGE_BITS`` rows. A list never crosses a range, so
a part with a third of all rows is many small groups, whatever the documents' own ids are; the sizes of the ranges are added up.
Only sizes leave the ranges: 80 rows for each part and range.

The filters of ``failures`` (``FILTERS``): A few words, B few distinct words, C many capitals, D marks, E text of a document with a smaller id.
Equal texts are equal in SHA-256. A text of more than a thousandth of all rows is looked up in a broadcast table of fewer than a thousand rows, the
others by a join in which no key holds more than that.

Defined results: a null text is empty. A null part is the empty one. A document with a null id
is judged like others, but makes no other fail E and does not fail it, and has no label. Rows that share an id are documents of their own and
don't make each other fail E. If an id has several labels, one that marks it counts. An empty table gives no rows. Other
columns are ignored. Memory of a task follows the longest text (about ten times its bytes).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caremart.llm.common import text_slices
from caremart.llm.words import blocks
from caremart.session import materialise

#: Rows of an id range, as a power of two.
RANGE_BITS = 15
#: A text is common if it holds more than 1/COMMON_PARTS of the rows, so fewer than COMMON_PARTS are.
COMMON_PARTS = 1000
FILTERS = "ABCDE"

# The bounds of the filters.
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITAL_PERCENT = 3
MARKS = r"[#$%&*|]"

_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_JUDGED = "part string, few boolean, repeated boolean, capitals boolean, marked boolean, digest binary"


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    marks = re.compile(MARKS)
    for batch in batches:
        for part in text_slices(batch, "text"):
            few, repeated, capitals, marked, digests = [], [], [], [], []
            for text in part.column("text").to_pylist():
                raw, seen, n = text.encode(), set(), 0
                for block in blocks(raw):
                    words = block.split()
                    n += len(words)
                    seen.update(words)
                few.append(n < MIN_WORDS)
                repeated.append(100 * len(seen) < MIN_DISTINCT_PERCENT * n)
                capitals.append(100 * (len(raw) - len(raw.translate(None, _CAPITALS))) > MAX_CAPITAL_PERCENT * len(text))
                marked.append(marks.search(text) is not None)
                digests.append(hashlib.sha256(raw).digest())
            flags = [pa.array(x, pa.bool_()) for x in (few, repeated, capitals, marked)]
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("part"), *flags, pa.array(digests, pa.binary())],
                                             ["id", "part", "few", "repeated", "capitals", "marked", "digest"])


def failures(docs: DataFrame, id_col: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(row, id, part, A, B, C, D, E): which filters each document fails. ``row`` numbers the rows of the written table."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    judged = rows.mapInArrow(_judge, f"id long, {_JUDGED}")
    judged = materialise(judged.withColumn("row", F.monotonically_increasing_id()), "judged")
    own = judged.select("row", "id", "part", F.col("few").alias("A"), F.col("repeated").alias("B"), F.col("capitals").alias("C"),
                        F.col("marked").alias("D"), "digest")
    repeats = judged.where("id IS NOT NULL").groupBy("digest").agg(
        F.min("id").alias("first"), F.max("id").alias("last"), F.count(F.lit(1)).alias("n")).where("first < last")
    repeats = materialise(repeats, "repeated-texts")
    common = F.col("n") * COMMON_PARTS > judged.count()
    # Fewer than COMMON_PARTS rows.
    split = own.join(F.broadcast(repeats.where(common).select("digest", F.col("first").alias("least"))), "digest", "left")
    rare = split.where("least IS NULL").join(repeats.where(~common).select("digest", "first"), "digest", "left")
    both = split.where("least IS NOT NULL").withColumnRenamed("least", "first").unionByName(rare.drop("least"))
    return both.withColumn("E", F.coalesce(F.col("id") > F.col("first"), F.lit(False))).select("row", "id", "part", *FILTERS)


def marked(rows: DataFrame, labels: DataFrame, marks: dict[str, Column], id_col: str = "doc_id") -> DataFrame:
    """``rows`` with a boolean column for each of ``marks``, conditions over the labels of a document."""
    known = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id")).agg(
        *[F.coalesce(F.bool_or(condition), F.lit(False)).alias(name) for name, condition in marks.items()])
    return rows.join(known, "id", "left").fillna(False, list(marks))


def postings(rows: DataFrame, filters: Sequence[str], marks: Sequence[str] = ()) -> DataFrame:
    """(part, range, n, one sorted list for each filter and mark): places within the range of the rows that fail or are marked."""
    place = F.col("row").bitwiseAND((1 << RANGE_BITS) - 1).cast("int")
    lists = [F.array_sort(F.collect_list(F.when(F.col(c), place))).alias(c) for c in (*filters, *marks)]
    return rows.groupBy("part", F.shiftright("row", RANGE_BITS).alias("range")).agg(F.count(F.lit(1)).alias("n"), *lists)


def member(ids: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which of the sorted ``ids`` are in the sorted ``of``."""
    if not len(of):
        return np.zeros(len(ids), bool)
    at = np.searchsorted(of, ids)
    return of[np.minimum(at, len(of) - 1)] == ids


def difference(ids: np.ndarray, without: np.ndarray) -> np.ndarray:
    """The sorted ``ids`` that are not in ``without``, galloping through the longer of the two."""
    if len(without) < len(ids):
        hits = without[member(without, ids)]
        return np.delete(ids, np.searchsorted(ids, hits))
    return ids[~member(ids, without)]


def union(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sorted ids of either list: the shorter one's new ids are put into the longer one."""
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    new = difference(short, long)
    return np.insert(long, np.searchsorted(long, new), new)


def unions(lists: Sequence[np.ndarray]) -> list[np.ndarray]:
    """The union of every subset of the lists, by the subset's bits."""
    out = [np.zeros(0, np.int32)]
    for subset in range(1, 1 << len(lists)):
        lowest = (subset & -subset).bit_length() - 1
        out.append(union(out[subset & (subset - 1)], lists[lowest]))
    return out


def set_sizes(lists: DataFrame, filters: Sequence[str], marks: Sequence[str] = ()) -> DataFrame:
    """(part, filter, before, n, failing, removed, rest, one column for each mark), added up over the ranges of a part.

    ``filter`` and ``before`` are a filter's place and the bits of the filters that ran before it; ``removed`` counts what it takes
    then, ``rest`` what stays, and each mark the marked among the removed.
    """
    names = ["part", "filter", "before", "n", "failing", "removed", "rest", *marks]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[list] = [[] for _ in names]
            for k in range(len(batch)):
                part, n = batch.column("part")[k].as_py(), batch.column("n")[k].as_py()
                own = [batch.column(c)[k].values.to_numpy() for c in filters]
                special = [batch.column(c)[k].values.to_numpy() for c in marks]
                for before, gone in enumerate(unions(own)):
                    for f, ids in enumerate(own):
                        if not before >> f & 1:
                            taken = difference(ids, gone)
                            sizes = [int(member(taken, s).sum()) for s in special]
                            row = (part, f, before, n, len(ids), len(taken), n - len(gone) - len(taken), *sizes)
                            for column, value in zip(found, row, strict=True):
                                column.append(value)
            kinds = [pa.string(), pa.int32(), pa.int32(), *[pa.int64()] * (len(names) - 3)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(found, kinds, strict=True)], names)

    schema = "part string, filter int, before int, " + ", ".join(f"`{c}` long" for c in names[3:])
    sizes = lists.select("part", "n", *filters, *marks).mapInArrow(run, schema)
    return sizes.groupBy("part", "filter", "before").agg(*[F.sum(c).alias(c) for c in names[3:]])


def orders(filters: Sequence[str]) -> list[tuple[str, int, int, int]]:
    """(order, step, filter, before) of every step of every order."""
    out = []
    for order in permutations(range(len(filters))):
        before = 0
        for step, f in enumerate(order, 1):
            out.append(("".join(filters[k] for k in order), step, f, before))
            before |= 1 << f
    return out


def report(sizes: DataFrame, filters: Sequence[str], marks: Sequence[str] = ()) -> DataFrame:
    """One row for each part, order and step: (part, filter_order, step, kept, removed, redundant, unique_fails, ``<mark>_lost``..., shapley).

    ``shapley`` is what the step's filter removes, summed over all orders.
    """
    k = len(filters)
    others = F.expr(f"{(1 << k) - 1} - shiftleft(1, filter)")
    # Orders in which exactly these filters ran before: their orders times those of the filters after.
    times = F.element_at(F.array(*[F.lit(factorial(b) * factorial(k - 1 - b)) for b in range(k)]), F.bit_count("before") + 1)
    own = Window.partitionBy("part", "filter")
    with_filter = sizes.withColumns({
        "unique_fails": F.max(F.when(F.col("before") == others, F.col("removed"))).over(own),
        "shapley": F.sum(F.col("removed") * times).over(own),
    })
    steps = sizes.sparkSession.createDataFrame(orders(filters), "filter_order string, step int, filter int, before int")
    # k! * k rows.
    return with_filter.join(F.broadcast(steps), ["filter", "before"]).select(
        "part", "filter_order", "step", F.col("rest").alias("kept"), "removed", (F.col("failing") - F.col("removed")).alias("redundant"),
        "unique_fails", *[F.col(m).alias(f"{m}_lost") for m in marks], "shapley")


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """The report of the five filters, with the good and the toxic documents that each step loses."""
    marks = {"good": F.col("quality") == 1, "toxic": F.col("toxic") == 1}
    rows = marked(failures(docs, id_col, text, part), labels, marks, id_col)
    return report(set_sizes(postings(rows, FILTERS, list(marks)), FILTERS, list(marks)), FILTERS, list(marks))
