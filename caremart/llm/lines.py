"""Cross-site line dedup by distinct-site spread, in DataFrame functions only.

A line's spread is the number of different sites it occurs on. One HyperLogLog sketch of sites per line hash is built
where the lines are read and merged by the aggregation, so a line on a third of all pages costs one sketch per input partition.
Lines whose estimate is near the threshold get an exact distinct count; those clearly above or below do not. Lines that
reach the threshold are boilerplate and leave every document, whichever page had them first.

Copies of a page must not make its lines boilerplate: sites are counted over one text of each group of copies (equal texts, and
texts that share ``COPY`` of the larger one's characters in widespread lines), on one site. Every line that still reaches the
threshold leaves every document, however little is left.

Lines are compared without leading and trailing spaces, tabs and carriage returns, and only if ``min_chars`` or more remain. They
are known by a 64-bit hash.

Defined results: a null or empty text comes back as it is. A null site is no site. Rows that share an id
keep their own texts; a line is boilerplate for all rows or none. A null id is an id like any other. An empty
table gives no rows. All columns of the input are returned, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caremart.llm.rows import whole_row
from caremart.session import materialise

#: Size of a sketch (2^12 registers) and its relative standard error.
LOG_REGISTERS, ERROR = 12, 1.04 / 64
#: Share of the larger text's characters that two texts have in common in widespread lines if one is a copy of the other.
COPY = 0.8


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r"))


def _hashes(docs: DataFrame, text: str, min_chars: int, *others: Column) -> DataFrame:
    """(others..., line): one row for each line that counts."""
    lines = docs.select(*others, F.explode(F.split(F.col(text), "\n", -1)).alias("line"))
    bare = _bare(F.col("line"))
    names = lines.columns[:-1]
    return lines.where(F.length(bare) >= min_chars).select(*names, F.xxhash64(bare).alias("line"))


def _widespread(seen: DataFrame, min_sites: int) -> DataFrame:
    """(line): the lines of ``seen`` (site, line) on ``min_sites`` sites or more."""
    margin = 1 + 4 * ERROR * min_sites
    spread = seen.groupBy("line").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LOG_REGISTERS))).alias("sites"))
    likely = materialise(spread.where(F.col("sites") >= min_sites - margin), "spread")
    near = likely.where(F.col("sites") <= min_sites + margin).select("line")
    exact = seen.join(near, "line", "left_semi").distinct().groupBy("line").agg(F.count("*").alias("n"))
    certain = likely.where(F.col("sites") > min_sites + margin).select("line")
    return materialise(certain.union(exact.where(F.col("n") >= min_sites).select("line")), "boilerplate")


def boilerplate(docs: DataFrame, min_sites: int, min_chars: int, suspect_share: float, text: str = "text", site: str = "source") -> DataFrame:
    """(line): hashes of the lines on ``min_sites`` sites or more, copies of a text counted as one text on one site.

    Equal texts are one by their MD5. Texts with more than ``suspect_share`` of their characters in lines that are widespread
    among those are held against one other: of the texts that have a line, the one with the smallest digest is its centre,
    and the centre of most of a text's characters is what it may be a copy of.
    """
    body = F.col(text)
    counted = F.filter(F.transform(F.split(body, "\n", -1), _bare), lambda x: F.length(x) >= min_chars)
    page = docs.where(F.col(site).isNotNull() & body.isNotNull()).select(
        F.unhex(F.md5(body)).alias("page"), F.col(site).cast("string").alias("site"), F.length(body).alias("size"),
        F.transform(counted, lambda x: F.struct(F.xxhash64(x).alias("line"), F.length(x).alias("n"))).alias("lines"))
    # Which site stands for a group of equal texts differs from group to group.
    least = F.min(F.struct(F.md5(F.concat("site", F.lit("|"), F.lower(F.hex("page")))).alias("h"), "site", "size", "lines")).alias("p")
    pages = materialise(page.groupBy("page").agg(least).select("page", "p.site", "p.size", "p.lines"), "pages")
    first = _widespread(pages.select("site", F.explode("lines.line").alias("line")), min_sites)
    hits = pages.select("page", "size", F.explode("lines").alias("l")).select("page", "size", "l.*").join(first, "line").groupBy(
        "page", "size", "line").agg(F.sum("n").alias("n"))
    hits = materialise(hits, "hits")
    mostly = hits.groupBy("page", "size").agg(F.sum("n").alias("n")).where(F.col("n") > suspect_share * F.col("size")).select("page")
    hits = materialise(hits.join(mostly, "page", "left_semi"), "mostly")
    centres = hits.groupBy("line").agg(F.min("page").alias("centre"))
    likely = hits.join(centres, "line").where("page <> centre").groupBy("page", "centre").agg(F.sum("n").alias("n")).groupBy("page").agg(
        F.max(F.struct("n", "centre"))["centre"].alias("centre"))
    other = hits.select(F.col("page").alias("centre"), "line", F.col("size").alias("other_size"), F.col("n").alias("other_n"))
    both = hits.join(likely, "page").join(other, ["centre", "line"]).groupBy("page", "size", "other_size").agg(
        F.sum(F.least("n", "other_n")).alias("n"))
    copies = materialise(both.where(F.col("n") >= COPY * F.greatest("size", "other_size")).select("page"), "copies")
    alone = pages.join(copies, "page", "left_anti")
    return _widespread(alone.select("site", F.explode("lines.line").alias("line")), min_sites)


def flagged(docs: DataFrame, min_sites: int = 10, min_chars: int = 10, suspect_share: float = 0.5, id_col: str = "doc_id",
            text: str = "text", site: str = "source") -> DataFrame:
    """(row, n_lines, n_removed, clean_text): ``row`` holds all columns of the document."""
    return _cut(docs, boilerplate(docs, min_sites, min_chars, suspect_share, text, site), min_chars, id_col, text)


def _cut(docs: DataFrame, widespread: DataFrame, min_chars: int, id_col: str, text: str) -> DataFrame:
    bad = _hashes(docs, text, min_chars, F.col(id_col).alias("id")).join(widespread, "line").groupBy("id").agg(
        F.collect_set("line").alias("bad"))
    rows = docs.select(whole_row(docs), F.col(id_col).alias("own_id"))
    body = F.col("row")[text]
    lines = F.split(body, "\n", -1)
    keep = lambda x: (F.length(_bare(x)) < min_chars) | ~F.array_contains(F.col("bad"), F.xxhash64(_bare(x)))
    joined = rows.join(bad, F.col("own_id").eqNullSafe(F.col("id")), "left").select(
        "row", F.when(F.col("bad").isNotNull(), F.filter(lines, keep)).alias("left_over"))
    kept_text = F.array_join("left_over", "\n")
    cut = F.col("left_over").isNotNull()
    return joined.select(
        "row",
        F.when(body.isNull(), 0).otherwise(F.size(lines)).alias("n_lines"),
        F.when(cut, F.size(lines) - F.size("left_over")).otherwise(0).alias("n_removed"),
        F.when(cut, kept_text).otherwise(body).alias("clean_text"),
    )


def dedup(docs: DataFrame, min_sites: int = 10, min_chars: int = 10, suspect_share: float = 0.5, id_col: str = "doc_id",
          text: str = "text", site: str = "source") -> DataFrame:
    """``docs`` with the boilerplate lines gone from their texts; same rows, same columns."""
    out = flagged(docs, min_sites, min_chars, suspect_share, id_col, text, site)
    return out.select(*[
        F.col("clean_text").alias(text) if c == text else F.col("row")[c].alias(c) for c in docs.columns])
