"""Delimited extracts: delimiter and encoding detection, missing tokens, source row numbers."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from caremart.functions.text import as_missing
from caremart.operators.keys import POSITION
from caremart.session import BROADCAST_ROW_LIMIT, materialise, together

# Separators considered, in order of preference.
DELIMITERS = (",", ";", "\t", "|", ":")

# Source names and their default file names.
EXTRACT_FILES = {
    "patient": "registre_patients_unique.csv",
    "urgence": "source_urgences.csv",
    "consultation": "source_consultations.csv",
    "hospitalisation": "source_hospitalisations.csv",
    "maternite": "source_maternite.csv",
}

UTF8 = "UTF-8"
LATIN1 = "ISO-8859-1"

# Where a scanned row comes from; together they give its place in the source.
ORIGIN = ("_src_file", "_src_block", "_src_id")

# monotonically_increasing_id() keeps the task in the bits above 33 and the row below.
_ROW_BITS = 33

# Text of a row with more fields than the header, NULL for every other row.
REJECT = "_src_reject"


def detect_delimiter(header: str) -> str:
    """The separator that occurs most often outside quotes in the header line."""
    bare = re.sub(r'"[^"]*"', "", header)
    return max(DELIMITERS, key=bare.count)


def _header(spark: SparkSession, path: str) -> str:
    """The first line only; the rest of the file stays on the cluster."""
    first = spark.read.text(path).limit(1).first()
    return "" if first is None else first["value"].lstrip("﻿")


@dataclass(frozen=True)
class FileKind:
    """How a file is to be read. A file with line breaks inside quotes is one task, whatever its size."""

    encoding: str
    multi_line: bool


def file_kinds(spark: SparkSession, path: str) -> dict[FileKind, list[str]]:
    """The files of ``path`` by kind: Latin-1 if one line is not valid UTF-8, several lines a row if one line has an odd
    number of quotes.

    One pass over the text. One row for each file reaches the driver, which lists the files anyway.
    """
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    per_file = (
        spark.read.text(path)
        .select(F.col("_metadata.file_path").alias("file"), (~F.is_valid_utf8("value")).alias("invalid"), (quotes % 2 == 1).alias("odd"))
        .groupBy("file")
        .agg(F.bool_or("invalid").alias("invalid"), F.bool_or("odd").alias("odd"))
    )
    kinds: dict[FileKind, list[str]] = {}
    for row in sorted(per_file.collect(), key=lambda r: r["file"]):
        kinds.setdefault(FileKind(LATIN1 if row["invalid"] else UTF8, row["odd"]), []).append(unquote(row["file"]))
    return kinds


def _fields(raw: Column, sep: str) -> Column:
    """Number of fields of a row as text."""
    mark = re.escape(sep)
    bare = F.regexp_replace(raw, rf'(^|{mark})"[^"]*+(?:""[^"]*+)*+"(?={mark}|\z)', "$1")
    return F.octet_length(bare) - F.octet_length(F.replace(bare, F.lit(sep), F.lit(""))) + 1


def _scan(spark: SparkSession, path: str, sep: str, kinds: dict[FileKind, list[str]]) -> tuple[DataFrame, list[str]]:
    """(the columns of the header as text, and in ``REJECT`` the text of each row that has more fields; the header).

    Every file must have the header of the first, else Spark fails with the names that differ. Headers
    with empty or repeated names cannot be compared that way and are read by position.
    """

    def reader(kind: FileKind, **options):
        return spark.read.options(
            sep=sep, quote='"', escape='"', encoding=kind.encoding, multiLine=kind.multi_line, **options)

    groups = [(k, f) for k, f in kinds.items()] or [(FileKind(UTF8, False), [path])]
    if len(groups) == 1:
        groups = [(groups[0][0], [path])]
    kind, files = groups[0]
    names = reader(kind, header=True).csv(files).columns
    if not names:
        return reader(kind, header=True).csv(files).withColumn(REJECT, F.lit(None).cast("string")), names
    written = reader(kind, header=False).csv(files).first()
    comparable = written is not None and list(written) == names
    schema = StructType([StructField(n, StringType()) for n in [*names, REJECT]])
    parts = [
        # Fields are counted against the whole header, so the parser must not leave columns out.
        reader(k, header=True, enforceSchema=not comparable, columnNameOfCorruptRecord=REJECT, columnPruning=False).schema(schema).csv(f)
        .select("*", *(c.alias(n) for c, n in zip(_origin(), ORIGIN)))
        for k, f in groups
    ]
    # Spark keeps the text of rows with fewer fields too; those are whole, their last columns are NULL.
    # A field is never longer than its row; comparing them makes the scan read a real column, without which Spark refuses it.
    longer = F.octet_length(REJECT) >= F.octet_length(F.coalesce(F.col(f"`{names[0]}`"), F.lit("")))
    wide = F.when(longer & (_fields(F.col(REJECT), sep) > len(names)), F.col(REJECT))
    return reduce(DataFrame.unionByName, parts).withColumn(REJECT, wide), names


def _origin() -> tuple[Column, ...]:
    return F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()


def read_delimited(
    spark: SparkSession,
    path: str,
    sep: str | None = None,
    encoding: str | None = None,
    with_origin: bool = False,
    multi_line: bool | None = None,
) -> DataFrame:
    """All columns as text with trimmed names and missing tokens as NULL.

    ``sep``, and for each file ``encoding`` and ``multi_line``, are detected unless given; giving the last two saves a pass over
    the text. A missing path raises Spark's PATH_NOT_FOUND when the plan is built. Rows with more fields than the
    header are left out. ``with_origin`` keeps them, with their text in ``REJECT``, and adds the file, block and running id
    of each row: see ``number_rows`` and ``rejected_rows``.
    """
    if encoding is not None and multi_line is not None:
        kinds = {FileKind(encoding, multi_line): [path]}
    else:
        kinds = {}
        for kind, files in file_kinds(spark, path).items():
            kind = FileKind(encoding or kind.encoding, kind.multi_line if multi_line is None else multi_line)
            kinds.setdefault(kind, []).extend(files)
    raw, header = _scan(spark, path, sep or detect_delimiter(_header(spark, path)), kinds)
    columns = [as_missing(F.col(f"`{c}`")).alias(c.strip().lstrip("\ufeff")) for c in header]
    if with_origin:
        return raw.select(*columns, *ORIGIN, REJECT)
    return raw.where(F.col(REJECT).isNull()).select(*columns)


def rejected_rows(stored: DataFrame) -> DataFrame:
    """(fichier, ligne): file and text of the rows with more fields than the header, from a stored scan."""
    return stored.where(F.col(REJECT).isNotNull()).select(F.col(ORIGIN[0]).alias("fichier"), F.col(REJECT).alias("ligne"))


def stage_source(scanned: DataFrame, label: str, position: str = POSITION) -> DataFrame:
    """Write a scanned source once as columns and number its rows (see ``number_rows``)."""
    return number_rows(materialise(scanned, f"stage-{label}"), label, position)


def number_rows(stored: DataFrame, label: str, position: str = POSITION) -> DataFrame:
    """The rows of a stored scan, numbered 0, 1, … in file order. Rejected rows leave, with their numbers.

    Spark packs file blocks into tasks by size, so the running id alone is not in file order. The
    id of a row relative to its block, shifted by the rows of all earlier blocks, is its row
    number, without sorting the data. The running id tells the task that read a row, and within it the block: the
    index has a row for each task with the first id and the shift of its blocks, and is looked up by the task's number.
    """
    file, block, rid = ORIGIN
    blocks = stored.groupBy(file, block).agg(F.count(F.lit(1)).alias("_n"), F.min(rid).alias("_first"))
    files = blocks.groupBy(file).agg(F.sum("_n").alias("_n"))
    earlier = (Window.unboundedPreceding, -1)
    files = files.select(
        file, F.coalesce(F.sum("_n").over(Window.orderBy(file).rowsBetween(*earlier)), F.lit(0)).alias("_file_base")
    )
    within = Window.partitionBy(file).orderBy(block).rowsBetween(*earlier)
    # The windows see one row per file, and one per block of a file, never the data.
    shift = F.struct((-F.col("_first")).alias("_first"), (F.col("_file_base") + F.col("_block_base") - F.col("_first")).alias("_shift"))
    index = (
        blocks.withColumn("_block_base", F.coalesce(F.sum("_n").over(within), F.lit(0)))
        .join(files, file)
        .groupBy(F.shiftright("_first", _ROW_BITS).alias("_task"))
        .agg(F.array_sort(F.collect_list(shift)).alias("_blocks"))
    )
    # One row per task of the scan, with its blocks from the last one on.
    index = materialise(index, f"blocks-{label}")
    index = F.broadcast(index) if (index.agg(F.sum(F.size("_blocks"))).first()[0] or 0) <= BROADCAST_ROW_LIMIT else index
    own = F.filter("_blocks", lambda b: -b["_first"] <= F.col(rid))
    return (
        stored.where(F.col(REJECT).isNull())
        .withColumn("_task", F.shiftright(rid, _ROW_BITS))
        .join(index, "_task", "left")
        .withColumn(position, F.col(rid) + F.get(own, 0)["_shift"])
        .drop(*ORIGIN, REJECT, "_task", "_blocks")
    )


def scan_extracts(
    spark: SparkSession, folder: str, files: Mapping[str, str] = EXTRACT_FILES, **options: str
) -> dict[str, DataFrame]:
    """The five sources by name, scanned and stored with the rows that were rejected."""
    return together(
        lambda name: materialise(read_delimited(spark, f"{folder}/{files[name]}", with_origin=True, **options), f"stage-{name}"),
        files,
    )


def read_extracts(
    spark: SparkSession, folder: str, files: Mapping[str, str] = EXTRACT_FILES, **options: str
) -> dict[str, DataFrame]:
    """The five sources by name, scanned, stored and numbered."""
    stored = scan_extracts(spark, folder, files, **options)
    return together(lambda name: number_rows(stored[name], name), stored)
