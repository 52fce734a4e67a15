"""Tables that change together: written load by load, seen through one listed run.

A load writes each of its tables to a folder of its own (``<root>/<table>/charge=<run>``). Only when all are complete is the run listed,
in one small file, with the folders that make up each table; a run may take folders over from the run before. Readers resolve the newest listed
run once and read all their tables from it, so they see a whole load or none of it, whatever fails or runs meanwhile. A listed
run and the folders it names are never changed. One load writes at a time.
"""

from __future__ import annotations

import datetime as dt
import json
import logging
import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from caremart.sources.tables import WAREHOUSE_TABLES, with_year, write_measured

log = logging.getLogger(__name__)

RUNS = "complete_runs"
FOLDER = "charge"
_LISTING = "run_id string, table_name string, folder string, extract string, columns string, rows long, highest long"
_RUN_ID = re.compile(r"[\w.+-]+")


def new_run_id() -> str:
    """An id that sorts after those given before."""
    return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%fZ")


@dataclass(frozen=True)
class Part:
    """A folder of a table: the extract its rows come from, its columns (as JSON), its rows and the highest key among them."""

    folder: str
    extract: str
    columns: str
    rows: int
    highest: int | None = None


@dataclass(frozen=True)
class Snapshot:
    """The tables of one run; they are read lazily."""

    spark: SparkSession
    root: str
    run_id: str
    parts: Mapping[str, tuple[Part, ...]] = field(default_factory=dict)

    def table(self, name: str, *columns: str) -> DataFrame:
        """A table of the run; only ``columns`` are read from the files."""
        if name not in self.parts:
            raise LookupError(f"run {self.run_id} under {self.root} has no table {name}")
        return read_parts(self.spark, self.root, name, self.parts[name], columns)

    def rows(self, name: str) -> int:
        return sum(p.rows for p in self.parts.get(name, ()))

    def highest(self, name: str) -> int:
        """The highest key of a table, 0 for an empty one."""
        return max((p.highest for p in self.parts.get(name, ()) if p.highest is not None), default=0)

    def without(self, extract: str, names: Iterable[str]) -> Snapshot:
        """The same run as if ``extract`` had given no rows to the tables ``names``."""
        left = {n: tuple(p for p in parts if n not in names or p.extract != extract) for n, parts in self.parts.items()}
        return Snapshot(self.spark, self.root, self.run_id, left)


def read_parts(spark: SparkSession, root: str, name: str, parts: Sequence[Part], columns: Sequence[str] = ()) -> DataFrame:
    """A table from its folders. The listed columns make it readable without a look at its files, even if it has no rows."""
    paths = [f"{root}/{name}/{FOLDER}={p.folder}" for p in parts]
    schema = StructType.fromJson(json.loads(parts[0].columns))
    table = spark.read.option("basePath", f"{root}/{name}").schema(schema).parquet(*paths)
    return table.select(*columns) if columns else table.select(*schema.names)


def _listing(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(_LISTING).parquet(f"{root}/{RUNS}")
    except AnalysisException as reason:
        if reason.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def is_listed(spark: SparkSession, root: str, run_id: str) -> bool:
    listing = _listing(spark, root)
    return listing is not None and not listing.where(F.col("run_id") == run_id).isEmpty()


def newest_snapshot(spark: SparkSession, root: str, run_id: str | None = None) -> Snapshot | None:
    """The newest listed run (or the run ``run_id``), ``None`` if there is none.

    One row for each folder reaches the driver, which would list the folders anyway.
    """
    listing = _listing(spark, root)
    if listing is None:
        return None
    run_id = run_id or listing.agg(F.max("run_id").alias("run_id")).first()["run_id"]
    rows = listing.where(F.col("run_id") == run_id).orderBy("table_name", "folder").collect() if run_id else []
    if not rows:
        return None
    parts: dict[str, tuple[Part, ...]] = {}
    for r in rows:
        if r.table_name is not None:
            parts[r.table_name] = (*parts.get(r.table_name, ()), Part(r.folder, r.extract, r.columns, r.rows, r.highest))
    return Snapshot(spark, root, run_id, parts)


def open_snapshot(spark: SparkSession, root: str, run_id: str | None = None) -> Snapshot:
    """``newest_snapshot`` that must exist."""
    found = newest_snapshot(spark, root, run_id)
    if found is None:
        raise LookupError(f"no complete run under {root}")
    return found


@dataclass
class Load:
    """A run that is being written. Nothing of it is visible before ``list_run``."""

    spark: SparkSession
    root: str
    run_id: str
    extract: str
    parts: dict[str, tuple[Part, ...]] = field(default_factory=dict)

    def write(self, df: DataFrame, name: str, key: str | None = None, casts: Mapping[str, str] | None = None,
              by_year: bool = False, behind: Sequence[Part] = ()) -> DataFrame:
        """Write the load's own folder of a table, put it behind the folders ``behind``, and return the whole table."""
        df = (with_year(df) if by_year else df).withColumns({c: F.col(c).cast(t) for c, t in (casts or {}).items()})
        rows, highest = write_measured(
            df, f"{self.root}/{name}", f"{FOLDER}={self.run_id}", "overwrite", partition_by=["annee"] if by_year else [], key=key)
        own = (Part(self.run_id, self.extract, df.schema.json(), rows, highest),) if rows or not behind else ()
        self.parts[name] = (*behind, *own)
        return read_parts(self.spark, self.root, name, self.parts[name])

    def list_run(self) -> None:
        """Make the run visible, with all its tables at once."""
        rows = [(self.run_id, name, p.folder, p.extract, p.columns, p.rows, p.highest) for name, parts in self.parts.items() for p in parts]
        listed = self.spark.createDataFrame(rows or [(self.run_id, *[None] * 6)], _LISTING)
        listed.coalesce(1).write.mode("append").parquet(f"{self.root}/{RUNS}")


def begin_load(spark: SparkSession, root: str, run_id: str | None = None, extract: str | None = None) -> Load:
    """A new run; the id of a listed one is refused. ``run_id`` must sort after earlier runs (a timestamp does)."""
    run_id = run_id or new_run_id()
    if not _RUN_ID.fullmatch(run_id):
        raise ValueError(f"run id {run_id!r}: letters, digits and . _ + - only")
    if is_listed(spark, root, run_id):
        raise ValueError(f"run {run_id} is complete under {root}")
    return Load(spark, root, run_id, extract or run_id)


def write_run(tables: Mapping[str, DataFrame], root: str, run_id: str) -> dict[str, int]:
    """Write several outputs as one run; readers see all of them or none."""
    load = begin_load(next(iter(tables.values())).sparkSession, root, run_id)
    for name, df in tables.items():
        load.write(df, name)
    load.list_run()
    return {name: load.parts[name][-1].rows for name in tables}


def latest_run(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the newest complete run."""
    return open_snapshot(spark, root).table(name)


def empty_warehouse(spark: SparkSession, root: str, tables: Iterable[str] = WAREHOUSE_TABLES, run_id: str | None = None) -> list[str]:
    """A run in which the tables are empty, with the columns they had; tables that the run before lacks are logged and returned."""
    before = newest_snapshot(spark, root)
    load, skipped = begin_load(spark, root, run_id), []
    load.parts.update(before.parts if before else {})
    for name in tables:
        if before is None or name not in before.parts:
            log.warning("table %s not emptied: not in the newest run", name)
            skipped.append(name)
        else:
            load.write(before.table(name).limit(0), name)
    load.list_run()
    return skipped
