"""Warehouse tables: scans, writes, relational connectors."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

# Warehouse tables, children before parents.
WAREHOUSE_TABLES = (
    "faits_maternite", "faits_hospitalisation", "faits_consultation", "faits_accueil",
    "dim_nouveaune", "dim_grossesse", "dim_medecin", "dim_lit", "dim_patient", "dim_temps", "dim_service",
    "dim_pathologie", "dim_geographie", "dim_gravite", "dim_transport", "dim_motif", "dim_decision", "dim_issue",
    "dim_admission", "dim_accouchement", "dim_complication",
)

# Forecast outputs, replaced together.
FORECAST_TABLE = "previsions_occupation"
ALERT_TABLE = "alertes_occupation"


def read_table(spark: SparkSession, root: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A warehouse table; only ``columns`` are read from the files."""
    table = spark.read.parquet(f"{root}/{name}")
    return table.select(*columns) if columns else table


def read_query(spark: SparkSession, query: str, **tables: DataFrame) -> DataFrame:
    """The result of a SQL query; ``{name}`` in the text stands for a given DataFrame."""
    return spark.sql(query, **tables)


def write_table(
    df: DataFrame,
    root: str,
    name: str,
    mode: str = "append",
    casts: Mapping[str, str] | None = None,
    partition_by: Sequence[str] = (),
) -> int:
    """Write a table and return its row count, observed by the write itself (no second scan)."""
    return write_measured(df, root, name, mode, casts, partition_by)[0]


def write_measured(
    df: DataFrame,
    root: str,
    name: str,
    mode: str = "append",
    casts: Mapping[str, str] | None = None,
    partition_by: Sequence[str] = (),
    key: str | None = None,
) -> tuple[int, int | None]:
    """``write_table`` that returns (rows, highest value of ``key``), both observed by the write itself."""
    df = df.withColumns({c: F.col(c).cast(t) for c, t in (casts or {}).items()})
    seen = Observation(f"rows_{name}")
    highest = F.max(F.col(key) if key else F.lit(None)).cast("long")
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), highest.alias("highest"))
    counted.write.mode(mode).partitionBy(*partition_by).parquet(f"{root}/{name}")
    rows = seen.get["rows"]
    log.info("%s: %d rows", name, rows)
    return rows, seen.get["highest"]


def with_year(fact: DataFrame, day_key: str = "temps_sk") -> DataFrame:
    """A fact with the year of its date key, by which it is partitioned."""
    return fact.withColumn("annee", F.floor(F.col(day_key) / 10000).cast("int"))


def write_fact(df: DataFrame, root: str, name: str, mode: str = "append", day_key: str = "temps_sk") -> int:
    """Write a fact table partitioned by year, so that date filters prune files."""
    return write_table(with_year(df, day_key), root, name, mode, partition_by=["annee"])


def jdbc_options(
    url: str,
    table: str,
    driver: str | None = None,
    batch_rows: int = 10_000,
    connections: int = 8,
    split: JdbcSplit | None = None,
    **extra: str,
) -> dict[str, str]:
    """Connector options for a relational warehouse: batched inserts, and with ``split`` reads, over a bounded set of connections."""
    options = {"url": url, "dbtable": table, "batchsize": str(batch_rows), "numPartitions": str(connections)}
    if driver:
        options["driver"] = driver
    if split:
        options |= {"partitionColumn": split.column, "lowerBound": str(split.low), "upperBound": str(split.high)}
    return {**options, **extra}


@dataclass(frozen=True)
class JdbcSplit:
    """A numeric, date or timestamp column and the bounds between which its values are dealt to the connections.

    Rows outside the bounds are read too, by the first and the last connection.
    """

    column: str
    low: object
    high: object


def measured_split(spark: SparkSession, options: Mapping[str, str], column: str) -> JdbcSplit | None:
    """The split of a relational table by the extremes of a column, asked from the server; ``None`` for an empty table."""
    asked = {**options, "dbtable": f"(SELECT MIN({column}) AS low, MAX({column}) AS high FROM {options['dbtable']} t) ends"}
    ends = spark.read.format("jdbc").options(**asked).load().first()
    return None if ends is None or ends[0] is None else JdbcSplit(column, ends[0], ends[1])


def _sql_literal(value: object) -> str:
    return "'" + str(value).replace("'", "''") + "'" if isinstance(value, (str, dt.date)) else str(value)


def ranges_of(column: str, bounds: Sequence[object]) -> list[str]:
    """Conditions that part a table at the ascending ``bounds`` of any comparable column, NULLs with the first part: one read each."""
    if not bounds:
        return ["1 = 1"]
    text = [_sql_literal(b) for b in bounds]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(text, text[1:])]
    return [f"{column} < {text[0]} OR {column} IS NULL", *inner, f"{column} >= {text[-1]}"]


def read_jdbc(spark: SparkSession, options: Mapping[str, str], conditions: Sequence[str] = ()) -> DataFrame:
    """A relational table or query; filters and columns are pushed to the server.

    The read is split by the options' ``partitionColumn`` or into one part for each of ``conditions``, which together
    must cover every row once (see ``ranges_of``).
    """
    if not conditions:
        return spark.read.format("jdbc").options(**options).load()
    kept = {k: v for k, v in options.items() if k not in ("url", "dbtable", "partitionColumn", "lowerBound", "upperBound", "numPartitions")}
    return spark.read.jdbc(options["url"], options["dbtable"], predicates=list(conditions), properties=kept)


def write_jdbc(df: DataFrame, options: Mapping[str, str], mode: str = "append") -> None:
    """Insert into a relational table; ``overwrite`` empties it and keeps its definition."""
    df.write.format("jdbc").options(**options, truncate="true").mode(mode).save()
