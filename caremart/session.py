"""Session settings and the scratch area for tables that are written once and read many times."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Independent tables written at the same time; their small jobs share the cluster.
CONCURRENT_WRITES = 6

#: Tables up to this many rows and bytes of text are broadcast; larger ones take the salted shuffle join.
BROADCAST_ROW_LIMIT = 500_000
BROADCAST_BYTE_LIMIT = 64_000_000


def build_session(app_name: str = "caremart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every plan here relies on (UTC dates, AQE on)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only where neither the setting nor a checkpoint folder exists (a local test run) is a
    temporary folder of this machine taken.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    local = tempfile.mkdtemp(prefix="caremart-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


#: Session settings of writes to the scratch area, and the writes that hold them now. A query's shuffle files go when it ends; times are
#: written as whole numbers, which costs less than the old form of 12 bytes and lets a scan skip by them.
_OF_WRITES = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}
_holding = 0
_held_by_user: dict[str, str | None] = {}
_hold = threading.Lock()


@contextmanager
def _write_settings(spark: SparkSession) -> Iterator[None]:
    """Queries that start inside have the settings of scratch writes; the session's own come back after."""
    global _holding, _held_by_user
    with _hold:
        if not _holding:
            _held_by_user = {key: spark.conf.get(key, None) for key in _OF_WRITES}
            for key, value in _OF_WRITES.items():
                spark.conf.set(key, value)
        _holding += 1
    try:
        yield
    finally:
        with _hold:
            _holding -= 1
            for key, value in _held_by_user.items() if not _holding else ():
                if value is None:
                    spark.conf.unset(key)
                else:
                    spark.conf.set(key, value)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the scratch area and read it back.

    This cuts the lineage in a way that survives lost executors, fixes one physical layout for
    every later use, and gives Catalyst the true byte size for its join choice. The shuffle files
    of the write are needed no more once it is done and are removed then.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/caremart/{label}-{uuid.uuid4().hex}"
    with _write_settings(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fits_broadcast(df: DataFrame) -> bool:
    """Whether ``df`` is within ``BROADCAST_ROW_LIMIT`` and, in its text columns, ``BROADCAST_BYTE_LIMIT``: one scan of it."""
    texts = [F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) for c, kind in df.dtypes if kind in ("string", "binary")]
    size = F.sum(sum(texts, F.lit(0).cast("long")))
    rows, text = df.agg(F.count(F.lit(1)), F.coalesce(size, F.lit(0))).first()
    return rows <= BROADCAST_ROW_LIMIT and text <= BROADCAST_BYTE_LIMIT


Item = TypeVar("Item")
Result = TypeVar("Result")


def together(work: Callable[[Item], Result], items: Iterable[Item]) -> dict[Item, Result]:
    """Results of independent jobs submitted side by side; the first failure is raised."""
    items = list(items)
    with ThreadPoolExecutor(CONCURRENT_WRITES) as threads:
        return dict(zip(items, threads.map(work, items)))
