"""Readers for delimited extracts and warehouse tables, and the writers of results."""

from caremart.sources.delimited import (
    FileKind,
    detect_delimiter,
    file_kinds,
    number_rows,
    read_delimited,
    read_extracts,
    rejected_rows,
    scan_extracts,
    stage_source,
)
from caremart.sources.snapshots import (
    Snapshot,
    begin_load,
    empty_warehouse,
    latest_run,
    newest_snapshot,
    open_snapshot,
    write_run,
)
from caremart.sources.tables import (
    JdbcSplit,
    jdbc_options,
    measured_split,
    ranges_of,
    read_jdbc,
    read_query,
    read_table,
    write_fact,
    write_jdbc,
    write_table,
)

__all__ = [
    "FileKind",
    "JdbcSplit",
    "Snapshot",
    "begin_load",
    "detect_delimiter",
    "empty_warehouse",
    "file_kinds",
    "jdbc_options",
    "latest_run",
    "measured_split",
    "newest_snapshot",
    "number_rows",
    "open_snapshot",
    "ranges_of",
    "read_delimited",
    "read_extracts",
    "read_jdbc",
    "read_query",
    "read_table",
    "rejected_rows",
    "scan_extracts",
    "stage_source",
    "write_fact",
    "write_jdbc",
    "write_run",
    "write_table",
]
