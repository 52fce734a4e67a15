"""Whole loads: extracts to warehouse, and warehouse to forecast."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caremart.plans.dims import build_dimensions
from caremart.plans.facts import FACT_DIMENSIONS, FACTS, FactOptions, build_facts
from caremart.plans.forecast import (
    HORIZON,
    alert_rows,
    combined_forecast,
    forecast_rows,
    observed_occupancy,
    service_series,
)
from caremart.plans.members import MEMBERS, added_members, versioned_members
from caremart.plans.settings import LoadSettings
from caremart.plans.standardise import (
    EVENT_DATES,
    LENIENT,
    PATIENT_ID,
    STRICT,
    parsed_events,
    rejected_dates,
    rejects_identified,
    standardise_events,
    standardise_patients,
    standardised,
)
from caremart.session import materialise, together
from caremart.sources.delimited import EXTRACT_FILES, number_rows, rejected_rows, scan_extracts
from caremart.sources.snapshots import Load, Snapshot, begin_load, newest_snapshot, open_snapshot, write_run
from caremart.sources.tables import ALERT_TABLE, FORECAST_TABLE

REJECTS_TABLE = "rejets_dates"
ROW_REJECTS_TABLE = "lignes_rejetees"

#: Gap-free sequences that strict loads add to their facts.
SEQUENCES = ("id_consultation", "id_accouchement")


class Warehouse:
    """The newest complete run of a warehouse folder, or the run ``run_id``, fixed when it is opened; tables are read lazily."""

    def __init__(self, spark: SparkSession, root: str, run_id: str | None = None):
        self.snapshot = open_snapshot(spark, root, run_id)

    def table(self, name: str, *columns: str) -> DataFrame:
        return self.snapshot.table(name, *columns)


def load_warehouse(
    spark: SparkSession,
    folder: str,
    root: str,
    settings: LoadSettings = LoadSettings(),
    mode: str = LENIENT,
    files: dict[str, str] = EXTRACT_FILES,
    options: FactOptions | None = None,
    run_id: str | None = None,
    extract: str | None = None,
    append: bool = False,
    versions: bool = False,
) -> dict[str, int]:
    """Read the five extracts into a new run of the warehouse; returns the rows written per table.

    Readers see the run once all its tables are complete, and the run before until then. Rows with more
    fields than their header go to a table of rejected rows, by source. See ``load_sources`` for the ways to load.
    """
    load = begin_load(spark, root, run_id, extract)
    stored = scan_extracts(spark, folder, files)
    before = newest_snapshot(spark, root) if append else None
    for name in stored:
        load.write(rejected_rows(stored[name]), f"{ROW_REJECTS_TABLE}/{name}", behind=_kept(before, load, f"{ROW_REJECTS_TABLE}/{name}"))
    sources = together(lambda name: number_rows(stored[name], name), stored)
    return load_sources(spark, sources, root, settings, mode, options, append=append, versions=versions, load=load)


def _kept(before: Snapshot | None, load: Load, name: str) -> tuple:
    """The folders of a table that stay when the load's extract is added, or added once more."""
    return () if before is None else before.without(load.extract, [name]).parts.get(name, ())


def load_sources(
    spark: SparkSession,
    sources: dict[str, DataFrame],
    root: str,
    settings: LoadSettings = LoadSettings(),
    mode: str = LENIENT,
    options: FactOptions | None = None,
    run_id: str | None = None,
    extract: str | None = None,
    append: bool = False,
    versions: bool = False,
    only: Sequence[str] = tuple(FACTS),
    load: Load | None = None,
) -> dict[str, int]:
    """``load_warehouse`` from sources already read, or of the facts named in ``only`` with the dimensions they look up. A load goes one of these ways:

    * By default every table is replaced, so a repeated load gives the same warehouse.
    * ``append`` keeps what is stored. Members that are not stored yet are added behind the highest key, known ones keep theirs, and the facts
      of ``extract`` (the run's id unless named) are added with ids that go on. If that extract was loaded before, its facts are
      replaced, and as its members are known by then, the result is the same.
    * ``versions`` keeps members and their history: a changed member gets a new version from ``settings.run_date`` on, and facts
      point at the version of their date. Without ``append`` the facts are replaced.
    """
    load = load or begin_load(spark, root, run_id, extract)
    before = newest_snapshot(spark, root) if append or versions else None
    options = replace(options or FactOptions(), mode=mode, settings=settings, as_of=versions)
    # Parsed once: dimensions, facts and rejects read the typed columns they need. Other sources give single columns to a few dimensions.
    events = [FACTS[fact][1] for fact in only]
    # The identifier behind a pseudonym is read for rejects alone.
    parsed = together(lambda name: materialise(rejects_identified(parsed_events(sources[name], name, mode)), f"parsed-{name}"), events)
    typed = {name: standardised(parsed[name].drop(PATIENT_ID), name, mode) if name in parsed else standardise_events(sources[name], name, mode)
             for name in EVENT_DATES}
    typed["patient"] = materialise(standardise_patients(sources["patient"]), "typed-patient")

    def store_dimension(df: DataFrame, name: str) -> DataFrame:
        spec = MEMBERS[name]
        casts = {"id_patient_anonyme": "varchar(128)"} if name == "dim_patient" else None
        if before is None or name not in before.parts:
            return load.write(df, name, spec.surrogate, casts)
        stored, loads = before.table(name), len(before.parts[name])
        incoming = materialise(df, f"incoming-{name}")
        if versions and spec.versioned:
            return load.write(versioned_members(stored, incoming, name, settings.run_date, loads), name, spec.surrogate, casts)
        fresh = added_members(stored, incoming, name, before.highest(name), loads)
        return load.write(fresh, name, spec.surrogate, casts, behind=before.parts[name])

    def write_fact(name: str) -> None:
        behind = _kept(before, load, name) if append else ()
        fact = facts[name]
        if behind:
            last, rows = max(p.highest or 0 for p in behind), sum(p.rows for p in behind)
            fact = fact.withColumns({"id_fait": F.col("id_fait") + last, **{c: F.col(c) + rows for c in SEQUENCES if c in fact.columns}})
        load.write(fact, name, "id_fait", by_year=True, behind=behind)

    def write_rejects(source: str) -> None:
        name = f"{REJECTS_TABLE}/{source}"
        load.write(rejected_dates(parsed[source], source), name, behind=_kept(before, load, name) if append else ())

    wanted = None if len(only) == len(FACTS) else {"dim_temps", *(d for fact in only for d in FACT_DIMENSIONS[fact])}
    dims = build_dimensions(typed, settings, wanted, store=store_dimension, strip_service=mode != STRICT)
    facts = build_facts(typed, dims, options, only)
    together(write_fact, facts)
    together(write_rejects, parsed)
    load.list_run()
    return {name: sum(p.rows for p in parts if p.folder == load.run_id) for name, parts in load.parts.items()}


def load_forecast(
    spark: SparkSession, root: str, run_id: str, how: str = "mean", horizon: int = HORIZON
) -> dict[str, int]:
    """Forecast every service of the warehouse and replace the forecast and alert tables together."""
    warehouse = Warehouse(spark, root)
    series = service_series(
        observed_occupancy(
            warehouse.table("faits_hospitalisation", "temps_sk", "service_sk", "nb_lits_occupes"),
            warehouse.table("dim_temps", "temps_sk", "date_complete"),
            warehouse.table("dim_service", "service_sk", "nom_service", "capacite_lits"),
            how,
        )
    )
    # A few rows per service: written once, read by the models and by both outputs.
    combined = materialise(combined_forecast(materialise(series, "series"), horizon), "forecast")
    outputs = {FORECAST_TABLE: forecast_rows(combined), ALERT_TABLE: alert_rows(combined)}
    return write_run(outputs, f"{root}/previsions", run_id)
