"""The four fact tables.

Lenient mode gives unresolved keys a default key; strict mode drops rows whose date or patient is
unresolved. The date key is a function of the date, so it needs no join; rows that a missing date
removes go before any lookup. Lookups onto small dimensions stay in the scan's stage, the patient
lookup shuffles only when the patient dimension is too large to broadcast.

The events are read by several dimensions and by their fact: pass written (``materialise``d)
sources, so that dates are parsed once.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caremart.functions import caesarean_flag, clamp_weight, complication_flag, date_key, strip, stripped, truncate_int
from caremart.operators.keys import POSITION, dense_key
from caremart.operators.lookup import DEFAULT_KEY, resolve
from caremart.plans.settings import LoadSettings
from caremart.plans.standardise import EVENT_DATES, LENIENT, PSEUDONYM, STRICT
from caremart.session import together

Dims = dict[str, DataFrame]

# The dimensions that each fact looks up, besides the calendar.
FACT_DIMENSIONS = {
    "faits_accueil": ("dim_patient", "dim_service", "dim_gravite", "dim_decision", "dim_motif"),
    "faits_consultation": ("dim_patient", "dim_service", "dim_pathologie", "dim_medecin"),
    "faits_hospitalisation": ("dim_patient", "dim_service", "dim_pathologie", "dim_issue", "dim_lit", "dim_admission"),
    "faits_maternite": ("dim_patient", "dim_accouchement", "dim_complication", "dim_grossesse", "dim_nouveaune"),
}

# Fixed value: stand-in for a missing consultation length, in minutes.
DEFAULT_CONSULTATION_MINUTES = 15


@dataclass(frozen=True)
class FactOptions:
    """How keys are resolved.

    ``unknown_key`` is given to unresolved keys. ``strip_rows`` also trims the text of the fact
    side, which the default leaves as it is. ``strict_beds`` resolves beds in strict mode, where
    the default gives every stay the unknown bed. ``as_of`` takes, of a versioned member, the version that held on the
    date of the event.
    """

    mode: str = LENIENT
    unknown_key: int = DEFAULT_KEY
    strip_rows: bool = False
    strict_beds: bool = False
    as_of: bool = False
    settings: LoadSettings = field(default_factory=LoadSettings)

    @property
    def strict(self) -> bool:
        return self.mode == STRICT


def _lower(column: str, options: FactOptions, always_strip: bool = False) -> Column:
    text = F.col(column)
    return F.lower(strip(text) if always_strip or options.strip_rows else text)


def _name(column: str) -> Column:
    """A natural key of a dimension: trimmed and lower case."""
    return F.lower(strip(F.col(column)))


def _inside_calendar(date_column: str, settings: LoadSettings) -> Column:
    """Comparison with the raw timestamp, so that it can be pushed into a file scan."""
    end = settings.calendar_end + dt.timedelta(days=1)
    bounds = [F.lit(d).cast("timestamp") for d in (settings.calendar_start, end)]
    return (F.col(date_column) >= bounds[0]) & (F.col(date_column) < bounds[1])


def with_date_key(events: DataFrame, date_column: str, settings: LoadSettings) -> DataFrame:
    """``temps_sk`` of events inside the calendar, NULL for all others."""
    inside = _inside_calendar(date_column, settings)
    return events.withColumn("temps_sk", F.when(inside, date_key(F.to_date(date_column))))


def _dated(events: DataFrame, source: str, options: FactOptions, drop_unknown: bool) -> DataFrame:
    if drop_unknown or options.strict:
        events = events.where(_inside_calendar(EVENT_DATES[source], options.settings))
    dated = with_date_key(events, EVENT_DATES[source], options.settings)
    return dated.fillna({"temps_sk": options.unknown_key})


def _event_day(events: DataFrame, dims: Dims, table: str, options: FactOptions) -> Column | None:
    """The day as of which a member's version is looked up, ``None`` for dimensions without versions."""
    if not options.as_of or "date_debut_validite" not in dims[table].columns:
        return None
    return F.to_date(next(c for c in EVENT_DATES.values() if c in events.columns))


def _resolve(
    events: DataFrame, dims: Dims, table: str, surrogate: str, columns: Sequence[str], row_keys: Sequence[Column],
    dim_keys: Sequence[Column], options: FactOptions,
) -> DataFrame:
    """One lookup; an absent source column or dimension gives every row the unknown key."""
    if table not in dims or any(c not in events.columns for c in columns):
        return events.withColumn(surrogate, F.lit(options.unknown_key))
    day = _event_day(events, dims, table, options)
    return resolve(events, dims[table], surrogate, row_keys, dim_keys, default=options.unknown_key, at=day)


def _named(events: DataFrame, dims: Dims, table: str, surrogate: str, column: str, dim_column: str,
           options: FactOptions, always_strip: bool = False) -> DataFrame:
    """Lookup of a text column by lower-case name."""
    keys = ([_lower(column, options, always_strip)], [_name(dim_column)]) if column in events.columns else ([], [])
    return _resolve(events, dims, table, surrogate, [column], *keys, options)


def _with_patient(events: DataFrame, source: DataFrame, dims: Dims, options: FactOptions) -> DataFrame:
    """The patient key; strict mode drops rows without one.

    Resolved last, so that a shuffle moves the other keys as numbers instead of text. Hot patients
    are counted in the source, without the lookups before.
    """
    pseudonym = F.upper(stripped(F.col(PSEUDONYM)))
    member = F.upper(stripped(F.col("id_patient_anonyme")))
    default = None if options.strict else options.unknown_key
    day = _event_day(events, dims, "dim_patient", options)
    found = resolve(
        events, dims["dim_patient"], "patient_sk", [pseudonym], [member], default=default, counted=source, at=day
    )
    return found.where(F.col("patient_sk").isNotNull()) if options.strict else found


def _count_or_zero(events: DataFrame, column: str) -> Column:
    return truncate_int(F.col(column), 0) if column in events.columns else F.lit(0)


def _fact(events: DataFrame, columns: dict[str, Column | str]) -> DataFrame:
    """The fact's columns behind its row id (source row number + 1: unique and ascending)."""
    columns = {"id_fait": (F.col(POSITION) + 1).cast("long"), **columns}
    return events.select(*[(F.col(e) if isinstance(e, str) else e).alias(n) for n, e in columns.items()])


def _numbered(fact: DataFrame, name: str) -> DataFrame:
    """A gap-free sequence column in source order."""
    return dense_key(fact, ["id_fait"], name).select(*fact.columns, name)


def fact_visits(visits: DataFrame, dims: Dims, options: FactOptions = FactOptions()) -> DataFrame:
    """``faits_accueil``: emergency visits. Off-calendar visits are dropped."""
    rows = _dated(visits, "urgence", options, drop_unknown=True)
    rows = _named(rows, dims, "dim_service", "service_sk", "Service", "nom_service", options)
    level = [truncate_int(F.col("Niveau_Urgence"))] if "Niveau_Urgence" in rows.columns else []
    rows = _resolve(rows, dims, "dim_gravite", "gravite_sk", ["Niveau_Urgence"], level, [F.col("niveau_urgence")],
                    options)
    rows = _named(rows, dims, "dim_decision", "decision_sk", "Decision_Medicale", "type_decision", options)
    rows = _named(rows, dims, "dim_motif", "motif_sk", "Motif_Consultation", "libelle_motif", options)
    rows = _with_patient(rows, visits, dims, options)
    unknown = F.lit(options.unknown_key)
    return _fact(
        rows,
        {
            "temps_sk": "temps_sk",
            "patient_sk": "patient_sk",
            "geographie_sk": unknown,
            "service_sk": "service_sk",
            "paiement_sk": unknown,
            "contexte_sk": unknown,
            "gravite_sk": "gravite_sk",
            "transport_sk": unknown,
            "motif_sk": "motif_sk",
            "decision_sk": "decision_sk",
            "nb_arrivees": F.lit(1),
            "temps_attente_tri": truncate_int(F.col("Temps_Attente_Tri"), 0),
            "temps_attente_orientation": truncate_int(F.col("Temps_Attente_Orientation"), 0),
            "nb_non_pris_en_charge": F.lit(0),
        },
    )


def fact_consultations(consultations: DataFrame, dims: Dims, options: FactOptions = FactOptions()) -> DataFrame:
    """``faits_consultation``: no row is dropped in lenient mode; strict mode adds ``id_consultation``."""
    rows = _dated(consultations, "consultation", options, drop_unknown=False)
    rows = _named(rows, dims, "dim_service", "service_sk", "Specialite_Medecin", "nom_service", options)
    rows = _named(rows, dims, "dim_pathologie", "pathologie_sk", "Pathologie", "libelle", options)
    rows = _named(rows, dims, "dim_medecin", "medecin_sk", "Medecin", "code_medecin", options)
    rows = _with_patient(rows, consultations, dims, options)
    unknown = F.lit(options.unknown_key)
    fact = _fact(
        rows,
        {
            "temps_sk": "temps_sk",
            "patient_sk": "patient_sk",
            "service_sk": "service_sk",
            "pathologie_sk": "pathologie_sk",
            "paiement_sk": unknown,
            "contexte_sk": unknown,
            "medecin_sk": "medecin_sk",
            "gravite_sk": unknown,
            "decision_sk": unknown,
            "nb_consultations": F.lit(1),
            "duree_consultation": F.coalesce("Duree_Consultation", F.lit(float(DEFAULT_CONSULTATION_MINUTES))),
            "nb_medicaments": _count_or_zero(rows, "Nbr_Medicaments"),
            "nb_examens": F.lit(0),
            "temps_attente": _count_or_zero(rows, "Temps_Attente"),
        },
    )
    return _numbered(fact, "id_consultation") if options.strict else fact


def fact_stays(stays: DataFrame, dims: Dims, options: FactOptions = FactOptions()) -> DataFrame:
    """``faits_hospitalisation``: off-calendar stays are dropped."""
    rows = _dated(stays, "hospitalisation", options, drop_unknown=True)
    rows = _named(rows, dims, "dim_service", "service_sk", "Service_Affectation", "nom_service", options)
    rows = _named(rows, dims, "dim_pathologie", "pathologie_sk", "Pathologie_Principale", "libelle", options)
    rows = _named(rows, dims, "dim_issue", "issue_sk", "Issue_Sortie", "type_issue", options)
    if options.strict and not options.strict_beds:
        rows = rows.withColumn("lit_sk", F.lit(options.unknown_key))
    else:
        bed = [strip(F.col("Numero_Lit"))] if "Numero_Lit" in rows.columns else []
        rows = _resolve(rows, dims, "dim_lit", "lit_sk", ["Numero_Lit"], bed, [strip(F.col("numero_lit"))], options)
    rows = _named(rows, dims, "dim_admission", "admission_sk", "Type_Admission", "type_admission", options)
    rows = _with_patient(rows, stays, dims, options)
    unknown = F.lit(options.unknown_key)
    return _fact(
        rows,
        {
            "temps_sk": "temps_sk",
            "patient_sk": "patient_sk",
            "service_sk": "service_sk",
            "pathologie_sk": "pathologie_sk",
            "geographie_sk": unknown,
            "contexte_sk": unknown,
            "lit_sk": "lit_sk",
            "admission_sk": "admission_sk",
            "issue_sk": "issue_sk",
            "nb_hospitalisations": F.lit(1),
            "duree_sejour": F.coalesce("Duree_Sejour", F.lit(0.0)),
            "nb_lits_occupes": F.lit(1),
            "nb_deces": F.lit(0),
            "nb_sorties": F.lit(1),
        },
    )


def fact_births(births: DataFrame, dims: Dims, options: FactOptions = FactOptions()) -> DataFrame:
    """``faits_maternite``: no row is dropped in lenient mode; strict mode adds ``id_accouchement``."""
    rows = _dated(births, "maternite", options, drop_unknown=False)
    rows = _named(rows, dims, "dim_accouchement", "accouchement_sk", "Type_Accouchement", "type_accouchement", options,
                  always_strip=True)
    rows = _named(rows, dims, "dim_complication", "complication_sk", "Complication_Type", "type_complication", options,
                  always_strip=True)
    weeks = F.col("Age_Gestationnel")
    rows = _resolve(rows, dims, "dim_grossesse", "grossesse_sk", ["Age_Gestationnel"], [weeks],
                    [F.col("age_gestationnel").cast("double")], options)
    newborn = ["Poids_Nouveau_Ne", "Taille_Naissance", "Score_Apgar"]
    member = ["poids_naissance", "taille_naissance", "score_apgar"]
    rows = _resolve(rows, dims, "dim_nouveaune", "bebe_sk", newborn, [F.col(c) for c in newborn],
                    [F.col(c).cast("double") for c in member], options)
    rows = _with_patient(rows, births, dims, options)
    unknown = F.lit(options.unknown_key)
    weight = F.col("Poids_Nouveau_Ne")
    complication = "Complication_Type" in rows.columns
    fact = _fact(
        rows,
        {
            "temps_sk": "temps_sk",
            "patient_sk": "patient_sk",
            "service_sk": unknown,
            "geographie_sk": unknown,
            "contexte_sk": unknown,
            "accouchement_sk": "accouchement_sk",
            "grossesse_sk": "grossesse_sk",
            "bebe_sk": "bebe_sk",
            "complication_sk": "complication_sk",
            "pathologie_sk": unknown,
            "nb_accouchements": F.lit(1),
            "nb_cesariennes": caesarean_flag(F.col("Type_Accouchement")),
            "nb_complications": complication_flag(F.col("Complication_Type")) if complication else F.lit(0),
            "poids_naissance": F.coalesce(weight, F.lit(0.0)) if options.strict else clamp_weight(weight),
            "nb_deces_maternels": F.lit(0),
            "nb_deces_neonatals": F.lit(0),
        },
    )
    return _numbered(fact, "id_accouchement") if options.strict else fact


#: Builder and event source of each fact table.
FACTS = {
    "faits_accueil": (fact_visits, "urgence"),
    "faits_consultation": (fact_consultations, "consultation"),
    "faits_hospitalisation": (fact_stays, "hospitalisation"),
    "faits_maternite": (fact_births, "maternite"),
}


def build_facts(
    sources: dict[str, DataFrame], dims: Dims, options: FactOptions = FactOptions(), tables: Sequence[str] = tuple(FACTS)
) -> dict[str, DataFrame]:
    """The fact tables from standardised sources and written dimensions."""

    def build(table: str) -> DataFrame:
        builder, source = FACTS[table]
        return builder(sources[source], dims, options)

    return together(build, tables)
