"""Typed, cleaned and pseudonymised sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caremart.functions import (
    age_band,
    extract_number,
    parse_date_strict,
    pseudonymise,
    strip,
    title_case,
    to_number,
    with_parsed_date,
)
from caremart.functions.dates import FALLBACK_DATE

LENIENT = "lenient"
STRICT = "strict"

PATIENT_ID = "ID_Patient"
PSEUDONYM = "ID_Patient_Anonyme"
#: Text of a date that could not be read.
UNREAD_DATE = "_date_illisible"

# Event date column of each source.
EVENT_DATES = {
    "urgence": "Date_Arrivee",
    "consultation": "Date_Consultation",
    "hospitalisation": "Date_Admission",
    "maternite": "Date_Accouchement",
}

# Columns that hold numbers (whole-text numbers; "75 kg" style columns are apart).
NUMERIC = {
    "urgence": ("Niveau_Urgence", "Temps_Attente_Tri", "Temps_Attente_Orientation"),
    "consultation": ("Annee_Experience", "Duree_Consultation", "Nbr_Medicaments", "Temps_Attente"),
    "hospitalisation": ("Duree_Sejour",),
    "maternite": ("Age_Gestationnel", "Nb_Grossesses", "Poids_Nouveau_Ne", "Taille_Naissance", "Score_Apgar"),
}


def standardise_patients(patients: DataFrame) -> DataFrame:
    """Identifier, name, sex, age, band and body measures, without a shuffle."""
    typed = patients.withColumns(
        {
            PATIENT_ID: strip(F.col(PATIENT_ID)),
            PSEUDONYM: pseudonymise(F.col(PATIENT_ID)),
            "Nom_Complet": strip(title_case(F.col("Nom_Complet"))),
            "Sexe": strip(F.upper("Sexe")),
            "Age": to_number(F.col("Age")),
            "Poids": extract_number(F.col("Poids")),
            "Taille": extract_number(F.col("Taille")),
        }
    )
    return typed.withColumn("Tranche_Age", age_band(F.col("Age")))


def parsed_events(events: DataFrame, source: str, mode: str = LENIENT) -> DataFrame:
    """One event source with its date as read (NULL if unreadable), pseudonym and numbers, and the text of an unreadable date.

    The date is parsed once for both the value and the reject: write this, and derive ``standardised`` and ``rejected_dates``.
    """
    date = EVENT_DATES[source]
    kept = events.withColumn(UNREAD_DATE, F.col(date))
    dated = kept.withColumn(date, parse_date_strict(F.col(date))) if mode == STRICT else with_parsed_date(kept, date)
    typed = dated.withColumns(
        {
            PSEUDONYM: pseudonymise(F.col(PATIENT_ID)),
            **{c: to_number(F.col(c)) for c in NUMERIC[source] if c in events.columns},
        }
    )
    # A step of its own, so that the parsed column is used and not its expression.
    unread = F.col(date).isNull() & (strip(F.col(UNREAD_DATE)) != "")
    return typed.withColumn(UNREAD_DATE, F.when(unread, F.col(UNREAD_DATE)))


def standardised(parsed: DataFrame, source: str, mode: str = LENIENT) -> DataFrame:
    """The rows of ``parsed_events`` that facts and dimensions use.

    Visits with an unreadable date are dropped; the other sources keep the stand-in date
    (lenient) or NULL (strict).
    """
    date = EVENT_DATES[source]
    rows = parsed.drop(UNREAD_DATE)
    if source == "urgence":
        return rows.where(F.col(date).isNotNull())
    return rows if mode == STRICT else rows.withColumn(date, F.coalesce(date, F.lit(FALLBACK_DATE).cast("timestamp")))


def rejects_identified(parsed: DataFrame) -> DataFrame:
    """``parsed_events`` with the identifier of the patient left to the rows of ``rejected_dates`` alone."""
    if PATIENT_ID not in parsed.columns:
        return parsed
    return parsed.withColumn(PATIENT_ID, F.when(F.col(UNREAD_DATE).isNotNull(), F.col(PATIENT_ID)))


def rejected_dates(parsed: DataFrame, source: str) -> DataFrame:
    """Rows of ``parsed_events`` whose date text is present and unreadable, with the text, to be written beside the output."""
    keep = [c for c in ("src_row", PATIENT_ID) if c in parsed.columns]
    return parsed.where(F.col(UNREAD_DATE).isNotNull()).select(F.lit(source).alias("source"), *keep, F.col(UNREAD_DATE).alias("date_text"))


def standardise_events(events: DataFrame, source: str, mode: str = LENIENT) -> DataFrame:
    """Parsed event date, pseudonym and numeric columns of one event source, in one plan."""
    return standardised(parsed_events(events, source, mode), source, mode)


def standardise(sources: dict[str, DataFrame], mode: str = LENIENT) -> dict[str, DataFrame]:
    """All five sources."""
    typed = {name: standardise_events(sources[name], name, mode) for name in EVENT_DATES}
    return {"patient": standardise_patients(sources["patient"]), **typed}


def date_rejects(events: DataFrame, source: str, mode: str = LENIENT) -> DataFrame:
    """``rejected_dates`` of a raw source."""
    return rejected_dates(parsed_events(events, source, mode), source)
