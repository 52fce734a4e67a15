"""The warehouse's declared constraints as one data-quality report."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caremart.operators.quality import (
    ForeignKey,
    length_rules,
    not_null_rules,
    stacked_duplicates,
    stacked_orphans,
    violation_counts,
)

# Primary keys, and the other unique column.
PRIMARY_KEYS = {
    "dim_temps": "temps_sk", "dim_patient": "patient_sk", "dim_service": "service_sk",
    "dim_pathologie": "pathologie_sk", "dim_geographie": "geographie_sk", "dim_gravite": "gravite_sk",
    "dim_transport": "transport_sk", "dim_motif": "motif_sk", "dim_decision": "decision_sk",
    "dim_medecin": "medecin_sk", "dim_lit": "lit_sk", "dim_issue": "issue_sk", "dim_admission": "admission_sk",
    "dim_accouchement": "accouchement_sk", "dim_grossesse": "grossesse_sk", "dim_nouveaune": "bebe_sk",
    "dim_complication": "complication_sk", "faits_accueil": "id_fait", "faits_consultation": "id_fait",
    "faits_hospitalisation": "id_fait", "faits_maternite": "id_fait",
}
UNIQUE_COLUMNS = {"dim_temps": "date_complete"}

# Columns that must be present.
NOT_NULL = {
    "dim_temps": ("date_complete",),
    "dim_patient": ("id_patient_anonyme", "date_debut_validite"),
    "dim_service": ("id_service", "date_debut_validite"),
    "dim_pathologie": ("code_cim10", "date_debut_validite"),
    "dim_geographie": ("id_localisation",),
    "dim_gravite": ("code_gravite",),
    "dim_transport": ("code_transport",),
    "dim_motif": ("code_motif",),
    "dim_decision": ("code_decision",),
    "dim_medecin": ("code_medecin", "date_debut_validite"),
    "dim_lit": ("numero_lit", "date_debut_validite"),
    "dim_issue": ("code_issue",),
    "dim_admission": ("code_admission",),
    "dim_accouchement": ("code_accouchement",),
    "dim_grossesse": ("code_grossesse", "date_debut_validite"),
    "dim_nouveaune": ("code_bebe", "date_debut_validite"),
    "dim_complication": ("code_complication",),
    "faits_accueil": ("temps_sk", "patient_sk"),
    "faits_consultation": ("temps_sk", "patient_sk"),
    "faits_hospitalisation": ("temps_sk", "patient_sk"),
    "faits_maternite": ("temps_sk", "patient_sk"),
}

# Declared text widths.
WIDTHS = {
    "dim_temps": {"jour_semaine": 20, "type_jour": 20, "periode_journee": 20},
    "dim_patient": {"id_patient_anonyme": 50, "sexe": 1, "tranche_age": 20, "statut_nutritionnel": 50},
    "dim_service": {"id_service": 20, "nom_service": 50, "type_service": 20},
    "dim_pathologie": {"code_cim10": 10, "libelle": 200, "categorie": 50, "niveau_gravite": 20},
    "dim_geographie": {"id_localisation": 20, "quartier": 50, "commune": 50, "ville": 50, "zone_sante": 50},
    "dim_gravite": {"code_gravite": 10, "categorie": 30},
    "dim_transport": {"code_transport": 10, "mode_transport": 30},
    "dim_motif": {"code_motif": 10, "libelle_motif": 100, "categorie_motif": 30},
    "dim_decision": {"code_decision": 10, "type_decision": 30, "service_destination": 50},
    "dim_medecin": {"code_medecin": 20, "specialite": 50, "grade": 30},
    "dim_lit": {"numero_lit": 10, "numero_chambre": 10, "type_chambre": 20},
    "dim_issue": {"code_issue": 10, "type_issue": 30, "categorie_issue": 20},
    "dim_admission": {"code_admission": 10, "type_admission": 20, "origine_admission": 30},
    "dim_accouchement": {"code_accouchement": 10, "type_accouchement": 30},
    "dim_grossesse": {"code_grossesse": 20},
    "dim_nouveaune": {"code_bebe": 20, "sexe_bebe": 1, "statut_bebe": 30},
    "dim_complication": {"code_complication": 10, "type_complication": 50, "niveau_gravite": 20},
}

# Foreign keys as child column -> parent table.
FOREIGN_KEYS = {
    "faits_accueil": {
        "temps_sk": "dim_temps", "patient_sk": "dim_patient", "geographie_sk": "dim_geographie",
        "service_sk": "dim_service", "gravite_sk": "dim_gravite", "transport_sk": "dim_transport",
        "motif_sk": "dim_motif", "decision_sk": "dim_decision",
    },
    "faits_consultation": {
        "temps_sk": "dim_temps", "patient_sk": "dim_patient", "service_sk": "dim_service",
        "pathologie_sk": "dim_pathologie", "medecin_sk": "dim_medecin", "gravite_sk": "dim_gravite",
        "decision_sk": "dim_decision",
    },
    "faits_hospitalisation": {
        "temps_sk": "dim_temps", "patient_sk": "dim_patient", "service_sk": "dim_service",
        "pathologie_sk": "dim_pathologie", "geographie_sk": "dim_geographie", "lit_sk": "dim_lit",
        "admission_sk": "dim_admission", "issue_sk": "dim_issue",
    },
    "faits_maternite": {
        "temps_sk": "dim_temps", "patient_sk": "dim_patient", "service_sk": "dim_service",
        "geographie_sk": "dim_geographie", "accouchement_sk": "dim_accouchement", "grossesse_sk": "dim_grossesse",
        "bebe_sk": "dim_nouveaune", "complication_sk": "dim_complication", "pathologie_sk": "dim_pathologie",
    },
    "dim_medecin": {"service_sk": "dim_service"},
    "dim_lit": {"service_sk": "dim_service"},
}

# Declared defaults of omitted columns.
DEFAULTS = {
    "dim_patient": {"est_actif": True, "version_ligne": 1},
    "dim_service": {"est_actif": True, "version_ligne": 1},
    "dim_pathologie": {"version_ligne": 1},
    "dim_medecin": {"version_ligne": 1},
    "dim_lit": {"est_actif": True},
    "dim_grossesse": {"est_actif": True, "version_ligne": 1},
    "dim_nouveaune": {"est_actif": True, "version_ligne": 1},
    "faits_accueil": {"nb_arrivees": 1, "nb_non_pris_en_charge": 0},
    "faits_consultation": {"nb_consultations": 1},
    "faits_hospitalisation": {"nb_hospitalisations": 1, "nb_lits_occupes": 1, "nb_deces": 0, "nb_sorties": 1},
    "faits_maternite": {"nb_accouchements": 1, "nb_cesariennes": 0, "nb_complications": 0, "nb_deces_maternels": 0,
                        "nb_deces_neonatals": 0},
}


def value_rules(table: str) -> dict[str, Column]:
    """Declared value checks of a table."""
    rules = {
        "dim_patient": {"sexe in (M, F)": F.col("sexe").isin("M", "F")},
        "dim_gravite": {"niveau_urgence between 1 and 5": F.col("niveau_urgence").between(1, 5)},
        "dim_nouveaune": {"sexe_bebe in (M, F)": F.col("sexe_bebe").isin("M", "F")},
    }
    return rules.get(table, {})


def _labelled(counts: DataFrame, table: str) -> DataFrame:
    return counts.select(F.lit(table).alias("table_name"), "rule", F.col("violations").cast("long").alias("violations"))


def foreign_keys(tables: Iterable[str]) -> list[ForeignKey]:
    """The declared foreign keys between the given tables."""
    names = set(tables)
    return [
        ForeignKey(child, column, parent, PRIMARY_KEYS[parent])
        for child, columns in FOREIGN_KEYS.items() for column, parent in columns.items() if {child, parent} <= names
    ]


def unique_columns(tables: Iterable[str]) -> list[tuple[str, str]]:
    """(table, column) of the declared primary keys and other unique columns of the given tables."""
    names = set(tables)
    return [(t, c) for keys in (PRIMARY_KEYS, UNIQUE_COLUMNS) for t, c in keys.items() if t in names]


def quality_report(tables: dict[str, DataFrame], uniqueness: bool = True) -> DataFrame:
    """(table_name, rule, violations) for every declared constraint of the given tables.

    Row rules are one aggregate per table, all foreign keys one anti join, and all unique columns one aggregate.
    """
    parts = []
    for table, df in tables.items():
        rules = {
            **not_null_rules(NOT_NULL.get(table, ())),
            **length_rules(WIDTHS.get(table, {})),
            **value_rules(table),
        }
        if rules:
            parts.append(_labelled(violation_counts(df, rules), table))
    if unique := uniqueness and unique_columns(tables):
        repeated = stacked_duplicates(tables, unique)
        parts.append(repeated.select("table_name", F.concat("column", F.lit(" unique")).alias("rule"), "violations"))
    if keys := foreign_keys(tables):
        parent = F.create_map(*[F.lit(x) for k in keys for x in (f"{k.child}.{k.column}", k.parent)])
        lost = stacked_orphans(tables, keys)
        rule = F.concat("column", F.lit(" in "), parent[F.concat_ws(".", "child", "column")])
        parts.append(lost.select(F.col("child").alias("table_name"), rule.alias("rule"), "violations"))
    return reduce(DataFrame.unionByName, parts)
