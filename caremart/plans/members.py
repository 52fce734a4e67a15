"""Members that outlive a load: which columns make a member, and how a load adds to a stored dimension."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caremart.functions import prefixed_code
from caremart.operators.versions import append_members, latest_members, merge_versions, one_active
from caremart.plans.dims import AFTER_DEFAULT


@dataclass(frozen=True)
class Code:
    """A code column made from a member's number, or, with ``by_row``, from the row that first showed it."""

    column: str
    prefix: str = ""
    width: int = 0
    by_row: bool = False


@dataclass(frozen=True)
class Member:
    """A dimension's key, the columns that make a member, and for versioned ones the columns whose change opens a version.

    ``first`` is the first key of real members; keys below it are the default member's. ``of_day`` keys are functions of their
    natural key and stay as they are.
    """

    surrogate: str
    natural: tuple[str, ...]
    code: Code | None = None
    first: int = 1
    identity: tuple[str, ...] = ()
    attributes: tuple[str, ...] = ()
    of_day: bool = False

    @property
    def versioned(self) -> bool:
        return bool(self.attributes)


# Keys, natural columns, codes and compared columns of the dimensions. ``identity`` is the narrower natural key under which a
# member keeps its versions, where one load may hold several profiles of it.
MEMBERS = {
    "dim_temps": Member("temps_sk", ("date_complete",), of_day=True),
    "dim_patient": Member(
        "patient_sk", ("id_patient_anonyme",),
        attributes=("sexe", "age", "tranche_age", "poids", "taille", "statut_nutritionnel", "antecedents_medicaux")),
    "dim_geographie": Member("geographie_sk", ("commune", "quartier"), Code("id_localisation", by_row=True)),
    "dim_service": Member("service_sk", ("nom_service",), Code("id_service", "SRV", 3), AFTER_DEFAULT,
                          attributes=("type_service", "capacite_lits")),
    "dim_pathologie": Member("pathologie_sk", ("libelle",), Code("code_cim10", "CIM", 3), AFTER_DEFAULT,
                             attributes=("categorie", "niveau_gravite")),
    "dim_medecin": Member("medecin_sk", ("code_medecin", "specialite", "grade", "annees_experience"), first=AFTER_DEFAULT,
                          identity=("code_medecin", "specialite"), attributes=("grade", "annees_experience", "service_sk")),
    "dim_gravite": Member("gravite_sk", ("niveau_urgence",), Code("code_gravite", "G", 2), AFTER_DEFAULT),
    "dim_transport": Member("transport_sk", ("mode_transport",), Code("code_transport", "T", 2)),
    "dim_motif": Member("motif_sk", ("libelle_motif",), Code("code_motif", "M", 3)),
    "dim_decision": Member("decision_sk", ("type_decision",), Code("code_decision", "D", 3), AFTER_DEFAULT),
    "dim_issue": Member("issue_sk", ("type_issue",), Code("code_issue", "IS", 3), AFTER_DEFAULT),
    "dim_lit": Member("lit_sk", ("numero_lit", "type_chambre", "service_sk"), Code("numero_chambre", "CH-", 3),
                      identity=("numero_lit",), attributes=("type_chambre", "service_sk")),
    "dim_admission": Member("admission_sk", ("type_admission", "origine_admission"), Code("code_admission", "ADM-", 3)),
    "dim_accouchement": Member("accouchement_sk", ("type_accouchement",), Code("code_accouchement", "AC", 2)),
    "dim_grossesse": Member("grossesse_sk", ("age_gestationnel", "nb_grossesses", "antecedents_obstetricaux"),
                            Code("code_grossesse", "G-", by_row=True)),
    "dim_nouveaune": Member("bebe_sk", ("poids_naissance", "taille_naissance", "score_apgar", "statut_bebe"),
                            Code("code_bebe", "B-", by_row=True)),
    "dim_complication": Member("complication_sk", ("type_complication",), Code("code_complication", "C", 2)),
}


def _coded(df: DataFrame, spec: Member, loads: int) -> DataFrame:
    """New members with codes of their own: by their number, or by their row and the number of loads before."""
    if spec.code is None:
        return df
    if spec.code.by_row:
        return df.withColumn(spec.code.column, F.concat(spec.code.column, F.lit(f"-{loads}")))
    return df.withColumn(spec.code.column, prefixed_code(spec.code.prefix, F.col(spec.surrogate) - (spec.first - 1), spec.code.width))


def added_members(stored: DataFrame, incoming: DataFrame, table: str, highest: int, loads: int) -> DataFrame:
    """The members of ``incoming`` that ``stored`` lacks, numbered behind its ``highest`` key in their own order.

    Default members are stored already. ``loads`` is the number of loads that made the stored table.
    """
    spec = MEMBERS[table]
    real = F.col(spec.surrogate) >= spec.first
    fresh = append_members(
        stored.where(real), incoming.where(real), spec.surrogate, spec.natural, [spec.surrogate], max(highest, spec.first - 1)
    ) if not spec.of_day else incoming.join(stored.select(spec.surrogate), spec.surrogate, "left_anti")
    return _coded(fresh, spec, loads)


def versioned_members(stored: DataFrame, incoming: DataFrame, table: str, run_date: dt.date, loads: int) -> DataFrame:
    """The whole dimension after ``incoming``: changed members get a version, new ones a first version, all others stay.

    Columns that a table does not declare (whether a version is active, its number) follow from its days.
    """
    spec = MEMBERS[table]
    columns, natural = incoming.columns, spec.identity or spec.natural
    carried = [spec.code.column] if spec.code else []
    filled = {"est_actif": F.col("date_fin_validite").isNull(), "version_ligne": F.lit(1)}
    held = stored.withColumns({c: e for c, e in filled.items() if c not in stored.columns})
    sent = latest_members(incoming, spec.surrogate, natural)
    merged = merge_versions(
        one_active(held, spec.surrogate, natural, run_date), sent, spec.surrogate, natural, spec.attributes, run_date, carried)
    if spec.code:
        # Keys above the stored ones are new; only first versions among them are new members.
        new = (F.col(spec.surrogate) > held.agg(F.coalesce(F.max(spec.surrogate), F.lit(0))).scalar()) & (F.col("version_ligne") == 1)
        coded = _coded(merged.withColumn("_own", F.col(spec.code.column)), spec, loads)
        merged = coded.withColumn(spec.code.column, F.when(new, F.col(spec.code.column)).otherwise(F.col("_own"))).drop("_own")
    return merged.select(*columns)
