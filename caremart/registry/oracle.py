"""SQL counterparts of the registered queries, for DuckDB over the driver tables.

Written from the semantics, with the database's own date, text and window functions. Steps are
named CTEs; a query takes the ones it needs.
"""

from __future__ import annotations

import math
import re

from caremart.registry import fixtures as fx

RUN_DATE = "DATE '2024-06-30'"

# Written forms in the order they are tried.
_LENIENT = ("%Y-%m-%d %H:%M:%S", "%Y-%m-%d %H:%M", "%Y-%m-%d", "%d/%m/%Y %H:%M:%S", "%d/%m/%Y %H:%M", "%d/%m/%Y",
            "%d-%m-%Y %H:%M:%S", "%d-%m-%Y %H:%M", "%d-%m-%Y", "%m/%d/%Y %H:%M:%S", "%m/%d/%Y %H:%M", "%m/%d/%Y",
            "%Y%m%d", "%d%m%Y")
# Other written forms, month first where a text leaves it open.
_TOLERANT = ("%Y-%m-%dT%H:%M:%S", "%m/%d/%Y %H:%M:%S.%f", "%d/%m/%Y %H:%M:%S.%f", "%m/%d/%Y %H:%M", "%d/%m/%Y %H:%M", "%m %d %Y",
             "%d %m %Y", "%Y %m %d", "%b-%d-%Y", "%Y-%b-%d", "%d %b %Y", "%Y.%m.%d", "%m/%d/%Y %I:%M %p", "%d/%m/%Y %I:%M %p",
             "%b %d, %Y %H:%M", "%m/%Y", "%Y%m%d %H%M", "%d-%b-%y")
_STRICT = ("%Y-%m-%d %H:%M:%S", "%Y-%m-%d", "%d/%m/%Y %H:%M", "%d/%m/%Y", "%d-%m-%Y %H:%M", "%d-%m-%Y")


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def lenient(x: str) -> str:
    spoken = strip(x)
    for shape, said in ((r"^(\d{1,2}:\d{2}) (.*)$", r"\2 \1"), (r"(\d)h(\d\d)$", r"\1:\2"), (r"^(\d{1,2})(st|nd|rd|th) ", r"\1 "),
                        (r"(:\d\d)(Z|[+-]\d\d:\d\d)$", r"\1")):
        spoken = f"regexp_replace({spoken}, '{shape}', '{said}')"
    tries = [f"try_strptime({strip(x)}, '{form}')" for form in _LENIENT] + [f"try_strptime({spoken}, '{form}')" for form in _TOLERANT]
    return "coalesce(" + ", ".join(f"CASE WHEN year({t}) BETWEEN 2020 AND 2030 THEN {t} END" for t in tries) + ")"


def lenient_or(x: str) -> str:
    return f"coalesce({lenient(x)}, TIMESTAMP '2025-01-01 00:00:00')"


def strict(x: str) -> str:
    return "coalesce(" + ", ".join(f"try_strptime({strip(x)}, '{form}')" for form in _STRICT) + ")"


def pseudonym(x: str) -> str:
    return f"CASE WHEN {strip(x)} <> '' THEN sha256({strip(x)}) END"


def number_in(x: str) -> str:
    return rf"try_cast(regexp_extract({x}, '[-+]?\d*\.?\d+') AS DOUBLE)"


def title(x: str) -> str:
    return (rf"array_to_string(list_transform(regexp_extract_all(lower({x}), '\p{{L}}+|[^\p{{L}}]+'), "
            "lambda w: upper(w[1]) || w[2:]), '')")


def truncated(x: str) -> str:
    return f"CAST(trunc({x}) AS INTEGER)"


def band(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL THEN 'Inconnu' WHEN trunc({x}) <= 5 THEN '0-5 ans' WHEN trunc({x}) <= 15 THEN "
            f"'6-15 ans' WHEN trunc({x}) <= 30 THEN '16-30 ans' WHEN trunc({x}) <= 60 THEN '31-60 ans' "
            f"ELSE '60 ans et +' END")


def bucket(buckets: int, *keys: str) -> str:
    """The seeded number of some keys."""
    text = ", ".join(f"coalesce(CAST({k} AS VARCHAR), '')" for k in keys)
    return f"(CAST('0x' || substr(md5(concat_ws('|', {text}, '0')), 1, 8) AS BIGINT) % {buckets})"


def seeded_distance(*keys: str) -> str:
    return f"round(1 + {bucket(1901, *keys)} / 100, 2)"


def seeded_capacity(*keys: str) -> str:
    return f"CAST(10 + {bucket(50, *keys)} AS INTEGER)"


def seeded_sex(*keys: str) -> str:
    return f"(['M', 'F'])[{bucket(2, *keys)} + 1]"


def _validity(active: bool = True, version: bool = True) -> str:
    parts = [f"{RUN_DATE} AS date_debut_validite", "CAST(NULL AS DATE) AS date_fin_validite"]
    parts += ["true AS est_actif"] if active else []
    parts += ["1 AS version_ligne"] if version else []
    return ", ".join(parts)


def _first_seen(source: str, columns: list[str], required: list[str], key: str, start: int = 1) -> str:
    """Distinct rows numbered by first position, NULLs and ties by value."""
    cols = ", ".join(columns)
    known = " AND ".join(f"{c} IS NOT NULL" for c in required)
    order = ", ".join(["src_row", *[f"{c} NULLS FIRST" for c in columns]])
    return (f"SELECT CAST(row_number() OVER (ORDER BY {order}) + {start - 1} AS INTEGER) AS {key}, * FROM "
            f"(SELECT {cols}, min(src_row) AS src_row FROM {source} WHERE {known} GROUP BY {cols})")


def _std(source: str, date: str, numeric: tuple[str, ...], parsed: str) -> str:
    kept = f"SELECT * REPLACE ({parsed} AS {date}"
    for c in numeric:
        kept += f", try_cast({c} AS DOUBLE) AS {c}"
    return f"{kept}), {pseudonym('ID_Patient')} AS pseudonym FROM raw_{source}"


_VISIT_NUMBERS = ("Niveau_Urgence", "Temps_Attente_Tri", "Temps_Attente_Orientation")
_CONSULT_NUMBERS = ("Annee_Experience", "Duree_Consultation", "Nbr_Medicaments", "Temps_Attente")
_BIRTH_NUMBERS = ("Age_Gestationnel", "Nb_Grossesses", "Poids_Nouveau_Ne", "Taille_Naissance", "Score_Apgar")

CTES: dict[str, str] = {
    **{f"raw_{name}": fx.in_duckdb(text) for name, text in fx.SOURCES.items()},
    "std_patient": f"""
        SELECT src_row, {strip('ID_Patient')} AS ID_Patient, {pseudonym('ID_Patient')} AS ID_Patient_Anonyme,
          {strip(title('Nom_Complet'))} AS Nom_Complet, {strip('upper(Sexe)')} AS Sexe, try_cast(Age AS DOUBLE) AS Age,
          {band('try_cast(Age AS DOUBLE)')} AS Tranche_Age, {number_in('Poids')} AS Poids,
          {number_in('Taille')} AS Taille, Statut_Nutritionnel, Antecedents_Medicaux, Commune, Quartier
        FROM raw_patient""",
    "std_urgence": f"SELECT * FROM ({_std('urgence', 'Date_Arrivee', _VISIT_NUMBERS, lenient('Date_Arrivee'))}) "
                   "WHERE Date_Arrivee IS NOT NULL",
    "std_consultation": _std("consultation", "Date_Consultation", _CONSULT_NUMBERS, lenient_or("Date_Consultation")),
    "std_hospitalisation": _std("hospitalisation", "Date_Admission", ("Duree_Sejour",), lenient_or("Date_Admission")),
    "std_maternite": _std("maternite", "Date_Accouchement", _BIRTH_NUMBERS, lenient_or("Date_Accouchement")),
    "strict_urgence": f"SELECT * FROM ({_std('urgence', 'Date_Arrivee', _VISIT_NUMBERS, strict('Date_Arrivee'))}) "
                      "WHERE Date_Arrivee IS NOT NULL",
    "strict_consultation": _std("consultation", "Date_Consultation", _CONSULT_NUMBERS, strict("Date_Consultation")),
    "strict_hospitalisation": _std("hospitalisation", "Date_Admission", ("Duree_Sejour",), strict("Date_Admission")),
    "strict_maternite": _std("maternite", "Date_Accouchement", _BIRTH_NUMBERS, strict("Date_Accouchement")),
    "calendar": """
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS temps_sk, CAST(d AS DATE) AS date_complete
        FROM range(TIMESTAMP '2024-01-01', TIMESTAMP '2027-01-01', INTERVAL 1 DAY) r(d)""",
    "dim_temps": """
        SELECT temps_sk, date_complete, CAST(day(date_complete) AS INTEGER) AS jour,
          CAST(month(date_complete) AS INTEGER) AS mois, CAST(quarter(date_complete) AS INTEGER) AS trimestre,
          CAST(year(date_complete) AS INTEGER) AS annee, CAST(week(date_complete) AS INTEGER) AS semaine,
          dayname(date_complete) AS jour_semaine,
          CASE WHEN isodow(date_complete) >= 6 THEN 'Weekend' ELSE 'Ouvrable' END AS type_jour, 0 AS heure,
          'Matin' AS periode_journee
        FROM calendar""",
    "dim_patient": f"""
        SELECT CAST(row_number() OVER (ORDER BY src_row) AS INTEGER) AS patient_sk,
          ID_Patient_Anonyme AS id_patient_anonyme, coalesce(Sexe, 'Inconnu') AS sexe,
          coalesce({truncated('Age')}, 0) AS age, Tranche_Age AS tranche_age, Poids AS poids, Taille AS taille,
          coalesce(Statut_Nutritionnel, 'Normal') AS statut_nutritionnel,
          coalesce(Antecedents_Medicaux, 'Aucun') AS antecedents_medicaux, {_validity()}
        FROM (SELECT *, row_number() OVER (PARTITION BY ID_Patient_Anonyme ORDER BY src_row) AS nth FROM std_patient)
        WHERE nth = 1""",
    "dim_geographie": f"""
        SELECT geographie_sk, CAST(src_row AS VARCHAR) AS id_localisation, Quartier AS quartier, Commune AS commune,
          'Lubumbashi' AS ville, CAST(NULL AS VARCHAR) AS zone_sante,
          {seeded_distance('Commune', 'Quartier')} AS distance_hopital
        FROM ({_first_seen('raw_patient', ['Commune', 'Quartier'], ['Commune', 'Quartier'], 'geographie_sk')})""",
    "dim_service": f"""
        SELECT 1 AS service_sk, 'SRV-DEF' AS id_service, 'Service par défaut' AS nom_service,
          'Général' AS type_service, 10 AS capacite_lits, {_validity()}
        UNION ALL
        SELECT service_sk, printf('SRV%03d', service_sk - 1), Service_Affectation, 'Hospitalisation',
          {seeded_capacity('Service_Affectation')}, {_validity()}
        FROM ({_first_seen('raw_hospitalisation', ['Service_Affectation'], ['Service_Affectation'], 'service_sk', 2)})
        """,
    "vocabulary": """
        SELECT libelle, min((origin, src_row)) AS place FROM (
          SELECT Pathologie AS libelle, 0 AS origin, src_row FROM raw_consultation WHERE Pathologie IS NOT NULL
          UNION ALL
          SELECT Pathologie_Principale, 1, src_row FROM raw_hospitalisation WHERE Pathologie_Principale IS NOT NULL)
        GROUP BY libelle""",
    "dim_pathologie": f"""
        SELECT 1 AS pathologie_sk, 'UNK' AS code_cim10, 'Pathologie inconnue' AS libelle, 'Général' AS categorie,
          'Modéré' AS niveau_gravite, {_validity(active=False)}
        UNION ALL
        SELECT CAST(n + 1 AS INTEGER), printf('CIM%03d', n), libelle, 'Infectieux', 'Modéré', {_validity(active=False)}
        FROM (SELECT libelle, row_number() OVER (ORDER BY place, libelle) AS n FROM vocabulary)""",
    "dim_medecin": f"""
        SELECT 1 AS medecin_sk, 'MED-DEF' AS code_medecin, 'Généraliste' AS specialite, 1 AS service_sk,
          'Spécialiste' AS grade, 5 AS annees_experience, {_validity(active=False)}
        UNION ALL
        SELECT medecin_sk, substr(Medecin, 1, 40), coalesce(Specialite_Medecin, 'Générale'), 1,
          coalesce(Grade_Medecin, 'Spécialiste'), coalesce({truncated('Annee_Experience')}, 5),
          {_validity(active=False)}
        FROM ({_first_seen('(SELECT * REPLACE (try_cast(Annee_Experience AS DOUBLE) AS Annee_Experience) '
                           'FROM raw_consultation)',
                           ['Medecin', 'Specialite_Medecin', 'Grade_Medecin', 'Annee_Experience'], ['Medecin'],
                           'medecin_sk', 2)})""",
    "dim_gravite": """
        SELECT 1 AS gravite_sk, 'G-DEF' AS code_gravite, 3 AS niveau_urgence, 'Modérée' AS categorie
        UNION ALL
        SELECT CAST(n + 1 AS INTEGER), printf('G%02d', n), level,
          CASE WHEN level <= 2 THEN 'Faible' WHEN level <= 3 THEN 'Modérée' ELSE 'Critique' END
        FROM (SELECT level, row_number() OVER (ORDER BY level) AS n FROM
          (SELECT DISTINCT CAST(trunc(Niveau_Urgence) AS INTEGER) AS level FROM std_urgence
           WHERE Niveau_Urgence IS NOT NULL))""",
    "dim_transport": f"""
        SELECT transport_sk, printf('T%02d', transport_sk) AS code_transport, Mode_Transport AS mode_transport,
          false AS est_reference
        FROM ({_first_seen('std_urgence', ['Mode_Transport'], ['Mode_Transport'], 'transport_sk')})""",
    "dim_motif": f"""
        SELECT motif_sk, printf('M%03d', motif_sk) AS code_motif, Motif_Consultation AS libelle_motif,
          'Urgence' AS categorie_motif
        FROM ({_first_seen('std_urgence', ['Motif_Consultation'], ['Motif_Consultation'], 'motif_sk')})""",
    "dim_decision": f"""
        SELECT 1 AS decision_sk, 'D-DEF' AS code_decision, 'Inconnu' AS type_decision,
          'Non précisé' AS service_destination
        UNION ALL
        SELECT decision_sk, printf('D%03d', decision_sk - 1), Decision_Medicale, 'Non précisé'
        FROM ({_first_seen('std_urgence', ['Decision_Medicale'], ['Decision_Medicale'], 'decision_sk', 2)})""",
    "dim_issue": f"""
        SELECT 1 AS issue_sk, 'IS-DEF' AS code_issue, 'Inconnu' AS type_issue, 'Indéterminée' AS categorie_issue
        UNION ALL
        SELECT issue_sk, printf('IS%03d', issue_sk - 1), Issue_Sortie, 'Sortie'
        FROM ({_first_seen('raw_hospitalisation', ['Issue_Sortie'], ['Issue_Sortie'], 'issue_sk', 2)})""",
    "dim_lit": f"""
        SELECT lit_sk, Numero_Lit AS numero_lit, printf('CH-%03d', lit_sk) AS numero_chambre,
          coalesce(Type_Chambre, 'Standard') AS type_chambre, coalesce(s.sk, 1) AS service_sk,
          {_validity(version=False)}
        FROM ({_first_seen('raw_hospitalisation', ['Numero_Lit', 'Type_Chambre', 'Service_Affectation'],
                           ['Numero_Lit'], 'lit_sk')})
        LEFT JOIN by_service s ON lower(Service_Affectation) = s.name""",
    "dim_admission": f"""
        SELECT admission_sk, printf('ADM-%03d', admission_sk) AS code_admission, Type_Admission AS type_admission,
          Origine_Admission AS origine_admission
        FROM ({_first_seen('raw_hospitalisation', ['Type_Admission', 'Origine_Admission'],
                           ['Type_Admission', 'Origine_Admission'], 'admission_sk')})""",
    "dim_accouchement": f"""
        SELECT accouchement_sk, printf('AC%02d', accouchement_sk) AS code_accouchement,
          Type_Accouchement AS type_accouchement, CAST(0 AS DOUBLE) AS duree_travail
        FROM ({_first_seen('raw_maternite', ['Type_Accouchement'], ['Type_Accouchement'], 'accouchement_sk')})""",
    "dim_grossesse": f"""
        SELECT grossesse_sk, printf('G-%03d', src_row) AS code_grossesse,
          {truncated('Age_Gestationnel')} AS age_gestationnel, {truncated('Nb_Grossesses')} AS nb_grossesses,
          Antecedents_Obstetricaux AS antecedents_obstetricaux, {_validity()}
        FROM ({_first_seen('std_maternite', ['Age_Gestationnel', 'Nb_Grossesses', 'Antecedents_Obstetricaux'],
                           ['Age_Gestationnel', 'Nb_Grossesses', 'Antecedents_Obstetricaux'], 'grossesse_sk')})""",
    "dim_nouveaune": f"""
        SELECT bebe_sk, printf('B-%03d', src_row) AS code_bebe,
          {seeded_sex('Poids_Nouveau_Ne', 'Taille_Naissance', 'Score_Apgar', 'Statut_Bebe')} AS sexe_bebe,
          Poids_Nouveau_Ne AS poids_naissance,
          Taille_Naissance AS taille_naissance, {truncated('Score_Apgar')} AS score_apgar, Statut_Bebe AS statut_bebe,
          {_validity()}
        FROM ({_first_seen('std_maternite', ['Poids_Nouveau_Ne', 'Taille_Naissance', 'Score_Apgar', 'Statut_Bebe'],
                           ['Poids_Nouveau_Ne', 'Taille_Naissance', 'Score_Apgar', 'Statut_Bebe'], 'bebe_sk')})""",
    "dim_complication": f"""
        SELECT complication_sk, printf('C%02d', complication_sk) AS code_complication,
          Complication_Type AS type_complication, 'Modérée' AS niveau_gravite
        FROM ({_first_seen('raw_maternite', ['Complication_Type'], ['Complication_Type'], 'complication_sk')})""",
    "by_patient": "SELECT upper(id_patient_anonyme) AS name, max(patient_sk) AS sk FROM dim_patient GROUP BY 1",
}


def _by(name: str, dim: str, key: str, column: str, lower: bool = True) -> None:
    text = strip(column)
    CTES[name] = f"SELECT {f'lower({text})' if lower else text} AS name, max({key}) AS sk FROM {dim} GROUP BY 1"


_by("by_service", "dim_service", "service_sk", "nom_service")
_by("by_pathologie", "dim_pathologie", "pathologie_sk", "libelle")
_by("by_medecin", "dim_medecin", "medecin_sk", "code_medecin")
_by("by_decision", "dim_decision", "decision_sk", "type_decision")
_by("by_motif", "dim_motif", "motif_sk", "libelle_motif")
_by("by_issue", "dim_issue", "issue_sk", "type_issue")
_by("by_lit", "dim_lit", "lit_sk", "numero_lit", lower=False)
_by("by_admission", "dim_admission", "admission_sk", "type_admission")
_by("by_accouchement", "dim_accouchement", "accouchement_sk", "type_accouchement")
_by("by_complication", "dim_complication", "complication_sk", "type_complication")
CTES["by_gravite"] = "SELECT niveau_urgence AS name, max(gravite_sk) AS sk FROM dim_gravite GROUP BY 1"
CTES["by_grossesse"] = "SELECT age_gestationnel AS name, max(grossesse_sk) AS sk FROM dim_grossesse GROUP BY 1"
CTES["by_bebe"] = ("SELECT poids_naissance AS p, taille_naissance AS t, score_apgar AS a, max(bebe_sk) AS sk "
                   "FROM dim_nouveaune GROUP BY 1, 2, 3")


def _visits(std: str, patient: str, unknown: int = 1, stripped: bool = False) -> str:
    text = (lambda c: f"lower({strip(c)})") if stripped else (lambda c: f"lower({c})")
    return f"""
        SELECT src_row + 1 AS id_fait, c.temps_sk, coalesce(p.sk, {unknown}) AS patient_sk, {unknown} AS geographie_sk,
          coalesce(s.sk, {unknown}) AS service_sk, {unknown} AS paiement_sk, {unknown} AS contexte_sk,
          coalesce(g.sk, {unknown}) AS gravite_sk, {unknown} AS transport_sk, coalesce(m.sk, {unknown}) AS motif_sk,
          coalesce(d.sk, {unknown}) AS decision_sk, 1 AS nb_arrivees,
          coalesce({truncated('Temps_Attente_Tri')}, 0) AS temps_attente_tri,
          coalesce({truncated('Temps_Attente_Orientation')}, 0) AS temps_attente_orientation,
          0 AS nb_non_pris_en_charge
        FROM {std} v JOIN calendar c ON CAST(v.Date_Arrivee AS DATE) = c.date_complete
        {patient} JOIN by_patient p ON upper(v.pseudonym) = p.name
        LEFT JOIN by_service s ON {text('v.Service')} = s.name
        LEFT JOIN by_gravite g ON trunc(v.Niveau_Urgence) = g.name
        LEFT JOIN by_decision d ON {text('v.Decision_Medicale')} = d.name
        LEFT JOIN by_motif m ON {text('v.Motif_Consultation')} = m.name"""


def _consultations(std: str, join: str) -> str:
    return f"""
        SELECT src_row + 1 AS id_fait, coalesce(c.temps_sk, 1) AS temps_sk, coalesce(p.sk, 1) AS patient_sk,
          coalesce(s.sk, 1) AS service_sk, coalesce(h.sk, 1) AS pathologie_sk, 1 AS paiement_sk, 1 AS contexte_sk,
          coalesce(m.sk, 1) AS medecin_sk, 1 AS gravite_sk, 1 AS decision_sk, 1 AS nb_consultations,
          coalesce(Duree_Consultation, CAST(15 AS DOUBLE)) AS duree_consultation,
          coalesce({truncated('Nbr_Medicaments')}, 0) AS nb_medicaments, 0 AS nb_examens,
          coalesce({truncated('Temps_Attente')}, 0) AS temps_attente
        FROM {std} v {join} JOIN calendar c ON CAST(v.Date_Consultation AS DATE) = c.date_complete
        {join} JOIN by_patient p ON upper(v.pseudonym) = p.name
        LEFT JOIN by_service s ON lower(v.Specialite_Medecin) = s.name
        LEFT JOIN by_pathologie h ON lower(v.Pathologie) = h.name
        LEFT JOIN by_medecin m ON lower(v.Medecin) = m.name"""


def _stays(std: str, patient: str, beds: bool) -> str:
    return f"""
        SELECT src_row + 1 AS id_fait, c.temps_sk, coalesce(p.sk, 1) AS patient_sk, coalesce(s.sk, 1) AS service_sk,
          coalesce(h.sk, 1) AS pathologie_sk, 1 AS geographie_sk, 1 AS contexte_sk,
          {'coalesce(l.sk, 1)' if beds else '1'} AS lit_sk, coalesce(a.sk, 1) AS admission_sk,
          coalesce(i.sk, 1) AS issue_sk, 1 AS nb_hospitalisations,
          coalesce(Duree_Sejour, CAST(0 AS DOUBLE)) AS duree_sejour, 1 AS nb_lits_occupes, 0 AS nb_deces,
          1 AS nb_sorties
        FROM {std} v JOIN calendar c ON CAST(v.Date_Admission AS DATE) = c.date_complete
        {patient} JOIN by_patient p ON upper(v.pseudonym) = p.name
        LEFT JOIN by_service s ON lower(v.Service_Affectation) = s.name
        LEFT JOIN by_pathologie h ON lower(v.Pathologie_Principale) = h.name
        LEFT JOIN by_issue i ON lower(v.Issue_Sortie) = i.name
        {f"LEFT JOIN by_lit l ON {strip('v.Numero_Lit')} = l.name" if beds else ""}
        LEFT JOIN by_admission a ON lower(v.Type_Admission) = a.name"""


def _births(std: str, join: str, clamp: bool) -> str:
    weight = ("CASE WHEN Poids_Nouveau_Ne < 10000 THEN Poids_Nouveau_Ne ELSE CAST(0 AS DOUBLE) END" if clamp
              else "coalesce(Poids_Nouveau_Ne, CAST(0 AS DOUBLE))")
    return f"""
        SELECT src_row + 1 AS id_fait, coalesce(c.temps_sk, 1) AS temps_sk, coalesce(p.sk, 1) AS patient_sk,
          1 AS service_sk, 1 AS geographie_sk, 1 AS contexte_sk, coalesce(a.sk, 1) AS accouchement_sk,
          coalesce(g.sk, 1) AS grossesse_sk, coalesce(b.sk, 1) AS bebe_sk, coalesce(x.sk, 1) AS complication_sk,
          1 AS pathologie_sk, 1 AS nb_accouchements,
          CASE WHEN lower(Type_Accouchement) = 'césarienne' THEN 1 ELSE 0 END AS nb_cesariennes,
          CASE WHEN lower(Complication_Type) = 'aucune' THEN 0 ELSE 1 END AS nb_complications,
          {weight} AS poids_naissance, 0 AS nb_deces_maternels, 0 AS nb_deces_neonatals
        FROM {std} v {join} JOIN calendar c ON CAST(v.Date_Accouchement AS DATE) = c.date_complete
        {join} JOIN by_patient p ON upper(v.pseudonym) = p.name
        LEFT JOIN by_accouchement a ON lower({strip('v.Type_Accouchement')}) = a.name
        LEFT JOIN by_complication x ON lower({strip('v.Complication_Type')}) = x.name
        LEFT JOIN by_grossesse g ON v.Age_Gestationnel = g.name
        LEFT JOIN by_bebe b ON v.Poids_Nouveau_Ne = b.p AND v.Taille_Naissance = b.t AND v.Score_Apgar = b.a"""


CTES["fact_visits"] = _visits("std_urgence", "LEFT")
CTES["fact_consultations"] = _consultations("std_consultation", "LEFT")
CTES["fact_stays"] = _stays("std_hospitalisation", "LEFT", beds=True)
CTES["fact_births"] = _births("std_maternite", "LEFT", clamp=True)

_OCC = fx.in_duckdb(fx.OCCUPANCY)
_SVC = fx.in_duckdb(fx.SERVICES)
CTES.update({
    "occupancy": f"SELECT o.*, s.service_sk, s.capacite_lits FROM ({_OCC}) o JOIN ({_SVC}) s "
                 "ON o.event_type = s.nom_service",
    "short_occupancy": f"SELECT o.*, s.service_sk, s.capacite_lits FROM ({fx.in_duckdb(fx.SHORT_OCCUPANCY)}) o "
                       f"JOIN ({_SVC}) s ON o.event_type = s.nom_service",
    "observed": """
        SELECT service_sk, d, avg(beds / capacite_lits) AS rate, avg(beds) AS beds,
          avg(CAST(capacite_lits AS DOUBLE)) AS capacity
        FROM occupancy WHERE capacite_lits > 0 GROUP BY ALL""",
    "spans": "SELECT service_sk, min(d) AS first_d, max(d) AS last_d FROM observed GROUP BY ALL",
    "dense": """
        SELECT s.service_sk, CAST(g.d AS DATE) AS d FROM spans s,
          LATERAL (SELECT unnest(generate_series(CAST(s.first_d AS TIMESTAMP), CAST(s.last_d AS TIMESTAMP),
                                                 INTERVAL 1 DAY)) AS d) g""",
    "series": """
        SELECT n.service_sk, n.d, row_number() OVER w - 1 AS i,
          last_value(o.rate IGNORE NULLS) OVER w AS rate, last_value(o.beds IGNORE NULLS) OVER w AS beds,
          last_value(o.capacity IGNORE NULLS) OVER w AS capacity
        FROM dense n LEFT JOIN observed o ON n.service_sk = o.service_sk AND n.d = o.d
        WINDOW w AS (PARTITION BY n.service_sk ORDER BY n.d)""",
    "trend": """
        SELECT service_sk, regr_slope(rate, i) AS slope, regr_intercept(rate, i) AS intercept, count(*) AS n,
          max(d) AS last_d, arg_min(capacity, d) AS capacity
        FROM series GROUP BY service_sk""",
    "linear": """
        SELECT service_sk, CAST(k AS INTEGER) AS k, CAST(last_d + CAST(k AS INTEGER) AS DATE) AS d, capacity,
          intercept + slope * (n - 1 + k) AS linear
        FROM trend, range(1, 31) r(k)""",
    "stand_ins": """
        SELECT service_sk, d, k, capacity,
          CASE WHEN k % 4 = 0 THEN NULL ELSE linear * 1.02 END AS ar,
          CASE WHEN k % 3 = 0 THEN NULL ELSE linear * 0.97 END AS seasonal,
          CASE WHEN k % 12 = 0 THEN NULL WHEN k = 29 THEN linear + 0.9 WHEN k = 28 THEN linear - 2.5
               ELSE linear END AS linear,
          CASE WHEN k % 3 = 0 THEN NULL ELSE linear * 0.9 END AS lower,
          CASE WHEN k % 3 = 0 THEN NULL ELSE linear * 1.1 END AS upper
        FROM linear""",
    "combined": """
        SELECT service_sk, d, k, capacity, rate, coalesce(lower, rate * 0.85) AS lower,
          coalesce(upper, rate * 1.15) AS upper
        FROM (SELECT *, greatest(0, least(1, coalesce(list_avg([x FOR x IN [ar, seasonal, linear] IF x IS NOT NULL]),
                                                      0.5))) AS rate FROM stand_ins)""",
    "forecasts": """
        SELECT d AS date_prevision, service_sk, round(rate * 100 + 1e-9, 6) AS occupation_predite,
          CAST(trunc(round(rate * capacity, 9)) AS INTEGER) AS nb_lits_occupes_predits,
          round(lower * 100 + 1e-9, 6) AS intervalle_inf, round(upper * 100 + 1e-9, 6) AS intervalle_sup,
          'Ensemble' AS modele,
          k AS horizon_jours
        FROM combined""",
})


def _solved(source: str, size: int) -> str:
    """``rows`` of normal equations, each with its right side last, after elimination column by column."""
    return f"""
        SELECT service_sk, 0 AS step, eqs FROM {source}
        UNION ALL
        SELECT service_sk, step + 1, list_transform(eqs, lambda r, i: CASE WHEN i = step + 1
            THEN list_transform(r, lambda x: x / eqs[step + 1][step + 1])
            ELSE list_transform(r, lambda x, j: x - r[step + 1] / eqs[step + 1][step + 1] * eqs[step + 1][j]) END)
        FROM {source}_solved WHERE step < {size}"""


_LAGS = range(1, 6)
_TERMS = [f"{f}(day * {2 * math.pi * k / period!r})" for period, order in ((365.25, 10), (7.0, 3)) for k in range(1, order + 1)
          for f in ("sin", "cos")]
_DESIGN = "[1.0::DOUBLE, (day - origin) / span, " + ", ".join(_TERMS) + "]"
_RECURSIVE = {"ar_fit_solved", "ar_ahead", "wave_fit_solved"}
CTES.update({
    "ar_steps": "SELECT *, " + ", ".join(f"lag(dz, {k}) OVER w AS z{k}" for k in _LAGS) + """
        FROM (SELECT service_sk, d, rate, rate - lag(rate) OVER (PARTITION BY service_sk ORDER BY d) AS dz FROM series)
        WINDOW w AS (PARTITION BY service_sk ORDER BY d)""",
    "ar_fit": "SELECT service_sk, [" + ", ".join(
        "[" + ", ".join(f"sum(z{i} * {f'z{j}' if j else 'dz'}) FILTER (z5 IS NOT NULL)" for j in (*_LAGS, 0)) + "]" for i in _LAGS)
        + "] AS eqs, arg_max([dz, z1, z2, z3, z4], d) AS recent, arg_max(rate, d) AS newest FROM ar_steps GROUP BY service_sk",
    "ar_fit_solved": _solved("ar_fit", 5),
    "ar_ahead": """
        SELECT service_sk, 0 AS k, recent AS held, newest AS level, [r[6] FOR r IN s.eqs] AS weights
        FROM ar_fit f JOIN ar_fit_solved s USING (service_sk) WHERE step = 5
        UNION ALL
        SELECT service_sk, k + 1, list_prepend(list_inner_product(weights, held), held[1:4]), level + list_inner_product(weights, held), weights
        FROM ar_ahead WHERE k < 30""",
    "wave_days": """
        SELECT *, max(day) OVER (PARTITION BY service_sk) AS last_day, min(day) OVER (PARTITION BY service_sk) AS origin,
          max(abs(rate)) OVER (PARTITION BY service_sk) AS scale,
          greatest(max(day) OVER (PARTITION BY service_sk) - min(day) OVER (PARTITION BY service_sk), 1.0) AS span
        FROM (SELECT service_sk, rate, CAST(d - DATE '1970-01-01' AS DOUBLE) AS day FROM series)""",
    "wave_design": f"SELECT *, rate / scale AS y, {_DESIGN} AS x FROM wave_days",
    "wave_noise": """
        SELECT service_sk, any_value(last_day) AS last_day, any_value(origin) AS origin, any_value(scale) AS scale, any_value(span) AS span,
          count(*) AS n, sum(y * y) AS yy, power(greatest(sqrt(greatest(regr_syy(y, x[2]) - power(regr_sxy(y, x[2]), 2) / regr_sxx(y, x[2]), 0)
            / count(*)), 1e-3) / 10, 2) AS penalty
        FROM wave_design GROUP BY service_sk""",
    "wave_sums": """
        SELECT service_sk, i, j, sum(x[i] * CASE WHEN j = 29 THEN y ELSE x[j] END) AS g
        FROM wave_design, range(1, 29) a(i), range(1, 30) b(j) GROUP BY ALL""",
    "wave_rows": "SELECT service_sk, i, list(g ORDER BY j) AS r FROM wave_sums GROUP BY ALL",
    "wave_fit": """
        SELECT service_sk, list(list_transform(r, lambda v, j: CASE WHEN j = i AND i > 2 THEN v + penalty ELSE v END) ORDER BY i) AS eqs
        FROM wave_rows JOIN wave_noise USING (service_sk) GROUP BY service_sk""",
    "wave_fit_solved": _solved("wave_fit", 28),
    "wave_weights": """
        SELECT n.*, [r[29] FOR r IN s.eqs] AS weights, plain.eqs AS plain
        FROM wave_noise n JOIN wave_fit_solved s ON n.service_sk = s.service_sk AND s.step = 28
        JOIN (SELECT service_sk, list(r ORDER BY i) AS eqs FROM wave_rows GROUP BY service_sk) plain ON plain.service_sk = n.service_sk""",
    "wave_spread": """
        SELECT *, 1.2815515655446004 * scale * sqrt(greatest((yy - 2 * list_inner_product(weights, [r[29] FOR r IN plain])
            + list_inner_product(weights, [list_inner_product(r[1:28], weights) FOR r IN plain])) / n
            - power((plain[1][29] - list_inner_product(plain[1][1:28], weights)) / n, 2), 0)) AS spread
        FROM wave_weights""",
    "wave_model": f"""
        SELECT service_sk, k, list_inner_product(weights, {_DESIGN}) * scale AS seasonal, spread
        FROM (SELECT w.*, CAST(r.k AS INTEGER) AS k, last_day + r.k AS day FROM wave_spread w, range(1, 31) r(k))""",
    "whole_models": """
        SELECT l.service_sk, l.k, l.d, l.capacity, greatest(0, least(1, (a.level + w.seasonal + l.linear) / 3)) AS rate,
          w.seasonal - w.spread AS lower, w.seasonal + w.spread AS upper
        FROM linear l JOIN ar_ahead a ON a.service_sk = l.service_sk AND a.k = l.k
        JOIN wave_model w ON w.service_sk = l.service_sk AND w.k = l.k""",
})


def query(final: str, ctes: dict[str, str] | None = None, stored: bool = False) -> str:
    """``final`` behind the steps it needs (of ``ctes``, all unless given), directly or through others, in definition-safe order."""
    ctes = CTES if ctes is None else ctes
    order: list[str] = []

    def need(text: str) -> None:
        for name in ctes:
            if name not in order and re.search(rf"\b{name}\b", text):
                order_guard = set(order)
                need(re.sub(rf"\b{name}\b", "", ctes[name]))
                if name not in order_guard and name not in order:
                    order.append(name)

    need(final)
    if not order:
        return final
    steps = ",\n".join(f"{name} AS {'MATERIALIZED ' if stored else ''}({ctes[name]})" for name in order)
    return f"WITH {'RECURSIVE ' if _RECURSIVE & set(order) else ''}{steps}\n{final}"


def strict_query(final: str) -> str:
    """``query`` over strictly parsed sources: ``std_`` names stand for the strict ones."""
    strict = {f"std_{name}": CTES[f"strict_{name}"] for name in ("urgence", "consultation", "hospitalisation", "maternite")}
    return query(final, CTES | strict)
