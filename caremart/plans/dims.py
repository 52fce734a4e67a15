"""The seventeen dimensions: members in first-seen order, dense keys, default members."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caremart.functions import (
    date_key,
    prefixed_code,
    seeded_choice,
    seeded_integer,
    seeded_uniform,
    severity_class,
    strip,
    truncate_int,
)
from caremart.operators.keys import POSITION, dense_key, keep_first, number_members
from caremart.operators.lookup import resolve
from caremart.plans.settings import LoadSettings
from caremart.plans.standardise import PSEUDONYM
from caremart.session import materialise, together

Sources = dict[str, DataFrame]

# The member with key 1 that stands for "unknown" in six dimensions.
DEFAULT_MEMBERS = {
    "dim_service": {"service_sk": 1, "id_service": "SRV-DEF", "nom_service": "Service par défaut",
                    "type_service": "Général", "capacite_lits": 10},
    "dim_pathologie": {"pathologie_sk": 1, "code_cim10": "UNK", "libelle": "Pathologie inconnue",
                       "categorie": "Général", "niveau_gravite": "Modéré"},
    "dim_medecin": {"medecin_sk": 1, "code_medecin": "MED-DEF", "specialite": "Généraliste", "service_sk": 1,
                    "grade": "Spécialiste", "annees_experience": 5},
    "dim_gravite": {"gravite_sk": 1, "code_gravite": "G-DEF", "niveau_urgence": 3, "categorie": "Modérée"},
    "dim_decision": {"decision_sk": 1, "code_decision": "D-DEF", "type_decision": "Inconnu",
                     "service_destination": "Non précisé"},
    "dim_issue": {"issue_sk": 1, "code_issue": "IS-DEF", "type_issue": "Inconnu", "categorie_issue": "Indéterminée"},
}
#: First key of the real members where key 1 is the default member.
AFTER_DEFAULT = 2
#: Physician names are cut to this many characters.
PHYSICIAN_CODE_LENGTH = 40


def validity(settings: LoadSettings, active: bool = True, version: bool = True) -> dict[str, Column]:
    """The versioning columns of a first version."""
    columns = {
        "date_debut_validite": F.lit(settings.run_date).cast("date"),
        "date_fin_validite": F.lit(None).cast("date"),
    }
    if active:
        columns["est_actif"] = F.lit(True)
    if version:
        columns["version_ligne"] = F.lit(1)
    return columns


def default_member(spark: SparkSession, table: str, tail: dict[str, Column] | None = None) -> DataFrame:
    """The one-row default member of a table."""
    values = {name: F.lit(value) for name, value in DEFAULT_MEMBERS[table].items()}
    return spark.range(1).select(*[v.alias(n) for n, v in {**values, **(tail or {})}.items()])


def with_unknown_member(dim: DataFrame, surrogate: str, key: int = -1) -> DataFrame:
    """The dimension plus a member for unresolved keys: the key, and NULL in every other column."""
    blank = [F.lit(key if c.name == surrogate else None).cast(c.dataType).alias(c.name) for c in dim.schema]
    return dim.unionByName(dim.sparkSession.range(1).select(*blank))


def _with_default(members: DataFrame, table: str, tail: dict[str, Column] | None = None) -> DataFrame:
    return default_member(members.sparkSession, table, tail).unionByName(members)


def _project(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return df.select(*[expr.alias(name) for name, expr in columns.items()])


def _key(name: str) -> Column:
    return F.col(name).cast("int")


def _rank(name: str, start: int) -> Column:
    """1-based number of a real member (its key without the offset of the default member)."""
    return F.col(name) - F.lit(start - 1)


def _members(
    source: DataFrame, columns: Sequence[str], required: Sequence[str], name: str, start: int = 1
) -> DataFrame:
    """Distinct rows with the required columns present, numbered in first-seen order."""
    # Plain IS NOT NULL reaches the file scan; dropna() would not.
    known = source.where(" AND ".join(f"`{c}` IS NOT NULL" for c in required))
    return number_members(known, columns, name, start)


def dim_temps(spark: SparkSession, settings: LoadSettings = LoadSettings()) -> DataFrame:
    """One row per calendar day."""
    bounds = [F.lit(d).cast("date") for d in (settings.calendar_start, settings.calendar_end)]
    day = F.col("date_complete")
    return _project(
        spark.range(1).select(F.explode(F.sequence(*bounds, F.expr("INTERVAL 1 DAY"))).alias("date_complete")),
        {
            "temps_sk": date_key(day),
            "date_complete": day,
            "jour": F.dayofmonth(day),
            "mois": F.month(day),
            "trimestre": F.quarter(day),
            "annee": F.year(day),
            "semaine": F.weekofyear(day),
            "jour_semaine": F.date_format(day, "EEEE"),
            "type_jour": F.when(F.weekday(day) >= 5, "Weekend").otherwise("Ouvrable"),
            "heure": F.lit(0),
            "periode_journee": F.lit("Matin"),
        },
    )


def dim_patient(patients: DataFrame, settings: LoadSettings = LoadSettings()) -> DataFrame:
    """First row of each pseudonym, numbered in source order.

    Patients without an identifier share one member whose natural key is NULL: it keeps its place
    in the numbering, is reported by the NOT NULL check and is never matched by a fact.
    """
    wanted = [PSEUDONYM, "Sexe", "Age", "Tranche_Age", "Poids", "Taille", "Statut_Nutritionnel",
              "Antecedents_Medicaux", POSITION]
    keyed = dense_key(keep_first(patients.select(*wanted), PSEUDONYM), [POSITION], "patient_sk")
    return _project(
        keyed,
        {
            "patient_sk": _key("patient_sk"),
            "id_patient_anonyme": F.col(PSEUDONYM),
            "sexe": F.coalesce("Sexe", F.lit("Inconnu")),
            "age": truncate_int(F.col("Age"), 0),
            "tranche_age": F.col("Tranche_Age"),
            "poids": F.col("Poids"),
            "taille": F.col("Taille"),
            "statut_nutritionnel": F.coalesce("Statut_Nutritionnel", F.lit("Normal")),
            "antecedents_medicaux": F.coalesce("Antecedents_Medicaux", F.lit("Aucun")),
            **validity(settings),
        },
    )


def dim_geographie(patients: DataFrame, settings: LoadSettings = LoadSettings()) -> DataFrame:
    """Distinct commune and quarter, both known."""
    columns = ["Commune", "Quartier"]
    return _project(
        _members(patients, columns, columns, "geographie_sk"),
        {
            "geographie_sk": _key("geographie_sk"),
            "id_localisation": F.col(POSITION).cast("string"),
            "quartier": F.col("Quartier"),
            "commune": F.col("Commune"),
            "ville": F.lit(settings.ville),
            "zone_sante": F.lit(settings.zone_sante).cast("string"),
            "distance_hopital": seeded_uniform(1, 20, F.col("Commune"), F.col("Quartier"), seed=settings.seed),
        },
    )


def dim_service(stays: DataFrame, settings: LoadSettings = LoadSettings()) -> DataFrame:
    """Default service and the distinct services of the stays."""
    name = F.col("Service_Affectation")
    members = _project(
        _members(stays, ["Service_Affectation"], ["Service_Affectation"], "service_sk", AFTER_DEFAULT),
        {
            "service_sk": _key("service_sk"),
            "id_service": prefixed_code("SRV", _rank("service_sk", AFTER_DEFAULT), 3),
            "nom_service": name,
            "type_service": F.lit("Hospitalisation"),
            "capacite_lits": seeded_integer(10, 60, name, seed=settings.seed),
            **validity(settings),
        },
    )
    return _with_default(members, "dim_service", validity(settings))


def pathology_vocabulary(consultations: DataFrame, stays: DataFrame) -> DataFrame:
    """Pathology labels of both sources, all consultations placed before all stays."""
    spoken = [(0, consultations, "Pathologie"), (1, stays, "Pathologie_Principale")]
    parts = [
        df.where(F.col(c).isNotNull())
        .groupBy(F.col(c).alias("libelle"))
        .agg(F.min(POSITION).alias(POSITION))
        .withColumn("origin", F.lit(origin))
        for origin, df, c in spoken
    ]
    first, second = parts
    # Each side is distinct already: at most two rows per label reach this aggregate.
    return first.unionByName(second).groupBy("libelle").agg(F.min(F.struct("origin", POSITION)).alias("place"))


def dim_pathologie(consultations: DataFrame, stays: DataFrame, settings: LoadSettings = LoadSettings()) -> DataFrame:
    """Default pathology and the vocabulary of consultations and stays."""
    keyed = dense_key(
        pathology_vocabulary(consultations, stays).select("libelle", "place.*"), ["origin", POSITION, "libelle"], "pathologie_sk",
        AFTER_DEFAULT
    )
    members = _project(
        keyed,
        {
            "pathologie_sk": _key("pathologie_sk"),
            "code_cim10": prefixed_code("CIM", _rank("pathologie_sk", AFTER_DEFAULT), 3),
            "libelle": F.col("libelle"),
            "categorie": F.lit("Infectieux"),
            "niveau_gravite": F.lit("Modéré"),
            **validity(settings, active=False),
        },
    )
    return _with_default(members, "dim_pathologie", validity(settings, active=False))


def dim_medecin(consultations: DataFrame, settings: LoadSettings = LoadSettings()) -> DataFrame:
    """Default physician and the distinct profiles; the name is cut after the distinct."""
    columns = ["Medecin", "Specialite_Medecin", "Grade_Medecin", "Annee_Experience"]
    members = _project(
        _members(consultations, columns, ["Medecin"], "medecin_sk", AFTER_DEFAULT),
        {
            "medecin_sk": _key("medecin_sk"),
            "code_medecin": F.substring("Medecin", 1, PHYSICIAN_CODE_LENGTH),
            "specialite": F.coalesce("Specialite_Medecin", F.lit("Générale")),
            "service_sk": F.lit(1),
            "grade": F.coalesce("Grade_Medecin", F.lit("Spécialiste")),
            "annees_experience": truncate_int(F.col("Annee_Experience"), 5),
            **validity(settings, active=False),
        },
    )
    return _with_default(members, "dim_medecin", validity(settings, active=False))


def dim_gravite(visits: DataFrame) -> DataFrame:
    """Default level and the distinct urgency levels in ascending order."""
    level = truncate_int(F.col("Niveau_Urgence"))
    levels = visits.where("Niveau_Urgence IS NOT NULL").select(level.alias("niveau_urgence")).distinct()
    members = _project(
        dense_key(levels, ["niveau_urgence"], "gravite_sk", AFTER_DEFAULT),
        {
            "gravite_sk": _key("gravite_sk"),
            "code_gravite": prefixed_code("G", _rank("gravite_sk", AFTER_DEFAULT), 2),
            "niveau_urgence": F.col("niveau_urgence"),
            "categorie": severity_class(F.col("niveau_urgence")),
        },
    )
    return _with_default(members, "dim_gravite")


def _vocabulary(
    source: DataFrame, column: str, key: str, code: tuple[str, str, int], label: str, constants: dict[str, Column],
    start: int = 1,
) -> DataFrame:
    """Distinct known values of one column as (key, code, label, constants)."""
    code_name, prefix, width = code
    return _project(
        _members(source, [column], [column], key, start),
        {
            key: _key(key),
            code_name: prefixed_code(prefix, _rank(key, start), width),
            label: F.col(column),
            **constants,
        },
    )


def dim_transport(visits: DataFrame) -> DataFrame:
    return _vocabulary(visits, "Mode_Transport", "transport_sk", ("code_transport", "T", 2), "mode_transport",
                       {"est_reference": F.lit(False)})


def dim_motif(visits: DataFrame) -> DataFrame:
    return _vocabulary(visits, "Motif_Consultation", "motif_sk", ("code_motif", "M", 3), "libelle_motif",
                       {"categorie_motif": F.lit("Urgence")})


def dim_decision(visits: DataFrame) -> DataFrame:
    members = _vocabulary(visits, "Decision_Medicale", "decision_sk", ("code_decision", "D", 3), "type_decision",
                          {"service_destination": F.lit("Non précisé")}, AFTER_DEFAULT)
    return _with_default(members, "dim_decision")


def dim_issue(stays: DataFrame) -> DataFrame:
    members = _vocabulary(stays, "Issue_Sortie", "issue_sk", ("code_issue", "IS", 3), "type_issue",
                          {"categorie_issue": F.lit("Sortie")}, AFTER_DEFAULT)
    return _with_default(members, "dim_issue")


def dim_lit(stays: DataFrame, service: DataFrame, settings: LoadSettings = LoadSettings(),
            strip_service: bool = True) -> DataFrame:
    """Distinct beds with the key of their service (``strip_service=False``: names compared untrimmed)."""
    columns = ["Numero_Lit", "Type_Chambre", "Service_Affectation"]
    name = strip(F.col("nom_service")) if strip_service else F.col("nom_service")
    beds = resolve(
        _members(stays, columns, ["Numero_Lit"], "lit_sk"),
        service, "service_sk", [F.lower("Service_Affectation")], [F.lower(name)],
    )
    return _project(
        beds,
        {
            "lit_sk": _key("lit_sk"),
            "numero_lit": F.col("Numero_Lit"),
            "numero_chambre": prefixed_code("CH-", F.col("lit_sk"), 3),
            "type_chambre": F.coalesce("Type_Chambre", F.lit("Standard")),
            "service_sk": F.col("service_sk"),
            **validity(settings, version=False),
        },
    )


def dim_admission(stays: DataFrame) -> DataFrame:
    """Distinct admission type and origin, both known."""
    columns = ["Type_Admission", "Origine_Admission"]
    return _project(
        _members(stays, columns, columns, "admission_sk"),
        {
            "admission_sk": _key("admission_sk"),
            "code_admission": prefixed_code("ADM-", F.col("admission_sk"), 3),
            "type_admission": F.col("Type_Admission"),
            "origine_admission": F.col("Origine_Admission"),
        },
    )


def dim_accouchement(births: DataFrame) -> DataFrame:
    return _vocabulary(births, "Type_Accouchement", "accouchement_sk", ("code_accouchement", "AC", 2),
                       "type_accouchement", {"duree_travail": F.lit(0.0)})


def dim_grossesse(births: DataFrame, settings: LoadSettings = LoadSettings()) -> DataFrame:
    """Distinct pregnancy profiles, coded by the row that first shows them."""
    columns = ["Age_Gestationnel", "Nb_Grossesses", "Antecedents_Obstetricaux"]
    return _project(
        _members(births, columns, columns, "grossesse_sk"),
        {
            "grossesse_sk": _key("grossesse_sk"),
            "code_grossesse": prefixed_code("G-", F.col(POSITION), 3),
            "age_gestationnel": truncate_int(F.col("Age_Gestationnel")),
            "nb_grossesses": truncate_int(F.col("Nb_Grossesses")),
            "antecedents_obstetricaux": F.col("Antecedents_Obstetricaux"),
            **validity(settings),
        },
    )


def dim_nouveaune(births: DataFrame, settings: LoadSettings = LoadSettings()) -> DataFrame:
    """Distinct newborn profiles, coded by the row that first shows them."""
    columns = ["Poids_Nouveau_Ne", "Taille_Naissance", "Score_Apgar", "Statut_Bebe"]
    return _project(
        _members(births, columns, columns, "bebe_sk"),
        {
            "bebe_sk": _key("bebe_sk"),
            "code_bebe": prefixed_code("B-", F.col(POSITION), 3),
            "sexe_bebe": seeded_choice(("M", "F"), *[F.col(c) for c in columns], seed=settings.seed),
            "poids_naissance": F.col("Poids_Nouveau_Ne"),
            "taille_naissance": F.col("Taille_Naissance"),
            "score_apgar": truncate_int(F.col("Score_Apgar")),
            "statut_bebe": F.col("Statut_Bebe"),
            **validity(settings),
        },
    )


def dim_complication(births: DataFrame) -> DataFrame:
    return _vocabulary(births, "Complication_Type", "complication_sk", ("code_complication", "C", 2),
                       "type_complication", {"niveau_gravite": F.lit("Modérée")})


def dimension_builders(sources: Sources, settings: LoadSettings) -> dict[str, Callable[[], DataFrame]]:
    """Builders of all dimensions the sources allow; an absent optional column leaves its dimension out.

    Beds are apart (``dim_lit``): they need the service dimension.
    """
    patients, visits = sources["patient"], sources["urgence"]
    consultations, stays, births = sources["consultation"], sources["hospitalisation"], sources["maternite"]
    spark = patients.sparkSession
    builders = {
        "dim_temps": lambda: dim_temps(spark, settings),
        "dim_patient": lambda: dim_patient(patients, settings),
        "dim_geographie": lambda: dim_geographie(patients, settings),
        "dim_service": lambda: dim_service(stays, settings),
        "dim_pathologie": lambda: dim_pathologie(consultations, stays, settings),
        "dim_medecin": lambda: dim_medecin(consultations, settings),
        "dim_grossesse": lambda: dim_grossesse(births, settings),
        "dim_nouveaune": lambda: dim_nouveaune(births, settings),
    }
    optional = {
        "dim_gravite": (visits, "Niveau_Urgence", dim_gravite),
        "dim_transport": (visits, "Mode_Transport", dim_transport),
        "dim_motif": (visits, "Motif_Consultation", dim_motif),
        "dim_decision": (visits, "Decision_Medicale", dim_decision),
        "dim_issue": (stays, "Issue_Sortie", dim_issue),
        "dim_admission": (stays, "Type_Admission", dim_admission),
        "dim_accouchement": (births, "Type_Accouchement", dim_accouchement),
        "dim_complication": (births, "Complication_Type", dim_complication),
    }
    for table, (source, column, build) in optional.items():
        if column in source.columns:
            builders[table] = lambda source=source, build=build: build(source)
        elif table in DEFAULT_MEMBERS:
            builders[table] = lambda table=table: default_member(spark, table)
    return builders


def build_dimensions(
    sources: Sources,
    settings: LoadSettings = LoadSettings(),
    tables: Sequence[str] | None = None,
    store: Callable[[DataFrame, str], DataFrame] = materialise,
    strip_service: bool = True,
) -> dict[str, DataFrame]:
    """The dimensions, each written once by ``store`` and read back.
    """
    builders = dimension_builders(sources, settings)
    wanted = [t for t in builders if tables is None or t in tables]
    stays = sources["hospitalisation"]
    beds = (tables is None or "dim_lit" in tables) and "Numero_Lit" in stays.columns
    if beds and "dim_service" not in wanted:
        wanted.append("dim_service")
    built = together(lambda table: store(builders[table](), table), wanted)
    if beds:
        built["dim_lit"] = store(dim_lit(stays, built["dim_service"], settings, strip_service), "dim_lit")
    return built
