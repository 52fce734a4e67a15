"""Registered queries: each runs one operator or composite plan over the whole driver tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import caremart.functions as fn
from caremart.operators import keys, lookup, quality, series, versions
from caremart.plans import checks, dims, facts, forecast, load, marts, standardise
from caremart.plans.settings import LoadSettings
from caremart.registry import fixtures as fx
from caremart.registry import oracle as sql
from caremart.registry.fixtures import Fixtures
from caremart.session import materialise, scratch_dir
from caremart.sources import delimited, snapshots, tables

SETTINGS = LoadSettings(run_date=dt.date(2024, 6, 30))


@dataclass(frozen=True)
class Registered:
    run: Callable[[Fixtures], DataFrame]
    oracle: str | None


REGISTRY: dict[str, Registered] = {}


def register(oracle: str | None = None) -> Callable[[Callable[[Fixtures], DataFrame]], Callable[[Fixtures], DataFrame]]:
    def add(run: Callable[[Fixtures], DataFrame]) -> Callable[[Fixtures], DataFrame]:
        REGISTRY[run.__name__] = Registered(run, (oracle if oracle.startswith("WITH") else sql.query(oracle)) if oracle else None)
        return run

    return add


# ---- column functions ------------------------------------------------------------------------

@register(f"SELECT src_row, {sql.pseudonym('ID_Patient')} AS pseudonym FROM raw_patient")
def pseudonymise(f: Fixtures) -> DataFrame:
    return f.source("patient").select("src_row", fn.pseudonymise(F.col("ID_Patient")).alias("pseudonym"))


@register(f"SELECT src_row, {sql.number_in('Poids')} AS poids, {sql.number_in('Taille')} AS taille FROM raw_patient")
def extract_number(f: Fixtures) -> DataFrame:
    return f.source("patient").select(
        "src_row", fn.extract_number(F.col("Poids")).alias("poids"), fn.extract_number(F.col("Taille")).alias("taille")
    )


@register("SELECT src_row, try_cast(Niveau_Urgence AS DOUBLE) AS level, "
          "coalesce(CAST(trunc(try_cast(Temps_Attente_Tri AS DOUBLE)) AS INTEGER), 0) AS wait FROM raw_urgence")
def coerce_numbers(f: Fixtures) -> DataFrame:
    return f.source("urgence").select(
        "src_row",
        fn.to_number(F.col("Niveau_Urgence")).alias("level"),
        fn.truncate_int(fn.to_number(F.col("Temps_Attente_Tri")), 0).alias("wait"),
    )


@register(f"SELECT src_row, {sql.lenient('Date_Arrivee')} AS parsed FROM raw_urgence")
def parse_dates_lenient(f: Fixtures) -> DataFrame:
    return f.source("urgence").select("src_row", fn.parse_date(F.col("Date_Arrivee")).alias("parsed"))


@register(f"SELECT src_row, {sql.lenient_or('Date_Accouchement')} AS parsed FROM raw_maternite")
def parse_dates_with_default(f: Fixtures) -> DataFrame:
    return f.source("maternite").select("src_row", fn.parse_date_or(F.col("Date_Accouchement")).alias("parsed"))


@register(f"SELECT src_row, {sql.strict('Date_Arrivee')} AS parsed FROM raw_urgence")
def parse_dates_strict(f: Fixtures) -> DataFrame:
    return f.source("urgence").select("src_row", fn.parse_date_strict(F.col("Date_Arrivee")).alias("parsed"))


@register(f"SELECT src_row, {sql.band('try_cast(Age AS DOUBLE)')} AS band FROM raw_patient")
def age_band(f: Fixtures) -> DataFrame:
    aged = f.source("patient").select("src_row", fn.to_number(F.col("Age")).alias("age"))
    return aged.select("src_row", fn.age_band(F.col("age")).alias("band"))


@register(f"SELECT src_row, {sql.strip(sql.title('Nom_Complet'))} AS name FROM raw_patient")
def title_case(f: Fixtures) -> DataFrame:
    return f.source("patient").select("src_row", fn.strip(fn.title_case(F.col("Nom_Complet"))).alias("name"))


@register("SELECT o_orderkey, printf('SRV%03d', o_orderkey) AS code FROM orders")
def prefixed_code(f: Fixtures) -> DataFrame:
    return f.table("orders").select("o_orderkey", fn.prefixed_code("SRV", F.col("o_orderkey"), 3).alias("code"))


@register("SELECT src_row, CASE WHEN w < 10000 THEN w ELSE CAST(0 AS DOUBLE) END AS weight FROM "
          "(SELECT src_row, try_cast(Poids_Nouveau_Ne AS DOUBLE) AS w FROM raw_maternite)")
def outlier_clamp(f: Fixtures) -> DataFrame:
    weight = fn.to_number(F.col("Poids_Nouveau_Ne"))
    return f.source("maternite").select("src_row", fn.clamp_weight(weight).alias("weight"))


@register("SELECT src_row, CASE WHEN lower(Type_Accouchement) = 'césarienne' THEN 1 ELSE 0 END AS caesarean, "
          "CASE WHEN lower(Complication_Type) = 'aucune' THEN 0 ELSE 1 END AS complication FROM raw_maternite")
def null_safe_flags(f: Fixtures) -> DataFrame:
    return f.source("maternite").select(
        "src_row",
        fn.caesarean_flag(F.col("Type_Accouchement")).alias("caesarean"),
        fn.complication_flag(F.col("Complication_Type")).alias("complication"),
    )


@register("SELECT l_orderkey, l_linenumber, l_suppkey, "
          "round(l_extendedprice / nullif(l_suppkey % 5, 0), 4) AS ratio FROM lineitem")
def guarded_division(f: Fixtures) -> DataFrame:
    ratio = fn.guarded_ratio(F.col("l_extendedprice"), F.col("l_suppkey") % 5)
    return f.table("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", F.round(ratio, 4).alias("ratio"))


@register("""
    SELECT o_orderkey, CAST(d AS DATE) AS d, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS day_key,
      CAST(day(d) AS INTEGER) AS jour, CAST(quarter(d) AS INTEGER) AS trimestre, CAST(week(d) AS INTEGER) AS semaine,
      dayname(d) AS jour_semaine, CASE WHEN isodow(d) >= 6 THEN 'Weekend' ELSE 'Ouvrable' END AS type_jour
    FROM (SELECT o_orderkey, o_orderdate AS d FROM orders)""")
def date_parts(f: Fixtures) -> DataFrame:
    day = F.to_date("o_orderdate")
    return f.table("orders").select(
        "o_orderkey",
        day.alias("d"),
        fn.date_key(day).alias("day_key"),
        F.dayofmonth(day).alias("jour"),
        F.quarter(day).alias("trimestre"),
        F.weekofyear(day).alias("semaine"),
        F.date_format(day, "EEEE").alias("jour_semaine"),
        F.when(F.weekday(day) >= 5, "Weekend").otherwise("Ouvrable").alias("type_jour"),
    )


# ---- standardised sources --------------------------------------------------------------------

@register("SELECT * FROM std_patient")
def patients_standardised(f: Fixtures) -> DataFrame:
    typed = standardise.standardise_patients(f.source("patient"))
    return typed.select(
        "src_row", "ID_Patient", "ID_Patient_Anonyme", "Nom_Complet", "Sexe", "Age", "Tranche_Age", "Poids", "Taille",
        "Statut_Nutritionnel", "Antecedents_Medicaux", "Commune", "Quartier",
    )


def _events(f: Fixtures, name: str, mode: str = standardise.LENIENT) -> DataFrame:
    """A standardised event source. Visits are written with their parsed date, so that the filter on it does not parse again."""
    parsed = standardise.parsed_events(f.source(name), name, mode)
    return standardise.standardised(materialise(parsed, f"parsed-{name}") if name == "urgence" else parsed, name, mode)


def _events_with_pseudonym(f: Fixtures, name: str, mode: str = standardise.LENIENT) -> DataFrame:
    return _events(f, name, mode).withColumnRenamed("ID_Patient_Anonyme", "pseudonym")


@register("SELECT * FROM std_urgence")
def visits_standardised(f: Fixtures) -> DataFrame:
    return _events_with_pseudonym(f, "urgence")


@register("SELECT * FROM std_consultation")
def consultations_standardised(f: Fixtures) -> DataFrame:
    return _events_with_pseudonym(f, "consultation")


@register("SELECT * FROM std_hospitalisation")
def stays_standardised(f: Fixtures) -> DataFrame:
    return _events_with_pseudonym(f, "hospitalisation")


@register("SELECT * FROM std_maternite")
def births_standardised(f: Fixtures) -> DataFrame:
    return _events_with_pseudonym(f, "maternite")


@register(f"SELECT 'urgence' AS source, src_row, ID_Patient, Date_Arrivee AS date_text FROM raw_urgence "
          f"WHERE {sql.strip('Date_Arrivee')} <> '' AND {sql.lenient('Date_Arrivee')} IS NULL")
def date_rejects(f: Fixtures) -> DataFrame:
    return standardise.date_rejects(f.source("urgence"), "urgence")


# ---- keys and members ------------------------------------------------------------------------

@register("SELECT Motif_Consultation, min(src_row) AS src_row FROM raw_urgence GROUP BY 1")
def distinct_first_seen(f: Fixtures) -> DataFrame:
    return keys.first_seen(f.source("urgence"), ["Motif_Consultation"])


@register("SELECT ID_Patient_Anonyme, Sexe, Age, src_row FROM (SELECT *, row_number() OVER "
          "(PARTITION BY ID_Patient_Anonyme ORDER BY src_row) AS nth FROM std_patient) WHERE nth = 1")
def dedupe_keep_first(f: Fixtures) -> DataFrame:
    typed = standardise.standardise_patients(f.source("patient"))
    return keys.keep_first(typed.select("ID_Patient_Anonyme", "Sexe", "Age", "src_row"), "ID_Patient_Anonyme")


@register("SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS sk, o_orderkey, o_orderdate FROM orders")
def dense_surrogate_key(f: Fixtures) -> DataFrame:
    orders = f.table("orders").select("o_orderkey", "o_orderdate")
    return keys.dense_key(orders, ["o_orderdate", "o_orderkey"], "sk")


@register("SELECT libelle, CAST(place[1] AS INTEGER) AS origin, place[2] AS src_row FROM vocabulary")
def union_distinct_vocab(f: Fixtures) -> DataFrame:
    vocabulary = dims.pathology_vocabulary(f.source("consultation"), f.source("hospitalisation"))
    return vocabulary.select("libelle", "place.*")


@register("SELECT gravite_sk, niveau_urgence FROM dim_gravite WHERE gravite_sk > 1")
def sorted_levels(f: Fixtures) -> DataFrame:
    return dims.dim_gravite(_events(f, "urgence")).where("gravite_sk > 1").select("gravite_sk", "niveau_urgence")


@register("SELECT service_sk AS sk, nom_service AS label FROM dim_service WHERE service_sk = 1 UNION ALL "
          "SELECT pathologie_sk, libelle FROM dim_pathologie WHERE pathologie_sk = 1 UNION ALL "
          "SELECT medecin_sk, code_medecin FROM dim_medecin WHERE medecin_sk = 1 UNION ALL "
          "SELECT decision_sk, type_decision FROM dim_decision WHERE decision_sk = 1 UNION ALL "
          "SELECT issue_sk, type_issue FROM dim_issue WHERE issue_sk = 1 UNION ALL "
          "SELECT gravite_sk, categorie FROM dim_gravite WHERE gravite_sk = 1")
def default_members(f: Fixtures) -> DataFrame:
    labels = {
        "dim_service": ("service_sk", "nom_service"),
        "dim_pathologie": ("pathologie_sk", "libelle"),
        "dim_medecin": ("medecin_sk", "code_medecin"),
        "dim_decision": ("decision_sk", "type_decision"),
        "dim_issue": ("issue_sk", "type_issue"),
        "dim_gravite": ("gravite_sk", "categorie"),
    }
    typed = f.sources()
    typed["urgence"] = materialise(_events(f, "urgence"), "typed-urgence")
    members = dims.build_dimensions(typed, SETTINGS, tuple(labels))
    parts = [members[table].select(*columns) for table, columns in labels.items()]
    first, *rest = [p.toDF("sk", "label").where("sk = 1") for p in parts]
    for part in rest:
        first = first.union(part)
    return first


# ---- dimensions ------------------------------------------------------------------------------

@register("""
    SELECT temps_sk, date_complete, CAST(day(date_complete) AS INTEGER) AS jour,
      CAST(month(date_complete) AS INTEGER) AS mois, CAST(quarter(date_complete) AS INTEGER) AS trimestre,
      CAST(year(date_complete) AS INTEGER) AS annee, CAST(week(date_complete) AS INTEGER) AS semaine,
      dayname(date_complete) AS jour_semaine,
      CASE WHEN isodow(date_complete) >= 6 THEN 'Weekend' ELSE 'Ouvrable' END AS type_jour, 0 AS heure,
      'Matin' AS periode_journee, CAST(coalesce(n, 0) AS BIGINT) AS n_visits
    FROM calendar LEFT JOIN (SELECT CAST(Date_Arrivee AS DATE) AS d, count(*) AS n FROM std_urgence GROUP BY 1)
      ON d = date_complete""")
def calendar_dim(f: Fixtures) -> DataFrame:
    """All calendar days with the number of visits on each, which may be none."""
    visits = _events(f, "urgence").groupBy(F.to_date("Date_Arrivee").alias("date_complete")).agg(
        F.count(F.lit(1)).alias("n_visits")
    )
    days = dims.dim_temps(f.spark, SETTINGS).join(visits, "date_complete", "left")
    return days.fillna(0, ["n_visits"])


@register("SELECT * FROM dim_patient")
def dim_patient(f: Fixtures) -> DataFrame:
    return dims.dim_patient(standardise.standardise_patients(f.source("patient")), SETTINGS)


@register("SELECT * FROM dim_geographie")
def dim_geographie(f: Fixtures) -> DataFrame:
    return dims.dim_geographie(f.source("patient"), SETTINGS)


@register("SELECT * FROM dim_service")
def dim_service(f: Fixtures) -> DataFrame:
    return dims.dim_service(f.source("hospitalisation"), SETTINGS)


@register("SELECT * FROM dim_pathologie")
def dim_pathologie(f: Fixtures) -> DataFrame:
    return dims.dim_pathologie(f.source("consultation"), f.source("hospitalisation"), SETTINGS)


@register("SELECT * FROM dim_medecin")
def dim_medecin(f: Fixtures) -> DataFrame:
    return dims.dim_medecin(_events(f, "consultation"), SETTINGS)


@register("SELECT * FROM dim_gravite")
def dim_gravite(f: Fixtures) -> DataFrame:
    return dims.dim_gravite(_events(f, "urgence"))


@register("SELECT * FROM dim_transport")
def dim_transport(f: Fixtures) -> DataFrame:
    return dims.dim_transport(_events(f, "urgence"))


@register("SELECT * FROM dim_motif")
def dim_motif(f: Fixtures) -> DataFrame:
    return dims.dim_motif(_events(f, "urgence"))


@register("SELECT * FROM dim_decision")
def dim_decision(f: Fixtures) -> DataFrame:
    return dims.dim_decision(_events(f, "urgence"))


@register("SELECT * FROM dim_issue")
def dim_issue(f: Fixtures) -> DataFrame:
    return dims.dim_issue(f.source("hospitalisation"))


@register("SELECT * FROM dim_lit")
def snowflake_lookup(f: Fixtures) -> DataFrame:
    """Beds with the key of their service."""
    stays = f.source("hospitalisation")
    return dims.dim_lit(stays, dims.dim_service(stays, SETTINGS), SETTINGS)


@register(sql.query("SELECT * FROM dim_lit", sql.CTES | {
    "by_service": "SELECT lower(nom_service) AS name, max(service_sk) AS sk FROM dim_service GROUP BY 1"}))
def snowflake_lookup_untrimmed(f: Fixtures) -> DataFrame:
    """Beds with the key of their service, names compared as they are written."""
    stays = f.source("hospitalisation")
    return dims.dim_lit(stays, dims.dim_service(stays, SETTINGS), SETTINGS, strip_service=False)


@register("SELECT * FROM dim_admission")
def dim_admission(f: Fixtures) -> DataFrame:
    return dims.dim_admission(f.source("hospitalisation"))


@register("SELECT * FROM dim_accouchement")
def dim_accouchement(f: Fixtures) -> DataFrame:
    return dims.dim_accouchement(f.source("maternite"))


@register("SELECT * FROM dim_grossesse")
def dim_grossesse(f: Fixtures) -> DataFrame:
    return dims.dim_grossesse(_events(f, "maternite"), SETTINGS)


@register("SELECT * FROM dim_nouveaune")
def dim_nouveaune(f: Fixtures) -> DataFrame:
    return dims.dim_nouveaune(_events(f, "maternite"), SETTINGS)


@register("SELECT * FROM dim_complication")
def dim_complication(f: Fixtures) -> DataFrame:
    return dims.dim_complication(f.source("maternite"))


@register(f"SELECT c_custkey, {sql.seeded_distance('c_name')} AS distance, {sql.seeded_capacity('c_name', 'c_nationkey')} AS capacity, "
          f"{sql.seeded_sex('c_name', 'c_acctbal')} AS sex FROM customer")
def seeded_attributes(f: Fixtures) -> DataFrame:
    """Distance, capacity and sex from one, two and a numeric key."""
    name = F.col("c_name")
    return f.table("customer").select(
        "c_custkey",
        fn.seeded_uniform(1, 20, name).alias("distance"),
        fn.seeded_integer(10, 60, name, F.col("c_nationkey")).alias("capacity"),
        fn.seeded_choice(("M", "F"), name, F.col("c_acctbal")).alias("sex"),
    )


# ---- lookups ---------------------------------------------------------------------------------

_ORDER_PATIENT = "SELECT v.src_row, coalesce(p.sk, 1) AS patient_sk FROM std_urgence v " \
                 "LEFT JOIN by_patient p ON upper(v.pseudonym) = p.name"


def _patient_keys(f: Fixtures, small: bool | None) -> DataFrame:
    parsed = standardise.parsed_events(f.source("urgence"), "urgence").select("src_row", "ID_Patient_Anonyme", "Date_Arrivee")
    visits = materialise(parsed, "visits").where("Date_Arrivee IS NOT NULL").drop("Date_Arrivee")
    members = materialise(dims.dim_patient(standardise.standardise_patients(f.source("patient")), SETTINGS), "dim_patient")
    return lookup.resolve(
        visits, members, "patient_sk", [F.upper("ID_Patient_Anonyme")], [F.upper("id_patient_anonyme")], small=small
    ).select("src_row", "patient_sk")


@register(_ORDER_PATIENT)
def lookup_join_default(f: Fixtures) -> DataFrame:
    """Patient keys of visits; missing and unknown patients get the default key."""
    return _patient_keys(f, small=None)


@register(_ORDER_PATIENT)
def lookup_join_salted(f: Fixtures) -> DataFrame:
    """The same keys by the shuffle join that spreads hot and missing keys."""
    return _patient_keys(f, small=False)


@register("""
    SELECT o_orderkey, coalesce(sk, 1) AS segment_sk
    FROM (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'Building' WHEN 1 THEN 'MACHINERY'
            WHEN 2 THEN 'household ' ELSE 'unknown' END AS segment FROM orders)
    LEFT JOIN (SELECT lower(c_mktsegment) AS name, CAST(max(c_custkey) AS INTEGER) AS sk FROM customer GROUP BY 1)
      ON lower(segment) = name""")
def lookup_last_wins(f: Fixtures) -> DataFrame:
    """Many members share a normalised key: the highest surrogate wins and no row is multiplied."""
    members = f.table("customer").select("c_custkey", F.concat(F.lit(" "), "c_mktsegment").alias("segment"))
    segment = F.element_at(
        F.array(*[F.lit(s) for s in ("Building", "MACHINERY", "household ", "unknown")]),
        (F.col("o_orderkey") % 4 + 1).cast("int"),
    )
    rows = f.table("orders").select("o_orderkey", segment.alias("segment"))
    found = lookup.resolve(
        rows, members, "c_custkey", [F.lower("segment")], [F.lower(fn.strip(F.col("segment")))], alias="segment_sk"
    )
    return found.select("o_orderkey", "segment_sk")


@register("SELECT src_row, coalesce(b.sk, 1) AS bebe_sk FROM std_maternite v LEFT JOIN by_bebe b "
          "ON v.Poids_Nouveau_Ne = b.p AND v.Taille_Naissance = b.t AND v.Score_Apgar = b.a")
def lookup_composite_key(f: Fixtures) -> DataFrame:
    """Newborn by weight, length and score as numbers."""
    births = _events(f, "maternite")
    newborn = ["Poids_Nouveau_Ne", "Taille_Naissance", "Score_Apgar"]
    member = ["poids_naissance", "taille_naissance", "score_apgar"]
    found = lookup.resolve(
        births.select("src_row", *newborn),
        dims.dim_nouveaune(births, SETTINGS),
        "bebe_sk",
        [F.col(c) for c in newborn],
        [F.col(c).cast("double") for c in member],
    )
    return found.select("src_row", "bebe_sk")


# ---- facts -----------------------------------------------------------------------------------

_BUILD = {
    "urgence": ("faits_accueil", facts.fact_visits),
    "consultation": ("faits_consultation", facts.fact_consultations),
    "hospitalisation": ("faits_hospitalisation", facts.fact_stays),
    "maternite": ("faits_maternite", facts.fact_births),
}


def _fact(f: Fixtures, name: str, **options) -> DataFrame:
    """One fact table with the dimensions it needs, each written once."""
    chosen = facts.FactOptions(settings=SETTINGS, **options)
    # Parsed once; the other event sources only give untouched text columns to the dimensions. Nothing reads the identifier behind a pseudonym.
    typed = f.sources()
    typed["patient"] = standardise.standardise_patients(typed["patient"])
    events = standardise.standardise_events(typed[name], name, chosen.mode).drop(standardise.PATIENT_ID)
    typed[name] = materialise(events, f"typed-{name}")
    table, build = _BUILD[name]
    members = dims.build_dimensions(typed, SETTINGS, facts.FACT_DIMENSIONS[table])
    return build(typed[name], members, chosen)


@register("SELECT * FROM fact_visits")
def fact_visits_lenient(f: Fixtures) -> DataFrame:
    return _fact(f, "urgence")


@register("SELECT * FROM fact_consultations")
def fact_consultations(f: Fixtures) -> DataFrame:
    return _fact(f, "consultation")


@register("SELECT * FROM fact_stays")
def fact_stays(f: Fixtures) -> DataFrame:
    return _fact(f, "hospitalisation")


@register("SELECT * FROM fact_births")
def fact_births_flags(f: Fixtures) -> DataFrame:
    return _fact(f, "maternite")


@register(sql._visits("std_urgence", "LEFT", unknown=-1, stripped=True))
def fact_visits_unknown_member(f: Fixtures) -> DataFrame:
    """Both sides trimmed, and -1 for unresolved keys."""
    return _fact(f, "urgence", unknown_key=-1, strip_rows=True)


_STRICT = {
    "fact_visits_strict": ("urgence", sql._visits("std_urgence", "")),
    "fact_consultations_strict": (
        "consultation",
        f"SELECT *, row_number() OVER (ORDER BY id_fait) AS id_consultation FROM ({sql._consultations('std_consultation', '')})",
    ),
    "fact_stays_strict": ("hospitalisation", sql._stays("std_hospitalisation", "", beds=False)),
    "fact_births_strict": (
        "maternite",
        f"SELECT *, row_number() OVER (ORDER BY id_fait) AS id_accouchement FROM ({sql._births('std_maternite', '', clamp=False)})",
    ),
}
for _name, (_source, _final) in _STRICT.items():
    # Strict facts: the dimensions are built from strictly parsed sources.
    REGISTRY[_name] = Registered(lambda f, source=_source: _fact(f, source, mode=standardise.STRICT), sql.strict_query(_final))


# ---- data quality ----------------------------------------------------------------------------

@register("SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def dq_unique(f: Fixtures) -> DataFrame:
    return quality.duplicates(f.table("lineitem"), ["l_orderkey", "l_linenumber"])


@register("SELECT src_row, 'ID_Patient not null' AS rule FROM raw_urgence WHERE ID_Patient IS NULL UNION ALL "
          "SELECT src_row, 'Motif_Consultation not null' FROM raw_urgence WHERE Motif_Consultation IS NULL")
def dq_not_null(f: Fixtures) -> DataFrame:
    rules = quality.not_null_rules(["ID_Patient", "Motif_Consultation"])
    return quality.violations(f.source("urgence"), rules).select("src_row", "rule")


@register("SELECT src_row, 'sexe in (M, F)' AS rule FROM std_patient WHERE coalesce(Sexe, 'Inconnu') NOT IN ('M', 'F')")
def dq_check(f: Fixtures) -> DataFrame:
    patients = standardise.standardise_patients(f.source("patient"))
    filled = patients.select("src_row", F.coalesce("Sexe", F.lit("Inconnu")).alias("sexe"))
    return quality.violations(filled, checks.value_rules("dim_patient")).select("src_row", "rule")


@register("SELECT l_partkey % 2500 AS value, count(*) AS n_rows FROM lineitem "
          "WHERE l_partkey % 2500 NOT IN (SELECT c_custkey FROM customer) GROUP BY 1")
def dq_foreign_key(f: Fixtures) -> DataFrame:
    child = f.table("lineitem").select((F.col("l_partkey") % 2500).alias("patient"))
    return quality.orphans(child, "patient", f.table("customer"), "c_custkey")


@register("SELECT src_row, 'Medecin length <= 40' AS rule FROM raw_consultation WHERE length(Medecin) > 40 UNION ALL "
          "SELECT src_row, 'Pathologie length <= 7' FROM raw_consultation WHERE length(Pathologie) > 7")
def dq_length(f: Fixtures) -> DataFrame:
    rules = quality.length_rules({"Medecin": 40, "Pathologie": 7})
    return quality.violations(f.source("consultation"), rules).select("src_row", "rule")


@register("SELECT src_row, coalesce(Medecin, 'Inconnu') AS Medecin, true AS est_actif, 1 AS version_ligne "
          "FROM raw_consultation")
def dq_defaults(f: Fixtures) -> DataFrame:
    rows = f.source("consultation").select("src_row", "Medecin")
    return quality.fill_declared_defaults(rows, {"Medecin": "Inconnu", **checks.DEFAULTS["dim_patient"]})


_FACT_STEPS = {"faits_accueil": "fact_visits", "faits_consultation": "fact_consultations", "faits_hospitalisation": "fact_stays",
               "faits_maternite": "fact_births"}
_VALUE_RULES = {"dim_patient": ("sexe in (M, F)", "sexe NOT IN ('M', 'F')"),
                "dim_gravite": ("niveau_urgence between 1 and 5", "niveau_urgence NOT BETWEEN 1 AND 5"),
                "dim_nouveaune": ("sexe_bebe in (M, F)", "sexe_bebe NOT IN ('M', 'F')")}


def _quality_oracle() -> str:
    parts = []
    for table in tables.WAREHOUSE_TABLES:
        step = _FACT_STEPS.get(table, table)
        broken = [(f"{c} not null", f"{c} IS NULL") for c in checks.NOT_NULL[table]]
        broken += [(f"{c} length <= {n}", f"length({c}) > {n}") for c, n in checks.WIDTHS.get(table, {}).items()]
        broken += [_VALUE_RULES[table]] if table in _VALUE_RULES else []
        rules = ", ".join(f"{{'rule': '{rule}', 'violations': count(*) FILTER ({condition})}}" for rule, condition in broken)
        parts.append(f"SELECT '{table}' AS table_name, unnest([{rules}], recursive := true) FROM {step}")
        unique = [checks.PRIMARY_KEYS[table], *([checks.UNIQUE_COLUMNS[table]] if table in checks.UNIQUE_COLUMNS else [])]
        parts += [f"SELECT '{table}', '{c} unique', CAST(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM {step} "
                  f"WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)" for c in unique]
        parts += [f"SELECT '{table}', '{c} in {parent}', count(*) FROM {step} "
                  f"WHERE {c} NOT IN (SELECT {checks.PRIMARY_KEYS[parent]} FROM {parent})"
                  for c, parent in checks.FOREIGN_KEYS.get(table, {}).items()]
    return sql.query(" UNION ALL ".join(parts), stored=True)


@register(_quality_oracle())
def quality_report(f: Fixtures) -> DataFrame:
    """Every declared constraint of the 21 tables of a loaded warehouse."""
    root = f"{scratch_dir(f.spark)}/caremart/warehouse-{uuid.uuid4().hex}"
    load.load_sources(f.spark, f.sources(), root, SETTINGS, run_id="2024-06-30")
    warehouse = load.Warehouse(f.spark, root)
    return checks.quality_report({t: warehouse.table(t) for t in tables.WAREHOUSE_TABLES})


# ---- daily series and forecast ---------------------------------------------------------------

def _services(f: Fixtures) -> DataFrame:
    """A table over all events, written once for the lookup and the star join."""
    return materialise(f.select(fx.SERVICES), "services")


def _history(f: Fixtures, text: str = fx.OCCUPANCY) -> DataFrame:
    """Stays of each service as facts joined to the calendar and the services."""
    services = _services(f)
    return forecast.occupancy_history(_stay_facts(f, services, text), dims.dim_temps(f.spark, SETTINGS), services)


def _stay_facts(f: Fixtures, services: DataFrame, text: str = fx.OCCUPANCY) -> DataFrame:
    stays = f.select(text)
    keyed = lookup.resolve(stays, services, "service_sk", [F.col("event_type")], [F.col("nom_service")])
    return keyed.select(
        "event_id", fn.date_key(F.col("d")).alias("temps_sk"), "service_sk", F.col("beds").alias("nb_lits_occupes")
    )


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Rounded measures. The nudge keeps exact ties from depending on the order of summation."""
    return df.withColumns({c: F.round(F.col(c) + 1e-9, digits) for c in columns})


def _series(f: Fixtures) -> DataFrame:
    services = _services(f)
    observed = forecast.observed_occupancy(_stay_facts(f, services), dims.dim_temps(f.spark, SETTINGS), services)
    return materialise(forecast.service_series(observed), "series")


@register("SELECT d AS date_complete, event_type AS nom_service, service_sk, beds AS nb_lits_occupes, capacite_lits, "
          "round(beds / capacite_lits + 1e-9, 6) AS taux_occupation FROM occupancy WHERE capacite_lits > 0")
def occupancy_history(f: Fixtures) -> DataFrame:
    return _rounded(_history(f), "taux_occupation")


@register("SELECT service_sk, d, round(rate + 1e-9, 6) AS rate, round(beds + 1e-9, 6) AS beds, capacity FROM observed")
def daily_mean(f: Fixtures) -> DataFrame:
    return _rounded(forecast.daily_occupancy(_history(f), "mean"), "rate", "beds")


@register("SELECT service_sk, d, round(sum(beds / capacite_lits) + 1e-9, 6) AS rate, "
          "round(sum(beds) + 1e-9, 6) AS beds, avg(CAST(capacite_lits AS DOUBLE)) AS capacity "
          "FROM occupancy WHERE capacite_lits > 0 GROUP BY ALL")
def daily_sum(f: Fixtures) -> DataFrame:
    services = _services(f)
    observed = forecast.observed_occupancy(_stay_facts(f, services), dims.dim_temps(f.spark, SETTINGS), services, "sum")
    return _rounded(observed, "rate", "beds")


@register("SELECT service_sk, d, CAST(i AS INTEGER) AS i, round(rate + 1e-9, 6) AS rate, "
          "round(beds + 1e-9, 6) AS beds, capacity FROM series")
def densify_ffill(f: Fixtures) -> DataFrame:
    return _rounded(series.with_index(_series(f), ["service_sk"], "d"), "rate", "beds")


@register("""
    SELECT event_type, d, round(avg(beds) + 1e-9, 6) AS beds
    FROM (SELECT event_type, max(d) OVER (PARTITION BY event_type) - min(d) OVER (PARTITION BY event_type) + 1 AS n,
            d, beds FROM short_occupancy)
    WHERE n >= 30 GROUP BY ALL""")
def min_history(f: Fixtures) -> DataFrame:
    """Observed days of the services that span the minimum history."""
    stays = f.select(fx.SHORT_OCCUPANCY)
    observed = series.daily(stays, ["event_type"], "d", beds="beds")
    long_enough = series.densify(observed, ["event_type"], "d", ["beds"], forecast.MIN_HISTORY)
    return _rounded(long_enough.join(observed.select("event_type", "d"), ["event_type", "d"]), "beds")


@register("""
    SELECT service_sk, d, round(dz + 1e-9, 6) AS dz, round(lag(dz, 1) OVER w + 1e-9, 6) AS dz_1,
      round(lag(dz, 2) OVER w + 1e-9, 6) AS dz_2, round(lag(dz, 3) OVER w + 1e-9, 6) AS dz_3,
      round(lag(dz, 4) OVER w + 1e-9, 6) AS dz_4, round(lag(dz, 5) OVER w + 1e-9, 6) AS dz_5
    FROM (SELECT service_sk, d, rate - lag(rate) OVER (PARTITION BY service_sk ORDER BY d) AS dz FROM series)
    WINDOW w AS (PARTITION BY service_sk ORDER BY d)""")
def difference_lags(f: Fixtures) -> DataFrame:
    lags = ["dz", *[f"dz_{k}" for k in range(1, 6)]]
    return _rounded(series.lagged(_series(f), ["service_sk"], "d", "rate", 5), *lags).select("service_sk", "d", *lags)


@register("SELECT service_sk, k, round(linear + 1e-9, 6) AS linear FROM linear")
def linear_forecast(f: Fixtures) -> DataFrame:
    return _rounded(forecast.linear_forecast(_series(f)), "linear")


@register("SELECT service_sk, CAST(k AS INTEGER) AS k, round(level + 1e-9, 6) AS ar FROM ar_ahead WHERE k > 0")
def ar_forecast(f: Fixtures) -> DataFrame:
    return _rounded(forecast.ar_forecast(_series(f)), "ar")


@register("SELECT service_sk, k, round(seasonal + 1e-9, 6) AS seasonal, round(seasonal - spread + 1e-9, 6) AS lower, "
          "round(seasonal + spread + 1e-9, 6) AS upper FROM wave_model")
def seasonal_forecast(f: Fixtures) -> DataFrame:
    return _rounded(forecast.seasonal_forecast(_series(f)), "seasonal", "lower", "upper")


@register("""
    SELECT d AS date_prevision, service_sk, round(rate * 100 + 1e-9, 4) AS occupation_predite,
      CAST(trunc(rate * capacity) AS INTEGER) AS nb_lits_occupes_predits, round(lower * 100 + 1e-9, 4) AS intervalle_inf,
      round(upper * 100 + 1e-9, 4) AS intervalle_sup, 'Ensemble' AS modele, k AS horizon_jours
    FROM whole_models""")
def ensemble_forecast(f: Fixtures) -> DataFrame:
    """The whole forecast: three models of every service, combined."""
    rows = forecast.forecast_rows(forecast.combined_forecast(_series(f)))
    return _rounded(rows, "occupation_predite", "intervalle_inf", "intervalle_sup", digits=4)


def _stand_ins(f: Fixtures) -> DataFrame:
    """Forecast days with model values derived from the trend, missing by rule."""
    daily_series = _series(f)
    days = forecast.horizon_frame(daily_series).join(forecast.linear_forecast(daily_series), ["service_sk", "k"])
    k, y = F.col("k"), F.col("linear")
    return days.select(
        "service_sk", "d", "k", "capacity",
        F.when(k % 4 != 0, y * 1.02).alias("ar"),
        F.when(k % 3 != 0, y * 0.97).alias("seasonal"),
        F.when(k % 12 != 0, F.when(k == 29, y + 0.9).when(k == 28, y - 2.5).otherwise(y)).alias("linear"),
        F.when(k % 3 != 0, y * 0.9).alias("lower"),
        F.when(k % 3 != 0, y * 1.1).alias("upper"),
    )


def _forecast_rows(f: Fixtures) -> DataFrame:
    return forecast.forecast_rows(forecast.combine(_stand_ins(f)))


@register("SELECT * FROM forecasts")
def ensemble_combine(f: Fixtures) -> DataFrame:
    return _rounded(_forecast_rows(f), "occupation_predite", "intervalle_inf", "intervalle_sup")


@register("SELECT service_sk, k, k % 3 = 0 AS fallback, round(lower + 1e-9, 6) AS lower, "
          "round(upper + 1e-9, 6) AS upper FROM combined")
def interval_fallback(f: Fixtures) -> DataFrame:
    """Intervals: the seasonal model's, or a fixed share of the rate where it gave none."""
    combined = forecast.combine(_stand_ins(f).withColumn("fallback", F.col("lower").isNull()))
    return _rounded(combined.select("service_sk", "k", "fallback", "lower", "upper"), "lower", "upper")


@register("SELECT service_sk, d AS date_alerte, round(rate * 100 + 1e-9, 6) AS seuil_atteint, "
          "CASE WHEN rate >= 0.85 THEN 'Critique' ELSE 'Avertissement' END AS type_alerte, 0 AS resolu "
          "FROM combined WHERE rate >= 0.75")
def alerts(f: Fixtures) -> DataFrame:
    return _rounded(forecast.alert_rows(forecast.combine(_stand_ins(f))), "seuil_atteint")


@register("SELECT service_sk, round_even(avg(occupation_predite), 2) AS occupation_predite, "
          "round_even(avg(intervalle_inf), 2) AS intervalle_inf, round_even(avg(intervalle_sup), 2) AS intervalle_sup "
          "FROM forecasts GROUP BY service_sk")
def forecast_summary(f: Fixtures) -> DataFrame:
    return forecast.summary(_forecast_rows(f))


# ---- versions and marts ----------------------------------------------------------------------

_CURRENT_MEMBERS = """
    SELECT CAST(c_custkey + 1 AS INT) AS sk, c_name AS name, c_mktsegment AS segment,
      CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_acctbal END AS balance,
      CAST('2024-01-01' AS DATE) AS date_debut_validite,
      CASE WHEN c_custkey % 6 = 0 THEN CAST('2024-03-01' AS DATE) ELSE NULL END AS date_fin_validite,
      c_custkey % 6 <> 0 AS est_actif, 1 AS version_ligne
    FROM {customer}"""
_INCOMING_MEMBERS = """
    SELECT CASE WHEN c_custkey % 11 = 0 THEN 'New ' || c_name ELSE c_name END AS name, c_mktsegment AS segment,
      CASE WHEN c_custkey % 9 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS balance
    FROM {customer}"""


@register(f"""
    WITH cur AS ({fx.in_duckdb(_CURRENT_MEMBERS)}), inc AS ({fx.in_duckdb(_INCOMING_MEMBERS)}),
    pairs AS (SELECT c.*, i.name AS new_name, i.segment AS new_segment, i.balance AS new_balance,
        c.sk IS NOT NULL AS known,
        c.sk IS NOT NULL AND i.name IS NOT NULL AND
          (c.segment IS DISTINCT FROM i.segment OR c.balance IS DISTINCT FROM i.balance) AS changed
      FROM (SELECT * FROM cur WHERE est_actif) c FULL JOIN inc i ON c.name = i.name)
    SELECT * FROM cur WHERE NOT est_actif
    UNION ALL
    SELECT sk, name, segment, balance, date_debut_validite,
      CASE WHEN changed THEN {sql.RUN_DATE} ELSE date_fin_validite END, NOT changed, version_ligne
    FROM pairs WHERE known
    UNION ALL
    SELECT CAST((SELECT max(sk) FROM cur) + row_number() OVER (ORDER BY new_name) AS INTEGER), new_name, new_segment,
      new_balance, {sql.RUN_DATE}, CAST(NULL AS DATE), true, CASE WHEN changed THEN version_ligne + 1 ELSE 1 END
    FROM pairs WHERE changed OR NOT known""")
def scd2_merge(f: Fixtures) -> DataFrame:
    return versions.merge_versions(
        f.select(_CURRENT_MEMBERS), f.select(_INCOMING_MEMBERS), "sk", "name", ["segment", "balance"],
        SETTINGS.run_date,
    )


_COMPOSITE_CURRENT = """
    SELECT CAST(c_custkey + 1 AS INT) AS sk, c_nationkey AS nation, CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_name END AS name,
      CASE WHEN c_custkey % 13 = 0 THEN CAST(c_custkey AS STRING) ELSE c_mktsegment END AS segment,
      CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_acctbal END AS balance, 'C' || CAST(c_custkey AS STRING) AS code,
      CAST('2024-01-01' AS DATE) AS date_debut_validite, CAST(NULL AS DATE) AS date_fin_validite, true AS est_actif, 1 AS version_ligne
    FROM {customer} WHERE c_custkey % 10 <> 3"""


def _composite_incoming(day: int) -> str:
    """The extract as it came first, and as it was corrected on the same day."""
    corrected = "WHEN c_custkey % 5 = 0 THEN c_acctbal + 5 " if day else ""
    return f"""
    SELECT c_nationkey AS nation, CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_name END AS name,
      CASE WHEN c_custkey % 13 = 0 THEN CAST(c_custkey AS STRING) ELSE c_mktsegment END AS segment,
      CASE WHEN c_custkey % 9 = 0 THEN NULL {corrected}WHEN c_custkey % 7 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS balance,
      'N' || CAST(c_custkey AS STRING) AS code
    FROM {{customer}} WHERE c_custkey % 10 <> 4"""


@register(f"""
    WITH cur AS ({fx.in_duckdb(_COMPOSITE_CURRENT)}), one AS ({fx.in_duckdb(_composite_incoming(0))}),
    two AS ({fx.in_duckdb(_composite_incoming(1))}),
    held AS (SELECT t.*, o.balance AS first_balance, c.sk AS old_sk, c.balance AS old_balance, c.code AS old_code,
        c.sk IS NULL AS fresh, c.sk IS NOT NULL AND c.balance IS DISTINCT FROM o.balance AS by_one
      FROM two t JOIN one o ON t.nation = o.nation AND t.segment = o.segment AND t.name IS NOT DISTINCT FROM o.name
      LEFT JOIN cur c ON t.nation = c.nation AND t.segment = c.segment AND t.name IS NOT DISTINCT FROM c.name),
    judged AS (SELECT *, NOT fresh AND NOT by_one AND old_balance IS DISTINCT FROM balance AS by_two FROM held),
    top AS (SELECT max(sk) AS top FROM cur),
    opened_one AS (SELECT *, top + row_number() OVER (ORDER BY nation NULLS FIRST, name NULLS FIRST, segment NULLS FIRST) AS sk
      FROM judged, top WHERE fresh OR by_one),
    opened_two AS (SELECT *, (SELECT max(sk) FROM opened_one)
        + row_number() OVER (ORDER BY nation NULLS FIRST, name NULLS FIRST, segment NULLS FIRST) AS sk
      FROM judged WHERE by_two)
    SELECT c.sk, c.nation, c.name, c.segment, c.balance, c.code, c.date_debut_validite,
      CASE WHEN j.old_sk IS NULL THEN c.date_fin_validite ELSE {sql.RUN_DATE} END AS date_fin_validite, j.old_sk IS NULL AS est_actif, 1 AS version_ligne
    FROM cur c LEFT JOIN (SELECT old_sk FROM judged WHERE by_one OR by_two) j ON c.sk = j.old_sk
    UNION ALL
    SELECT CAST(sk AS INTEGER), nation, name, segment, balance, CASE WHEN fresh THEN code ELSE old_code END, {sql.RUN_DATE}, CAST(NULL AS DATE), true,
      CASE WHEN fresh THEN 1 ELSE 2 END
    FROM (SELECT sk, nation, name, segment, balance, code, old_code, fresh FROM opened_one UNION ALL
          SELECT sk, nation, name, segment, balance, code, old_code, fresh FROM opened_two)""")
def scd2_merge_composite(f: Fixtures) -> DataFrame:
    """Members by three columns, one of them missing at times: an extract, its correction of the same day, and the correction once more."""
    merged = f.select(_COMPOSITE_CURRENT)
    for day in (0, 1, 1):
        merged = materialise(versions.merge_versions(
            merged, f.select(_composite_incoming(day)), "sk", ["nation", "name", "segment"], ["balance"], SETTINGS.run_date, ["code"]), "merged")
    return merged


_HISTORY = """
    SELECT CAST(c_custkey * 4 + v AS INT) AS sk, ' ' || c_name AS name, date_add(CAST('2024-01-01' AS DATE), 400 * v) AS date_debut_validite,
      CASE WHEN v < c_custkey % 4 THEN date_add(CAST('2024-01-01' AS DATE), 400 * v + 400) END AS date_fin_validite
    FROM (SELECT c_custkey, c_name, explode(sequence(0, CAST(c_custkey % 4 AS INT))) AS v FROM {customer})"""


@register("""
    SELECT o_orderkey, coalesce(sk, 1) AS member_sk
    FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 17 <> 0 THEN c_name END AS name,
            CASE WHEN o_orderkey % 19 <> 0 THEN CAST(o_orderdate AS DATE) + 10227 END AS day FROM orders JOIN customer ON o_custkey = c_custkey) e
    LEFT JOIN (SELECT CAST(c_custkey * 4 + v AS INTEGER) AS sk, c_name AS member,
            CASE WHEN v = 0 THEN DATE '0001-01-01' ELSE CAST('2024-01-01' AS DATE) + CAST(400 * v AS INTEGER) END AS since,
            CASE WHEN v < c_custkey % 4 THEN CAST('2024-01-01' AS DATE) + CAST(400 * v + 400 AS INTEGER) ELSE DATE '9999-12-31' END AS until
          FROM customer, range(0, 4) r(v) WHERE v <= c_custkey % 4) m
      ON name = member AND ((day >= since AND day < until) OR (day IS NULL AND until = DATE '9999-12-31'))""")
def fact_as_of(f: Fixtures) -> DataFrame:
    """Orders with the version of their customer that held on their day; missing days take the open version."""
    orders, customers = f.table("orders"), f.table("customer")
    events = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 17 != 0, F.col("c_name")).alias("name"),
        F.when(F.col("o_orderkey") % 19 != 0, F.date_add(F.to_date("o_orderdate"), 10227)).alias("day"),
    )
    history = materialise(f.select(_HISTORY), "history")
    found = lookup.resolve(events, history, "sk", [F.col("name")], [fn.strip(F.col("name"))], alias="member_sk", at=F.col("day"))
    return found.select("o_orderkey", "member_sk")


def _kpi(fact: str, measures: str) -> str:
    return (f"SELECT CAST(temps_sk // 10000 AS INTEGER) AS annee, CAST(temps_sk // 100 % 100 AS INTEGER) AS mois, "
            f"service_sk, {measures} FROM {fact} GROUP BY 1, 2, 3")


@register(_kpi("fact_visits", "CAST(sum(nb_arrivees) AS BIGINT) AS arrivees, "
               "CAST(sum(nb_non_pris_en_charge) AS BIGINT) AS non_pris_en_charge, "
               "round(avg(temps_attente_tri) + 1e-9, 6) AS attente_tri_moyenne, "
               "round(avg(temps_attente_orientation) + 1e-9, 6) AS attente_orientation_moyenne"))
def mart_kpis(f: Fixtures) -> DataFrame:
    kpis = marts.indicators(_fact(f, "urgence"), "faits_accueil")
    return _rounded(kpis, "attente_tri_moyenne", "attente_orientation_moyenne")


@register(_kpi("fact_consultations", "CAST(sum(nb_consultations) AS BIGINT) AS consultations, "
               "round(avg(duree_consultation) + 1e-9, 6) AS duree_moyenne, "
               "CAST(sum(nb_medicaments) AS BIGINT) AS medicaments"))
def mart_consultations(f: Fixtures) -> DataFrame:
    return _rounded(marts.indicators(_fact(f, "consultation"), "faits_consultation"), "duree_moyenne")


@register(_kpi("fact_stays", "CAST(sum(nb_hospitalisations) AS BIGINT) AS hospitalisations, "
               "round(avg(duree_sejour) + 1e-9, 6) AS duree_sejour_moyenne, CAST(sum(nb_deces) AS BIGINT) AS deces, "
               "CAST(sum(nb_sorties) AS BIGINT) AS sorties"))
def mart_stays(f: Fixtures) -> DataFrame:
    return _rounded(marts.indicators(_fact(f, "hospitalisation"), "faits_hospitalisation"), "duree_sejour_moyenne")


@register("""
    SELECT annee, mois, CAST(grouping(annee, mois) AS INTEGER) AS niveau,
      CAST(sum(nb_accouchements) AS BIGINT) AS accouchements, CAST(sum(nb_cesariennes) AS BIGINT) AS cesariennes,
      CAST(sum(nb_complications) AS BIGINT) AS complications, round(avg(poids_naissance) + 1e-9, 6) AS poids_moyen
    FROM (SELECT *, CAST(temps_sk // 10000 AS INTEGER) AS annee, CAST(temps_sk // 100 % 100 AS INTEGER) AS mois
          FROM fact_births)
    GROUP BY ROLLUP (annee, mois)""")
def mart_rollup(f: Fixtures) -> DataFrame:
    return _rounded(marts.indicator_rollup(_fact(f, "maternite"), "faits_maternite"), "poids_moyen")


# ---- sources and sinks -----------------------------------------------------------------------

def _written_text(df: DataFrame, sep: str, encoding: str, path: str | None = None) -> str:
    """The rows as delimited files in key order, several files in the scratch folder; added to ``path`` if that is given."""
    path = path or f"{scratch_dir(df.sparkSession)}/caremart/extract-{uuid.uuid4().hex}"
    ordered = df.repartitionByRange(4, "src_row").sortWithinPartitions("src_row")
    ordered.write.csv(
        path, mode="append", header=True, sep=sep, encoding=encoding, emptyValue="", nullValue="N/A", escape='"',
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    return path


_EXTRACT = ("SELECT src_row, CAST(src_row AS VARCHAR) AS row_text, Mode_Transport, Motif_Consultation, Service "
            "FROM raw_urgence")


def _extract(f: Fixtures, sep: str, encoding: str) -> DataFrame:
    columns = ["Mode_Transport", "Motif_Consultation", "Service"]
    rows = f.source("urgence").select("src_row", F.col("src_row").cast("string").alias(" row_text "), *columns)
    path = _written_text(rows, sep, encoding)
    scanned = delimited.read_delimited(f.spark, path, with_origin=True).drop("src_row")
    return delimited.stage_source(scanned, "extract")


@register(_EXTRACT)
def csv_scan_semicolon(f: Fixtures) -> DataFrame:
    """Visits written as ';' text and read back: delimiter found, header trimmed, rows numbered in file order."""
    return _extract(f, ";", "UTF-8")


@register(_EXTRACT)
def csv_scan_latin1(f: Fixtures) -> DataFrame:
    """Visits written as tab-separated Latin-1 text: the encoding is found."""
    return _extract(f, "\t", "ISO-8859-1")


@register("""SELECT src_row, CAST(src_row AS VARCHAR) AS row_text, Service,
    CASE WHEN src_row % 3 = 0 THEN Motif_Consultation || chr(10) || 'dit "urgent", ' || Service
         ELSE Motif_Consultation END AS Motif_Consultation FROM raw_urgence""")
def csv_scan_multiline(f: Fixtures) -> DataFrame:
    """Visits with line breaks, quotes and separators inside quoted fields."""
    broken = F.concat("Motif_Consultation", F.lit('\ndit "urgent", '), "Service")
    rows = f.source("urgence").select(
        "src_row", F.col("src_row").cast("string").alias("row_text"), "Service",
        F.when(F.col("src_row") % 3 == 0, broken).otherwise(F.col("Motif_Consultation")).alias("Motif_Consultation"))
    path = _written_text(rows, ",", "UTF-8")
    scanned = delimited.read_delimited(f.spark, path, with_origin=True).drop("src_row")
    return delimited.stage_source(scanned, "multiline")


@register("SELECT CAST(src_row AS VARCHAR) AS row_text, Service || ' é' AS Service FROM raw_urgence")
def csv_scan_mixed_encoding(f: Fixtures) -> DataFrame:
    """Visits in one folder, some files in UTF-8 and some in Latin-1: each file is read by its own encoding."""
    rows = f.source("urgence").select(
        "src_row", F.col("src_row").cast("string").alias("row_text"), F.concat("Service", F.lit(" é")).alias("Service"))
    path = _written_text(rows.where("src_row % 2 = 0"), ";", "UTF-8")
    _written_text(rows.where("src_row % 2 = 1"), ";", "ISO-8859-1", path)
    return delimited.read_delimited(f.spark, path).select("row_text", "Service")


@register("""SELECT CASE WHEN src_row % 5 <> 0 THEN CAST(src_row AS VARCHAR) END AS row_text,
    CASE WHEN src_row % 5 > 1 THEN Service END AS Service,
    CASE WHEN src_row % 5 = 0 THEN concat(src_row, ';', coalesce(Service, 'N/A'), ';"a;b";EXTRA') END AS ligne FROM raw_urgence""")
def csv_rejects(f: Fixtures) -> DataFrame:
    """Visits of which a fifth has a field too many and a fifth ends early: the first are rejected as text, the others are kept."""
    row, turn = F.col("src_row").cast("string"), F.col("src_row") % 5
    whole = F.concat_ws(";", row, F.coalesce("Service", F.lit("N/A")), F.lit('"a;b"'))
    line = F.when(turn == 0, F.concat(whole, F.lit(";EXTRA"))).when(turn == 1, row).otherwise(whole)
    path = f"{scratch_dir(f.spark)}/caremart/extract-{uuid.uuid4().hex}"
    # One column whose name is the header line; quoting is left to the lines themselves.
    f.source("urgence").select(line.alias("row_text;Service;note")).write.csv(
        path, header=True, sep="|", escapeQuotes=False, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    stored = materialise(delimited.read_delimited(f.spark, path, with_origin=True), "over-wide")
    kept = delimited.number_rows(stored, "over-wide").select("row_text", "Service", F.lit(None).cast("string").alias("ligne"))
    none = F.lit(None).cast("string")
    return kept.union(delimited.rejected_rows(stored).select(none.alias("row_text"), none.alias("Service"), "ligne"))


@register("SELECT temps_sk, nb_arrivees, patient_sk, CAST(temps_sk // 10000 AS INTEGER) AS annee FROM fact_visits "
          "WHERE temps_sk BETWEEN 20250101 AND 20251231")
def fact_partition_pruning(f: Fixtures) -> DataFrame:
    """Visits of one year from a written fact table: only that year's files are read."""
    root = f"{scratch_dir(f.spark)}/caremart/warehouse-{uuid.uuid4().hex}"
    tables.write_fact(_fact(f, "urgence"), root, "faits_accueil", "overwrite")
    fact = tables.read_table(f.spark, root, "faits_accueil", ["temps_sk", "nb_arrivees", "patient_sk", "annee"])
    return fact.where("annee = 2025")


@register("SELECT c_mktsegment AS segment, count(*) AS n, round(avg(c_acctbal) + 1e-9, 4) AS balance "
          "FROM customer GROUP BY 1")
def sql_query_scan(f: Fixtures) -> DataFrame:
    """A SQL text over a table."""
    text = """
        SELECT c_mktsegment AS segment, count(*) AS n, round(avg(c_acctbal) + 1e-9, 4) AS balance
        FROM {t} GROUP BY 1"""
    return tables.read_query(f.spark, text, t=f.table("customer"))


@register("SELECT * FROM forecasts")
def replaced_run(f: Fixtures) -> DataFrame:
    """Forecasts and alerts written as two runs; the newest complete one is read."""
    root = f"{scratch_dir(f.spark)}/caremart/runs-{uuid.uuid4().hex}"
    combined = materialise(forecast.combine(_stand_ins(f)), "combined")
    rows, alarms = forecast.forecast_rows(combined), forecast.alert_rows(combined)
    stale = {tables.FORECAST_TABLE: rows.where("horizon_jours = 1"), tables.ALERT_TABLE: alarms}
    snapshots.write_run(stale, root, "2024-06-29")
    snapshots.write_run({tables.FORECAST_TABLE: rows, tables.ALERT_TABLE: alarms}, root, "2024-06-30")
    newest = snapshots.latest_run(f.spark, root, tables.FORECAST_TABLE)
    return _rounded(newest, "occupation_predite", "intervalle_inf", "intervalle_sup")


def _root(f: Fixtures, name: str) -> str:
    return f"{scratch_dir(f.spark)}/caremart/{name}-{uuid.uuid4().hex}"


_SUMS = {t: f"CAST(sum({checks.PRIMARY_KEYS[t]}) AS BIGINT)" for t in tables.WAREHOUSE_TABLES}


@register(sql.query(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows, {_SUMS[t]} AS keys FROM {_FACT_STEPS.get(t, t)}" for t in tables.WAREHOUSE_TABLES), stored=True))
def replaced_warehouse(f: Fixtures) -> DataFrame:
    """Rows and keys of the 21 tables of the newest whole run: an older one has a single fact, and a newer load ended before it was complete."""
    root, sources = _root(f, "replaced"), f.sources()
    load.load_sources(f.spark, sources, root, SETTINGS, run_id="2024-06-29", only=["faits_accueil"])
    load.load_sources(f.spark, sources, root, SETTINGS, run_id="2024-06-30")
    broken = snapshots.begin_load(f.spark, root, "2024-07-01")
    for table in ("dim_patient", "faits_accueil"):
        broken.write(load.Warehouse(f.spark, root).table(table).limit(1), table)
    warehouse = load.Warehouse(f.spark, root)
    parts = [
        warehouse.table(t).agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
                               F.sum(F.col(checks.PRIMARY_KEYS[t]).cast("long")).alias("keys")) for t in tables.WAREHOUSE_TABLES]
    return reduce(DataFrame.unionByName, parts).select("table_name", "n_rows", "keys")


def _appended(column: str, first: int, order: str = "place") -> str:
    """Members of a text column of the visits, numbered extract by extract, with the extract that first had them."""
    return (f"SELECT lower({sql.strip('name')}) AS name, place[1] AS since, {first - 1} + row_number() OVER (ORDER BY {order}) AS sk FROM "
            f"(SELECT {column} AS name, min((part, src_row)) AS place FROM visits WHERE {column} IS NOT NULL GROUP BY 1)")


def _known(name: str, value: str) -> str:
    return f"coalesce((SELECT max(m.sk) FROM {name} m WHERE m.name = {value} AND m.since <= v.part), 1)"


@register(sql.query(f"""
    SELECT CASE WHEN v.part = 1 THEN src_row + 1 ELSE src_row + 1 + (SELECT max(src_row) + 1 FROM dated WHERE part = 1) END AS id_fait,
      CAST(strftime(Date_Arrivee, '%Y%m%d') AS INTEGER) AS temps_sk,
      CAST({_known('patients', 'upper(v.pseudonym)')} AS INTEGER) AS patient_sk,
      CAST(coalesce((SELECT max(s.sk) FROM by_service s WHERE s.name = lower(v.Service)), 1) AS INTEGER) AS service_sk,
      CAST({_known('levels', 'trunc(v.Niveau_Urgence)')} AS INTEGER) AS gravite_sk,
      CAST({_known('motifs', 'lower(v.Motif_Consultation)')} AS INTEGER) AS motif_sk,
      CAST({_known('decisions', 'lower(v.Decision_Medicale)')} AS INTEGER) AS decision_sk
    FROM dated v""", sql.CTES | {
        "visits": "SELECT *, CASE WHEN src_row % 3 = 1 THEN 2 ELSE 1 END AS part FROM std_urgence",
        "dated": "SELECT * FROM visits WHERE Date_Arrivee BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2026-12-31 23:59:59'",
        "motifs": _appended("Motif_Consultation", 1),
        "decisions": _appended("Decision_Medicale", 2),
        "levels": "SELECT level AS name, since, 1 + row_number() OVER (ORDER BY since, level) AS sk FROM "
                  "(SELECT trunc(Niveau_Urgence) AS level, min(part) AS since FROM visits WHERE Niveau_Urgence IS NOT NULL GROUP BY 1)",
        "patients": "SELECT upper(name) AS name, place[1] AS since, row_number() OVER (ORDER BY place) AS sk FROM "
                    "(SELECT ID_Patient_Anonyme AS name, min((CASE WHEN src_row % 2 = 0 THEN 1 ELSE 2 END, src_row)) AS place "
                    "FROM std_patient GROUP BY 1)",
    }))
def appended_load(f: Fixtures) -> DataFrame:
    """Visits of two extracts, the second of which was loaded twice: members keep their keys, facts are added once."""
    root, sources = _root(f, "appended"), f.sources()
    patients, visits = sources["patient"], sources["urgence"]
    early = {**sources, "patient": patients.where("src_row % 2 = 0"), "urgence": visits.where("src_row % 3 <> 1")}
    late = {**sources, "urgence": visits.where("src_row % 3 = 1")}
    for run_id, extract, given in (("1", "may", early), ("2", "june", late), ("3", "june", late)):
        load.load_sources(f.spark, given, root, SETTINGS, run_id=run_id, extract=extract, append=True, only=["faits_accueil"])
    return load.Warehouse(f.spark, root).table(
        "faits_accueil", "id_fait", "temps_sk", "patient_sk", "service_sk", "gravite_sk", "motif_sk", "decision_sk")


@register(f"""
    SELECT patient_sk, id_patient_anonyme, age, date_debut_validite, CASE WHEN changed THEN DATE '2024-07-31' END AS date_fin_validite,
      NOT changed AS est_actif, 1 AS version_ligne
    FROM (SELECT *, coalesce(old_age IS NOT NULL, false) AS changed FROM dim_patient LEFT JOIN older USING (patient_sk))
    UNION ALL
    SELECT CAST((SELECT max(patient_sk) FROM dim_patient) + row_number() OVER (ORDER BY id_patient_anonyme NULLS FIRST) AS INTEGER),
      id_patient_anonyme, age + 1, DATE '2024-07-31', CAST(NULL AS DATE), true, 2
    FROM dim_patient JOIN older USING (patient_sk)""".replace(
        "older USING", "(SELECT patient_sk, age AS old_age FROM dim_patient WHERE patient_sk % 7 = 0 AND age BETWEEN 0 AND 98) o USING"))
def versioned_load(f: Fixtures) -> DataFrame:
    """Patients after a second load in which some have aged by a year, and after that load once more."""
    root, sources = _root(f, "versioned"), f.sources()
    load.load_sources(f.spark, sources, root, SETTINGS, run_id="1", versions=True, only=["faits_accueil"])
    first = load.Warehouse(f.spark, root).table("dim_patient", "patient_sk", "id_patient_anonyme", "age")
    aged = first.where("patient_sk % 7 = 0 AND age BETWEEN 0 AND 98").select(F.col("id_patient_anonyme").alias("p"), (F.col("age") + 1).alias("a"))
    patients = sources["patient"].join(
        materialise(aged, "aged"), F.coalesce(fn.pseudonymise(F.col("ID_Patient")), F.lit("")) == F.coalesce("p", F.lit("")), "left")
    older = patients.withColumn("Age", F.coalesce(F.col("a").cast("string"), F.col("Age"))).drop("p", "a")
    later = replace(SETTINGS, run_date=dt.date(2024, 7, 31))
    for run_id in ("2", "3"):
        load.load_sources(f.spark, {**sources, "patient": older}, root, later, run_id=run_id, versions=True, only=["faits_accueil"])
    return load.Warehouse(f.spark, root).table(
        "dim_patient", "patient_sk", "id_patient_anonyme", "age", "date_debut_validite", "date_fin_validite", "est_actif", "version_ligne")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        name: (lambda spark, sf_dir, run=entry.run: run(Fixtures(spark, sf_dir))) for name, entry in REGISTRY.items()
    }


def oracle_sql() -> dict[str, str]:
    return {name: entry.oracle for name, entry in REGISTRY.items() if entry.oracle}
