"""Hospital-shaped sources derived from the driver tables.

Each derivation is one SELECT in SQL that Spark and DuckDB read alike, so a query and its oracle
start from the same rows; every row of the table takes part. Dirty values (mixed date forms,
padding, missing keys, unknown members) follow from the keys.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Keys that spread the rows of a table evenly.
SPREAD = {
    "customer": ("c_custkey",),
    "orders": ("o_orderkey",),
    "lineitem": ("l_orderkey", "l_linenumber"),
    "events": ("event_id",),
}


#: Number of written forms of a date below.
DATE_FORMS = 25


def _date_text(day: str, form: str, years: int) -> str:
    """The day written in one of ``DATE_FORMS`` forms chosen by ``form``, shifted by whole ``years``.

    28 years keep weekdays and leap days in place.
    """
    y = f"CAST(year({day}) + {years} AS STRING)"
    m, d = f"CAST(month({day}) AS STRING)", f"CAST(day({day}) AS STRING)"
    mm, dd = f"lpad({m}, 2, '0')", f"lpad({d}, 2, '0')"
    name = f"substr('JanFebMarAprMayJunJulAugSepOctNovDec', 3 * month({day}) - 2, 3)"
    th = f"CASE WHEN day({day}) IN (1, 21, 31) THEN 'st' WHEN day({day}) IN (2, 22) THEN 'nd' WHEN day({day}) IN (3, 23) THEN 'rd' ELSE 'th' END"
    return f"""CASE {form}
        WHEN 0 THEN {y} || '-' || {mm} || '-' || {dd} || ' 08:55:00'
        WHEN 1 THEN {dd} || '/' || {mm} || '/' || {y} || ' 08:55'
        WHEN 2 THEN {d} || '/' || {m} || '/' || {y}
        WHEN 3 THEN {y} || {mm} || {dd}
        WHEN 4 THEN {dd} || {mm} || {y}
        WHEN 5 THEN {mm} || '/' || {dd} || '/' || {y}
        WHEN 6 THEN {y} || '-' || {mm} || '-' || {dd} || 'T08:55:00'
        WHEN 7 THEN ' ' || {dd} || '-' || {mm} || '-' || {y} || ' 08:55:00 '
        WHEN 8 THEN {dd} || '/' || {mm} || '/' || {y} || ' 08:55:10.250000'
        WHEN 9 THEN {dd} || '/' || {mm} || '/' || {y} || ' 08:55+02:00'
        WHEN 10 THEN {dd} || ' ' || {mm} || ' ' || {y}
        WHEN 11 THEN {y} || ' ' || {mm} || ' ' || {dd}
        WHEN 12 THEN {name} || '-' || {dd} || '-' || {y}
        WHEN 13 THEN {y} || '-' || {name} || '-' || {dd}
        WHEN 14 THEN {d} || {th} || ' ' || {name} || ' ' || {y}
        WHEN 15 THEN {dd} || '/' || {mm} || '/' || {y} || ' 8h55'
        WHEN 16 THEN '08:55 ' || {dd} || '/' || {mm} || '/' || {y}
        WHEN 17 THEN {y} || '.' || {mm} || '.' || {dd}
        WHEN 18 THEN {mm} || '/' || {dd} || '/' || {y} || ' 08:55 PM'
        WHEN 19 THEN {name} || ' ' || {d} || ', ' || {y} || ' 10:00'
        WHEN 20 THEN {mm} || '/' || {y}
        WHEN 21 THEN {y} || {mm} || {dd} || ' 0855'
        WHEN 22 THEN {dd} || '-' || {name} || '-' || substr({y}, 3, 2)
        WHEN 23 THEN {y} || '-' || {mm} || '-' || {dd} || 'T01:55:00Z'
        ELSE CASE WHEN {d} = '7' THEN NULL WHEN {d} = '8' THEN {y} || '-' || {mm} || '-' || {dd} || ' 8' ELSE 'garbage ' || {y} END END"""


PATIENTS = """
    SELECT c_custkey AS src_row,
      CASE WHEN c_custkey % 53 = 7 THEN NULL
           WHEN c_custkey % 53 = 8 THEN '   '
           WHEN c_custkey % 10 = 9 THEN ' P' || CAST(c_custkey - 1 AS STRING) || ' '
           ELSE 'P' || CAST(c_custkey AS STRING) END AS ID_Patient,
      ' ' || replace(lower(c_name), '#', ' d' || chr(39)) || 'b élise-' || upper(n_name) AS Nom_Complet,
      CASE c_custkey % 5 WHEN 0 THEN ' m' WHEN 1 THEN 'F ' WHEN 2 THEN 'f' WHEN 3 THEN 'M' ELSE NULL END AS Sexe,
      CASE WHEN c_custkey % 17 = 3 THEN NULL
           WHEN c_custkey % 17 = 4 THEN 'abc'
           WHEN c_custkey % 17 = 5 THEN CAST(CAST(floor(c_acctbal / 100) AS BIGINT) AS STRING) || '.9'
           ELSE ' ' || CAST(CAST(floor(c_acctbal / 100) AS BIGINT) AS STRING) END AS Age,
      CASE c_custkey % 4 WHEN 0 THEN CAST(40 + c_custkey % 60 AS STRING) || ' kg'
           WHEN 1 THEN 'env. ' || CAST(40 + c_custkey % 60 AS STRING) || '.25kg'
           WHEN 2 THEN 'inconnu' ELSE NULL END AS Poids,
      CASE c_custkey % 3 WHEN 0 THEN '1,75 m' WHEN 1 THEN '-.5x' ELSE '1.' || CAST(50 + c_custkey % 40 AS STRING) END
        AS Taille,
      CASE c_custkey % 3 WHEN 0 THEN NULL ELSE 'Malnutri' END AS Statut_Nutritionnel,
      CASE c_custkey % 4 WHEN 0 THEN NULL ELSE 'Asthme' END AS Antecedents_Medicaux,
      CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE r_name END AS Commune,
      n_name AS Quartier
    FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey"""

VISITS = f"""
    SELECT o_orderkey AS src_row,
      CASE WHEN o_orderkey % 31 = 0 THEN NULL
           WHEN o_orderkey % 31 = 1 THEN ' P' || CAST(o_custkey AS STRING) || ' '
           ELSE 'P' || CAST(o_custkey AS STRING) END AS ID_Patient,
      {_date_text('o_orderdate', f'o_orderkey % {DATE_FORMS}', 28)} AS Date_Arrivee,
      CASE WHEN o_orderkey % 41 = 0 THEN NULL WHEN o_orderkey % 41 = 1 THEN 'x'
           ELSE substr(o_orderpriority, 1, 1) END AS Niveau_Urgence,
      CASE o_orderkey % 4 WHEN 0 THEN 'Ambulance' WHEN 1 THEN 'À pied' WHEN 2 THEN 'Véhicule privé'
           ELSE NULL END AS Mode_Transport,
      CASE WHEN o_orderkey % 7 = 0 THEN NULL
           WHEN o_orderkey % 7 = 1 THEN 'Motif ' || CAST(o_custkey % 13 AS STRING) || ' '
           ELSE 'Motif ' || CAST(o_custkey % 13 AS STRING) END AS Motif_Consultation,
      CASE o_orderstatus WHEN 'F' THEN 'Hospitalisation' WHEN 'O' THEN 'Retour domicile' ELSE
           CASE WHEN o_orderkey % 2 = 0 THEN 'ORIENTATION' ELSE NULL END END AS Decision_Medicale,
      CASE o_orderkey % 8 WHEN 0 THEN 'service af' WHEN 1 THEN 'SERVICE NO' WHEN 2 THEN ' Service RF'
           WHEN 3 THEN 'Service RO' WHEN 4 THEN 'Urgences' WHEN 5 THEN NULL ELSE 'Service NF' END AS Service,
      CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE CAST(o_orderkey % 60 AS STRING) || '.7' END AS Temps_Attente_Tri,
      CAST(o_custkey % 90 AS STRING) AS Temps_Attente_Orientation
    FROM {{orders}}"""

CONSULTATIONS = f"""
    SELECT event_id AS src_row,
      CASE WHEN event_id % 43 = 0 THEN NULL ELSE 'P' || CAST(user_id AS STRING) END AS ID_Patient,
      {_date_text('ts', f'event_id % {DATE_FORMS}', 0)} AS Date_Consultation,
      CASE WHEN event_id % 37 = 0 THEN NULL ELSE 'Patho ' || regexp_extract(props, '[0-9]+', 0) END AS Pathologie,
      CASE user_id % 7 WHEN 0 THEN NULL
           WHEN 1 THEN 'Dr Jean Ilunga wa Ilunga Kalombo Mutombo ' || CAST(user_id AS STRING)
           ELSE 'Dr ' || CAST(user_id AS STRING) END AS Medecin,
      CASE event_type WHEN 'error' THEN NULL WHEN 'click' THEN 'Service AF' ELSE event_type END AS Specialite_Medecin,
      CASE user_id % 3 WHEN 0 THEN 'Interne' WHEN 1 THEN 'Chef' ELSE NULL END AS Grade_Medecin,
      CASE user_id % 5 WHEN 0 THEN NULL ELSE CAST(user_id % 30 AS STRING) END AS Annee_Experience,
      CASE event_id % 4 WHEN 0 THEN NULL ELSE CAST(value AS STRING) END AS Duree_Consultation,
      CASE event_id % 6 WHEN 5 THEN NULL ELSE CAST(event_id % 6 AS STRING) END AS Nbr_Medicaments,
      CASE event_id % 5 WHEN 4 THEN 'n.c.' ELSE CAST(event_id % 50 AS STRING) || '.5' END AS Temps_Attente
    FROM {{events}}"""

STAYS = f"""
    SELECT l_orderkey * 8 + l_linenumber AS src_row,
      CASE WHEN l_partkey % 23 = 0 THEN NULL ELSE 'P' || CAST(l_partkey AS STRING) END AS ID_Patient,
      {_date_text('l_shipdate', f'(l_suppkey + l_linenumber) % {DATE_FORMS}', 28)} AS Date_Admission,
      CASE l_suppkey % 11 WHEN 3 THEN NULL WHEN 4 THEN 'SERVICE ' || l_returnflag || l_linestatus
           WHEN 5 THEN 'Service ' || l_returnflag || l_linestatus || ' '
           ELSE 'Service ' || l_returnflag || l_linestatus END AS Service_Affectation,
      CASE WHEN l_partkey % 19 = 0 THEN NULL ELSE 'PATHO ' || CAST(l_partkey % 120 AS STRING) END
        AS Pathologie_Principale,
      CASE l_returnflag WHEN 'A' THEN 'Guérison' WHEN 'R' THEN 'Transfert' ELSE NULL END AS Issue_Sortie,
      CASE WHEN l_suppkey % 13 = 0 THEN NULL ELSE ' L' || CAST(l_suppkey AS STRING) END AS Numero_Lit,
      CASE l_suppkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 'Isolement' ELSE 'Réanimation' END AS Type_Chambre,
      CASE l_linenumber % 3 WHEN 0 THEN 'Urgence' WHEN 1 THEN 'Programmée' ELSE NULL END AS Type_Admission,
      CASE l_suppkey % 2 WHEN 0 THEN 'Domicile' ELSE 'Transfert' END AS Origine_Admission,
      CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_quantity AS STRING) END AS Duree_Sejour
    FROM {{lineitem}}"""

BIRTHS = f"""
    SELECT o_orderkey AS src_row,
      CASE WHEN o_orderkey % 47 = 0 THEN NULL ELSE 'P' || CAST(o_custkey AS STRING) END AS ID_Patient,
      {_date_text('o_orderdate', f'(o_orderkey + 3) % {DATE_FORMS}', 28)} AS Date_Accouchement,
      CASE o_orderstatus WHEN 'F' THEN CASE WHEN o_orderkey % 5 = 0 THEN 'CÉSARIENNE' ELSE 'Césarienne' END
           WHEN 'O' THEN ' Normal ' ELSE NULL END AS Type_Accouchement,
      CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE CAST(28 + o_orderkey % 14 AS STRING) END AS Age_Gestationnel,
      CAST(1 + o_custkey % 6 AS STRING) AS Nb_Grossesses,
      CASE o_custkey % 3 WHEN 0 THEN 'Aucun antécédent' WHEN 1 THEN 'Hypertension' ELSE NULL END
        AS Antecedents_Obstetricaux,
      CASE WHEN o_orderkey % 31 = 0 THEN NULL WHEN o_orderkey % 31 = 1 THEN '32000'
           ELSE CAST(2000 + (o_custkey * 37) % 2500 AS STRING) END AS Poids_Nouveau_Ne,
      CAST(45 + o_custkey % 10 AS STRING) || '.5' AS Taille_Naissance,
      CAST(4 + o_orderkey % 7 AS STRING) AS Score_Apgar,
      CASE o_orderkey % 3 WHEN 0 THEN 'Sain' WHEN 1 THEN 'Complication' ELSE NULL END AS Statut_Bebe,
      CASE o_orderkey % 6 WHEN 0 THEN 'Aucune' WHEN 1 THEN 'aucune' WHEN 2 THEN NULL WHEN 3 THEN 'Hémorragie '
           WHEN 4 THEN 'Infection' ELSE ' infection' END AS Complication_Type
    FROM {{orders}}"""

# Daily use of services: every event is a stay of its type's service. Events of each seventh day
# count for the day before, which leaves gaps to close.
OCCUPANCY = """
    SELECT event_type, event_id,
      CAST(ts AS DATE) - CASE WHEN day(ts) % 7 = 0 THEN 1 ELSE 0 END AS d,
      value AS beds
    FROM {events}"""

# Events of one type end after the 20th, which is less than the minimum history.
SHORT_OCCUPANCY = """
    SELECT event_type, event_id,
      CAST(ts AS DATE) - CASE WHEN event_type = 'signup' AND day(ts) > 20 THEN 15
                              WHEN day(ts) % 7 = 0 THEN 1 ELSE 0 END AS d,
      value AS beds
    FROM {events}"""

# Services named after the event types; the capacities give both alert classes and none.
SERVICES = """
    SELECT CASE event_type WHEN 'click' THEN 2 WHEN 'error' THEN 3 WHEN 'purchase' THEN 4 WHEN 'signup' THEN 5
           ELSE 6 END AS service_sk,
      event_type AS nom_service,
      CASE event_type WHEN 'click' THEN 55 WHEN 'error' THEN 62 WHEN 'purchase' THEN 100 WHEN 'signup' THEN 0
           ELSE 70 END AS capacite_lits
    FROM (SELECT DISTINCT event_type FROM {events}) kinds"""

SOURCES = {
    "patient": PATIENTS,
    "urgence": VISITS,
    "consultation": CONSULTATIONS,
    "hospitalisation": STAYS,
    "maternite": BIRTHS,
}


def _compiled(text: str) -> str:
    """The same derivation for Spark, the form of a date passed through a lambda.

    Lambdas stay out of whole-stage code, whose one method would outgrow with the date forms what the virtual machine compiles.
    """
    return re.sub(r"CASE (\S.*)\n(\s+WHEN 0 )", r"CASE get(transform(array(\1), k -> k), 0)\n\2", text)


class Fixtures:
    """Driver tables of one folder and the sources derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def select(self, text: str) -> DataFrame:
        """A derivation over the driver tables it names."""
        used = {t: self.table(t) for t in TABLES if "{" + t + "}" in text}
        return self.spark.sql(text, **used)

    def source(self, name: str) -> DataFrame:
        """A hospital source. Its text is costly to parse, so a table that is read in few parts is spread first."""
        text, cores = _compiled(SOURCES[name]), self.spark.sparkContext.defaultParallelism
        used = {t: self.table(t) for t in TABLES if "{" + t + "}" in text}
        spread = {
            t: df.repartition(cores, *SPREAD[t]) if t in SPREAD and df.rdd.getNumPartitions() < cores else df for t, df in used.items()
        }
        return self.spark.sql(text, **spread)

    def sources(self) -> dict[str, DataFrame]:
        return {name: self.source(name) for name in SOURCES}


def in_duckdb(text: str) -> str:
    """The same derivation over DuckDB views of the driver tables."""
    return text.format(**{t: t for t in TABLES})
