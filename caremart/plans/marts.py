"""Indicators of the four fact tables by time and service."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Indicators of each fact table.
INDICATORS: dict[str, dict[str, tuple[str, str]]] = {
    "faits_accueil": {
        "arrivees": ("sum", "nb_arrivees"),
        "non_pris_en_charge": ("sum", "nb_non_pris_en_charge"),
        "attente_tri_moyenne": ("avg", "temps_attente_tri"),
        "attente_orientation_moyenne": ("avg", "temps_attente_orientation"),
    },
    "faits_consultation": {
        "consultations": ("sum", "nb_consultations"),
        "duree_moyenne": ("avg", "duree_consultation"),
        "medicaments": ("sum", "nb_medicaments"),
    },
    "faits_hospitalisation": {
        "hospitalisations": ("sum", "nb_hospitalisations"),
        "duree_sejour_moyenne": ("avg", "duree_sejour"),
        "deces": ("sum", "nb_deces"),
        "sorties": ("sum", "nb_sorties"),
    },
    "faits_maternite": {
        "accouchements": ("sum", "nb_accouchements"),
        "cesariennes": ("sum", "nb_cesariennes"),
        "complications": ("sum", "nb_complications"),
        "poids_moyen": ("avg", "poids_naissance"),
    },
}


def month_levels() -> dict[str, Column]:
    """Year and month of the date key; no calendar join is needed."""
    return {
        "annee": F.floor(F.col("temps_sk") / 10000).cast("int"),
        "mois": F.floor(F.col("temps_sk") / 100).cast("int") % 100,
    }


def indicators(fact: DataFrame, table: str, by: Sequence[str] = ("annee", "mois", "service_sk")) -> DataFrame:
    """The table's indicators per year, month and service."""
    aggregates = {"sum": F.sum, "avg": F.avg}
    measures = [aggregates[how](column).alias(name) for name, (how, column) in INDICATORS[table].items()]
    return fact.withColumns(month_levels()).groupBy(*by).agg(*measures)


def indicator_rollup(fact: DataFrame, table: str) -> DataFrame:
    """Year, year-month and overall subtotals of the table's indicators.

    Sums are added up before the rollup expands the rows, so the expansion works on one row per
    year, month and input partition instead of on every fact.
    """
    specs = INDICATORS[table]
    partial = []
    for name, (how, column) in specs.items():
        partial.append(F.sum(column).alias(f"{name}_s"))
        if how == "avg":
            partial.append(F.count(column).alias(f"{name}_n"))
    final = [
        (F.sum(f"{n}_s") if how == "sum" else F.sum(f"{n}_s") / F.nullif(F.sum(f"{n}_n"), F.lit(0))).alias(n)
        for n, (how, _) in specs.items()
    ]
    monthly = fact.withColumns(month_levels()).groupBy("annee", "mois").agg(*partial)
    return monthly.rollup("annee", "mois").agg(F.grouping_id().cast("int").alias("niveau"), *final)
