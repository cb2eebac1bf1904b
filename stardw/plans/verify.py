"""Checks a person runs after a load."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stardw.plans.dimensions import TABLES

Tables = Mapping[str, DataFrame]

_KEYS = {"dim_date": "cle_date", "dim_canal": "cle_canal", "dim_geographie": "cle_geographie",
         "dim_fournisseur": "cle_fournisseur", "dim_produit": "cle_produit",
         "dim_client": "cle_client", "dim_employe": "cle_employe", "fait_ventes": "cle_date"}


def row_counts(dw: Tables) -> DataFrame:
    """Rows per table."""
    return reduce(DataFrame.unionByName, [
        dw[t].agg(F.count(F.lit(1)).alias("nb")).select(F.lit(t).alias("table_name"), "nb")
        for t in TABLES])


def key_ranges(dw: Tables) -> DataFrame:
    """Rows and key range per table: what a push must leave unchanged."""
    return reduce(DataFrame.unionByName, [
        dw[t].agg(F.count(F.lit(1)).alias("nb"),
                  F.min(_KEYS[t]).cast("bigint").alias("cle_min"),
                  F.max(_KEYS[t]).cast("bigint").alias("cle_max"))
        .select(F.lit(t).alias("table_name"), "nb", "cle_min", "cle_max")
        for t in TABLES])


def contracts(dw: Tables) -> DataFrame:
    """Current employees by contract type and status."""
    return (dw["dim_employe"].filter("est_courant")
            .groupBy("type_contrat_courant", "statut_contrat")
            .agg(F.count(F.lit(1)).alias("nb_employes"),
                 F.avg("salaire").alias("salaire_moyen"),
                 F.avg(F.col("nb_contrats_signes").cast("decimal(10,2)"))
                 .alias("nb_contrats_moy"))
            .orderBy(F.asc_nulls_first("type_contrat_courant"), "statut_contrat"))


def top_reps(dw: Tables, top: int = 10) -> DataFrame:
    """Sales staff by revenue, with the attributes of the current version."""
    attributes = ["nom_complet", "org_pays", "sexe", "tranche_age", "tranche_salaire",
                  "type_contrat_courant"]
    per_key = dw["fait_ventes"].groupBy("cle_employe").agg(
        F.sum("montant_net").alias("ca"), F.sum("montant_marge").alias("marge"),
        F.count(F.lit(1)).alias("lignes"))
    return (per_key.join(dw["dim_employe"].filter("est_courant"), "cle_employe")
            .groupBy(*attributes)
            .agg(F.sum("ca").alias("ca_total"), F.sum("marge").alias("marge_totale"),
                 F.sum("lignes").alias("nb_lignes_vendues"))
            .orderBy(F.desc("ca_total"), "nom_complet").limit(top))
