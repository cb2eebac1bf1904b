"""The seven dimensions, built from staging."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stardw.functions import exprs as E

# dimension -> (staging table, natural key, surrogate key)
OVERWRITTEN = {
    "dim_canal": ("canal", "canal_id", "cle_canal"),
    "dim_geographie": ("geographie_full", "ville_id", "cle_geographie"),
    "dim_fournisseur": ("fournisseur_full", "fournisseur_id", "cle_fournisseur"),
    "dim_produit": ("produit_full", "produit_id", "cle_produit"),
}
HISTORISED = {
    "dim_client": ("client_full", "client_id", "cle_client"),
    "dim_employe": ("employe_full", "employe_id", "cle_employe"),
}
TABLES = ["dim_date", *OVERWRITTEN, *HISTORISED, "fait_ventes"]


def date_dimension(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day from ``start`` to ``end``."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("j"))
    return date_attributes(days, "j")


def date_attributes(days: DataFrame, day: str) -> DataFrame:
    j = F.col(day)
    weekday = F.weekday(j) + 1
    return days.select(
        E.date_key(j).alias("cle_date"),
        j.alias("date_complete"),
        F.dayofmonth(j).alias("jour_du_mois"),
        F.month(j).alias("numero_mois"),
        F.date_format(j, "MMMM").alias("nom_mois"),
        F.quarter(j).alias("numero_trimestre"),
        F.year(j).alias("annee"),
        weekday.alias("jour_de_semaine"),
        F.date_format(j, "EEEE").alias("nom_jour"),
        F.weekofyear(j).alias("semaine_annee"),
        weekday.isin(6, 7).alias("est_weekend"),
        E.season(j).alias("saison"))


def whole_years(lines: DataFrame, day: str) -> DataFrame:
    """Every day of the calendar years that ``day`` touches, as column ``jour``."""
    span = lines.agg(F.min(day).alias("a"), F.max(day).alias("b"))
    return span.select(F.explode(F.sequence(
        F.trunc("a", "year"),
        F.date_sub(F.add_months(F.trunc("b", "year"), 12), 1))).alias("jour"))


def client_versions(staged: DataFrame, as_of: date) -> DataFrame:
    """Staged clients as the history compares them: NULL and empty text are the same."""
    age = E.age_bracket(F.col("date_naissance"), F.lit(as_of))
    rows = staged.withColumn("tranche_age", age)
    fields = ["nom_complet", "sexe", "tranche_age", "groupe_client", None,
              "nom_ville", "nom_pays", "nom_continent"]
    hashed = E.row_hash([E.flag_text(F.col("a_carte_fidelite")) if f is None
                         else E.or_empty(F.col(f)) for f in fields])
    return rows.select("client_id", "nom_complet", "sexe", "tranche_age", "groupe_client",
                       "a_carte_fidelite", "nom_ville", "nom_pays", "nom_continent",
                       hashed.alias("hash_ligne"))


def employee_versions(staged: DataFrame, as_of: date) -> DataFrame:
    """Staged employees as the history compares them; six mandatory fields enter as they are."""
    rows = (staged
            .withColumn("tranche_age", E.age_bracket(F.col("date_naissance"), F.lit(as_of)))
            .withColumn("tranche_salaire", E.salary_bracket(F.col("salaire"))))
    mandatory = {"nom_complet", "sexe", "tranche_age", "salaire", "tranche_salaire",
                 "date_embauche"}
    fields = ["nom_complet", "sexe", "tranche_age", "salaire", "tranche_salaire", "org_pays",
              "org_compagnie", "org_departement", "org_section", "org_groupe", "nom_manager",
              "date_embauche", "date_depart", "type_contrat_courant", "date_debut_contrat",
              "date_fin_contrat", "statut_contrat", "nb_contrats_signes"]
    hashed = E.row_hash([F.col(f).cast("string") if f in mandatory else E.or_empty(F.col(f))
                         for f in fields])
    return rows.select("employe_id", *fields, hashed.alias("hash_ligne"))


VERSIONS = {"dim_client": client_versions, "dim_employe": employee_versions}
