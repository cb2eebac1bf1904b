"""Reference data of an empty operational model, from literal lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stardw.functions import labels as L
from stardw.operators.tables import insert_if_absent
from stardw.session import local_rows


def listed(spark: SparkSession, table: str, values: Sequence, columns: str) -> DataFrame:
    """Literal rows numbered from 1 in their order, as ``<table>_id``."""
    rows = [(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(values, 1)]
    return local_rows(spark, rows, f"{table}_id int, {columns}")


def children(parents: DataFrame, table: str, names, parent_id: str) -> DataFrame:
    """Rows below each parent, named by the array column ``names``, numbered in parent order.

    For the seeded trees, whose size is that of the literal lists.
    """
    pairs = parents.select(parent_id, F.posexplode(names).alias("_k", f"nom_{table}"))
    number = F.row_number().over(Window.orderBy(parent_id, "_k"))
    return pairs.select(number.alias(f"{table}_id"), f"nom_{table}", parent_id)


def reference_tables(spark: SparkSession, company_prefix: str = "Compagnie ",
                     ) -> dict[str, DataFrame]:
    continents = listed(spark, "continent", L.CONTINENTS, "nom_continent string")
    countries = listed(spark, "pays", L.COUNTRIES,
                       "code_pays string, nom_pays string, nom_continent string")
    org_countries = listed(spark, "org_pays", L.ORG_COUNTRIES, "nom_org_pays string")
    companies = org_countries.select(
        F.col("org_pays_id").alias("org_compagnie_id"),
        F.concat(F.lit(company_prefix), "nom_org_pays").alias("nom_org_compagnie"),
        "org_pays_id")
    departments = children(companies, "org_departement",
                           F.array(*[F.lit(d) for d in L.DEPARTMENTS]), "org_compagnie_id")
    sections = children(
        departments, "org_section",
        F.array(F.concat(F.lit(L.SECTION_PREFIX), "nom_org_departement")), "org_departement_id")
    groups = children(
        sections, "org_groupe",
        F.array(*[F.concat(F.lit(p), "nom_org_section") for p in L.ORG_GROUP_PREFIXES]),
        "org_section_id")
    product_lines = listed(spark, "ligne_produit", L.PRODUCT_LINES, "nom_ligne_produit string")
    categories = (listed(spark, "categorie_produit", L.PRODUCT_CATEGORIES,
                         "nom_ligne_produit string, nom_categorie_produit string")
                  .join(product_lines, "nom_ligne_produit")
                  .select("categorie_produit_id", "nom_categorie_produit", "ligne_produit_id"))
    product_groups = children(
        categories, "groupe_produit",
        F.array(*[F.concat(F.lit(p), "nom_categorie_produit")
                  for p in L.PRODUCT_GROUP_PREFIXES]),
        "categorie_produit_id")
    return {
        "continent": continents,
        "pays": countries.join(continents, "nom_continent").select(
            "pays_id", "code_pays", "nom_pays", "continent_id"),
        "canal_vente": local_rows(spark, L.CHANNELS,
                                  "canal_id int, code_canal string, nom_canal string"),
        "org_pays": org_countries, "org_compagnie": companies,
        "org_departement": departments, "org_section": sections, "org_groupe": groups,
        "ligne_produit": product_lines, "categorie_produit": categories,
        "groupe_produit": product_groups,
        "groupe_client": listed(spark, "groupe_client", L.CUSTOMER_GROUPS,
                                "nom_groupe_client string, description string"),
    }


# What tells the rows of a table apart: names, and the parent where names repeat below others.
# Parents come before their children.
UNIQUE = {"continent": ["nom_continent"], "pays": ["code_pays"], "canal_vente": ["code_canal"],
          "org_pays": ["nom_org_pays"], "org_compagnie": ["nom_org_compagnie", "org_pays_id"],
          "org_departement": ["nom_org_departement", "org_compagnie_id"],
          "org_section": ["nom_org_section", "org_departement_id"],
          "org_groupe": ["nom_org_groupe", "org_section_id"],
          "ligne_produit": ["nom_ligne_produit"],
          "categorie_produit": ["nom_categorie_produit", "ligne_produit_id"],
          "groupe_produit": ["nom_groupe_produit", "categorie_produit_id"],
          "groupe_client": ["nom_groupe_client"]}
PARENT = {"pays": "continent", "org_compagnie": "org_pays", "org_departement": "org_compagnie",
          "org_section": "org_departement", "org_groupe": "org_section",
          "categorie_produit": "ligne_produit", "groupe_produit": "categorie_produit"}
IDS = {"canal_vente": "canal_id"}


def seed(spark: SparkSession, stored: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """``stored`` with the missing reference rows; rows that are there stay as they are.

    New rows are numbered after the highest stored id, and refer to the id that their parent has
    in the store, found by its name. Sizes are those of the literal lists.
    """
    fresh, out = reference_tables(spark), {}
    final: dict[str, DataFrame] = {}  # id in the lists -> id in the store
    for name, unique in UNIQUE.items():
        rows, own = fresh[name], IDS.get(name, f"{name}_id")
        if parent := PARENT.get(name):
            up = IDS.get(parent, f"{parent}_id")
            rows = (rows.withColumnRenamed(up, "_listed").join(final[parent], "_listed")
                    .withColumnRenamed("_final", up).drop("_listed").select(*fresh[name].columns))
        if name in stored:
            kept = stored[name]
            highest = kept.agg(F.coalesce(F.max(own), F.lit(0)).alias("n")).scalar()
            number = F.row_number().over(Window.orderBy(own)) + highest
            new = rows.join(kept.select(*unique), unique, "left_anti")
            new = new.withColumn(own, number.cast(kept.schema[own].dataType))
            out[name] = insert_if_absent(kept, new.select(*rows.columns), unique)
        else:
            out[name] = rows
        final[name] = rows.select(F.col(own).alias("_listed"), *unique).join(
            out[name].select(F.col(own).alias("_final"), *unique), unique).select(
            "_listed", "_final")
    return out
