"""Declared constraints checked as Spark jobs. Each report has one row per check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stardw.functions import labels as L
from stardw.operators import fact
from stardw.sources.operational import OperationalSource


def report(rows: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, rows)


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str,
            check: str) -> DataFrame:
    """Rows of ``child`` whose key ``parent`` lacks. Counted per key first, so a hot key is one
    row of the join; NULL keys refer to nothing and are no orphans."""
    held = child.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).agg(
        F.count(F.lit(1)).alias("_n"))
    return lost_keys(held, "_k", "_n", parent, parent_key, check)


def lost_keys(held: DataFrame, key: str, n: str, parent: DataFrame, parent_key: str,
              check: str) -> DataFrame:
    """The same from keys and how many rows hold each; a key may have several counts."""
    counts = held.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).agg(
        F.sum(n).alias("_n"))
    lost = counts.join(parent.select(F.col(parent_key).alias("_k")), "_k", "left_anti")
    return lost.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("nb_lignes"),
                    F.count(F.lit(1)).alias("nb_cles")).select(
                        F.lit(check).alias("controle"), "nb_lignes", "nb_cles")


def fact_orphans(dw: Mapping[str, DataFrame]) -> DataFrame:
    """Foreign keys of the fact."""
    sales = dw["fait_ventes"]
    checks = [orphans(sales, "cle_date", dw["dim_date"], "cle_date", "fait_ventes.cle_date")]
    for dim, (_, _, cle, name, _) in fact.LOOKUPS.items():
        checks.append(orphans(sales, name, dw[dim], cle, f"fait_ventes.{name}"))
    return report(checks)


def source_orphans(ops: OperationalSource) -> DataFrame:
    """Foreign keys of the order tables."""
    lines, orders = ops.unnumbered_lines(), ops["commande"]
    return report([
        orphans(lines, "commande_id", orders, "commande_id", "ligne_commande.commande_id"),
        orphans(lines, "produit_id", ops["produit"], "produit_id", "ligne_commande.produit_id"),
        orphans(orders, "client_id", ops["client"], "client_id", "commande.client_id"),
        orphans(orders, "employe_id", ops["employe"], "employe_id", "commande.employe_id"),
        orphans(orders, "canal_id", ops["canal_vente"], "canal_id", "commande.canal_id"),
    ])


# Child, its column, parent and the parent's key, for the references below the order tables.
REFERENCES = [
    ("pays", "continent_id", "continent", "continent_id"),
    ("region", "pays_id", "pays", "pays_id"), ("ville", "region_id", "region", "region_id"),
    ("org_compagnie", "org_pays_id", "org_pays", "org_pays_id"),
    ("org_departement", "org_compagnie_id", "org_compagnie", "org_compagnie_id"),
    ("org_section", "org_departement_id", "org_departement", "org_departement_id"),
    ("org_groupe", "org_section_id", "org_section", "org_section_id"),
    ("employe", "org_groupe_id", "org_groupe", "org_groupe_id"),
    ("employe", "manager_id", "employe", "employe_id"),
    ("contrat_employe", "employe_id", "employe", "employe_id"),
    ("fournisseur", "pays_id", "pays", "pays_id"),
    ("categorie_produit", "ligne_produit_id", "ligne_produit", "ligne_produit_id"),
    ("groupe_produit", "categorie_produit_id", "categorie_produit", "categorie_produit_id"),
    ("produit", "groupe_produit_id", "groupe_produit", "groupe_produit_id"),
    ("produit", "fournisseur_id", "fournisseur", "fournisseur_id"),
    ("historique_prix", "produit_id", "produit", "produit_id"),
    ("remise_produit", "produit_id", "produit", "produit_id"),
    ("client", "groupe_client_id", "groupe_client", "groupe_client_id"),
    ("client", "ville_id", "ville", "ville_id"),
    ("carte_fidelite", "client_id", "client", "client_id")]


def model_orphans(ops: OperationalSource) -> DataFrame:
    """Foreign keys of all tables but those of the orders."""
    return report([orphans(ops[child], key, ops[parent], parent_key, f"{child}.{key}")
                   for child, key, parent, parent_key in REFERENCES])


def duplicates(df: DataFrame, key: Sequence[str], check: str) -> DataFrame:
    """Keys held by several rows, and the rows beyond the first of each."""
    return beyond_first(df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")), "_n", check)


def beyond_first(counts: DataFrame, n: str, check: str) -> DataFrame:
    """The same from the number of rows of each key."""
    return counts.filter(F.col(n) > 1).agg(
        F.count(F.lit(1)).alias("nb_cles"),
        F.coalesce(F.sum(F.col(n) - 1), F.lit(0)).alias("nb_lignes")).select(
            F.lit(check).alias("controle"), "nb_lignes", "nb_cles")


def dimension_keys(dw: Mapping[str, DataFrame]) -> DataFrame:
    """Natural keys of the dimensions, of the current versions where there are more."""
    checks = [("dim_date", ["cle_date"], dw["dim_date"]),
              ("dim_canal", ["canal_id"], dw["dim_canal"]),
              ("dim_geographie", ["ville_id"], dw["dim_geographie"]),
              ("dim_fournisseur", ["fournisseur_id"], dw["dim_fournisseur"]),
              ("dim_produit", ["produit_id"], dw["dim_produit"]),
              ("dim_client", ["client_id"], dw["dim_client"].filter("est_courant")),
              ("dim_employe", ["employe_id"], dw["dim_employe"].filter("est_courant"))]
    return report([duplicates(df, key, f"{table}({', '.join(key)})") for table, key, df in checks])


def unique_keys(dw: Mapping[str, DataFrame]) -> DataFrame:
    """Natural keys of the dimensions and the line key of the fact."""
    return dimension_keys(dw).unionByName(duplicates(
        dw["fait_ventes"], fact.LINE_KEY, f"fait_ventes({', '.join(fact.LINE_KEY)})"))


def violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that break each rule, all counted in one pass. As in SQL, unknown is no violation."""
    counts = df.agg(*[F.count(F.when(~rule, 1)).alias(f"r{i}")
                      for i, rule in enumerate(rules.values())])
    pairs = F.array(*[F.struct(F.lit(name).alias("controle"), F.col(f"r{i}").alias("nb_lignes"))
                      for i, name in enumerate(rules)])
    return counts.select(F.inline(pairs))


def source_ranges(ops: OperationalSource) -> DataFrame:
    """Domains, ranges and order of dates in the operational tables."""
    c = F.col
    ends = c("date_fin") >= c("date_debut")
    tables = {
        "client": (ops["client"], {"sexe": c("sexe").isin("M", "F")}),
        "employe": (ops["employe"], {
            "sexe": c("sexe").isin("M", "F"), "salaire": c("salaire") >= 0}),
        "contrat_employe": (ops["contrat_employe"], {
            "type_contrat": c("type_contrat").isin(L.CONTRACT_TYPES),
            "dates": c("date_fin").isNull() | ends}),
        "historique_prix": (ops["historique_prix"], {
            "cout": c("cout") >= 0, "prix_vente": c("prix_vente") >= 0,
            "dates": c("date_fin").isNull() | ends}),
        "remise_produit": (ops["remise_produit"], {
            "pct_remise": c("pct_remise").between(0, 1), "dates": ends}),
        "ligne_commande": (ops.unnumbered_lines(), {
            "quantite": c("quantite") > 0, "prix_unitaire": c("prix_unitaire") >= 0,
            "cout_unitaire": c("cout_unitaire") >= 0,
            "pct_remise": c("pct_remise").between(0, 1)}),
    }
    return report([violations(df, {f"{table}.{name}": rule for name, rule in rules.items()})
                    for table, (df, rules) in tables.items()])


def history_faults(history: DataFrame, natural_key: str, cle: str) -> DataFrame:
    """Faults of a history: several current versions, gaps, ends before starts, keys used twice.

    The versions of one natural key, at most one per load, follow each other in key order.
    """
    following = Window.partitionBy(natural_key).orderBy("effectif_du", cle)
    versions = history.select(
        natural_key, "est_courant", "effectif_du", "effectif_au",
        F.lead("effectif_du").over(following).alias("_next"))
    gap = F.col("_next").isNotNull() & ~F.col("effectif_au").eqNullSafe(F.col("_next"))
    last = F.col("_next").isNull()
    per_row = versions.agg(
        F.count(F.when(gap, 1)).alias("intervalles_non_contigus"),
        F.count(F.when(F.col("effectif_au") < F.col("effectif_du"), 1)).alias("fins_avant_debut"),
        F.count(F.when(last != F.col("est_courant"), 1)).alias("courante_pas_derniere"))
    rows = per_row.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("controle"), F.col(n).alias("nb_lignes"))
        for n in per_row.columns])))
    several = duplicates(history.filter("est_courant"), [natural_key],
                         "plusieurs_courantes").select("controle", "nb_lignes")
    twice = duplicates(history, [cle], "cle_en_double").select("controle", "nb_lignes")
    return report([rows, several, twice])
