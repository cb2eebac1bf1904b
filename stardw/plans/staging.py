"""The seven staging tables: the operational model flattened by joins.

Lookups along the hierarchies are left to Catalyst, which broadcasts the small ones. The joins
that order lines go through can meet hot keys and use the salted lookup join.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stardw.functions import exprs as E
from stardw.operators import fact
from stardw.operators.skew import hot_keys, lookup_join
from stardw.session import cut_lineage
from stardw.sources.operational import OperationalSource

# Columns of each staging table, in their fixed order.
COLUMNS = {
    "geographie_full": ["ville_id", "nom_ville", "code_postal", "nom_region", "code_pays",
                        "nom_pays", "nom_continent"],
    "fournisseur_full": ["fournisseur_id", "nom_fournisseur", "nom_pays", "nom_continent"],
    "canal": ["canal_id", "code_canal", "nom_canal"],
    "produit_full": ["produit_id", "nom_produit", "nom_groupe_produit",
                     "nom_categorie_produit", "nom_ligne_produit", "fournisseur_id_naturel",
                     "nom_fournisseur", "actif"],
    "client_full": ["client_id", "nom_complet", "sexe", "date_naissance", "groupe_client",
                    "a_carte_fidelite", "nom_ville", "nom_pays", "nom_continent", "maj_le"],
    "employe_full": ["employe_id", "nom_complet", "sexe", "date_naissance", "salaire",
                     "org_pays", "org_compagnie", "org_departement", "org_section",
                     "org_groupe", "nom_manager", "date_embauche", "date_depart",
                     "type_contrat_courant", "date_debut_contrat", "date_fin_contrat",
                     "statut_contrat", "nb_contrats_signes", "maj_le"],
    "lignes_commande": ["commande_id", "numero_ligne", "date_commande", "client_id",
                        "employe_id", "canal_id", "produit_id", "fournisseur_id",
                        "cli_ville_id", "quantite", "prix_unitaire", "cout_unitaire",
                        "pct_remise"],
}


def _countries(ops: OperationalSource) -> DataFrame:
    return ops["pays"].join(ops["continent"], "continent_id").select(
        "pays_id", "code_pays", "nom_pays", "nom_continent")


def geography(ops: OperationalSource) -> DataFrame:
    return (ops["ville"].join(ops["region"], "region_id").join(_countries(ops), "pays_id")
            .select(*COLUMNS["geographie_full"]))


def suppliers(ops: OperationalSource) -> DataFrame:
    return (ops["fournisseur"].join(_countries(ops), "pays_id")
            .select(*COLUMNS["fournisseur_full"]))


def channels(ops: OperationalSource) -> DataFrame:
    return ops["canal_vente"].select(*COLUMNS["canal"])


def products(ops: OperationalSource) -> DataFrame:
    tree = (ops["groupe_produit"]
            .join(ops["categorie_produit"], "categorie_produit_id")
            .join(ops["ligne_produit"], "ligne_produit_id")
            .select("groupe_produit_id", "nom_groupe_produit", "nom_categorie_produit",
                    "nom_ligne_produit"))
    # Written, so that Catalyst knows its size: estimates of joins are far too large.
    tree = cut_lineage(tree, "arbre")
    supplier = ops["fournisseur"].select("fournisseur_id", "nom_fournisseur")
    # A product without a line has no group; it stays, as do clients without one.
    rows = lookup_join(ops["produit"], tree, "groupe_produit_id", spread=["produit_id"],
                       how="left")
    rows = lookup_join(rows, supplier, "fournisseur_id", spread=["produit_id"],
                       hot=lambda: hot_keys(ops["produit"], "fournisseur_id"))
    return (rows.withColumn("fournisseur_id_naturel", F.col("fournisseur_id"))
            .select(*COLUMNS["produit_full"]))


def clients(ops: OperationalSource) -> DataFrame:
    """Clients with their group and card, if any, and their place."""
    cards = ops["carte_fidelite"].select("client_id", "carte_fidelite_id")
    groups = ops["groupe_client"].select(
        "groupe_client_id", F.col("nom_groupe_client").alias("groupe_client"))
    places = cut_lineage(
        geography(ops).select("ville_id", "nom_ville", "nom_pays", "nom_continent"), "lieux")
    rows = ops["client"].join(groups, "groupe_client_id", "left").join(
        cards, "client_id", "left")
    return (lookup_join(rows, places, "ville_id", spread=["client_id"],
                        hot=lambda: hot_keys(ops["client"], "ville_id"))
            .withColumn("nom_complet", E.full_name(F.col("nom"), F.col("prenom")))
            .withColumn("a_carte_fidelite", F.col("carte_fidelite_id").isNotNull())
            .select(*COLUMNS["client_full"]))


def current_contract(ops: OperationalSource) -> DataFrame:
    """Per employee with contracts: the contract that counts, and how many there are.

    An open contract comes before a closed one, then the latest start. Taken as a maximum while
    the contracts are counted, so nothing is sorted.
    """
    contract = F.struct("contrat_id", "type_contrat", "date_debut", "date_fin")
    order = F.struct(F.col("date_fin").isNull(), "date_debut", "contrat_id")
    return (ops["contrat_employe"].groupBy("employe_id")
            .agg(F.max_by(contract, order).alias("c"),
                 F.count(F.lit(1)).cast("int").alias("nb_contrats_signes"))
            .select("employe_id", "c.contrat_id",
                    F.col("c.type_contrat").alias("type_contrat_courant"),
                    F.col("c.date_debut").alias("date_debut_contrat"),
                    F.col("c.date_fin").alias("date_fin_contrat"), "nb_contrats_signes"))


def organisation(ops: OperationalSource) -> DataFrame:
    return (ops["org_groupe"].join(ops["org_section"], "org_section_id")
            .join(ops["org_departement"], "org_departement_id")
            .join(ops["org_compagnie"], "org_compagnie_id")
            .join(ops["org_pays"], "org_pays_id")
            .select("org_groupe_id", F.col("nom_org_pays").alias("org_pays"),
                    F.col("nom_org_compagnie").alias("org_compagnie"),
                    F.col("nom_org_departement").alias("org_departement"),
                    F.col("nom_org_section").alias("org_section"),
                    F.col("nom_org_groupe").alias("org_groupe")))


def employees(ops: OperationalSource, as_of: date) -> DataFrame:
    staff = ops["employe"]
    managers = staff.select(F.col("employe_id").alias("manager_id"),
                            E.full_name(F.col("nom"), F.col("prenom")).alias("nom_manager"))
    return (staff
            .join(organisation(ops), "org_groupe_id")
            .join(managers, "manager_id", "left")
            .join(current_contract(ops), "employe_id", "left")
            .withColumn("nom_complet", E.full_name(F.col("nom"), F.col("prenom")))
            .withColumn("statut_contrat", E.contract_status(
                F.col("contrat_id"), F.col("date_fin_contrat"), F.lit(as_of)))
            .withColumn("nb_contrats_signes",
                        F.coalesce("nb_contrats_signes", F.lit(0)))
            .select(*COLUMNS["employe_full"]))


def order_lines(ops: OperationalSource, after: date | None = None, only: int | None = None,
                dims: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Order lines with everything the fact needs to look up its keys.

    ``after`` keeps the orders dated strictly later; ``only`` keeps one order. With ``dims`` the
    lines also carry the six keys of the fact, null where a dimension doesn't know one: orders and
    products look them up before lines join them.
    """
    client = ops["client"].select("client_id", F.col("ville_id").alias("cli_ville_id"))
    product = ops["produit"].select("produit_id", "fournisseur_id")
    # One order has no key worth a pass over the table; an increment is searched by itself.
    def hot(found, rows, key):
        return dict if only is not None else found if after is None else (
            lambda: hot_keys(rows, key))
    # The client's place joins the orders, of which there are fewer than lines.
    wanted = ops.orders(after, only)
    orders = lookup_join(wanted, client, "client_id", spread=["commande_id"],
                         hot=hot(ops.hot_clients, wanted, "client_id"))
    if dims is not None:
        def hot_order(column: str) -> dict:
            found = ops.hot_clients if column == "client_id" else lambda: hot_keys(orders, column)
            return hot(found, orders, column)()
        orders = fact.with_keys(orders, dims, fact.OF_ORDER, ["commande_id"], hot=hot_order)
        product = cut_lineage(fact.with_keys(
            product, dims, fact.OF_PRODUCT, ["produit_id"]), "produits")
    lines = ops.order_lines(after, only)

    def hot_lines(key: str):
        return dict if only is not None else lambda: ops.hot_lines(key, after)
    rows = lookup_join(lines, orders, "commande_id", spread=["numero_ligne", "produit_id"],
                       hot=hot_lines("commande_id"))
    rows = lookup_join(rows, product, "produit_id", spread=["commande_id", "numero_ligne"],
                       hot=hot_lines("produit_id"))
    return rows.select(*COLUMNS["lignes_commande"], *(fact.KEYS if dims is not None else []))


def first_order(ops: OperationalSource) -> int | None:
    """Lowest order number: the order a single-order run takes unless told otherwise."""
    return ops["commande"].agg(F.min("commande_id")).first()[0]


def dimension_tables(ops: OperationalSource, as_of: date) -> dict[str, DataFrame]:
    return {
        "geographie_full": geography(ops),
        "fournisseur_full": suppliers(ops),
        "canal": channels(ops),
        "produit_full": products(ops),
        "client_full": clients(ops),
        "employe_full": employees(ops, as_of),
    }


def all_tables(ops: OperationalSource, as_of: date, after: date | None = None,
               only: int | None = None) -> dict[str, DataFrame]:
    return {**dimension_tables(ops, as_of), "lignes_commande": order_lines(ops, after, only)}
