"""A hand-made operational model of a few rows."""

from datetime import date
from decimal import Decimal

from stardw.session import local_rows
from stardw.sources.operational import OperationalSource

SCHEMAS = {
    "continent": "continent_id int, nom_continent string",
    "pays": "pays_id int, code_pays string, nom_pays string, continent_id int",
    "region": "region_id int, nom_region string, pays_id int",
    "ville": "ville_id int, nom_ville string, code_postal string, region_id int",
    "org_pays": "org_pays_id int, nom_org_pays string",
    "org_compagnie": "org_compagnie_id int, nom_org_compagnie string, org_pays_id int",
    "org_departement": "org_departement_id int, nom_org_departement string, "
                       "org_compagnie_id int",
    "org_section": "org_section_id int, nom_org_section string, org_departement_id int",
    "org_groupe": "org_groupe_id int, nom_org_groupe string, org_section_id int",
    "employe": "employe_id bigint, nom string, prenom string, sexe string, "
               "date_naissance date, date_embauche date, date_depart date, "
               "salaire decimal(12,2), manager_id bigint, org_groupe_id int, "
               "maj_le timestamp_ntz",
    "contrat_employe": "contrat_id bigint, employe_id bigint, date_debut date, date_fin date, "
                       "type_contrat string",
    "fournisseur": "fournisseur_id int, nom_fournisseur string, pays_id int",
    "ligne_produit": "ligne_produit_id int, nom_ligne_produit string",
    "categorie_produit": "categorie_produit_id int, nom_categorie_produit string, "
                         "ligne_produit_id int",
    "groupe_produit": "groupe_produit_id int, nom_groupe_produit string, "
                      "categorie_produit_id int",
    "produit": "produit_id bigint, nom_produit string, groupe_produit_id int, "
               "fournisseur_id int, actif boolean",
    "historique_prix": "prix_id bigint, produit_id bigint, date_debut date, date_fin date, "
                       "cout decimal(12,2), prix_vente decimal(12,2)",
    "remise_produit": "remise_id bigint, produit_id bigint, date_debut date, date_fin date, "
                      "pct_remise decimal(5,4)",
    "groupe_client": "groupe_client_id int, nom_groupe_client string",
    "client": "client_id bigint, nom string, prenom string, sexe string, date_naissance date, "
              "groupe_client_id int, ville_id int, actif boolean, maj_le timestamp_ntz",
    "carte_fidelite": "carte_fidelite_id bigint, client_id bigint, numero_carte string",
    "canal_vente": "canal_id smallint, code_canal string, nom_canal string",
    "commande": "commande_id bigint, date_commande date, client_id bigint, employe_id bigint, "
                "canal_id smallint",
    "ligne_commande": "commande_id bigint, numero_ligne int, produit_id bigint, "
                      "quantite decimal(12,3), prix_unitaire decimal(12,2), "
                      "cout_unitaire decimal(12,2), pct_remise decimal(5,4)",
}


def D(text):
    return Decimal(text)


def base_rows():
    born = date(1970, 5, 1)
    return {
        "continent": [(1, "Europe")],
        "pays": [(1, "FR", "France", 1), (2, "BE", "Belgique", 1)],
        "region": [(1, "Nord", 1), (2, "Wallonie", 2)],
        "ville": [(1, "Lille", "59000", 1), (2, "Namur", None, 2)],
        "org_pays": [(1, "France")],
        "org_compagnie": [(1, "Compagnie France", 1)],
        "org_departement": [(1, "Ventes", 1), (2, "Finance", 1)],
        "org_section": [(1, "Section Ventes", 1), (2, "Section Finance", 2)],
        "org_groupe": [(1, "Groupe A — Section Ventes", 1), (2, "Groupe A — Section Finance", 2)],
        "employe": [
            (1, "Petit", "Anne", "F", born, date(1990, 1, 1), None, D("60000.00"), None, 1, None),
            (2, "Grand", "Marc", "M", born, date(1991, 1, 1), None, D("29999.99"), 1, 1, None),
            (3, "Blanc", "Lou", "F", born, date(1992, 1, 1), None, D("120000.00"), 1, 2, None),
            (4, "Noir", "Max", "M", born, date(1993, 1, 1), None, D("30000.00"), 1, 1, None)],
        "contrat_employe": [
            (1, 1, date(1990, 1, 1), None, "CDI"),                    # open, older …
            (2, 1, date(1995, 1, 1), date(1996, 1, 1), "CDD"),        # … beats closed, newer
            (3, 2, date(1991, 1, 1), date(1992, 1, 1), "CDD"),        # only past
            (4, 2, date(1993, 1, 1), date(1994, 1, 1), "Stage"),
            (5, 3, date(1992, 1, 1), date(2001, 12, 31), "CDD")],     # ends on the day
        "fournisseur": [(1, "Alpha", 1), (2, "Beta", 2)],
        "ligne_produit": [(1, "Plein air")],
        "categorie_produit": [(1, "Camping", 1)],
        "groupe_produit": [(1, "Entrée — Camping", 1), (2, "Premium — Camping", 1)],
        "produit": [(10, "Tente", 1, 1, True), (20, "Sac", 2, 2, True), (30, "Lampe", 2, 2, False)],
        "historique_prix": [
            (1, 10, date(1998, 1, 1), date(1998, 12, 31), D("5.00"), D("9.00")),
            (2, 10, date(1999, 1, 1), None, D("6.00"), D("11.00")),
            (3, 20, date(1998, 6, 1), date(1998, 6, 30), D("1.00"), D("2.00"))],
        "remise_produit": [
            (1, 10, date(1998, 3, 1), date(1998, 3, 31), D("0.1000")),
            (2, 10, date(1998, 3, 15), date(1998, 4, 15), D("0.2000"))],
        "groupe_client": [(1, "Bronze"), (2, "Or")],
        "client": [
            (100, "Durand", "Eva", "F", date(1977, 1, 1), 1, 1, True, None),
            (200, "Morel", "Jean", "M", None, None, 2, True, None),
            (300, "Roux", "Lise", None, date(1950, 1, 1), 2, 1, True, None)],
        "carte_fidelite": [(1, 100, "OSC-00000001")],
        "canal_vente": [(1, "MAGASIN", "Magasin physique"), (3, "INTERNET", "Vente en ligne")],
        "commande": [
            (1, date(1998, 3, 20), 100, 1, 1), (2, date(1999, 1, 1), 200, 2, 3),
            (3, date(2000, 12, 31), 300, 3, 1), (4, date(2000, 12, 31), 100, 2, 3)],
        "ligne_commande": [
            (1, 1, 10, D("3.000"), D("10.55"), D("7.01"), D("0.0750")),
            (1, 2, 20, D("1.000"), D("20.00"), D("10.00"), D("0.0000")),
            (2, 1, 10, D("2.000"), D("11.00"), D("6.00"), D("0.0000")),
            (3, 1, 30, D("5.000"), D("4.00"), D("1.00"), D("0.5000")),
            (4, 1, 20, D("1.000"), D("8.00"), D("3.00"), D("0.0000"))],
    }


def source(spark, **changes):
    """The model, with some tables replaced; plain rows or DataFrames."""
    rows = {**base_rows(), **changes}
    return OperationalSource({
        name: local_rows(spark, made, SCHEMAS[name]) if isinstance(made, list) else made
        for name, made in rows.items()})
