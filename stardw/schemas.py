"""Declared schemas of the warehouse and of its run tables. Nothing is inferred on a read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_HISTORY = "effectif_du date, effectif_au date, est_courant boolean, hash_ligne string"

DDL = {
    "dim_date": "cle_date int, date_complete date, jour_du_mois int, numero_mois int, "
                "nom_mois string, numero_trimestre int, annee int, jour_de_semaine int, "
                "nom_jour string, semaine_annee int, est_weekend boolean, saison string",
    "dim_canal": "cle_canal smallint, canal_id smallint, code_canal string, nom_canal string",
    "dim_geographie": "cle_geographie bigint, ville_id int, nom_ville string, "
                      "nom_region string, code_pays string, nom_pays string, "
                      "nom_continent string, code_postal string",
    "dim_fournisseur": "cle_fournisseur bigint, fournisseur_id bigint, "
                       "nom_fournisseur string, nom_pays string, nom_continent string",
    "dim_produit": "cle_produit bigint, produit_id bigint, nom_produit string, "
                   "nom_groupe_produit string, nom_categorie_produit string, "
                   "nom_ligne_produit string, fournisseur_id_naturel bigint, "
                   "nom_fournisseur string, actif boolean",
    "dim_client": "cle_client bigint, client_id bigint, nom_complet string, sexe string, "
                  "tranche_age string, groupe_client string, a_carte_fidelite boolean, "
                  "nom_ville string, nom_pays string, nom_continent string, " + _HISTORY,
    "dim_employe": "cle_employe bigint, employe_id bigint, nom_complet string, sexe string, "
                   "tranche_age string, salaire decimal(12,2), tranche_salaire string, "
                   "org_pays string, org_compagnie string, org_departement string, "
                   "org_section string, org_groupe string, nom_manager string, "
                   "date_embauche date, date_depart date, type_contrat_courant string, "
                   "date_debut_contrat date, date_fin_contrat date, statut_contrat string, "
                   "nb_contrats_signes int, " + _HISTORY,
    "fait_ventes": "cle_date int, cle_produit bigint, cle_client bigint, cle_employe bigint, "
                   "cle_fournisseur bigint, cle_canal smallint, cle_geographie_client bigint, "
                   "commande_id bigint, numero_ligne int, quantite decimal(12,3), "
                   "prix_unitaire decimal(12,2), cout_unitaire decimal(12,2), "
                   "pct_remise decimal(5,4), montant_brut decimal(14,2), "
                   "montant_remise decimal(14,2), montant_net decimal(14,2), "
                   "montant_cout decimal(14,2), montant_marge decimal(14,2), mois_cle int",
    "lignes_commande": "commande_id bigint, numero_ligne int, date_commande date, "
                       "client_id bigint, employe_id bigint, canal_id bigint, "
                       "produit_id bigint, fournisseur_id bigint, cli_ville_id bigint, "
                       "quantite decimal(12,3), prix_unitaire decimal(12,2), "
                       "cout_unitaire decimal(12,2), pct_remise decimal(5,4)",
    "watermark": "job_name string, last_value timestamp_ntz, updated_at timestamp_ntz",
    "run_log": "run_id bigint, job_name string, started_at timestamp_ntz, "
               "ended_at timestamp_ntz, status string, rows_in bigint, rows_out bigint, "
               "error_msg string",
}


def schema_of(table: str) -> T.StructType:
    return T.StructType.fromDDL(DDL[table])


def conform(df: DataFrame, table: str) -> DataFrame:
    """The declared columns in their declared order and types; a value that does not fit fails."""
    return df.to(schema_of(table))
