"""SQL counterparts of the registered queries, for an independent engine (DuckDB) to run.

They start from the same raw tables and share no code with the Spark side. Named building blocks
become common table expressions; each statement lists only the blocks it needs.
"""

from __future__ import annotations

import re

# --- the operational model -----------------------------------------------------------------------

BLOCKS = {
    "ops_continent": "select r_regionkey continent_id, r_name nom_continent from region",
    "ops_pays": """
        select n_nationkey pays_id, lpad(cast(n_nationkey as varchar), 2, '0') code_pays,
               n_name nom_pays, n_regionkey continent_id
        from nation""",
    "ops_region": """
        select n_nationkey * 2 + k region_id, n_name || '-R' || k nom_region,
               n_nationkey pays_id
        from nation cross join (values (0), (1)) t(k)""",
    "ops_ville": """
        select region_id * 2 + k ville_id, 'V' || (region_id * 2 + k) nom_ville,
               case when (region_id * 2 + k) % 7 = 0 then null
                    else lpad(cast(region_id * 2 + k as varchar), 5, '0') end code_postal,
               region_id
        from ops_region cross join (values (0), (1)) t(k)""",
    "ops_groupe_client": """
        select row_number() over (order by c_mktsegment) groupe_client_id,
               c_mktsegment nom_groupe_client
        from (select distinct c_mktsegment from customer where c_mktsegment is not null) x""",
    "ops_client": """
        select c_custkey client_id, 'Client' nom, c_name prenom,
               case when c_custkey % 11 = 0 then null when c_custkey % 2 = 0 then 'F'
                    else 'M' end sexe,
               case when c_custkey % 13 = 0 then null
                    else make_date(1940 + c_custkey % 60, 1 + c_custkey % 12,
                                   1 + c_custkey % 28) end date_naissance,
               case when c_custkey % 17 = 0 then null else g.groupe_client_id
                    end groupe_client_id,
               c_nationkey * 4 + c_custkey % 4 ville_id, c_custkey % 20 <> 0 actif,
               cast(date '1995-01-01' + cast(c_custkey % 1000 as int) as timestamp) maj_le
        from customer left join ops_groupe_client g on g.nom_groupe_client = c_mktsegment""",
    "ops_carte_fidelite": """
        select c_custkey carte_fidelite_id, c_custkey client_id
        from customer where c_custkey % 4 = 0""",
    "ops_fournisseur": """
        select s_suppkey fournisseur_id, s_name nom_fournisseur, s_nationkey pays_id
        from supplier""",
    "ops_ligne_produit": """
        select row_number() over (order by p_type) ligne_produit_id, p_type nom_ligne_produit
        from (select distinct p_type from part where p_type is not null) x""",
    "ops_categorie_produit": """
        select ligne_produit_id * 4 + k categorie_produit_id,
               nom_ligne_produit || '-' || k nom_categorie_produit, ligne_produit_id
        from ops_ligne_produit cross join (values (0), (1), (2), (3)) t(k)""",
    "ops_groupe_produit": """
        select categorie_produit_id * 2 + k groupe_produit_id,
               case when k = 0 then 'Entrée' else 'Premium' end || ' — '
                 || nom_categorie_produit nom_groupe_produit,
               categorie_produit_id
        from ops_categorie_produit cross join (values (0), (1)) t(k)""",
    "ops_produit": """
        select p_partkey produit_id, p_name || ' ' || p_partkey nom_produit,
               (l.ligne_produit_id * 4 + p_size % 4) * 2
                 + case when p_retailprice >= 950 then 1 else 0 end groupe_produit_id,
               p_partkey % (select count(*) from supplier) fournisseur_id,
               p_partkey % 50 <> 0 actif
        from part left join ops_ligne_produit l on l.nom_ligne_produit = p_type""",
    "ops_historique_prix": """
        select p_partkey * 3 + k prix_id, p_partkey produit_id, cast(d0 as date) date_debut,
               cast(d1 as date) date_fin,
               cast(cast(p_retailprice as decimal(12,2))
                    * cast(40 + p_partkey % 37 + 5 * k as decimal(3,0)) * 0.01
                    as decimal(12,2)) cout,
               cast(cast(p_retailprice as decimal(12,2))
                    * cast(100 + 10 * k as decimal(3,0)) * 0.01 as decimal(12,2)) prix_vente
        from part cross join (values (0, '1995-01-01', '1996-12-31'),
                                     (1, '1997-01-01', '1998-12-31'),
                                     (2, '1999-01-01', null)) t(k, d0, d1)
        where not (p_partkey % 40 = 0 and k = 0)""",
    "ops_remise_produit": """
        select p_partkey * 2 + k remise_id, p_partkey produit_id, cast(d0 as date) date_debut,
               cast(d1 as date) date_fin,
               cast(cast(5 + p_partkey % 20 + k as decimal(3,0)) * 0.01 as decimal(5,4))
                 pct_remise
        from part cross join (values (0, '1996-03-01', '1996-05-31'),
                                     (1, '1996-05-01', '1997-06-30')) t(k, d0, d1)
        where p_partkey % 10 < 3""",
    "ops_organisation": """
        select (c.r_regionkey * 6 + d.k) * 2 + g.k org_groupe_id, c.r_name org_pays,
               'Compagnie ' || c.r_name org_compagnie, d.nom org_departement,
               'Section ' || d.nom org_section, g.nom || 'Section ' || d.nom org_groupe
        from region c
        cross join (values (0, 'Ventes'), (1, 'Marketing'), (2, 'Finance'),
                           (3, 'Informatique'), (4, 'Ressources Humaines'),
                           (5, 'Logistique')) d(k, nom)
        cross join (values (0, 'Groupe A — '), (1, 'Groupe B — ')) g(k, nom)""",
    "ops_org_pays": "select r_regionkey org_pays_id from region",
    "ops_org_compagnie": "select r_regionkey org_compagnie_id, r_regionkey org_pays_id from region",
    "ops_org_departement": """
        select r_regionkey * 6 + k org_departement_id, r_regionkey org_compagnie_id
        from region cross join range(6) t(k)""",
    "ops_org_section": """
        select org_departement_id org_section_id, org_departement_id from ops_org_departement""",
    "ops_org_groupe": """
        select org_section_id * 2 + k org_groupe_id, org_section_id
        from ops_org_section cross join range(2) t(k)""",
    "ops_employe": """
        select e employe_id, 'Emp' nom, 'E' || e prenom,
               case when e % 2 = 0 then 'F' else 'M' end sexe,
               make_date(1945 + e % 40, 6, 15) date_naissance,
               make_date(1985 + e % 10, 1, 1) date_embauche,
               case when e % 23 = 0 then date '1999-12-31' end date_depart,
               cast(25000 + (e * 7919) % 110000 as decimal(12,2)) salaire,
               case when e % 5 = 0 then null else e - e % 5 end manager_id,
               ((e % 5) * 6 + case when e % 10 < 8 then 0 else 2 end) * 2
                 + case when e % 3 = 0 then 0 else 1 end org_groupe_id,
               cast(date '1995-01-01' + cast(e % 1000 as int) as timestamp) maj_le
        from (select distinct o_orderkey % (select 70 + count(*) // 20000 from orders) e
              from orders) x""",
    "ops_contrat_employe": """
        select employe_id * 3 + k contrat_id, employe_id, cast(d0 as date) date_debut,
               cast(d1 as date) date_fin, ty type_contrat
        from ops_employe
        cross join (values (0, '1995-01-01', '1996-12-31', 'CDD'),
                           (1, '1997-01-01', '1999-06-30', 'CDD'),
                           (2, '1999-07-01', null, 'CDI')) t(k, d0, d1, ty)
        where employe_id % 7 <> 0 and (employe_id % 3 <> 0 or k < 2)""",
    "ops_canal_vente": """
        select canal_id, code_canal, nom_canal
        from (values (1, 'MAGASIN', 'Magasin physique'), (2, 'CATALOGUE', 'Vente par catalogue'),
                     (3, 'INTERNET', 'Vente en ligne')) t(canal_id, code_canal, nom_canal)
        where canal_id in (select 1 + o_orderkey % 3 from orders)""",
    "ops_commande": """
        select o_orderkey commande_id, cast(o_orderdate as date) date_commande,
               o_custkey client_id,
               o_orderkey % (select 70 + count(*) // 20000 from orders) employe_id, 1 + o_orderkey % 3 canal_id
        from orders""",
    "ops_ligne_commande": """
        select commande_id, numero_ligne, produit_id, quantite, prix_unitaire,
               cast(prix_unitaire * cast(40 + produit_id % 37 as decimal(3,0)) * 0.01
                    as decimal(12,2)) cout_unitaire, pct_remise
        from (select l_orderkey commande_id, numero_ligne, l_partkey produit_id, quantite,
                     cast(cast((ec - ec % qi) / qi as bigint) * 0.01 as decimal(12,2))
                       prix_unitaire, pct_remise
              from (select l_orderkey, l_partkey,
                           cast(row_number() over (
                             partition by l_orderkey
                             order by l_linenumber, l_partkey, l_suppkey, l_extendedprice,
                                      l_quantity, l_discount, l_tax, l_returnflag,
                                      l_linestatus, l_shipdate) as int) numero_ligne,
                           cast(l_quantity as decimal(12,3)) quantite,
                           cast(l_quantity as bigint) qi,
                           cast(cast(l_extendedprice as decimal(12,2)) * 100 as bigint) ec,
                           cast(l_discount as decimal(5,4)) pct_remise
                    from lineitem) a) b""",
    "client_lot1": "select * from ops_client where client_id % 25 <> 9",
    "client_lot2": """
        select * replace (case when client_id % 10 = 3 then 1 else groupe_client_id end
                          as groupe_client_id)
        from ops_client where client_id % 25 <> 7""",
    "employe_lot1": "select * from ops_employe where employe_id % 25 <> 9",
    "employe_lot2": """
        select * replace (case when employe_id % 10 = 3 then salaire + 10000 else salaire end
                          as salaire)
        from ops_employe where employe_id % 25 <> 7""",
}

# --- staging -------------------------------------------------------------------------------------

BLOCKS.update({
    "stg_geographie": """
        select ville_id, nom_ville, code_postal, nom_region, code_pays, nom_pays, nom_continent
        from ops_ville join ops_region using (region_id) join ops_pays using (pays_id)
        join ops_continent using (continent_id)""",
    "stg_fournisseur": """
        select fournisseur_id, nom_fournisseur, nom_pays, nom_continent
        from ops_fournisseur join ops_pays using (pays_id)
        join ops_continent using (continent_id)""",
    "stg_produit": """
        select produit_id, nom_produit, nom_groupe_produit, nom_categorie_produit,
               nom_ligne_produit, fournisseur_id fournisseur_id_naturel, nom_fournisseur, actif
        from ops_produit left join ops_groupe_produit using (groupe_produit_id)
        left join ops_categorie_produit using (categorie_produit_id)
        left join ops_ligne_produit using (ligne_produit_id)
        join ops_fournisseur using (fournisseur_id)""",
    "stg_lignes": """
        select o.commande_id, l.numero_ligne, o.date_commande, o.client_id, o.employe_id,
               o.canal_id, l.produit_id, p.fournisseur_id, c.ville_id cli_ville_id, l.quantite,
               l.prix_unitaire, l.cout_unitaire, l.pct_remise
        from ops_commande o join ops_ligne_commande l on l.commande_id = o.commande_id
        join ops_produit p on p.produit_id = l.produit_id
        join ops_client c on c.client_id = o.client_id""",
})


def _clients(table: str) -> str:
    return f"""
        select c.client_id, left(c.nom || ' ' || c.prenom, 160) nom_complet, c.sexe,
               c.date_naissance, g.nom_groupe_client groupe_client,
               cf.carte_fidelite_id is not null a_carte_fidelite, v.nom_ville, v.nom_pays,
               v.nom_continent, c.maj_le
        from {table} c
        left join ops_groupe_client g on g.groupe_client_id = c.groupe_client_id
        left join ops_carte_fidelite cf on cf.client_id = c.client_id
        join stg_geographie v on v.ville_id = c.ville_id"""


def _employees(table: str, as_of: str) -> str:
    return f"""
        select e.employe_id, left(e.nom || ' ' || e.prenom, 160) nom_complet, e.sexe,
               e.date_naissance, e.salaire, o.org_pays, o.org_compagnie, o.org_departement,
               o.org_section, o.org_groupe, left(m.nom || ' ' || m.prenom, 160) nom_manager,
               e.date_embauche, e.date_depart, cc.type_contrat type_contrat_courant,
               cc.date_debut date_debut_contrat, cc.date_fin date_fin_contrat,
               case when cc.contrat_id is null then 'SansContrat'
                    when cc.date_fin is null or cc.date_fin >= date '{as_of}' then 'Actif'
                    else 'Expire' end statut_contrat,
               (select count(*) from ops_contrat_employe ce
                where ce.employe_id = e.employe_id) nb_contrats_signes,
               e.maj_le
        from {table} e
        join ops_organisation o on o.org_groupe_id = e.org_groupe_id
        left join {table} m on m.employe_id = e.manager_id
        left join lateral (
            select contrat_id, type_contrat, date_debut, date_fin from ops_contrat_employe ce
            where ce.employe_id = e.employe_id
            order by (date_fin is null) desc, date_debut desc limit 1) cc on true"""


def _age(birth: str, as_of: str) -> str:
    age = f"(year(date '{as_of}') - year({birth}))"
    return (f"case when {birth} is null then 'inconnu' when {age} < 25 then '<25' "
            f"when {age} < 35 then '25-34' when {age} < 45 then '35-44' "
            f"when {age} < 55 then '45-54' when {age} < 65 then '55-64' else '>=65' end")


SALARY = ("case when salaire < 30000 then '<30k' when salaire < 50000 then '30-50k' "
          "when salaire < 80000 then '50-80k' when salaire < 120000 then '80-120k' "
          "else '>=120k' end")


def _client_versions(staged: str, as_of: str) -> str:
    return f"""
        select *, sha256(concat_ws('|', coalesce(nom_complet, ''), coalesce(sexe, ''),
                  tranche_age, coalesce(groupe_client, ''),
                  cast(cast(a_carte_fidelite as int) as varchar), coalesce(nom_ville, ''),
                  coalesce(nom_pays, ''), coalesce(nom_continent, ''))) hash_ligne
        from (select *, {_age('date_naissance', as_of)} tranche_age from {staged}) x"""


EMPLOYEE_FIELDS = ["nom_complet", "sexe", "tranche_age", "salaire", "tranche_salaire",
                   "org_pays", "org_compagnie", "org_departement", "org_section", "org_groupe",
                   "nom_manager", "date_embauche", "date_depart", "type_contrat_courant",
                   "date_debut_contrat", "date_fin_contrat", "statut_contrat",
                   "nb_contrats_signes"]


def _employee_versions(staged: str, as_of: str) -> str:
    fields = ", ".join(f"coalesce(cast({f} as varchar), '')" for f in EMPLOYEE_FIELDS)
    return f"""
        select *, sha256(concat_ws('|', {fields})) hash_ligne
        from (select *, {_age('date_naissance', as_of)} tranche_age, {SALARY} tranche_salaire
              from {staged}) x"""


def _history(first: str, second: str, natural: str, cle: str, fields: list[str], day1: str,
             day2: str) -> str:
    """Versions after two loads, written as one statement over both batches."""
    cols1 = ", ".join(f"a.{f}" for f in fields)
    cols2 = ", ".join(f"b.{f}" for f in fields)
    return f"""
        select a.{cle}, a.{natural}, {cols1}, date '{day1}' effectif_du,
               case when b.hash_ligne <> a.hash_ligne then date '{day2}' end effectif_au,
               coalesce(b.hash_ligne = a.hash_ligne, true) est_courant, a.hash_ligne
        from (select *, row_number() over (order by {natural}) {cle} from {first}) a
        left join {second} b using ({natural})
        union all
        select (select count(*) from {first}) + row_number() over (order by b.{natural}),
               b.{natural}, {cols2}, date '{day2}', null, true, b.hash_ligne
        from {second} b left join {first} a using ({natural})
        where a.hash_ligne is null or a.hash_ligne <> b.hash_ligne"""


CLIENT_FIELDS = ["nom_complet", "sexe", "tranche_age", "groupe_client", "a_carte_fidelite",
                 "nom_ville", "nom_pays", "nom_continent"]

BLOCKS.update({
    "stg_client": _clients("ops_client"),
    "stg_employe": _employees("ops_employe", "2001-12-31"),
    "stg_client1": _clients("client_lot1"),
    "stg_client2": _clients("client_lot2"),
    "stg_employe1": _employees("employe_lot1", "2001-12-31"),
    "stg_employe2": _employees("employe_lot2", "2002-01-31"),
    "v_client": _client_versions("stg_client", "2001-12-31"),
    "v_client1": _client_versions("stg_client1", "2001-12-31"),
    "v_client2": _client_versions("stg_client2", "2002-01-31"),
    "early_client1": _client_versions("stg_client1", "1996-01-01"),
    "early_client2": _client_versions("stg_client2", "1998-06-30"),
    "v_employe": _employee_versions("stg_employe", "2001-12-31"),
    "v_employe1": _employee_versions("stg_employe1", "2001-12-31"),
    "v_employe2": _employee_versions("stg_employe2", "2002-01-31"),
    "h_client": _history("v_client1", "v_client2", "client_id", "cle_client", CLIENT_FIELDS,
                         "2001-12-31", "2002-01-31"),
    "h_early": _history("early_client1", "early_client2", "client_id", "cle_client",
                        CLIENT_FIELDS, "1996-01-01", "1998-06-30"),
    "h_employe": _history("v_employe1", "v_employe2", "employe_id", "cle_employe",
                          EMPLOYEE_FIELDS, "2001-12-31", "2002-01-31"),
})

# --- the fact ------------------------------------------------------------------------------------

BLOCKS.update({
    "mesures": """
        select *, year(date_commande) * 10000 + month(date_commande) * 100
                  + day(date_commande) cle_date,
               cast(quantite * prix_unitaire as decimal(14,2)) montant_brut,
               cast(quantite * prix_unitaire * pct_remise as decimal(14,2)) montant_remise,
               cast(quantite * prix_unitaire * (cast(1 as decimal(5,4)) - pct_remise)
                    as decimal(14,2)) montant_net,
               cast(quantite * cout_unitaire as decimal(14,2)) montant_cout,
               cast(quantite * prix_unitaire * (cast(1 as decimal(5,4)) - pct_remise)
                    - quantite * cout_unitaire as decimal(14,2)) montant_marge
        from stg_lignes""",
    "cles_produit": """select produit_id, row_number() over (order by produit_id) cle_produit
                       from ops_produit""",
    "cles_client": """select client_id, row_number() over (order by client_id) cle_client
                      from ops_client""",
    "cles_employe": """select employe_id, row_number() over (order by employe_id) cle_employe
                       from ops_employe""",
    "cles_fournisseur": """
        select fournisseur_id, row_number() over (order by fournisseur_id) cle_fournisseur
        from ops_fournisseur""",
    "cles_canal": """select canal_id, row_number() over (order by canal_id) cle_canal
                     from ops_canal_vente""",
    "cles_geo": """select ville_id cli_ville_id,
                          row_number() over (order by ville_id) cle_geographie_client
                   from ops_ville""",
    "fait": """
        select m.*, cle_produit, cle_client, cle_employe, cle_fournisseur, cle_canal,
               cle_geographie_client
        from mesures m join cles_produit using (produit_id) join cles_client using (client_id)
        join cles_employe using (employe_id) join cles_fournisseur using (fournisseur_id)
        join cles_canal using (canal_id) join cles_geo using (cli_ville_id)""",
    "jours": """
        select cast(j as date) j
        from (select min(o_orderdate) a, max(o_orderdate) b from orders) x,
             lateral (select unnest(generate_series(date_trunc('year', a),
                             date_trunc('year', b) + interval 1 year - interval 1 day,
                             interval 1 day)) j) y""",
    "d_date": """
        select year(j) * 10000 + month(j) * 100 + day(j) cle_date, j date_complete,
               day(j) jour_du_mois, month(j) numero_mois, monthname(j) nom_mois,
               quarter(j) numero_trimestre, year(j) annee, isodow(j) jour_de_semaine,
               dayname(j) nom_jour, week(j) semaine_annee, isodow(j) in (6, 7) est_weekend,
               case when month(j) in (12, 1, 2) then 'Hiver'
                    when month(j) in (3, 4, 5) then 'Printemps'
                    when month(j) in (6, 7, 8) then 'Été' else 'Automne' end saison
        from jours""",
})

_FACT_COLUMNS = """cle_date, cle_produit, cle_client, cle_employe, cle_fournisseur, cle_canal,
    cle_geographie_client, commande_id, numero_ligne, cast(quantite as double) quantite,
    cast(prix_unitaire as double) prix_unitaire, cast(cout_unitaire as double) cout_unitaire,
    cast(pct_remise as double) pct_remise, cast(montant_brut as double) montant_brut,
    cast(montant_remise as double) montant_remise, cast(montant_net as double) montant_net,
    cast(montant_cout as double) montant_cout, cast(montant_marge as double) montant_marge"""


def _money(expr: str, name: str) -> str:
    return f"cast({expr} as double) {name}"


def _orphans(check: str, child: str, key: str, parent: str, parent_key: str) -> str:
    return f"""select '{check}' controle, count(*) nb_lignes, count(distinct {key}) nb_cles
               from {child} where {key} is not null
               and {key} not in (select {parent_key} from {parent})"""


def _duplicates(check: str, table: str, key: str) -> str:
    return f"""select '{check}' controle, cast(coalesce(sum(n - 1), 0) as bigint) nb_lignes,
                      count(*) nb_cles
               from (select count(*) n from {table} group by {key} having count(*) > 1) x"""


def _rules(table: str, rules: dict[str, str]) -> str:
    return " union all ".join(
        f"select '{table}.{name}' controle, count(*) nb_lignes from ops_{table} where not ({rule})"
        for name, rule in rules.items())


def _faults(name: str, history: str, natural: str, cle: str) -> str:
    return f"""
        select '{name}' dimension, controle, cast(n as bigint) nb_lignes from (
          with s as (select *, lead(effectif_du) over (
                       partition by {natural} order by effectif_du, {cle}) nx from {history})
          select 'intervalles_non_contigus' controle, count(*) n from s
            where nx is not null and effectif_au is distinct from nx
          union all select 'fins_avant_debut', count(*) from s where effectif_au < effectif_du
          union all select 'courante_pas_derniere', count(*) from s
            where (nx is null) <> est_courant
          union all select 'plusieurs_courantes', coalesce(sum(c - 1), 0) from (
            select count(*) c from {history} where est_courant group by {natural}
            having count(*) > 1)
          union all select 'cle_en_double', coalesce(sum(c - 1), 0) from (
            select count(*) c from {history} group by {cle} having count(*) > 1)
          union all select 'versions', count(*) from {history}) t"""


_ETA_LEVELS = {"ligne_produit": "nom_ligne_produit",
               "categorie_produit": "nom_categorie_produit", "groupe_client": "groupe_client",
               "canal": "code_canal", "sexe_emp": "sexe_emp",
               "tranche_salaire_emp": "tranche_salaire_emp", "pays_client": "nom_pays"}

_ETA = " union all ".join(
    f"""select '{name}' variable, round((select sum(n * (m - mu) * (m - mu)) / max(st)
        from (select count(*) n, avg(x) m from eta_faits group by {level}) g, eta_total), 4)
        eta_carre""" for name, level in _ETA_LEVELS.items())

BLOCKS.update({
    "eta_faits": f"""
        select cast(f.montant_net as double) x, p.nom_ligne_produit, p.nom_categorie_produit,
               c.groupe_client, k.code_canal, e.sexe sexe_emp,
               {SALARY.replace('salaire <', 'e.salaire <')} tranche_salaire_emp, g.nom_pays
        from fait f join stg_produit p on p.produit_id = f.produit_id
        join stg_client c on c.client_id = f.client_id
        join ops_canal_vente k on k.canal_id = f.canal_id
        join ops_employe e on e.employe_id = f.employe_id
        join stg_geographie g on g.ville_id = f.cli_ville_id""",
    "eta_total": """
        select mu, (select sum((x - mu) * (x - mu)) from eta_faits) st
        from (select avg(x) mu from eta_faits) a""",
    "annuel": """
        select produit_id, year(date_commande) annee, sum(montant_net) ca
        from fait group by all""",
    "ca_employe": f"""
        select e.employe_id, e.nom_complet, e.org_pays, e.sexe,
               {_age('e.date_naissance', '2001-12-31')} tranche_age,
               {SALARY.replace('salaire <', 'e.salaire <')} tranche_salaire,
               e.type_contrat_courant, sum(f.montant_net) ca, sum(f.montant_marge) marge,
               count(*) lignes, count(distinct f.commande_id) nb_commandes
        from fait f join stg_employe e on e.employe_id = f.employe_id
        group by all""",
})

_DIM_COUNTS = {"dim_date": ("d_date", "min(cle_date)", "max(cle_date)"),
               "dim_canal": ("ops_canal_vente", "1", "count(*)"),
               "dim_geographie": ("ops_ville", "1", "count(*)"),
               "dim_fournisseur": ("ops_fournisseur", "1", "count(*)"),
               "dim_produit": ("ops_produit", "1", "count(*)"),
               "dim_client": ("ops_client", "1", "count(*)"),
               "dim_employe": ("ops_employe", "1", "count(*)"),
               "fait_ventes": ("fait", "min(cle_date)", "max(cle_date)")}

QUERIES = {
    "stage_canal": "select * from ops_canal_vente",
    "stage_geographie": "select * from stg_geographie",
    "stage_fournisseur": "select * from stg_fournisseur",
    "stage_produit": "select * from stg_produit",
    "stage_client": "select * replace (cast(maj_le as varchar) as maj_le) from stg_client",
    "stage_employe": """select * replace (cast(maj_le as varchar) as maj_le,
                        cast(salaire as double) as salaire) from stg_employe""",
    "stage_order_lines": """
        select * replace (cast(quantite as double) as quantite,
            cast(prix_unitaire as double) as prix_unitaire,
            cast(cout_unitaire as double) as cout_unitaire,
            cast(pct_remise as double) as pct_remise) from stg_lignes""",
    "incremental_lines": """
        select * replace (cast(quantite as double) as quantite,
            cast(prix_unitaire as double) as prix_unitaire,
            cast(cout_unitaire as double) as cout_unitaire,
            cast(pct_remise as double) as pct_remise) from stg_lignes
        where date_commande > date '1998-06-30'""",
    "current_contract": """
        select employe_id, type_contrat_courant, date_debut_contrat, date_fin_contrat,
               statut_contrat, nb_contrats_signes from stg_employe""",
    "dim_date": "select * from d_date",
    "dim_canal": "select row_number() over (order by canal_id) cle_canal, * from ops_canal_vente",
    "dim_geographie": """select row_number() over (order by ville_id) cle_geographie, *
                         from stg_geographie""",
    "dim_fournisseur": """select row_number() over (order by fournisseur_id) cle_fournisseur, *
                          from stg_fournisseur""",
    "dim_produit": """select row_number() over (order by produit_id) cle_produit, *
                      from stg_produit""",
    "surrogate_keys": """
        select produit_id, row_number() over (order by produit_id) cle_produit
        from ops_produit where actif
        union all
        select produit_id, (select count(*) from ops_produit where actif)
                           + row_number() over (order by produit_id)
        from ops_produit where not actif""",
    "scd2_client": "select * from h_client",
    "scd2_employe": "select * replace (cast(salaire as double) as salaire) from h_employe",
    "asof_client_version": """
        select c.commande_id, c.client_id, c.date_commande, h.cle_client, h.effectif_du,
               h.groupe_client, h.tranche_age
        from ops_commande c left join h_early h on h.client_id = c.client_id
         and h.effectif_du <= c.date_commande
         and (h.effectif_au is null or c.date_commande < h.effectif_au)""",
    "price_at_date": """
        select l.commande_id, l.numero_ligne, l.produit_id, o.date_commande,
               cast(coalesce(p.cout, 10) as double) cout,
               cast(coalesce(p.prix_vente, 20) as double) prix_vente
        from ops_ligne_commande l join ops_commande o on o.commande_id = l.commande_id
        left join ops_historique_prix p on p.produit_id = l.produit_id
         and p.date_debut <= o.date_commande
         and (p.date_fin is null or o.date_commande <= p.date_fin)""",
    "discount_at_date": """
        select l.commande_id, l.numero_ligne, l.produit_id, any_value(o.date_commande)
                 date_commande,
               cast(coalesce(arg_min(r.pct_remise, r.remise_id), 0) as double) pct_remise
        from ops_ligne_commande l join ops_commande o on o.commande_id = l.commande_id
        left join ops_remise_produit r on r.produit_id = l.produit_id
         and o.date_commande between r.date_debut and r.date_fin
        group by l.commande_id, l.numero_ligne, l.produit_id""",
    "order_total_rollup": """
        select c.commande_id, cast(coalesce(t.total, 0) as double) montant_total
        from ops_commande c left join (
          select commande_id, cast(sum(quantite * prix_unitaire
                   * (cast(1 as decimal(5,4)) - pct_remise)) as decimal(14,2)) total
          from ops_ligne_commande group by commande_id) t on t.commande_id = c.commande_id""",
    "order_total_batch": """
        select c.commande_id, case when c.commande_id % 5 = 0
                 then cast(coalesce(t.total, 0) as double) else 0.0::double end montant_total
        from ops_commande c left join (
          select commande_id, cast(sum(quantite * prix_unitaire
                   * (cast(1 as decimal(5,4)) - pct_remise)) as decimal(14,2)) total
          from ops_ligne_commande group by commande_id) t on t.commande_id = c.commande_id""",
    "sql_brackets": f"""
        select 'age' genre, {_age('date_naissance', '2001-12-31')} tranche, count(*) nb
        from ops_client group by all
        union all
        select 'salaire', {SALARY}, count(*) from ops_employe group by all""",
    "dim_date_growth": """
        select 0 etape, year(d) annee, count(*) nb_jours from (
          select unnest(generate_series(date_trunc('year', min(date_commande)),
                        date_trunc('year', max(date_commande)) + interval 1 year - interval 1 day,
                        interval 1 day)) d
          from ops_commande where date_commande <= date '1996-06-30') x group by all
        union all
        select 1, year(d), count(*) from (
          select unnest(generate_series(date_trunc('year', min(date_commande)),
                        date_trunc('year', max(date_commande)) + interval 1 year - interval 1 day,
                        interval 1 day)) d
          from ops_commande where date_commande <= date '1996-06-30') x group by all
        union all
        select 2, annee, count(*) from d_date group by all""",
    "sales_staff_semi": """
        select employe_id, count(*) nb_commandes from ops_commande
        where employe_id in (
          select employe_id from ops_employe where org_groupe_id in (
            select org_groupe_id from ops_organisation where org_departement = 'Ventes'))
        group by employe_id""",
    "insert_if_absent": """
        select client_id, groupe_client_id, ville_id from client_lot1
        union all
        select client_id, groupe_client_id, ville_id from client_lot2
        where client_id not in (select client_id from client_lot1)""",
    "org_tree_expand": """
        select o.*, (select count(*) from ops_employe e
                     where e.org_groupe_id = o.org_groupe_id) nb_employes
        from ops_organisation o""",
    "product_tree_expand": """
        select g.groupe_produit_id, g.nom_groupe_produit, c.nom_categorie_produit,
               l.nom_ligne_produit, (select count(*) from ops_produit p
                 where p.groupe_produit_id = g.groupe_produit_id) nb_produits
        from ops_groupe_produit g join ops_categorie_produit c using (categorie_produit_id)
        join ops_ligne_produit l using (ligne_produit_id)""",
    "price_view": """select produit_id, date_debut, date_fin, cast(cout as double) cout,
                            cast(prix_vente as double) prix_vente from ops_historique_prix""",
    "bulk_text_lines": r"""
        select client_id || chr(9) || nom || chr(9) || prenom || chr(9) || coalesce(sexe, '\N')
               || chr(9) || coalesce(cast(date_naissance as varchar), '\N') || chr(9)
               || coalesce(cast(groupe_client_id as varchar), '\N') ligne
        from ops_client""",
    "age_salary_brackets": f"""
        select 'age' genre, {_age('date_naissance', '2001-12-31')} tranche, count(*) nb
        from ops_client group by all
        union all
        select 'salaire', {SALARY}, count(*) from ops_employe group by all""",
    "scalar_string_ops": r"""
        select client_id, left(nom || ' ' || prenom, 20) nom_coupe,
               cast(right(prenom, 9) as int) numero,
               'OSC-' || lpad(cast(client_id as varchar), 8, '0') numero_carte,
               prenom || ' ' || nom || '\\ ' texte_brut,
               sha256(coalesce(sexe, '') || '|' || prenom) hash_nom,
               sexe || '-' || prenom sexe_nom
        from ops_client""",
    "scalar_date_ops": """
        select commande_id, year(date_commande) * 10000 + month(date_commande) * 100
                 + day(date_commande) cle_date,
               cast(date_commande + interval 1 day as date) lendemain,
               year(date_commande) - (1945 + commande_id % 40) ecart_annees,
               date_diff('second', timestamp '1995-01-01 00:00:00',
                         date_commande + interval 12 hour) ecart_secondes,
               isodow(date_commande) jour_de_semaine, week(date_commande) semaine_annee,
               dayname(date_commande) nom_jour,
               case when month(date_commande) in (12, 1, 2) then 'Hiver'
                    when month(date_commande) in (3, 4, 5) then 'Printemps'
                    when month(date_commande) in (6, 7, 8) then 'Été' else 'Automne' end saison
        from ops_commande""",
    "scalar_math_ops": """
        select commande_id, numero_ligne, round(sqrt(cast(quantite as double)), 6) racine,
               pow(cast(quantite as double), 2) carre, produit_id % 7 reste,
               cast(round(prix_unitaire, 1) as double) prix_arrondi,
               cast(round(100 * pct_remise / nullif(pct_remise, 0), 2) as double) rapport,
               cast(montant_brut as double) montant_brut,
               cast(montant_remise as double) montant_remise,
               cast(montant_net as double) montant_net,
               cast(montant_cout as double) montant_cout,
               cast(montant_marge as double) montant_marge
        from mesures""",
    "dq_ranges": " union all ".join([
        _rules("client", {"sexe": "sexe in ('M', 'F')"}),
        _rules("employe", {"sexe": "sexe in ('M', 'F')", "salaire": "salaire >= 0"}),
        _rules("contrat_employe", {
            "type_contrat": "type_contrat in ('CDI', 'CDD', 'Interim', 'Stage', 'Alternance', "
                            "'Freelance')",
            "dates": "date_fin is null or date_fin >= date_debut"}),
        _rules("historique_prix", {"cout": "cout >= 0", "prix_vente": "prix_vente >= 0",
                                   "dates": "date_fin is null or date_fin >= date_debut"}),
        _rules("remise_produit", {"pct_remise": "pct_remise between 0 and 1",
                                  "dates": "date_fin >= date_debut"}),
        _rules("ligne_commande", {"quantite": "quantite > 0",
                                  "prix_unitaire": "prix_unitaire >= 0",
                                  "cout_unitaire": "cout_unitaire >= 0",
                                  "pct_remise": "pct_remise between 0 and 1"})]),
    "dq_scd2": _faults("client", "h_client", "client_id", "cle_client") + " union all "
               + _faults("employe", "h_employe", "employe_id", "cle_employe"),
    "fact_sales": f"select {_FACT_COLUMNS}, cle_date // 100 mois_cle from fait",
    "fact_rejects": """
        select 'dim_client' dimension, count(*) nb_lignes from mesures
        where client_id not in (select client_id from stg_client where groupe_client is not null)
        union all
        select 'dim_produit', count(*) from mesures
        where produit_id not in (select produit_id from stg_produit where actif)""",
    "fact_reload_idempotent": """
        select cle_date, count(*) nb_lignes,
               cast(sum(q) as double) quantite,
               cast(sum(cast(q * prix_unitaire * (cast(1 as decimal(5,4)) - pct_remise)
                             as decimal(14,2))) as double) montant_net
        from (select *, cast(quantite + case when date_commande > date '1998-06-30' then 1
                                             else 0 end as decimal(12,3)) q from fait
              where not (date_commande > date '1998-06-30' and produit_id % 50 = 0)) x
        group by cle_date""",
    "watermark_after_load": """
        select 'fait_ventes' job_name, max(date_commande) last_value from stg_lignes""",
    "single_order_trace": f"""
        select {_FACT_COLUMNS} from fait
        where commande_id = (select min(commande_id) from ops_commande)""",
    "stream_fact_load": """
        select cle_date // 100 mois_cle, count(*) nb_lignes,
               cast(sum(montant_net) as double) montant_net,
               cast(sum(montant_marge) as double) montant_marge
        from fait group by cle_date // 100""",
    "dq_orphans": " union all ".join([
        _orphans("fait_ventes.cle_date", "fait", "cle_date", "d_date", "cle_date"),
        *[_orphans(f"fait_ventes.{cle}", "fait", cle, block, cle) for cle, block in [
            ("cle_canal", "cles_canal"), ("cle_geographie_client", "cles_geo"),
            ("cle_employe", "cles_employe"), ("cle_fournisseur", "cles_fournisseur"),
            ("cle_produit", "cles_produit"), ("cle_client", "cles_client")]],
        _orphans("ligne_commande.commande_id", "ops_ligne_commande", "commande_id",
                 "ops_commande", "commande_id"),
        _orphans("ligne_commande.produit_id", "ops_ligne_commande", "produit_id",
                 "ops_produit", "produit_id"),
        _orphans("commande.client_id", "ops_commande", "client_id", "ops_client", "client_id"),
        _orphans("commande.employe_id", "ops_commande", "employe_id", "ops_employe",
                 "employe_id"),
        _orphans("commande.canal_id", "ops_commande", "canal_id", "ops_canal_vente",
                 "canal_id"),
        _orphans("commande.client_id au premier lot", "ops_commande", "client_id",
                 "client_lot1", "client_id")]),
    "dq_model_orphans": " union all ".join([
        *[_orphans(f"{child}.{key}", f"ops_{child}", key, f"ops_{parent}", parent_key)
          for child, key, parent, parent_key in [
              ("pays", "continent_id", "continent", "continent_id"),
              ("region", "pays_id", "pays", "pays_id"),
              ("ville", "region_id", "region", "region_id"),
              ("org_compagnie", "org_pays_id", "org_pays", "org_pays_id"),
              ("org_departement", "org_compagnie_id", "org_compagnie", "org_compagnie_id"),
              ("org_section", "org_departement_id", "org_departement", "org_departement_id"),
              ("org_groupe", "org_section_id", "org_section", "org_section_id"),
              ("employe", "org_groupe_id", "org_groupe", "org_groupe_id"),
              ("employe", "manager_id", "employe", "employe_id"),
              ("contrat_employe", "employe_id", "employe", "employe_id"),
              ("fournisseur", "pays_id", "pays", "pays_id"),
              ("categorie_produit", "ligne_produit_id", "ligne_produit", "ligne_produit_id"),
              ("groupe_produit", "categorie_produit_id", "categorie_produit",
               "categorie_produit_id"),
              ("produit", "groupe_produit_id", "groupe_produit", "groupe_produit_id"),
              ("produit", "fournisseur_id", "fournisseur", "fournisseur_id"),
              ("historique_prix", "produit_id", "produit", "produit_id"),
              ("remise_produit", "produit_id", "produit", "produit_id"),
              ("client", "groupe_client_id", "groupe_client", "groupe_client_id"),
              ("client", "ville_id", "ville", "ville_id"),
              ("carte_fidelite", "client_id", "client", "client_id")]],
        _orphans("carte_fidelite.client_id au premier lot", "ops_carte_fidelite", "client_id",
                 "client_lot1", "client_id"),
        _orphans("contrat_employe.employe_id au premier lot", "ops_contrat_employe", "employe_id",
                 "(select employe_id from ops_employe where employe_id % 25 <> 9)",
                 "employe_id")]),
    "skipped_orders": """
        with marque as (select max(date_commande) jour from stg_lignes)
        select date_commande, count(*) nb_commandes,
               cast(any_value(jour) - date_commande as bigint) jours_avant_marque
        from ops_commande, marque
        where date_commande <= jour and commande_id not in (
          select commande_id from fait where commande_id % 11 <> 3)
        group by date_commande""",
    "dq_duplicates": " union all ".join([
        _duplicates("dim_date(cle_date)", "d_date", "cle_date"),
        _duplicates("dim_canal(canal_id)", "ops_canal_vente", "canal_id"),
        _duplicates("dim_geographie(ville_id)", "stg_geographie", "ville_id"),
        _duplicates("dim_fournisseur(fournisseur_id)", "stg_fournisseur", "fournisseur_id"),
        _duplicates("dim_produit(produit_id)", "stg_produit", "produit_id"),
        _duplicates("dim_client(client_id)", "stg_client", "client_id"),
        _duplicates("dim_employe(employe_id)", "stg_employe", "employe_id"),
        _duplicates("fait_ventes(commande_id, numero_ligne)", "fait",
                    "commande_id, numero_ligne"),
        _duplicates("lineitem(l_orderkey, l_linenumber)", "lineitem",
                    "l_orderkey, l_linenumber")]),
    "q1_best_sellers": f"""
        select produit_id, nom_produit, nom_groupe_produit,
               {_money('sum(quantite)', 'qte_totale')}, {_money('sum(montant_net)', 'ca')}
        from fait join stg_produit using (produit_id)
        group by produit_id, nom_produit, nom_groupe_produit
        order by sum(quantite) desc, produit_id limit 20""",
    "q2_declining_products": f"""
        select produit_id, nom_produit, annee, {_money('ca', 'ca')},
               {_money('prec', 'ca_precedent')}, {_money('ca - prec', 'delta_abs')},
               case when prec > 0 then round(100 * (ca - prec) / prec, 2) end delta_pct
        from (select *, lag(ca) over (partition by produit_id order by annee) prec
              from annuel) x join stg_produit using (produit_id)
        where prec is not null and ca < prec
        order by delta_pct nulls last, produit_id, annee limit 20""",
    "q3_marginal_products": f"""
        with base as (select produit_id, nom_produit, sum(montant_net) ca
                      from fait f join stg_produit using (produit_id)
                      join stg_geographie g on g.ville_id = f.cli_ville_id
                      where g.nom_pays = 'NATION_3' and year(date_commande) = 1998
                      group by all)
        select produit_id, nom_produit, {_money('ca', 'ca')},
               round(100 * ca / nullif((select sum(ca) from base), 0), 4) pct_ca
        from base where ca / nullif((select sum(ca) from base), 0) < 0.001""",
    "q4_group_margin": f"""
        select nom_groupe_produit, year(date_commande) annee, {_money('sum(montant_net)', 'ca')},
               {_money('sum(montant_cout)', 'cout_marchandises')},
               {_money('sum(montant_marge)', 'marge')},
               round(100 * sum(montant_marge) / nullif(sum(montant_net), 0), 2) pct_marge
        from fait join stg_produit using (produit_id)
        where nom_groupe_produit = 'Premium — LARGE-1' group by all""",
    "q5_margin_vs_quantity": """
        with p as (select cast(sum(quantite) as double) qte,
                          cast(sum(montant_marge) as double) marge
                   from fait group by produit_id)
        select round(corr(qte, marge), 4) pearson_qte_marge,
               round(regr_slope(marge, qte), 4) pente,
               round(regr_intercept(marge, qte), 4) ordonnee_origine,
               round(regr_r2(marge, qte), 4) r_carre
        from p""",
    "q6_q7_discount_effect": """
        select case when pct_remise > 0 then 'avec_remise' else 'sans_remise' end bucket,
               count(*) nb_lignes, round(avg(quantite), 3) qte_moy_ligne,
               round(avg(montant_net), 2) ca_moy_ligne,
               round(avg(montant_marge), 2) marge_moy_ligne,
               cast(sum(montant_net) as double) ca_total,
               cast(sum(montant_marge) as double) marge_totale
        from fait group by 1""",
    "q8_top_reps": f"""
        select employe_id, nom_complet, org_pays, nb_commandes, {_money('ca', 'ca')},
               {_money('marge', 'marge')}
        from ca_employe order by ca desc, employe_id limit 20""",
    "q9_sales_rep_ranks": f"""
        select org_pays, sexe, tranche_age, tranche_salaire, employe_id, nom_complet,
               {_money('ca', 'ca')},
               row_number() over (partition by org_pays order by ca desc, employe_id) rang_pays,
               row_number() over (partition by sexe order by ca desc, employe_id) rang_sexe,
               row_number() over (partition by tranche_age order by ca desc, employe_id) rang_age,
               row_number() over (partition by tranche_salaire
                                  order by ca desc, employe_id) rang_salaire
        from ca_employe""",
    "q10_customer_groups": f"""
        select groupe_client, count(distinct client_id) nb_clients,
               {_money('sum(montant_net)', 'ca')},
               round(avg(montant_net), 2) panier_moyen_ligne
        from fait join stg_client using (client_id) group by groupe_client""",
    "q11_top_customers": f"""
        select client_id, nom_complet, nom_pays, {_money('sum(montant_net)', 'ca')},
               {_money('sum(montant_marge)', 'marge')},
               count(distinct commande_id) nb_commandes
        from fait join stg_client using (client_id)
        group by client_id, nom_complet, nom_pays
        order by sum(montant_marge) desc, client_id limit 50""",
    "q12_top_suppliers": f"""
        select fournisseur_id, nom_fournisseur, nom_pays, {_money('sum(montant_net)', 'ca')},
               {_money('sum(montant_marge)', 'marge')},
               round(100 * sum(montant_marge) / nullif(sum(montant_net), 0), 2) taux_marge
        from fait join stg_fournisseur using (fournisseur_id)
        group by fournisseur_id, nom_fournisseur, nom_pays
        order by sum(montant_marge) desc, fournisseur_id limit 20""",
    "q13a_order_stats": """
        with p as (select sum(montant_net) ca from fait group by commande_id)
        select round(avg(ca), 4) ca_moy_commande,
               round(stddev_samp(cast(ca as double)), 4) ca_std_commande,
               cast(min(ca) as double) ca_min, cast(max(ca) as double) ca_max from p""",
    "q13b_month_stats": """
        with p as (select sum(montant_net) ca from fait
                   group by year(date_commande), month(date_commande))
        select round(avg(ca), 4) ca_moy_mois,
               round(stddev_samp(cast(ca as double)), 4) ca_std_mois from p""",
    "q13c_rep_stats": """
        select round(avg(ca), 4) ca_moy_employe,
               round(stddev_samp(cast(ca as double)), 4) ca_std_employe from ca_employe""",
    "q14_eta_squared": _ETA,
    "q15_welch_gender": """
        with a as (select sexe, count(*) n, avg(cast(ca as double)) m,
                          var_samp(cast(ca as double)) v from ca_employe group by sexe)
        select round(f.m, 4) "ca_moy_F", round(h.m, 4) "ca_moy_M", f.n "n_F", h.n "n_M",
               round((f.m - h.m) / sqrt(f.v / f.n + h.v / h.n), 4) welch_t
        from (select * from a where sexe = 'F') f, (select * from a where sexe = 'M') h""",
    "wipe_and_reload": " union all ".join(
        f"select '{t}' table_name, {0 if step == 1 else 1} * count(*) nb, {step} etape from {block}"
        for step in (0, 1, 2) for t, (block, _, _) in _DIM_COUNTS.items()),
    "last_runs": " union all ".join(
        [f"select '{t}' job_name, 'SUCCESS' status, count(*) rows_in, count(*) rows_out from {b}"
         for t, (b, _, _) in _DIM_COUNTS.items() if t != "fait_ventes"]
        + ["select 'fait_ventes', 'SUCCESS', (select count(*) from stg_lignes), count(*) from fait",
           "select 'staging', 'SUCCESS', count(*), count(*) from stg_lignes",
           "select 'publication', 'SUCCESS', count(*), count(*) from fait"]),
    "verify_row_counts": " union all ".join(
        f"select '{t}' table_name, count(*) nb from {block}"
        for t, (block, _, _) in _DIM_COUNTS.items()),
    "publish_row_counts": " union all ".join(
        f"select '{t}' table_name, count(*) nb, cast({low} as bigint) cle_min, "
        f"cast({high} as bigint) cle_max from {block}"
        for t, (block, low, high) in _DIM_COUNTS.items()),
    "verify_contracts": """
        select type_contrat_courant, statut_contrat, count(*) nb_employes,
               round(avg(salaire), 4) salaire_moyen,
               round(avg(nb_contrats_signes), 4) nb_contrats_moy
        from stg_employe group by all""",
    "verify_top_reps": f"""
        select nom_complet, org_pays, sexe, tranche_age, tranche_salaire, type_contrat_courant,
               {_money('sum(ca)', 'ca_total')}, {_money('sum(marge)', 'marge_totale')},
               cast(sum(lignes) as bigint) nb_lignes_vendues
        from ca_employe group by all order by sum(ca) desc, nom_complet limit 10""",
}


def _needed(sql: str, found: list[str]) -> None:
    for name in BLOCKS:
        if name not in found and re.search(rf"\b{name}\b", sql):
            _needed(BLOCKS[name], found)
            if name not in found:
                found.append(name)


def statement(sql: str) -> str:
    """``sql`` preceded by the blocks it needs, in order of dependence."""
    blocks: list[str] = []
    _needed(sql, blocks)
    if not blocks:
        return sql
    ctes = ",\n".join(f"{b} as materialized ({BLOCKS[b]})" for b in blocks)
    return f"with {ctes}\nselect * from ({sql}) resultat"


def statements() -> dict[str, str]:
    return {name: statement(sql) for name, sql in QUERIES.items()}
