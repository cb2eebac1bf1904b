"""The business questions, each a function of the published tables.

Revenue is the sum of ``montant_net``, margin of ``montant_marge``, volume of ``quantite``. Where
a dimension may be large, the fact is summed per surrogate key first: rows of a hot key meet in
the map-side aggregate, and the dimension joins one row per key. Ties are broken by natural key.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stardw.functions import labels as L
from stardw.operators.fact import LINE_KEY
from stardw.operators.ranking import ranks_in_groups
from stardw.operators.skew import hot_keys, lookup_join
from stardw.session import cut_lineage

Tables = Mapping[str, DataFrame]

ALL_LINES = "*"


def _sum(column: str, name: str) -> Column:
    return F.sum(column).alias(name)


def _share(part: Column, whole: Column, digits: int) -> Column:
    """100 * part / whole, NULL for a zero whole."""
    return F.round(100 * part / F.nullif(whole, F.lit(0)), digits)


def _current(dim: DataFrame) -> DataFrame:
    return dim.filter("est_courant")


def _of_year(fact: DataFrame, year: int) -> DataFrame:
    """Only the month partitions of a year."""
    return fact.filter(F.col("mois_cle").between(year * 100 + 1, year * 100 + 12))


def best_sellers(dw: Tables, top: int = 20) -> DataFrame:
    """Q1. Products by quantity."""
    per_product = dw["fait_ventes"].groupBy("cle_produit").agg(
        _sum("quantite", "qte_totale"), _sum("montant_net", "ca"))
    return (per_product.join(dw["dim_produit"], "cle_produit")
            .select("produit_id", "nom_produit", "nom_groupe_produit", "qte_totale", "ca")
            .orderBy(F.desc("qte_totale"), "produit_id").limit(top))


def declining_products(dw: Tables, top: int = 20) -> DataFrame:
    """Q2. Products with less revenue than in the last year in which they sold."""
    yearly = (dw["fait_ventes"].join(dw["dim_date"].select("cle_date", "annee"), "cle_date")
              .groupBy("cle_produit", "annee").agg(_sum("montant_net", "ca")))
    # One row per product and year, so a product's window holds as many rows as it has years.
    before = F.lag("ca").over(Window.partitionBy("cle_produit").orderBy("annee"))
    drop = F.col("ca") - F.col("ca_precedent")
    fallen = (yearly.withColumn("ca_precedent", before)
              .filter(F.col("ca") < F.col("ca_precedent")))
    return (fallen.join(dw["dim_produit"].select("cle_produit", "produit_id", "nom_produit"),
                        "cle_produit")
            .select("produit_id", "nom_produit", "annee", "ca", "ca_precedent",
                    drop.alias("delta_abs"),
                    F.when(F.col("ca_precedent") > 0,
                           F.round(100 * drop / F.col("ca_precedent"), 2)).alias("delta_pct"))
            .orderBy(F.asc_nulls_last("delta_pct"), "produit_id", "annee").limit(top))


def marginal_products(dw: Tables, country: str, year: int,
                      threshold: str = "0.001") -> DataFrame:
    """Q3. Products below a share of the revenue of a country in a year.

    The sums per product are written, as both the total and the shares are taken from them.
    """
    places = dw["dim_geographie"].filter(F.col("nom_pays") == country).select(
        F.col("cle_geographie").alias("cle_geographie_client"))
    days = dw["dim_date"].filter(F.col("annee") == year).select("cle_date")
    per_product = cut_lineage(
        _of_year(dw["fait_ventes"], year)
        .join(places, "cle_geographie_client").join(days, "cle_date")
        .groupBy("cle_produit").agg(_sum("montant_net", "ca")), "q3")
    total = F.nullif(per_product.agg(F.sum("ca")).scalar(), F.lit(0))
    return (per_product.withColumn("total", total)
            .filter(F.col("ca") / F.col("total") < F.expr(f"{threshold}BD"))
            .join(dw["dim_produit"], "cle_produit")
            .select("produit_id", "nom_produit", "ca",
                    F.round(100 * F.col("ca") / F.col("total"), 4).alias("pct_ca"))
            .orderBy(F.asc_nulls_last("pct_ca"), "produit_id"))


def group_margin(dw: Tables, group: str | None = None) -> DataFrame:
    """Q4. Margin of a product group, or of each of them, by year."""
    products = dw["dim_produit"].select("cle_produit", "nom_groupe_produit")
    if group is not None:
        products = products.filter(F.col("nom_groupe_produit") == group)
    sums = [_sum(c, c) for c in ("montant_net", "montant_cout", "montant_marge")]
    sales = dw["fait_ventes"].join(dw["dim_date"].select("cle_date", "annee"), "cle_date")
    sales = sales.groupBy("cle_produit", "annee").agg(*sums)
    return (sales.join(products, "cle_produit")
            .groupBy("nom_groupe_produit", "annee")
            .agg(_sum("montant_net", "ca"), _sum("montant_cout", "cout_marchandises"),
                 _sum("montant_marge", "marge"))
            .withColumn("pct_marge", _share(F.col("marge"), F.col("ca"), 2))
            .orderBy("nom_groupe_produit", "annee"))


def margin_vs_quantity(dw: Tables) -> DataFrame:
    """Q5. Does the margin of a product depend on the quantity sold?"""
    per_product = (dw["fait_ventes"].groupBy("cle_produit")
                   .agg(_sum("quantite", "qte"), _sum("montant_marge", "marge"))
                   .join(dw["dim_produit"].select("cle_produit"), "cle_produit", "left_semi")
                   .select(F.col("qte").cast("double"), F.col("marge").cast("double")))
    return per_product.agg(
        F.corr("qte", "marge").alias("pearson_qte_marge"),
        F.regr_slope("marge", "qte").alias("pente"),
        F.regr_intercept("marge", "qte").alias("ordonnee_origine"),
        F.regr_r2("marge", "qte").alias("r_carre"))


def discount_effect(dw: Tables) -> DataFrame:
    """Q6, Q7. Lines with and without discount: volume, revenue and margin."""
    bucket = F.when(F.col("pct_remise") > 0, L.WITH_DISCOUNT).otherwise(L.WITHOUT_DISCOUNT)
    return (dw["fait_ventes"].groupBy(bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("nb_lignes"),
        F.round(F.avg("quantite"), 3).alias("qte_moy_ligne"),
        F.round(F.avg("montant_net"), 2).alias("ca_moy_ligne"),
        F.round(F.avg("montant_marge"), 2).alias("marge_moy_ligne"),
        F.round(F.sum("montant_net"), 2).alias("ca_total"),
        F.round(F.sum("montant_marge"), 2).alias("marge_totale")))


def _by_employee(dw: Tables, *aggregates: Column) -> DataFrame:
    """Aggregates per current employee version, with its attributes."""
    return (dw["fait_ventes"].groupBy("cle_employe").agg(*aggregates)
            .join(_current(dw["dim_employe"]), "cle_employe"))


def top_reps(dw: Tables, top: int = 20) -> DataFrame:
    """Q8. Sales staff by revenue."""
    return (_by_employee(dw, F.count_distinct("commande_id").alias("nb_commandes"),
                         _sum("montant_net", "ca"), _sum("montant_marge", "marge"))
            .select("employe_id", "nom_complet", "org_pays", "nb_commandes", "ca", "marge")
            .orderBy(F.desc("ca"), "employe_id").limit(top))


def sales_rep_ranks(dw: Tables) -> DataFrame:
    """Q9. Rank of each member of the sales staff by country, gender, age and salary."""
    base = _by_employee(dw, _sum("montant_net", "ca")).select(
        "org_pays", "sexe", "tranche_age", "tranche_salaire", "employe_id", "nom_complet", "ca")
    ranks = {"rang_pays": "org_pays", "rang_sexe": "sexe", "rang_age": "tranche_age",
             "rang_salaire": "tranche_salaire"}
    best_first = [F.desc("ca"), F.asc("employe_id")]
    # By a distributed sort: a gender is half of the staff, too many for the window of one task.
    return ranks_in_groups(base, ranks, best_first).orderBy(*best_first)


def customer_groups(dw: Tables) -> DataFrame:
    """Q10. Customer groups: clients, revenue, mean revenue of a line."""
    per_client = dw["fait_ventes"].groupBy("cle_client").agg(
        _sum("montant_net", "ca"), F.count("montant_net").alias("lignes"))
    clients = _current(dw["dim_client"]).select("cle_client", "client_id", "groupe_client")
    return (per_client.join(clients, "cle_client")
            .groupBy("groupe_client")
            .agg(F.count_distinct("client_id").alias("nb_clients"), _sum("ca", "ca"),
                 _sum("lignes", "lignes"))
            .select("groupe_client", "nb_clients", "ca",
                    F.round(F.col("ca") / F.col("lignes"), 2).alias("panier_moyen_ligne"))
            .orderBy(F.desc("ca"), F.asc_nulls_last("groupe_client")))


def top_customers(dw: Tables, top: int = 50) -> DataFrame:
    """Q11. Customers by margin."""
    per_client = dw["fait_ventes"].groupBy("cle_client").agg(
        _sum("montant_net", "ca"), _sum("montant_marge", "marge"),
        F.count_distinct("commande_id").alias("nb_commandes"))
    return (per_client.join(_current(dw["dim_client"]), "cle_client")
            .select("client_id", "nom_complet", "nom_pays", "ca", "marge", "nb_commandes")
            .orderBy(F.desc("marge"), "client_id").limit(top))


def top_suppliers(dw: Tables, top: int = 20) -> DataFrame:
    """Q12. Suppliers by margin."""
    per_supplier = dw["fait_ventes"].groupBy("cle_fournisseur").agg(
        _sum("montant_net", "ca"), _sum("montant_marge", "marge"))
    return (per_supplier.join(dw["dim_fournisseur"], "cle_fournisseur")
            .select("fournisseur_id", "nom_fournisseur", "nom_pays", "ca", "marge",
                    _share(F.col("marge"), F.col("ca"), 2).alias("taux_marge"))
            .orderBy(F.desc("marge"), "fournisseur_id").limit(top))


def order_stats(dw: Tables) -> DataFrame:
    """Q13. Revenue of an order: mean, deviation, extremes."""
    per_order = dw["fait_ventes"].groupBy("commande_id").agg(_sum("montant_net", "ca"))
    return per_order.agg(
        F.avg("ca").alias("ca_moy_commande"), F.stddev_samp("ca").alias("ca_std_commande"),
        F.min("ca").alias("ca_min"), F.max("ca").alias("ca_max"))


def month_stats(dw: Tables) -> DataFrame:
    """Q13. Revenue of a month: mean and deviation."""
    months = dw["dim_date"].select("cle_date", "annee", "numero_mois")
    per_month = (dw["fait_ventes"].join(months, "cle_date")
                 .groupBy("annee", "numero_mois").agg(_sum("montant_net", "ca")))
    return per_month.agg(F.avg("ca").alias("ca_moy_mois"),
                         F.stddev_samp("ca").alias("ca_std_mois"))


def rep_stats(dw: Tables) -> DataFrame:
    """Q13. Revenue of a member of the sales staff: mean and deviation."""
    return _by_employee(dw, _sum("montant_net", "ca")).agg(
        F.avg("ca").alias("ca_moy_employe"), F.stddev_samp("ca").alias("ca_std_employe"))


def eta_squared(dw: Tables) -> DataFrame:
    """Q14. Share of the variance of line revenue that each candidate variable explains.

    All versions of clients and employees count. The lines are reduced in one pass to one row
    per combination of the seven variables, with its count, mean and squared deviations; the
    seven groupings and the total are then taken over these few rows.
    """
    employees = dw["dim_employe"].select(
        "cle_employe", F.col("sexe").alias("sexe_emp"),
        F.col("tranche_salaire").alias("tranche_salaire_emp"))
    places = dw["dim_geographie"].select(
        F.col("cle_geographie").alias("cle_geographie_client"),
        F.col("nom_pays").alias("pays_client"))
    products = dw["dim_produit"].select(
        "cle_produit", F.col("nom_ligne_produit").alias("ligne_produit"),
        F.col("nom_categorie_produit").alias("categorie_produit"))
    channels = dw["dim_canal"].select("cle_canal", F.col("code_canal").alias("canal"))
    clients = dw["dim_client"].select("cle_client", "groupe_client")
    lines = sales = dw["fait_ventes"]
    # The large dimensions first: lines are moved for these, with no text but one of the first.
    for dim, key in [(clients, "cle_client"), (products, "cle_produit"),
                     (channels, "cle_canal"), (places, "cle_geographie_client"),
                     (employees, "cle_employe")]:
        lines = lookup_join(lines, dim, key, spread=LINE_KEY,
                            hot=lambda key=key: hot_keys(sales, key))
    variables = ["ligne_produit", "categorie_produit", "groupe_client", "canal", "sexe_emp",
                 "tranche_salaire_emp", "pays_client"]
    cells = lines.groupBy(*variables).agg(
        F.count(F.lit(1)).alias("n"), F.sum("montant_net").alias("s"),
        (F.var_pop(F.col("montant_net").cast("double")) * F.count(F.lit(1))).alias("q"))

    # One row per level of each variable, and one for all lines. The squared deviations of
    # parts with sums s and counts n from their common mean are sum(s^2 / n) - S^2 / N.
    square = F.col("s").cast("double") * F.col("s").cast("double") / F.col("n")
    levels = cells.withColumn("m", square).groupingSets(
        [[v] for v in variables] + [[]], *variables).agg(
            F.grouping_id().alias("g"), F.sum("n").alias("n"), F.sum("s").alias("s"),
            (F.sum("q") + F.sum("m")).alias("squares"))
    everything = 2 ** len(variables) - 1
    which = F.when(F.col("g") == everything, F.lit(ALL_LINES))
    for i, name in enumerate(variables):
        which = which.when(F.col("g") == everything - 2 ** (len(variables) - 1 - i), F.lit(name))
    per_variable = (levels.withColumn("m", square).groupBy(which.alias("variable"))
                    .agg(F.sum("m").alias("m"), F.sum("squares").alias("squares")))
    # Eight rows from here on.
    is_total = F.col("variable") == ALL_LINES
    everywhere = Window.partitionBy()
    base = F.max(F.when(is_total, F.col("m"))).over(everywhere)
    squares = F.max(F.when(is_total, F.col("squares"))).over(everywhere)
    return (per_variable
            .select("variable", F.round((F.col("m") - base)
                                        / F.nullif(squares - base, F.lit(0.0)), 4)
                    .alias("eta_carre"))
            .filter(~is_total)
            .orderBy(F.desc_nulls_last("eta_carre"), "variable"))


def welch_gender(dw: Tables) -> DataFrame:
    """Q15. Welch's t for the revenue of women and men on the sales staff."""
    ca = F.col("ca").cast("double")

    def of(sex: str, aggregate, name: str) -> Column:
        return aggregate(F.when(F.col("sexe") == sex, ca)).alias(name)

    sums = _by_employee(dw, _sum("montant_net", "ca")).agg(
        of("F", F.avg, "ca_moy_F"), of("M", F.avg, "ca_moy_M"),
        of("F", F.count, "n_F"), of("M", F.count, "n_M"),
        of("F", F.var_samp, "v_F"), of("M", F.var_samp, "v_M"))
    error = F.sqrt(F.col("v_F") / F.col("n_F") + F.col("v_M") / F.col("n_M"))
    # Without a group on either side there is no comparison.
    return (sums.filter((F.col("n_F") > 0) & (F.col("n_M") > 0))
            .select("ca_moy_F", "ca_moy_M", "n_F", "n_M",
                    ((F.col("ca_moy_F") - F.col("ca_moy_M"))
                     / F.nullif(error, F.lit(0.0))).alias("welch_t")))


QUESTIONS = {
    "q1_best_sellers": best_sellers, "q2_declining_products": declining_products,
    "q3_marginal_products": marginal_products, "q4_group_margin": group_margin,
    "q5_margin_vs_quantity": margin_vs_quantity, "q6_q7_discount_effect": discount_effect,
    "q8_top_reps": top_reps, "q9_sales_rep_ranks": sales_rep_ranks,
    "q10_customer_groups": customer_groups, "q11_top_customers": top_customers,
    "q12_top_suppliers": top_suppliers, "q13a_order_stats": order_stats,
    "q13b_month_stats": month_stats, "q13c_rep_stats": rep_stats,
    "q14_eta_squared": eta_squared, "q15_welch_gender": welch_gender,
}
