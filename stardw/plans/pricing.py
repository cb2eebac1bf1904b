"""What held on the day of an order: price, discount, version of the client."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stardw.functions import labels as L
from stardw.operators.fact import LINE_KEY
from stardw.operators.intervals import window_at, window_carried
from stardw.operators.skew import lookup_join
from stardw.sources.operational import OperationalSource


def dated_lines(ops: OperationalSource) -> DataFrame:
    orders = ops["commande"].select("commande_id", "date_commande")
    lines = ops["ligne_commande"].select(*LINE_KEY, "produit_id")
    return lookup_join(lines, orders, "commande_id", spread=["numero_ligne", "produit_id"],
                       hot=ops.hot_orders)


def price_at_date(ops: OperationalSource, *, carried: bool = False) -> DataFrame:
    """Cost and price of each line's product on the order day; a default outside all windows.

    ``carried`` is for products with more windows than fit one row, none of which overlap.
    """
    if carried:
        found = window_carried(dated_lines(ops), ops["historique_prix"], "produit_id",
                               "date_commande", start="date_debut", end="date_fin",
                               values=["cout", "prix_vente"])
    else:
        found = window_at(dated_lines(ops), ops["historique_prix"], "produit_id", "date_commande",
                          start="date_debut", end="date_fin", first_by=["date_debut", "prix_id"],
                          values=["cout", "prix_vente"], spread=LINE_KEY, hot=ops.hot_products)
    money = "decimal(12,2)"
    return found.withColumns({
        "cout": F.coalesce("cout", F.lit(L.DEFAULT_COST).cast(money)),
        "prix_vente": F.coalesce("prix_vente", F.lit(L.DEFAULT_PRICE).cast(money))})


def discount_at_date(ops: OperationalSource) -> DataFrame:
    """Discount of each line's product on the order day: the first stored one, or none."""
    found = window_at(dated_lines(ops), ops["remise_produit"], "produit_id", "date_commande",
                      start="date_debut", end="date_fin", first_by=["remise_id"],
                      values=["pct_remise"], spread=LINE_KEY, hot=ops.hot_products)
    return found.withColumn("pct_remise", F.coalesce(
        "pct_remise", F.lit(0).cast("decimal(5,4)")))


def client_version_at_date(orders: DataFrame, history: DataFrame, *, carried: bool = False,
                           ) -> DataFrame:
    """The version of the client that was valid on the order day, NULL before the first one.

    ``carried`` is for clients with more versions than fit one row.
    """
    if carried:
        return window_carried(orders.select("commande_id", "client_id", "date_commande"), history,
                              "client_id", "date_commande", start="effectif_du", end="effectif_au",
                              values=["cle_client", "effectif_du", "groupe_client", "tranche_age"],
                              closed=False)
    return window_at(orders.select("commande_id", "client_id", "date_commande"), history,
                     "client_id", "date_commande", start="effectif_du", end="effectif_au",
                     first_by=["effectif_du", "cle_client"],
                     values=["cle_client", "effectif_du", "groupe_client", "tranche_age"],
                     spread=["commande_id"], closed=False)
