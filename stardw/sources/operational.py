"""The operational model as a mapping of DataFrames, whatever it is read from."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stardw.operators.skew import hot_keys


class OperationalSource:
    """``source["client"]`` is the table ``client``.

    The order tables also take the high-water mark or one order, so that a source can push the
    restriction into its scan.
    """

    def __init__(self, tables: Mapping[str, DataFrame] | Callable[[str], DataFrame]):
        self._tables = tables
        self._hot: dict[str, dict] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if callable(self._tables):
            return self._tables(name)
        return self._tables[name]

    def orders(self, after: date | None = None, only: int | None = None) -> DataFrame:
        rows = self["commande"]
        if after is not None:
            rows = rows.filter(F.col("date_commande") > F.lit(after))
        if only is not None:
            rows = rows.filter(F.col("commande_id") == only)
        return rows

    def order_lines(self, after: date | None = None, only: int | None = None) -> DataFrame:
        rows = self["ligne_commande"]
        if only is not None:
            return rows.filter(F.col("commande_id") == only)
        if after is not None:
            return rows.join(self.orders(after).select("commande_id"), "commande_id", "left_semi")
        return rows

    def unnumbered_lines(self) -> DataFrame:
        """Order lines for sums, where the line number may be left out."""
        return self["ligne_commande"]

    def price_view(self, name: str = "v_prix_produit_a") -> DataFrame:
        """The view over the price windows, also registered under ``name``."""
        view = self["historique_prix"].select("produit_id", "date_debut", "date_fin", "cout",
                                              "prix_vente")
        view.createOrReplaceTempView(name)
        return view

    # Keys that hold many lines or orders, each found by a pass over one stored column.

    def _find_hot(self, what: str, find: Callable[[], dict]) -> dict:
        if what not in self._hot:
            self._hot[what] = find()
        return self._hot[what]

    def hot_orders(self) -> dict:
        return self._find_hot("orders", lambda: hot_keys(self["ligne_commande"], "commande_id"))

    def hot_lines(self, key: str, after: date | None = None) -> dict:
        """Keys that hold many of the lines after the mark."""
        if after is not None:
            return hot_keys(self.order_lines(after), key)
        return self.hot_orders() if key == "commande_id" else self.hot_products()

    def hot_products(self) -> dict:
        return self._find_hot("products", lambda: hot_keys(self["ligne_commande"], "produit_id"))

    def hot_clients(self) -> dict:
        return self._find_hot("clients", lambda: hot_keys(self["commande"], "client_id"))
