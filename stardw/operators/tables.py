"""Small table operators: insert if absent, header totals, tree expansion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def insert_if_absent(table: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """``table`` with the ``rows`` whose key it does not hold; one of equal new keys is kept."""
    # One row per new key before the join, so a key with many copies is one row of it.
    fresh = rows.dropDuplicates(list(key)).join(table.select(*key), list(key), "left_anti")
    return table.unionByName(fresh.select(*table.columns))


def of_department(employees: DataFrame, organisation: DataFrame, name: str) -> DataFrame:
    """Employees whose group lies in a department."""
    groups = organisation.filter(F.col("org_departement") == name).select("org_groupe_id")
    return employees.join(groups, "org_groupe_id", "left_semi")


def order_totals(orders: DataFrame, lines: DataFrame,
                 batch: DataFrame | None = None) -> DataFrame:
    """Orders with their total recomputed from their lines.

    An order without lines, or outside ``batch`` (a table of order numbers), keeps its total.
    """
    if batch is not None:
        lines = lines.join(batch.select("commande_id"), "commande_id", "left_semi")
    rest = F.lit(1).cast("decimal(1,0)") - F.col("pct_remise")
    totals = lines.groupBy("commande_id").agg(
        F.sum(F.col("quantite") * F.col("prix_unitaire") * rest)
        .cast("decimal(14,2)").alias("_total"))
    old: Column = (F.col("montant_total") if "montant_total" in orders.columns
                   else F.lit(0).cast("decimal(14,2)"))
    return (orders.join(totals, "commande_id", "left")
            .withColumn("montant_total", F.coalesce("_total", old)).drop("_total"))
