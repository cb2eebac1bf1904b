"""The sales fact: key lookups, derived amounts, rejects."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stardw.functions import exprs as E
from stardw.operators.skew import hot_keys, lookup_join

LINE_KEY = ["commande_id", "numero_ligne"]
MEASURES = ["montant_brut", "montant_remise", "montant_net", "montant_cout", "montant_marge"]
COLUMNS = ["cle_date", "cle_produit", "cle_client", "cle_employe", "cle_fournisseur",
           "cle_canal", "cle_geographie_client", "commande_id", "numero_ligne", "quantite",
           "prix_unitaire", "cout_unitaire", "pct_remise", *MEASURES]
PARTITION = "mois_cle"

# dimension -> (column of the line, natural key, surrogate key, name of the key in the fact,
#               whether only current versions are looked up)
LOOKUPS = {
    "dim_canal": ("canal_id", "canal_id", "cle_canal", "cle_canal", False),
    "dim_geographie": ("cli_ville_id", "ville_id", "cle_geographie", "cle_geographie_client",
                       False),
    "dim_employe": ("employe_id", "employe_id", "cle_employe", "cle_employe", True),
    "dim_fournisseur": ("fournisseur_id", "fournisseur_id", "cle_fournisseur",
                        "cle_fournisseur", False),
    "dim_produit": ("produit_id", "produit_id", "cle_produit", "cle_produit", False),
    "dim_client": ("client_id", "client_id", "cle_client", "cle_client", True),
}


# What an order decides, and what its product does.
OF_ORDER = ["dim_canal", "dim_geographie", "dim_employe", "dim_client"]
OF_PRODUCT = ["dim_produit", "dim_fournisseur"]
KEYS = [spec[3] for spec in LOOKUPS.values()]


def _lookup(dim: DataFrame, line_column: str, natural: str, cle: str, name: str,
            current: bool) -> DataFrame:
    if current:
        dim = dim.filter("est_courant")
    return dim.select(F.col(natural).alias(line_column), F.col(cle).alias(name))


def with_keys(rows: DataFrame, dims: Mapping[str, DataFrame], which: Sequence[str],
              spread: Sequence[str], how: str = "left",
              hot: Callable[[str], dict] | None = None) -> DataFrame:
    """Add the looked-up keys of some dimensions to rows that ``spread`` tells apart.

    Orders and products have them looked up before lines join them, so that lines are moved for
    neither.
    """
    for dim in which:
        column = LOOKUPS[dim][0]
        rows = lookup_join(
            rows, _lookup(dims[dim], *LOOKUPS[dim]), column, spread=spread, how=how,
            hot=None if hot is None else lambda column=column: hot(column))
    return rows


def resolve_keys(lines: DataFrame, dims: Mapping[str, DataFrame], how: str = "inner",
                 ) -> DataFrame:
    """Lines with the six keys; those that were staged with them are not looked up again."""
    if set(KEYS) <= set(lines.columns):
        return lines.dropna(subset=KEYS) if how == "inner" else lines
    # Hot keys are looked for in the lines alone, which needs one column and no join. Small
    # dimensions come first, so that they filter early.
    return with_keys(lines, dims, list(LOOKUPS), LINE_KEY, how,
                     lambda column: hot_keys(lines, column))


def lost(lines: DataFrame) -> dict[str, Column]:
    """For each dimension, the lines staged with keys that it doesn't know, as an aggregate."""
    return {dim: F.count_if(F.col(spec[3]).isNull()) for dim, spec in LOOKUPS.items()}


def keyed(lines: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Fact rows of staged order lines without their amounts. A line with a key that no dimension
    knows is left out."""
    rows = (resolve_keys(lines, dims)
            .withColumn("cle_date", E.date_key(F.col("date_commande")))
            .withColumn("cle_canal", F.col("cle_canal").cast("smallint"))
            .withColumn("numero_ligne", F.col("numero_ligne").cast("int")))
    return rows.select(*[c for c in COLUMNS if c not in MEASURES],
                       E.month_key(F.col("cle_date")).alias(PARTITION))


def with_amounts(rows: DataFrame) -> DataFrame:
    """Rows of :func:`keyed` as fact rows. Each amount follows from its own row, so it need not be
    moved with it."""
    return rows.withColumns(E.measures(
        F.col("quantite"), F.col("prix_unitaire"), F.col("cout_unitaire"),
        F.col("pct_remise"))).select(*COLUMNS, PARTITION)


def build_fact(lines: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Fact rows of staged order lines. A line with a key that no dimension knows is left out."""
    return with_amounts(keyed(lines, dims))


def rejects(lines: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """The lines :func:`build_fact` leaves out, each with the dimensions it misses."""
    missing = {dim: F.col(spec[3]).isNull() for dim, spec in LOOKUPS.items()}
    names = F.array_compact(F.array(*[
        F.when(is_missing, F.lit(dim)) for dim, is_missing in missing.items()]))
    return (resolve_keys(lines, dims, how="left")
            .withColumn("manques", names)
            .filter(F.size("manques") > 0)
            .select(*[c for c in lines.columns if c not in KEYS], "manques"))


def reject_report(lines: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Lost lines per missing dimension."""
    return (rejects(lines, dims)
            .select(F.explode("manques").alias("dimension"))
            .groupBy("dimension").agg(F.count(F.lit(1)).alias("nb_lignes")))
