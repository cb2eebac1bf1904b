"""Surrogate keys: dense, stable across reloads, and independent of row order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stardw.operators.ranking import rank_by_key


def highest_key(rows: DataFrame, cle: str) -> Column:
    """The highest key given so far, 0 at first, as a scalar subquery."""
    return rows.agg(F.coalesce(F.max(cle), F.lit(0)).cast("long").alias("haut")).scalar()


def assign_keys(rows: DataFrame, natural_key: str, cle: str,
                after: Column | None = None) -> DataFrame:
    """Give each row the next free key, in the order of its unique natural key."""
    ranked = rank_by_key(rows, natural_key, "_rang")
    start = F.lit(0).cast("long") if after is None else after
    return ranked.withColumn(cle, start + F.col("_rang")).drop("_rang")


def extend_key_map(key_map: DataFrame | None, staged: DataFrame, natural_key: str,
                   cle: str) -> DataFrame:
    """The key map with a key for every natural key of ``staged``; known keys never change."""
    wanted = staged.select(natural_key).distinct()
    if key_map is None:
        return assign_keys(wanted, natural_key, cle).select(natural_key, cle)
    fresh = wanted.join(key_map, natural_key, "left_anti")
    added = assign_keys(fresh, natural_key, cle, highest_key(key_map, cle))
    return key_map.select(natural_key, cle).unionByName(added.select(natural_key, cle))
