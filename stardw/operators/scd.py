"""Slowly changing dimensions: overwrite in place, and history with validity dates."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stardw.operators.keys import assign_keys, extend_key_map, highest_key

VALIDITY = ["effectif_du", "effectif_au", "est_courant", "hash_ligne"]


def scd1_reload(staged: DataFrame, natural_key: str, cle: str,
                key_map: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Full reload: attributes are replaced, keys are kept. Gives (dimension, key map)."""
    full_map = extend_key_map(key_map, staged, natural_key, cle)
    attributes = [c for c in staged.columns if c != natural_key]
    dim = staged.join(full_map, natural_key).select(cle, natural_key, *attributes)
    return dim, full_map


def scd2_changes(current: DataFrame, staged: DataFrame, natural_key: str, cle: str,
                 as_of: date) -> DataFrame:
    """Compare the current versions with the staged rows, both unique per natural key.

    One full outer join gives, per natural key: the current version, closed at ``as_of`` if its
    hash differs, and a version opened at ``as_of`` (still without key) if it is new or changed.
    A vanished natural key keeps its current version.
    """
    attributes = [c for c in staged.columns if c not in (natural_key, "hash_ligne")]
    c, s = current.alias("c"), staged.alias("s")
    present = F.col(f"c.{cle}").isNotNull()
    arrived = F.col("s.hash_ligne").isNotNull()
    changed = present & arrived & (F.col("c.hash_ligne") != F.col("s.hash_ligne"))
    opened = arrived & (~present | changed)

    closing = f"case when c.hash_ligne <> s.hash_ligne then date'{as_of}' else c.effectif_au end"
    kept = F.expr(f"struct(c.{cle}, c.{natural_key}, "
                  + "".join(f"c.{a}, " for a in attributes)
                  + f"c.effectif_du, {closing} as effectif_au, "
                  "coalesce(c.hash_ligne = s.hash_ligne, true) as est_courant, c.hash_ligne)")
    key_type = current.schema[cle].dataType.simpleString()
    added = F.expr(f"struct(cast(null as {key_type}) as {cle}, s.{natural_key}, "
                   + "".join(f"s.{a}, " for a in attributes)
                   + f"date'{as_of}' as effectif_du, cast(null as date) as effectif_au, "
                   "true as est_courant, s.hash_ligne)")
    versions = F.array_compact(F.array(F.when(present, kept), F.when(opened, added)))
    return (c.join(s, F.col(f"c.{natural_key}") == F.col(f"s.{natural_key}"), "full_outer")
            .select(F.inline(versions)))


def scd2_first(staged: DataFrame, natural_key: str, cle: str, as_of: date) -> DataFrame:
    """First load: every row opens a version."""
    opened = assign_keys(staged, natural_key, cle)
    return _columns(opened.withColumns({
        "effectif_du": F.lit(as_of), "effectif_au": F.lit(None).cast("date"),
        "est_courant": F.lit(True)}), staged, natural_key, cle)


def scd2_step(current: DataFrame, staged: DataFrame, natural_key: str, cle: str, as_of: date,
              after: Column, cut: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """What the current versions become: kept, closed, and opened with the keys ``after``.

    ``cut`` may write the compared rows and read them back, so that numbering the opened versions
    does not join again.
    """
    changes = scd2_changes(current, staged, natural_key, cle, as_of)
    if cut is not None:
        changes = cut(changes)
    opened = assign_keys(changes.filter(F.col(cle).isNull()).drop(cle), natural_key, cle, after)
    return _columns(changes.filter(F.col(cle).isNotNull()), staged, natural_key, cle).unionByName(
        _columns(opened, staged, natural_key, cle))


def scd2_merge(history: DataFrame | None, staged: DataFrame, natural_key: str, cle: str,
               as_of: date, cut: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The whole history after the staged rows have arrived.

    ``staged`` carries ``hash_ligne`` over the compared attributes. Closed versions pass by.
    """
    if history is None:
        return scd2_first(staged, natural_key, cle, as_of)
    step = scd2_step(history.filter("est_courant"), staged, natural_key, cle, as_of,
                     highest_key(history, cle), cut)
    return _columns(history.filter("not est_courant"), staged, natural_key, cle).unionByName(step)


def _columns(rows: DataFrame, staged: DataFrame, natural_key: str, cle: str) -> DataFrame:
    attributes: Sequence[str] = [c for c in staged.columns
                                 if c not in (natural_key, "hash_ligne")]
    return rows.select(cle, natural_key, *attributes, *VALIDITY)
