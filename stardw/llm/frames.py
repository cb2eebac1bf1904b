"""Columns of callers, kept apart from those the operators add."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REST = "_rest"


def others(df: DataFrame, taken: Iterable[str]) -> list[str]:
    """Columns of ``df`` that clash with none of ``taken``, upper and lower case alike."""
    names = {t.lower() for t in taken}
    return [c for c in df.columns if c.lower() not in names]


def narrowed(docs: DataFrame, *needed: str) -> DataFrame:
    """``docs`` with the columns an operator needs, and all others in one."""
    rest = [docs[c].alias(c) for c in docs.columns if c not in needed]
    return docs.select(*[docs[c] for c in needed],
                       F.struct(F.lit(0).alias("_"), *rest).alias(REST))


def widened(df: DataFrame, docs: DataFrame, *needed: str) -> DataFrame:
    """The columns of ``docs`` again, from what ``narrowed`` made of them."""
    return df.select(*[F.col(c) if c in needed else F.col(REST)[c].alias(c) for c in docs.columns])
