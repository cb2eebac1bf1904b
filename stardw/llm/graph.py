"""Connected components of links between documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stardw.session import cut_lineage

MOST_ROUNDS = 60


def connected(links: DataFrame) -> DataFrame:
    """``node`` and the least node of its component as ``label``, from pairs ``a``, ``b``.

    Alternating large and small stars: every node is tied to the least of its neighbours until
    each component is one star. Minima are summed up before they are shuffled, and the joins are
    plain, so that adaptive execution splits a node with very many neighbours. Each round is
    written; nothing is collected but a count and a checksum.
    """
    def checked(df: DataFrame) -> tuple[DataFrame, tuple]:
        df = cut_lineage(df.distinct(), "links")
        return df, tuple(df.agg(F.count(F.lit(1)),
                                F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    a, b = F.col("a"), F.col("b")
    links, state = checked(links.filter(a != b).select(
        F.greatest(a, b).alias("a"), F.least(a, b).alias("b")))
    for _ in range(MOST_ROUNDS):
        both = links.union(links.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (both.join(least, "a").filter(b > a)
                 .select(b.alias("a"), F.least(a, F.col("m")).alias("b"))).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").filter(b != F.col("m")).select(b.alias("a"), F.col("m").alias("b"))
                 .union(least.select("a", F.col("m").alias("b"))))
        links, new = checked(small)
        if new == state:
            labels = (links.select(a.alias("node"), b.alias("label"))
                      .union(links.select(b.alias("node"), b.alias("label")).distinct()))
            return cut_lineage(labels, "components")
        state = new
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
