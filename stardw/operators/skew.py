"""Joins of a large table with a lookup table, safe when one key holds much of the rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stardw.session import local_rows

# A key is hot when it holds more rows than a task should sort, whatever the size of the table.
HOT_MIN_ROWS = 1_000_000
# Counters of a frequent-items sketch. It finds every key with more than a small multiple of
# rows / HOT_TRACKED; keys between that and HOT_MIN_ROWS, which a very large table may have, still
# make tasks of a few million rows, which spill but end. Sketches of the tasks are merged in groups
# first, so that no task merges them all.
HOT_TRACKED = 100_000
HOT_MOST = 50_000
SKETCH_GROUPS = 256


def plan_size(df: DataFrame) -> int | None:
    """Size Catalyst expects of ``df``, in bytes: file sizes for a plain scan."""
    try:
        plan = df._jdf.queryExecution().optimizedPlan()
    except AttributeError:  # a remote session shows no plan statistics
        return None
    return int(str(plan.stats().sizeInBytes()))


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Catalyst itself will broadcast ``df``, by the session's size limit."""
    size = plan_size(df)
    if size is None:
        return False
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return 0 <= size <= int(limit)


def hot_keys(df: DataFrame, key: str, *, min_rows: int | None = None) -> dict:
    """Keys that hold at least ``min_rows`` rows, with their approximate row counts.

    One pass over one column with a mergeable sketch, no shuffle of the keys. The answer has at
    most ``HOT_MOST`` keys. It only steers how a join is spread: results do not depend on it. Keys
    below the bound are left to adaptive execution.
    """
    min_rows = HOT_MIN_ROWS if min_rows is None else min_rows
    sketches = df.groupBy((F.spark_partition_id() % SKETCH_GROUPS).alias("_part")).agg(
        F.count(F.col(key)).alias("n"),
        F.expr(f"approx_top_k_accumulate({key}, {HOT_TRACKED})").alias("sketch"))
    # Grouped, for no row rather than an empty sketch when there are no keys.
    found = sketches.filter("n > 0").groupBy(F.lit(1)).agg(
        F.sum("n").alias("n"),
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, {HOT_TRACKED}), {HOT_MOST})")
        .alias("top")).first()
    if found is None:
        return {}
    return {item["item"]: item["count"] for item in found["top"]
            if item["item"] is not None and item["count"] >= min_rows}


def salts_for(hot: dict, rows_per_part: int | None = None) -> dict:
    """Tasks to spread each hot key over. Together these are at most rows / rows_per_part, and
    one more per hot key."""
    rows_per_part = rows_per_part or HOT_MIN_ROWS
    return {key: max(2, -(-count // rows_per_part)) for key, count in hot.items()}


def salted_join(facts: DataFrame, lookup: DataFrame, key: str, how: str, salts: dict,
                spread: Sequence[str]) -> DataFrame:
    """Equi-join in which the rows of a hot key are spread over ``salts[key]`` tasks.

    ``spread`` names columns that tell the rows of one key apart. The salt is a hash of them, so
    a task that runs again gives each row the same salt. The lookup rows of the hot keys, and
    only these, are repeated. Exact for any ``salts``.
    """
    spark = facts.sparkSession
    schema = T.StructType([T.StructField(key, facts.schema[key].dataType),
                           T.StructField("_parts", T.IntegerType())])
    # At most HOT_MOST literal rows: Catalyst sees their size and broadcasts them.
    parts = local_rows(spark, list(salts.items()), schema)
    left = (facts.join(parts, key, "left")
            .withColumn("_salt", F.coalesce(F.pmod(F.xxhash64(*spread), F.col("_parts")),
                                            F.lit(0)).cast("int"))
            .drop("_parts"))
    right = (lookup.join(parts, key, "left")
             .withColumn("_salt", F.explode(
                 F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)))
             .drop("_parts"))
    return left.join(right, [key, "_salt"], how).drop("_salt")


def lookup_join(facts: DataFrame, lookup: DataFrame, key: str, *, spread: Sequence[str],
                how: str = "inner", hot: Callable[[], dict] | None = None) -> DataFrame:
    """Join ``facts`` with a table that has one row per ``key``.

    A lookup below the session's broadcast limit is left to Catalyst, which broadcasts it. Beyond
    the limit both sides are shuffled, and hot keys of ``facts`` are salted. Hot keys are only
    looked for when they matter, with ``hot`` where a source knows a shorter way to them.
    """
    if fits_broadcast(lookup):
        return facts.join(lookup, key, how)
    found = hot_keys(facts, key) if hot is None else hot()
    if not found:
        return facts.join(lookup, key, how)
    return salted_join(facts, lookup, key, how, salts_for(found), spread)
