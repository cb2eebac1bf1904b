"""Dense numbering that never sends a large group to one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stardw.session import cut_lineage, local_rows

# Keys are 64-bit: blocks of 2^20 consecutive keys, then groups of 2^20 blocks, leave at most
# 2^24 groups. No window below ever sees more rows than these bounds.
BLOCK_BITS = 20


def rank_by_key(rows: DataFrame, key: str, out: str) -> DataFrame:
    """Add ``out`` = 1, 2, 3 … in the order of ``key``, a unique integer column.

    Rows are counted per block of keys, the counts are summed up to give each block its start,
    and rows are numbered inside their block. A block cannot hold more than 2^20 distinct keys,
    however they are distributed, so the work splits evenly and the result is the same on every
    run: it depends on key values only, not on how rows are partitioned.
    """
    blocks = rows.select(F.shiftright(F.col(key).cast("long"), BLOCK_BITS).alias("_block"))
    blocks = blocks.groupBy("_block").agg(F.count(F.lit(1)).alias("_n"))
    blocks = blocks.withColumn("_group", F.shiftright("_block", BLOCK_BITS))
    before = F.coalesce(F.sum("_n").over(
        Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    groups = (blocks.groupBy("_group").agg(F.sum("_n").alias("_n"))
              .select("_group", before.alias("_group_start")))
    inside = F.coalesce(F.sum("_n").over(
        Window.partitionBy("_group").orderBy("_block")
        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = (blocks.withColumn("_inside", inside).join(groups, "_group")
              .select("_block", (F.col("_group_start") + F.col("_inside")).alias("_start")))
    position = F.row_number().over(Window.partitionBy("_block").orderBy(key))
    return (rows.withColumn("_block", F.shiftright(F.col(key).cast("long"), BLOCK_BITS))
            .withColumn("_pos", position)
            .join(starts, "_block")
            .withColumn(out, (F.col("_start") + F.col("_pos")).cast("long"))
            .drop("_block", "_pos", "_start"))


def placed_in_order(rows: DataFrame, by: Sequence[Column]) -> DataFrame:
    """The rows in the order ``by``, written with their place: ``_part`` and ``_id`` in it."""
    # The fixed-seed number splits long runs of equal rows, whose mutual order is free.
    return cut_lineage(
        rows.withColumn("_tie", F.rand(17))
        .repartitionByRange(*by, F.col("_tie"))
        .sortWithinPartitions(*by, F.col("_tie"))
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_id", 33))
        .drop("_tie"), "numbered")


def number_by_range(rows: DataFrame, group: Sequence[str], order: Sequence[Column | str],
                    out: str) -> DataFrame:
    """``row_number`` per ``group`` by a distributed sort, for groups of any size.

    The rows are range-partitioned and sorted, so one group may span many tasks, and written to
    the shared folder with their place in their partition. Each (partition, group) then needs
    only a start: the number of rows of the group in earlier partitions.
    """
    placed = placed_in_order(rows, [F.col(g) for g in group] + [
        F.col(o) if isinstance(o, str) else o for o in order])
    pieces = placed.groupBy(*group, "_part").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    # Rows per group here: at most one per partition of the sort.
    earlier = F.coalesce(F.sum("_n").over(
        Window.partitionBy(*group).orderBy("_part")
        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # A group without columns still needs one partitioning value.
    starts = pieces.select(*group, "_part", (earlier - F.col("_first")).alias("_shift"))
    joined = placed.alias("r").join(
        starts.alias("s"),
        [F.col(f"r.{c}").eqNullSafe(F.col(f"s.{c}")) for c in [*group, "_part"]])
    kept = [F.col(f"r.{c}") for c in rows.columns]
    return joined.select(*kept, (F.col("_id") + F.col("_shift") + 1).cast("long").alias(out))


def ranks_in_groups(rows: DataFrame, ranks: Mapping[str, str], order: Sequence[Column],
                    ) -> DataFrame:
    """Several ``row_number`` that share their order, by one distributed sort: ``ranks`` names the
    column that each is counted in.

    A row's number is that of the rows of its group in its partition, and a start that the earlier
    partitions give. The numbers in the partition take one shuffle by partition for all groups, and
    the starts are one row for each partition, so the groups may be of any size but must be few.
    """
    placed = placed_in_order(rows, order)

    def named(rank: str, group: str) -> Column:
        # A text for each group, also for none.
        return F.to_json(F.struct(F.lit(rank).alias("r"), F.col(group).alias("g")))

    counts = (placed.select("_part", F.explode(F.array(*[
        named(r, g) for r, g in ranks.items()])).alias("_group"))
        .groupBy("_part", "_group").agg(F.count(F.lit(1)).alias("_n")))
    earlier = F.coalesce(F.sum("_n").over(
        Window.partitionBy("_group").orderBy("_part")
        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = (counts.withColumn("_before", earlier).groupBy("_part").agg(
        F.map_from_entries(F.collect_list(F.struct("_group", "_before"))).alias("_starts")))
    inside = placed.repartition("_part").withColumns({
        r: F.row_number().over(Window.partitionBy("_part", g).orderBy("_id"))
        for r, g in ranks.items()})
    numbered = inside.join(starts, "_part").withColumns({
        r: (F.col(r) + F.col("_starts")[named(r, g)]).cast("long") for r, g in ranks.items()})
    return numbered.select(*rows.columns, *ranks)


def number_in_groups(rows: DataFrame, group: str, order: Sequence[Column | str], out: str,
                     hot: Sequence = ()) -> DataFrame:
    """``row_number`` per ``group``; the groups in ``hot`` are numbered by a distributed sort."""
    plain = F.row_number().over(
        Window.partitionBy(group).orderBy(*order)).cast("long")
    if not hot:
        return rows.withColumn(out, plain)
    schema = T.StructType([T.StructField(group, rows.schema[group].dataType)])
    few = F.broadcast(local_rows(rows.sparkSession, [(key,) for key in hot], schema))
    return rows.join(few, group, "left_anti").withColumn(out, plain).unionByName(
        number_by_range(rows.join(few, group, "left_semi").select(*rows.columns), [group], order,
                        out))
