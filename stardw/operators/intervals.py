"""Lookup of the validity window that holds on a day."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stardw.operators.ranking import placed_in_order
from stardw.operators.skew import lookup_join


def _holds(w: Column, day: str, start: str, end: str, closed: bool) -> Column:
    before_end = F.col(day) <= w[end] if closed else F.col(day) < w[end]
    return (w[start] <= F.col(day)) & (w[end].isNull() | before_end)


def window_at(rows: DataFrame, windows: DataFrame, key: str, day: str, *, start: str, end: str,
              first_by: Sequence[str], values: Sequence[str], spread: Sequence[str],
              closed: bool = True, hot: Callable[[], dict] | None = None) -> DataFrame:
    """Add ``values`` of the first window of ``key`` that contains ``day``; NULL without one.

    Windows are [start, end] or, with ``closed=False``, [start, end); a NULL end is open.
    "First" is by ``first_by``. The windows of a key, which differ in their days, are gathered
    into one short sorted array, so a row meets exactly one lookup row: overlaps cannot multiply
    rows, and rows are neither grouped again nor joined back.
    """
    # Windows with the same days and rank collapse before anything is gathered: what is left
    # per key is bounded by the calendar, not by the number of stored windows.
    order = list(dict.fromkeys(first_by))
    rest = [c for c in (start, end, *values) if c not in order]
    best = (windows.groupBy(key, start, end)
            .agg(F.min(F.struct(*order, *[c for c in rest if c not in (start, end)]))
                 .alias("_best")))
    fields = [F.col(start) if c == start else F.col(end) if c == end else F.col(f"_best.{c}")
              for c in (*order, *rest)]
    gathered = (best.select(key, F.struct(*[f.alias(c) for f, c in
                                            zip(fields, (*order, *rest))]).alias("_w"))
                .groupBy(key).agg(F.sort_array(F.collect_list("_w")).alias("_windows")))

    joined = lookup_join(rows, gathered, key, spread=spread, how="left", hot=hot)
    hit = F.get(F.filter("_windows", lambda w: _holds(w, day, start, end, closed)), F.lit(0))
    return (joined.withColumn("_hit", hit)
            .select(*rows.columns, *[F.col(f"_hit.{v}").alias(v) for v in values]))


def window_carried(rows: DataFrame, windows: DataFrame, key: str, day: str, *, start: str,
                   end: str, values: Sequence[str], closed: bool = True) -> DataFrame:
    """The same as :func:`window_at` for windows of a key that do not overlap, however many.

    Rows and starts of windows are sorted together by key and day over all tasks, so a key with many
    windows or rows spans several. Each row takes the last start before it in its partition, or the
    one that the key's earlier partitions leave open: one small row for each partition and key that
    spans more than one. Windows that end on the day they start hold on no day of [start, end).
    """
    kept = [start, end, *[v for v in values if v not in (start, end)]]
    marks = windows.filter(F.col(key).isNotNull() & F.col(start).isNotNull()).select(
        F.col(key).alias("_k"), F.col(start).alias("_d"), F.lit(0).alias("_kind"),
        # Of windows that start on one day the longest counts.
        F.struct(F.col(end).isNull().alias("open"), F.col(end).alias("end")).alias("_length"),
        F.struct(*kept).alias("_w"))
    events = rows.select(F.col(key).alias("_k"), F.col(day).alias("_d"), F.lit(1).alias("_kind"),
                         F.struct(*rows.columns).alias("_row"))
    both = marks.unionByName(events, allowMissingColumns=True)
    placed = placed_in_order(both, [F.col(c) for c in ("_k", "_d", "_kind", "_length")])
    pieces = placed.groupBy("_k", "_part").agg(
        F.max_by("_w", F.when(F.col("_kind") == 0, F.col("_id"))).alias("_left"))
    spanning = pieces.groupBy("_k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    earlier = Window.partitionBy("_k").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = pieces.join(spanning.select("_k"), "_k", "left_semi").select(
        "_k", "_part", F.last("_left", ignorenulls=True).over(earlier).alias("_carried"))
    so_far = Window.partitionBy("_k", "_part").orderBy("_id").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    found = (placed.withColumn("_here", F.last("_w", ignorenulls=True).over(so_far))
             .filter("_kind = 1").join(carried, ["_k", "_part"], "left")
             .select("_row.*", F.coalesce("_here", "_carried").alias("_hit")))
    hit = F.when(_holds(F.col("_hit"), day, start, end, closed), F.col("_hit"))
    return found.withColumn("_hit", hit).select(
        *rows.columns, *[F.col(f"_hit.{v}").alias(v) for v in values])
