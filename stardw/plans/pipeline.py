"""Loads from the operational model to the published warehouse."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stardw.operators import fact
from stardw.operators.scd import scd1_reload
from stardw.plans import dimensions as D
from stardw.plans import meta, staging
from stardw.schemas import conform, schema_of
from stardw.session import counted_cut, local_rows, passing_scratch, same_scratch
from stardw.sources import deltas, histories
from stardw.sources.operational import OperationalSource
from stardw.sources.snapshots import Warehouse

# Jobs launched side by side; each is a Spark job of its own.
PARALLEL_JOBS = 8
LINES = "lignes_commande"


def _side_by_side(spark: SparkSession, work: dict) -> dict:
    """Run independent loads together; the first failure is raised after all have ended."""
    with ThreadPoolExecutor(PARALLEL_JOBS) as pool:
        jobs = {name: pool.submit(inheritable_thread_target(spark)(same_scratch(do)))
                for name, do in work.items()}
    return {name: job.result() for name, job in jobs.items()}


@dataclass
class Staged:
    """Staging tables as written by one run."""

    warehouse: Warehouse
    entries: dict

    def __getitem__(self, table: str) -> DataFrame:
        return self.warehouse.open(f"staging/{table}", self.entries[table])

    def __contains__(self, table: str) -> bool:
        return table in self.entries

    def rows(self, table: str) -> int:
        return self.entries[table]["rows"]

    def observed(self, table: str) -> dict:
        return self.entries[table].get("observed", {})


def stage(warehouse: Warehouse, tables: dict[str, DataFrame], observe: dict | None = None) -> Staged:
    """Write staging tables, so that what follows reads each source once."""
    def write(table: str, df: DataFrame):
        return lambda: warehouse.write(f"staging/{table}", df, observe=observe)

    return Staged(warehouse, _side_by_side(
        warehouse.spark, {t: write(t, df) for t, df in tables.items()}))


def stage_lines(staged: Staged, ops: OperationalSource, entries: dict, after: date | None = None,
                only: int | None = None) -> DataFrame:
    """Stage the order lines with the keys that the dimensions of ``entries`` give them."""
    dims = {d: staged.warehouse.open(d, entries[d]) for d in fact.LOOKUPS}
    lines = staging.order_lines(ops, after, only, dims)
    staged.entries |= stage(staged.warehouse, {LINES: lines}, fact.lost(lines)).entries
    return staged[LINES]


def date_entry(warehouse: Warehouse, run: meta.Run, orders: DataFrame,
                span: tuple[date, date] | None) -> dict:
    """The date dimension, grown by whole years when orders come from outside it.

    Days it has stay as they are; a dimension that covers the orders is left alone.
    """
    run.rows_in = run.rows_out = 0
    known = warehouse.manifest().get("dim_date")
    dates = warehouse.open("dim_date", known) if known is not None else None
    if dates is not None and dates.isEmpty():
        known = dates = None
    if dates is None and span is not None:
        dates = conform(D.date_dimension(warehouse.spark, *span), "dim_date")
    ordered = orders.select(F.col("date_commande").alias("jour"))
    if dates is None:
        days = D.date_attributes(D.whole_years(ordered, "jour"), "jour")
    else:
        low, high = dates.agg(F.min("date_complete"), F.max("date_complete")).first()
        if ordered.filter(~F.col("jour").between(low, high)).isEmpty():
            if known is not None:
                return known
            days = dates
        else:
            # From the first to the last day of both, so that no year between is left out.
            both = ordered.union(dates.select("date_complete"))
            grown = conform(D.date_attributes(D.whole_years(both, "jour"), "jour"), "dim_date")
            days = dates.unionByName(grown.join(dates.select("cle_date"), "cle_date", "left_anti"))
    entry = warehouse.write("dim_date", conform(days, "dim_date"))
    run.rows_in = run.rows_out = entry["rows"]
    return entry


def _overwritten_entries(warehouse: Warehouse, run: meta.Run, dim: str,
                         staged: Staged) -> dict:
    table, natural, cle = D.OVERWRITTEN[dim]
    map_name = f"cles_{dim}"
    rows = staged[table]
    known = warehouse[map_name] if map_name in warehouse else None
    _, full_map = scd1_reload(rows, natural, cle, known)
    # The keys are fixed before the dimension uses them.
    map_entry = warehouse.write(map_name, full_map)
    attributes = [c for c in rows.columns if c != natural]
    keyed = rows.join(warehouse.open(map_name, map_entry), natural).select(
        cle, natural, *attributes)
    entry = warehouse.write(dim, conform(keyed, dim))
    run.rows_in, run.rows_out = staged.rows(table), entry["rows"]
    return {dim: entry, map_name: map_entry}


def _historised_entries(warehouse: Warehouse, run: meta.Run, dim: str, staged: Staged,
                        as_of: date) -> dict:
    table, natural, cle = D.HISTORISED[dim]
    versions = D.VERSIONS[dim](staged[table], as_of)
    entry, opened = histories.load(warehouse, dim, versions, natural, cle, as_of,
                                   warehouse.manifest().get(dim))
    run.rows_in, run.rows_out = staged.rows(table), opened
    return {dim: entry}


def load_dimensions(warehouse: Warehouse, log: meta.RunLog, staged: Staged, orders: DataFrame,
                    as_of: date, span: tuple[date, date] | None = None) -> dict:
    """Entries of the seven dimensions and of the key maps, unpublished.

    ``orders`` are those to be loaded; the date dimension covers their days.
    """
    def job(name, build):
        def do():
            with log.run(name) as run:
                return build(run)
        return do

    work = {"dim_date": job("dim_date", lambda run: {"dim_date": date_entry(
        warehouse, run, orders, span)})}
    for dim in D.OVERWRITTEN:
        work[dim] = job(dim, lambda run, dim=dim: _overwritten_entries(
            warehouse, run, dim, staged))
    for dim in D.HISTORISED:
        work[dim] = job(dim, lambda run, dim=dim: _historised_entries(
            warehouse, run, dim, staged, as_of))
    entries: dict = {}
    for made in _side_by_side(warehouse.spark, work).values():
        entries.update(made)
    return entries


def _check_dates(lines: DataFrame, dates: DataFrame) -> None:
    outside = (lines.select(F.col("date_commande").alias("date_complete")).distinct()
               .join(dates, "date_complete", "left_anti")
               .agg(F.count(F.lit(1)).alias("n"), F.min("date_complete").alias("d")).first())
    if outside["n"]:
        raise ValueError(f"{outside['n']} order dates are outside the date dimension, "
                         f"from {outside['d']}")


def _finished(rows: DataFrame) -> DataFrame:
    return conform(fact.with_amounts(rows), "fait_ventes")


def fact_entry(warehouse: Warehouse, lines: DataFrame, dims, published: dict | None,
               table: str = meta.FACT_JOB) -> tuple[dict, int]:
    """Entry of the fact with ``lines`` added or replaced, and the number of rows they gave.

    ``lines`` have been written. A line that came before and finds its dimensions no longer goes.
    """
    fresh = fact.keyed(lines, dims)
    if published is None or not published["parts"]:
        entry, made = deltas.first(warehouse, table, fresh, fact.PARTITION, fact.LINE_KEY,
                                   finish=_finished)
    else:
        if "index" not in published:  # written before there was an index
            published = deltas.indexed(warehouse, table, published, fact.LINE_KEY)
        entry, made = deltas.load(warehouse, table, fresh, lines.select(*fact.LINE_KEY), published,
                                  finish=_finished)
    return entry, made["rows"]


def load_fact(warehouse: Warehouse, log: meta.RunLog, lines: DataFrame, entries: dict,
              table: str = meta.FACT_JOB, *, n: int | None = None,
              published: dict | None = None) -> dict:
    """Entries of the fact and of its high-water mark, unpublished.

    ``entries`` has the dimensions to look up in, ``published`` the fact and the marks that the load
    adds to, by default the newest. Lines whose number ``n`` is known have been written.
    """
    if n is None:
        lines, n = counted_cut(lines, "lignes")
    if published is None:
        published = warehouse.manifest()
    dims = {d: warehouse.open(d, entries[d]) for d in fact.LOOKUPS}
    with log.run(table) as run:
        run.rows_in = n
        dates = warehouse.open("dim_date", entries["dim_date"])
        _check_dates(lines, dates.select("date_complete"))
        known = published.get(table)
        if n or known is None:
            entry, run.rows_out = fact_entry(warehouse, lines, dims, known, table)
        else:
            entry, run.rows_out = known, 0
        marks = (warehouse.open("watermark", published["watermark"]) if "watermark" in published
                 else local_rows(warehouse.spark, [], schema_of("watermark")))
        highest = lines.agg(F.max("date_commande").alias("jour"))
        mark_entry = warehouse.write("watermark", conform(
            meta.merged_watermark(marks, table, highest, meta.now()), "watermark").coalesce(1))
    return {table: entry, "watermark": mark_entry}


def compact(warehouse: Warehouse, table: str = meta.FACT_JOB, most: int = deltas.MOST_LOTS) -> bool:
    """Write the months anew that small loads have left in many folders or with lists of lines gone.

    False if there are none. A load that publishes meanwhile makes it fail; it can be run again.
    """
    base, published = warehouse.snapshot()
    entry = published[table]
    if "index" not in entry:
        return False
    made = deltas.compacted(warehouse, table, entry, most)
    return made is not entry and warehouse.commit({table: made}, base)


def run(ops: OperationalSource, warehouse: Warehouse, as_of: date, *,
        span: tuple[date, date] | None = None, lookback_days: int = 0) -> None:
    """Stage, load the dimensions side by side, load the fact, publish everything at once.

    Only orders after the high-water mark are staged. ``span`` sets the days of the date
    dimension on the first load; by default it covers the years of the staged orders. A load that
    another one overtakes fails when it publishes, and publishes nothing.
    """
    with passing_scratch(warehouse.spark):
        _run(ops, warehouse, meta.RunLog(warehouse), as_of, span, lookback_days)


def _run(ops: OperationalSource, warehouse: Warehouse, log: meta.RunLog, as_of: date,
         span: tuple[date, date] | None, lookback_days: int) -> None:
    base, published = warehouse.snapshot()
    after = meta.effective_watermark(meta.watermark(warehouse), lookback_days)
    with log.run("staging") as staging_run:
        staged = stage(warehouse, staging.dimension_tables(ops, as_of))
        entries = load_dimensions(warehouse, log, staged, ops.orders(after), as_of, span)
        lines = stage_lines(staged, ops, entries, after)
        n = staging_run.rows_in = staging_run.rows_out = staged.rows(LINES)
    for dim, missed in staged.observed(LINES).items():
        if missed:
            # Lines that stay out of the fact since a dimension doesn't know their key.
            with log.run(f"rejets {dim}") as rejected:
                rejected.rows_in, rejected.rows_out = n, missed
    made = load_fact(warehouse, log, lines, entries, n=n, published=published)
    with log.run("publication") as publication:
        # The staging tables of the last run stay readable until they expire.
        publication.rows_in = publication.rows_out = log.rows_out[meta.FACT_JOB]
        warehouse.commit({**entries, **made, "staging": staged.entries}, base)


def run_single_order(ops: OperationalSource, warehouse: Warehouse, as_of: date,
                     commande_id: int | None = None) -> DataFrame:
    """Fact rows of one order, by default the lowest, for following a line from end to end.

    All tables are staged afresh and the dimensions loaded from them, with the published keys as a
    start, so a client who joined today is found. Nothing is published and the high-water mark
    stays; the steps leave their rows in the run log.
    """
    if commande_id is None:
        commande_id = staging.first_order(ops)
    log = meta.RunLog(warehouse, f"commande {commande_id}: ")
    with log.run("staging") as staging_run:
        staged = stage(warehouse, staging.dimension_tables(ops, as_of))
        entries = load_dimensions(warehouse, log, staged, ops.orders(only=commande_id), as_of)
        lines = stage_lines(staged, ops, entries, only=commande_id)
        staging_run.rows_in = staging_run.rows_out = staged.rows(LINES)
    dims = {d: warehouse.open(d, entries[d]) for d in fact.LOOKUPS}
    with log.run(meta.FACT_JOB) as run:
        rows, n = counted_cut(conform(fact.build_fact(lines, dims), "fait_ventes"), "commande")
        run.rows_in, run.rows_out = staging_run.rows_out, n
    # Nothing of what was staged for one order is published, so it goes.
    warehouse.discard({**entries, "staging": staged.entries})
    return rows


def wipe(warehouse: Warehouse) -> None:
    """Publish every table empty, forget all keys and the high-water mark."""
    spark = warehouse.spark
    maps = {f"cles_{dim}": local_rows(spark, [], f"{natural} bigint, {cle} bigint")
            for dim, (_, natural, cle) in D.OVERWRITTEN.items()}
    empty = {t: local_rows(spark, [], schema_of(t)) for t in [*D.TABLES, "watermark"]}
    base = warehouse.version()
    parts = dict.fromkeys(D.HISTORISED, histories.CURRENT)
    facts = empty.pop(meta.FACT_JOB)
    made = {t: warehouse.write(t, df, parts.get(t)) for t, df in {**empty, **maps}.items()}
    made[meta.FACT_JOB] = deltas.first(warehouse, meta.FACT_JOB, facts, fact.PARTITION,
                                       fact.LINE_KEY)[0]
    warehouse.commit(made, base)


def create_views(warehouse: Warehouse, prefix: str = "") -> None:
    """The published tables as views, for questions asked in SQL."""
    for table in D.TABLES:
        warehouse[table].createOrReplaceTempView(f"{prefix}{table}")
