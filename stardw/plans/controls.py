"""Checks of the fact that read each month once.

A ledger keeps, for every month of the fact, what the checks need of it: how many lines hold each
foreign key, and the line keys that come more than once. A month is known by the folders and lists it
is made of; one that has not changed since the last check is not read again. Foreign keys are compared
with the dimensions as they are now, at the grain of keys. A line key can come twice in different
months only if its order is in several, which the index of orders tells.

The ledger lies beside the manifest, so a check never stands in the way of a load. Two checks at a
time may both read a month; the later one's ledger counts.
"""

from __future__ import annotations

import json
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stardw.operators import fact, quality
from stardw.plans import meta
from stardw.session import local_rows
from stardw.sources import deltas
from stardw.sources.operational import OperationalSource
from stardw.sources.snapshots import Overtaken, Warehouse

FOLDER = "_controles"
FOREIGN = {"cle_date": ("dim_date", "cle_date"),
           **{spec[3]: (dim, spec[2]) for dim, spec in fact.LOOKUPS.items()}}
ROWS = T.StructType([T.StructField(*f) for f in (
    ("colonne", T.StringType()), ("cle", T.LongType()), ("commande_id", T.LongType()),
    ("numero_ligne", T.IntegerType()), ("n", T.LongType()), ("mois_cle", T.IntegerType()))])
REPEATED = "cle de ligne"


class Ledger:
    def __init__(self, warehouse: Warehouse, table: str = meta.FACT_JOB):
        self.warehouse, self.table = warehouse, table
        self.entry = warehouse.manifest()[table]
        self.read_months: list[str] = []
        self._bring_up_to_date()

    def _state(self) -> tuple[int, dict]:
        path = f"{self.warehouse.root}/{FOLDER}"
        names = [n for n in self.warehouse._list(path) if n.endswith(f".{self.table}.json")]
        if not names:
            return 0, {"months": {}, "parts": {}}
        return int(names[-1].split(".")[0]), json.loads(self.warehouse._read_text(f"{path}/{names[-1]}"))

    def _bring_up_to_date(self) -> None:
        parts, gone = self.entry["parts"], self.entry.get("gone", {})
        made_of = {m: [lots, gone.get(m, [])] for m, lots in parts.items()}
        number, known = self._state()
        new = {m for m, of in made_of.items() if known["months"].get(m) != of}
        if not new and set(known["months"]) == set(made_of):
            self.parts = known["parts"]
            return
        self.read_months = sorted(new)
        kept = {m: lots for m, lots in known["parts"].items() if m in made_of and m not in new}
        written = self._written({m: parts[m] for m in new}) if new else {}
        self.parts = {**kept, **written}
        state = json.dumps({"months": made_of, "parts": self.parts}, sort_keys=True)
        try:
            self.warehouse._publish_text(
                f"{self.warehouse.root}/{FOLDER}/{number + 1:010d}.{self.table}.json", state)
        except Overtaken:  # another check has just published its own
            return

    def _written(self, months: dict) -> dict:
        gone = {m: lots for m, lots in self.entry.get("gone", {}).items() if m in months}
        rows = self.warehouse.open(self.table, {**self.entry, "parts": months, "gone": gone})
        none = F.lit(None)
        held = rows.select("mois_cle", F.inline(F.array(*[
            F.struct(F.lit(c).alias("colonne"), F.col(c).cast("bigint").alias("cle"))
            for c in FOREIGN]))).groupBy("mois_cle", "colonne", "cle").agg(
                F.count(F.lit(1)).alias("n"))
        twice = rows.groupBy("mois_cle", *fact.LINE_KEY).agg(
            F.count(F.lit(1)).alias("n")).filter("n > 1")
        both = held.withColumns({"commande_id": none, "numero_ligne": none}).unionByName(
            twice.withColumns({"colonne": F.lit(REPEATED), "cle": none}))
        return self.warehouse.write(FOLDER, both.to(ROWS), "mois_cle", "colonne")["parts"]

    def rows(self) -> DataFrame:
        if not self.parts:
            return local_rows(self.warehouse.spark, [], ROWS)
        return self.warehouse.parts(FOLDER, self.parts, "mois_cle", ROWS).select(*ROWS.names)

    def orphans(self) -> DataFrame:
        """Foreign keys of the fact that the dimensions lack."""
        rows = self.rows()
        return quality.report([
            quality.lost_keys(rows.filter(F.col("colonne") == column).select("cle", "n"), "cle", "n",
                              self.warehouse[dim], key, f"{self.table}.{column}")
            for column, (dim, key) in FOREIGN.items()])

    def repeated_lines(self) -> DataFrame:
        """Line keys that several rows hold."""
        found = self.rows().filter(F.col("colonne") == REPEATED).select(*fact.LINE_KEY, "n")
        index = self.entry.get("index", {}).get("parts")
        if index:
            schema = T.StructType.fromJson(self.entry["schema"])
            orders = self.warehouse.parts(
                deltas._index(self.table), index, deltas.BUCKET,
                deltas._index_schema(fact.LINE_KEY, "mois_cle", schema)).select(
                    "commande_id", "mois_cle").distinct()
            several = orders.groupBy("commande_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
            # Mostly none; the months of these orders only are read.
            months = [r[0] for r in orders.join(several, "commande_id", "left_semi")
                      .select("mois_cle").distinct().collect()]
            if months:
                lines = self.warehouse.open(self.table, self.entry).filter(
                    F.col("mois_cle").isin(months)).join(several, "commande_id", "left_semi")
                found = found.join(several.select("commande_id"), "commande_id", "left_anti").unionByName(
                    lines.groupBy(*fact.LINE_KEY).agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
        return quality.beyond_first(found, "n", f"{self.table}({', '.join(fact.LINE_KEY)})")


def orders_held(warehouse: Warehouse, entry: dict, table: str = meta.FACT_JOB) -> DataFrame:
    """Numbers of the orders in the fact, from the index of orders. An index may name orders whose
    lines have all gone since."""
    schema = T.StructType.fromJson(entry["schema"])
    return warehouse.parts(
        deltas._index(table), entry["index"]["parts"], deltas.BUCKET,
        deltas._index_schema(fact.LINE_KEY, "mois_cle", schema)).select("commande_id")


def skipped_orders(ops: OperationalSource, warehouse: Warehouse, mark: date | None = None,
                   entry: dict | None = None, table: str = meta.FACT_JOB) -> DataFrame:
    """Orders at or below the high-water mark that the fact does not hold, by day.

    They arrived after their day had been loaded, or have no line whose dimensions are known. The
    first day tells the ``lookback_days`` that a load needs to take them. Only two columns of the
    orders and the index are read, not the fact.
    """
    mark = meta.watermark(warehouse) if mark is None else mark
    entry = warehouse.manifest()[table] if entry is None else entry
    orders = ops["commande"].select("commande_id", "date_commande").filter(
        F.col("date_commande") <= F.lit(mark))
    if entry["parts"]:
        held = (orders_held(warehouse, entry, table) if "index" in entry
                else warehouse.open(table, entry).select("commande_id"))
        orders = orders.join(held, "commande_id", "left_anti")
    return (orders.groupBy("date_commande").agg(F.count(F.lit(1)).alias("nb_commandes"))
            .withColumn("jours_avant_marque", F.date_diff(F.lit(mark), "date_commande")))


def fact_orphans(warehouse: Warehouse) -> DataFrame:
    return Ledger(warehouse).orphans()


def unique_keys(warehouse: Warehouse) -> DataFrame:
    """Natural keys of the dimensions, and the line key of the fact by the ledger."""
    return quality.dimension_keys(warehouse).unionByName(Ledger(warehouse).repeated_lines())
