"""Tables that many small loads add to and take from, read as if each load had rewritten them.

A load writes the rows it adds as a folder of each part, and the keys that came again as a list that
takes the rows of earlier folders away. Both are numbered by the load; a row counts unless a later
list of its part names its key. An index tells in which parts the rows of a leading key number (an
order) are. It is cut into buckets of 2^``bits`` consecutive numbers, so a load of orders that follow
each other reads and writes one bucket or two, however large the table is, and never the table. The
index may name a part that a number has left; a list then takes nothing away there.

Reading costs a join with the lists of the parts that have any; parts without lists are read as they
are. ``compacted`` writes the parts anew that have lists or many folders, and the buckets that have many.

An entry names by part the folders (``parts``) and lists (``gone``), the numbers of the loads (``seq``),
and by bucket the folders of the index (``index``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stardw.session import cut_lineage

BUCKET = "seau"
BUCKET_BITS = 22
# Folders of a part or bucket beyond which compaction writes it as one.
MOST_LOTS = 8


def _bucket(number: str, bits: int) -> Column:
    return F.coalesce(F.shiftright(F.col(number).cast("long"), bits), F.lit(0))


def _gone(table: str) -> str:
    return f"{table}_suppressions"


def _index(table: str) -> str:
    return f"{table}_index"


def _merge(old: dict, new: dict) -> dict:
    """Folders by part: those of ``old``, then those of ``new``."""
    return {p: [*old.get(p, []), *new.get(p, [])] for p in sorted({*old, *new})}


def _numbered(entry: dict) -> dict:
    """The entry with the numbers of the folders it still names, and no others."""
    named = {lot for lots in [*entry["parts"].values(), *entry["gone"].values()] for lot in lots}
    return {**entry, "seq": {lot: n for lot, n in entry["seq"].items() if lot in named}}


def _index_schema(key: list[str], partition: str, schema: T.StructType) -> T.StructType:
    return T.StructType([schema[key[0]], schema[partition], T.StructField(BUCKET, T.LongType())])


def _write_index(warehouse, table: str, numbers: DataFrame, key: list[str], bits: int) -> dict:
    rows = numbers.withColumn(BUCKET, _bucket(key[0], bits))
    return warehouse.write(_index(table), rows, BUCKET, key[0])["parts"]


def first(warehouse, table: str, rows: DataFrame, partition: str, key: list[str], *,
          bits: int = BUCKET_BITS, finish: Callable[[DataFrame], DataFrame] | None = None,
          ) -> tuple[dict, dict]:
    """Entry of a new table of ``rows``, and the entry of what was written. ``finish`` adds to the
    rows what need not be moved with them."""
    made = warehouse.write(table, rows, partition, key[0], finish=finish)
    return indexed(warehouse, table, made, key, bits=bits), made


def indexed(warehouse, table: str, entry: dict, key: list[str], *, bits: int = BUCKET_BITS) -> dict:
    """The entry of a table that was written whole, as one that small loads can add to."""
    made = {**{name: entry[name] for name in ("schema", "partition", "parts")}, "key": key, "gone": {},
            "seq": {lot: 1 for lots in entry["parts"].values() for lot in lots}}
    index = {}
    if made["parts"]:
        numbers = warehouse.open(table, made).select(key[0], made["partition"]).distinct()
        index = _write_index(warehouse, table, numbers, key, bits)
    return {**made, "index": {"bits": bits, "parts": index}}


def load(warehouse, table: str, rows: DataFrame, keys: DataFrame, old: dict, *,
         finish: Callable[[DataFrame], DataFrame] | None = None) -> tuple[dict, dict]:
    """Entry of the table with ``rows`` added and the earlier rows of ``keys`` gone, and the entry
    of what was written.

    ``finish`` is as for :func:`first`. ``keys`` are read a few times, so they should be written already.
    """
    partition, key, bits = old["partition"], old["key"], old["index"]["bits"]
    schema = T.StructType.fromJson(old["schema"])
    made = warehouse.write(table, rows, partition, key[0], finish=finish)
    number = 1 + max(old["seq"].values(), default=0)
    # As many as the buckets the load falls into.
    touched = [str(r[0]) for r in keys.select(_bucket(key[0], bits)).distinct().collect()]
    own = {b: old["index"]["parts"][b] for b in touched if b in old["index"]["parts"]}
    gone: dict = {}
    added = (warehouse.open(table, {**made, "gone": {}}).select(key[0], partition).distinct()
             if made["parts"] else None)
    if own:
        known = warehouse.parts(_index(table), own, BUCKET, _index_schema(key, partition, schema))
        numbers = keys.select(key[0]).distinct()
        known = cut_lineage(known.select(key[0], partition).distinct()
                            .join(numbers, key[0], "left_semi"), "connues")
        listed = keys.select(*key).distinct().join(known, key[0]).select(*key, partition)
        gone = warehouse.write(_gone(table), listed, partition, key[0])["parts"]
        if added is not None:
            added = added.join(known, [key[0], partition], "left_anti")
    index = _write_index(warehouse, table, added, key, bits) if added is not None else {}
    lots = {lot for parts in (made["parts"], gone) for lots in parts.values() for lot in lots}
    return _numbered({
        **old, "parts": _merge(old["parts"], made["parts"]),
        # A list without an earlier folder in its part has nothing to take.
        "gone": _merge(old["gone"], {p: g for p, g in gone.items() if p in old["parts"]}),
        "seq": {**old["seq"], **{lot: number for lot in lots}},
        "index": {"bits": bits, "parts": _merge(old["index"]["parts"], index)}}), made


def merged(warehouse, table: str, entry: dict, schema: T.StructType) -> DataFrame:
    """The rows of an entry with lists of gone keys: the newest row of each key counts."""
    partition, key = entry["partition"], entry["key"]
    with_lot = T.StructType([*schema, T.StructField("lot", T.StringType())])
    touched = {p: lots for p, lots in entry["parts"].items() if p in entry["gone"]}
    whole = {p: lots for p, lots in entry["parts"].items() if p not in entry["gone"]}
    # A folder "lot=…" is read as the value of a column.
    numbers = F.create_map(*[F.lit(x) for lot, n in sorted(entry["seq"].items())
                             for x in (lot.removeprefix("lot="), n)])

    def read(name: str, parts: dict, columns: T.StructType) -> DataFrame:
        return warehouse.parts(name, parts, partition, columns).withColumn(
            "_seq", numbers[F.col("lot")]).drop("lot")

    rows = read(table, touched, with_lot).alias("r")
    lists = read(_gone(table), {p: lots for p, lots in entry["gone"].items() if p in touched},
                 T.StructType([*[schema[k] for k in key], schema[partition], with_lot["lot"]]))
    same = [F.col(f"r.{c}") == F.col(f"g.{c}") for c in [*key, partition]]
    condition = F.col("g._seq") > F.col("r._seq")
    for one in same:
        condition &= one
    left = rows.join(lists.alias("g"), condition, "left_anti").select(*schema.names)
    if not whole:
        return left
    return left.unionByName(warehouse.parts(table, whole, partition, schema).select(*schema.names))


def compacted(warehouse, table: str, entry: dict, most: int = MOST_LOTS) -> dict:
    """The entry with one folder for each part that had lists or more than ``most`` folders, and
    for each bucket of the index that had more; the same entry if there is none."""
    partition, key = entry["partition"], entry["key"]
    schema = T.StructType.fromJson(entry["schema"])
    parts = {p: lots for p, lots in entry["parts"].items() if p in entry["gone"] or len(lots) > most}
    buckets = {b: lots for b, lots in entry["index"]["parts"].items() if len(lots) > most}
    if not parts and not buckets and not entry["gone"]:
        return entry
    out = {**entry, "gone": {}}
    if parts:
        rows = warehouse.open(table, {**entry, "parts": parts, "gone": {
            p: g for p, g in entry["gone"].items() if p in parts}})
        made = warehouse.write(table, rows, partition, key[0])["parts"]
        kept = {p: lots for p, lots in entry["parts"].items() if p not in parts}
        newest = max(entry["seq"].values())
        out |= {"parts": {**kept, **made},
                "seq": {**entry["seq"], **{lot: newest for lots in made.values() for lot in lots}}}
    if buckets:
        numbers = warehouse.parts(_index(table), buckets, BUCKET,
                                  _index_schema(key, partition, schema))
        made = _write_index(warehouse, table, numbers.select(key[0], partition).distinct(), key,
                            entry["index"]["bits"])
        out["index"] = {**entry["index"], "parts": {**entry["index"]["parts"], **made}}
    return _numbered(out)
