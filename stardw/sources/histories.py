"""Histories of which a load compares and rewrites only the key ranges that have changed.

Versions are kept by ranges of 2^``bits`` natural keys, current and closed ones apart. For each range
the entry knows a digest of the rows that the last load staged: their number, and two sums of hashes
that don't depend on their order. A range whose digest has not changed would give the same versions
again, so it is neither read nor written. The others are joined with their current versions, which
are written anew; closed versions are only added to, until a range has more than ``MOST_LOTS`` folders
of them.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stardw.operators.scd import scd2_first, scd2_step
from stardw.schemas import conform
from stardw.session import cut_lineage

CURRENT, RANGE = "est_courant", "tranche"
RANGE_BITS = 16
MOST_LOTS = 16


def _range(natural: str, bits: int) -> Column:
    return F.shiftright(F.col(natural).cast("long"), bits)


def digests(versions: DataFrame, natural: str, bits: int) -> dict[str, str]:
    """Digest of the staged rows of each key range; as many as the ranges."""
    key, row = F.col(natural), F.col("hash_ligne")
    found = versions.groupBy(_range(natural, bits).alias("r")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(key, row).cast("decimal(38,0)")).alias("s"),
        F.bit_xor(F.xxhash64(row, key)).alias("x")).collect()
    return {str(r["r"]): f"{r['n']} {r['s']} {r['x']}" for r in found}


def _key(current: bool, key_range: str) -> str:
    return f"{str(current).lower()}/{RANGE}={key_range}"


def load(warehouse, dim: str, versions: DataFrame, natural: str, cle: str, as_of: date,
         known: dict | None, *, bits: int | None = None) -> tuple[dict, int]:
    """Entry of the history after ``versions`` have arrived, and the number of versions opened.

    ``versions``, unique by ``natural``, carry ``hash_ligne``. They are read twice.
    """
    bits = (known or {}).get("bits", RANGE_BITS if bits is None else bits)
    arrived = digests(versions, natural, bits)
    highest, parts = 0, {}
    if known is not None and "digests" not in known:
        known = _ranged(warehouse, dim, known, natural, cle, bits)
    if known is None:
        step = scd2_first(versions, natural, cle, as_of)
    else:
        highest, parts = known["highest"], known["parts"]
        changed = {r for r, digest in arrived.items() if digest != known["digests"].get(r)}
        if not changed:
            return known, 0
        mine = {p: lots for p, lots in parts.items() if p in {_key(True, r) for r in changed}}
        if len(changed) < len(arrived):
            # As many literals as ranges.
            versions = versions.filter(_range(natural, bits).isin(*map(int, changed)))
        step = scd2_step(warehouse.open(dim, {**known, "parts": mine}), versions, natural, cle,
                         as_of, F.lit(highest).cast("long"), cut=lambda df: cut_lineage(df, dim))
    # Opened versions are those with new keys.
    made = _write(warehouse, dim, step, natural, bits, {
        "opened": F.count_if(F.col(cle) > highest), "highest": F.max(cle)})
    entry = {"schema": made["schema"], "partition": CURRENT, "bits": bits,
             "digests": {**(known or {}).get("digests", {}), **arrived},
             "highest": max(highest, made["observed"].get("highest") or 0),
             "parts": {**parts, **{p: [*(parts.get(p, []) if p.startswith("false") else []), *lots]
                                   for p, lots in made["parts"].items()}}}
    return _tidied(warehouse, dim, entry, natural), made["observed"].get("opened") or 0


def _write(warehouse, dim: str, rows: DataFrame, natural: str, bits: int, observe=None) -> dict:
    made = warehouse.write(dim, conform(rows, dim).withColumn(RANGE, _range(natural, bits)),
                           [CURRENT, RANGE], natural, observe)
    return {**made, "schema": {**made["schema"], "fields": [
        f for f in made["schema"]["fields"] if f["name"] != RANGE]}}


def _tidied(warehouse, dim: str, entry: dict, natural: str) -> dict:
    """The closed versions of a range in many folders become one folder again."""
    many = {p: lots for p, lots in entry["parts"].items() if len(lots) > MOST_LOTS}
    if not many:
        return entry
    rows = warehouse.open(dim, {**entry, "parts": many})
    return {**entry, "parts": {**entry["parts"], **_write(
        warehouse, dim, rows, natural, entry["bits"])["parts"]}}


def _ranged(warehouse, dim: str, known: dict, natural: str, cle: str, bits: int) -> dict:
    """The entry of a history that was written without ranges, written with them."""
    made = _write(warehouse, dim, warehouse.open(dim, known), natural, bits,
                  {"highest": F.max(cle)})
    return {"schema": made["schema"], "partition": CURRENT, "bits": bits, "digests": {},
            "highest": made["observed"].get("highest") or 0, "parts": made["parts"]}
