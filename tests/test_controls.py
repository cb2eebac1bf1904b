"""Checks by the ledger of months against the same checks of the whole fact."""

from datetime import date

import pytest

import retail
from stardw.operators import fact, quality
from stardw.plans import controls, meta, pipeline, staging
from stardw.schemas import conform
from stardw.sources import deltas
from stardw.sources.snapshots import Warehouse

AS_OF = date(2001, 12, 31)


def rows(report):
    return sorted(map(tuple, report.collect()))


def test_a_second_check_reads_no_old_month(spark, store, monkeypatch):
    ops = retail.source(spark)
    pipeline.run(ops, store, AS_OF)
    first = controls.Ledger(store)
    assert first.read_months == sorted(store.manifest()["fait_ventes"]["parts"])
    assert rows(first.orphans()) == rows(quality.fact_orphans(store))
    assert rows(controls.unique_keys(store)) == rows(quality.unique_keys(store))
    asked = []
    parts = Warehouse.parts
    monkeypatch.setattr(Warehouse, "parts", lambda self, table, *rest: asked.append(table) or parts(self, table, *rest))
    store._opened.clear()
    second = controls.Ledger(store)
    rows(second.orphans()), rows(second.repeated_lines())
    assert second.read_months == [] and "fait_ventes" not in asked
    # One order comes again: its month is read, no other.
    staged = conform(staging.order_lines(ops, only=1), "lignes_commande")
    entry, _ = pipeline.fact_entry(store, staged, {d: store[d] for d in fact.LOOKUPS}, store.manifest()["fait_ventes"])
    store.commit({"fait_ventes": entry})
    assert controls.Ledger(store).read_months == ["199803"]
    assert rows(controls.unique_keys(store)) == rows(quality.unique_keys(store))


def test_faults_are_found(spark, store):
    pipeline.run(retail.source(spark), store, AS_OF)
    controls.Ledger(store)
    sales = store["fait_ventes"]
    # A line twice in its month, one in two months, one with a key that no product has.
    more = [sales.filter("commande_id = 1 and numero_ligne = 1"),
            sales.filter("commande_id = 1 and numero_ligne = 1").selectExpr(
                *[c if c != "mois_cle" else "200012 mois_cle" for c in sales.columns]),
            sales.filter("commande_id = 4").limit(1).selectExpr(
                *[{"cle_produit": "cast(99 as bigint) cle_produit", "numero_ligne": "77 numero_ligne"}.get(c, c)
                  for c in sales.columns])]
    entry = store.manifest()["fait_ventes"]
    for n, extra in enumerate(more):
        made = store.write("fait_ventes", conform(extra, "fait_ventes"), "mois_cle", "commande_id")
        index = deltas._write_index(store, "fait_ventes", extra.select("commande_id", "mois_cle"), fact.LINE_KEY, deltas.BUCKET_BITS)
        entry = {**entry, "parts": deltas._merge(entry["parts"], made["parts"]),
                 "seq": {**entry["seq"], **{lot: 5 + n for lots in made["parts"].values() for lot in lots}},
                 "index": {**entry["index"], "parts": deltas._merge(entry["index"]["parts"], index)}}
    store.commit({"fait_ventes": entry})
    assert rows(controls.unique_keys(store)) == rows(quality.unique_keys(store))
    found = {r.controle: (r.nb_lignes, r.nb_cles) for r in controls.fact_orphans(store).collect()}
    assert found["fait_ventes.cle_produit"] == (1, 1) and rows(controls.fact_orphans(store)) == rows(quality.fact_orphans(store))
    twice = {r.controle: (r.nb_lignes, r.nb_cles) for r in controls.unique_keys(store).collect()}
    assert twice["fait_ventes(commande_id, numero_ligne)"] == (2, 1)
    # A product that leaves its dimension is missed at once, without a month being read.
    store.commit({"dim_produit": store.write("dim_produit", store["dim_produit"].filter("produit_id <> 10"))})
    ledger = controls.Ledger(store)
    assert ledger.read_months == [] and rows(ledger.orphans()) == rows(quality.fact_orphans(store))


@pytest.mark.parametrize("before", [False, True])
def test_an_empty_fact(spark, store, before):
    if before:
        pipeline.run(retail.source(spark), store, AS_OF)
        controls.Ledger(store)
    else:
        pipeline.run(retail.source(spark, commande=[], ligne_commande=[]), store, AS_OF, span=(date(2000, 1, 1), date(2000, 12, 31)))
    if before:
        pipeline.wipe(store)
    assert rows(controls.fact_orphans(store)) == rows(quality.fact_orphans(store))
    assert rows(controls.unique_keys(store)) == rows(quality.unique_keys(store))
    assert meta.FACT_JOB in store


def test_orders_that_arrive_late_are_listed(spark, store):
    ops = retail.source(spark)
    early = retail.source(spark, commande=[o for o in retail.base_rows()["commande"] if o[0] != 2])
    pipeline.run(early, store, AS_OF)
    # Order 2 is of 1999 and comes when all days up to the end of 2000 have been loaded.
    assert rows(controls.skipped_orders(early, store)) == []
    found = controls.skipped_orders(ops, store).collect()
    assert [tuple(r) for r in found] == [(date(1999, 1, 1), 1, 730)]
    pipeline.run(ops, store, AS_OF)
    assert len(controls.skipped_orders(ops, store).collect()) == 1
    pipeline.run(ops, store, AS_OF, lookback_days=1 + found[0].jours_avant_marque)
    assert rows(controls.skipped_orders(ops, store)) == []
    # Nothing loaded yet: nothing is at or below the mark.
    pipeline.wipe(store)
    assert rows(controls.skipped_orders(ops, store)) == []


def test_references_of_the_whole_model(spark):
    found = {r.controle: (r.nb_lignes, r.nb_cles) for r in quality.model_orphans(retail.source(spark)).collect()}
    assert len(found) == len(quality.REFERENCES) and set(found.values()) == {(0, 0)}
    broken = retail.base_rows()
    broken["ville"].append((3, "Ailleurs", None, 77))
    broken["contrat_employe"] += [(8, 99, date(1990, 1, 1), None, "CDI"), (9, 99, date(1991, 1, 1), None, "CDI")]
    found = {r.controle: (r.nb_lignes, r.nb_cles) for r in quality.model_orphans(
        retail.source(spark, ville=broken["ville"], contrat_employe=broken["contrat_employe"])).collect()}
    assert {k: v for k, v in found.items() if v != (0, 0)} == {
        "ville.region_id": (1, 1), "contrat_employe.employe_id": (2, 1)}
