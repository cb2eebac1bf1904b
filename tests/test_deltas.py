"""Small loads into a table of many months, against a plain model; publication of streams."""

import json
from datetime import date

import pytest
from hypothesis import HealthCheck, Phase, example, given, settings
from hypothesis import strategies as st

import retail
from stardw.operators import fact
from stardw.plans import meta, pipeline, staging
from stardw.schemas import conform
from stardw.session import counted_cut, scratch_dir
from stardw.sources import deltas
from stardw.sources.snapshots import Overtaken, Warehouse
from stardw.streaming import fact_stream

AS_OF = date(2001, 12, 31)
SCHEMA = "commande_id bigint, numero_ligne int, v string, mois_cle int"
KEY = ["commande_id", "numero_ligne"]

line = st.tuples(st.integers(0, 40), st.integers(1, 3))
# What a load brings: lines that came, and the month of those that give a row.
batch = st.dictionaries(line, st.one_of(st.none(), st.integers(200101, 200104)), max_size=12)


def made(spark, rows):
    return spark.createDataFrame([(*k, f"v{n}", m) for k, (n, m) in rows.items()], SCHEMA)


def written(spark, keys):
    return counted_cut(spark.createDataFrame(list(keys), "commande_id bigint, numero_ligne int"))[0]


def rows_of(store, entry):
    return sorted(tuple(r) for r in store.open("t", entry).collect())


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck), phases=[Phase.explicit, Phase.generate])
@example(batches=[{(0, 1): 200101, (25, 1): 200101}, {(36, 3): None, (0, 1): None}, {(0, 1): 200102}], compact_after=1)
@given(batches=st.lists(batch, min_size=2, max_size=4), compact_after=st.integers(0, 4))
def test_like_a_table_that_each_load_rewrites(spark, batches, compact_after):
    store, model, entry = Warehouse(spark, scratch_dir(spark, "deltas")), {}, None
    for n, arrived in enumerate(batches):
        rows = {k: (n, m) for k, m in arrived.items() if m is not None}
        if entry is None:
            entry, wrote = deltas.first(store, "t", made(spark, rows), "mois_cle", KEY, bits=3)
            arrived = rows
        elif arrived:
            entry, wrote = deltas.load(store, "t", made(spark, rows), written(spark, arrived), entry)
        else:
            continue
        model = {k: r for k, r in model.items() if k not in arrived} | rows
        wanted = sorted((*k, f"v{i}", m) for k, (i, m) in model.items())
        assert wrote["rows"] == len(rows)
        assert rows_of(store, entry) == wanted
        # As it is read back from a manifest, and filtered by month.
        entry = json.loads(json.dumps(entry))
        assert rows_of(store, entry) == wanted
        assert store.open("t", entry).filter("mois_cle = 200102").count() == sum(
            m == 200102 for _, m in model.values())
        index = {(r[0], r[1]) for b, lots in entry["index"]["parts"].items() for r in store.parts(
            "t_index", {b: lots}, "seau", deltas._index_schema(KEY, "mois_cle", made(spark, {}).schema)).collect()}
        assert index >= {(k[0], m) for k, (_, m) in model.items()}
        if n == compact_after:
            entry = deltas.compacted(store, "t", entry, most=1)
            assert rows_of(store, entry) == wanted and not entry["gone"]
            assert all(len(lots) == 1 for lots in [*entry["parts"].values(), *entry["index"]["parts"].values()])
            assert deltas.compacted(store, "t", entry, most=1) is entry


def test_a_small_load_touches_its_own_buckets_only(spark, store, monkeypatch):
    first = {(i, 1): (0, 200101 + i // 20) for i in range(80)}
    entry, _ = deltas.first(store, "t", made(spark, first), "mois_cle", KEY, bits=3)
    before = json.loads(json.dumps(entry))
    assert len(entry["index"]["parts"]) == 10
    asked = []
    parts = Warehouse.parts
    monkeypatch.setattr(Warehouse, "parts", lambda self, table, found, *rest: (
        asked.append((table, sorted(found), sorted({x for lots in found.values() for x in lots}))) or parts(self, table, found, *rest)))
    arrived = {(41, 1): (1, 200104), (41, 2): (1, 200104), (43, 1): (1, 200103)}
    entry, _ = deltas.load(store, "t", made(spark, arrived), written(spark, arrived), entry)
    mine = sorted({lot for lots in entry["parts"].values() for lot in lots} - {
        lot for lots in before["parts"].values() for lot in lots})
    # The index is read in one bucket; of the table, only what the load has written itself.
    assert [a for a in asked if a[0] == "t_index"] == [("t_index", ["5"], before["index"]["parts"]["5"])]
    assert [a[2] for a in asked if a[0] == "t"] == [mine]
    assert {b for b, lots in entry["index"]["parts"].items() if lots != before["index"]["parts"].get(b)} == {"5"}
    assert set(entry["gone"]) == {"200103"}
    assert {r.v for r in store.open("t", entry).filter("commande_id = 41").collect()} == {"v1"}
    asked.clear()
    # Orders that nobody has seen take nothing away, so no list is written and no month is joined.
    new = {(1000, 1): (2, 200104)}
    entry, _ = deltas.load(store, "t", made(spark, new), written(spark, new), entry)
    assert not [a for a in asked if a[0] == "t_index"] and set(entry["gone"]) == {"200103"}


def test_months_without_lists_are_read_without_a_join(spark, store):
    first = {(i, 1): (0, 200101 + i // 20) for i in range(80)}
    entry, _ = deltas.first(store, "t", made(spark, first), "mois_cle", KEY)
    plain = store.open("t", entry)._jdf.queryExecution().toString()
    arrived = {(1, 1): (1, 200101)}
    entry, _ = deltas.load(store, "t", made(spark, arrived), written(spark, arrived), entry)
    other = store.open("t", entry).filter("mois_cle = 200103").select("v")
    assert "Join" not in plain and other.count() == 20
    scans = other._jdf.queryExecution().optimizedPlan().toString()
    assert "200103" in scans


def test_a_table_written_before_there_was_an_index(spark, store):
    ops = retail.source(spark)
    pipeline.run(ops, store, AS_OF)
    old = {k: v for k, v in store.manifest()["fait_ventes"].items() if k in ("schema", "partition", "parts")}
    before = sorted(map(tuple, store["fait_ventes"].collect()))
    store.commit({"fait_ventes": old})
    assert not pipeline.compact(store)
    staged = conform(staging.order_lines(ops), "lignes_commande")
    entry, n = pipeline.fact_entry(store, staged, {d: store[d] for d in fact.LOOKUPS}, old)
    assert n == 5 and sorted(map(tuple, store.open("fait_ventes", entry).collect())) == before


# --- publication -------------------------------------------------------------------------------


def test_a_batch_is_published_once(spark, store):
    def table(n):
        return {"t": store.write("t", spark.range(n).toDF("x"))}
    assert store.commit(table(1), 0, ("s", 0)) and store.holds(("s", 0)) and not store.holds(("s", 1))
    # Again after its driver has died, whatever has been published since.
    assert not store.commit(table(2), store.version(), ("s", 0))
    assert store.commit(table(3), store.version(), ("other", 0))
    assert not store.commit(table(4), 1, ("s", 0))
    assert store["t"].count() == 3 and store.version() == 2
    with pytest.raises(Overtaken):
        store.commit(table(5), 1, ("s", 1))
    assert store.commit(table(6), 2, ("s", 1)) and set(store.manifest()) == {"t"}
    assert store.snapshot()[1]["_base"] == 2


def test_one_of_two_that_publish_at_a_time(spark, store):
    from concurrent.futures import ThreadPoolExecutor
    path = f"{store.root}/_manifest/0000000001.json"

    def publish(n):
        try:
            store._publish_text(path, json.dumps({"n": n}))
            return n
        except Overtaken:
            return None
    with ThreadPoolExecutor(8) as pool:
        won = [n for n in pool.map(publish, range(24)) if n is not None]
    assert len(won) == 1 and store.manifest() == {"n": won[0]}
    assert store._list(f"{store.root}/_manifest") == ["0000000001.json"]


def test_replayed_and_overtaken_batches_count_once(spark, store):
    pipeline.run(retail.source(spark), store, AS_OF)
    wanted = sorted(map(tuple, store["fait_ventes"].collect()))
    log = meta.RunLog(store)
    lines = conform(staging.order_lines(retail.source(spark)), "lignes_commande")
    halves = [counted_cut(lines.filter(f"commande_id % 2 = {k}")) for k in range(2)]
    batch_load = pipeline.load_fact
    overtakes = iter([True, False, False, False])

    def overtaken(*args, **kw):
        made = batch_load(*args, **kw)
        if next(overtakes):
            # A batch load of other tables publishes while this batch is at work.
            store.commit({"other": store.write("other", spark.range(2).toDF("x"))}, store.version())
        return made
    pipeline.load_fact = overtaken
    try:
        for number, (half, n) in enumerate(halves):
            assert fact_stream.load_batch(store, log, half, n, ("s", number), "flux")
            assert not fact_stream.load_batch(store, log, half, n, ("s", number), "flux")
    finally:
        pipeline.load_fact = batch_load
    assert sorted(map(tuple, store["flux"].collect())) == wanted
    assert store["other"].count() == 2 and meta.watermark(store, "flux") == meta.watermark(store)
