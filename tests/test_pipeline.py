from datetime import date

import pytest
from pyspark.sql import functions as F

import retail
from stardw.operators import fact, quality
from stardw.plans import meta, pipeline, staging, verify
from stardw.schemas import DDL, conform, schema_of
from stardw.session import local_rows, scratch_dir
from stardw.sources.snapshots import Warehouse
from stardw.streaming import fact_stream

AS_OF = date(2001, 12, 31)
LATER = date(2002, 1, 31)


def lines_of(dw):
    return {(r.commande_id, r.numero_ligne): r for r in dw["fait_ventes"].collect()}


def facts(dw):
    return sorted(tuple(r) for r in dw["fait_ventes"].collect())


def closed_lots(dw):
    parts = dw.manifest()["dim_client"]["parts"]
    return [lot for part, lots in parts.items() if part.startswith("false") for lot in lots]


def with_orders(spark, orders, lines, **changes):
    return retail.source(spark, commande=orders, ligne_commande=lines, **changes)


def test_full_load(spark, store):
    pipeline.run(retail.source(spark), store, AS_OF)
    got = lines_of(store)
    assert len(got) == 5
    first = got[1, 1]
    assert [str(first[m]) for m in fact.MEASURES] == [
        "31.65", "2.37", "29.28", "21.03", "8.25"]
    assert first.cle_date == 19980320 and first.mois_cle == 199803
    counts = {r.table_name: r.nb for r in verify.row_counts(store).collect()}
    assert counts["dim_date"] == 365 * 2 + 366 and counts["fait_ventes"] == 5
    for table in pipeline.D.TABLES:
        assert store[table].schema.simpleString() == schema_of(table).simpleString()
    assert meta.watermark(store) == date(2000, 12, 31)
    assert not quality.fact_orphans(store).filter("nb_lignes > 0").count()
    assert not quality.unique_keys(store).filter("nb_lignes > 0").count()
    log = {r.job_name: r for r in meta.RunLog(store).latest().collect()}
    assert len(log) == 10 and all(r.status == "SUCCESS" for r in log.values())
    assert (log["fait_ventes"].rows_in, log["fait_ventes"].rows_out) == (5, 5)
    assert log["dim_client"].rows_out == 3


def test_increments_add_up_to_a_full_load(spark, store):
    rows = retail.base_rows()
    early = [o for o in rows["commande"] if o[1] < date(1999, 6, 1)]
    span = (date(1998, 1, 1), date(2001, 12, 31))
    pipeline.run(with_orders(spark, early, rows["ligne_commande"]), store, AS_OF, span=span)
    assert len(lines_of(store)) == 3
    pipeline.run(retail.source(spark), store, AS_OF, span=span)
    whole = Warehouse(spark, scratch_dir(spark, "whole"))
    pipeline.run(retail.source(spark), whole, AS_OF, span=span)
    assert facts(store) == facts(whole)
    # The date dimension is only built once.
    log = [r for r in meta.RunLog(store).latest(40).collect() if r.job_name == "dim_date"]
    assert [r.rows_out for r in log] == [0, 1461]


def test_orders_on_the_watermark_day_wait_for_a_lookback(spark, store):
    rows = retail.base_rows()
    pipeline.run(retail.source(spark), store, AS_OF)
    late = (9, date(2000, 12, 31), 100, 1, 1)
    more = with_orders(spark, [*rows["commande"], late], [
        *rows["ligne_commande"], (9, 1, 10, *map(retail.D, ("1", "1.00", "1.00", "0")))])
    pipeline.run(more, store, AS_OF)
    assert (9, 1) not in lines_of(store)
    pipeline.run(more, store, AS_OF, lookback_days=1)
    assert (9, 1) in lines_of(store) and len(lines_of(store)) == 6


def test_empty_increment_keeps_fact_and_mark(spark, store):
    pipeline.run(retail.source(spark), store, AS_OF)
    before, entry = facts(store), store.manifest()["fait_ventes"]
    pipeline.run(retail.source(spark), store, AS_OF)
    assert facts(store) == before and store.manifest()["fait_ventes"] == entry
    assert meta.watermark(store) == date(2000, 12, 31)


def test_line_that_comes_again_is_replaced_even_in_another_month(spark, store):
    rows = retail.base_rows()
    pipeline.run(retail.source(spark), store, AS_OF)
    untouched = store.manifest()["fait_ventes"]["parts"]["199901"]
    orders = [(1, date(2001, 1, 5), *o[2:]) if o[0] == 1 else o for o in rows["commande"]]
    lines = [(*k[:3], retail.D("9.000"), *k[4:]) if k[:2] == (1, 1) else k
             for k in rows["ligne_commande"]]
    entries = store.manifest()
    again = staging.order_lines(with_orders(spark, orders, lines), only=1)
    dates = pipeline.D.date_dimension(spark, date(1998, 1, 1), date(2001, 12, 31))
    entries["dim_date"] = store.write("dim_date", conform(dates, "dim_date"))
    store.commit(pipeline.load_fact(store, meta.RunLog(store), again, entries))
    got = lines_of(store)
    assert len(got) == 5
    assert got[1, 1].mois_cle == 200101 and str(got[1, 1].quantite) == "9.000"
    # The load wrote a list of lines gone; compaction writes the month anew, which has none left.
    assert pipeline.compact(store) and not pipeline.compact(store)
    assert lines_of(store) == got
    parts = store.manifest()["fait_ventes"]["parts"]
    assert "199803" not in parts and parts["199901"] == untouched


def test_unknown_product_is_dropped_and_reported(spark, store):
    rows = retail.base_rows()
    pipeline.run(retail.source(spark), store, AS_OF)
    schema = retail.SCHEMAS
    dims = {d: store[d] for d in fact.LOOKUPS}
    staged = staging.order_lines(retail.source(spark))
    known = dims | {"dim_produit": dims["dim_produit"].filter("produit_id <> 20"),
                    "dim_client": dims["dim_client"].filter("client_id <> 100")}
    assert fact.build_fact(staged, known).count() == 2
    report = {r.dimension: r.nb_lignes for r in fact.reject_report(staged, known).collect()}
    assert report == {"dim_produit": 2, "dim_client": 3}
    assert fact.rejects(staged, dims).count() == 0 and rows and schema


def test_fact_takes_the_current_version(spark, store):
    rows = retail.base_rows()
    early = [o for o in rows["commande"] if o[1] < date(1999, 6, 1)]
    span = (date(1998, 1, 1), date(2001, 12, 31))
    pipeline.run(with_orders(spark, early, rows["ligne_commande"]), store, AS_OF, span=span)
    moved = [(*c[:5], 2, *c[6:]) if c[0] == 100 else c for c in rows["client"]]
    pipeline.run(retail.source(spark, client=moved), store, LATER, span=span)
    versions = {r.cle_client: r for r in store["dim_client"].filter("client_id = 100").collect()}
    assert {v.groupe_client for v in versions.values()} == {"Bronze", "Or"}
    got = lines_of(store)
    # A sale keeps the version it was loaded with.
    assert versions[got[1, 1].cle_client].groupe_client == "Bronze"
    assert versions[got[4, 1].cle_client].groupe_client == "Or"
    closed = next(v for v in versions.values() if not v.est_courant)
    assert (closed.effectif_au, closed.groupe_client) == (LATER, "Bronze")


def test_keys_survive_a_product_that_vanishes_and_returns(spark, store):
    rows = retail.base_rows()
    pipeline.run(retail.source(spark), store, AS_OF)
    keys = {r.produit_id: r.cle_produit for r in store["dim_produit"].collect()}
    fewer = [p for p in rows["produit"] if p[0] != 30]
    pipeline.run(retail.source(spark, produit=[*fewer, (40, "Gourde", 1, 1, True)]), store, AS_OF)
    now = {r.produit_id: r.cle_produit for r in store["dim_produit"].collect()}
    assert 30 not in now and now[40] == max(keys.values()) + 1 and now[10] == keys[10]
    pipeline.run(retail.source(spark), store, AS_OF)
    assert {r.produit_id: r.cle_produit for r in store["dim_produit"].collect()} == keys


def test_the_date_dimension_grows_by_whole_years(spark, store):
    rows = retail.base_rows()
    early = [o for o in rows["commande"] if o[1] < date(1999, 6, 1)]
    pipeline.run(with_orders(spark, early, rows["ligne_commande"]), store, AS_OF)
    before = {tuple(r) for r in store["dim_date"].collect()}
    pipeline.run(retail.source(spark), store, AS_OF)
    after = {tuple(r) for r in store["dim_date"].collect()}
    assert before < after and len(lines_of(store)) == 5
    years = {r.annee: r["count"] for r in store["dim_date"].groupBy("annee").count().collect()}
    assert years == {1998: 365, 1999: 365, 2000: 366}
    # With a span of its own it starts there, and still takes in all orders.
    whole = Warehouse(spark, scratch_dir(spark, "whole"))
    pipeline.run(retail.source(spark), whole, AS_OF, span=(date(1999, 1, 1), date(1999, 12, 31)))
    assert lines_of(whole) == lines_of(store)


def test_orders_without_a_date_stop_the_load(spark, store):
    rows = retail.base_rows()
    orders = [(o[0], None, *o[2:]) if o[0] == 1 else o for o in rows["commande"]]
    source = with_orders(spark, orders, rows["ligne_commande"])
    source.orders = lambda after=None, only=None: source["commande"]
    source.order_lines = lambda after=None, only=None: source["ligne_commande"]
    with pytest.raises(ValueError, match="outside the date dimension"):
        pipeline.run(source, store, AS_OF)
    assert store.manifest() == {}
    failed = meta.RunLog(store).read().filter("status = 'FAIL'").collect()
    assert [r.job_name for r in failed] == ["fait_ventes"]
    assert "outside" in failed[0].error_msg and failed[0].rows_in is None


def test_a_load_that_was_overtaken_publishes_nothing(spark, store):
    def loaded(n):
        return {f"t{n}": store.write(f"t{n}", spark.range(n).toDF("x"))}
    store.commit(loaded(1), base=0)
    base = store.version()
    store.commit(loaded(2), base)
    with pytest.raises(RuntimeError, match="published since"):
        store.commit(loaded(3), base)
    assert set(store.manifest()) == {"t1", "t2"}


def test_reload_drops_lines_that_no_longer_resolve(spark, store):
    ops = retail.source(spark)
    pipeline.run(ops, store, AS_OF)
    entries = store.manifest()
    dims = {d: store[d] for d in pipeline.fact.LOOKUPS}
    gone = store["dim_produit"].filter("produit_id <> 10")
    dims["dim_produit"] = gone
    staged = conform(staging.order_lines(ops), "lignes_commande")
    lost = {(r.commande_id, r.numero_ligne) for r in staged.filter("produit_id = 10").collect()}
    assert lost
    entry, n = pipeline.fact_entry(store, staged, dims, entries["fait_ventes"])
    left = {(r.commande_id, r.numero_ligne) for r in store.open("fait_ventes", entry).collect()}
    assert n == len(left) == 5 - len(lost) and not left & lost


def test_closed_versions_become_one_folder_again(spark, store, monkeypatch):
    monkeypatch.setattr(pipeline.histories, "MOST_LOTS", 2)
    rows = retail.base_rows()
    for month in range(1, 6):
        pipeline.run(retail.source(spark, client=[
            (*c[:5], 1 + month % 2, *c[6:]) if c[0] == 100 else c for c in rows["client"]]),
            store, date(2002, month, 1))
    assert len(closed_lots(store)) <= 2
    versions = store["dim_client"].filter("client_id = 100").collect()
    assert len(versions) == 5 and sum(v.est_courant for v in versions) == 1


def test_single_order_run_sees_todays_clients(spark, store):
    rows = retail.base_rows()
    pipeline.run(retail.source(spark, client=[c for c in rows["client"] if c[0] != 100]), store, AS_OF)
    one = pipeline.run_single_order(retail.source(spark), store, AS_OF)
    wanted = {o[0] for o in rows["commande"] if o[0] == 1}
    assert {r.commande_id for r in one.collect()} == wanted
    log = [r.job_name for r in meta.RunLog(store).latest(100).collect()]
    assert "commande 1: fait_ventes" in log and "commande 1: dim_client" in log


def test_single_order_run_leaves_everything_as_it_is(spark, store):
    ops = retail.source(spark)
    pipeline.run(ops, store, AS_OF)
    before = store.manifest()
    one = pipeline.run_single_order(ops, store, AS_OF)
    assert {r.commande_id for r in one.collect()} == {1}
    assert pipeline.run_single_order(ops, store, AS_OF, 3).count() == 1
    assert store.manifest() == before


def test_wipe(spark, store):
    pipeline.run(retail.source(spark), store, AS_OF)
    pipeline.wipe(store)
    assert all(r.nb == 0 for r in verify.row_counts(store).collect())
    assert meta.watermark(store) == date(1900, 1, 1)
    pipeline.run(retail.source(spark), store, AS_OF)
    assert len(lines_of(store)) == 5
    assert {r.cle_produit for r in store["dim_produit"].collect()} == {1, 2, 3}


def test_published_together_or_not_at_all(spark, store):
    store.commit({"a": store.write("a", spark.range(3).toDF("x"))})
    other = store.write("a", spark.range(5).toDF("x"))
    assert store["a"].count() == 3
    store.commit({"a": other})
    assert store["a"].count() == 5
    with pytest.raises(RuntimeError, match="another load"):
        store._publish_text(f"{store.root}/_manifest/0000000002.json", "{}")


def test_stream_equals_batch(spark, store):
    pipeline.run(retail.source(spark), store, AS_OF)
    staged = conform(staging.order_lines(retail.source(spark)), "lignes_commande")
    landing = scratch_dir(spark, "landing")
    checkpoint = scratch_dir(spark, "stream")
    staged.repartition(5, "commande_id", "numero_ligne").write.parquet(landing)

    def play():
        stream = fact_stream.read_lines(spark, landing, files_per_batch=2)
        fact_stream.load_available(stream, store, checkpoint, "fait_flux").awaitTermination()
        return sorted(tuple(r) for r in store["fait_flux"].collect())

    assert play() == facts(store)
    assert meta.watermark(store, "fait_flux") == date(2000, 12, 31)
    # Only files that have not been read are loaded; a line that comes again is replaced.
    again = staged.filter("commande_id = 2").selectExpr(
        *[c if c != "quantite" else "cast(7 as decimal(12,3)) quantite" for c in staged.columns])
    again.write.mode("append").parquet(landing)
    got = {(r[7], r[8]): str(r[9]) for r in play()}
    assert len(got) == 5 and got[2, 1] == "7.000"


def test_views_for_sql(spark, store):
    pipeline.run(retail.source(spark), store, AS_OF)
    pipeline.create_views(store, "dw_")
    row = spark.sql("select p.nom_produit, sum(f.quantite) q from dw_fait_ventes f "
                    "join dw_dim_produit p using (cle_produit) group by 1 order by q desc").first()
    assert row.nom_produit == "Tente" or row.nom_produit == "Lampe"


def test_run_log_of_a_failure(spark, store):
    log = meta.RunLog(store)
    with pytest.raises(KeyError):
        with log.run("essai") as run:
            run.rows_in = 3
            raise KeyError("absent")
    with log.run("essai"):
        pass
    rows = log.latest().collect()
    assert [(r.run_id, r.status) for r in rows] == [(2, "SUCCESS"), (1, "FAIL")]
    assert rows[1].rows_in is None and "absent" in rows[1].error_msg
    assert meta.RunLog(store)._new_id() == 3 and "run_log" in DDL
    # A driver that died leaves its run open, and a file half written that doesn't count.
    stopped = log.run("arrêt")
    stopped.__enter__()
    fs, at = store._fs(f"{log.path}/000000000009.json.abc.draft")
    fs.create(at, False).close()
    assert [(r.job_name, r.status) for r in log.latest(1).collect()] == [("arrêt", "RUNNING")]
    assert meta.RunLog(store)._new_id() == 4
    assert local_rows(spark, [], "a int").count() == 0


def test_expired_folders_go_and_published_ones_stay(spark, store):
    ops = retail.source(spark)
    for day in (AS_OF, LATER, date(2002, 2, 28)):
        pipeline.run(ops, store, day)
    before, products = facts(store), store.manifest()["dim_produit"]["lot"]
    gone = store.expire(keep=1)
    assert any(p.startswith("dim_produit/") for p in gone)
    assert any(p.startswith("staging/client_full/") for p in gone)
    assert store._list(f"{store.root}/dim_produit") == [products]
    assert facts(store) == before and store["dim_client"].count() >= 3
    assert pipeline.Staged(store, store.manifest()["staging"])["canal"].count() == 2


def test_closed_versions_are_added_to_and_never_rewritten(spark, store):
    rows = retail.base_rows()

    def moved(group):
        return retail.source(spark, client=[
            (*c[:5], group, *c[6:]) if c[0] == 100 else c for c in rows["client"]])

    lots = []
    for day, group in [(AS_OF, 1), (LATER, 2), (date(2002, 2, 28), 1)]:
        pipeline.run(moved(group), store, day)
        lots.append(closed_lots(store))
    assert [len(x) for x in lots] == [0, 1, 2] and lots[2][0] == lots[1][0]
    versions = store["dim_client"].filter("client_id = 100").orderBy("cle_client").collect()
    assert [v.groupe_client for v in versions] == ["Bronze", "Or", "Bronze"]
    assert [v.est_courant for v in versions] == [False, False, True]
    assert quality.history_faults(store["dim_client"], "client_id", "cle_client").filter(
        "nb_lignes > 0").count() == 0
    plan = store["dim_client"].filter("est_courant")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(est_courant" in plan


def test_amounts_are_not_moved_with_the_lines(spark, store):
    """What is worked out from a row is added after rows are brought together by month."""
    seen = []

    def finish(rows):
        seen.append(rows.columns)
        return rows.withColumn("double", F.col("x") * 2)
    entry = store.write("t", spark.range(6).selectExpr("id x", "cast(id % 2 as int) mois_cle"), "mois_cle",
                        "x", finish=finish)
    assert seen == [["x", "mois_cle"]] and entry["rows"] == 6
    assert sorted((r.x, r.double) for r in store.open("t", entry).collect()) == [(i, 2 * i) for i in range(6)]
    assert not set(fact.MEASURES) & set(fact.keyed(
        spark.createDataFrame([], ", ".join(f"{c} long" for c in [
            "commande_id", "numero_ligne", "quantite", "prix_unitaire", "cout_unitaire", "pct_remise",
            *fact.KEYS]) + ", date_commande date"), {}).columns)
