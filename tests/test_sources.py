from datetime import date

import pytest

import retail
from stardw.operators import quality, tables
from stardw.session import local_rows, scratch_dir
from stardw.sources import delimited, jdbc, seed


def test_bulk_text_round_trip(spark):
    df = local_rows(spark, [(1, "a\\b", date(2000, 1, 2), None, retail.D("1.50")),
                            (2, None, None, True, None)],
                    "i int, t string, d date, b boolean, m decimal(5,2)")
    path = scratch_dir(spark, "bulk")
    delimited.write_bulk(df, path)
    lines = sorted(r[0] for r in spark.read.text(path).collect())
    assert lines == ["1\ta\\\\b\t2000-01-02\t\\N\t1.50", "2\t\\N\t\\N\ttrue\t\\N"]
    back = delimited.read_bulk(spark, path, df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_jdbc_options():
    small = jdbc.read_options("jdbc:x", "pays")
    assert small["dbtable"] == "ops.pays" and "partitionColumn" not in small
    large = jdbc.read_options("jdbc:x", "commande", bounds=(1, 9), partitions=4)
    assert (large["partitionColumn"], large["lowerBound"], large["upperBound"],
            large["numPartitions"]) == ("commande_id", "1", "9", "4")
    push = jdbc.write_options("jdbc:x", "dim_date")
    assert push["truncate"] == "true" and push["dbtable"] == "dw.dim_date"
    assert jdbc.PUSH_ORDER[-1] == "fait_ventes"


def test_reference_data(spark):
    counts = {name: df.count() for name, df in seed.reference_tables(spark).items()}
    assert counts == {
        "continent": 6, "pays": 16, "canal_vente": 3, "org_pays": 10, "org_compagnie": 10,
        "org_departement": 60, "org_section": 60, "org_groupe": 120, "ligne_produit": 5,
        "categorie_produit": 12, "groupe_produit": 24, "groupe_client": 5}


def test_seeding_again_adds_nothing(spark):
    stored = {"groupe_client": local_rows(
        spark, [(7, "Or", "gardé")],
        "groupe_client_id int, nom_groupe_client string, description string")}
    groups = {r.nom_groupe_client: r.description
              for r in seed.seed(spark, stored)["groupe_client"].collect()}
    assert groups["Or"] == "gardé" and len(groups) == 5


def test_seeding_a_partly_filled_store(spark):
    stored = {
        "continent": local_rows(spark, [(1, "Europe"), (9, "Atlantide")],
                                "continent_id int, nom_continent string"),
        "org_compagnie": local_rows(spark, [(4, "Compagnie X", 1)],
                                    "org_compagnie_id int, nom_org_compagnie string, org_pays_id int")}
    made = {name: [r.asDict() for r in df.collect()] for name, df in seed.seed(spark, stored).items()}
    ids = [r["continent_id"] for r in made["continent"]]
    assert len(set(ids)) == len(ids) and {1, 9} <= set(ids)
    names = {r["nom_continent"]: r["continent_id"] for r in made["continent"]}
    assert names["Europe"] == 1 and min(i for n, i in names.items() if n not in ("Europe", "Atlantide")) == 10
    france = next(r for r in made["pays"] if r["nom_pays"] == "France")
    assert france["continent_id"] == 1
    assert all(r["continent_id"] in ids for r in made["pays"])
    assert len(made["org_compagnie"]) == 11
    companies = {r["org_compagnie_id"] for r in made["org_compagnie"]}
    assert {r["org_compagnie_id"] for r in made["org_departement"]} <= companies
    assert len(made["org_departement"]) == 60 and len(made["org_groupe"]) == 120


def test_null_labels_keep_their_rows(spark, tmp_path):
    import duckdb
    from stardw.plans import staging
    from stardw.sources.retail_parquet import RetailParquet
    con = duckdb.connect()
    changed = {"customer": "* replace (case when c_custkey = 3 then null else c_mktsegment end as c_mktsegment)",
               "part": "* replace (case when p_partkey = 7 then null else p_type end as p_type)"}
    for name in "region nation customer supplier part orders lineitem".split():
        con.execute(f"copy (select {changed.get(name, '*')} from '/root/testdata/sf0.001/{name}.parquet') "
                    f"to '{tmp_path}/{name}.parquet'")
    plain, ops = RetailParquet(spark, "/root/testdata/sf0.001"), RetailParquet(spark, str(tmp_path))
    for build in (staging.clients, staging.products, staging.order_lines):
        assert build(ops).count() == build(plain).count()
    assert staging.clients(ops).filter("client_id = 3").first().groupe_client is None
    same = [tuple(r) for r in plain["groupe_client"].orderBy("groupe_client_id").collect()]
    assert [tuple(r) for r in ops["groupe_client"].orderBy("groupe_client_id").collect()] == same


def test_insert_if_absent(spark):
    table = local_rows(spark, [(1, "a")], "k int, v string")
    rows = local_rows(spark, [(1, "b"), (2, "c"), (2, "c")], "k int, v string")
    assert sorted(map(tuple, tables.insert_if_absent(table, rows, ["k"]).collect())) == [
        (1, "a"), (2, "c")]


def test_quality_reports(spark):
    rows = retail.base_rows()
    ops = retail.source(
        spark,
        client=[(*c[:3], "X", *c[4:]) if c[0] == 100 else c for c in rows["client"]],
        ligne_commande=[*rows["ligne_commande"],
                        (1, 3, 99, *map(retail.D, ("0", "1", "1", "1.5")))],
        contrat_employe=[(1, 1, date(2000, 1, 2), date(2000, 1, 1), "Autre")])
    broken = {r.controle for r in quality.source_ranges(ops).filter("nb_lignes > 0").collect()}
    assert broken == {"client.sexe", "ligne_commande.quantite", "ligne_commande.pct_remise",
                      "contrat_employe.dates", "contrat_employe.type_contrat"}
    lost = {r.controle: r.nb_lignes for r in quality.source_orphans(ops).collect()}
    assert {k for k, n in lost.items() if n} == {"ligne_commande.produit_id"}
    twice = quality.duplicates(ops["ligne_commande"], ["commande_id"], "x").first()
    assert (twice.nb_cles, twice.nb_lignes) == (1, 2)


@pytest.mark.parametrize("sf", ["0.001"])
def test_hot_order_numbering_matches_the_window(spark, sf, monkeypatch):
    from stardw.sources.retail_parquet import RetailParquet
    source = RetailParquet(spark, f"/root/testdata/sf{sf}")
    plain = sorted(map(tuple, source.order_lines().collect()))
    some = [r[0] for r in source.raw("lineitem").select("l_orderkey").distinct()
            .orderBy("l_orderkey").limit(3).collect()]
    monkeypatch.setattr(RetailParquet, "hot_orders", lambda self: {k: 9 for k in some})
    assert sorted(map(tuple, RetailParquet(spark, source.folder).order_lines().collect())) == plain
