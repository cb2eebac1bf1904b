from datetime import date

from pyspark.sql import functions as F

import retail
from conftest import TESTDATA
from stardw.operators import tables
from stardw.plans import pricing, staging
from stardw.sources.retail_parquet import RetailParquet

AS_OF = date(2001, 12, 31)


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_contracts(spark):
    rows = by(staging.employees(retail.source(spark), AS_OF), "employe_id")
    assert [(rows[e].statut_contrat, rows[e].type_contrat_courant, rows[e].nb_contrats_signes)
            for e in (1, 2, 3, 4)] == [
        ("Actif", "CDI", 2), ("Expire", "Stage", 2), ("Actif", "CDD", 1),
        ("SansContrat", None, 0)]
    assert rows[1].nom_manager is None and rows[2].nom_manager == "Petit Anne"
    assert rows[3].org_departement == "Finance"


def test_contract_that_ended_yesterday(spark):
    rows = by(staging.employees(retail.source(spark), date(2002, 1, 1)), "employe_id")
    assert rows[3].statut_contrat == "Expire"


def test_clients(spark):
    rows = by(staging.clients(retail.source(spark)), "client_id")
    assert rows[100].a_carte_fidelite and not rows[200].a_carte_fidelite
    assert rows[200].groupe_client is None and rows[200].nom_pays == "Belgique"
    assert rows[100].nom_complet == "Durand Eva"


def test_order_lines_after_and_only(spark):
    ops = retail.source(spark)
    assert staging.order_lines(ops).count() == 5
    # Strictly after: the orders of the day itself stay out.
    after = staging.order_lines(ops, after=date(1999, 1, 1)).collect()
    assert sorted(r.commande_id for r in after) == [3, 4]
    assert staging.order_lines(ops, after=date(2000, 12, 31)).count() == 0
    plan = staging.order_lines(ops, after=date(1999, 1, 1))._jdf.queryExecution().toString()
    assert "LeftSemi" in plan
    assert {r.commande_id for r in staging.order_lines(ops, only=1).collect()} == {1}
    assert staging.first_order(ops) == 1


def test_staging_columns(spark):
    for name, df in staging.all_tables(retail.source(spark), AS_OF).items():
        assert df.columns == staging.COLUMNS[name]


def test_price_at_date(spark):
    days = [date(1998, 1, 1), date(1998, 12, 31), date(2005, 1, 1), date(1997, 12, 31)]
    orders = [(i, d, 100, 1, 1) for i, d in enumerate(days)]
    lines = [(i, 1, 10, *[retail.D(x) for x in ("1", "1", "1", "0")]) for i in range(4)]
    ops = retail.source(spark, commande=orders, ligne_commande=lines)
    got = by(pricing.price_at_date(ops), "commande_id")
    assert [(str(got[i].cout), str(got[i].prix_vente)) for i in range(4)] == [
        ("5.00", "9.00"), ("5.00", "9.00"), ("6.00", "11.00"), ("10.00", "20.00")]


def test_overlapping_discounts_give_the_first_and_no_extra_line(spark):
    days = [date(1998, 3, 20), date(1998, 4, 1), date(1998, 5, 1)]
    orders = [(i, d, 100, 1, 1) for i, d in enumerate(days)]
    lines = [(i, 1, 10, *[retail.D(x) for x in ("1", "1", "1", "0")]) for i in range(3)]
    ops = retail.source(spark, commande=orders, ligne_commande=lines)
    rows = pricing.discount_at_date(ops).collect()
    assert sorted((r.commande_id, str(r.pct_remise)) for r in rows) == [
        (0, "0.1000"), (1, "0.2000"), (2, "0.0000")]


def test_first_window_wins_by_start(spark):
    prices = [(1, 10, date(1998, 2, 1), None, retail.D("2"), retail.D("2")),
              (2, 10, date(1998, 1, 1), None, retail.D("1"), retail.D("1"))]
    ops = retail.source(spark, historique_prix=prices)
    got = {(r.commande_id, r.numero_ligne): r for r in pricing.price_at_date(ops).collect()}
    assert str(got[1, 1].cout) == "1.00" and len(got) == 5


def test_order_totals(spark):
    ops = retail.source(spark)
    orders = ops["commande"].unionByName(retail.source(
        spark, commande=[(9, date(2001, 1, 1), 100, 1, 1)])["commande"])
    totals = {r.commande_id: str(r.montant_total)
              for r in tables.order_totals(orders, ops["ligne_commande"]).collect()}
    assert totals == {1: "49.28", 2: "22.00", 3: "10.00", 4: "8.00", 9: "0.00"}
    batch = ops["commande"].filter("commande_id = 1")
    partly = {r.commande_id: str(r.montant_total) for r in tables.order_totals(
        orders, ops["ligne_commande"], batch).collect()}
    assert partly[1] == "49.28" and partly[2] == "0.00"


def test_sales_department(spark):
    ops = retail.source(spark)
    staff = tables.of_department(ops["employe"], staging.organisation(ops), "Ventes")
    assert sorted(r.employe_id for r in staff.collect()) == [1, 2, 4]


def test_price_view(spark):
    retail.source(spark).price_view()
    assert spark.sql("select count(*) from v_prix_produit_a where produit_id = 10").first()[0] == 2


def test_lines_are_shuffled_by_order_and_by_product_once(spark, capsys):
    """Numbering and the join with orders share one partitioning, with broadcasts off."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        staging.order_lines(RetailParquet(spark, TESTDATA)).explain()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    plan = capsys.readouterr().out.splitlines()
    scan = next(i for i, line in enumerate(plan) if "FileScan" in line and "l_orderkey" in line)
    # What lies above the scan of the lines: the lines further left than it, each of them once.
    above, depth = [], plan[scan].index("FileScan")
    for line in reversed(plan[:scan]):
        at = len(line) - len(line.lstrip(" :+-"))
        if at < depth:
            above.append(line)
            depth = at
    keys = [line.split("hashpartitioning(")[1].split("#")[0] for line in above if "Exchange hash" in line]
    assert keys == ["l_orderkey", "produit_id"]


def test_a_mark_before_most_orders_selects_no_lines(spark, tmp_path):
    days = [None, date(1800, 1, 1), *[date(1997, 1, d) for d in range(1, 6)]]
    spark.createDataFrame([(k, d) for k, d in enumerate(days)], "o_orderkey long, o_orderdate date").withColumn(
        "o_orderdate", F.col("o_orderdate").cast("timestamp_ntz")).write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(k, 1, 10 + n, 1, 1000.0, 2.0, 0.0, 0.0, "N", "O", date(1997, 2, 1)) for k in [*range(7), 99]
             for n in range(2)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, "
                          "l_extendedprice double, l_quantity double, l_discount double, l_tax double, "
                          "l_returnflag string, l_linestatus string, l_shipdate date").write.parquet(
                              f"{tmp_path}/lineitem.parquet")
    source = RetailParquet(spark, str(tmp_path))

    def found(after):
        return sorted((r.commande_id, r.numero_ligne) for r in source.order_lines(after).collect())
    assert found(date(1900, 1, 1)) == [(k, n) for k in range(2, 7) for n in (1, 2)]
    assert not source._selected
    assert found(date(1997, 1, 3)) == [(k, n) for k in (5, 6) for n in (1, 2)]
    assert list(source._selected) == [date(1997, 1, 3)]
