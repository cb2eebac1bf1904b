import statistics
from datetime import date

import pytest

import retail
from stardw.plans import analytics, pipeline
from stardw.session import local_rows, scratch_dir
from stardw.sources.snapshots import Warehouse


@pytest.fixture(scope="module")
def dw(spark):
    made = Warehouse(spark, scratch_dir(spark, "questions"))
    pipeline.run(retail.source(spark), made, date(2001, 12, 31))
    return made


def test_every_question_has_an_answer(dw):
    needed = {"q3_marginal_products": ("France", 1998, "2")}
    for name, ask in analytics.QUESTIONS.items():
        if name == "q2_declining_products":
            continue
        assert ask(dw, *needed.get(name, ())).count() > 0, name


def test_best_sellers_break_ties_by_product(dw):
    rows = analytics.best_sellers(dw).collect()
    assert [(r.produit_id, str(r.qte_totale)) for r in rows] == [
        (10, "5.000"), (30, "5.000"), (20, "2.000")]


def sales(spark, rows):
    """(product, year, revenue) as a minimal warehouse."""
    facts = [(p, y * 10000 + 101, y * 100 + 1, retail.D(ca)) for p, y, ca in rows]
    years = sorted({y for _, y, _ in rows})
    products = sorted({p for p, _, _ in rows})
    return {
        "fait_ventes": local_rows(spark, facts, "cle_produit bigint, cle_date int, "
                                  "mois_cle int, montant_net decimal(14,2)"),
        "dim_date": local_rows(spark, [(y * 10000 + 101, y) for y in years],
                               "cle_date int, annee int"),
        "dim_produit": local_rows(spark, [(p, p * 10, f"P{p}") for p in products],
                                  "cle_produit bigint, produit_id bigint, nom_produit string")}


def test_decline_compares_with_the_last_year_that_has_sales(spark):
    dw = sales(spark, [(1, 1998, "100"), (1, 2001, "80"), (2, 1998, "10"), (2, 1999, "20"),
                       (3, 1998, "-5"), (3, 1999, "-6"), (4, 1998, "200"), (4, 1999, "50")])
    rows = [(r.produit_id, r.annee, str(r.delta_abs),
             None if r.delta_pct is None else float(r.delta_pct))
            for r in analytics.declining_products(dw).collect()]
    # Without a positive year before there is no percentage; such rows come last.
    assert rows == [(40, 1999, "-150.00", -75.0), (10, 2001, "-20.00", -20.0),
                    (30, 1999, "-1.00", None)]


def test_group_margin_of_a_large_product_dimension(spark, dw):
    plain = sorted(map(tuple, analytics.group_margin(dw).collect()))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(tuple, analytics.group_margin(dw).collect())) == plain
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def employees(spark, versions):
    """(key, id, sex, current, revenue per order …)"""
    facts = [(k, i * 10 + j, retail.D(ca)) for i, (k, _, _, _, *cas) in enumerate(versions)
             for j, ca in enumerate(cas)]
    return {
        "fait_ventes": local_rows(spark, facts, "cle_employe bigint, commande_id bigint, "
                                  "montant_net decimal(14,2)"),
        "dim_employe": local_rows(spark, [v[:4] for v in versions], "cle_employe bigint, "
                                  "employe_id bigint, sexe string, est_courant boolean")}


def test_closed_versions_do_not_count_for_the_staff(spark):
    dw = employees(spark, [(1, 1, "F", False, "1000"), (2, 1, "F", True, "100", "100"),
                           (3, 2, "F", True, "300"), (4, 3, "M", True, "50"),
                           (5, 4, "M", True, "150")])
    row = analytics.welch_gender(dw).first()
    assert (row.ca_moy_F, row.ca_moy_M, row.n_F, row.n_M) == (250.0, 100.0, 2, 2)
    error = (statistics.variance([200, 300]) / 2 + statistics.variance([50, 150]) / 2) ** 0.5
    assert row.welch_t == pytest.approx(150 / error)
    stats = analytics.rep_stats(dw).first()
    assert float(stats.ca_std_employe) == pytest.approx(statistics.stdev([200, 300, 50, 150]))


def test_no_comparison_without_both_groups(spark):
    assert analytics.welch_gender(employees(spark, [(1, 1, "F", True, "5")])).count() == 0


def test_eta_squared_against_plain_sums(spark, dw):
    got = {r.variable: r.eta_carre for r in analytics.eta_squared(dw).collect()}
    rows = (dw["fait_ventes"].join(dw["dim_canal"], "cle_canal")
            .join(dw["dim_client"].select("cle_client", "groupe_client"), "cle_client")).collect()
    values = [float(r.montant_net) for r in rows]
    mean = statistics.mean(values)
    whole = sum((v - mean) ** 2 for v in values)
    for variable, level in [("canal", "code_canal"), ("groupe_client", "groupe_client")]:
        groups = {}
        for r in rows:
            groups.setdefault(r[level], []).append(float(r.montant_net))
        between = sum(len(g) * (statistics.mean(g) - mean) ** 2 for g in groups.values())
        assert got[variable] == pytest.approx(between / whole, abs=1e-4)
    assert len(got) == 7 and got["ligne_produit"] == 0.0


def test_customer_groups_count_the_missing_group(dw):
    rows = {r.groupe_client: r for r in analytics.customer_groups(dw).collect()}
    assert set(rows) == {"Bronze", "Or", None} and rows["Bronze"].nb_clients == 1
    assert float(rows["Bronze"].panier_moyen_ligne) == round((29.28 + 20 + 8) / 3, 2)


def test_eta_squared_moves_lines_without_the_texts_of_small_dimensions(spark, dw):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = analytics.eta_squared(dw)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    joined = [line.split("(")[1].split("#")[0] for line in plan.splitlines() if "Join Inner" in line]
    # The innermost joins come last in the plan, and first when it runs.
    assert joined[-2:] == ["cle_produit", "cle_client"]
