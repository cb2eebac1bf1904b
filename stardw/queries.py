"""The registered queries: every operator and question over the given parquet tables.

Operators work on the tables as read. Questions and checks read the warehouse that the pipeline
loads from these tables, once per session and folder, into the shared folder.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stardw.functions import exprs as E
from stardw.functions import labels as L
from stardw.operators import fact, keys, quality, scd, tables
from stardw.plans import (analytics, controls, dimensions, meta, pipeline, pricing, staging,
                          verify)
from stardw.schemas import conform
from stardw.session import cut_lineage, scratch_dir
from stardw.sources import histories
from stardw.sources.delimited import bulk_lines
from stardw.sources.operational import OperationalSource
from stardw.sources.retail_parquet import RetailParquet
from stardw.sources.snapshots import Warehouse
from stardw.streaming import fact_stream

# Days of the two loads that the history queries play, and of the one of the questions.
FIRST_LOAD = date(2001, 12, 31)
SECOND_LOAD = date(2002, 1, 31)
# Days of the loads of the as-of lookup, inside the range of the orders.
EARLY_LOAD = date(1996, 1, 1)
LATE_LOAD = date(1998, 6, 30)
INCREMENT_AFTER = date(1998, 6, 30)
GROWTH_UNTIL = date(1996, 6, 30)
QUESTION_COUNTRY = "NATION_3"
QUESTION_YEAR = 1998
QUESTION_GROUP = "Premium — LARGE-1"

SOURCE_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]

_warehouses: dict[tuple, Warehouse] = {}
_loading = threading.Lock()


def warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """The warehouse loaded from the tables in ``folder``."""
    source = RetailParquet(spark, folder)
    known = source.state(*SOURCE_TABLES)
    with _loading:
        if known not in _warehouses:
            made = Warehouse(spark, scratch_dir(spark, "entrepot"))
            pipeline.run(source, made, FIRST_LOAD)
            _warehouses[known] = made
        return _warehouses[known]


def portable(df: DataFrame) -> DataFrame:
    """Plain types, which two engines can compare: bigint, double, text, boolean, date."""
    def plain(field: T.StructField) -> str:
        kind = field.dataType
        if isinstance(kind, T.DecimalType | T.FloatType):
            return f"cast({field.name} as double) {field.name}"
        if isinstance(kind, T.ByteType | T.ShortType | T.IntegerType):
            return f"cast({field.name} as bigint) {field.name}"
        if isinstance(kind, T.TimestampType | T.TimestampNTZType):
            return f"cast({field.name} as string) {field.name}"
        return field.name
    return df.selectExpr(*[plain(f) for f in df.schema])


# --- arrivals: the tables as a first and a second load find them ---------------------------------

def _with(ops: OperationalSource, **replaced: DataFrame) -> OperationalSource:
    return OperationalSource(lambda name: replaced[name] if name in replaced else ops[name])


def first_clients(ops: OperationalSource) -> OperationalSource:
    return _with(ops, client=ops["client"].filter("client_id % 25 <> 9"))


def second_clients(ops: OperationalSource) -> OperationalSource:
    moved = F.when(F.col("client_id") % 10 == 3, 1).otherwise(F.col("groupe_client_id"))
    return _with(ops, client=ops["client"].filter("client_id % 25 <> 7")
                 .withColumn("groupe_client_id", moved))


def first_employees(ops: OperationalSource) -> OperationalSource:
    return _with(ops, employe=ops["employe"].filter("employe_id % 25 <> 9"))


def second_employees(ops: OperationalSource) -> OperationalSource:
    raised = F.when(F.col("employe_id") % 10 == 3, F.col("salaire") + 10000).otherwise(
        F.col("salaire")).cast("decimal(12,2)")
    return _with(ops, employe=ops["employe"].filter("employe_id % 25 <> 7")
                 .withColumn("salaire", raised))


def _two_loads(versions: Callable[[int], DataFrame], dim: str, first: date, second: date,
               ) -> DataFrame:
    """The history after two loads, each stored as the pipeline stores it."""
    spark = SparkSession.active()
    made = Warehouse(spark, scratch_dir(spark, "historique"))
    _, natural, cle = dimensions.HISTORISED[dim]
    entry = None
    for load, day in ((1, first), (2, second)):
        entry, _ = histories.load(made, dim, cut_lineage(versions(load), "lot"), natural, cle, day,
                                  entry)
    return made.open(dim, entry)


def client_history(ops: OperationalSource, first: date, second: date) -> DataFrame:
    def versions(load: int) -> DataFrame:
        arrived, day = (first_clients(ops), first) if load == 1 else (second_clients(ops), second)
        return dimensions.client_versions(staging.clients(arrived), day)
    return _two_loads(versions, "dim_client", first, second)


def employee_history(ops: OperationalSource, first: date, second: date) -> DataFrame:
    def versions(load: int) -> DataFrame:
        arrived, day = ((first_employees(ops), first) if load == 1
                        else (second_employees(ops), second))
        return dimensions.employee_versions(staging.employees(arrived, day), day)
    return _two_loads(versions, "dim_employe", first, second)


# --- queries of the operational tables -----------------------------------------------------------

def _dim(name: str):
    table, natural, cle = dimensions.OVERWRITTEN[name]
    builders = {"canal": staging.channels, "geographie_full": staging.geography,
                "fournisseur_full": staging.suppliers, "produit_full": staging.products}

    def build(ops: OperationalSource) -> DataFrame:
        return scd.scd1_reload(builders[table](ops), natural, cle)[0]
    return build


def dim_date(ops: OperationalSource) -> DataFrame:
    days = dimensions.whole_years(ops["commande"], "date_commande")
    return dimensions.date_attributes(days, "jour")


def surrogate_keys(ops: OperationalSource) -> DataFrame:
    """Keys after a load that knew the active products, then one that knows all."""
    first = keys.extend_key_map(None, ops["produit"].filter("actif"),
                                "produit_id", "cle_produit")
    return keys.extend_key_map(first, ops["produit"], "produit_id", "cle_produit")


def current_contract(ops: OperationalSource) -> DataFrame:
    return staging.employees(ops, FIRST_LOAD).select(
        "employe_id", "type_contrat_courant", "date_debut_contrat", "date_fin_contrat",
        "statut_contrat", "nb_contrats_signes")


def sales_staff_semi(ops: OperationalSource) -> DataFrame:
    """Orders taken by each member of the sales department."""
    staff = tables.of_department(ops["employe"], staging.organisation(ops), L.SALES_DEPARTMENT)
    return (ops["commande"].groupBy("employe_id").agg(F.count(F.lit(1)).alias("nb_commandes"))
            .join(staff.select("employe_id"), "employe_id", "left_semi"))


def insert_absent_clients(ops: OperationalSource) -> DataFrame:
    columns = ["client_id", "groupe_client_id", "ville_id"]
    return tables.insert_if_absent(first_clients(ops)["client"].select(*columns),
                                   second_clients(ops)["client"].select(*columns),
                                   ["client_id"])


def org_tree_expand(ops: OperationalSource) -> DataFrame:
    """Every group of the organisation tree with its path and its employees."""
    staff = ops["employe"].groupBy("org_groupe_id").agg(F.count(F.lit(1)).alias("n"))
    return (staging.organisation(ops).join(staff, "org_groupe_id", "left")
            .withColumn("nb_employes", F.coalesce("n", F.lit(0))).drop("n"))


def product_tree_expand(ops: OperationalSource) -> DataFrame:
    """Every group of the product tree with its path and its products."""
    held = ops["produit"].groupBy("groupe_produit_id").agg(F.count(F.lit(1)).alias("n"))
    return (ops["groupe_produit"].join(ops["categorie_produit"], "categorie_produit_id")
            .join(ops["ligne_produit"], "ligne_produit_id")
            .join(held, "groupe_produit_id", "left")
            .select("groupe_produit_id", "nom_groupe_produit", "nom_categorie_produit",
                    "nom_ligne_produit", F.coalesce("n", F.lit(0)).alias("nb_produits")))


def age_salary_brackets(ops: OperationalSource) -> DataFrame:
    ages = ops["client"].groupBy(E.age_bracket(
        F.col("date_naissance"), F.lit(FIRST_LOAD)).alias("tranche")).agg(
            F.count(F.lit(1)).alias("nb"))
    pays = ops["employe"].groupBy(E.salary_bracket(F.col("salaire")).alias("tranche")).agg(
        F.count(F.lit(1)).alias("nb"))
    return ages.select(F.lit("age").alias("genre"), "tranche", "nb").unionByName(
        pays.select(F.lit("salaire").alias("genre"), "tranche", "nb"))


def scalar_string_ops(ops: OperationalSource) -> DataFrame:
    name, key = F.col("prenom"), F.col("client_id")
    return ops["client"].select(
        "client_id",
        F.left(F.concat("nom", F.lit(" "), "prenom"), F.lit(20)).alias("nom_coupe"),
        F.right("prenom", F.lit(9)).cast("int").alias("numero"),
        E.card_number(key).alias("numero_carte"),
        E.bulk_text(F.concat(name, F.lit("\t"), "nom", F.lit("\\\n"))).alias("texte_brut"),
        E.row_hash([E.or_empty(F.col("sexe")), name]).alias("hash_nom"),
        F.concat("sexe", F.lit("-"), "prenom").alias("sexe_nom"))


def scalar_date_ops(ops: OperationalSource) -> DataFrame:
    day = F.col("date_commande")
    born = F.make_date(F.lit(1945) + (F.col("commande_id") % 40).cast("int"), F.lit(6),
                       F.lit(15))
    noon = F.timestamp_add("HOUR", F.lit(12), day.cast("timestamp"))
    return ops["commande"].select(
        "commande_id", E.date_key(day).alias("cle_date"),
        F.date_add(day, 1).alias("lendemain"), (F.year(day) - F.year(born)).alias("ecart_annees"),
        F.timestamp_diff("SECOND", F.lit(date(1995, 1, 1)).cast("timestamp"), noon)
        .alias("ecart_secondes"),
        (F.weekday(day) + 1).alias("jour_de_semaine"), F.weekofyear(day).alias("semaine_annee"),
        F.date_format(day, "EEEE").alias("nom_jour"), E.season(day).alias("saison"))


def scalar_math_ops(ops: OperationalSource) -> DataFrame:
    qty, price = F.col("quantite"), F.col("prix_unitaire")
    return ops["ligne_commande"].select(
        "commande_id", "numero_ligne",
        F.round(F.sqrt(qty.cast("double")), 6).alias("racine"),
        F.pow(qty.cast("double"), F.lit(2)).alias("carre"),
        (F.col("produit_id") % 7).alias("reste"),
        F.round(price, 1).alias("prix_arrondi"),
        F.round(100 * F.col("pct_remise") / F.nullif(F.col("pct_remise"), F.lit(0)), 2)
        .alias("rapport"),
        *E.measures(qty, price, F.col("cout_unitaire"), F.col("pct_remise")).values())


def asof_client_version(ops: OperationalSource) -> DataFrame:
    history = client_history(ops, EARLY_LOAD, LATE_LOAD)
    return pricing.client_version_at_date(ops["commande"], history)


def bulk_text_lines(ops: OperationalSource) -> DataFrame:
    """Clients as lines of a bulk-copy file."""
    return bulk_lines(ops["client"].select(
        "client_id", "nom", "prenom", "sexe", "date_naissance", "groupe_client_id")).select(
            F.col("value").alias("ligne"))


def dq_duplicates(ops: OperationalSource, dw: Warehouse) -> DataFrame:
    """Line numbers as stored repeat; the keys of the warehouse must not."""
    stored = quality.duplicates(ops.raw("lineitem"), ["l_orderkey", "l_linenumber"],
                                "lineitem(l_orderkey, l_linenumber)")
    return controls.unique_keys(dw).unionByName(stored)


def dq_orphans(ops: OperationalSource, dw: Warehouse) -> DataFrame:
    """Foreign keys, and those of orders whose client a first load does not hold."""
    lost = quality.orphans(ops["commande"], "client_id", first_clients(ops)["client"],
                           "client_id", "commande.client_id au premier lot")
    return controls.fact_orphans(dw).unionByName(quality.source_orphans(ops)).unionByName(lost)


def dq_scd2(ops: OperationalSource) -> DataFrame:
    """Faults of the two histories after two loads, with their number of versions."""
    reports = []
    for name, history, natural, cle in [
            ("client", client_history(ops, FIRST_LOAD, SECOND_LOAD), "client_id", "cle_client"),
            ("employe", employee_history(ops, FIRST_LOAD, SECOND_LOAD), "employe_id",
             "cle_employe")]:
        faults = quality.history_faults(history, natural, cle)
        versions = history.agg(F.count(F.lit(1)).alias("nb_lignes")).select(
            F.lit("versions").alias("controle"), "nb_lignes")
        reports.append(faults.unionByName(versions).withColumn("dimension", F.lit(name)))
    return reports[0].unionByName(reports[1])


# --- queries of the fact and the warehouse -------------------------------------------------------

def fact_sales(ops: OperationalSource, dw: Warehouse) -> DataFrame:
    """The fact as a full load builds it from the staged lines and the published keys."""
    dims = {d: dw[d] for d in fact.LOOKUPS}
    return fact.build_fact(staging.order_lines(ops, dims=dims), dims)


def fact_rejects(ops: OperationalSource, dw: Warehouse) -> DataFrame:
    """Lines lost per missing dimension when clients without a group and inactive products are
    not loaded."""
    dims = {d: dw[d] for d in fact.LOOKUPS}
    dims["dim_client"] = dims["dim_client"].filter("groupe_client is not null")
    dims["dim_produit"] = dims["dim_produit"].filter("actif")
    return fact.reject_report(staging.order_lines(ops, dims=dims), dims)


def fact_reload_idempotent(ops: OperationalSource, dw: Warehouse) -> DataFrame:
    """The fact per day after the later orders have come again with one more unit a line, twice,
    and inactive products have left their dimension: the lines of these go."""
    again = cut_lineage(staging.order_lines(ops, after=INCREMENT_AFTER).withColumn(
        "quantite", (F.col("quantite") + 1).cast("decimal(12,3)")), "reprise")
    dims = {d: dw[d] for d in fact.LOOKUPS}
    dims["dim_produit"] = dims["dim_produit"].filter("actif")
    entry = dw.manifest()[meta.FACT_JOB]
    for _ in range(2):
        entry, _ = pipeline.fact_entry(dw, again, dims, entry)
    loaded = dw.open(meta.FACT_JOB, entry)
    return loaded.groupBy("cle_date").agg(
        F.count(F.lit(1)).alias("nb_lignes"), F.sum("quantite").alias("quantite"),
        F.sum("montant_net").alias("montant_net"))


def skipped_orders(ops: OperationalSource, dw: Warehouse) -> DataFrame:
    """What the first load has left out when every eleventh order arrives after it."""
    table = f"fait_tardif_{uuid.uuid4().hex[:8]}"
    dims = {d: dw[d] for d in fact.LOOKUPS}
    arrived = staging.order_lines(ops, dims=dims).filter("commande_id % 11 <> 3")
    entry, _ = pipeline.fact_entry(dw, arrived, dims, None, table)
    return controls.skipped_orders(ops, dw, meta.watermark(dw), entry, table)


def dq_model_orphans(ops: OperationalSource) -> DataFrame:
    """References below the orders, and those to clients and employees a first load does not hold."""
    return quality.model_orphans(ops).unionByName(quality.orphans(
        ops["carte_fidelite"], "client_id", first_clients(ops)["client"], "client_id",
        "carte_fidelite.client_id au premier lot")).unionByName(quality.orphans(
            ops["contrat_employe"], "employe_id", first_employees(ops)["employe"], "employe_id",
            "contrat_employe.employe_id au premier lot"))


def order_total_batch(ops: OperationalSource) -> DataFrame:
    """Order totals recomputed for every fifth order; the others keep none."""
    batch = ops["commande"].filter("commande_id % 5 = 0").select("commande_id")
    return tables.order_totals(ops["commande"], ops.unnumbered_lines(), batch).select(
        "commande_id", "montant_total")


def sql_brackets(ops: OperationalSource) -> DataFrame:
    """Clients and employees by bracket, by the functions registered for SQL."""
    E.register_sql_functions(SparkSession.active())
    ages = ops["client"].groupBy(F.expr(f"fn_tranche_age(date_naissance, date'{FIRST_LOAD}')")
                                 .alias("tranche")).agg(F.count(F.lit(1)).alias("nb"))
    pays = ops["employe"].groupBy(F.expr("fn_tranche_salaire(salaire)").alias("tranche")).agg(
        F.count(F.lit(1)).alias("nb"))
    return ages.select(F.lit("age").alias("genre"), "tranche", "nb").unionByName(
        pays.select(F.lit("salaire").alias("genre"), "tranche", "nb"))


def last_runs(dw: Warehouse) -> DataFrame:
    """The runs of the load with their rows, without numbers and times."""
    jobs = [*dimensions.TABLES, "staging", "publication"]
    return (meta.RunLog(dw).latest(1000).filter(F.col("job_name").isin(jobs))
            .select("job_name", "status", "rows_in", "rows_out"))


def wipe_and_reload(ops: OperationalSource) -> DataFrame:
    """Rows per table after a load, after a wipe, and after another load."""
    spark = SparkSession.active()
    made = Warehouse(spark, scratch_dir(spark, "vide"))
    found = []
    for step, act in enumerate((lambda: pipeline.run(ops, made, FIRST_LOAD),
                                lambda: pipeline.wipe(made),
                                lambda: pipeline.run(ops, made, FIRST_LOAD))):
        act()
        found.append(verify.row_counts(made).withColumn("etape", F.lit(step)))
    return found[0].unionByName(found[1]).unionByName(found[2])


def dim_date_growth(ops: OperationalSource) -> DataFrame:
    """Days per year after a load of the earlier orders, one that adds nothing, one of all."""
    spark = SparkSession.active()
    made = Warehouse(spark, scratch_dir(spark, "dates"))
    log = meta.RunLog(made)
    early = ops.orders().filter(F.col("date_commande") <= F.lit(GROWTH_UNTIL))
    found = []
    for step, orders in enumerate((early, early, ops.orders())):
        with log.run("dim_date") as run:
            made.commit({"dim_date": pipeline.date_entry(made, run, orders, None)})
        found.append(made["dim_date"].groupBy("annee").agg(
            F.count(F.lit(1)).alias("nb_jours")).withColumn("etape", F.lit(step)))
    return found[0].unionByName(found[1]).unionByName(found[2])


def watermark_after_load(ops: OperationalSource, dw: Warehouse) -> DataFrame:
    """The mark after the load, and what a later load without new orders makes of it."""
    marks = dw["watermark"].filter(F.col("job_name") == meta.FACT_JOB)
    nothing = ops.orders(after=meta.watermark(dw)).agg(F.max("date_commande").alias("jour"))
    later = meta.merged_watermark(marks, meta.FACT_JOB, nothing, meta.now())
    return later.select("job_name", F.col("last_value").cast("date").alias("last_value"))


def single_order_trace(ops: OperationalSource, dw: Warehouse) -> DataFrame:
    return pipeline.run_single_order(ops, dw, FIRST_LOAD).drop("mois_cle")


def stream_fact_load(ops: OperationalSource, dw: Warehouse) -> DataFrame:
    """The fact per month when its lines arrive as a stream of files, earlier orders first."""
    spark = dw.spark
    table = f"fait_flux_{uuid.uuid4().hex[:8]}"
    landing = scratch_dir(spark, "arrivee")
    (conform(staging.order_lines(ops), "lignes_commande")
     .repartitionByRange("date_commande", "commande_id", "numero_ligne")
     .write.parquet(landing))
    # Three batches or so: each adds to months that an earlier one has begun.
    stream = fact_stream.read_lines(spark, landing, files_per_batch=max(
        1, -(-len(dw._list(landing)) // 3)))
    query = fact_stream.load_available(stream, dw, scratch_dir(spark, "flux"), table)
    query.awaitTermination()
    return dw[table].groupBy("mois_cle").agg(
        F.count(F.lit(1)).alias("nb_lignes"), F.sum("montant_net").alias("montant_net"),
        F.sum("montant_marge").alias("montant_marge"))


OF_SOURCE: dict[str, Callable[[OperationalSource], DataFrame]] = {
    "stage_canal": staging.channels,
    "stage_geographie": staging.geography,
    "stage_fournisseur": staging.suppliers,
    "stage_produit": staging.products,
    "stage_client": staging.clients,
    "stage_employe": lambda ops: staging.employees(ops, FIRST_LOAD),
    "stage_order_lines": staging.order_lines,
    "incremental_lines": lambda ops: staging.order_lines(ops, after=INCREMENT_AFTER),
    "current_contract": current_contract,
    "dim_date": dim_date,
    "dim_canal": _dim("dim_canal"),
    "dim_geographie": _dim("dim_geographie"),
    "dim_fournisseur": _dim("dim_fournisseur"),
    "dim_produit": _dim("dim_produit"),
    "surrogate_keys": surrogate_keys,
    "scd2_client": lambda ops: client_history(ops, FIRST_LOAD, SECOND_LOAD),
    "scd2_employe": lambda ops: employee_history(ops, FIRST_LOAD, SECOND_LOAD),
    "asof_client_version": asof_client_version,
    "price_at_date": pricing.price_at_date,
    "discount_at_date": pricing.discount_at_date,
    "order_total_rollup": lambda ops: tables.order_totals(
        ops["commande"], ops.unnumbered_lines()).select("commande_id", "montant_total"),
    "order_total_batch": order_total_batch,
    "sql_brackets": sql_brackets,
    "wipe_and_reload": wipe_and_reload,
    "dim_date_growth": dim_date_growth,
    "sales_staff_semi": sales_staff_semi,
    "insert_if_absent": insert_absent_clients,
    "org_tree_expand": org_tree_expand,
    "product_tree_expand": product_tree_expand,
    "price_view": lambda ops: ops.price_view(),
    "bulk_text_lines": bulk_text_lines,
    "age_salary_brackets": age_salary_brackets,
    "scalar_string_ops": scalar_string_ops,
    "scalar_date_ops": scalar_date_ops,
    "scalar_math_ops": scalar_math_ops,
    "dq_ranges": quality.source_ranges,
    "dq_model_orphans": dq_model_orphans,
    "dq_scd2": dq_scd2,
}

OF_BOTH: dict[str, Callable[[OperationalSource, Warehouse], DataFrame]] = {
    "fact_sales": fact_sales,
    "fact_rejects": fact_rejects,
    "fact_reload_idempotent": fact_reload_idempotent,
    "watermark_after_load": watermark_after_load,
    "single_order_trace": single_order_trace,
    "stream_fact_load": stream_fact_load,
    "dq_orphans": dq_orphans,
    "dq_duplicates": dq_duplicates,
    "skipped_orders": skipped_orders,
}

OF_WAREHOUSE: dict[str, Callable[[Warehouse], DataFrame]] = {
    **analytics.QUESTIONS,
    "q3_marginal_products": lambda dw: analytics.marginal_products(
        dw, QUESTION_COUNTRY, QUESTION_YEAR),
    "q4_group_margin": lambda dw: analytics.group_margin(dw, QUESTION_GROUP),
    "last_runs": last_runs,
    "verify_row_counts": verify.row_counts,
    "verify_contracts": verify.contracts,
    "verify_top_reps": verify.top_reps,
    "publish_row_counts": verify.key_ranges,
}


def _rounded(df: DataFrame) -> DataFrame:
    """Doubles that come out of floating-point sums, to the digits that do not depend on the
    order of summation."""
    return df.selectExpr(*[
        f"round({f.name}, 4) {f.name}" if isinstance(f.dataType, T.DoubleType) else f.name
        for f in df.schema])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    made: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for name, of_source in OF_SOURCE.items():
        made[name] = lambda spark, folder, q=of_source: portable(
            q(RetailParquet(spark, folder)))
    for name, of_both in OF_BOTH.items():
        made[name] = lambda spark, folder, q=of_both: portable(
            q(RetailParquet(spark, folder), warehouse(spark, folder)))
    for name, of_warehouse in OF_WAREHOUSE.items():
        made[name] = lambda spark, folder, q=of_warehouse: _rounded(portable(
            q(warehouse(spark, folder))))
    return made
