"""Operational model derived from a folder of TPC-H-like parquet tables.

The columns the operational model has and the parquet tables lack are derived from their keys by
arithmetic, so every table grows with its origin and is the same on every run.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stardw.functions import labels as L
from stardw.operators import skew
from stardw.operators.ranking import number_by_range, number_in_groups
from stardw.operators.skew import hot_keys
from stardw.session import counted_cut, lasting_scratch, local_rows
from stardw.sources.operational import OperationalSource

# Employees: at least so many, and one more for every so many orders.
LEAST_EMPLOYEES = 70
ORDERS_PER_EMPLOYEE = 20_000

_facts_known: dict[tuple, object] = {}

LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
              "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def _text(value: Column) -> Column:
    return value.cast("string")


def _pad(value: Column, width: int) -> Column:
    return F.lpad(_text(value), width, "0")


def _percent(value: Column) -> Column:
    return value.cast("decimal(3,0)") * F.expr("0.01BD")


def _windows(*windows: tuple) -> Column:
    """Array of (k, first day, last day or None[, label]) to explode next to each row."""
    return F.array(*[
        F.struct(F.lit(k).alias("k"), F.lit(d0).cast("date").alias("d0"),
                 F.lit(d1).cast("date").alias("d1"), *[F.lit(x).alias("label") for x in more])
        for k, d0, d1, *more in windows])


class RetailParquet(OperationalSource):
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._raw: dict[str, DataFrame] = {}
        self._built: dict[str, DataFrame] = {}
        self._selected: dict[date, tuple[DataFrame, int]] = {}
        super().__init__(self._build)

    def raw(self, name: str) -> DataFrame:
        if name not in self._raw:
            self._raw[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._raw[name]

    def _build(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = getattr(self, f"_{name}")()
        return self._built[name]

    def state(self, *tables: str) -> tuple:
        """Size and age of the files of tables, to tell when they have been written anew."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        found = []
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{table}.parquet")
            fs = path.getFileSystem(conf)
            found.append((table, fs.getContentSummary(path).getLength(),
                          fs.getFileStatus(path).getModificationTime()))
        return (self.spark.sparkContext.applicationId, self.folder, *found)

    def _once(self, table: str, what: str, find):
        """Small facts about a table, found once per session and state of its files."""
        known = (*self.state(table), what)
        if known not in _facts_known:
            with lasting_scratch():
                _facts_known[known] = find()
        return _facts_known[known]

    def _numbered_labels(self, table: str, column: str, id_name: str, name: str) -> DataFrame:
        """The distinct values of a label column, numbered from 1 in their order. No value: none."""
        distinct = (self.raw(table).select(F.col(column).alias(name))
                    .filter(F.col(name).isNotNull()).distinct())
        numbered = self._once(table, column, lambda: number_by_range(
            distinct, [], [name], id_name))
        return numbered.select(F.col(id_name).cast("int").alias(id_name), name)

    # --- geography ---------------------------------------------------------------------------

    def _continent(self):
        return self.raw("region").select(
            F.col("r_regionkey").alias("continent_id"), F.col("r_name").alias("nom_continent"))

    def _pays(self):
        return self.raw("nation").select(
            F.col("n_nationkey").alias("pays_id"),
            _pad(F.col("n_nationkey"), 2).alias("code_pays"),
            F.col("n_name").alias("nom_pays"), F.col("n_regionkey").alias("continent_id"))

    def _region(self):
        return (self.raw("nation")
                .withColumn("k", F.explode(F.array(F.lit(0), F.lit(1))))
                .select((F.col("n_nationkey") * 2 + F.col("k")).alias("region_id"),
                        F.concat("n_name", F.lit("-R"), _text(F.col("k"))).alias("nom_region"),
                        F.col("n_nationkey").alias("pays_id")))

    def _ville(self):
        number = F.col("region_id") * 2 + F.col("k")
        return (self["region"]
                .withColumn("k", F.explode(F.array(F.lit(0), F.lit(1))))
                .select(number.alias("ville_id"),
                        F.concat(F.lit("V"), _text(number)).alias("nom_ville"),
                        F.when(number % 7 != 0, _pad(number, 5)).alias("code_postal"),
                        "region_id"))

    # --- clients -----------------------------------------------------------------------------

    def _groupe_client(self):
        return self._numbered_labels("customer", "c_mktsegment", "groupe_client_id",
                                     "nom_groupe_client")

    def _client(self):
        key = F.col("c_custkey")
        born = F.make_date(*[part.cast("int") for part in (
            1940 + key % 60, 1 + key % 12, 1 + key % 28)])
        return (self.raw("customer")
                .withColumnRenamed("c_mktsegment", "nom_groupe_client")
                .join(self["groupe_client"], "nom_groupe_client", "left")
                .select(
                    key.alias("client_id"), F.lit("Client").alias("nom"),
                    F.col("c_name").alias("prenom"),
                    F.when(key % 11 == 0, None).when(key % 2 == 0, "F").otherwise("M")
                    .alias("sexe"),
                    F.when(key % 13 != 0, born).alias("date_naissance"),
                    F.when(key % 17 != 0, F.col("groupe_client_id")).alias("groupe_client_id"),
                    (F.col("c_nationkey") * 4 + key % 4).alias("ville_id"),
                    (key % 20 != 0).alias("actif"),
                    self._stamp(key).alias("maj_le")))

    def _carte_fidelite(self):
        key = F.col("c_custkey")
        return self.raw("customer").filter(key % 4 == 0).select(
            key.alias("carte_fidelite_id"), key.alias("client_id"),
            F.concat(F.lit("C-"), _pad(key, 8)).alias("numero_carte"))

    @staticmethod
    def _stamp(key: Column) -> Column:
        day = F.date_add(F.lit(date(1995, 1, 1)), (key % 1000).cast("int"))
        return day.cast("timestamp_ntz")

    # --- suppliers and products --------------------------------------------------------------

    def _fournisseur(self):
        return self.raw("supplier").select(
            F.col("s_suppkey").alias("fournisseur_id"),
            F.col("s_name").alias("nom_fournisseur"), F.col("s_nationkey").alias("pays_id"))

    def _ligne_produit(self):
        return self._numbered_labels("part", "p_type", "ligne_produit_id", "nom_ligne_produit")

    def _categorie_produit(self):
        return (self["ligne_produit"]
                .withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(3))))
                .select((F.col("ligne_produit_id") * 4 + F.col("k"))
                        .alias("categorie_produit_id"),
                        F.concat("nom_ligne_produit", F.lit("-"), _text(F.col("k")))
                        .alias("nom_categorie_produit"), "ligne_produit_id"))

    def _groupe_produit(self):
        entry, premium = L.PRODUCT_GROUP_PREFIXES
        prefix = F.when(F.col("k") == 0, entry).otherwise(premium)
        return (self["categorie_produit"]
                .withColumn("k", F.explode(F.array(F.lit(0), F.lit(1))))
                .select((F.col("categorie_produit_id") * 2 + F.col("k"))
                        .alias("groupe_produit_id"),
                        F.concat(prefix, "nom_categorie_produit").alias("nom_groupe_produit"),
                        "categorie_produit_id"))

    def _produit(self):
        key = F.col("p_partkey")
        suppliers = self.raw("supplier").agg(F.count(F.lit(1)).alias("n")).scalar()
        group = ((F.col("ligne_produit_id") * 4 + F.col("p_size") % 4) * 2
                 + F.when(F.col("p_retailprice") >= 950, 1).otherwise(0))
        return (self.raw("part")
                .withColumnRenamed("p_type", "nom_ligne_produit")
                .join(self["ligne_produit"], "nom_ligne_produit", "left")
                .select(key.alias("produit_id"),
                        F.concat("p_name", F.lit(" "), _text(key)).alias("nom_produit"),
                        group.alias("groupe_produit_id"),
                        (key % suppliers).alias("fournisseur_id"),
                        (key % 50 != 0).alias("actif")))

    def _historique_prix(self):
        key, k = F.col("p_partkey"), F.col("w.k")
        price = F.col("p_retailprice").cast("decimal(12,2)")
        return (self.raw("part")
                .withColumn("w", F.explode(_windows(
                    (0, "1995-01-01", "1996-12-31"), (1, "1997-01-01", "1998-12-31"),
                    (2, "1999-01-01", None))))
                .filter(~((key % 40 == 0) & (k == 0)))
                .select((key * 3 + k).alias("prix_id"), key.alias("produit_id"),
                        F.col("w.d0").alias("date_debut"), F.col("w.d1").alias("date_fin"),
                        (price * _percent(40 + key % 37 + 5 * k)).cast("decimal(12,2)")
                        .alias("cout"),
                        (price * _percent(100 + 10 * k)).cast("decimal(12,2)")
                        .alias("prix_vente")))

    def _remise_produit(self):
        key, k = F.col("p_partkey"), F.col("w.k")
        return (self.raw("part")
                .filter(key % 10 < 3)
                .withColumn("w", F.explode(_windows(
                    (0, "1996-03-01", "1996-05-31"), (1, "1996-05-01", "1997-06-30"))))
                .select((key * 2 + k).alias("remise_id"), key.alias("produit_id"),
                        F.col("w.d0").alias("date_debut"), F.col("w.d1").alias("date_fin"),
                        _percent(5 + key % 20 + k).cast("decimal(5,4)").alias("pct_remise")))

    # --- organisation ------------------------------------------------------------------------

    def _org_pays(self):
        return self.raw("region").select(
            F.col("r_regionkey").alias("org_pays_id"), F.col("r_name").alias("nom_org_pays"))

    def _org_compagnie(self):
        return self["org_pays"].select(
            F.col("org_pays_id").alias("org_compagnie_id"),
            F.concat(F.lit("Compagnie "), "nom_org_pays").alias("nom_org_compagnie"),
            "org_pays_id")

    def _org_departement(self):
        names = F.array(*[F.lit(d) for d in L.DEPARTMENTS])
        return (self["org_compagnie"]
                .select("org_compagnie_id", F.posexplode(names).alias("k", "nom"))
                .select((F.col("org_compagnie_id") * 6 + F.col("k")).alias("org_departement_id"),
                        F.col("nom").alias("nom_org_departement"), "org_compagnie_id"))

    def _org_section(self):
        return self["org_departement"].select(
            F.col("org_departement_id").alias("org_section_id"),
            F.concat(F.lit(L.SECTION_PREFIX), "nom_org_departement").alias("nom_org_section"),
            "org_departement_id")

    def _org_groupe(self):
        prefixes = F.array(*[F.lit(p) for p in L.ORG_GROUP_PREFIXES])
        return (self["org_section"]
                .select("org_section_id", "nom_org_section",
                        F.posexplode(prefixes).alias("k", "prefixe"))
                .select((F.col("org_section_id") * 2 + F.col("k")).alias("org_groupe_id"),
                        F.concat("prefixe", "nom_org_section").alias("nom_org_groupe"),
                        "org_section_id"))

    def _employe(self):
        e = F.col("employe_id")
        department = F.when(e % 10 < 8, L.DEPARTMENTS.index("Ventes")).otherwise(
            L.DEPARTMENTS.index("Finance"))
        group = ((e % 5) * 6 + department) * 2 + F.when(e % 3 == 0, 0).otherwise(1)
        return (self.raw("orders")
                .select(self._taken_by().alias("employe_id")).distinct()
                .select(e, F.lit("Emp").alias("nom"),
                        F.concat(F.lit("E"), _text(e)).alias("prenom"),
                        F.when(e % 2 == 0, "F").otherwise("M").alias("sexe"),
                        F.concat(_text(1945 + e % 40), F.lit("-06-15")).cast("date")
                        .alias("date_naissance"),
                        F.concat(_text(1985 + e % 10), F.lit("-01-01")).cast("date")
                        .alias("date_embauche"),
                        F.when(e % 23 == 0, F.lit(date(1999, 12, 31))).alias("date_depart"),
                        (25000 + (e * 7919) % 110000).cast("decimal(12,2)").alias("salaire"),
                        F.when(e % 5 != 0, e - e % 5).alias("manager_id"),
                        group.cast("int").alias("org_groupe_id"),
                        self._stamp(e).alias("maj_le")))

    def _taken_by(self) -> Column:
        """The employee of an order. The staff grows with the orders, in steps."""
        orders = self.raw("orders").agg(F.count(F.lit(1)).alias("n")).scalar()
        return F.col("o_orderkey") % (LEAST_EMPLOYEES + F.call_function(
            "div", orders, F.lit(ORDERS_PER_EMPLOYEE).cast("long")))

    def _contrat_employe(self):
        e, k = F.col("employe_id"), F.col("w.k")
        return (self["employe"]
                .filter(e % 7 != 0)
                .withColumn("w", F.explode(_windows(
                    (0, "1995-01-01", "1996-12-31", "CDD"),
                    (1, "1997-01-01", "1999-06-30", "CDD"),
                    (2, "1999-07-01", None, "CDI"))))
                .filter((e % 3 != 0) | (k < 2))
                .select((e * 3 + k).alias("contrat_id"), e.alias("employe_id"),
                        F.col("w.d0").alias("date_debut"), F.col("w.d1").alias("date_fin"),
                        F.col("w.label").alias("type_contrat")))

    # --- orders ------------------------------------------------------------------------------

    def _canal_vente(self):
        """The channels in which there are orders."""
        channels = local_rows(
            self.spark, L.CHANNELS, "canal_id long, code_canal string, nom_canal string")
        used = self.raw("orders").select((1 + F.col("o_orderkey") % 3).alias("canal_id"))
        return used.distinct().join(channels, "canal_id").select(
            "canal_id", "code_canal", "nom_canal")

    @staticmethod
    def _later(after: date) -> Column:
        """As a bound on the stored timestamp, so that it reaches the scan."""
        return F.col("o_orderdate") >= F.lit(after + timedelta(days=1)).cast("timestamp_ntz")

    def _wanted_orders(self, after: date | None, only: int | None) -> DataFrame:
        raw = self.raw("orders")
        if after is not None:
            raw = raw.filter(self._later(after))
        if only is not None:
            raw = raw.filter(F.col("o_orderkey") == only)
        return raw

    def orders(self, after: date | None = None, only: int | None = None) -> DataFrame:
        key = F.col("o_orderkey")
        return self._wanted_orders(after, only).select(
            key.alias("commande_id"), F.col("o_orderdate").cast("date").alias("date_commande"),
            F.col("o_custkey").alias("client_id"), self._taken_by().alias("employe_id"),
            (1 + key % 3).alias("canal_id"))

    def _commande(self):
        return self.orders()

    def _find_hot(self, what: str, find) -> dict:
        return self._once("orders" if what == "clients" else "lineitem", f"hot {what}", find)

    def hot_orders(self) -> dict:
        return self._find_hot("orders", lambda: hot_keys(self.raw("lineitem"), "l_orderkey"))

    def hot_products(self) -> dict:
        return self._find_hot("products", lambda: hot_keys(self.raw("lineitem"), "l_partkey"))

    def _selected_lines(self, after: date) -> tuple[DataFrame, int]:
        """The stored lines of the orders after the mark and their number, selected once."""
        if after not in self._selected:
            wanted = self._wanted_orders(after, None)
            chosen = self.raw("lineitem").select("l_orderkey", *LINE_ORDER).join(
                wanted.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
            with lasting_scratch():
                self._selected[after] = counted_cut(chosen, "increment")
        return self._selected[after]

    def _takes_most(self, after: date) -> bool:
        """Whether most orders come after the mark, as before a first load. Their lines are then not
        selected and written first: that moves and stores most lines once more."""
        def find() -> bool:
            wanted = F.count_if(self._later(after))
            return bool(self.raw("orders").agg(2 * wanted > F.count(F.lit(1))).first()[0])
        return self._once("orders", f"most after {after}", find)

    def hot_lines(self, key: str, after: date | None = None) -> dict:
        if after is None or self._takes_most(after):
            return super().hot_lines(key)
        raw, n = self._selected_lines(after)
        # Few lines have no key with many.
        return {} if n < skew.HOT_MIN_ROWS else skew.hot_keys(
            raw, {"commande_id": "l_orderkey", "produit_id": "l_partkey"}[key])

    def order_lines(self, after: date | None = None, only: int | None = None) -> DataFrame:
        """Order lines, renumbered per order since the stored line numbers repeat.

        Lines of other orders than those asked for leave before any is sorted or numbered, or when
        that is done if they are the fewer.
        """
        most = only is None and after is not None and self._takes_most(after)
        if only is not None:
            raw = self.raw("lineitem").select("l_orderkey", *LINE_ORDER)
            raw, hot = raw.filter(F.col("l_orderkey") == only), []
        elif after is not None and not most:
            raw, hot = self._selected_lines(after)[0], list(self.hot_lines("commande_id", after))
        else:
            raw = self.raw("lineitem").select("l_orderkey", *LINE_ORDER)
            hot = list(self.hot_orders())
        numbered = number_in_groups(raw, "l_orderkey", LINE_ORDER, "numero_ligne", hot)
        if most:
            numbered = numbered.join(self._wanted_orders(after, None).select(
                F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
        return numbered.select(
            F.col("l_orderkey").alias("commande_id"),
            F.col("numero_ligne").cast("int").alias("numero_ligne"),
            *self._line_values())

    def unnumbered_lines(self) -> DataFrame:
        """Order lines without their number, which costs no shuffle."""
        return self.raw("lineitem").select(F.col("l_orderkey").alias("commande_id"),
                                           *self._line_values())

    @staticmethod
    def _line_values() -> list[Column]:
        # Unit price in whole cents, in integers: doubles would round differently elsewhere.
        cents = (F.col("l_extendedprice").cast("decimal(12,2)") * 100).cast("bigint")
        quantity = F.nullif(F.col("l_quantity").cast("bigint"), F.lit(0))
        price = (F.call_function("div", cents - cents % quantity, quantity)
                 * F.expr("0.01BD")).cast("decimal(12,2)")
        return [
            F.col("l_partkey").alias("produit_id"),
            F.col("l_quantity").cast("decimal(12,3)").alias("quantite"),
            price.alias("prix_unitaire"),
            (price * _percent(40 + F.col("l_partkey") % 37)).cast("decimal(12,2)")
            .alias("cout_unitaire"),
            F.col("l_discount").cast("decimal(5,4)").alias("pct_remise")]

    def _ligne_commande(self):
        return self.order_lines()
