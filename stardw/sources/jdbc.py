"""Reading the operational model from a database, and pushing the warehouse to one."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from stardw.sources.operational import OperationalSource
from stardw.sources.snapshots import Warehouse

# Tables read by parallel range scans on a numeric key; the others are small.
SPLIT_BY = {"commande": "commande_id", "ligne_commande": "commande_id",
            "client": "client_id", "produit": "produit_id", "carte_fidelite": "client_id",
            "historique_prix": "produit_id", "remise_produit": "produit_id"}

# Parents before the fact that refers to them.
PUSH_ORDER = ["dim_date", "dim_canal", "dim_geographie", "dim_fournisseur", "dim_produit",
              "dim_client", "dim_employe", "fait_ventes"]


def read_options(url: str, table: str, schema: str = "ops", *,
                 bounds: tuple[int, int] | None = None, partitions: int = 64,
                 fetch_size: int = 10_000, query: str | None = None) -> dict[str, str]:
    """Options to read a table, or the rows of it that ``query`` gives."""
    options = {"url": url, "dbtable": f"({query}) t" if query else f"{schema}.{table}",
               "fetchsize": str(fetch_size),
               "pushDownPredicate": "true", "pushDownAggregate": "true"}
    if bounds is not None and table in SPLIT_BY:
        options.update(partitionColumn=SPLIT_BY[table], lowerBound=str(bounds[0]),
                       upperBound=str(bounds[1]), numPartitions=str(partitions))
    return options


class JdbcSource(OperationalSource):
    """Operational tables of a database. Filters and column choices reach the database."""

    def __init__(self, spark: SparkSession, url: str, schema: str = "ops",
                 partitions: int = 64, **properties: str):
        self.spark, self.url, self.schema = spark, url, schema
        self.partitions, self.properties = partitions, properties
        self._seen: dict[str, DataFrame] = {}
        super().__init__(self._read)

    def _bounds(self, table: str, of: str | None = None) -> tuple[int, int] | None:
        key = SPLIT_BY.get(table)
        if key is None:
            return None
        of = f"({of}) t" if of else f"{self.schema}.{table}"
        low, high = (self.spark.read.format("jdbc").options(**self.properties)
                     .option("url", self.url)
                     .option("query", f"select min({key}) a, max({key}) b "
                                      f"from {of}").load().first())
        return None if low is None else (int(low), int(high))

    def _read(self, table: str) -> DataFrame:
        if table not in self._seen:
            self._seen[table] = self._load(table)
        return self._seen[table]

    def _load(self, table: str) -> DataFrame:
        options = read_options(self.url, table, self.schema, bounds=self._bounds(table),
                               partitions=self.partitions)
        return (self.spark.read.format("jdbc").options(**self.properties)
                .options(**options).load())

    def order_lines(self, after: date | None = None, only: int | None = None) -> DataFrame:
        """The database chooses the lines of an increment, so that only these travel."""
        if after is None or only is not None:
            return super().order_lines(after, only)
        sql = later_lines(self.schema, after)
        options = read_options(self.url, "ligne_commande", self.schema, query=sql,
                               bounds=self._bounds("ligne_commande", sql),
                               partitions=self.partitions)
        return (self.spark.read.format("jdbc").options(**self.properties)
                .options(**options).load())


def later_lines(schema: str, after: date) -> str:
    """SQL for the lines of orders dated strictly later."""
    return (f"select l.* from {schema}.ligne_commande l join {schema}.commande c "
            f"on c.commande_id = l.commande_id where c.date_commande > date '{after}'")


def write_options(url: str, table: str, schema: str = "dw", *, batch: int = 10_000,
                  writers: int = 16) -> dict[str, str]:
    # "truncate" empties the table and keeps its definition, constraints and indexes; the
    # cascade lets a parent be emptied before its children are filled again.
    return {"url": url, "dbtable": f"{schema}.{table}", "batchsize": str(batch),
            "numPartitions": str(writers), "truncate": "true", "cascadeTruncate": "true"}


def push(warehouse: Warehouse, url: str, schema: str = "dw", **properties: str) -> None:
    """Replace the tables of a database by the published ones, keys as they are."""
    for table in PUSH_ORDER:
        rows = warehouse[table]
        if table == "fait_ventes":
            rows = rows.drop("mois_cle")
        (rows.write.format("jdbc").mode("overwrite").options(**properties)
         .options(**write_options(url, table, schema)).save())
