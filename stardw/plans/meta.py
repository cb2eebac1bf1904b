"""Run log and high-water marks."""

from __future__ import annotations

import json
import threading
import uuid
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import UTC, date, datetime, timedelta

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stardw.functions import labels as L
from stardw.schemas import schema_of
from stardw.session import local_rows
from stardw.sources.snapshots import Overtaken, Warehouse

FACT_JOB = "fait_ventes"
RUNNING, LOST = "RUNNING", "LOST"
# A driver renews its lease three times in it.
LEASE_SECONDS = 120
# Files of closed runs beyond which they become a table.
MOST_FILES = 200


def now() -> datetime:
    """UTC, to the millisecond, without zone."""
    t = datetime.now(UTC).replace(tzinfo=None)
    return t.replace(microsecond=t.microsecond // 1000 * 1000)


@dataclass
class Run:
    run_id: int
    job_name: str
    started_at: datetime
    rows_in: int | None = None
    rows_out: int | None = None


class RunLog:
    """Small files apart from the manifest: one when a run starts, one when it ends.

    A load that fails leaves its trace. A driver holds a lease that it renews as long as it has open
    runs; a run that is open while the lease of its driver has expired is closed as LOST by the next
    load. Drivers that write at the same time take different numbers. Beyond ``MOST_FILES`` the files
    of closed runs become one table, which a file named by its highest number points to, so that
    little is listed however long the log.
    """

    def __init__(self, warehouse: Warehouse, prefix: str = "", lease_seconds: float = LEASE_SECONDS):
        self.spark: SparkSession = warehouse.spark
        self.prefix = prefix
        self.warehouse = warehouse
        self.path = f"{warehouse.root}/_run_log"
        self.lease_seconds = lease_seconds
        self.holder = uuid.uuid4().hex[:12]
        self._lock = threading.Lock()
        self._next: int | None = None
        self._open = 0
        # Rows that the ended jobs of this load gave.
        self.rows_out: dict[str, int | None] = {}

    # --- reading -----------------------------------------------------------------------------

    def read(self) -> DataFrame:
        schema = schema_of("run_log")
        rows = local_rows(self.spark, [], schema)
        table = self._table()[1]
        if table:
            rows = rows.unionByName(self.spark.read.schema(schema).parquet(table))
        if self._names():
            rows = rows.unionByName(self.spark.read.schema(schema).json(f"{self.path}/*.json"))
        # The end of a run counts, and its start only while there is no end.
        last = F.max_by(F.struct(*schema.names), F.col("status") != RUNNING)
        return rows.groupBy("run_id").agg(last.alias("r")).select("r.*")

    def _names(self) -> list[str]:
        """Files of runs; what a crash has left of one being written doesn't count."""
        return [n for n in self.warehouse._list(self.path) if n.endswith(".json")]

    def _table(self) -> tuple[int, str | None]:
        """Highest number and folder of the newest table of closed runs."""
        found = self.warehouse._list(f"{self.path}/_tables")
        pointers = [n for n in found if n.endswith(".pointer")]
        if not pointers:
            return 0, None
        folder = self.warehouse._read_text(f"{self.path}/_tables/{pointers[-1]}").strip()
        return int(pointers[-1].split(".")[0]), f"{self.path}/_tables/{folder}"

    # --- numbers and leases ------------------------------------------------------------------

    def _new_id(self) -> int:
        with self._lock:
            if self._next is None:
                names = self._names()
                self._next = 1 + max((int(n.split(".")[0]) for n in names), default=0)
                self._next = max(self._next, 1 + self._table()[0])
            run_id, self._next = self._next, self._next + 1
            return run_id

    def _renew(self) -> None:
        until = now() + timedelta(seconds=self.lease_seconds)
        fs, at = self.warehouse._fs(f"{self.path}/_leases/{self.holder}")
        stream = fs.create(at, True)
        stream.write(bytearray(until.isoformat(), "utf-8"))
        stream.close()

    def _expired(self, holder: str | None) -> bool:
        fs, at = self.warehouse._fs(f"{self.path}/_leases/{holder}")
        try:
            return datetime.fromisoformat(self.warehouse._read_text(str(at.toString()))) < now()
        except (Py4JJavaError, ValueError):  # none, or it is just being renewed
            return not fs.exists(at)

    def _heartbeat(self) -> None:
        while self._open:
            self._renew()
            self._wake.wait(self.lease_seconds / 3)

    def _begin(self) -> None:
        with self._lock:
            self._open += 1
            if self._open > 1:
                return
        self._renew()
        self._wake = threading.Event()
        threading.Thread(target=self._heartbeat, daemon=True).start()

    def _end(self) -> None:
        with self._lock:
            self._open -= 1
            if not self._open:
                self._wake.set()

    def close_lost(self) -> list[int]:
        """Close the open runs whose driver has let its lease expire."""
        names = self._names()
        ended = {n.split(".")[0] for n in names if ".start." not in n}
        lost = []
        for name in names:
            if ".start." not in name or name.split(".")[0] in ended:
                continue
            row = json.loads(self.warehouse._read_text(f"{self.path}/{name}"))
            if not self._expired(row.get("holder")):
                continue
            row |= {"status": LOST, "ended_at": now().isoformat(),
                    "error_msg": "the driver ended without closing the run"}
            try:
                self.warehouse._publish_text(f"{self.path}/{row['run_id']:012d}.json", json.dumps(row))
            except Overtaken:  # closed meanwhile
                continue
            lost.append(row["run_id"])
        return lost

    def compact(self, most: int = MOST_FILES) -> bool:
        """Put the files of closed runs into one table if there are more than ``most``."""
        names = self._names()
        closed = [n for n in names if ".start." not in n]
        if len(closed) <= most:
            return False
        before, table = self._table()
        schema = schema_of("run_log")
        rows = self.spark.read.schema(schema).json([f"{self.path}/{n}" for n in closed])
        if table:
            rows = rows.unionByName(self.spark.read.schema(schema).parquet(table))
        folder = f"rows-{uuid.uuid4().hex[:12]}"
        rows.dropDuplicates(["run_id"]).coalesce(1).write.parquet(f"{self.path}/_tables/{folder}")
        highest = max(before, *[int(n.split(".")[0]) for n in closed])
        try:
            self.warehouse._publish_text(
                f"{self.path}/_tables/{highest:012d}.pointer", folder)
        except Overtaken:  # another driver has just done so
            return False
        # The rows are in the table now; a reader that sees both takes one.
        done = {n.split(".")[0] for n in closed}
        for name in names:
            if name.split(".")[0] in done:
                fs, at = self.warehouse._fs(f"{self.path}/{name}")
                fs.delete(at, False)
        return True

    # --- writing -----------------------------------------------------------------------------

    @contextmanager
    def run(self, job: str):
        """Open a run as RUNNING, let the caller set its counts, close it as SUCCESS or FAIL."""
        if self._next is None:
            self.close_lost()
            self.compact()
        self._begin()
        try:
            while True:
                run = Run(self._new_id(), self.prefix + job, now())
                try:
                    self._append(run, RUNNING, None)
                    break
                except Overtaken:  # another driver took the number
                    self._next = None
            try:
                yield run
            except Exception as problem:
                self._append(run, "FAIL", str(problem))
                raise
            self._append(run, "SUCCESS", None)
            self.rows_out[job] = run.rows_out
        finally:
            self._end()

    def _append(self, run: Run, status: str, error: str | None) -> None:
        done = status == "SUCCESS"
        ended = status != RUNNING
        name = f"{run.run_id:012d}{'' if ended else '.start'}.json"
        self.warehouse._publish_text(f"{self.path}/{name}", json.dumps({
            "run_id": run.run_id, "job_name": run.job_name,
            "started_at": run.started_at.isoformat(),
            "ended_at": now().isoformat() if ended else None,
            "status": status, "rows_in": run.rows_in if done else None,
            "rows_out": run.rows_out if done else None, "error_msg": error,
            "holder": self.holder}))

    def latest(self, n: int = 20) -> DataFrame:
        """The last runs and how many second boundaries each crossed."""
        seconds = (F.unix_seconds(F.col("ended_at").cast("timestamp"))
                   - F.unix_seconds(F.col("started_at").cast("timestamp")))
        return (self.read()
                .select("run_id", "job_name", "started_at", "ended_at", "status", "rows_in",
                        "rows_out", seconds.alias("duree_sec"), "error_msg")
                .orderBy(F.desc("run_id")).limit(n))


def watermark(warehouse: Warehouse, job: str = FACT_JOB) -> date:
    """The last day loaded, or a day before all data."""
    if "watermark" not in warehouse:
        return L.FIRST_WATERMARK
    row = (warehouse["watermark"].filter(F.col("job_name") == job)
           .agg(F.max("last_value").alias("v")).first())
    return row["v"].date() if row["v"] else L.FIRST_WATERMARK


def effective_watermark(mark: date, lookback_days: int) -> date:
    """The mark moved back, for orders that arrive late; a load replaces the lines it knows."""
    return mark - timedelta(days=lookback_days) if lookback_days else mark


def merged_watermark(marks: DataFrame, job: str, highest: DataFrame,
                     at: datetime) -> DataFrame:
    """The marks after a load of ``highest`` (one row, column ``jour``, NULL if empty)."""
    arrived = (highest.filter(F.col("jour").isNotNull())
               .select(F.lit(job).alias("job_name"),
                       F.col("jour").cast("timestamp_ntz").alias("last_value"),
                       F.lit(at).cast("timestamp_ntz").alias("updated_at")))
    return marks.join(arrived, "job_name", "left_anti").unionByName(arrived)
