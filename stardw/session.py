"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

_local_roots: dict[str, str] = {}
_marked: set[str] = set()
# The folder of the load that the thread works for, if it deletes what it writes on the way.
_load = threading.local()


def build_session(app: str = "stardw", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the loads expect; ``conf`` overrides or extends them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
        # Call sites of Python column calls are only needed to debug; they slow plan building.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, for checkpoints and written intermediate tables.

    It is the one the cluster names in ``spark.checkpoint.dir``. Where that is unset, only a
    local session gets a folder of its own; on a cluster it is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = sc.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="stardw-")
    return _local_roots[app]


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _application_folder(spark: SparkSession) -> str:
    """Folder of this application under the shared root, which goes when the driver ends."""
    path = f"{shared_root(spark)}/stardw-{spark.sparkContext.applicationId}"
    if path not in _marked:
        fs, at = _file_system(spark, path)
        fs.mkdirs(at)
        fs.deleteOnExit(at)
        _marked.add(path)
    return path


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared root, owned by this application."""
    folder = getattr(_load, "folder", None) or _application_folder(spark)
    return f"{folder}/{label}-{uuid.uuid4().hex[:12]}"


@contextmanager
def passing_scratch(spark: SparkSession) -> Iterator[None]:
    """What the thread writes on the way goes when the block ends: for loads that publish what they
    make and give back nothing that reads it. Inside another such block it goes with that one's."""
    if getattr(_load, "folder", None):
        yield
        return
    _load.folder = folder = f"{_application_folder(spark)}/load-{uuid.uuid4().hex[:12]}"
    try:
        yield
    finally:
        _load.folder = None
        fs, at = _file_system(spark, folder)
        fs.delete(at, True)


@contextmanager
def lasting_scratch() -> Iterator[None]:
    """What the thread writes stays as long as the application: for what is kept for later loads."""
    folder, _load.folder = getattr(_load, "folder", None), None
    try:
        yield
    finally:
        _load.folder = folder


def same_scratch(do: Callable) -> Callable:
    """``do`` for another thread, which writes where this one does."""
    folder = getattr(_load, "folder", None)

    def run():
        _load.folder = folder
        try:
            return do()
        finally:
            _load.folder = None
    return run


def sweep(spark: SparkSession, days: float = 7) -> list[str]:
    """Delete what drivers that died have left under the shared root: folders of other applications
    in which nothing was written for so long."""
    root = shared_root(spark)
    fs, at = _file_system(spark, root)
    limit = spark._jvm.java.lang.System.currentTimeMillis() - int(days * 86_400_000)
    gone = []
    for found in fs.listStatus(at) if fs.exists(at) else []:
        path = found.getPath()
        if (path.getName().startswith("stardw-") and f"{root}/{path.getName()}" not in _marked
                and max([found.getModificationTime(),
                         *[f.getModificationTime() for f in fs.listStatus(path)]]) < limit):
            fs.delete(path, True)
            gone.append(path.getName())
    return gone


def cut_lineage(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so that lost executors cost no rerun."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def counted_cut(df: DataFrame, label: str = "cut") -> tuple[DataFrame, int]:
    """The same, with the number of rows, which the writing job counts."""
    seen = Observation()
    cut = cut_lineage(df.observe(seen, F.count(F.lit(1)).alias("n")), label)
    return cut, seen.get.get("n", 0)


def local_rows(spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType,
               ) -> DataFrame:
    """A few literal rows as part of the plan, so that Catalyst knows their size."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(schema)
    columns = [pa.array([row[i] for row in rows], type=field.type)
               for i, field in enumerate(arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), schema)
